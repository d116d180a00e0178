"""The same feeds and models as SQL, to check results against another engine.

``MODELS`` maps a name to its SELECT; :func:`with_models` puts the ones a query needs in front of it.
"""

from __future__ import annotations

import re

from tidemark.functions.keys import NULL_MARK
from tidemark.quality.suite import PRICE_TIERS, RETURN_REASONS
from tidemark.workload.standins import CATEGORIES, QUERY_PARAMS

AS_OF = f"DATE '{QUERY_PARAMS.as_of_date}'"
RUN_TS = f"TIMESTAMP '{QUERY_PARAMS.run_ts}'"
NEWEST = "_loaded_at DESC, _source_file_row_number DESC"


CALENDAR = """SELECT d::DATE AS date_day, strftime(d, '%Y%m%d')::INTEGER AS date_key, year(d) AS year, quarter(d) AS quarter,
  month(d) AS month, strftime(d, '%b') AS month_name, day(d) AS day_of_month, dayofweek(d) AS day_of_week,
  strftime(d, '%a') AS day_name, weekofyear(d) AS week_of_year, dayofweek(d) IN (0, 6) AS is_weekend"""


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def key(*parts: str) -> str:
    return "md5(" + " || '-' || ".join(f"coalesce({p}, '{NULL_MARK}')" for p in parts) + ")"


def _version_key(natural: str) -> str:
    return key(natural, "strftime(valid_from, '%Y-%m-%d %H:%M:%S.%f')")


def _at(start: str, days: str) -> str:
    return f"TIMESTAMP '{start}' + to_days(({days})::INTEGER)"


def _seed(name: str) -> str:
    from importlib import resources

    lines = (resources.files("tidemark") / "seeds" / f"{name}.csv").read_text().splitlines()
    rows = ", ".join("(" + ", ".join(f"'{v}'" for v in line.split(",")) + ")" for line in lines[1:])
    return f"SELECT * FROM (VALUES {rows}) AS v({lines[0]})"


def _latest(raw: str, columns: str, keys: str, newest: str = NEWEST) -> str:
    return (
        f"SELECT {columns}, _loaded_at FROM {raw}\n"
        f"QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {newest}) = 1"
    )


def _trim(names: str) -> str:
    return ", ".join(f"trim({n}) AS {n}" for n in names.split())


def _history(staged: str, natural: str) -> str:
    return (
        f"SELECT *, source_updated_at AS valid_from, lead(source_updated_at) OVER "
        f"(PARTITION BY {natural} ORDER BY source_updated_at) AS valid_to FROM {staged}"
    )


def asof(fact: str, natural: str, dim: str, dim_natural: str, at: str) -> str:
    """Join condition of the version valid at a time."""
    return (
        f"{fact}.{natural} = {dim}.{dim_natural} AND {fact}.{at} >= {dim}.valid_from "
        f"AND {fact}.{at} < coalesce({dim}.valid_to, TIMESTAMP '9999-12-31')"
    )


_DAY = "(l_shipdate::DATE)"
_NEXT_DAY = f"({_DAY}::TIMESTAMP + to_days(1))"
_PRODUCT = "'PROD-' || (l_partkey // 50)"
_LOT = "'LOT-' || (l_partkey // 50) || '-' || (l_partkey % 3)"
_WAREHOUSE = "'WH-' || (1 + l_suppkey // 50)"
_LINE_ROW = "l_partkey * 1000000 + l_suppkey AS _source_file_row_number"

MODELS: dict[str, str] = {
    "territory": _seed("territory"),
    "category_group_list": _seed("therapeutic_category_group"),
    "reason_list": _seed("return_reason_lookup"),
    # -- feeds
    "raw_product": f"""
SELECT ' PROD-' || p_partkey || ' ' AS product_id, 'NDC-' || p_partkey AS ndc_code,
  CASE WHEN k = 0 THEN p_name || ' (draft)' ELSE p_name END AS product_name,
  ({_list(CATEGORIES)})[p_partkey % 9 + 1] AS therapeutic_category, p_type AS formulation,
  p_retailprice::DECIMAL(12,2) + 10 * r AS list_price,
  ({_list(PRICE_TIERS)})[(p_partkey + r) % 3 + 1] AS price_tier, p_partkey % 17 <> 0 AS is_active,
  {_at('1996-01-01 07:00:00', 'r * (200 + p_size * 7)')} AS source_updated_at,
  source_updated_at + to_days((1 + k)::INTEGER) AS _loaded_at, p_partkey AS _source_file_row_number
FROM (SELECT *, unnest(range(p_partkey % 3 + 1)) AS r FROM part), range(2) AS copies(k)""",
    "raw_hcp": f"""
SELECT 'HCP-' || c_custkey AS hcp_id, (1000000000 + c_custkey)::VARCHAR AS npi_number, c_mktsegment AS first_name,
  ' ' || c_name AS last_name, c_mktsegment AS specialty,
  (['Tier A', 'Tier B', 'Tier C'])[(c_nationkey + r) % 3 + 1] AS hcp_tier,
  'TERR-' || lpad(((c_nationkey + r) % 14 + 1)::VARCHAR, 3, '0') AS territory_id, 'City ' || c_nationkey AS city,
  'S' || c_nationkey AS state, lpad(c_custkey::VARCHAR, 9, '0') AS zip_code,
  {_at('2023-12-20 07:00:00', 'r * (9 + c_custkey % 5)')} AS source_updated_at,
  source_updated_at + to_days(1) AS _loaded_at, c_custkey AS _source_file_row_number
FROM (SELECT *, unnest(range(c_custkey % 3 + 1)) AS r FROM customer)""",
    "raw_sales_rep": f"""
SELECT 'REP-' || s_suppkey AS rep_id, 'Rep' AS first_name,
  CASE WHEN r = 1 THEN s_name || ' II' ELSE s_name END AS last_name,
  DATE '2010-01-01' + s_nationkey * 30 AS hire_date,
  'TERR-' || lpad(((s_nationkey + r) % 14 + 1)::VARCHAR, 3, '0') AS territory_id,
  CASE WHEN s_suppkey % 5 = 0 THEN ' ' ELSE 'REP-' || (s_suppkey - s_suppkey % 5 + 1) END AS manager_rep_id,
  'R' || s_nationkey AS region,
  {_at('2023-12-25 06:00:00', 'r * (10 + s_suppkey % 7)')} AS source_updated_at,
  source_updated_at + to_days(1) AS _loaded_at, s_suppkey AS _source_file_row_number
FROM (SELECT *, unnest(range(s_suppkey % 2 + 1)) AS r FROM supplier)""",
    "raw_hcp_visit": """
SELECT 'VISIT-' || event_id AS visit_id, 'REP-' || (user_id // 5) AS rep_id, 'HCP-' || user_id AS hcp_id,
  ts::DATE AS visit_date, event_type AS visit_type, (event_id % 60 + 5 * k)::DECIMAL(6,0) AS duration_minutes,
  CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id % 26 END::DECIMAL(8,0) AS samples_dropped_qty,
  CASE WHEN event_id % 3 = 0 THEN ' ' ELSE 'PROD-' || (event_id // 5) END AS sample_product_id, ts AS created_at,
  ts::DATE::TIMESTAMP + to_days((1 + k)::INTEGER) AS _loaded_at, event_id AS _source_file_row_number
FROM (SELECT *, unnest(range(CASE WHEN event_id % 10 = 0 THEN 2 ELSE 1 END)) AS k FROM events)""",
    "raw_distributor": f"""
SELECT 'DIST-' || c_custkey AS distributor_id, c_name AS distributor_name, 'Tier ' || (c_nationkey % 3 + k) AS distributor_tier,
  'City ' || c_nationkey AS city, 'S' || c_nationkey AS state, lpad(c_custkey::VARCHAR, 9, '0') AS zip_code,
  {_at('1995-01-01 06:00:00', 'k')} AS source_updated_at, {_at('1995-01-02 00:00:00', 'k')} AS _loaded_at,
  c_custkey AS _source_file_row_number
FROM customer, range(2) AS copies(k)""",
    "raw_warehouse": f"""
SELECT 'WH-' || s_suppkey AS warehouse_id, s_name || ' ' || k AS warehouse_name, 'R' || s_nationkey AS region,
  'City ' || s_nationkey AS city, 'S' || s_nationkey AS state,
  {_at('1995-01-01 06:00:00', 'k')} AS source_updated_at, {_at('1995-01-02 00:00:00', 'k')} AS _loaded_at,
  s_suppkey AS _source_file_row_number
FROM supplier, range(2) AS copies(k)""",
    "raw_sales_order": f"""
SELECT 'ORD-' || l_orderkey AS order_id, 'ORD-' || l_orderkey || '-L' || l_linenumber AS order_line_id,
  o_orderdate::DATE AS order_date, 'DIST-' || o_custkey AS distributor_id, {_PRODUCT} AS product_id, {_LOT} AS batch_id,
  {_WAREHOUSE} AS warehouse_id, l_quantity::DECIMAL(10,0) AS quantity, l_extendedprice::DECIMAL(12,2) AS list_price,
  l_discount::DECIMAL(6,4) AS discount_pct, l_tax::DECIMAL(6,4) AS rebate_pct,
  CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE l_linenumber * 1.5 END::DECIMAL(12,2) AS chargeback_amount,
  {_DAY} AS ship_date, o_orderdate AS created_at, {_NEXT_DAY} AS _loaded_at, {_LINE_ROW}
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "raw_return": f"""
SELECT 'RET-' || l_orderkey || '-' || l_linenumber AS return_id, 'ORD-' || l_orderkey AS original_order_id,
  {_PRODUCT} AS product_id, {_LOT} AS batch_id, 'DIST-' || o_custkey AS distributor_id, {_DAY} + 10 AS return_date,
  l_quantity::DECIMAL(10,0) AS quantity, ({_list((*RETURN_REASONS, 'Other'))})[l_partkey % 6 + 1] AS reason_code,
  CASE l_partkey % 4 WHEN 0 THEN NULL WHEN 1 THEN true ELSE false END AS recall_flag, l_shipdate AS created_at,
  {_NEXT_DAY} AS _loaded_at, {_LINE_ROW}
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R'""",
    "raw_inventory_snapshot": f"""
SELECT last_day(l_shipdate) AS snapshot_date, {_WAREHOUSE} AS warehouse_id, {_PRODUCT} AS product_id, {_LOT} AS batch_id,
  DATE '1996-06-01' + ((l_partkey // 50 * 37 + l_partkey % 3 * 111) % 2500)::INTEGER AS lot_expiry_date,
  (l_quantity * 100)::DECIMAL(12,0) AS qty_on_hand, l_shipdate AS created_at, {_NEXT_DAY} AS _loaded_at,
  'lines-' || l_partkey || '-' || l_suppkey AS _source_file, l_orderkey * 10 + l_linenumber AS _source_file_row_number
FROM lineitem""",
    # -- staging
    "stg_product": _latest(
        "raw_product",
        _trim("product_id ndc_code product_name therapeutic_category formulation price_tier")
        + ", list_price, is_active, source_updated_at", "product_id, source_updated_at",
    ),
    "stg_hcp": _latest(
        "raw_hcp",
        _trim("hcp_id npi_number first_name last_name specialty hcp_tier territory_id city state zip_code")
        + ", source_updated_at", "hcp_id, source_updated_at",
    ),
    "stg_sales_rep": _latest(
        "raw_sales_rep",
        _trim("rep_id first_name last_name territory_id region")
        + ", hire_date, nullif(trim(manager_rep_id), '') AS manager_rep_id, source_updated_at",
        "rep_id, source_updated_at",
    ),
    "stg_hcp_visit": _latest(
        "raw_hcp_visit",
        _trim("visit_id rep_id hcp_id visit_type")
        + ", visit_date, duration_minutes, coalesce(samples_dropped_qty, 0) AS samples_dropped_qty, "
        "nullif(trim(sample_product_id), '') AS sample_product_id, created_at", "visit_id",
    ),
    "stg_distributor": _latest(
        "raw_distributor",
        _trim("distributor_id distributor_name distributor_tier city state zip_code") + ", source_updated_at",
        "distributor_id",
    ),
    "stg_warehouse": _latest(
        "raw_warehouse", _trim("warehouse_id warehouse_name region city state") + ", source_updated_at", "warehouse_id",
    ),
    "stg_sales_order": _latest(
        "raw_sales_order",
        _trim("order_id order_line_id distributor_id product_id batch_id warehouse_id")
        + ", order_date, quantity, list_price, discount_pct, rebate_pct, "
        "coalesce(chargeback_amount, 0) AS chargeback_amount, ship_date, created_at", "order_line_id",
    ),
    "stg_return": _latest(
        "raw_return",
        _trim("return_id original_order_id product_id batch_id distributor_id reason_code")
        + ", return_date, quantity, coalesce(recall_flag, false) AS recall_flag, created_at", "return_id",
    ),
    "stg_inventory_snapshot": _latest(
        "raw_inventory_snapshot",
        _trim("warehouse_id product_id batch_id") + ", snapshot_date, lot_expiry_date, qty_on_hand, created_at",
        "snapshot_date, warehouse_id, product_id, batch_id",
        "_loaded_at DESC, _source_file DESC, _source_file_row_number DESC",
    ),
    # -- histories
    "product_history": _history("stg_product", "product_id"),
    "hcp_history": _history("stg_hcp", "hcp_id"),
    "sales_rep_history": _history("stg_sales_rep", "rep_id"),
    # -- business logic
    "gross_to_net": """
SELECT *, (quantity * list_price)::DECIMAL(14,2) AS gross_amount,
  (quantity * list_price * discount_pct)::DECIMAL(14,2) AS discount_amount,
  rebate_exact::DECIMAL(14,2) AS rebate_amount,
  (gross_amount - discount_amount - rebate_exact - chargeback_amount)::DECIMAL(14,2) AS net_revenue
FROM (SELECT *, (quantity * list_price - quantity * list_price * discount_pct) * rebate_pct AS rebate_exact
      FROM stg_sales_order)""",
    "engagement_score": f"""
SELECT *, least(100, round(
    (least(visits_trailing_window, 12) / 12.0)::DECIMAL(12,6) * 40
    + (least(samples_trailing_window, 150) / 150.0)::DECIMAL(12,6) * 30
    + (CASE WHEN days_since_prior_visit IS NULL THEN 0.5 WHEN days_since_prior_visit <= 7 THEN 1
            WHEN days_since_prior_visit >= 60 THEN 0
            ELSE 1 - ((days_since_prior_visit - 7) / 53.0)::DECIMAL(12,6) END)::DECIMAL(12,6) * 30, 1)) AS engagement_score
FROM (SELECT *, count(*) OVER last_days AS visits_trailing_window,
        sum(samples_dropped_qty) OVER last_days AS samples_trailing_window,
        date_diff('day', lag(visit_date) OVER one_by_one, visit_date) AS days_since_prior_visit
      FROM stg_hcp_visit
      WINDOW last_days AS (PARTITION BY hcp_id ORDER BY visit_date
                          RANGE BETWEEN INTERVAL {QUERY_PARAMS.engagement_days} DAY PRECEDING AND CURRENT ROW),
             one_by_one AS (PARTITION BY hcp_id ORDER BY visit_date, created_at, visit_id))""",
    "daily_consumption": """
SELECT warehouse_id, product_id, ship_date, sum(quantity) AS shipped FROM stg_sales_order GROUP BY ALL""",
    "inventory_runway": f"""
SELECT *, CASE WHEN avg_daily_consumption <> 0
               THEN round((qty_on_hand / avg_daily_consumption)::DECIMAL(30,6), 1) END AS days_on_hand
FROM (SELECT *, (SELECT avg(shipped)::DECIMAL(24,6) FROM daily_consumption AS d
                 WHERE d.warehouse_id = s.warehouse_id AND d.product_id = s.product_id
                   AND d.ship_date BETWEEN s.snapshot_date - {QUERY_PARAMS.consumption_days} AND s.snapshot_date
                ) AS avg_daily_consumption
      FROM stg_inventory_snapshot AS s)""",
    "batch_expiry": f"""
SELECT product_id, batch_id, arg_max(lot_expiry_date, (snapshot_date, lot_expiry_date)) AS lot_expiry_date,
  date_diff('day', {AS_OF}, arg_max(lot_expiry_date, (snapshot_date, lot_expiry_date))) AS days_to_expiry,
  days_to_expiry <= {QUERY_PARAMS.near_expiry_days} AS is_near_expiry, days_to_expiry < 0 AS is_expired
FROM stg_inventory_snapshot GROUP BY product_id, batch_id""",
    # -- dimensions
    "dim_product": f"""
SELECT {_version_key('product_id')} AS product_key, h.* EXCLUDE (_loaded_at), category_group, valid_to IS NULL AS is_current
FROM product_history AS h LEFT JOIN category_group_list USING (therapeutic_category)""",
    "dim_hcp": f"""
SELECT {_version_key('hcp_id')} AS hcp_key, h.* EXCLUDE (_loaded_at), territory_name, region, valid_to IS NULL AS is_current
FROM hcp_history AS h LEFT JOIN territory USING (territory_id)""",
    "dim_sales_rep": f"""
SELECT {_version_key('h.rep_id').replace('valid_from', 'h.valid_from')} AS rep_key, h.* EXCLUDE (_loaded_at, region),
  t.territory_name, t.region, m.first_name || ' ' || m.last_name AS manager_name, h.valid_to IS NULL AS is_current
FROM sales_rep_history AS h LEFT JOIN territory AS t USING (territory_id)
LEFT JOIN sales_rep_history AS m ON m.rep_id = h.manager_rep_id AND m.valid_to IS NULL""",
    "dim_distributor": f"""
SELECT {key('distributor_id')} AS distributor_key, s.* EXCLUDE (_loaded_at), {RUN_TS} AS first_loaded_at
FROM stg_distributor AS s""",
    "dim_warehouse": f"""
SELECT {key('warehouse_id')} AS warehouse_key, s.* EXCLUDE (_loaded_at), {RUN_TS} AS first_loaded_at
FROM stg_warehouse AS s""",
    "dim_date": f"""
{CALENDAR}
FROM range(DATE '{QUERY_PARAMS.spine_start}', DATE '{QUERY_PARAMS.spine_end}', INTERVAL 1 DAY) AS days(d)""",
    # -- facts
    "fact_sales_orders": f"""
SELECT f.*, distributor_key, warehouse_key, date_key AS order_date_key, product_key, e.lot_expiry_date,
  e.is_expired AS batch_is_expired_today, f.ship_date > e.lot_expiry_date AS is_expired_at_ship
FROM gross_to_net AS f
LEFT JOIN dim_distributor AS d ON f.distributor_id = d.distributor_id
LEFT JOIN dim_warehouse AS w ON f.warehouse_id = w.warehouse_id
LEFT JOIN dim_date ON order_date = date_day
LEFT JOIN batch_expiry AS e ON f.product_id = e.product_id AND f.batch_id = e.batch_id
LEFT JOIN dim_product AS p ON {asof('f', 'product_id', 'p', 'product_id', 'order_date')}""",
    "fact_hcp_visits": f"""
SELECT f.*, date_key AS visit_date_key, hcp_key, rep_key, product_key AS sample_product_key
FROM engagement_score AS f
LEFT JOIN dim_date ON visit_date = date_day
LEFT JOIN dim_hcp AS h ON {asof('f', 'hcp_id', 'h', 'hcp_id', 'visit_date')}
LEFT JOIN dim_sales_rep AS r ON {asof('f', 'rep_id', 'r', 'rep_id', 'visit_date')}
LEFT JOIN dim_product AS p ON {asof('f', 'sample_product_id', 'p', 'product_id', 'visit_date')}""",
    "fact_inventory_snapshot": f"""
SELECT f.*, date_key AS snapshot_date_key, warehouse_key, product_key, e.days_to_expiry, e.is_near_expiry, e.is_expired
FROM inventory_runway AS f
LEFT JOIN dim_date ON snapshot_date = date_day
LEFT JOIN dim_warehouse AS w ON f.warehouse_id = w.warehouse_id
LEFT JOIN batch_expiry AS e ON f.product_id = e.product_id AND f.batch_id = e.batch_id
LEFT JOIN dim_product AS p ON {asof('f', 'product_id', 'p', 'product_id', 'snapshot_date')}""",
    "fact_returns": f"""
SELECT f.*, date_key AS return_date_key, distributor_key, product_key, reason_category, is_controllable
FROM stg_return AS f
LEFT JOIN dim_date ON return_date = date_day
LEFT JOIN dim_distributor AS d ON f.distributor_id = d.distributor_id
LEFT JOIN reason_list AS l ON f.reason_code = l.reason_code
LEFT JOIN dim_product AS p ON {asof('f', 'product_id', 'p', 'product_id', 'return_date')}""",
}


def needed(sql: str) -> list[str]:
    """Models a text refers to, directly or through other models, in definition order."""
    found: set[str] = set()
    queue = [sql]
    while queue:
        text = queue.pop()
        for name in MODELS:
            if name not in found and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                found.add(name)
                queue.append(MODELS[name])
    return [name for name in MODELS if name in found]


def _renamed(sql: str) -> str:
    """The text with every model it reads replaced by the model as of the first run."""
    return re.sub(rf"\b(FROM|JOIN)(\s+)({'|'.join(MODELS)})\b", r"\1\2\3_early", sql)


def with_models(sql: str, early: dict[str, str] | None = None) -> str:
    """``early`` holds conditions on raw models: ``<model>_early`` then stands for a model built from such rows only."""
    if early:
        wanted = sorted({name for name in MODELS if f"{name}_early" in sql})
        late = needed(sql.replace("_early", " "))
        first = needed(" ".join(f"FROM {name}" for name in wanted))
        parts = [f"{n} AS ({MODELS[n]})" for n in late]
        for n in first:
            text = f"SELECT * FROM ({MODELS[n]}) WHERE {early[n]}" if n in early else _renamed(MODELS[n])
            parts.append(f"{n}_early AS ({text})")
        return "WITH " + ",\n".join(parts) + "\n" + sql
    names = needed(sql)
    if not names:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({MODELS[n]})" for n in names) + "\n" + sql
