"""What some of the queries return, as SQL for another engine, straight from their definitions."""

_SPACED = r"'[^\x20\x09-\x0D]+'"
_ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"


def _lower(column: str) -> str:
    return f"translate({column}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words(table: str, key: str, text: str, pattern: str) -> str:
    return f"SELECT {key}, coalesce(regexp_extract_all({text}, {pattern}), []::VARCHAR[]) AS w FROM {table}"


AUTOMATON_DEDUP = f"""
WITH texts AS ({_words('documents', 'doc_id', 'text', _SPACED)}),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS run FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM texts)),
repeated AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY run) AS first_id FROM windows) WHERE first_id < doc_id),
removed AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM repeated),
places AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM texts),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM places ANTI JOIN removed USING (doc_id, i) GROUP BY doc_id),
gone AS (SELECT doc_id, count(*) AS n FROM removed GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (doc_id) LEFT JOIN gone USING (doc_id)"""

#: A byte is two hexadecimal digits here.
SUFFIX_DEDUP = """
WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (SELECT doc_id, i, substr(h, 2 * i - 1, 100) AS run FROM (SELECT doc_id, h, unnest(range(1, len(h) // 2 - 48)) AS i FROM texts)),
repeated AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY run) AS first_id FROM windows) WHERE first_id < doc_id),
removed AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM repeated),
places AS (SELECT doc_id, i, substr(h, 2 * i - 1, 2) AS b FROM (SELECT doc_id, h, unnest(range(1, len(h) // 2 + 1)) AS i FROM texts)),
kept AS (SELECT doc_id, string_agg(b, '' ORDER BY i) AS h FROM places ANTI JOIN removed USING (doc_id, i) GROUP BY doc_id),
gone AS (
  SELECT doc_id, count(*) AS n, count(*) FILTER (first) AS spans
  FROM (SELECT doc_id, i, i - 1 IS DISTINCT FROM lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS first FROM removed) GROUP BY doc_id)
SELECT doc_id, (len(texts.h) // 2)::BIGINT AS n_bytes, coalesce(n, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(kept.h, ''))) AS kept_sha256
FROM texts LEFT JOIN kept USING (doc_id) LEFT JOIN gone USING (doc_id)"""


def _linked(size: int, percent: int) -> str:
    """Sets of shingles, and for every document the smallest one that it reaches by links."""
    return f"""
WITH RECURSIVE texts AS ({_words('documents', 'doc_id', _lower('text'), _SPACED)}),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + {size - 1}], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {size - 1}, least(len(w), 1)) + 1)) AS i FROM texts)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM shingles AS a JOIN shingles AS b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
linked AS (
  SELECT x, y FROM pairs JOIN sizes AS p ON p.doc_id = x JOIN sizes AS q ON q.doc_id = y WHERE 100 * common >= {percent} * (p.n + q.n - common)),
edges AS (SELECT x, y FROM linked UNION ALL SELECT y, x FROM linked),
reach AS (SELECT x AS doc_id, x AS other FROM edges UNION SELECT doc_id, y FROM reach JOIN edges ON other = x),
lowest AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id),
grouped AS (
  SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(component_id, doc_id) AS component_id
  FROM texts LEFT JOIN sizes USING (doc_id) LEFT JOIN lowest USING (doc_id))
"""


JACCARD_JOIN = _linked(5, 75) + """
SELECT grouped.*, coalesce(n_links, 0)::BIGINT AS n_links FROM grouped LEFT JOIN (SELECT x AS doc_id, count(*) AS n_links FROM edges GROUP BY x) USING (doc_id)"""
SUPER_MINHASH = _linked(3, 85) + "SELECT *, doc_id = component_id AS kept FROM grouped"

DECONTAMINATE = f"""
WITH texts AS ({_words('documents', 'doc_id', _lower('text'), _ALNUM)}),
items AS ({_words('benchmark', 'item_id', _lower('text'), _ALNUM)}),
wanted AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + 12], ' ') AS run
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, least(len(w), 1)) + 1)) AS i FROM items)),
windows AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS run
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM texts, (SELECT DISTINCT n FROM wanted))),
hits AS (SELECT doc_id, item_id, i, windows.n FROM windows JOIN wanted USING (n, run)),
words AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) FROM hits) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * n_hit >= len(w) AS contaminated
FROM texts LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)"""

#: Each order of the five letters with every step: the filter's bit, and the bits of the filters before it.
FILTER_AUDIT = f"""
WITH texts AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), {_SPACED}) AS w FROM documents),
firsts AS (SELECT t, min(doc_id) AS first_id FROM texts GROUP BY t),
marks AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
judged AS (
  SELECT part, (len(w) < 50)::INT + 2 * (100 * len(list_distinct(w)) < 65 * len(w))::INT + 4 * (100 * len(regexp_extract_all(t, '[A-Z]')) > 5 * length(t))::INT
    + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * (texts.doc_id > first_id)::INT AS mask, coalesce(good, false)::INT AS good, coalesce(toxic, false)::INT AS toxic
  FROM texts JOIN firsts USING (t) LEFT JOIN marks ON marks.doc_id = texts.doc_id),
cells AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM judged GROUP BY part, mask),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS bit),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters AS a, letters AS b, letters AS c, letters AS d, letters AS e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
    AND len(list_distinct([a.bit, b.bit, c.bit, d.bit, e.bit])) = 5),
steps AS (SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[:step - 1]), 0)::INT AS before FROM orders, (SELECT unnest(range(1, 6))::INT AS step)),
audit AS (
  SELECT part, filter_order, step, bit, sum(n) FILTER (mask & (before | bit) = 0) AS kept, sum(n) FILTER (mask & bit <> 0 AND mask & before = 0) AS removed,
    sum(n) FILTER (mask & bit <> 0 AND mask & before <> 0) AS redundant, sum(n) FILTER (mask = bit) AS unique_fails,
    sum(good) FILTER (mask & bit <> 0 AND mask & before = 0) AS good_lost, sum(toxic) FILTER (mask & bit <> 0 AND mask & before = 0) AS toxic_lost
  FROM cells, steps GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
  coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
  (coalesce(sum(removed) OVER (PARTITION BY part, bit), 0))::BIGINT AS shapley
FROM audit"""


def _clusters(rounds: int = 10, clusters: int = 8) -> str:
    """One step of each round after the other; rows (k, d, c) are components of centroids."""
    steps = [f"""c0 AS MATERIALIZED (
  SELECT k, d, v AS c FROM (SELECT vec_id, row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS k FROM (SELECT DISTINCT vec_id FROM parts)) JOIN parts USING (vec_id) WHERE k < {clusters})"""]
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
  SELECT vec_id, k, away FROM (
    SELECT vec_id, k, away, row_number() OVER (PARTITION BY vec_id ORDER BY away, k) AS place
    FROM (SELECT vec_id, k, sum((v - c) * (v - c)) AS away FROM parts JOIN c{r} USING (d) GROUP BY vec_id, k)) WHERE place = 1)""")
        if r < rounds:
            steps.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT k, d, coalesce((s - ((s % n) + n) % n) // n, c) AS c FROM c{r} LEFT JOIN (SELECT k, d, sum(v) AS s, count(*) AS n FROM a{r} JOIN parts USING (vec_id) GROUP BY k, d) USING (k, d))""")
    return f"""
WITH kept AS (
  SELECT vec_id, embedding AS e FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
parts AS MATERIALIZED (SELECT vec_id, unnest(range(64)) AS d, floor(unnest(e)::DOUBLE * 1024)::BIGINT AS v FROM kept),
{", ".join(steps)},
prints AS (SELECT k, sha256(string_agg(c::VARCHAR, ',' ORDER BY d)) AS centroid_sha256 FROM c{rounds} GROUP BY k)
SELECT vec_id, k::INT AS cluster, away::BIGINT AS distance, (sum(away) OVER (PARTITION BY k))::BIGINT AS cluster_inertia, (sum(away) OVER ())::BIGINT AS inertia, centroid_sha256
FROM a{rounds} JOIN prints USING (k)"""


SQL = {"op2_automaton_dedup": AUTOMATON_DEDUP, "op5_suffix_dedup": SUFFIX_DEDUP, "op7_jaccard_join": JACCARD_JOIN, "op8_decontaminate": DECONTAMINATE, "op11_super_minhash": SUPER_MINHASH, "op12_hilbert_clusters": _clusters(), "op13_filter_audit": FILTER_AUDIT}
