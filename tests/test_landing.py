import datetime as dt
import os
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.registry import RAW_TABLES
from tidemark.session import shared_dir
from tidemark.sources import missing_days, quarantine, read_days, read_seed, require_days
from tidemark.sources import landing as L
from tidemark.sources.landing import CSV_OPTIONS, folder, landed_days, scan_days, text_ddl
from tidemark.streaming import ingest_new_files, newest_load, newest_load_time, read_ledger, read_raw

RETURN = RAW_TABLES["erp.return"]
HEADER = "these,names,are,not,read,at,all,in,this,file"
GOOD = [
    'RET-1,ORD-1,PROD-1,LOT-1,DIST-1,2026-06-01,5,"Damaged, in Transit",True,2026-06-01T08:00:00',
    "RET-2,ORD-2,PROD-1,LOT-1,DIST-1,2026-06-01,NULL,null,,2026-06-01 08:00:00.5",
    'RET-3,"say ""hi""",PROD-1,"",DIST-1,2026-06-01,7',
]


def put(base, table, day, lines, name="f.csv", header=HEADER):
    path = f"{folder(str(base), table)}/dt={day}"
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}", "w") as f:
        f.write("\n".join([header, *lines]) + "\n")


def test_dialect_types_and_load_columns(spark, tmp_path):
    put(tmp_path, RETURN, "2026-06-01", GOOD)
    put(tmp_path, RETURN, "2026-06-02", GOOD[:1])
    got = read_days(spark, str(tmp_path), RETURN, "2026-06-01")
    assert [f.dataType for f in got.schema.fields[:10]] == [f.dataType for f in RETURN.schema.fields]
    one, two, three = rows(got, "return_id")
    assert one[:10] == (
        "RET-1", "ORD-1", "PROD-1", "LOT-1", "DIST-1", dt.date(2026, 6, 1), Decimal(5), "Damaged, in Transit", True,
        dt.datetime(2026, 6, 1, 8),
    )
    assert two[6:10] == (None, None, None, dt.datetime(2026, 6, 1, 8, 0, 0, 500_000))
    assert three[1] == 'say "hi"' and three[3] is None and three[7:10] == (None, None, None)  # a short line
    assert [r[11] for r in (one, two, three)] == [1, 2, 3] and one[10].endswith("dt=2026-06-01/f.csv")
    assert one[12] is not None and one[13] == "2026-06-01"


def test_a_range_of_days_reads_only_its_folders(spark, tmp_path):
    for day in ("2026-06-01", "2026-06-02", "2026-06-03"):
        put(tmp_path, RETURN, day, GOOD)
    got = read_days(spark, str(tmp_path), RETURN, "2026-06-02", "2026-06-03")
    assert got.count() == 6 and {r.dt for r in got.select("dt").collect()} == {"2026-06-02", "2026-06-03"}
    scan = scan_days(spark, str(tmp_path), RETURN, "2026-06-02", "2026-06-03")
    assert "PartitionFilters: [isnotnull(dt" in scan._jdf.queryExecution().executedPlan().toString()
    assert {f.split("dt=")[1][:10] for f in scan.inputFiles()} >= {"2026-06-02", "2026-06-03"}


def test_a_bad_value_stops_the_load_or_goes_to_quarantine(spark, tmp_path):
    put(tmp_path, RETURN, "2026-06-01", [GOOD[0], GOOD[0].replace(",5,", ",many,")])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_days(spark, str(tmp_path), RETURN, "2026-06-01").collect()
    text = spark.read.options(**CSV_OPTIONS).schema(text_ddl(RETURN)).csv(folder(str(tmp_path), RETURN))
    good, bad = quarantine(text, RETURN)
    assert good.count() == 1 and rows(bad.select("quantity")) == [("many",)]


@pytest.fixture
def pieces(spark, tmp_path):
    """Three files that are cut into many blocks; row k of each is called Rk."""
    for f in range(3):
        put(tmp_path / "landing", RETURN, "2026-06-01", [f"R{i}" + ",x" * (i % 3) for i in range(1, 5001 + f)], name=f"f{f}.csv")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    yield str(tmp_path / "landing")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def right_numbers(got):
    right = F.expr("return_id = concat('R', _source_file_row_number)")
    per_file = got.groupBy("_source_file").agg(F.count("*"), F.count_if(right), F.count_distinct("_source_file_row_number"))
    return sorted(tuple(r)[1:] for r in per_file.collect())


def test_row_numbers_of_files_cut_into_many_pieces(spark, pieces, tmp_path):
    assert scan_days(spark, pieces, RETURN, "2026-06-01").rdd.getNumPartitions() > 10
    want = [(n, n, n) for n in (5000, 5001, 5002)]
    assert right_numbers(read_days(spark, pieces, RETURN, "2026-06-01")) == want
    raw = str(tmp_path / "raw")
    ingest_new_files(spark, pieces, raw, RETURN)
    assert right_numbers(read_raw(spark, raw, RETURN)) == want
    blocks = spark.read.parquet(f"{raw}/erp/return__ledger")
    assert blocks.count() > 10 and blocks.agg(F.sum("_n")).first()[0] == 15003


def test_rows_compare_alike_without_exact_numbers(spark, pieces, tmp_path):
    raw = str(tmp_path / "raw")
    ingest_new_files(spark, pieces, raw, RETURN)
    cheap = read_raw(spark, raw, RETURN, exact_numbers=False)
    assert "Join" not in cheap._jdf.queryExecution().executedPlan().toString()
    last = cheap.groupBy("_source_file").agg(F.max_by("return_id", "_source_file_row_number").alias("last"))
    assert sorted(r["last"] for r in last.collect()) == ["R5000", "R5001", "R5002"]


def test_the_ledger_tells_files_loads_and_times(spark, tmp_path):
    landing, raw = str(tmp_path / "landing"), str(tmp_path / "raw")
    assert newest_load(spark, raw, RETURN) is None and newest_load_time(spark, raw, RETURN) is None
    assert read_ledger(spark, raw, RETURN).count() == 0
    put(landing, RETURN, "2026-06-01", GOOD)
    put(landing, RETURN, "2026-06-02", GOOD[:2])
    ingest_new_files(spark, landing, raw, RETURN)
    first = newest_load_time(spark, raw, RETURN)
    put(landing, RETURN, "2026-06-03", [])  # a file without rows
    ingest_new_files(spark, landing, raw, RETURN)
    assert newest_load(spark, raw, RETURN) == 1 and newest_load_time(spark, raw, RETURN) == first
    assert rows(read_ledger(spark, raw, RETURN).select("table_name", "dt", "load", "n_rows"), "dt") == [
        ("erp.return", "2026-06-01", 0, 3), ("erp.return", "2026-06-02", 0, 2)]
    assert first == read_raw(spark, raw, RETURN).agg(F.max("_loaded_at")).first()[0]


def test_a_load_counts_once_it_is_in_the_ledger(spark, tmp_path):
    landing, raw = str(tmp_path / "landing"), str(tmp_path / "raw")
    put(landing, RETURN, "2026-06-01", GOOD)
    ingest_new_files(spark, landing, raw, RETURN)
    spark.read.parquet(f"{raw}/erp/return/_load=0").write.partitionBy("dt").parquet(f"{raw}/erp/return/_load=1")  # a job that died here
    for exact in (True, False):
        assert read_raw(spark, raw, RETURN, exact_numbers=exact).count() == 3
    put(landing, RETURN, "2026-06-02", GOOD[:1])
    ingest_new_files(spark, landing, raw, RETURN)
    assert read_raw(spark, raw, RETURN).count() == 4 and newest_load(spark, raw, RETURN) == 1


def test_ingest_loads_each_file_once(spark, tmp_path):
    landing, raw = str(tmp_path / "landing"), str(tmp_path / "raw")
    put(landing, RETURN, "2026-06-01", GOOD)
    for expected in (3, 3):
        ingest_new_files(spark, landing, raw, RETURN)
        assert read_raw(spark, raw, RETURN).count() == expected
    put(landing, RETURN, "2026-06-02", GOOD[:2])
    put(landing, RETURN, "2026-06-01", GOOD[:1], name="late.csv")
    ingest_new_files(spark, landing, raw, RETURN, files_per_batch=1)
    got = read_raw(spark, raw, RETURN)
    assert got.count() == 6 and read_raw(spark, raw, RETURN, "2026-06-02").count() == 2
    assert rows(got.groupBy("dt").agg(F.max("_source_file_row_number"), F.count("*")), "dt") == [("2026-06-01", 3, 4), ("2026-06-02", 2, 2)]
    assert [f.dataType for f in got.schema.fields[:10]] == [f.dataType for f in RETURN.schema.fields]


def test_a_bad_file_leaves_nothing_loaded_and_loads_once_mended(spark, tmp_path):
    landing, raw = str(tmp_path / "landing"), str(tmp_path / "raw")
    put(landing, RETURN, "2026-06-01", [GOOD[0].replace("2026-06-01,5", "no date,5")])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        ingest_new_files(spark, landing, raw, RETURN)
    put(landing, RETURN, "2026-06-01", GOOD)
    ingest_new_files(spark, landing, raw, RETURN)
    assert read_raw(spark, raw, RETURN).count() == 3


def test_completeness_names_what_is_missing(spark, tmp_path):
    tables = [RETURN, RAW_TABLES["mdm.product"], RAW_TABLES["mdm.hcp"]]
    days = ["2026-06-01", "2026-06-02"]
    put(tmp_path, RETURN, days[0], GOOD)
    for day in days:
        put(tmp_path, RAW_TABLES["mdm.product"], day, [])
    assert rows(missing_days(spark, str(tmp_path), tables, days), "table_name", "dt") == [
        ("erp.return", "2026-06-02"), ("mdm.hcp", "2026-06-01"), ("mdm.hcp", "2026-06-02"),
    ]
    with pytest.raises(RuntimeError, match="mdm.hcp 2026-06-01"):
        require_days(spark, str(tmp_path), tables, days)
    require_days(spark, str(tmp_path), tables, days, optional=["mdm.hcp", "erp.return"])


def test_only_the_days_asked_for_are_listed(spark, tmp_path, monkeypatch):
    put(tmp_path, RETURN, "2026-06-01", GOOD)
    put(tmp_path, RETURN, "2026-06-02", GOOD)
    assert rows(landed_days(spark, str(tmp_path), [RETURN, RAW_TABLES["mdm.hcp"]]), "dt") == [("erp.return", "2026-06-01"), ("erp.return", "2026-06-02")]
    listed = []
    files = L._files
    monkeypatch.setattr(L, "_files", lambda spark, pattern: listed.append(pattern) or files(spark, pattern))
    assert missing_days(spark, str(tmp_path), [RETURN], ["2026-06-02"]).count() == 0
    assert listed == [f"{folder(str(tmp_path), RETURN)}/dt=2026-06-02/*.csv"]


def test_a_folder_that_cannot_be_read_is_no_empty_folder(spark):
    with pytest.raises(Exception, match="No FileSystem for scheme"):
        require_days(spark, "nowhere://store/landing", [RETURN], ["2026-06-01"])
    with pytest.raises(Exception, match="No FileSystem for scheme"):
        landed_days(spark, "nowhere://store/landing", [RETURN])


def test_seeds(spark, tmp_path):
    assert read_seed(spark, "territory").count() == 12
    assert read_seed(spark, "therapeutic_category_group").count() == 8
    reasons = {r[0]: r[2] for r in read_seed(spark, "return_reason_lookup").collect()}
    assert len(reasons) == 5 and reasons["Product Recall"] is False and reasons["Overstock"] is True
    big = tmp_path / "big.csv"
    big.write_text("territory_id,territory_name,region\n" + "T,n,r\n" * 10_001)
    with pytest.raises(ValueError, match="more than 10000"):
        read_seed(spark, "territory", str(big))


def test_shared_dir_follows_the_session(spark):
    assert shared_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir") + "/x-")
