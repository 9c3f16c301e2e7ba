import datetime as dt
import glob
import os
import shutil
import time
import uuid

from pyspark.sql import functions as F

from conftest import SF01, tx_frame
from txrisk import schema as S
from txrisk.operators import features as feat
from txrisk.functions import calendar as cal
from txrisk.session import scratch_path
from txrisk.sources import sinks
from txrisk.sources import transactions as src

D = dt.datetime


def _rows(day, n, start_id):
    return [(start_id + i, D(2024, 1, day, 1 + i), i, i, 10.0 + i, 0) for i in range(n)]


def test_append_and_dynamic_overwrite(spark):
    path = scratch_path(spark, f"test-sink-{uuid.uuid4().hex}")
    sinks.write_daily(tx_frame(spark, _rows(1, 3, 0) + _rows(2, 2, 10)), path)
    sinks.write_daily(tx_frame(spark, _rows(3, 4, 20)), path, mode="append")          # S7: a new day
    sinks.write_daily(tx_frame(spark, _rows(2, 5, 30)), path)                         # rewrite day 2 only
    back = sinks.read_partitioned(spark, path, S.RAW_TRANSACTION, S.TX_DATE)
    got = {r[S.TX_DATE]: r["n"] for r in back.groupBy(S.TX_DATE).agg(F.count("*").alias("n")).collect()}
    assert got == {"2024-01-01": 3, "2024-01-02": 5, "2024-01-03": 4}
    day2 = [r[S.TX_ID] for r in back.where(F.col(S.TX_DATE) == "2024-01-02").collect()]
    assert sorted(day2) == list(range(30, 35))


def test_partition_filter_reaches_scan(spark):
    path = scratch_path(spark, f"test-prune-{uuid.uuid4().hex}")
    sinks.write_daily(tx_frame(spark, _rows(1, 3, 0) + _rows(2, 2, 10)), path)
    back = sinks.read_partitioned(spark, path, S.RAW_TRANSACTION, S.TX_DATE).where(F.col(S.TX_DATE) == "2024-01-02")
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(TX_DATE" in plan and back.count() == 2


def test_latest_file(spark):
    base = scratch_path(spark, f"test-files-{uuid.uuid4().hex}")
    tx_frame(spark, _rows(1, 3, 0)).coalesce(1).write.parquet(f"{base}/a")
    time.sleep(1.1)
    tx_frame(spark, _rows(2, 2, 10)).coalesce(1).write.parquet(f"{base}/b")
    both = spark.read.schema(S.RAW_TRANSACTION).parquet(f"{base}/a", f"{base}/b")
    assert sorted(r[S.TX_ID] for r in src.latest_file(both).collect()) == [10, 11]


def test_align_to_schema(spark):
    base = tx_frame(spark, _rows(1, 2, 7))
    shuffled = base.select(*reversed(base.columns), F.lit(1).alias("extra")).withColumn(S.TX_ID, F.col(S.TX_ID).cast("string"))
    out = src.align_to(shuffled, S.RAW_TRANSACTION)
    assert out.columns == S.RAW_COLUMNS and out.schema == S.RAW_TRANSACTION
    assert sorted(out.collect()) == sorted(base.collect())


def test_seconds_until_midnight(spark):
    df = spark.createDataFrame([(D(2024, 1, 1, 0, 0, 0),), (D(2024, 1, 1, 23, 59, 50),), (D(2024, 1, 1, 12),)],
                               "t timestamp_ntz")
    got = [r[0] for r in df.select(cal.seconds_until_midnight("t")).collect()]
    assert got == [0, 10, 43200]


def test_csv_round_trip(spark):
    path = scratch_path(spark, f"test-csv-{uuid.uuid4().hex}")
    tx = tx_frame(spark, _rows(1, 3, 0))
    sinks.write_daily(tx, path, fmt="csv")
    back = src.read_transactions(spark, path, fmt="csv")
    assert sorted(back.collect()) == sorted(tx.collect())


def test_read_latest_day_and_lookback_prune(spark):
    path = scratch_path(spark, f"test-latest-{uuid.uuid4().hex}")
    rows = _rows(1, 2, 0) + _rows(5, 3, 10) + _rows(9, 2, 20)
    sinks.write_daily(tx_frame(spark, rows), path)
    assert sinks.partition_values(spark, path) == ["2024-01-01", "2024-01-05", "2024-01-09"]
    latest = sinks.read_latest_day(spark, path, S.RAW_TRANSACTION)
    assert sorted(r[S.TX_ID] for r in latest.collect()) == [20, 21]
    assert "PartitionFilters: [isnotnull(TX_DATE" in latest._jdf.queryExecution().executedPlan().toString()
    lb = sinks.read_lookback(spark, path, 4)  # last = 01-09 02:00 -> keep > 01-05 02:00
    assert sorted(r[S.TX_ID] for r in lb.collect()) == [12, 20, 21]
    assert "PartitionFilters" in lb._jdf.queryExecution().executedPlan().toString()


def test_lookback_is_the_same_in_any_session_zone(spark, tmp_path):
    path = str(tmp_path / "raw")
    sinks.write_daily(src.transactions(spark, SF01), path)
    counts = set()
    for zone in ("UTC", "America/Los_Angeles"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            counts.add(sinks.read_lookback(spark, path, 14).count())
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert counts == {4680}


def test_folders_are_listed_through_hadoop(spark, tmp_path):
    for d in ("TX_DATE=2024-01-02", "TX_DATE=2024-01-01", "_tmp"):
        (tmp_path / d).mkdir()
    assert sinks.partition_values(spark, f"file://{tmp_path}") == ["2024-01-01", "2024-01-02"]
    assert not sinks.folder_exists(spark, f"file://{tmp_path}/none")


def _late(spark, path):
    """Days 1 to 9, where the greatest id lies in day 7's folder."""
    rows = [(i, D(2024, 1, 1 + i, 2), 1, 1, 1, 0) for i in range(9)] + [(100, D(2024, 1, 7, 12), 1, 1, 1, 0)]
    sinks.write_daily(tx_frame(spark, rows), path)
    return rows


def test_a_late_id_in_an_older_day_is_the_anchor(spark, tmp_path):
    path = str(tmp_path / "days")
    rows = _late(spark, path)
    got = sorted(r[0] for r in sinks.read_lookback(spark, path, 4).select(S.TX_ID).collect())
    assert got == sorted(i for i, t, *_ in rows if t > D(2024, 1, 3, 12))
    whole = src.read_transactions(spark, path)
    assert got == sorted(r[0] for r in feat.lookback(whole, 4).select(S.TX_ID).collect())


def test_manifest_follows_the_files(spark, tmp_path):
    path = str(tmp_path / "days")
    _late(spark, path)

    def last():
        return {r[S.TX_DATE]: (r.n_rows, r.last_id, r.last_time) for r in sinks.day_manifest(spark, path)}
    assert len(last()) == 9 and last()["2024-01-07"] == (2, 100, D(2024, 1, 7, 12))
    assert sinks._versions(spark, path) == [1]
    # a day that another writer adds, one that it rewrites, and one that goes
    other = tx_frame(spark, [(200, D(2024, 1, 20, 1, 2, 3), 1, 1, 1, 0), (201, D(2024, 1, 7, 1), 1, 1, 1, 0)])
    other.withColumn(S.TX_DATE, F.date_format(S.TX_DATETIME, "yyyy-MM-dd")).write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy(S.TX_DATE).parquet(path)
    shutil.rmtree(f"{path}/{S.TX_DATE}=2024-01-02")
    found = last()
    assert found["2024-01-07"] == (1, 201, D(2024, 1, 7, 1)) and found["2024-01-20"] == (1, 200, D(2024, 1, 20, 1, 2, 3))
    assert "2024-01-02" not in found and len(found) == 9
    sinks.write_manifest(spark, path)
    assert sinks._versions(spark, path) == [2] and last() == found


def test_manifest_of_known_days_reads_no_rows(spark, tmp_path):
    path = str(tmp_path / "days")
    _late(spark, path)
    for day in sinks.partition_values(spark, path):  # same names and sizes, unreadable content
        for f in glob.glob(f"{path}/{S.TX_DATE}={day}/part-*"):
            size = os.path.getsize(f)
            with open(f, "wb") as out:
                out.write(b"x" * size)
    assert max(r.last_id for r in sinks.day_manifest(spark, path)) == 100


def test_the_stage_before_a_daily_write_runs_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def watch(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    tx = src.transactions(spark, SF01)
    sinks.write_daily(tx.mapInArrow(watch, tx.schema), str(tmp_path / "once"))
    assert seen.value == 10_000


def test_a_large_day_is_written_by_several_tasks(spark, tmp_path):
    one_day = src.transactions(spark, SF01).withColumn(S.TX_DATETIME, F.to_timestamp_ntz(F.lit("2024-01-01 05:00:00"))).repartition(8)
    kept = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        sinks.write_daily(one_day, str(tmp_path / "large"))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", kept)
    back = spark.read.parquet(str(tmp_path / "large"))
    assert back.count() == 10_000 and len(back.inputFiles()) > 2
