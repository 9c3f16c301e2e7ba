import datetime as dt

from pyspark.sql import functions as F

from conftest import SF01, tx_frame
from txrisk import schema as S
from txrisk.operators import features as feat
from txrisk.sources import transactions as src

D = dt.datetime


def _by_id(df, col):
    return [r[col] for r in df.orderBy(S.TX_ID).collect()]


def test_ties_closed_and_half_open(spark):
    rows = [(1, D(2024, 1, 1), 7, 1, 10, 0), (2, D(2024, 1, 2), 7, 1, 20, 0),
            (3, D(2024, 1, 2), 7, 1, 30, 0), (4, D(2024, 1, 3, 0, 0, 1), 7, 1, 40, 0)]
    df = tx_frame(spark, rows)
    closed = feat.customer_spending(df, windows=(1,), bounds="closed")
    half = feat.customer_spending(df, windows=(1,), bounds="half_open")
    assert _by_id(closed, S.customer_nb_tx(1)) == [1, 3, 3, 1]
    assert _by_id(half, S.customer_nb_tx(1)) == [1, 1, 2, 1]
    assert _by_id(half, S.customer_avg_amount(1)) == [10.0, 20.0, 25.0, 40.0]


def test_delay_edge(spark):
    t = D(2024, 1, 20)
    day, sec = dt.timedelta(days=1), dt.timedelta(seconds=1)
    rows = [(10, t, 1, 5, 1, 0), (1, t - 7 * day, 1, 5, 1, 1), (2, t - 7 * day - sec, 1, 5, 1, 0),
            (3, t - 8 * day, 1, 5, 1, 0), (4, t - 8 * day - sec, 1, 5, 1, 0)]
    df = tx_frame(spark, rows)
    closed = feat.terminal_risk(df, 7, (1,), "closed").where(F.col(S.TX_ID) == 10).first()
    half = feat.terminal_risk(df, 7, (1,), "half_open").where(F.col(S.TX_ID) == 10).first()
    assert closed[S.terminal_nb_tx(1)] == 2 and closed[S.terminal_risk(1)] == 0.0
    assert half[S.terminal_nb_tx(1)] == 2 and half[S.terminal_risk(1)] == 0.5


def test_empty_risk_window(spark):
    df = tx_frame(spark, [(1, D(2024, 1, 5), 1, 9, 5, 1)])
    r = feat.terminal_risk(df).first()
    for w in S.WINDOWS:
        assert r[S.terminal_nb_tx(w)] == 0 and r[S.terminal_risk(w)] == 0.0


def test_night_and_weekend_flags(spark):
    night = [D(2024, 1, 1, 0), D(2024, 1, 1, 5), D(2024, 1, 1, 6, 59, 59), D(2024, 1, 1, 7), D(2024, 1, 1, 23)]
    df = tx_frame(spark, [(i, t, 1, 1, 1, 0) for i, t in enumerate(night)])
    assert _by_id(feat.add_calendar_flags(df), "TX_DURING_NIGHT") == [1, 1, 1, 0, 0]
    days = [D(2024, 1, 5), D(2024, 1, 6), D(2024, 1, 7), D(2024, 1, 8)]  # Fri Sat Sun Mon
    df = tx_frame(spark, [(i, t, 1, 1, 1, 0) for i, t in enumerate(days)])
    assert _by_id(feat.add_calendar_flags(df), "TX_DURING_WEEKEND") == [0, 1, 1, 0]


def test_minus_one_and_nulls(spark):
    df = spark.createDataFrame([(1, -1.0, -1), (2, 0.0, 0), (3, None, None)], "id long, a double, b int")
    out = feat.fill_numeric_nulls(src.replace_minus_one(df, ["a", "b"])).orderBy("id").collect()
    assert [(r.a, r.b) for r in out] == [(0.0, 0), (0.0, 0), (0.0, 0)]


def test_reference_check_values_sf001(spark):
    ft = feat.feature_table(src.transactions(spark, SF01), lookback_days=90)
    s = ft.agg(F.sum(S.customer_nb_tx(1)).alias("c1"), F.sum(S.terminal_nb_tx(1)).alias("t1"),
               F.sum(S.terminal_nb_tx(7)).alias("t7"), F.sum("TX_DURING_WEEKEND").alias("we"),
               F.sum("TX_DURING_NIGHT").alias("ni"), F.count("*").alias("n")).first()
    assert (s.c1, s.t1, s.t7, s.we, s.ni, s.n) == (31982, 24886, 151807, 2629, 2913, 10000)


def test_window_properties(spark):
    ft = feat.feature_table(src.transactions(spark, SF01), lookback_days=90)
    bad = ft.where((F.col(S.customer_nb_tx(1)) > F.col(S.customer_nb_tx(7)))
                   | (F.col(S.customer_nb_tx(7)) > F.col(S.customer_nb_tx(30)))
                   | (F.col(S.terminal_risk(30)) < 0) | (F.col(S.terminal_risk(30)) > 1))
    assert bad.count() == 0


def _scans(df) -> list[str]:
    import re
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Location: \w+\s*\(\d+ paths?\)\[file:([^\s,\]]+)", plan)


def test_input_is_written_once_and_read_no_more(spark):
    """The final plan reads scratch tables alone, with no window, sort or shuffle of its rows."""
    ft = feat.feature_table(src.transactions(spark, SF01), lookback_days=None)
    plan = ft._jdf.queryExecution().executedPlan().toString()
    assert _scans(ft) and not any("events.parquet" in s for s in _scans(ft))
    assert "SortMergeJoin" not in plan and "rangepartitioning" not in plan


def test_scan_prunes_columns(spark):
    df = feat.customer_spending(src.transactions(spark, SF01)).select(S.TX_ID, S.customer_nb_tx(1))
    schema = df._jdf.queryExecution().executedPlan().toString()
    assert "_row:struct<TRANSACTION_ID:bigint>" in schema and "_frauds" not in schema


def _sliding(df, bounds):
    """Both families by Spark's sliding RANGE frames (quadratic; for comparison only)."""
    from pyspark.sql import Window
    sec = F.unix_timestamp(S.TX_DATETIME)
    day = 86400
    out = [S.TX_ID]
    for w in S.WINDOWS:
        frame = Window.partitionBy(S.CUSTOMER_ID).orderBy(sec).rangeBetween(-w * day, 0)
        out += [F.count(F.lit(1)).over(frame).alias(S.customer_nb_tx(w)),
                F.avg(S.TX_AMOUNT).over(frame).alias(S.customer_avg_amount(w))]
        lo = -(7 + w) * day + (bounds == "half_open")
        hi = -7 * day - (bounds == "closed")
        frame = Window.partitionBy(S.TERMINAL_ID).orderBy(sec).rangeBetween(lo, hi)
        n = F.count(S.TX_FRAUD).over(frame)
        out += [n.alias(S.terminal_nb_tx(w)),
                F.coalesce(F.try_divide(F.sum(S.TX_FRAUD).over(frame).cast("double"), n), F.lit(0.0))
                .alias(S.terminal_risk(w))]
    return df.select(*out)


def test_hot_keys_equal_sliding_frames(spark):
    # one terminal and one customer hold a third of all rows
    tx = src.transactions(spark, SF01)
    hot = tx.withColumn(S.TERMINAL_ID, F.when(F.col(S.TX_ID) % 3 == 0, F.lit(7)).otherwise(F.col(S.TERMINAL_ID))) \
        .withColumn(S.CUSTOMER_ID, F.when(F.col(S.TX_ID) % 3 == 1, F.lit(5)).otherwise(F.col(S.CUSTOMER_ID)))
    assert _differing(feat.feature_table(hot, lookback_days=None), _sliding(hot, "closed")) == (10000, 0)
    half = feat.terminal_risk(hot, bounds="half_open")
    want = _sliding(hot, "half_open")
    assert _differing(half, want.select(*[c for c in want.columns if c in half.columns])) == (10000, 0)


def _differing(got, want):
    """(joined rows, rows that differ; means and risks by more than float summation does)."""
    j = got.alias("a").join(want.alias("b"), S.TX_ID)
    bad = F.lit(False)
    for c in want.columns[1:]:
        a, b = F.col(f"a.{c}"), F.col(f"b.{c}")
        close = F.abs(a - b) <= 1e-9 * (F.abs(b) + 1) if ("_AVG_" in c or "_RISK_" in c) else a == b
        bad = bad | ~F.coalesce(close, a.eqNullSafe(b))
    return j.count(), j.where(bad).count()


def test_null_keys_and_times_keep_their_rows(spark):
    rows = [(1, dt.datetime(2024, 1, 1), None, 1, 5.0, 0), (2, dt.datetime(2024, 1, 1, 1), None, None, 7.0, 1),
            (3, dt.datetime(2024, 1, 2), 9, None, 1.5, 0)]
    df = tx_frame(spark, rows)
    df = df.union(df.limit(1).withColumn(S.TX_ID, F.lit(4)).withColumn(S.TX_DATETIME, F.lit(None).cast("timestamp_ntz")))
    for bounds in feat.BOUNDS:
        got = {r[S.TX_ID]: r for r in feat.feature_table(df, lookback_days=None, bounds=bounds).collect()}
        assert sorted(got) == [1, 2, 3, 4]
        assert got[2][S.customer_nb_tx(1)] == 2 and got[2][S.customer_avg_amount(1)] == 6.0
        assert got[3][S.customer_nb_tx(1)] == 1
        assert got[4][S.customer_nb_tx(30)] == 0 and got[4][S.terminal_risk(30)] == 0.0


def test_running_sums_leave_no_residue(spark):
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(days=2 * i), 1, 1, 0.1 * 3 ** (i % 9), 0) for i in range(40)]
    got = feat.customer_spending(tx_frame(spark, rows), windows=(1,)).select(S.TX_AMOUNT, S.customer_avg_amount(1)).collect()
    assert all(abs(a - b) < 1e-8 for a, b in got)
