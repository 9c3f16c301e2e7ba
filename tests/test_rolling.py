"""The two-level prefix scan and exact sums: hot keys, days and seconds, the whole range of doubles."""

import datetime as dt
import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from conftest import SF01, tx_frame
from txrisk import schema as S
from txrisk.operators import features as feat
from txrisk.operators import rolling
from txrisk.sources import transactions as src

T0 = dt.datetime(2024, 1, 1)


def _brute(rows, w, bounds):
    """{id: (count, exact total, known)} of each row's frame; rows: (id, second, key, amount)."""
    out = {}
    for i, t, k, _ in rows:
        frame = [a for j, u, kk, a in rows if kk == k and (
            t - w * 86400 <= u <= t if bounds == "closed" else t - w * 86400 < u < t or (u == t and j <= i))]
        known = [a for a in frame if a is not None]
        out[i] = (len(frame) if bounds == "closed" else len(known), known)
    return out


def _frame(spark, rows):
    df = tx_frame(spark, [(i, T0 + dt.timedelta(seconds=t), k, 0, 0 if a is None else a, 0) for i, t, k, a in rows])
    missing = [i for i, _, _, a in rows if a is None]
    return df.withColumn(S.TX_AMOUNT, F.when(~F.col(S.TX_ID).isin(missing), F.col(S.TX_AMOUNT))) if missing else df


def _mean(known):
    """The mean as a correctly rounded double, with the rules of infinities and NaN."""
    if any(math.isnan(a) for a in known) or {math.inf, -math.inf} <= set(known):
        return math.nan
    if any(math.isinf(a) for a in known):
        return next(a for a in known if math.isinf(a))
    return float(sum(map(Fraction, known)) / len(known))


def _same(got, want):
    if want is None or got is None:
        return want is got
    return (math.isnan(got) and math.isnan(want)) or got == want or abs(got - want) <= 1e-14 * abs(want)


AMOUNTS = {
    "cents": [0.01, 0.1, 19.99, 1234.56, -7.35],
    "past decimals": [2e12, 1e-9, 3e-9, 1.0, 5e11],
    "whole range": [5e-324, 1.5e300, -1.5e300, 1.0, 1e-300, 2.0 ** -1000],
    "odd": [math.nan, 1.0, math.inf, 3.5, -math.inf, None],
    "zeros": [0.0, -0.0],
    "nulls": [None],
}


@pytest.mark.parametrize("bounds", feat.BOUNDS)
@pytest.mark.parametrize("name", AMOUNTS)
def test_means_are_exact(spark, name, bounds):
    rng = random.Random(name)
    rows = [(i, rng.randrange(0, 4 * 86400, 21600), rng.randrange(2), rng.choice(AMOUNTS[name])) for i in range(60)]
    got = {r[S.TX_ID]: r for r in feat.customer_spending(_frame(spark, rows), (1, 2), bounds).collect()}
    for w in (1, 2):
        for i, (n, known) in _brute(rows, w, bounds).items():
            assert got[i][S.customer_nb_tx(w)] == n
            mean = got[i][S.customer_avg_amount(w)]
            assert _same(mean, _mean(known) if known else None), (name, known, mean)


def test_what_leaves_leaves_nothing_behind(spark):
    """A window after NaN, infinity and 1e300 holds only what is in it."""
    rows = [(0, 0, 1, math.nan), (1, 10, 1, math.inf), (2, 20, 1, 1e300), (3, 3 * 86400, 1, 1e-9), (4, 6 * 86400, 1, 0.1)]
    got = {r[S.TX_ID]: r[S.customer_avg_amount(1)] for r in feat.customer_spending(_frame(spark, rows), (1,)).collect()}
    assert got[3] == 1e-9 and got[4] == 0.1


def test_mean_of_large_and_small_amounts(spark):
    rows = [(0, 0, 1, 2e12), (1, 1, 1, 1.0), (2, 2, 2, 1e-9), (3, 3, 2, 3e-9), (4, 4, 3, 1.0), (5, 5, 3, math.inf),
            (6, 6, 4, 1.0), (7, 7, 4, math.nan)]
    got = {r[S.TX_ID]: r[S.customer_avg_amount(1)] for r in feat.customer_spending(_frame(spark, rows), (1,)).collect()}
    assert got[1] == 1000000000000.5 and got[3] == 2e-9 and got[5] == math.inf and math.isnan(got[7])


def test_bands_follow_the_data(spark):
    def bands(*amounts):
        return rolling.ExactSum(spark.createDataFrame([(a,) for a in amounts], "a double"), "a").bands
    assert len(bands(0.01, 10_000.0)) == 4 and len(bands(5e-324, 1.7e308)) == 88
    assert bands(0.0, math.nan) == [] and bands() == []


def _spread(spark, df, key, bounds):
    """How many range partitions the rows of one scan lie in, and its result."""
    seen = []
    keep = rolling.written

    def spy(table, name):
        out = keep(table, name)
        if name == "scan":
            seen.append(out)
        return out
    rolling.written = spy
    try:
        result = feat.customer_spending(df, (1, 7), bounds)
    finally:
        rolling.written = keep
    return seen[0].where("_mark = 0").select("_part").distinct().count(), result


@pytest.mark.parametrize("bounds", feat.BOUNDS)
def test_one_key_on_one_day_lies_in_several_partitions(spark, bounds):
    n = 20_000
    rows = spark.range(n).select(
        F.col("id").alias(S.TX_ID), (F.lit(T0).cast("timestamp_ntz") + F.make_interval(secs=(F.col("id") * 7919) % 86400)).alias(S.TX_DATETIME),
        F.lit(1).cast("long").alias(S.CUSTOMER_ID), (F.col("id") % 97 + 0.25).alias(S.TX_AMOUNT))
    parts, result = _spread(spark, rows, 1, bounds)
    assert parts >= 3  # the others hold what leaves on later days
    got = result.select(S.TX_ID, S.customer_nb_tx(1), S.customer_avg_amount(1)).toPandas().set_index(S.TX_ID)
    pdf = rows.toPandas().sort_values([S.TX_DATETIME, S.TX_ID])
    count, total = range(1, n + 1), pdf[S.TX_AMOUNT].cumsum().to_numpy()
    pdf["n"], pdf["mean"] = count, total / range(1, n + 1)
    if bounds == "closed":
        last = pdf.groupby(S.TX_DATETIME)[["n", "mean"]].transform("last")
        pdf[["n", "mean"]] = last
    j = got.join(pdf.set_index(S.TX_ID)[["n", "mean"]])
    assert (j[S.customer_nb_tx(1)] == j["n"]).all()
    assert ((j[S.customer_avg_amount(1)] - j["mean"]).abs() < 1e-9).all()


@pytest.mark.parametrize("bounds", feat.BOUNDS)
def test_one_second_lies_in_several_partitions(spark, bounds):
    n = 5_000
    rows = spark.range(n).select(F.col("id").alias(S.TX_ID), F.lit(T0).cast("timestamp_ntz").alias(S.TX_DATETIME),
                                 F.lit(None).cast("long").alias(S.CUSTOMER_ID), F.lit(2.5).alias(S.TX_AMOUNT))
    parts, result = _spread(spark, rows, None, bounds)
    assert parts > 1
    counts = sorted(r[0] for r in result.select(S.customer_nb_tx(7)).collect())
    assert counts == ([n] * n if bounds == "closed" else list(range(1, n + 1)))
    assert {r[0] for r in result.select(S.customer_avg_amount(1)).collect()} == {2.5}


def test_hot_keys_equal_brute_force_on_any_number_of_partitions(spark):
    rng = random.Random(11)
    rows = [(i, rng.randrange(0, 9 * 86400, 3600), rng.choice([1, 1, 1, 2, 3, 4, 5, None]), rng.choice([1.5, 0.1, None])) for i in range(300)]
    base = _frame(spark, rows)
    want = {b: _brute(rows, 7, b) for b in feat.BOUNDS}
    for n in (1, 3, 40):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        try:
            for b in feat.BOUNDS:
                got = {r[S.TX_ID]: r[S.customer_nb_tx(7)] for r in feat.customer_spending(base, (7,), b).collect()}
                assert got == {i: x[0] for i, x in want[b].items()}
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", 8)


def test_terminal_risk_of_rows_without_labels_or_times(spark):
    df = tx_frame(spark, [(i, T0 + dt.timedelta(days=i), 1, 1, 1, i % 2) for i in range(12)])
    df = df.withColumn(S.TX_FRAUD, F.when(F.col(S.TX_ID) != 1, F.col(S.TX_FRAUD))) \
        .withColumn(S.TX_DATETIME, F.when(F.col(S.TX_ID) != 3, F.col(S.TX_DATETIME)))
    for b in feat.BOUNDS:
        got = {r[S.TX_ID]: (r[S.terminal_nb_tx(30)], r[S.terminal_risk(30)]) for r in feat.terminal_risk(df, 7, (30,), b).collect()}
        # day 11 sees days 0 to 3 (half-open: and 4), of which 1 has no label and 3 no time
        assert got[11] == ((2, 0.0) if b == "closed" else (3, 0.0)) and got[3] == (0, 0.0)


def test_empty_input(spark):
    empty = src.transactions(spark, SF01).limit(0)
    assert feat.feature_table(empty).collect() == [] and feat.customer_spending(empty, bounds="half_open").collect() == []


def test_scopes_delete_their_own_tables_only(spark):
    import glob
    import os
    import threading

    from txrisk.session import scratch_path, scratch_scope, written

    def folders():
        return {os.path.basename(p) for p in glob.glob(scratch_path(spark, "scope-*").replace("file:", ""))}
    one, two = spark.range(3), spark.range(4)
    other = []

    def elsewhere():
        other.append(written(two, "scope-b"))
    with scratch_scope(spark):
        kept = written(one, "scope-a")
        thread = threading.Thread(target=elsewhere)
        thread.start()
        thread.join()
        assert kept.count() == 3 and len(folders()) == 2
        with scratch_scope(spark):
            written(one, "scope-c")
            assert len(folders()) == 3
        assert len(folders()) == 2
    assert [f[:7] for f in folders()] == ["scope-b"] and other[0].count() == 4
    with pytest.raises(ZeroDivisionError), scratch_scope(spark):
        written(one, "scope-d")
        raise ZeroDivisionError
    assert [f[:7] for f in folders()] == ["scope-b"]
