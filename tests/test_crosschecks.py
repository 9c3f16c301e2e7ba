"""Procedural restatements (pandas / plain Python) of W2 and L3 against the set forms."""

import datetime as dt
import hashlib

import pandas as pd
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import SF01, tx_frame
from incident_rule import incidents_by_rule
from txrisk import schema as S
from txrisk.operators import features as feat
from txrisk.operators import labels as lab
from txrisk.sources import transactions as src


def test_half_open_equals_pandas_rolling_on_tied_orders(spark):
    o = src.table(spark, SF01, "orders").select(
        F.col("o_orderkey").alias(S.TX_ID), F.col("o_custkey").alias(S.CUSTOMER_ID),
        F.col("o_orderdate").alias(S.TX_DATETIME), F.col("o_totalprice").alias(S.TX_AMOUNT))
    got = feat.customer_spending(o, windows=(1, 30), bounds="half_open").toPandas().set_index(S.TX_ID)
    pdf = o.toPandas().sort_values([S.TX_DATETIME, S.TX_ID])
    for w in (1, 30):
        def roll(g):
            g = g.set_index(S.TX_DATETIME)
            r = g[S.TX_AMOUNT].rolling(f"{w}d")
            return pd.DataFrame({"n": r.count().to_numpy(), "s": r.sum().to_numpy()}, index=g[S.TX_ID].to_numpy())
        want = pd.concat([roll(g) for _, g in pdf.groupby(S.CUSTOMER_ID, sort=False)])
        j = got.join(want)
        assert (j[S.customer_nb_tx(w)] == j["n"]).all()
        assert ((j[S.customer_avg_amount(w)] - j["s"] / j["n"]).abs() <= 1e-6 * j["s"].abs()).all()


def _md5_key(*parts):
    return int(hashlib.md5(":".join(str(p) for p in parts).encode()).hexdigest()[:8], 16)


def test_customer_incidents_equal_day_loop(spark):
    tx = src.transactions(spark, SF01)
    inc = incidents_by_rule(tx)
    got = {r[S.TX_ID]: r["n_hits"] for r in lab.customer_hits(tx, inc).collect()}
    pdf = tx.select(S.TX_ID, S.CUSTOMER_ID, S.TX_TIME_DAYS).toPandas()
    cust = inc.where("kind = 'customer'").toPandas()
    hits = {}
    for day in range(int(pdf[S.TX_TIME_DAYS].max())):
        members = set(cust[cust.start_day == day].entity_id)
        c = pdf[(pdf[S.TX_TIME_DAYS] >= day) & (pdf[S.TX_TIME_DAYS] < day + 14) & pdf[S.CUSTOMER_ID].isin(members)]
        ids = sorted(c[S.TX_ID], key=lambda i: (_md5_key(day, i), i))
        for i in ids[: len(ids) // 3]:
            hits[i] = hits.get(i, 0) + 1
    assert got == hits


times = st.lists(st.tuples(st.integers(0, 3), st.integers(0, 4), st.integers(0, 2)), min_size=1, max_size=12)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(times)
def test_window_frames_match_brute_force(spark, rows):
    """Random tied times (day, hour, customer): closed / half-open counts against brute force."""
    base = dt.datetime(2024, 1, 1)
    data = [(i, base + dt.timedelta(days=d, hours=12 * h), c, 0, float(i + 1), 0) for i, (d, h, c) in enumerate(rows)]
    df = tx_frame(spark, data)
    closed = {r[S.TX_ID]: r[S.customer_nb_tx(1)] for r in feat.customer_spending(df, (1,), "closed").collect()}
    half = {r[S.TX_ID]: r[S.customer_nb_tx(1)] for r in feat.customer_spending(df, (1,), "half_open").collect()}
    for i, t, c, *_ in data:
        peers = [(j, u) for j, u, cc, *_ in data if cc == c]
        want_closed = sum(1 for j, u in peers if t - dt.timedelta(days=1) <= u <= t)
        want_half = sum(1 for j, u in peers if t - dt.timedelta(days=1) < u < t or (u == t and j <= i))
        assert closed[i] == want_closed and half[i] == want_half
