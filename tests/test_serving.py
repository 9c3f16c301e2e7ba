import datetime as dt

from pyspark.sql import functions as F

from conftest import tx_frame
from txrisk import schema as S
from txrisk.functions import messages as M
from txrisk.operators import features as feat
from txrisk.operators import ids
from txrisk.operators import snapshot as snap

D = dt.datetime


def test_latest_day_scope_and_keep_last(spark):
    rows = [(1, D(2024, 1, 1, 10), 1, 5, 10, 0),       # customer 1 only yesterday
            (2, D(2024, 1, 2, 9), 2, 5, 20, 0),
            (3, D(2024, 1, 2, 11), 2, 5, 40, 0)]       # later row of customer 2 in the latest day
    processed = feat.feature_table(tx_frame(spark, rows), lookback_days=None)
    latest = {r[S.CUSTOMER_ID]: r for r in snap.customer_snapshot(processed).collect()}
    assert set(latest) == {2}
    assert latest[2][S.customer_nb_tx(1)] == 2 and latest[2][S.customer_avg_amount(1)] == 30.0
    assert {r[S.CUSTOMER_ID] for r in snap.customer_snapshot(processed, "all").collect()} == {1, 2}
    req = tx_frame(spark, [(9, D(2024, 1, 3), 1, 5, 1, 0), (10, D(2024, 1, 3), 2, 5, 1, 0)]).select(*S.MESSAGE_FIELDS)
    cust, term = snap.customer_snapshot(processed), snap.terminal_snapshot(processed)
    assert [r[S.TX_ID] for r in snap.enrich(req, cust, term).collect()] == [10]
    rej = snap.rejected(req, cust, term).collect()
    assert [(r[S.TX_ID], r.reason) for r in rej] == [(9, "customer")]
    all_scope = snap.enrich(req, snap.customer_snapshot(processed, "all"), term)
    assert sorted(r[S.TX_ID] for r in all_scope.collect()) == [9, 10]


def test_message_text_and_dead_letters(spark):
    body = "{'TRANSACTION_ID': 5, 'TX_DATETIME': Timestamp('2022-10-18 01:02:03'), 'CUSTOMER_ID': 7, 'TX_AMOUNT': 3.5}"
    msgs = spark.createDataFrame([("5", '"' + body + '"'), ("6", '"' + body[:30])], "key string, value string")
    good, dead = M.split_dead_letters(M.decode_raw_messages(msgs))
    g = good.collect()
    assert len(g) == 1 and g[0][S.TX_ID] == 5 and g[0][S.CUSTOMER_ID] == 7 and g[0][S.TX_AMOUNT] == 3.5
    assert g[0][S.TX_DATETIME] == D(2022, 10, 18, 1, 2, 3)
    assert [r.key for r in dead.collect()] == ["6"]


def test_raw_message_round_trip(spark):
    rows = [(i, D(2024, 1, 1, 0, 0, i), i, i % 3, 1.25 * i, 0) for i in range(20)]
    tx = tx_frame(spark, rows).select(*S.MESSAGE_FIELDS)
    good, dead = M.split_dead_letters(M.decode_raw_messages(M.encode_raw_messages(tx)))
    assert dead.count() == 0
    assert sorted(good.select(*S.MESSAGE_FIELDS).collect()) == sorted(tx.collect())


def test_rebase_fixture(spark):
    hist = spark.createDataFrame([(9, D(2024, 1, 4, 23, 59, 50), 345590, 3)],
                                 f"{S.TX_ID} long, {S.TX_DATETIME} timestamp_ntz, {S.TX_TIME_SECONDS} long, {S.TX_TIME_DAYS} long")
    batch = spark.createDataFrame([(0, D(2024, 1, 5, 0, 0, 5), 5, 0), (1, D(2024, 1, 5, 0, 0, 9), 9, 0)], hist.schema)
    out = ids.rebase(batch, hist).orderBy(S.TX_ID).collect()
    assert [(r[S.TX_ID], r[S.TX_TIME_DAYS], r[S.TX_TIME_SECONDS]) for r in out] == [(10, 4, 345605), (11, 4, 345609)]


def test_sequential_ids_contiguous(spark):
    df = spark.range(0, 5000, 1, 7).select(F.col("id"), (F.col("id") * 7919 % 5000).alias("k"))
    out = ids.sequential_ids(df, ["k", "id"]).toPandas().sort_values("SEQ_ID")
    assert list(out.SEQ_ID) == list(range(5000))
    assert list(out.k) == sorted(out.k)
