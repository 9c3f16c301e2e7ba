import datetime as dt
import uuid

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from conftest import tx_frame
from txrisk import schema as S
from txrisk.functions import messages as M
from txrisk.operators import features as feat
from txrisk.operators import model as md
from txrisk.session import scratch_path
from txrisk.streaming import scoring as st


def test_stream_equals_batch(spark):
    D = dt.datetime(2024, 1, 1)
    rows = [(i, D + dt.timedelta(hours=3 * i), i % 7, i % 4, float(10 + (i * 37) % 250), int((i * 37) % 250 > 200))
            for i in range(120)]
    tx = tx_frame(spark, rows)
    processed = feat.feature_table(tx, lookback_days=None)
    model = md.fit(processed, {"numTrees": 3, "maxDepth": 3})
    base = scratch_path(spark, f"test-stream-{uuid.uuid4().hex}")
    M.encode_raw_messages(tx.select(*S.MESSAGE_FIELDS)).repartition(3).write.json(f"{base}/in")
    q = st.start_scoring(st.file_message_stream(spark, f"{base}/in", max_files_per_trigger=1),
                         lambda: processed, model, f"{base}/out", f"{base}/ckpt")
    q.awaitTermination()
    streamed = spark.read.parquet(f"{base}/out/predictions").select("key", "value")
    batch_pred, _rej, _dead = st.score_batch(M.encode_raw_messages(tx.select(*S.MESSAGE_FIELDS)), processed, model)
    batch = M.encode_predictions(batch_pred, st.PREDICTION_FIELDS)
    assert sorted(streamed.collect()) == sorted(batch.collect())
    assert streamed.count() > 0


def test_topic_audit(spark):
    recs = spark.createDataFrame([("p", 0, 5), ("p", 0, 6), ("p", 1, 2)], "topic string, partition int, offset long")
    out = {(r.partition): (r.n_messages, r.min_offset, r.max_offset) for r in st.topic_audit(recs).collect()}
    assert out == {0: (2, 5, 6), 1: (1, 2, 2)}


def test_snapshot_refresh_is_seen_between_batches(spark):
    """The processed table is re-read for every micro-batch: a customer that only
    appears in the refreshed table is rejected in batch 0 and scored in batch 1."""
    D = dt.datetime(2024, 1, 1)
    old = [(i, D + dt.timedelta(hours=i), 1, 1, 10.0 + i, 0) for i in range(5)]
    new = old + [(100, D + dt.timedelta(hours=6), 2, 1, 50.0, 0)]
    base = scratch_path(spark, f"test-refresh-{uuid.uuid4().hex}")
    processed_old = feat.feature_table(tx_frame(spark, old), lookback_days=None)
    processed_new = feat.feature_table(tx_frame(spark, new), lookback_days=None)
    model = md.fit(processed_new, {"numTrees": 2, "maxDepth": 2})
    req = tx_frame(spark, [(200, D + dt.timedelta(days=1), 2, 1, 5.0, 0)]).select(*S.MESSAGE_FIELDS)
    msgs = M.encode_raw_messages(req)
    msgs.coalesce(1).write.json(f"{base}/in/a")
    msgs.withColumn("key", F.lit("201")).coalesce(1).write.json(f"{base}/in/b")
    calls = []

    def load():
        calls.append(1)
        return processed_old if len(calls) == 1 else processed_new

    stream = (spark.readStream.schema(st.MESSAGE_SCHEMA).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").json(f"{base}/in"))
    q = st.start_scoring(stream, load, model, f"{base}/out", f"{base}/ckpt")
    q.awaitTermination()
    rejected = spark.read.parquet(f"{base}/out/rejected").count()
    scored = spark.read.parquet(f"{base}/out/predictions").count()
    assert len(calls) == 2 and rejected == 1 and scored == 1


def test_bodies_are_parsed_once(spark):
    msgs = spark.createDataFrame([("1", "{'TRANSACTION_ID': 1}")], "key string, value string")
    for df in M.split_dead_letters(M.decode_raw_messages(msgs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("from_json") == 1


def test_json_strings_with_escapes(spark):
    texts = ['a "quoted" \\ backslash', "line\nbreak\ttab", "caf\u00e9 \u4e16", "{'TRANSACTION_ID': 7}", ""]
    df = spark.createDataFrame([(x,) for x in texts], "t string")
    assert [r[0] for r in df.select(M.unwrap_body(M.json_string(F.col("t")))).collect()] == texts
    escaped = spark.createDataFrame([('"{\'TRANSACTION_ID\': \\u0037}"',), ('"{\'TRANSACTION_ID\': 7',), (None,)],
                                    "value string").withColumn("key", F.lit("7"))
    good, dead = M.split_dead_letters(M.decode_raw_messages(escaped))
    assert [r[S.TX_ID] for r in good.collect()] == [7] and dead.count() == 2


def test_topic_writer_options():
    class Recorder:
        def __init__(self):
            self.calls = []

        def __getattr__(self, name):
            if name == "write":
                return self

            def call(*args):
                self.calls.append((name, *args))
                return self
            return call

    rows = Recorder()
    st.kafka_writer("host:1", "predictions", **{"kafka.acks": "all"})(rows, 0)
    assert rows.calls == [("select", "key", "value"), ("format", "kafka"),
                          ("option", "kafka.bootstrap.servers", "host:1"), ("option", "kafka.acks", "all"),
                          ("option", "topic", "predictions"), ("save",)]


def test_published_messages_are_the_written_ones(spark):
    D = dt.datetime(2024, 1, 1)
    tx = tx_frame(spark, [(i, D + dt.timedelta(hours=i), i % 3, i % 2, 10.0 + i, i % 2) for i in range(12)])
    processed = feat.feature_table(tx, lookback_days=None)
    model = md.fit(processed, {"numTrees": 2, "maxDepth": 2})
    base = scratch_path(spark, f"test-publish-{uuid.uuid4().hex}")
    M.encode_raw_messages(tx.select(*S.MESSAGE_FIELDS)).coalesce(1).write.json(f"{base}/in")
    sent = []
    st.start_scoring(st.file_message_stream(spark, f"{base}/in"), lambda: processed, model, f"{base}/out",
                     f"{base}/ckpt", publish=lambda df, i: sent.extend(df.collect())).awaitTermination()
    assert len(sent) == 12
    assert sorted(sent) == sorted(spark.read.parquet(f"{base}/out/predictions").select("key", "value").collect())


class _Failing:
    """A publisher that keeps what it is given and fails half-way through chosen batches, once each."""

    def __init__(self, fail):
        self.fail, self.sent, self.calls = set(fail), [], []

    def __call__(self, msgs, batch_id):
        rows = msgs.collect()
        self.calls.append(batch_id)
        if batch_id in self.fail:
            self.fail.remove(batch_id)
            raise RuntimeError("the topic is gone")
        self.sent += [(batch_id, r.key, r.value) for r in rows]


def test_a_failed_batch_is_published_once_and_unchanged_after_a_restart(spark):
    D = dt.datetime(2024, 1, 1)
    tx = tx_frame(spark, [(i, D + dt.timedelta(hours=i), i % 3, i % 2, 10.0 + i, i % 2) for i in range(12)])
    processed = feat.feature_table(tx, lookback_days=None)
    model = md.fit(processed, {"numTrees": 2, "maxDepth": 2})
    base = scratch_path(spark, f"test-restart-{uuid.uuid4().hex}")
    for part in range(3):
        M.encode_raw_messages(tx.where(F.col(S.TX_ID) % 3 == part).select(*S.MESSAGE_FIELDS)).coalesce(1) \
            .write.mode("append").json(f"{base}/in")
    loads = []

    def load():
        loads.append(1)
        return processed if len(loads) < 3 else processed.withColumn(S.customer_avg_amount(1), F.lit(1e6))

    def run(publish):
        q = st.start_scoring(st.file_message_stream(spark, f"{base}/in", max_files_per_trigger=1), load, model,
                             f"{base}/out", f"{base}/ckpt", publish=publish)
        q.awaitTermination()

    publish = _Failing({1})
    with pytest.raises(StreamingQueryException):
        run(publish)
    log = {r.batch: (r.predictions, r.published) for r in st.batch_log(spark, f"{base}/out").collect()}
    assert log == {0: (4, True), 1: (4, False)}
    before = sorted(tuple(r) for r in spark.read.parquet(f"{base}/out/predictions/batch=1").collect())
    run(publish)
    assert publish.calls == [0, 1, 1, 2] and len(loads) == 3, "batch 1 is published again, not scored again"
    assert sorted(r[1:] for r in publish.sent if r[0] == 1) == before
    assert sorted(int(r[1]) for r in publish.sent) == list(range(12))
    assert {r.batch: r.published for r in st.batch_log(spark, f"{base}/out").collect()} == {0: True, 1: True, 2: True}
    assert sorted(tuple(r) for r in st.read_output(spark, f"{base}/out").collect()) == sorted(r[1:] for r in publish.sent)


def test_a_batch_that_fails_while_it_is_written_is_not_seen_and_written_anew(spark):
    D = dt.datetime(2024, 1, 1)
    tx = tx_frame(spark, [(i, D + dt.timedelta(hours=i), i % 3, i % 2, 10.0 + i, i % 2) for i in range(8)])
    processed = feat.feature_table(tx, lookback_days=None)
    model = md.fit(processed, {"numTrees": 2, "maxDepth": 2})
    base = scratch_path(spark, f"test-half-{uuid.uuid4().hex}")
    M.encode_raw_messages(tx.select(*S.MESSAGE_FIELDS)).coalesce(1).write.json(f"{base}/in")
    # half-written: predictions are there, the other outputs and the mark are not
    spark.createDataFrame([("9", "left behind")], st.MESSAGE_SCHEMA).write.parquet(f"{base}/out/predictions/batch=0")
    assert st.read_output(spark, f"{base}/out").collect() == []
    publish = _Failing(())
    for _ in range(2):  # the second run finds nothing new
        st.start_scoring(st.file_message_stream(spark, f"{base}/in"), lambda: processed, model, f"{base}/out", f"{base}/ckpt",
                         publish=publish).awaitTermination()
    assert publish.calls == [0] and sorted(int(r[1]) for r in publish.sent) == list(range(8))
    assert st.read_output(spark, f"{base}/out").where("value = 'left behind'").count() == 0


def test_a_batch_marked_done_is_skipped(spark):
    D = dt.datetime(2024, 1, 1)
    tx = tx_frame(spark, [(i, D + dt.timedelta(hours=i), 1, 1, 10.0 + i, i % 2) for i in range(4)])
    processed = feat.feature_table(tx, lookback_days=None)
    model = md.fit(processed, {"numTrees": 2, "maxDepth": 2})
    base = scratch_path(spark, f"test-done-{uuid.uuid4().hex}")
    M.encode_raw_messages(tx.select(*S.MESSAGE_FIELDS)).coalesce(1).write.json(f"{base}/in")
    publish = _Failing(())
    for checkpoint in ("a", "b"):  # offsets lost: the stream replays batch 0
        st.start_scoring(st.file_message_stream(spark, f"{base}/in"), lambda: processed, model, f"{base}/out",
                         f"{base}/{checkpoint}", publish=publish).awaitTermination()
    assert publish.calls == [0] and len(publish.sent) == 4
