"""Message-stream scoring (T-1 ... T-5, S4, S9, S10).

raw-data messages (key, value) -> decode (dead letters aside) -> calendar
flags -> join the latest customer and terminal snapshots -> forest ->
prediction messages (key, JSON value).

Each micro-batch runs in ``foreachBatch``: the snapshots are re-read from the
processed table for every batch, so a nightly feature refresh is picked up
without restarting the query. A batch goes through two marks: its outputs are
written to folders of its own and it is marked *prepared*; its predictions are
published and it is marked *done*. A batch that the stream replays after a failure
starts where its marks end: without one it is computed anew over what it left
behind, from *prepared* on what was written is published, unchanged even if
snapshots have been refreshed since, and a *done* batch is skipped. Readers see
batches from *prepared* on (``read_output``). Offsets live in the checkpoint location (the consumer-group
equivalent). ``availableNow`` processes what is there and stops (the bounded
batch of messages); ``maxFilesPerTrigger`` / ``maxOffsetsPerTrigger`` bound a
micro-batch.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import schema as S
from ..functions import messages as M
from ..operators import snapshot as snap
from ..operators.model import probability_of_one

MESSAGE_SCHEMA = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType())])
PREDICTION_FIELDS = [S.TX_ID, S.TX_DATETIME, S.CUSTOMER_ID, S.TERMINAL_ID, "prediction", "probability"]


def file_message_stream(spark: SparkSession, path: str, fmt: str = "json",
                        max_files_per_trigger: int | None = None) -> DataFrame:
    """S4 for tests and file drops: (key, value) records from a folder."""
    r = spark.readStream.schema(MESSAGE_SCHEMA).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def kafka_message_stream(spark: SparkSession, servers: str, topic: str, starting: str = "earliest",
                         max_offsets_per_trigger: int | None = None, **options) -> DataFrame:
    """Kafka source (needs the spark-sql-kafka package on the classpath)."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("startingOffsets", starting))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    for k, v in options.items():
        r = r.option(k, v)
    return r.load().select(F.col("key").cast("string"), F.col("value").cast("string"),
                           "topic", "partition", "offset")


def score_batch(messages: DataFrame, processed: DataFrame, model: PipelineModel,
                scope: str = "latest_day") -> tuple[DataFrame, DataFrame, DataFrame]:
    """T-2 + T-3 on one (static) batch: (predictions, rejected requests, dead letters)."""
    return score_decoded(M.decode_raw_messages(messages), snap.customer_snapshot(processed, scope),
                         snap.terminal_snapshot(processed, scope), model)


def score_decoded(decoded: DataFrame, cust: DataFrame, term: DataFrame,
                  model: PipelineModel) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``score_batch`` from decoded messages and both snapshots."""
    good, dead = M.split_dead_letters(decoded)
    requests = good.select(*S.MESSAGE_FIELDS)
    enriched = snap.enrich(requests, cust, term, how="inner")
    scored = model.transform(enriched.withColumn(S.TX_FRAUD, F.col(S.TX_FRAUD).cast("double")))
    out = scored.withColumn("probability", probability_of_one("probability")).withColumn(
        "prediction", F.col("prediction").cast("int"))
    return out.select(*PREDICTION_FIELDS), snap.rejected(requests, cust, term), dead.select("key", "value")


BATCHES = "batches"
BATCH_SCHEMA = T.StructType([T.StructField(c, T.LongType()) for c in ("batch", "predictions", "rejected", "dead")])
OUTPUTS = ("predictions", "rejected", "dead")


def _mark_path(spark: SparkSession, out_path: str, batch_id: int, mark: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{out_path}/{BATCHES}/{mark}/batch={batch_id}.json")
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _marked(spark: SparkSession, out_path: str, batch_id: int, mark: str) -> bool:
    fs, p = _mark_path(spark, out_path, batch_id, mark)
    return fs.exists(p)


def _mark(spark: SparkSession, out_path: str, batch_id: int, mark: str, content: str) -> None:
    """A mark appears whole: written under a hidden name, then renamed."""
    fs, p = _mark_path(spark, out_path, batch_id, mark)
    fs.mkdirs(p.getParent())
    hidden = spark._jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}")
    out = fs.create(hidden, True)
    out.write(bytearray(content.encode()))
    out.close()
    if not fs.rename(hidden, p):
        raise IOError(f"could not mark batch {batch_id} as {mark}")


def batch_log(spark: SparkSession, out_path: str) -> DataFrame:
    """T-4: (batch, rows of each output, published) of every batch whose outputs are whole."""
    def read(mark):
        fs, p = _mark_path(spark, out_path, 0, mark)
        folder = f"{out_path}/{BATCHES}/{mark}"
        return spark.read.schema(BATCH_SCHEMA).json(folder) if fs.exists(p.getParent()) else spark.createDataFrame([], BATCH_SCHEMA)
    done = read("done").select("batch", F.lit(True).alias("published"))
    return read("prepared").join(done, "batch", "left").withColumn("published", F.coalesce("published", F.lit(False)))


def read_output(spark: SparkSession, out_path: str, name: str = "predictions") -> DataFrame:
    """(key, value) rows of the batches whose outputs are whole; what a failed batch left behind is not seen."""
    schema = T.StructType(MESSAGE_SCHEMA.fields + [T.StructField("batch", T.LongType())])
    rows = spark.read.schema(schema).parquet(f"{out_path}/{name}")
    return rows.join(batch_log(spark, out_path).select("batch"), "batch", "left_semi").select(*MESSAGE_SCHEMA.names)


def kafka_writer(servers: str, topic: str, **options) -> Callable[[DataFrame, int], None]:
    """Publishes (key, value) rows to a topic (needs the spark-sql-kafka package).

    A batch is sent once unless the driver dies between the end of its sending and
    its *done* mark: a topic cannot take part in the mark, so then it is sent again,
    with the same keys and values.
    """
    def publish(msgs: DataFrame, batch_id: int) -> None:
        w = msgs.select("key", "value").write.format("kafka").option("kafka.bootstrap.servers", servers)
        for k, v in options.items():
            w = w.option(k, v)
        w.option("topic", topic).save()
    return publish


def start_scoring(stream: DataFrame, load_processed: Callable[[], DataFrame], model: PipelineModel,
                  out_path: str, checkpoint: str, available_now: bool = True,
                  processing_time: str | None = None,
                  publish: Callable[[DataFrame, int], None] | None = None):
    """T-1 ... T-5: run the scoring stream; prediction messages land under ``out_path``.

    ``out_path/predictions`` holds (key, value) prediction messages (S9 payload),
    ``out_path/rejected`` the requests without snapshots, ``out_path/dead`` bad bodies, ``out_path/batches``
    the marks of each batch. ``publish`` (see
    ``kafka_writer``) also gets each batch's prediction messages, as they were written.
    """
    def prepare(batch: DataFrame, batch_id: int) -> None:
        spark, processed = batch.sparkSession, load_processed()
        # Three outputs read these: decoded messages and one row for each key.
        shared = [M.decode_raw_messages(batch).persist(), snap.customer_snapshot(processed).persist(),
                  snap.terminal_snapshot(processed).persist()]
        try:
            pred, rej, dead = score_decoded(*shared, model)
            counts = {"batch": batch_id}
            for name, df in zip(OUTPUTS, (M.encode_predictions(pred, PREDICTION_FIELDS), rej, dead)):
                folder = f"{out_path}/{name}/batch={batch_id}"
                df.write.mode("overwrite").parquet(folder)
                counts[name] = spark.read.schema(df.schema).parquet(folder).count()
            _mark(spark, out_path, batch_id, "prepared", json.dumps(counts))
        finally:
            for df in shared:
                df.unpersist()

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if _marked(spark, out_path, batch_id, "done"):
            return
        if not _marked(spark, out_path, batch_id, "prepared"):
            prepare(batch, batch_id)
        if publish is not None:
            publish(spark.read.schema(MESSAGE_SCHEMA).parquet(f"{out_path}/predictions/batch={batch_id}"), batch_id)
        _mark(spark, out_path, batch_id, "done", json.dumps({"batch": batch_id}))

    w = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "10 seconds")
    return w.start()


def topic_audit(records: DataFrame) -> DataFrame:
    """Messages per (topic, partition) with their offset range."""
    return (records.groupBy("topic", "partition")
            .agg(F.count(F.lit(1)).alias("n_messages"), F.min("offset").alias("min_offset"),
                 F.max("offset").alias("max_offset")))
