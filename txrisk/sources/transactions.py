"""Transaction tables: scans, the latest partition, schema alignment, clean-up.

All readers return lazy DataFrames; filters and projections placed on them
reach the Parquet scan (``PushedFilters`` / ``PartitionFilters`` /
``ReadSchema``), so nothing is read that a query does not use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import schema as S
from ..functions import calendar as cal

# Series start of the driver's `events` table; TX_TIME_DAYS / TX_TIME_SECONDS
# count from its midnight.
EVENTS_ORIGIN = "2024-01-01"
# Label rule of scenario 1 (fixed value): amounts above this are frauds.
AMOUNT_THRESHOLD = 220.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table; declared schemas (``schema.INPUT_TABLES``) skip the inference job."""
    reader = spark.read
    if name in S.INPUT_TABLES:
        reader = reader.schema(S.INPUT_TABLES[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events_to_transactions(events: DataFrame, origin: str = EVENTS_ORIGIN,
                           amount_threshold: float = AMOUNT_THRESHOLD) -> DataFrame:
    """Map the generic `events` table onto the raw transaction schema.

    event_id -> TRANSACTION_ID, ts (cut to whole seconds) -> TX_DATETIME,
    user_id -> CUSTOMER_ID, props.k -> TERMINAL_ID, value -> TX_AMOUNT; the
    label is scenario 1 (amount above the threshold).
    """
    ts = cal.truncate_to_second("ts")
    origin_sec = F.unix_timestamp(F.to_timestamp_ntz(F.lit(f"{origin} 00:00:00")))
    fraud = (F.col("value") > F.lit(amount_threshold)).cast("int")
    return events.select(
        F.col("event_id").cast("long").alias(S.TX_ID),
        ts.alias(S.TX_DATETIME),
        F.col("user_id").cast("long").alias(S.CUSTOMER_ID),
        F.get_json_object("props", "$.k").cast("long").alias(S.TERMINAL_ID),
        F.col("value").cast("double").alias(S.TX_AMOUNT),
        (cal.epoch_seconds("ts") - origin_sec).cast("long").alias(S.TX_TIME_SECONDS),
        cal.days_between("ts", origin).alias(S.TX_TIME_DAYS),
        fraud.alias(S.TX_FRAUD),
        fraud.alias(S.TX_FRAUD_SCENARIO),
    )


def transactions(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    """The canonical transaction view over ``events`` of a test-data folder."""
    return events_to_transactions(table(spark, sf_dir, "events"), **kw)


def read_transactions(spark: SparkSession, path: str, fmt: str = "parquet",
                      schema: T.StructType = S.RAW_TRANSACTION, clean: bool = True) -> DataFrame:
    """One multi-file scan of a folder of daily files with a fixed schema.

    Replaces the list-read-concatenate loop; with ``clean`` the -1 markers are
    replaced by 0 (P7). No global sort: row order is not part of a table.
    """
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", "true").option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
    # Partition folders (e.g. TX_DATE=...) add discovered columns; keep the declared ones.
    df = reader.format(fmt).load(path).select(*schema.names)
    return replace_minus_one(df) if clean else df


def align_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast the columns of a reference schema, in its order."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def replace_minus_one(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Value -1 becomes 0 in every numeric column (or the given ones)."""
    numeric = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
    cols = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, numeric)]
    return df.replace(-1, 0, subset=cols) if cols else df


def latest_partition(df: DataFrame, day_col: str = S.TX_TIME_DAYS) -> DataFrame:
    """Rows of the newest day.

    The bound is a scalar subquery, so on a day-partitioned table the filter
    prunes partitions after the (metadata-cheap) max is known.
    """
    newest = df.select(F.max(day_col)).scalar()
    return df.where(F.col(day_col) == newest)


def latest_file(df: DataFrame) -> DataFrame:
    """S2, file-time variant: rows of the most recently modified input file."""
    meta = df.select("*", F.col("_metadata.file_modification_time").alias("_mtime"))
    newest = meta.select(F.max("_mtime")).scalar()
    return meta.where(F.col("_mtime") == newest).drop("_mtime")
