"""Queries over message codecs and partitioned sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import Window, functions as F

from .. import schema as S
from ..functions import messages as M
from ..session import scratch_path
from ..sources import sinks
from ..sources import transactions as src
from ..streaming import scoring
from . import sqlparts as Q
from .registry import query
from .sqlparts import stable_round


@query("parsed_messages", f"""WITH {Q.TX}
SELECT CAST(TRANSACTION_ID AS VARCHAR) AS key, TRANSACTION_ID, TX_DATETIME, CUSTOMER_ID, TERMINAL_ID,
       TX_AMOUNT, TX_TIME_SECONDS, TX_TIME_DAYS FROM tx""")
def parsed_messages(spark, sf_dir):
    """Every transaction encoded as a raw-data message and decoded back."""
    tx = src.transactions(spark, sf_dir)
    good, _dead = M.split_dead_letters(M.decode_raw_messages(M.encode_raw_messages(tx)))
    return good.drop("value")


@query("dead_letters", f"""WITH {Q.TX}
SELECT CAST(TRANSACTION_ID AS VARCHAR) AS key, substr(md5(CAST(TRANSACTION_ID AS VARCHAR)), 1, 1) <> '3' AS has_body
FROM tx WHERE substr(md5(CAST(TRANSACTION_ID AS VARCHAR)), 1, 1) < '6'""")
def dead_letters(spark, sf_dir):
    """Messages whose body does not parse or has no id; six in sixteen have been damaged, each in one of six ways."""
    msgs = M.encode_raw_messages(src.transactions(spark, sf_dir))
    how, body = F.substring(F.md5("key"), 1, 1), F.col("value")
    damaged = (F.when(how == "0", F.substring(body, 1, 40))
               .when(how == "1", M.json_string(F.lit("{'CUSTOMER_ID': 5}")))
               .when(how == "2", F.lit("not a message"))
               .when(how == "3", F.lit(None))
               .when(how == "4", F.lit(""))
               .when(how == "5", M.json_string(F.lit("{'TRANSACTION_ID': 'x', 'CUSTOMER_ID': 5}")))
               .otherwise(body))
    _good, dead = M.split_dead_letters(M.decode_raw_messages(msgs.withColumn("value", damaged)))
    return dead.select("key", F.col("value").isNotNull().alias("has_body"))


@query("topic_audit", f"""WITH {Q.TX}
SELECT 'raw_data' AS topic, CAST(CUSTOMER_ID % 3 AS INTEGER) AS partition, CAST(count(*) AS BIGINT) AS n_messages,
       min(TRANSACTION_ID) AS min_offset, max(TRANSACTION_ID) AS max_offset FROM tx GROUP BY 2""")
def topic_audit(spark, sf_dir):
    """Message counts and offset ranges; customers spread over three partitions, ids as offsets."""
    tx = src.transactions(spark, sf_dir)
    return scoring.topic_audit(tx.select(F.lit("raw_data").alias("topic"),
                                         (F.col(S.CUSTOMER_ID) % 3).cast("int").alias("partition"),
                                         F.col(S.TX_ID).alias("offset")))


@query("aligned_batch", f"WITH {Q.TX} SELECT * EXCLUDE (sec) FROM tx")
def aligned_batch(spark, sf_dir):
    """Columns as text, in reverse order and beside another, brought to the declared schema."""
    tx = src.transactions(spark, sf_dir)
    given = tx.select(F.lit("x").alias("other"), *[F.col(c).cast("string").alias(c) for c in reversed(S.RAW_COLUMNS)])
    return src.align_to(given, S.RAW_TRANSACTION)


@query("message_times", f"""WITH {Q.TX}
SELECT TRANSACTION_ID, TX_DATETIME AS PARSED_TIME FROM tx""")
def message_times(spark, sf_dir):
    """time taken from between the parentheses of Timestamp('..') in the body."""
    tx = src.transactions(spark, sf_dir)
    msgs = M.encode_raw_messages(tx)
    return msgs.select(F.col("key").cast("long").alias(S.TX_ID),
                       M.extract_paren_time("value").alias("PARSED_TIME"))


@query("prediction_messages", f"""WITH {Q.TX}
SELECT CAST(TRANSACTION_ID AS VARCHAR) AS key,
       '{{"TRANSACTION_ID":' || TRANSACTION_ID || ',"TX_DATETIME":"' || strftime(TX_DATETIME, '%Y-%m-%d %H:%M:%S')
       || '","CUSTOMER_ID":' || CUSTOMER_ID || ',"TERMINAL_ID":' || TERMINAL_ID
       || ',"prediction":' || TX_FRAUD || ',"probability":' || CAST(CAST(round(TX_AMOUNT / 1000.0 + 1e-9, 6) AS DECIMAL(38,6)) AS VARCHAR) || '}}' AS value
FROM tx""")
def prediction_messages(spark, sf_dir):
    """Prediction records serialised as the predictions topic carries them.

    The score here is a stand-in (amount / 1000, label as class) so the JSON
    layout can be checked by SQL; model scores go through the same encoder.
    """
    tx = src.transactions(spark, sf_dir)
    scored = tx.select(S.TX_ID, S.TX_DATETIME, S.CUSTOMER_ID, S.TERMINAL_ID,
                       F.col(S.TX_FRAUD).alias("prediction"),
                       stable_round(F.col(S.TX_AMOUNT) / F.lit(1000.0)).alias("probability"))
    return M.encode_predictions(scored, ["TRANSACTION_ID", "TX_DATETIME", "CUSTOMER_ID", "TERMINAL_ID",
                                         "prediction", "probability"], decimals=6)


_PARTITION_SQL = f"""WITH {Q.TX}
SELECT {{part}} AS {{name}}, CAST(count(*) AS BIGINT) AS n_rows, min(TX_TIME_SECONDS) AS min_seconds,
       max(TX_TIME_SECONDS) AS max_seconds, CAST(sum(TX_FRAUD) AS BIGINT) AS n_frauds
FROM tx GROUP BY 1"""


def _partition_summary(df, name):
    return (df.groupBy(name).agg(F.count(F.lit(1)).alias("n_rows"), F.min(S.TX_TIME_SECONDS).alias("min_seconds"),
                                 F.max(S.TX_TIME_SECONDS).alias("max_seconds"),
                                 F.sum(F.col(S.TX_FRAUD).cast("long")).alias("n_frauds")))


@query("daily_partitions", _PARTITION_SQL.format(part="strftime(TX_DATETIME, '%Y-%m-%d')", name="TX_DATE"))
def daily_partitions(spark, sf_dir):
    """S5 + S1: write one folder per day to the shared scratch folder, read it back, count per day."""
    path = scratch_path(spark, f"daily-{uuid.uuid4().hex}")
    sinks.write_daily(src.transactions(spark, sf_dir), path)
    back = sinks.read_partitioned(spark, path, S.RAW_TRANSACTION, S.TX_DATE)
    return _partition_summary(src.replace_minus_one(back), S.TX_DATE)


@query("daily_append", _PARTITION_SQL.format(part="strftime(TX_DATETIME, '%Y-%m-%d')", name="TX_DATE"))
def daily_append(spark, sf_dir):
    """Rows of even ids written first, the others appended to the same day folders."""
    path = scratch_path(spark, f"append-{uuid.uuid4().hex}")
    tx = src.transactions(spark, sf_dir)
    sinks.write_daily(tx.where(F.col(S.TX_ID) % 2 == 0), path)
    sinks.write_daily(tx.where(F.col(S.TX_ID) % 2 != 0), path, mode="append")
    return _partition_summary(sinks.read_partitioned(spark, path, S.RAW_TRANSACTION, S.TX_DATE), S.TX_DATE)


@query("order_within_day", f"""WITH {Q.TX}
SELECT strftime(TX_DATETIME, '%Y-%m-%d') AS TX_DATE, CAST(count(*) AS BIGINT) AS n_rows,
       CAST(0 AS BIGINT) AS n_out_of_order FROM tx GROUP BY 1""")
def order_within_day(spark, sf_dir):
    """O3: rows of a day's files that are earlier than the row before them."""
    path = scratch_path(spark, f"order-{uuid.uuid4().hex}")
    sinks.write_daily(src.transactions(spark, sf_dir), path)
    back = sinks.read_partitioned(spark, path, S.RAW_TRANSACTION, S.TX_DATE).select(
        S.TX_DATE, S.TX_TIME_SECONDS, F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("i"))
    before = F.lag(S.TX_TIME_SECONDS).over(Window.partitionBy(S.TX_DATE, "file").orderBy("i"))
    return (back.withColumn("late", F.coalesce((F.col(S.TX_TIME_SECONDS) < before).cast("long"), F.lit(0).cast("long")))
            .groupBy(S.TX_DATE).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("late").alias("n_out_of_order")))


@query("monthly_partitions", _PARTITION_SQL.format(part="strftime(TX_DATETIME, '%Y-%m')", name="TX_MONTH"))
def monthly_partitions(spark, sf_dir):
    """One folder per month, read back and counted."""
    path = scratch_path(spark, f"monthly-{uuid.uuid4().hex}")
    sinks.write_monthly(src.transactions(spark, sf_dir), path)
    back = sinks.read_partitioned(spark, path, S.RAW_TRANSACTION, "TX_MONTH")
    return _partition_summary(back, "TX_MONTH")


@query("daily_partitions_csv", _PARTITION_SQL.format(part="strftime(TX_DATETIME, '%Y-%m-%d')", name="TX_DATE"))
def daily_partitions_csv(spark, sf_dir):
    """The same day-partitioned round trip through CSV files."""
    path = scratch_path(spark, f"daily-csv-{uuid.uuid4().hex}")
    sinks.write_daily(src.transactions(spark, sf_dir), path, fmt="csv")
    back = sinks.read_partitioned(spark, path, S.RAW_TRANSACTION, S.TX_DATE, fmt="csv")
    return _partition_summary(back, S.TX_DATE)


@query("latest_day_rows", f"""WITH {Q.TX}
SELECT TRANSACTION_ID, TX_TIME_DAYS FROM tx WHERE TX_TIME_DAYS = (SELECT max(TX_TIME_DAYS) FROM tx)""")
def latest_day_rows(spark, sf_dir):
    """Rows of the newest day."""
    return src.latest_partition(src.transactions(spark, sf_dir)).select(S.TX_ID, S.TX_TIME_DAYS)


@query("lookback_from_partitions", f"""
WITH {Q.TX},
last AS (SELECT arg_max(TX_DATETIME, TRANSACTION_ID) AS t FROM tx)
SELECT tx.TRANSACTION_ID, tx.TX_DATETIME, tx.CUSTOMER_ID FROM tx, last
WHERE tx.TX_DATETIME > last.t - INTERVAL 14 DAY""")
def lookback_from_partitions(spark, sf_dir):
    """S5 + S1 + P1: write day folders, then read back only the 14-day lookback (partition pruning)."""
    path = scratch_path(spark, f"lookback-{uuid.uuid4().hex}")
    sinks.write_daily(src.transactions(spark, sf_dir), path)
    return sinks.read_lookback(spark, path, 14).select(S.TX_ID, S.TX_DATETIME, S.CUSTOMER_ID)


@query("latest_file_rows", f"""WITH {Q.TX}
SELECT TRANSACTION_ID, TX_DATETIME FROM tx WHERE TX_TIME_DAYS = (SELECT max(TX_TIME_DAYS) FROM tx)""")
def latest_file_rows(spark, sf_dir):
    """The rows of the newest file, of a folder in which the newest day was written last."""
    path = scratch_path(spark, f"files-{uuid.uuid4().hex}")
    tx = src.transactions(spark, sf_dir)
    newest = tx.select(F.max(S.TX_TIME_DAYS)).scalar()
    tx.where(F.col(S.TX_TIME_DAYS) < newest).write.parquet(path)
    tx.where(F.col(S.TX_TIME_DAYS) == newest).coalesce(1).write.mode("append").parquet(path)
    return src.latest_file(spark.read.schema(S.RAW_TRANSACTION).parquet(path)).select(S.TX_ID, S.TX_DATETIME)
