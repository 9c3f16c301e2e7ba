"""Table-level summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import schema as S


def entity_counts(df: DataFrame) -> DataFrame:
    """A1/A2: rows, distinct customers and terminals, frauds, fraud percentage."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct(S.CUSTOMER_ID).alias("n_customers"),
        F.countDistinct(S.TERMINAL_ID).alias("n_terminals"),
        F.sum(F.col(S.TX_FRAUD).cast("long")).alias("n_frauds"),
    ).withColumn("fraud_pct", F.round(F.col("n_frauds") * 100.0 / F.col("n_rows"), 6))


def day_bounds(df: DataFrame) -> DataFrame:
    """First and last day, and the last row (greatest id): id, time, day, seconds."""
    return df.agg(
        F.min(S.TX_TIME_DAYS).alias("min_day"),
        F.max(S.TX_TIME_DAYS).alias("max_day"),
        F.max(S.TX_ID).alias("last_id"),
        F.max_by(S.TX_DATETIME, S.TX_ID).alias("last_datetime"),
        F.max_by(S.TX_TIME_DAYS, S.TX_ID).alias("last_day"),
        F.max_by(S.TX_TIME_SECONDS, S.TX_ID).alias("last_seconds"),
    )


def first_fraud_day(df: DataFrame) -> DataFrame:
    """Defrauded customers with the first day each became known and their fraud count."""
    return (df.where(F.col(S.TX_FRAUD) == 1)
            .groupBy(S.CUSTOMER_ID)
            .agg(F.min(S.TX_TIME_DAYS).alias("first_fraud_day"),
                 F.count(F.lit(1)).alias("n_frauds")))


def scenario_totals(df: DataFrame) -> DataFrame:
    """A5: rows and amount per fraud scenario."""
    return (df.groupBy(S.TX_FRAUD_SCENARIO)
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 F.sum(F.col(S.TX_FRAUD).cast("long")).alias("n_frauds")))
