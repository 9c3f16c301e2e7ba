"""A deterministic incident table for the test series."""

from pyspark.sql import DataFrame, functions as F

from txrisk import schema as S
from txrisk.operators.labels import INCIDENT_DAYS

# Deterministic incident rule for the test series: terminal (d*37+11) mod #terminals,
# customers (d*13 + offset) mod #customers for each offset.
TERMINAL_STEP, TERMINAL_SHIFT = 37, 11
CUSTOMER_STEP, CUSTOMER_SHIFTS = 13, (1, 14, 27)


def incidents_by_rule(tx: DataFrame, n_days: int = INCIDENT_DAYS) -> DataFrame:
    """Incident table (kind, entity_id, start_day, n_days) for start days 0..max_day-1.

    Everything derives lazily from one aggregate of the transactions (no
    driver round trip); size is (1 + len(CUSTOMER_SHIFTS)) x days.
    """
    b = tx.agg(F.max(S.TX_TIME_DAYS).alias("max_day"),
               (F.max(S.CUSTOMER_ID) + 1).alias("n_cust"),
               (F.max(S.TERMINAL_ID) + 1).alias("n_term"))
    days = b.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("max_day") - 1)).alias("d"))
    term = days.select(F.lit("terminal").alias("kind"),
                       ((F.col("d") * TERMINAL_STEP + TERMINAL_SHIFT) % F.col("n_term")).alias("entity_id"),
                       F.col("d").alias("start_day"))
    cust = days.select(F.lit("customer").alias("kind"),
                       F.explode(F.array(*[(F.col("d") * CUSTOMER_STEP + k) % F.col("n_cust")
                                           for k in CUSTOMER_SHIFTS])).alias("entity_id"),
                       F.col("d").alias("start_day"))
    return (term.unionByName(cust).distinct()
            .withColumn("n_days", F.lit(n_days)))
