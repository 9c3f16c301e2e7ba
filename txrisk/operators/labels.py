"""Fraud labels by rule.

Scenario 1: amount above a threshold.
Scenario 2: every transaction of a compromised terminal during n_days from the
            incident day.
Scenario 3: a fraction (1/3) of the transactions of compromised customers
            during n_days from the incident day; each selection multiplies the
            amount by 5.
Precedence: 3 over 2 over 1 (last writer wins). Selection in scenario 3 does
not depend on the amount, so the sequential day loop equals one grouped join:
hits per transaction = number of incident days that picked it.

Interval joins are equi-joins on (entity, day): each incident is expanded to
its n_days (entity, day) cells, a table bounded by incidents x n_days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .. import schema as S
from ..sources.transactions import AMOUNT_THRESHOLD
from ..functions.hashing import md5_key
from .sampling import lowest_k_per_group

# Fixed values of the rules.
INCIDENT_DAYS = 14
AMOUNT_MULTIPLIER = 5.0
CUSTOMER_FRACTION_DIVISOR = 3
#: Days without a fraud that a session of frauds may hold.
GAP_DAYS = 1


def incident_sessions(tx: DataFrame, gap_days: int = GAP_DAYS, label_col: str = S.TX_FRAUD) -> DataFrame:
    """Incidents (kind, entity_id, start_day, n_days) from labelled transactions.

    The days on which a terminal or a customer has frauds are joined to sessions
    (gaps and islands): a session goes on while at most ``gap_days`` days without a
    fraud lie between two days with one, and is an incident from its first day to
    its last. Frauds are reduced to one row for each entity and day before they
    meet by entity, so a window holds as many rows as there are days, however
    many frauds an entity has. Rows without entity or day give none.
    """
    entity = lambda kind, c: F.struct(F.lit(kind).alias("kind"), F.col(c).cast("long").alias("entity_id"))
    days = (tx.where(F.col(label_col) == 1)
            .select(F.explode(F.array(entity("terminal", S.TERMINAL_ID), entity("customer", S.CUSTOMER_ID))).alias("e"),
                    F.col(S.TX_TIME_DAYS).cast("long").alias("day"))
            .select("e.kind", "e.entity_id", "day").where("entity_id is not null and day is not null").distinct())
    by_entity = Window.partitionBy("kind", "entity_id").orderBy("day")
    new = F.coalesce((F.col("day") - F.lag("day").over(by_entity) > gap_days + 1).cast("long"), F.lit(1).cast("long"))
    session = F.sum("_new").over(by_entity)
    return (days.withColumn("_new", new).withColumn("_session", session)
            .groupBy("kind", "entity_id", "_session")
            .agg(F.min("day").alias("start_day"), (F.max("day") - F.min("day") + 1).cast("int").alias("n_days"))
            .drop("_session"))


def _incident_cells(incidents: DataFrame, kind: str, key: str) -> DataFrame:
    """(start_day, entity, day) for each day an incident covers."""
    inc = incidents.where(F.col("kind") == kind)
    start = F.col("start_day").cast("long")
    days = F.sequence(start, start + F.col("n_days").cast("long") - 1)
    return inc.select("start_day", F.col("entity_id").cast("long").alias(key), F.explode(days).alias(S.TX_TIME_DAYS))


def terminal_hits(tx: DataFrame, incidents: DataFrame) -> DataFrame:
    """TRANSACTION_IDs on a compromised terminal inside an incident interval (left-semi)."""
    cells = _incident_cells(incidents, "terminal", S.TERMINAL_ID).select(S.TERMINAL_ID, S.TX_TIME_DAYS).distinct()
    return tx.join(cells, [S.TERMINAL_ID, S.TX_TIME_DAYS], "left_semi")


def customer_hits(tx: DataFrame, incidents: DataFrame,
                  divisor: int = CUSTOMER_FRACTION_DIVISOR) -> DataFrame:
    """(TRANSACTION_ID, n_hits) picked by customer incidents.

    Per incident day, the candidates are the rows of its customers inside its
    interval; floor(candidates / divisor) of them with the smallest
    md5(start_day:TRANSACTION_ID) are picked.
    """
    cells = _incident_cells(incidents, "customer", S.CUSTOMER_ID)
    cand = (tx.select(S.TX_ID, S.CUSTOMER_ID, S.TX_TIME_DAYS)
            .join(cells, [S.CUSTOMER_ID, S.TX_TIME_DAYS])
            .select("start_day", S.TX_ID, md5_key("start_day", S.TX_ID).alias("_h")))
    picked = lowest_k_per_group(cand, ["start_day"], "_h", S.TX_ID,
                                lambda n: F.floor(n / F.lit(divisor)))
    return picked.groupBy(S.TX_ID).agg(F.count(F.lit(1)).alias("n_hits"))


def amount_flag(tx: DataFrame, threshold: float = AMOUNT_THRESHOLD) -> DataFrame:
    """L1: scenario 1 labels only."""
    s1 = (F.col(S.TX_AMOUNT) > F.lit(threshold)).cast("int")
    return tx.withColumns({S.TX_FRAUD: s1, S.TX_FRAUD_SCENARIO: s1})


def label_transactions(tx: DataFrame, incidents: DataFrame, threshold: float = AMOUNT_THRESHOLD,
                       multiplier: float = AMOUNT_MULTIPLIER,
                       divisor: int = CUSTOMER_FRACTION_DIVISOR) -> DataFrame:
    """Final TX_FRAUD, TX_FRAUD_SCENARIO and TX_AMOUNT of every row."""
    # Terminal flag straight from the (terminal, day) cells - a table bounded by
    # incidents x n_days - so the transactions are not re-joined on their id.
    t_cells = (_incident_cells(incidents, "terminal", S.TERMINAL_ID).select(S.TERMINAL_ID, S.TX_TIME_DAYS)
               .distinct().withColumn("_s2", F.lit(True)))
    c_hit = customer_hits(tx, incidents, divisor)
    j = tx.join(t_cells, [S.TERMINAL_ID, S.TX_TIME_DAYS], "left").join(c_hit, S.TX_ID, "left")
    hits = F.coalesce(F.col("n_hits"), F.lit(0))
    scenario = (F.when(hits > 0, 3).when(F.col("_s2").isNotNull(), 2)
                .when(F.col(S.TX_AMOUNT) > F.lit(threshold), 1).otherwise(0))
    out = j.withColumns({
        S.TX_AMOUNT: F.col(S.TX_AMOUNT) * F.pow(F.lit(multiplier), hits),
        S.TX_FRAUD_SCENARIO: scenario.cast("int"),
        S.TX_FRAUD: (scenario > 0).cast("int"),
    })
    return out.select(*tx.columns)


def flag_members(tx: DataFrame, members: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in a member table (no interval), left-semi."""
    return tx.join(members.select(key).distinct(), key, "left_semi")


def newly_flagged_counts(tx: DataFrame, incidents: DataFrame, threshold: float = AMOUNT_THRESHOLD) -> DataFrame:
    """A5 (printed totals of the source): frauds added by each scenario in turn.

    Scenario 2 counts rows it turns from genuine to fraud; scenario 3 counts
    rows it turns from genuine to fraud after scenarios 1 and 2.
    """
    t_cells = (_incident_cells(incidents, "terminal", S.TERMINAL_ID).select(S.TERMINAL_ID, S.TX_TIME_DAYS)
               .distinct().withColumn("_s2", F.lit(1)))
    c_hit = customer_hits(tx, incidents).select(S.TX_ID, F.lit(1).alias("_s3"))
    j = tx.join(t_cells, [S.TERMINAL_ID, S.TX_TIME_DAYS], "left").join(c_hit, S.TX_ID, "left")
    s1 = F.col(S.TX_AMOUNT) > F.lit(threshold)
    s2 = F.col("_s2").isNotNull()
    s3 = F.col("_s3").isNotNull()
    return j.agg(
        F.sum(s1.cast("long")).alias("new_scenario_1"),
        F.sum((s2 & ~s1).cast("long")).alias("new_scenario_2"),
        F.sum((s3 & ~s1 & ~s2).cast("long")).alias("new_scenario_3"),
    )


# Daily-batch form (fixed values): one compromised terminal for the whole batch,
# ten compromised customers, half of their transactions picked.
DAILY_TERMINALS = 1
DAILY_CUSTOMERS = 10
DAILY_DIVISOR = 2


def label_daily_batch(batch: DataFrame, seed: int = 42, n_terminals: int = DAILY_TERMINALS,
                      n_customers: int = DAILY_CUSTOMERS, divisor: int = DAILY_DIVISOR,
                      threshold: float = AMOUNT_THRESHOLD, multiplier: float = AMOUNT_MULTIPLIER) -> DataFrame:
    """L4 + J7: labels of one batch without incident intervals.

    The compromised entities are the batch's active terminals / customers with
    the smallest md5(seed:id) (top-n with a partial group limit); membership is
    a left-semi join; among the compromised customers' rows floor(n / divisor)
    with the smallest md5(seed:TRANSACTION_ID) are picked (one group, split into
    hash buckets, so the whole batch never sorts in one task).
    """
    from .sampling import top_n_per_group
    one = F.lit(0).alias("_g")
    terms = top_n_per_group(batch.select(S.TERMINAL_ID).distinct().select(S.TERMINAL_ID, one), ["_g"],
                            [md5_key(F.lit(str(seed)), S.TERMINAL_ID), S.TERMINAL_ID], n_terminals)
    custs = top_n_per_group(batch.select(S.CUSTOMER_ID).distinct().select(S.CUSTOMER_ID, one), ["_g"],
                            [md5_key(F.lit(str(seed)), S.CUSTOMER_ID), S.CUSTOMER_ID], n_customers)
    s2 = flag_members(batch, terms, S.TERMINAL_ID).select(S.TX_ID, F.lit(True).alias("_s2"))
    cand = (flag_members(batch, custs, S.CUSTOMER_ID)
            .select(S.TX_ID, F.lit(0).alias("_g"), md5_key(F.lit(str(seed)), S.TX_ID).alias("_h")))
    picked = (lowest_k_per_group(cand, ["_g"], "_h", S.TX_ID, lambda n: F.floor(n / F.lit(divisor)))
              .select(S.TX_ID, F.lit(True).alias("_s3")))
    j = batch.join(s2, S.TX_ID, "left").join(picked, S.TX_ID, "left")
    s3 = F.col("_s3").isNotNull()
    scenario = (F.when(s3, 3).when(F.col("_s2").isNotNull(), 2)
                .when(F.col(S.TX_AMOUNT) > F.lit(threshold), 1).otherwise(0))
    out = j.withColumns({
        S.TX_AMOUNT: F.when(s3, F.col(S.TX_AMOUNT) * F.lit(multiplier)).otherwise(F.col(S.TX_AMOUNT)),
        S.TX_FRAUD_SCENARIO: scenario.cast("int"),
        S.TX_FRAUD: (scenario > 0).cast("int"),
    })
    return out.select(*batch.columns)
