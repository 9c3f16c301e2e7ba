"""Sequential ids in time order and series continuation.

``sequential_ids`` avoids a global single-partition ``row_number``: the table
is range-partitioned and sorted (``orderBy``), each row gets its position
inside its partition, and a table of per-partition row counts - one row per
partition, so its size is bounded by the partition count - turns positions
into global ids. The sorted table is written to the shared scratch folder first,
so both passes see identical partitions and a lost executor does not
re-randomise them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .. import schema as S
from ..functions import calendar as cal
from ..session import written


def sequential_ids(df: DataFrame, order_cols: list[str], id_col: str = "SEQ_ID",
                   start: int = 0, checkpoint: bool = True) -> DataFrame:
    spark = df.sparkSession
    # Range partitions in order, sorted inside: the global order. An explicit
    # partition count keeps AQE from folding the ranges into a few tasks.
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
               .withColumn("_pid", F.spark_partition_id())
               .withColumn("_mid", F.monotonically_increasing_id()))
    if checkpoint:
        ordered = written(ordered, "ordered")
    # monotonically_increasing_id = partition index << 33 | position in partition
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    ordered = ordered.withColumn("_pos", local)
    sizes = ordered.groupBy("_pid").agg((F.max("_pos") + 1).alias("_size"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_pid", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    # offsets has one row per partition: a bounded, broadcast-safe side.
    out = ordered.join(F.broadcast(offsets), "_pid")
    return (out.withColumn(id_col, F.col("_offset") + F.col("_pos") + F.lit(start))
            .drop("_pid", "_mid", "_pos", "_offset"))


def rebase(batch: DataFrame, history: DataFrame) -> DataFrame:
    """Continue the history's series with a batch numbered from 0.

    ids += last id + 1; TX_TIME_DAYS += last day + 1;
    TX_TIME_SECONDS += last seconds + seconds from the last time to midnight.
    The anchors are scalar subqueries over the history (one aggregate).
    """
    last = history.agg(F.max_by(F.struct(S.TX_ID, S.TX_DATETIME, S.TX_TIME_SECONDS, S.TX_TIME_DAYS),
                                S.TX_ID).alias("l"))
    last_id = last.select("l." + S.TX_ID).scalar()
    last_day = last.select("l." + S.TX_TIME_DAYS).scalar()
    sec_shift = last.select(F.col("l." + S.TX_TIME_SECONDS)
                            + cal.seconds_until_midnight(F.col("l." + S.TX_DATETIME))).scalar()
    return batch.withColumns({
        S.TX_ID: F.col(S.TX_ID) + last_id + 1,
        S.TX_TIME_SECONDS: F.col(S.TX_TIME_SECONDS) + sec_shift,
        S.TX_TIME_DAYS: F.col(S.TX_TIME_DAYS) + last_day + 1,
    })
