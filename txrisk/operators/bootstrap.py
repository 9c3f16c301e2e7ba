"""Bootstrap comparison of two scoring models.

E1: each model's scored rows are resampled with replacement, full size, R
times. Rows stand in the order of score, then label, so rows that count alike - a
cell of one score and label - are a range of positions. Draw k of replicate r
picks position ``md5(seed:model:r:k) mod N``: exactly N draws per replicate,
deterministic, no driver loop. What a draw needs is the cell of its position,
found by binary search among the cells' first positions; the draws are made in
numpy, thousands at a time, and counted by cell where they are made, so what is
shuffled are counts of scores x replicates, not draws, and rows are never sorted
or numbered. Where there are more cells than are broadcast, the draws meet them in
an equi-join on the position's high bits. The exact AUC of each (model, replicate)
comes from these counts with the distributed metric.

E2: two-sample equal-variance t-test on the replicate AUCs; promote the
challenger when p < alpha and its mean AUC is not below the champion's.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..functions.hashing import md5_key60_numbered
from ..functions.stats import t_p_value
from ..session import written
from .metrics import roc_auc
from .prefix import running_sums

REPLICATES = 100
ALPHA = 0.05
#: Cells that are broadcast at most: about 50 bytes each.
BROADCAST_CELLS = 200_000
#: Slots that one row of the draws' source stands for.
PIECE = 1 << 14


def score_cells(scores: DataFrame, model_col: str = "model", label_col: str = "label", score_col: str = "score") -> DataFrame:
    """(model, score, label, first, last, n, m): the positions of each cell, the model's number of rows and its own number."""
    one = F.col(label_col) == 1
    per_score = written(scores.groupBy(model_col, score_col).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(~one | one.isNull()).alias("_zeros")), "cells")
    totals = per_score.groupBy(model_col).agg(F.sum("_n").alias("_n_model")) \
        .withColumn("_m", F.row_number().over(Window.orderBy(model_col)).cast("long"))
    ends = running_sums(per_score, [model_col], score_col, ["_n"])
    start = F.col("_n_cum") - F.col("_n")
    cell = lambda label, first, last: F.struct(F.lit(label).alias("label"), first.alias("first"), last.alias("last"))
    both = F.array(cell(0, start, start + F.col("_zeros") - 1), cell(1, start + F.col("_zeros"), F.col("_n_cum") - 1))
    # one row per model: a bounded side
    return (ends.withColumn("_c", F.explode(both)).where("_c.last >= _c.first").join(F.broadcast(totals), model_col)
            .select(model_col, score_col, F.col("_c.label").alias(label_col), F.col("_c.first").alias("_first"),
                    F.col("_c.last").alias("_last"), F.col("_n_model").alias("_n"), "_m"))


def _draws(batches, seed: int):
    """(number of the model, replicate, positions drawn) for each piece."""
    for b in batches:
        for m, model, n, first, r in zip(*(c.to_pylist() for c in b.columns)):
            yield m, r, (md5_key60_numbered(f"{seed}:{model}:{r}:", first, min(first + PIECE, n)) % np.uint64(n)).astype(np.int64)


def _drawn(pieces: DataFrame, seed: int) -> DataFrame:
    """(_m, replicate, _j): a row for every draw."""
    def draw(batches):
        for m, r, j in _draws(batches, seed):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(j), m)), pa.array(np.full(len(j), r, dtype=np.int32)), pa.array(j)],
                                             names=["_m", "replicate", "_j"])
    return pieces.mapInArrow(draw, "_m long, replicate int, _j long")


def _counted(pieces: DataFrame, cells: DataFrame, seed: int) -> DataFrame:
    """(_m, replicate, _first, _drawn): how often the pieces of each partition draw the cell that begins at ``_first``.

    Positions of rows without a score lie in no cell; their draws count for none.
    """
    at = cells.select("_m", "_first", "_last").toPandas().sort_values(["_m", "_first"])  # as many as are broadcast at most
    sent = cells.sparkSession.sparkContext.broadcast(
        {m: tuple(g[c].to_numpy(dtype=np.int64) for c in ("_first", "_last")) for m, g in at.groupby("_m")})

    def count(batches):
        now, drawn = None, None

        def rows():
            met = np.flatnonzero(drawn)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(met), now[0])), pa.array(np.full(len(met), now[1], dtype=np.int32)),
                 pa.array(sent.value[now[0]][0][met]), pa.array(drawn[met])], names=["_m", "replicate", "_first", "_drawn"])
        for m, r, j in _draws(batches, seed):
            first, last = sent.value[m]
            if now != (m, r):
                if now:
                    yield rows()
                now, drawn = (m, r), np.zeros(len(first), dtype=np.int64)
            j.sort()
            cell = np.searchsorted(first, j, "right") - 1
            drawn += np.bincount(cell[(cell >= 0) & (j <= last[cell])], minlength=len(first))
        if now:
            yield rows()
    return pieces.mapInArrow(count, "_m long, replicate int, _first long, _drawn long")


def bootstrap_auc(scores: DataFrame, replicates: int = REPLICATES, seed: int = 42,
                  model_col: str = "model", label_col: str = "label",
                  score_col: str = "score", broadcast_cells: int = BROADCAST_CELLS) -> DataFrame:
    """(model, replicate, roc_auc, n_pos, n_neg) for every replicate."""
    cells = written(score_cells(scores, model_col, label_col, score_col), "cells")
    n = int(scores.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_cells, n_rows = cells.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("_last") - F.col("_first") + 1), F.lit(0))).first()
    # Draws are made from pieces of a replicate's slots. Pieces of one replicate stand together, so a task
    # meets few replicates and its counts by score fold many draws into one.
    reps = F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))).alias("replicate")
    pieces = cells.groupBy("_m", F.col(model_col).cast("string").alias("_model")).agg(F.max("_n").alias("_n")) \
        .select("_m", "_model", "_n", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(PIECE).cast("long"))).alias("_from")) \
        .select("_m", "_model", "_n", "_from", reps).repartitionByRange(n, "_m", "replicate", "_from") \
        .sortWithinPartitions("_m", "replicate")
    if n_cells <= broadcast_cells:  # measured
        picked = _counted(pieces, cells, seed).join(
            F.broadcast(cells.select("_m", "_first", score_col, label_col)), ["_m", "_first"]) \
            .groupBy("_m", "replicate", score_col, label_col).agg(F.sum("_drawn").alias("count"))
    else:
        # Positions share high bits with about as many ranges as there are cells; a range's key is one
        # number of model and high bits.
        shift = max(0, (n_rows // max(n_cells, 1)).bit_length() - 1)
        key = lambda c: F.shiftleft(F.col("_m"), 48).bitwiseOR(F.shiftright(F.col(c), shift))
        found = cells.select("_m", label_col, score_col, "_first", "_last", F.explode(F.sequence(key("_first"), key("_last"))).alias("_key")) \
            .drop("_m")
        met = _drawn(pieces, seed).withColumn("_key", key("_j")).join(found, "_key")
        picked = met.where((F.col("_j") >= F.col("_first")) & (F.col("_j") <= F.col("_last"))) \
            .groupBy("_m", "replicate", score_col, label_col).count()
    models = F.broadcast(cells.select("_m", model_col).distinct())  # one row for each model
    picked = picked.join(models, "_m")
    return roc_auc(picked, label_col, score_col, group_cols=[model_col, "replicate"], weight_col="count",
                   cuts_from=cells.select(score_col), materialize=True)


def replicate_stats(aucs: DataFrame, model_col: str = "model") -> DataFrame:
    """A10: count, mean and sample variance of the replicate AUCs per model."""
    return aucs.groupBy(model_col).agg(F.count(F.lit(1)).alias("n"), F.avg("roc_auc").alias("mean_auc"),
                                       F.var_samp("roc_auc").alias("var_auc"))


def t_test(aucs: DataFrame, champion: str, challenger: str, model_col: str = "model") -> DataFrame:
    """One row with both means, t, degrees of freedom (p-value added by ``decide``)."""
    st = replicate_stats(aucs, model_col)
    pick = {}
    for role, name in (("champion", champion), ("challenger", challenger)):
        for c in ("n", "mean_auc", "var_auc"):
            pick[f"{c}_{role}"] = F.max(F.when(F.col(model_col) == name, F.col(c))).alias(f"{c}_{role}")
    j = st.agg(*pick.values())
    n1, n2 = F.col("n_champion"), F.col("n_challenger")
    dof = n1 + n2 - 2
    sp2 = ((n1 - 1) * F.col("var_auc_champion") + (n2 - 1) * F.col("var_auc_challenger")) / dof
    t = F.try_divide(F.col("mean_auc_champion") - F.col("mean_auc_challenger"),
                     F.sqrt(sp2 * (F.lit(1.0) / n1 + F.lit(1.0) / n2)))
    return j.select("mean_auc_champion", "mean_auc_challenger", t.alias("t_stat"), dof.cast("double").alias("dof"))


def decide(test: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """P-value and decision. Ties of the means promote (keep needs champion > challenger)."""
    p = t_p_value(F.col("t_stat"), F.col("dof"))
    out = test.withColumn("p_value", p)
    promote = (F.col("p_value") < alpha) & ~(F.col("mean_auc_champion") > F.col("mean_auc_challenger"))
    return out.withColumn("decision", F.when(promote, "promote").otherwise("keep"))


def histogram(aucs: DataFrame, bins: int = 10, model_col: str = "model", value_col: str = "roc_auc") -> DataFrame:
    """E5: counts per (model, bin) over the common range of all values; bin 1..bins."""
    rng = aucs.agg(F.min(value_col).alias("lo"), F.max(value_col).alias("hi"))
    lo = rng.select("lo").scalar()
    hi = rng.select("hi").scalar()
    raw = F.floor((F.col(value_col) - lo) * bins / (hi - lo)) + 1
    b = F.when(hi == lo, F.lit(1)).otherwise(F.least(raw, F.lit(bins))).cast("int")
    return aucs.groupBy(model_col, b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
