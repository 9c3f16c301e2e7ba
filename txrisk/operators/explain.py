"""Per-feature contributions of forest predictions (E4): path-dependent TreeSHAP.

The forest's node table is read from the saved model (a bounded artefact:
trees x nodes), flattened into arrays, broadcast once, and every row of the
input is explained inside ``mapInPandas`` tasks. For class 1 the value of a
leaf is its share of class-1 training weight, the ensemble output is the mean
over trees (Spark's probability), so contributions and base value are means
of the per-tree values; base + sum(contributions) = P(class 1).

The algorithm is the published polynomial-time path-dependent TreeSHAP
(Lundberg, Erion, Lee, 2018, Algorithm 2).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def _forest_stage(model: PipelineModel):
    return model.stages[-1]


def load_trees(spark: SparkSession, model_path: str) -> list[dict]:
    """Flat arrays per tree from the saved forest stage's node table."""
    from ..sources.sinks import folder_exists
    whole = folder_exists(spark, f"{model_path}/stages")
    stage_dir = f"{model_path}/stages/*_RandomForest*" if whole else model_path
    nodes = spark.read.parquet(f"{stage_dir}/data").select(
        "treeID", F.col("nodeData.id").alias("id"), F.col("nodeData.impurityStats").alias("stats"),
        F.col("nodeData.leftChild").alias("left"), F.col("nodeData.rightChild").alias("right"),
        F.col("nodeData.split.featureIndex").alias("feature"),
        F.col("nodeData.split.leftCategoriesOrThreshold").alias("thr")).toPandas()
    trees = []
    for _tid, g in nodes.groupby("treeID"):
        g = g.sort_values("id")
        n = int(g["id"].max()) + 1
        left = np.full(n, -1, np.int64)
        right = np.full(n, -1, np.int64)
        feat = np.full(n, -1, np.int64)
        thr = np.zeros(n)
        cover = np.zeros(n)
        value = np.zeros(n)
        for r in g.itertuples(index=False):
            i = int(r.id)
            stats = np.asarray(r.stats, dtype=float)
            cover[i] = stats.sum()
            value[i] = stats[1] / stats.sum() if stats.sum() > 0 and len(stats) > 1 else 0.0
            if r.left >= 0:
                left[i], right[i], feat[i] = int(r.left), int(r.right), int(r.feature)
                thr[i] = float(r.thr[0])
        trees.append(dict(left=left, right=right, feature=feat, threshold=thr, cover=cover, value=value))
    return trees


def _extend(d, z, o, w, pz, po, pi):
    l = len(d)
    d, z, o, w = d + [pi], z + [pz], o + [po], w + [1.0 if l == 0 else 0.0]
    for i in range(l - 1, -1, -1):
        w[i + 1] += po * w[i] * (i + 1) / (l + 1)
        w[i] = pz * w[i] * (l - i) / (l + 1)
    return d, z, o, w


def _unwind(d, z, o, w, i):
    l = len(d) - 1
    w = list(w)
    n = w[l]
    for j in range(l - 1, -1, -1):
        if o[i] != 0:
            t = w[j]
            w[j] = n * (l + 1) / ((j + 1) * o[i])
            n = t - w[j] * z[i] * (l - j) / (l + 1)
        else:
            w[j] = w[j] * (l + 1) / (z[i] * (l - j))
    d2 = d[:i] + d[i + 1:]
    z2 = z[:i] + z[i + 1:]
    o2 = o[:i] + o[i + 1:]
    return d2, z2, o2, w[:l]


def tree_shap(x: np.ndarray, tree: dict, n_features: int) -> np.ndarray:
    """Contributions of one tree for one row."""
    phi = np.zeros(n_features)
    left, right, feat, thr, cover, value = (tree[k] for k in ("left", "right", "feature", "threshold", "cover", "value"))

    def rec(j, d, z, o, w, pz, po, pi):
        d, z, o, w = _extend(d, z, o, w, pz, po, pi)
        if left[j] < 0:
            for i in range(1, len(d)):
                _, _, _, uw = _unwind(d, z, o, w, i)
                phi[d[i]] += sum(uw) * (o[i] - z[i]) * value[j]
            return
        f = feat[j]
        xv = x[f]
        hot, cold = (left[j], right[j]) if (not np.isnan(xv) and xv <= thr[j]) else (right[j], left[j])
        iz, io = 1.0, 1.0
        if f in d[1:]:
            k = d.index(f, 1)
            iz, io = z[k], o[k]
            d, z, o, w = _unwind(d, z, o, w, k)
        rec(hot, d, z, o, w, iz * cover[hot] / cover[j], io, f)
        rec(cold, d, z, o, w, iz * cover[cold] / cover[j], 0.0, f)

    rec(0, [], [], [], [], 1.0, 1.0, -1)
    return phi


def _extend_v(d, z, o, w, pz, po, pi, n_rows):
    """EXTEND with per-row arrays for the one fractions and the weights."""
    l = len(d)
    d, z = d + [pi], z + [pz]
    o = o + [np.broadcast_to(np.asarray(po, dtype=float), (n_rows,)).copy()]
    w = [x.copy() for x in w] + [np.ones(n_rows) if l == 0 else np.zeros(n_rows)]
    for i in range(l - 1, -1, -1):
        w[i + 1] += o[l] * w[i] * (i + 1) / (l + 1)
        w[i] = pz * w[i] * (l - i) / (l + 1)
    return d, z, o, w


def _unwind_v(d, z, o, w, i):
    """UNWIND with per-row arrays; rows whose one fraction is 0 take the other branch."""
    l = len(d) - 1
    oi, zi = o[i], z[i]
    hot = oi != 0
    safe_o = np.where(hot, oi, 1.0)
    n = w[l].copy()
    out = [None] * l
    for j in range(l - 1, -1, -1):
        a = n * (l + 1) / ((j + 1) * safe_o)
        b = w[j] * (l + 1) / (zi * (l - j)) if zi != 0 else np.zeros_like(n)
        n = np.where(hot, w[j] - a * zi * (l - j) / (l + 1), n)
        out[j] = np.where(hot, a, b)
    return d[:i] + d[i + 1:], z[:i] + z[i + 1:], o[:i] + o[i + 1:], out


def tree_shap_batch(X: np.ndarray, tree: dict, n_features: int) -> np.ndarray:
    """Contributions of one tree for a batch of rows (n_rows x n_features).

    Within a tree the recursion path (features, zero fractions) is the same
    for every row; only the 0/1 one fractions and the weights differ, so the
    recursion runs once per tree over arrays of rows.
    """
    n_rows = X.shape[0]
    phi = np.zeros((n_rows, n_features))
    left, right, feat, thr, cover, value = (tree[k] for k in ("left", "right", "feature", "threshold", "cover", "value"))

    def rec(j, d, z, o, w, pz, po, pi):
        d, z, o, w = _extend_v(d, z, o, w, pz, po, pi, n_rows)
        if left[j] < 0:
            for i in range(1, len(d)):
                _, _, _, uw = _unwind_v(d, z, o, w, i)
                phi[:, d[i]] += np.sum(uw, axis=0) * (o[i] - z[i]) * value[j]
            return
        f = feat[j]
        xv = X[:, f]
        goes_left = (~np.isnan(xv)) & (xv <= thr[j])
        iz, io = 1.0, np.ones(n_rows)
        if f in d[1:]:
            k = d.index(f, 1)
            iz, io = z[k], o[k]
            d, z, o, w = _unwind_v(d, z, o, w, k)
        rec(left[j], d, z, o, w, iz * cover[left[j]] / cover[j], io * goes_left, f)
        rec(right[j], d, z, o, w, iz * cover[right[j]] / cover[j], io * ~goes_left, f)

    rec(0, [], [], [], [], 1.0, 1.0, -1)
    return phi


def expected_value(tree: dict) -> float:
    """Cover-weighted mean of the leaf values."""
    leaves = tree["left"] < 0
    return float((tree["cover"][leaves] * tree["value"][leaves]).sum() / tree["cover"][0])


def contributions(df: DataFrame, trees: list[dict], features: list[str], id_col: str) -> DataFrame:
    """One row per input row: id, base_value, one contribution per feature, prediction."""
    spark = df.sparkSession
    bc = spark.sparkContext.broadcast(trees)
    nf = len(features)
    out_schema = T.StructType([df.schema[id_col], T.StructField("base_value", T.DoubleType())]
                              + [T.StructField(f"shap_{f}", T.DoubleType()) for f in features]
                              + [T.StructField("probability_1", T.DoubleType())])

    def explain(batches):
        ts = bc.value
        base = float(np.mean([expected_value(t) for t in ts]))
        for pdf in batches:
            x = pdf[features].to_numpy(dtype=float)
            phis = np.zeros((len(pdf), nf))
            if len(pdf):
                for t in ts:
                    phis += tree_shap_batch(x, t, nf)
                phis /= len(ts)
            out = pd.DataFrame({id_col: pdf[id_col].to_numpy(), "base_value": base})
            for k, f in enumerate(features):
                out[f"shap_{f}"] = phis[:, k]
            out["probability_1"] = base + phis.sum(axis=1)
            yield out

    return df.select(id_col, *features).mapInPandas(explain, out_schema)
