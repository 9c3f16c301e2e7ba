"""Quality classifier as a sparse ensemble of rules (operator 13).

Small decision trees over statistics of a text give rules: the conditions on the
way to a node, joined by "and". A lasso logistic regression over the rules'
truth values gives most of them no weight; the rest are compiled into one Spark
column expression, so scoring a table is a projection over its statistics.

Only texts enter the statistics. The trees and the lasso are fitted on a sample
of labelled rows of at most ``SAMPLE`` rows (the ids with the smallest hashes),
which one partition holds so that the fit does not depend on how a table is
partitioned. Statistics and scores cover every row and every whole text.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, Words, discard, map_texts, mix64, quoted, stored

#: Labelled rows that the model is fitted on, at most.
SAMPLE = 20_000
TREES, DEPTH, PENALTY, SEED = 24, 3, 0.001, 13
THRESHOLD = 0.3
HOLD_OUT = 5

STATISTICS = ("log_words", "word_length", "upper", "digits", "symbols", "exclaims", "marks", "bare", "distinct",
              "echoes", "top_word", "repeated_windows", "repeated_lines")
WINDOW = 4
#: Lines in place of words: newlines separate, spaces belong to them.
LINES = bytes(32 if b == 10 else 1 if b == 32 else b for b in range(256))
SYMBOLS = b"#*$%&|<>"


def _classes() -> np.ndarray:
    out = np.zeros(256, dtype=np.int64)
    for b in range(256):
        c = bytes([b])
        out[b] = (1 if c.isupper() else 2 if c.islower() else 3 if c.isdigit() else 4 if b == 32 or 9 <= b <= 13
                  else 5 if c in SYMBOLS else 6 if c == b"!" else 7 if 128 <= b < 192 else 8 if b >= 192 else 0)
    return out


CLASS = _classes()
UPPER, LOWER, DIGIT, BLANK, SYMBOL, EXCLAIM, INNER, LEAD = range(1, 9)


def _distinct(key: np.ndarray, of: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``n`` texts: how many different keys it has, and how often the most frequent one occurs."""
    both = mix64(key ^ mix64(of.astype(np.uint64) + np.uint64(1)))
    _, at, count = np.unique(both, return_index=True, return_counts=True)
    most = np.zeros(n, dtype=np.int64)
    np.maximum.at(most, of[at], count)
    return np.bincount(of[at], minlength=n), most


def _measure(texts: list) -> dict:
    texts = [t if t is not None else b"" for t in texts]
    n = len(texts)
    words = Words(texts, BLANKS)
    raw = CLASS[np.frombuffer(b" ".join(texts), dtype=np.uint8)]
    lengths = np.fromiter((len(t) for t in texts), dtype=np.int64, count=n)
    # The blank between two texts counts for the text before it; blanks are not used.
    owner = np.repeat(np.arange(n), lengths + 1)[:len(raw)]
    seen = np.bincount(owner * 9 + raw, minlength=9 * n).reshape(n, 9)
    counted = np.diff(words.first)
    per_word = np.maximum(counted, 1)
    letters = seen[:, UPPER] + seen[:, LOWER]
    chars = seen.sum(1) - seen[:, BLANK] - seen[:, INNER]
    lettered = np.isin(raw, (UPPER, LOWER, DIGIT, INNER, LEAD))
    inside = np.concatenate(([0], np.cumsum(lettered)))
    bare = np.bincount(words.text[inside[words.end] == inside[words.start]], minlength=n)
    kinds, top = _distinct(words.hash, words.text, n)
    echo = (words.hash[1:] == words.hash[:-1]) & (words.text[1:] == words.text[:-1])
    gram, whole = words.grams(WINDOW)
    at = words.text[:len(gram)][whole]
    windows = np.bincount(at, minlength=n)
    lines = Words([t.translate(LINES) for t in texts], bytes(range(256)))
    n_lines = np.diff(lines.first)
    return {
        "log_words": np.log1p(counted), "word_length": chars / per_word,
        "upper": seen[:, UPPER] / np.maximum(letters, 1), "digits": seen[:, DIGIT] / np.maximum(chars, 1),
        "symbols": seen[:, SYMBOL] / per_word, "exclaims": seen[:, EXCLAIM] / per_word, "marks": seen[:, 0] / per_word,
        "bare": bare / per_word, "distinct": kinds / per_word,
        "echoes": np.bincount(words.text[1:][echo], minlength=n) / per_word, "top_word": top / per_word,
        "repeated_windows": (windows - _distinct(gram[whole], at, n)[0]) / np.maximum(windows, 1),
        "repeated_lines": (n_lines - _distinct(lines.hash, lines.text, n)[0]) / np.maximum(n_lines, 1),
    }


def statistics(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with the columns ``STATISTICS`` of each whole text; a null or empty text has zeros."""
    new = ", ".join(f"{c} double" for c in STATISTICS)
    return map_texts(docs, text_col, docs.columns if keep is None else keep, new, lambda: _measure)


def held_out(doc_id: Column) -> Column:
    """Whether a row's label must not be learnt: one id in five, by its checksum. A null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HOLD_OUT == 0, F.lit(True))


#: A condition: statistic, whether it lies above the bound, bound.
Condition = tuple[str, bool, float]


def condition(c: Condition) -> Column:
    return F.col(c[0]) > c[2] if c[1] else F.col(c[0]) <= c[2]


def rule(conditions: tuple[Condition, ...]) -> Column:
    out = condition(conditions[0])
    for c in conditions[1:]:
        out = out & condition(c)
    return out


def tree_rules(model) -> list[tuple[Condition, ...]]:
    """The rules of all nodes below the roots of a forest's trees, each once, with the narrowest bound of a statistic."""
    found = set()

    def walk(node, above: dict):
        if above:
            found.add(tuple(sorted((f, up, t) for (f, up), t in above.items())))
        if node.subtreeDepth() == 0:
            return
        split = node.split()
        name, t = STATISTICS[split.featureIndex()], float(split.threshold())
        low, high = above.get((name, False)), above.get((name, True))
        walk(node.leftChild(), {**above, (name, False): t if low is None else min(low, t)})
        walk(node.rightChild(), {**above, (name, True): t if high is None else max(high, t)})

    for tree in model.trees:
        walk(tree._java_obj.rootNode(), {})
    return sorted(found)


@dataclass
class RuleModel:
    """Rules with their weights (those that the lasso gave any), and the intercept."""

    intercept: float
    rules: list[tuple[tuple[Condition, ...], float]] = field(default_factory=list)

    def score(self) -> Column:
        """The probability of label 1 as a column over ``STATISTICS``."""
        z = F.lit(self.intercept)
        for conditions, weight in self.rules:
            z = z + F.when(rule(conditions), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))

    def texts(self) -> list[str]:
        """The rules in words, the weightiest first."""
        return [f"{w:+.3f} if " + " and ".join(f"{n} {'>' if up else '<='} {t:.4g}" for n, up, t in c)
                for c, w in sorted(self.rules, key=lambda r: -abs(r[1]))]


def labelled(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text",
             sample: int = SAMPLE) -> DataFrame:
    """(label, statistics) of at most ``sample`` rows whose labels may be learnt, in one partition.

    Of several labels of an id the highest counts; ids and labels that are null
    are not learnt.
    """
    given = labels.select(quoted(id_col).alias("id"), quoted(label).cast("double").alias("label")) \
        .where(F.col("label").isNotNull() & ~held_out(F.col("id")))
    chosen = given.groupBy("id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("id"), "id").limit(sample)
    # At most ``sample`` ids: a bounded side. Documents that share an id could be more, hence the second bound.
    rows = docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text")).join(F.broadcast(chosen), "id")
    order = [F.xxhash64("id"), "id", *STATISTICS]
    return statistics(rows, keep=["id", "label"]).orderBy(*order).limit(sample).coalesce(1).select("label", *STATISTICS)


def fit(rows: DataFrame, trees: int = TREES, depth: int = DEPTH, penalty: float = PENALTY, seed: int = SEED) -> RuleModel:
    """Rules from trees, weights from a lasso, both over ``labelled`` rows.

    Without labelled rows every score is 0.5; with labels of one kind alone, it
    is the share of that kind, drawn towards 0.5 by one row of either kind.
    """
    rows = stored(rows, "labelled")
    one, n = rows.agg(F.coalesce(F.sum("label"), F.lit(0.0)), F.count(F.lit(1))).first()
    if one == 0 or one == n:
        share = (one + 1) / (n + 2)
        discard(rows)
        return RuleModel(float(np.log(share / (1 - share))))
    table = VectorAssembler(inputCols=list(STATISTICS), outputCol="features").transform(rows).coalesce(1)
    forest = RandomForestClassifier(labelCol="label", featuresCol="features", numTrees=trees, maxDepth=depth, seed=seed,
                                    maxBins=64, featureSubsetStrategy="sqrt").fit(table)
    rules = tree_rules(forest)
    truth = rows.coalesce(1).select("label", array_to_vector(F.array(*[rule(r).cast("double") for r in rules])).alias("features"))
    lasso = LogisticRegression(labelCol="label", featuresCol="features", elasticNetParam=1.0, regParam=penalty, maxIter=60, tol=1e-4).fit(truth)
    weights = lasso.coefficients.toArray()
    discard(rows)
    return RuleModel(float(lasso.intercept), [(r, float(w)) for r, w in zip(rules, weights) if w != 0.0])


def scored(docs: DataFrame, model: RuleModel, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None,
           threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with held_out, score and predicted.

    Every row is scored, empty and null texts by their zeros; repeated rows get
    equal scores. An input column named like a new one gives way to it.
    """
    keep = docs.columns if keep is None else keep
    new = ("held_out", "score", "predicted")
    held = docs.select(F.struct(*[quoted(c) for c in keep]).alias("document"), quoted(id_col).alias("id"),
                       quoted(text_col).alias("body"))
    found = statistics(held, "body", ["document", "id"]).withColumn("score", model.score())
    old = [F.col("document").getField(c).alias(c) for c in keep if c.lower() not in new]
    return found.select(*old, held_out(F.col("id")).alias("held_out"), "score",
                        (F.col("score") >= threshold).cast("int").alias("predicted"))


def classified(docs: DataFrame, labels: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``scored`` by the rules that ``docs`` and ``labels`` (doc_id, quality) give."""
    return scored(docs, fit(labelled(docs, labels)), keep=keep)
