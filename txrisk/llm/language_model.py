"""Document scores by masked pseudo-likelihood (operator 5).

A small network with a window on both sides predicts every word from its
neighbours: the neighbours' vectors, weighted by their place, are summed and
squashed, and a two-step softmax (word class, then word in the class) gives the
probability of the hidden word. A document's score is the sum of the log
probabilities of all its words, each seen from both sides.

The most frequent words are predicted one by one. A rarer word's probability is
that of a rare word at its place times its own share among rare words, which its
spelling gives: a model of each byte after the two before it, counted over all
rare words of all documents. As neighbours, rare words stand in hashed buckets,
each with a vector of its own; their number follows the root of the distinct words.

Training runs where the data is: each task starts from the same parameters,
trains in numpy on all words of its partition, and hands on its parameters
weighted by its words; Spark averages them row by row with partial sums. So
what is gathered grows with the input, while the driver and every task hold one
model (about 300 KB and 68 bytes for each bucket) and the spelling (18 MB). The
vocabulary counts all documents.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import FOLD, Words, discard, fold_words, map_texts, quoted, slices, stored

CLASSES = 32
PER_CLASS = 64
VOCABULARY = CLASSES * PER_CLASS
#: Ids of a word outside the vocabulary, and of what lies beyond a text's ends.
OTHER, BEYOND = 0, 1
DIM = 16
REACH = 2
BATCH = 8192
#: Parameters stay within this bound, so that no exponential overflows.
BOUND = np.float32(4)
RATE = 0.15
FLUSH_WORDS = 200_000
SEED = 7
#: Buckets of rare words for the root of the distinct words.
BUCKETS = 16

#: Bytes of words as symbols; EDGE stands before and after a word.
SYMBOL = np.zeros(256, dtype=np.int32)
_IN_WORDS = [b for b in range(256) if FOLD[b] == b and b != 32]
EDGE = len(_IN_WORDS)
SYMBOLS = EDGE + 1
SYMBOL[:] = EDGE
SYMBOL[_IN_WORDS] = np.arange(EDGE)


def triples(words: Words) -> np.ndarray:
    """Code of (the two symbols before, symbol) at each byte of the words' buffer and its end.

    The places ``start`` to ``end`` of a word, both included, spell it with its end.
    """
    s = np.full(len(words.buf) + 3, EDGE, dtype=np.int32)
    s[2:-1] = SYMBOL[np.frombuffer(words.buf, dtype=np.uint8)]
    before = np.where(s[1:-1] == EDGE, EDGE, s[:-2])
    return (before * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:]


class Spelling:
    """Log probability of a rare word by its bytes, each after the two before it (Witten-Bell)."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray):
        n = np.zeros(SYMBOLS ** 3)
        n[codes] = counts
        n = n.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
        pairs = n.sum(0)
        p = (pairs.sum(0) + 1) / (pairs.sum() + SYMBOLS)
        for c in (pairs, n):
            kinds = np.maximum((c > 0).sum(-1, keepdims=True), 1)
            p = (c + kinds * p) / (c.sum(-1, keepdims=True) + kinds)
        # No word is empty.
        p[EDGE, EDGE, EDGE] = 0
        p[EDGE, EDGE] /= p[EDGE, EDGE].sum()
        with np.errstate(divide="ignore"):
            self.log = np.log(p, out=p).astype(np.float32).ravel()

    def of(self, words: Words, at: np.ndarray) -> np.ndarray:
        """Log probabilities of the words at ``at``."""
        if not len(at):
            return np.zeros(0)
        start, size = words.start[at], words.end[at] - words.start[at] + 1
        first = np.cumsum(size) - size
        place = np.arange(int(size.sum())) + np.repeat(start - first, size)
        return np.add.reduceat(self.log[triples(words)[place]].astype(float), first)


class Vocabulary(list):
    """The words with a probability of their own, most frequent first, and what is known of the others."""

    def __init__(self, words, buckets: int = 0, spelling: Spelling | None = None):
        super().__init__(words)
        self.buckets = buckets
        self.spelling = spelling or Spelling(np.zeros(0, dtype=np.int64), np.zeros(0))


def spelled(counts: DataFrame, known: list[str]) -> Spelling:
    """The spelling of all words of ``counts`` (word, n) that are not ``known``, each n times."""
    listed = counts.sparkSession.sparkContext.broadcast(set(known))

    def count(batches):
        total = np.zeros(SYMBOLS ** 3, dtype=np.int64)
        for b in batches:
            rare = [(w.encode(), n) for w, n in zip(*(c.to_pylist() for c in b.columns)) if w not in listed.value]
            if not rare:
                continue
            words = Words([w for w, _ in rare])
            times = np.zeros(len(words.buf) + 2, dtype=np.int64)
            n = np.array([n for _, n in rare], dtype=np.int64)
            times[words.start] += n
            times[words.end + 1] -= n
            code, where = np.unique(triples(words), return_inverse=True)
            total[code] += np.bincount(where, np.cumsum(times)[:-1], minlength=len(code)).astype(np.int64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["code", "n"])

    # At most one row for each triple of symbols comes back.
    found = counts.mapInArrow(count, "code int, n long").groupBy("code").agg(F.sum("n").alias("n")).toPandas()
    return Spelling(found["code"].to_numpy(dtype=np.int64), found["n"].to_numpy(dtype=np.int64))


def vocabulary(docs: DataFrame, text_col: str = "text", size: int = VOCABULARY - 2) -> Vocabulary:
    """The most frequent words of all documents, most frequent first (ties by word), and all others' spelling."""
    def count(batches):
        seen: Counter = Counter()

        def flush():
            out = pa.RecordBatch.from_arrays(
                [pa.array([w.decode("utf-8", "replace") for w in seen], pa.string()),
                 pa.array(list(seen.values()), pa.int64())], names=["word", "n"])
            seen.clear()
            return out
        for b in batches:
            texts = b.column(0)
            for lo, hi in slices(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
                for t in texts.slice(lo, hi - lo).to_pylist():
                    seen.update(fold_words(t or b""))
                if len(seen) > FLUSH_WORDS:
                    yield flush()
        yield flush()

    counts = stored(docs.select(quoted(text_col).cast("binary").alias("text"))
                    .mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
    words = [r[0] for r in counts.orderBy(F.desc("n"), "word").limit(size).select("word").collect()]
    rare = counts.count() - len(words)
    out = Vocabulary(words, math.ceil(BUCKETS * math.sqrt(rare)), spelled(counts, words))
    discard(counts)
    return out


class Ids:
    """Word ids by hash; as neighbours, words outside the vocabulary have the ids of their buckets."""

    def __init__(self, words: list[str], buckets: int = 0):
        h = Words([w.encode() for w in words]).hash
        order = np.argsort(h)
        self.buckets = buckets
        self.hash, self.id = h[order], (order + 2).astype(np.int64)

    def of(self, h: np.ndarray) -> np.ndarray:
        if not len(self.hash):
            return np.full(len(h), OTHER, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.hash, h), len(self.hash) - 1)
        return np.where(self.hash[at] == h, self.id[at], OTHER)

    def windows(self, texts: list) -> tuple[np.ndarray, np.ndarray, Words]:
        """Ids of all words, those of their neighbours (one column for each place), and the words."""
        words = Words(texts)
        ids = self.of(words.hash)
        seen = ids
        if self.buckets:
            seen = np.where(ids == OTHER, VOCABULARY + (words.hash % np.uint64(self.buckets)).astype(np.int64), ids)
        n = len(ids)
        near = np.full((n, 2 * REACH), BEYOND, dtype=np.uint16 if VOCABULARY + self.buckets < 1 << 16 else np.int32)
        for c, k in enumerate([*range(-REACH, 0), *range(1, REACH + 1)]):
            lo, hi = max(0, -k), min(n, n - k)
            if lo < hi:
                same = words.text[lo:hi] == words.text[lo + k:hi + k]
                near[lo:hi, c] = np.where(same, seen[lo + k:hi + k], BEYOND)
        return ids, near, words


class Window:
    """The network; all parameters are rows of one array, so that they can be averaged as rows."""

    ROWS = 2 * VOCABULARY + CLASSES + 2 * REACH + 1

    def __init__(self, rows: np.ndarray | None = None, buckets: int = 0):
        """New parameters with so many buckets, or given ``rows``."""
        if rows is None:
            rng = np.random.default_rng(SEED)
            rows = rng.normal(0, 0.1, (self.ROWS + buckets, DIM + 1)).astype(np.float32)
            rows[:, DIM] = 0
            rows[-1 - 2 * REACH:-1, :DIM] = 1
            rows[-1] = 0
        self.rows = rows
        self.step = np.zeros_like(rows)
        self.buckets = len(rows) - self.ROWS
        self.seen = VOCABULARY + self.buckets
        self.vector = rows[:self.seen, :DIM]
        self.word = rows[self.seen:self.seen + VOCABULARY]
        self.group = rows[self.seen + VOCABULARY:self.seen + VOCABULARY + CLASSES]
        self.place = rows[-1 - 2 * REACH:-1, :DIM]
        self.bias = rows[-1, :DIM]

    def hidden(self, near: np.ndarray) -> np.ndarray:
        total = np.broadcast_to(self.bias, (len(near), DIM)).copy()
        for k in range(near.shape[1]):
            # take copies whole rows, several times faster than an index does
            total += self.rows.take(near[:, k], axis=0)[:, :DIM] * self.place[k]
        return np.tanh(total, out=total)

    @staticmethod
    def by_class(ids: np.ndarray):
        """Order of words by class, and each class's range in that order."""
        group = (ids // PER_CLASS).astype(np.uint8)
        order = np.argsort(group, kind="stable")
        edge = np.searchsorted(group[order], np.arange(CLASSES + 1))
        return order, [(c, int(edge[c]), int(edge[c + 1])) for c in range(CLASSES) if edge[c] < edge[c + 1]]

    def log_probability(self, ids: np.ndarray, near: np.ndarray) -> np.ndarray:
        out = np.empty(len(ids))
        order, ranges = self.by_class(ids)
        for c, lo, hi in ranges:
            own = self.word[c * PER_CLASS:(c + 1) * PER_CLASS]
            for i in range(lo, hi, BATCH):
                at = order[i:min(hi, i + BATCH)]
                h = self.hidden(near.take(at, axis=0))
                groups = h @ self.group[:, :DIM].T + self.group[:, DIM]
                words = h @ own[:, :DIM].T + own[:, DIM]
                got = groups[:, c] + words[np.arange(len(at)), ids[at] % PER_CLASS]
                np.exp(groups, out=groups)
                np.exp(words, out=words)
                out[at] = got - np.log(groups.sum(1)) - np.log(words.sum(1))
        return out

    @staticmethod
    def sums(rows: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Sums of the runs of rows that begin at ``first``; runs of one row, the most, are only copied."""
        size = np.diff(first, append=len(rows))
        several = size > 1
        out = rows.take(first, axis=0)
        if several.any():
            of = size[several]
            out[several] = np.add.reduceat(rows.take(np.flatnonzero(np.repeat(several, size)), axis=0), np.cumsum(of) - of)
        return out

    def train(self, ids: np.ndarray, near: np.ndarray, scale: np.ndarray) -> None:
        """One step of Adagrad; ``scale`` holds the squared gradients so far."""
        order, ranges = self.by_class(ids)
        ids, near = ids[order], near.take(order, axis=0)
        h = self.hidden(near)
        step = self.step
        vector, word = step[:self.seen], step[self.seen:self.seen + VOCABULARY]
        group = step[self.seen + VOCABULARY:self.seen + VOCABULARY + CLASSES]
        inside = ids % PER_CLASS
        g = np.exp(h @ self.group[:, :DIM].T + self.group[:, DIM])
        g /= g.sum(1, keepdims=True)
        for c, a, b in ranges:
            g[a:b, c] -= 1
        back = g @ self.group[:, :DIM]
        group[:, :DIM] = g.T @ h
        group[:, DIM] = g.sum(0)
        for c, a, b in ranges:
            rows = slice(c * PER_CLASS, (c + 1) * PER_CLASS)
            own, seen = self.word[rows], h[a:b]
            g = np.exp(seen @ own[:, :DIM].T + own[:, DIM])
            g /= g.sum(1, keepdims=True)
            g[np.arange(b - a), inside[a:b]] -= 1
            back[a:b] += g @ own[:, :DIM]
            word[rows, :DIM] = g.T @ seen
            word[rows, DIM] = g.sum(0)
        back *= 1 - h * h
        step[-1, :DIM] = back.sum(0)
        for k in range(near.shape[1]):
            w = near[:, k]
            by_word = np.argsort(w, kind="stable")
            w = w[by_word]
            first = np.flatnonzero(np.append(True, w[1:] != w[:-1]))
            total = self.sums(back.take(by_word, axis=0), first)
            at = w[first]
            step[-1 - 2 * REACH + k, :DIM] = (total * self.rows.take(at, axis=0)[:, :DIM]).sum(0)
            total *= self.place[k]
            total += vector.take(at, axis=0)[:, :DIM]
            vector[at, :DIM] = total
        # Parameters that no word of the step meets have no gradient: they stay, whatever their number.
        met = np.zeros(len(step), dtype=bool)
        met[self.seen + VOCABULARY:] = True
        met[near] = True
        for c, _, _ in ranges:
            met[self.seen + c * PER_CLASS:self.seen + (c + 1) * PER_CLASS] = True
        met = np.flatnonzero(met)
        own = step.take(met, axis=0)
        step[met] = 0
        seen = scale.take(met, axis=0)
        seen += own * own
        scale[met] = seen
        seen += np.float32(1e-6)
        own *= np.float32(RATE)
        own /= np.sqrt(seen, out=seen)
        own = np.subtract(self.rows.take(met, axis=0), own, out=own)
        self.rows[met] = np.clip(own, -BOUND, BOUND, out=own)


def trained(docs: DataFrame, words: list[str], text_col: str = "text", rounds: int = 1) -> Window:
    """The network after ``rounds`` rounds of training over all documents and averaging."""
    spark = docs.sparkSession
    src = docs.select(quoted(text_col).cast("binary").alias("text"))
    model = Window(buckets=getattr(words, "buckets", 0))
    names = [f"v{i}" for i in range(DIM + 1)]
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast((list(words), model.rows))

        def train(batches, sent=sent):
            known, rows = sent.value
            model = Window(rows.copy())
            ids_of = Ids(known, model.buckets)
            scale = np.full_like(rows, 0.1)
            total = 0
            for b in batches:
                texts = b.column(0)
                for lo, hi in slices(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
                    ids, near, _ = ids_of.windows(texts.slice(lo, hi - lo).to_pylist())
                    total += len(ids)
                    for i in range(0, len(ids), BATCH):
                        model.train(ids[i:i + BATCH], near[i:i + BATCH], scale)
            if total:
                cols = [pa.array(np.arange(len(rows), dtype=np.int32)), pa.array(np.full(len(rows), total))]
                cols += [pa.array(model.rows[:, i]) for i in range(DIM + 1)]
                yield pa.RecordBatch.from_arrays(cols, names=["row", "n", *names])

        parts = src.mapInArrow(train, "row int, n long, " + ", ".join(f"{v} float" for v in names))
        mean = [(F.sum(F.col(v).cast("double") * F.col("n")) / F.sum("n")).alias(v) for v in names]
        found = parts.groupBy("row").agg(*mean).toPandas()
        rows = model.rows.copy()
        if len(found):
            rows[found["row"].to_numpy()] = found[names].to_numpy(dtype=np.float32)
        model = Window(rows)
        sent.unpersist()
    return model


def score(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None,
          words: list[str] | None = None, model: Window | None = None) -> DataFrame:
    """Columns ``keep`` (default: all) of each document with its pseudo-likelihood.

    New columns: ``n_words long``, ``log_likelihood double`` (the sum over all
    words; 0 without words) and ``mean_log_probability double`` (null without
    words). Without ``words`` and ``model`` they are made from the documents; a
    plain list of words spells every other word from even odds.

    One row for each input row, repeated rows too. A null or empty text has no
    words. Texts of any length are read whole. An empty table trains nothing and
    gives an empty result. Input columns named like new ones give way.
    """
    words = vocabulary(docs, text_col) if words is None else words
    words = words if isinstance(words, Vocabulary) else Vocabulary(words)
    model = trained(docs, words, text_col) if model is None else model
    sent = docs.sparkSession.sparkContext.broadcast((list(words), words.spelling, model.rows))

    def make():
        known, spelling, rows = sent.value
        net = Window(rows)
        ids_of = Ids(known, net.buckets)

        def compute(texts):
            ids, near, words = ids_of.windows(texts)
            of, log = words.text, net.log_probability(ids, near)
            rare = np.flatnonzero(ids == OTHER)
            log[rare] += spelling.of(words, rare)
            total = np.bincount(of, log, minlength=len(texts))
            return {"n_words": np.bincount(of, minlength=len(texts)).tolist(), "log_likelihood": total.tolist()}
        return compute

    out = map_texts(docs, text_col, docs.columns if keep is None else keep,
                    "n_words long, log_likelihood double", make)
    return out.withColumn("mean_log_probability", F.when(F.col("n_words") > 0,
                                                         F.col("log_likelihood") / F.col("n_words")))
