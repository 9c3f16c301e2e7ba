"""Quality rules by distribution divergence (operator 9).

A document is compared with the reference of its language: the histogram of its
character classes and that of the language's most common words, each by the
Jensen-Shannon distance. Short texts are noisy, so each test has a minimum
length and the word test a margin that shrinks with the square root of the
length. Counting rules (short texts, repeated 8-word windows) come first.

The references are counted over the whole corpus, one for each value of the
language column with enough words: each task counts classes and words by
language and hands on partial sums, Spark adds them up, and only the most common
words are kept. What is sent to the tasks follows the number of languages:
languages x (classes + words). Then one map over whole texts judges every row
by itself. A row without language is held against the nearest reference; a
language with too few words for a reference takes no distribution test.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import BLANKS, Words, fold_words, map_texts, mix64, quoted, slices

#: Words of a language, over all documents, from which it has a reference.
REFERENCE_WORDS = 2000
COMMON_WORDS = 100
#: Distinct words that a task counts before it hands on partial sums.
FLUSH_WORDS = 200_000

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
REPEAT_WINDOW = 8
CLASS_MIN_WORDS = 50
CLASS_DISTANCE = 0.32
WORD_MIN_WORDS = 100
WORD_DISTANCE = 0.38
WORD_MARGIN = 0.8

SYMBOLS = b"#*$%&|<>"


def _class_of(b: int) -> int:
    c = chr(b)
    if b >= 128:
        return 0
    if c.islower():
        return 1
    if c.isupper():
        return 2
    if c.isdigit():
        return 3
    if c == "\n":
        return 4
    if c.isspace():
        return 5
    return 6 if c in ".,;:!?'\"()-" else 7


CLASSES = 8
CLASS = np.array([_class_of(b) for b in range(256)])
IS_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))
#: A byte that begins a character of a word.
IN_WORD = np.array([b != 32 and not 9 <= b <= 13 and b & 0xC0 != 0x80 for b in range(256)])


def per_text(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """All bytes, and the text that each belongs to."""
    raw = np.frombuffer(b"".join(t or b"" for t in texts), dtype=np.uint8)
    return raw, np.repeat(np.arange(len(texts)), [len(t) if t else 0 for t in texts])


def class_histograms(texts: list) -> np.ndarray:
    raw, of = per_text(texts)
    return np.bincount(of * CLASSES + CLASS[raw], minlength=len(texts) * CLASSES).reshape(-1, CLASSES)


def repeat_words(words: Words, texts: int, width: int = REPEAT_WINDOW) -> np.ndarray:
    """Words of each text in windows that occur twice or more in it."""
    gram, inside = words.grams(width)
    at = np.flatnonzero(inside)
    if not len(at):
        return np.zeros(texts, dtype=np.int64)
    key = gram[at] ^ mix64(words.text[at].astype(np.uint64) + np.uint64(1))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    again = np.zeros(len(at), dtype=bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    edge = np.zeros(words.n + 1, dtype=np.int64)
    np.add.at(edge, at[again], 1)
    np.add.at(edge, at[again] + width, -1)
    return np.bincount(words.text[np.cumsum(edge[:-1]) > 0], minlength=texts)


def dup_lines(text: bytes | None) -> int:
    if not text:
        return 0
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def base_counts(texts: list) -> dict[str, np.ndarray]:
    """The counting rules' figures; words here are runs without ASCII white space."""
    raw, of = per_text(texts)
    words = Words(texts, BLANKS)
    n = len(texts)
    return {
        "n_words": np.diff(words.first),
        "word_chars": np.bincount(of[IN_WORD[raw]], minlength=n),
        "n_symbols": np.bincount(of[IS_SYMBOL[raw]], minlength=n),
        "n_dup_lines": np.array([dup_lines(t) for t in texts], dtype=np.int64),
        "n_repeat_words": repeat_words(words, n),
    }


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (base 2) of the rows of p and q; 0 where a row is empty."""
    total = p.sum(1, keepdims=True)
    p = p / np.maximum(total, 1)
    q = q / np.maximum(q.sum(1, keepdims=True), 1)
    m = (p + q) / 2

    def kl(a):
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(a > 0, a * np.log2(a / m), 0.0).sum(1)
    return np.where(total[:, 0] > 0, np.sqrt(np.maximum(0, (kl(p) + kl(q)) / 2)), 0.0)


class References:
    """Class and common-word histograms of each language, in fixed-size arrays."""

    def __init__(self, classes: dict[str, np.ndarray], words: dict[str, dict[str, int]], totals: dict[str, int]):
        self.names = sorted(totals)
        self.place = {x: i for i, x in enumerate(self.names)}
        self.classes = np.array([classes.get(x, np.zeros(CLASSES)) for x in self.names], dtype=float).reshape(-1, CLASSES)
        union = sorted({w for x in words.values() for w in x})
        own = Words([w.encode() for w in union])
        order = np.argsort(own.hash)
        self.hashes = own.hash[order]
        place = {union[i]: r for r, i in enumerate(order.tolist())}
        self.words = np.zeros((len(self.names), COMMON_WORDS + 1))
        # Where the union's words stand in each language's histogram; last: any other word.
        self.slot = np.full((len(self.names), len(union) + 1), COMMON_WORDS, dtype=np.uint8)
        for i, x in enumerate(self.names):
            for j, (w, n) in enumerate(sorted(words.get(x, {}).items(), key=lambda e: (-e[1], e[0]))):
                self.words[i, j] = n
                self.slot[i, place[w]] = j
            self.words[i, COMMON_WORDS] = totals.get(x, 0) - self.words[i].sum()

    def distances(self, texts: list, langs: list) -> tuple[np.ndarray, np.ndarray]:
        """Class and word distance of each text to its reference, without language to the
        nearest (each distance by itself); NaN where there is none."""
        words = Words(texts)
        at = np.searchsorted(self.hashes, words.hash)
        known = np.append(self.hashes, np.uint64(0))[at] == words.hash
        known &= at < len(self.hashes)
        at = np.where(known, at, len(self.hashes))
        classes = class_histograms(texts).astype(float)
        out = np.full((2, len(texts)), np.nan)

        def against(rows: np.ndarray, ref: np.ndarray) -> np.ndarray:
            """Distances of the texts ``rows`` to the references ``ref``."""
            row = np.full(len(texts), -1)
            row[rows] = np.arange(len(rows))
            mine = row[words.text]
            own = np.flatnonzero(mine >= 0)
            mine = mine[own]
            slot = self.slot[ref[mine], at[own]].astype(np.int64)
            seen = np.bincount(mine * (COMMON_WORDS + 1) + slot, minlength=len(rows) * (COMMON_WORDS + 1))
            return np.array([distance(classes[rows], self.classes[ref]),
                             distance(seen.reshape(-1, COMMON_WORDS + 1).astype(float), self.words[ref])])

        ref = np.array([-1 if x is None else self.place.get(x, -1) for x in langs], dtype=np.int64)
        rows = np.flatnonzero(ref >= 0)
        if len(rows):
            out[:, rows] = against(rows, ref[rows])
        rows = np.array([i for i, x in enumerate(langs) if x is None], dtype=np.int64)
        if len(rows):
            for k in range(len(self.names)):
                out[:, rows] = np.fmin(out[:, rows], against(rows, np.full(len(rows), k)))
        return out[0], out[1]


def references(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> References:
    """Counts over all documents; the driver gets languages x (classes + words + 1) rows."""
    def count(batches):
        classes: Counter = Counter()
        words: Counter = Counter()

        def flush():
            rows = [(k[0], "c", str(k[1]), n) for k, n in classes.items()]
            rows += [(k[0], "w", k[1].decode("utf-8", "replace"), n) for k, n in words.items()]
            rows += [(lang, "t", "", sum(n for k, n in words.items() if k[0] == lang)) for lang in {k[0] for k in words}]
            classes.clear()
            words.clear()
            return pa.RecordBatch.from_pylist(
                [dict(zip(names, r)) for r in rows],
                schema=pa.schema([("lang", pa.string()), ("kind", pa.string()), ("key", pa.string()), ("n", pa.int64())]))

        names = ["lang", "kind", "key", "n"]
        for b in batches:
            texts, langs = b.columns
            for lo, hi in slices(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
                for text, lang in zip(texts.slice(lo, hi - lo).to_pylist(), langs.slice(lo, hi - lo).to_pylist()):
                    if not text or lang is None:
                        continue
                    for c, n in enumerate(class_histograms([text])[0].tolist()):
                        if n:
                            classes[lang, c] += n
                    for w, n in Counter(fold_words(text)).items():
                        words[lang, w] += n
                if len(words) > FLUSH_WORDS:
                    yield flush()
        yield flush()

    part = docs.select(quoted(text_col).cast("binary").alias("text"), quoted(lang_col).cast("string").alias("lang")) \
        .mapInArrow(count, "lang string, kind string, key string, n long")
    by_lang = part.groupBy("lang", "kind", "key").agg(F.sum("n").alias("n"))
    rank = Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "key")
    top = by_lang.withColumn("r", F.row_number().over(rank)).where(F.col("r") <= COMMON_WORDS).drop("r")
    total = F.max(F.when(F.col("kind") == "t", F.col("n"))).over(Window.partitionBy("lang"))
    top = top.withColumn("total", total).where(F.col("total") >= REFERENCE_WORDS)
    classes: dict = {}
    words: dict = {}
    totals: dict = {}
    for lang, kind, key, n in top.select("lang", "kind", "key", "n").collect():
        if kind == "t":
            totals[lang] = n
        elif kind == "w":
            words.setdefault(lang, {})[key] = n
        else:
            classes.setdefault(lang, np.zeros(CLASSES))[int(key)] = n
    return References(classes, words, totals)


def judged(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", keep: list[str] | None = None,
           refs: References | None = None) -> DataFrame:
    """Columns ``keep`` (default: all) of each document with its figures and verdict.

    New columns: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words
    (long), base_failed (boolean), class_distance, word_distance (double), kept
    (boolean). One row for each input row, repeated rows too. A null or empty
    text has no words and fails the counting rules. A null language is held
    against the nearest reference. A language with fewer than ``REFERENCE_WORDS``
    words in all documents has no reference: its distances are null and only the
    counting rules judge it, as do those without language if no language has a
    reference. Texts of any length are read whole; input columns named like new ones give way. An empty table gives an
    empty result.
    """
    refs = references(docs, text_col, lang_col) if refs is None else refs
    sent = docs.sparkSession.sparkContext.broadcast(refs)

    def make():
        ref = sent.value

        def compute(texts, langs):
            out = base_counts(texts)
            n = out["n_words"]
            out["class_distance"], out["word_distance"] = ref.distances(texts, langs)
            out["base_failed"] = (n < MIN_WORDS) | (100 * out["n_repeat_words"] > MAX_REPEAT_PERCENT * n)
            odd = (n >= CLASS_MIN_WORDS) & (out["class_distance"] > CLASS_DISTANCE)
            odd |= (n >= WORD_MIN_WORDS) & (
                out["word_distance"] > WORD_DISTANCE + WORD_MARGIN / np.sqrt(np.maximum(n, 1)))
            out["kept"] = ~out["base_failed"] & ~odd
            return {k: pa.array(v, from_pandas=k.endswith("distance")) for k, v in out.items()}
        return compute

    return map_texts(docs, text_col, docs.columns if keep is None else keep,
                     "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
                     "base_failed boolean, class_distance double, word_distance double, kept boolean",
                     make, args=[lang_col])
