"""Substring deduplication by sliding sentence spans (operator 10).

A text is cut into sentences: at line ends, and between two words where a mark
of ``.!?`` and later a blank stand, whatever signs are beside them (so that a
copy with signs strewn in has the same sentences). Every run of several
consecutive sentences (at least two, with at least ``MIN_WORDS`` words, as short
as that allows, from each sentence on and up to each sentence) is hashed and
joined over all texts.
The run's first occurrence stays; sentences covered by any other occurrence are
removed. Runs are taken in both directions so that a repeated passage is
covered from its first to its last sentence.

Scale: a run's occurrences are summed up to their first place before they are
shuffled, and only runs met twice join back; a passage that a third of the
corpus shares is a hot key of that join, which adaptive execution splits. A
Bloom filter of the repeated runs, of fixed size (8 MB), keeps most other runs
out of the join; it only saves shuffling. Hashes have 128 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BitFilter, Words, beside, map_texts, mix64, quoted, signed, stored

MIN_WORDS = 20
MIN_SENTENCES = 2
#: A sentence of more words is cut at every word whose hash is a multiple of
#: CUT, so that the parts are the same wherever a passage stands in it.
SENTENCE_WORDS = 25
CUT = np.uint64(8)
#: log2 of the filter's bits: 8 MB.
FILTER_BITS = 26

ENDS = np.isin(np.arange(256), list(b".!?"))
BLANK = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])
BASES = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F))


def inverse(base: np.uint64) -> np.uint64:
    """Of an odd number modulo 2**64."""
    return np.uint64(pow(int(base), -1, 1 << 64))


class Sentences:
    """Sentences and runs of some texts; all places count from the start of the slice."""

    def __init__(self, texts: list):
        self.words = w = Words(texts)
        # As Words lays texts out; a line end also parts two texts.
        raw = np.frombuffer(b"\n".join(t or b"" for t in texts), dtype=np.uint8)
        self.first = np.zeros(0, dtype=np.int64)  # first word of each sentence
        if w.n:
            ends, blanks, lines = (np.flatnonzero(x) for x in (ENDS[raw], BLANK[raw], raw == 10))
            lo, hi = w.end[:-1], w.start[1:]
            mark = np.append(ends, len(raw))[np.searchsorted(ends, lo)]
            blank, line = (np.append(-1, x)[np.searchsorted(x, hi)] for x in (blanks, lines))
            new = np.append(True, (line >= lo) | (mark < blank))
            first = np.flatnonzero(new)
            size = np.diff(np.append(first, w.n))
            self.first = np.flatnonzero(new | (np.repeat(size, size) > SENTENCE_WORDS) & (w.hash % CUT == 0))
        self.end = np.append(self.first[1:], w.n)
        self.text = w.text[self.first]
        self.of_text = np.searchsorted(self.text, np.arange(len(texts) + 1))

    def runs(self) -> tuple[np.ndarray, np.ndarray]:
        """First and last sentence of each run, without repeats."""
        n, span = len(self.first), MIN_SENTENCES - 1
        i = np.arange(n)
        last = np.maximum(i + span, np.searchsorted(self.end, self.first + MIN_WORDS))
        ahead = last < n
        ahead[ahead] = self.text[last[ahead]] == self.text[i[ahead]]
        first = np.minimum(i - span, np.searchsorted(self.first, self.end - MIN_WORDS, side="right") - 1)
        back = first >= 0
        back[back] = self.text[first[back]] == self.text[i[back]]
        pairs = np.unique(np.concatenate((i[ahead] * (n + 1) + last[ahead], first[back] * (n + 1) + i[back])))
        return pairs // (n + 1), pairs % (n + 1)

    def hashes(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two 64-bit hashes of the words from sentence a to sentence b."""
        lo, hi = self.first[a], self.end[b]
        out = []
        for base in BASES:
            power = np.full(self.words.n + 1, base, dtype=np.uint64)
            back = np.full(self.words.n + 1, inverse(base), dtype=np.uint64)
            power[0] = back[0] = 1
            power, back = np.cumprod(power), np.cumprod(back)
            total = np.concatenate(([np.uint64(0)], np.cumsum(mix64(self.words.hash ^ base) * power[:-1])))
            out.append(mix64((total[hi] - total[lo]) * back[lo] + (hi - lo).astype(np.uint64)))
        return out[0], out[1]

    def again(self, a: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Which runs (in order of a) repeat an earlier run of their own text."""
        key = h ^ mix64(self.text[a].astype(np.uint64) + np.uint64(1))
        order = np.argsort(key, kind="stable")
        out = np.zeros(len(a), dtype=bool)
        out[order[1:]] = key[order][1:] == key[order][:-1]
        return out


def run_rows(base: DataFrame, repeated=None) -> DataFrame:
    """(h1, h2, ord, rid, a, b): the first occurrence of each run in each text.

    With ``repeated`` (a broadcast filter), only runs whose h1 passes it.
    """
    src = base.select("rid", "ord", F.col("text").cast("binary").alias("text"))

    def make():
        passes = repeated.value.passes if repeated is not None else None

        def compute(texts):
            s = Sentences(texts)
            a, b = s.runs()
            h1, h2 = s.hashes(a, b)
            new = ~s.again(a, h1)
            if passes is not None:
                new &= passes(h1)
            a, b, h1, h2 = a[new], b[new], h1[new], h2[new]
            text = s.text[a]
            at = np.searchsorted(text, np.arange(len(texts) + 1))
            base_of = s.of_text[text]
            runs = pa.StructArray.from_arrays(
                [pa.array(signed(h1)), pa.array(signed(h2)), pa.array((a - base_of).astype(np.int32)),
                 pa.array((b - base_of).astype(np.int32))], names=["h1", "h2", "a", "b"])
            return {"runs": pa.ListArray.from_arrays(pa.array(at, pa.int32()), runs)}
        return compute

    rows = map_texts(src, "text", ["rid", "ord"], "runs array<struct<h1:long,h2:long,a:int,b:int>>", make)
    return rows.select("rid", "ord", F.explode("runs").alias("r")).select("r.h1", "r.h2", "ord", "rid", "r.a", "r.b")


def dedup(docs: DataFrame, text_col: str = "text", order_col: str = "doc_id",
          keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (default: all) of each document with what is left of its text.

    New columns: ``clean string``, ``n_sentences long``, ``removed array<int>``
    (places of removed sentences, from 0) and ``n_removed long``.

    The first occurrence of a run is the one in the row with the smallest
    ``order_col`` (null last; equal values in the order in which Spark read the
    rows), leftmost within a text. One row for each input row; of repeated rows
    the first keeps its sentences. A null or empty text has no sentences and an
    empty ``clean``. Words are compared with A-Z in lower case and without
    punctuation; texts with fewer than MIN_WORDS words or MIN_SENTENCES sentences
    have no run. A sentence goes with the space up to the next one; the rest of
    the text stays as it is. Input columns named like new ones give way.
    """
    keep = docs.columns if keep is None else keep
    base = stored(docs.select(
        F.struct(*[quoted(c) for c in keep]).alias("doc"), quoted(text_col).alias("text"),
        quoted(order_col).alias("ord"), F.monotonically_increasing_id().alias("rid")), "sentences")
    place = F.struct(F.col("ord").isNull().alias("last"), "ord", "rid")
    firsts = run_rows(base).groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")) \
        .where("n > 1").select("h1", "h2", F.col("first.rid").alias("first_rid"))
    firsts = stored(firsts, "repeated")
    repeated = base.sparkSession.sparkContext.broadcast(BitFilter(firsts.select("h1"), FILTER_BITS))
    covered = run_rows(base, repeated).drop("ord").join(firsts, ["h1", "h2"]).where("rid <> first_rid")
    gone = covered.groupBy("rid").agg(F.collect_set(F.struct("a", "b")).alias("spans"))
    joined = base.join(gone, "rid", "left").select("doc", "text", "spans")

    def make():
        def compute(texts, spans):
            s = Sentences(texts)
            a, b = s.runs()
            mine = s.again(a, s.hashes(a, b)[0])
            edge = np.zeros(len(s.first) + 1, dtype=np.int64)
            np.add.at(edge, a[mine], 1)
            np.add.at(edge, b[mine] + 1, -1)
            for t, found in enumerate(spans):
                if found:
                    at = np.array([(x["a"], x["b"]) for x in found]) + s.of_text[t]
                    np.add.at(edge, at[:, 0], 1)
                    np.add.at(edge, at[:, 1] + 1, -1)
            drop = np.cumsum(edge[:-1]) > 0
            clean, removed = [], []
            offset = 0
            for t, text in enumerate(texts):
                text = text or b""
                lo, hi = int(s.of_text[t]), int(s.of_text[t + 1])
                gone = np.flatnonzero(drop[lo:hi])
                removed.append(gone.astype(np.int32))
                if len(gone):
                    start = s.words.start[s.first[lo:hi]] - offset
                    start[0] = 0
                    stop = np.append(start[1:], len(text))
                    clean.append(b"".join(text[start[i]:stop[i]] for i in np.flatnonzero(~drop[lo:hi])))
                else:
                    clean.append(text)
                offset += len(text) + 1
            return {"clean": pa.array([c.decode("utf-8", "replace") for c in clean], pa.string()),
                    "n_sentences": np.diff(s.of_text).tolist(), "removed": removed}
        return compute

    out = map_texts(joined, "text", ["doc"], "clean string, n_sentences long, removed array<int>", make, args=["spans"])
    out = out.withColumn("n_removed", F.size("removed").cast("long"))
    return out.select(*beside("doc", keep, ["clean", "n_sentences", "removed", "n_removed"]))
