"""Benchmark decontamination by winnowing (operator 1).

Both sides are fingerprinted alike: of the k-gram hashes in every sliding
window the smallest (leftmost) is kept, so two texts that share ``span``
consecutive words share a kept k-gram inside them. Fingerprints are joined on
their hash; each hit is extended word by word to both sides, and a run of at
least ``span`` equal words is a leak. An item of fewer words is one
fingerprint by itself, looked up at every place of a document.

Scale: documents are read once; a fingerprint leaves its task only if a Bloom
filter of the benchmark's fingerprints lets it pass. The filter has a fixed
size (2 MB) whatever the benchmark has, so it may be sent to every task; it
only saves shuffling, the join decides. A passage that a third of the corpus
shares is a hot join key on the document side alone, which adaptive execution
splits.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import BitFilter, Words, beside, map_texts, quoted, signed, stored

SPAN = 10
KGRAM = 5
#: log2 of the filter's bits: 2 MB.
FILTER_BITS = 24

CAND = "cands array<struct<pos:long,width:int,hash:long,ctx:array<string>>>"


def selected(words: Words, span: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the k-grams that winnowing keeps."""
    gram, _ = words.grams(k)
    m = max(0, words.n - span + 1)
    if not m:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    best, place = gram[:m].copy(), np.arange(m)
    for j in range(1, span - k + 1):
        lower = gram[j:j + m] < best
        best[lower] = gram[j:j + m][lower]
        place[lower] = np.flatnonzero(lower) + j
    inside = words.text[:m] == words.text[span - 1:span - 1 + m]
    at = np.unique(place[inside])
    return at, gram[at]


def context(words: Words, at: int, span: int, k: int) -> list[str]:
    """The k-gram with the words up to ``span - k`` places around it in its text ('' beyond it)."""
    lo, hi = words.first[words.text[at]], words.first[words.text[at] + 1]
    return [words.word(i).decode("utf-8", "replace") if lo <= i < hi else ""
            for i in range(at - (span - k), at + span)]


def candidates(words: Words, texts: int, span: int, k: int, short_widths: list[int], keep) -> list[list]:
    """Fingerprints that ``keep(hashes)`` lets pass, as one list for each text."""
    at, hashes = selected(words, span, k)
    ok = keep(hashes)
    parts = [(at[ok], hashes[ok], span)]
    for width in short_widths:
        gram, inside = words.grams(width, seed=1000)
        ok = inside.copy()
        ok[ok] = keep(gram[ok])
        parts.append((np.flatnonzero(ok), gram[ok], width))
    rows: list[list] = [[] for _ in range(texts)]
    for places, found, width in parts:
        for i, h in zip(places.tolist(), signed(found).tolist()):
            t = int(words.text[i])
            ctx = context(words, i, span, k) if width == span else \
                [words.word(j).decode("utf-8", "replace") for j in range(i, i + width)]
            rows[t].append({"pos": i - int(words.first[t]), "width": width, "hash": h, "ctx": ctx})
    return rows


def fingerprints(bench: DataFrame, item_col: str, text_col: str, span: int, k: int) -> DataFrame:
    """(item, width, hash, ctx) of every fingerprint of every item."""
    def make():
        def compute(texts):
            words = Words(texts)
            size = np.diff(words.first)
            rows = candidates(words, len(texts), span, k, [], lambda h: np.ones(len(h), bool))
            for t in np.flatnonzero((size > 0) & (size < span)).tolist():
                lo, width = int(words.first[t]), int(size[t])
                own = Words([texts[t]])
                gram, _ = own.grams(width, seed=1000)
                rows[t] = [{"pos": 0, "width": width, "hash": int(signed(gram)[0]),
                            "ctx": [words.word(j).decode("utf-8", "replace") for j in range(lo, lo + width)]}]
            return {"cands": rows}
        return compute

    items = map_texts(bench.select(quoted(item_col).alias("item"), quoted(text_col).alias("text")),
                      "text", ["item"], CAND, make)
    return items.select("item", F.explode("cands").alias("c")).select(
        "item", F.col("c.width").alias("width"), F.col("c.hash").alias("hash"), F.col("c.ctx").alias("ctx"))


def leaks(docs: DataFrame, bench: DataFrame, text_col: str = "text", keep: list[str] | None = None,
          item_col: str = "item_id", item_text_col: str = "text", span: int = SPAN, k: int = KGRAM) -> DataFrame:
    """Columns ``keep`` (default: all) of each document with what it shares with the benchmark.

    New columns: ``n_words long``, ``n_hit long`` (words inside any occurrence of
    an item's window of ``span`` words, or of a whole shorter item), ``items
    array<string>`` (distinct ids with such windows, sorted as strings) and
    ``spans array<struct<from:long,to:long>>`` (the hit runs found, ``to``
    excluded; they may overlap).

    One row for each input row; repeated rows and repeated ids are judged each
    for itself. A null or empty text has no words; a null or wordless item has no
    windows; an item without an id marks words but is not listed. An empty
    benchmark leaves every document clean. Input columns named like new ones
    give way.
    """
    spark = docs.sparkSession
    keep = docs.columns if keep is None else keep
    prints = stored(fingerprints(bench, item_col, item_text_col, span, k), "prints")
    bits = spark.sparkContext.broadcast(BitFilter(prints.select("hash"), FILTER_BITS))
    # At most span - 1 widths.
    short = sorted(r[0] for r in prints.where(F.col("width") < span).select("width").distinct().collect())

    def make():
        passes = bits.value.passes

        def compute(texts):
            words = Words(texts)
            return {"n_words": np.diff(words.first).tolist(),
                    "cands": candidates(words, len(texts), span, k, short, passes)}
        return compute

    src = docs.select(F.struct(*[quoted(c) for c in keep]).alias("doc"), quoted(text_col).alias("text"))
    base = stored(map_texts(src, "text", ["doc"], "n_words long, " + CAND, make)
                  .withColumn("rid", F.monotonically_increasing_id()), "leaks")

    cand = base.select("rid", F.explode("cands").alias("d")).select(
        "rid", F.col("d.pos").alias("pos"), F.col("d.width").alias("width"), F.col("d.hash").alias("hash"),
        F.col("d.ctx").alias("doc_ctx"))
    met = cand.join(prints.withColumnRenamed("ctx", "item_ctx"), ["hash", "width"])
    reach = span - k

    def same(i):
        a, b = F.col("doc_ctx")[i], F.col("item_ctx")[i]
        return (a == b) & (a != "")

    def run(places):
        total, alive = F.lit(0), F.lit(True)
        for i in places:
            alive = alive & same(i)
            total = total + alive.cast("int")
        return total

    middle = F.lit(True)
    for i in range(reach, reach + k):
        middle = middle & same(i)
    whole = met.where(F.col("width") < span).where(F.col("doc_ctx") == F.col("item_ctx")).select(
        "rid", "item", F.col("pos").alias("from"), (F.col("pos") + F.col("width")).alias("to"))
    long = met.where(F.col("width") == span).where(middle).select(
        "rid", "item", (F.col("pos") - run(range(reach - 1, -1, -1))).alias("from"),
        (F.col("pos") + k + run(range(reach + k, span + reach))).alias("to")
    ).where(F.col("to") - F.col("from") >= span)
    hits = whole.union(long)

    before = Window.partitionBy("rid").orderBy("from", "to").rowsBetween(Window.unboundedPreceding, -1)
    spans = hits.groupBy("rid", "from", "to").agg(F.collect_set("item").alias("items")) \
        .withColumn("seen", F.coalesce(F.max("to").over(before), F.lit(0)))
    found = spans.groupBy("rid").agg(
        F.sum(F.greatest(F.col("to") - F.greatest("from", "seen"), F.lit(0))).alias("n_hit"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_list(F.col("items").cast("array<string>"))))).alias("items"),
        F.sort_array(F.collect_list(F.struct("from", "to"))).alias("spans"))
    out = base.join(found, "rid", "left").select(
        F.col("doc"), "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("spans", F.array().cast("array<struct<from:long,to:long>>")).alias("spans"))
    return out.select(*beside("doc", keep, ["n_words", "n_hit", "items", "spans"]))


def digests(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


#: The result by its definition: every window of every item against every place of every document.
ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS width,
              array_to_string(w[p:p + least(len(w), 10) - 1], ' ') AS win
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM b WHERE len(w) > 0)),
dw AS (SELECT r, width, p, array_to_string(w[p:p + width - 1], ' ') AS win
       FROM (SELECT r, w, width, unnest(range(1, len(w) - width + 2)) AS p
             FROM d, (SELECT DISTINCT width FROM bw) WHERE len(w) >= width)),
hit AS (SELECT r, item_id, p, dw.width FROM dw JOIN bw ON dw.width = bw.width AND dw.win = bw.win),
places AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + width)) AS q FROM hit) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS names
          FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS i FROM hit WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (r) LEFT JOIN items USING (r)
"""
