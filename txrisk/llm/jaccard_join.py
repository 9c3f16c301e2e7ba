"""N-gram Jaccard join by MinHash banding (operator 6).

Texts are sets of word shingles. Rows with the same set are one class; classes
are joined. Each of ``TREES`` tries holds, for every class, one key of MinHash
values; two classes meet where they share a key. Its length is fixed before the
data are read: the longest of at most ``LONGEST`` values with which two sets of
threshold similarity meet in some trie with the target recall (4 here). Classes
with one key make a node; the pairs of a node are verified exactly on
their shingles.

Scale: a class meets others through small (prefix, row) records; texts move
only for classes with a candidate. A node of many classes is split into blocks
and each pair of blocks is a task of its own, so no node is held whole. A pair
that shares several nodes is verified only in the first trie. Verification
returns one row for each class and block pair (a sum and a link to the group's
smallest row), so links are counted without listing pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, beside, discard, map_texts, mix64, quoted, signed, stored
from .components import components

SHINGLE = 5
THRESHOLD = 0.8
TREES = 20
LONGEST = 8
TARGET_RECALL = 0.9999
BLOCK = 512
#: Columns of an incidence matrix at a time.
CHUNK = 4096


def prefix_length(threshold: float, recall: float, trees: int = TREES, longest: int = LONGEST) -> int:
    """The longest prefix with which sets of threshold similarity meet with the target recall."""
    depth = longest
    while depth > 1 and 1 - (1 - threshold ** depth) ** trees < recall:
        depth -= 1
    return depth


def shingles(texts: list, width: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; one shingle of all words if they are fewer."""
    words = Words(texts)
    gram, inside = words.grams(width)
    out = []
    for t in range(len(texts)):
        lo, hi = int(words.first[t]), int(words.first[t + 1])
        if hi - lo >= width:
            out.append(np.unique(gram[lo:hi - width + 1]))
        elif hi > lo:
            h = np.uint64(hi - lo)
            for x in words.hash[lo:hi]:
                h = mix64(np.array([h ^ x], dtype=np.uint64))[0]
            out.append(np.array([h], dtype=np.uint64))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def signatures(sets: list[np.ndarray], trees: int, depth: int) -> np.ndarray:
    """One node key for each set (none empty) and trie: the hash of its label's prefix."""
    flat = np.concatenate(sets)
    at = np.cumsum([0, *map(len, sets[:-1])])
    factor = mix64(np.arange(1, trees * depth + 1, dtype=np.uint64)) | np.uint64(1)
    keys = np.empty((len(sets), trees), dtype=np.uint64)
    for t in range(trees):
        key = np.full(len(sets), np.uint64(t + 1), dtype=np.uint64)
        for f in factor[t * depth:(t + 1) * depth]:
            key = mix64(key ^ np.minimum.reduceat(flat * f, at))
        keys[:, t] = key
    return keys


def set_rows(base: DataFrame, width: int, trees: int, depth: int) -> DataFrame:
    """(rid, ord, s1, s2, keys): two hashes of each row's set and its node keys; null and empty without words."""
    def make():
        def compute(texts):
            sets = shingles(texts, width)
            full = [i for i, s in enumerate(sets) if len(s)]
            s1, s2, keys = [None] * len(texts), [None] * len(texts), [[]] * len(texts)
            if full:
                found = signed(signatures([sets[i] for i in full], trees, depth))
                for i, row in zip(full, found):
                    s = sets[i]
                    keys[i] = row
                    s1[i] = int(signed(np.array([mix64(s).sum(dtype=np.uint64)]))[0])
                    s2[i] = int(signed(np.array([mix64(s ^ np.uint64(len(s) + 77)).sum(dtype=np.uint64)]))[0])
            return {"s1": s1, "s2": s2, "keys": keys}
        return compute

    return map_texts(base.select("rid", "ord", "text"), "text", ["rid", "ord"],
                     "s1 long, s2 long, keys array<long>", make)


def grouped(batches, columns: list[str]):
    """Runs of equal values of ``columns`` in a sorted stream, as Arrow tables."""
    rest = None
    for b in batches:
        t = pa.Table.from_batches([b])
        if rest is not None:
            t = pa.concat_tables([rest, t])
        n = t.num_rows
        if not n:
            continue
        change = np.zeros(n, dtype=bool)
        for c in columns:
            v = t.column(c).to_numpy()
            change[1:] |= v[1:] != v[:-1]
        edge = [0, *np.flatnonzero(change).tolist()]
        for lo, hi in zip(edge[:-1], edge[1:]):
            yield t.slice(lo, hi - lo)
        rest = t.slice(edge[-1]).combine_chunks()
    if rest is not None and rest.num_rows:
        yield rest


def first_met(keys: np.ndarray, tree: int, block: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """Pairs (row < column) of one from block lo and one from hi that meet in no earlier trie."""
    n = len(keys)
    new = np.zeros((n, n), dtype=bool)
    a, b = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
    new[np.ix_(a, b)] = True
    new |= new.T
    for t in range(tree):
        new &= keys[:, t][:, None] != keys[:, t][None, :]
    return np.triu(new, 1)


def overlaps(sets: list[np.ndarray], wanted: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the wanted pairs (others may be 0)."""
    n = len(sets)
    out = np.zeros((n, n), dtype=np.int64)
    if n <= 6:
        for i, j in np.argwhere(wanted):
            out[i, j] = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
        return out
    flat = np.concatenate(sets)
    of = np.repeat(np.arange(n), [len(s) for s in sets])
    values, column, times = np.unique(flat, return_inverse=True, return_counts=True)
    # A shingle of one set alone is in no intersection.
    shared = times > 1
    column = np.where(shared, np.cumsum(shared) - 1, -1)[column]
    width = int(shared.sum())
    order = np.argsort(column, kind="stable")
    column, of = column[order], of[order]
    for c in range(0, width, CHUNK):
        lo, hi = np.searchsorted(column, [c, c + CHUNK])
        part = np.zeros((n, min(CHUNK, width - c)), dtype=np.float32)
        part[of[lo:hi], column[lo:hi] - c] = 1
        out += np.rint(part @ part.T).astype(np.int64)
    return out


def smallest_linked(linked: np.ndarray, rid: np.ndarray) -> np.ndarray:
    """For each row the smallest rid of its component under ``linked`` (symmetric)."""
    root = rid.copy()
    while True:
        near = np.where(linked, root[None, :], np.iinfo(np.int64).max).min(1)
        new = np.minimum(root, near)
        if (new == root).all():
            return root
        root = new


def linked_classes(docs: DataFrame, text_col: str, order_col: str, keep: list[str], width: int, threshold: float,
                   trees: int, longest: int, recall: float, block: int) -> tuple[DataFrame, DataFrame, DataFrame, tuple]:
    """Stored rows; (rid, ord, rep, copy_id, copies); (rid, links, root) of linked classes; tables to discard."""
    depth = prefix_length(threshold, recall, trees, longest)
    base = stored(docs.select(
        F.struct(*[quoted(c) for c in keep]).alias("doc"), quoted(text_col).alias("text"),
        quoted(order_col).alias("ord"), F.monotonically_increasing_id().alias("rid")), "shingled")
    sets = stored(set_rows(base, width, trees, depth), "signatures")
    place = F.struct(F.col("ord").isNull().alias("last"), "ord", "rid")
    classes = stored(sets.where("s1 IS NOT NULL").groupBy("s1", "s2").agg(
        F.min(place).alias("p"), F.count(F.lit(1)).alias("copies"))
        .select("s1", "s2", F.col("p.rid").alias("rep"), F.col("p.ord").alias("copy_id"), "copies"), "classes")

    reps = sets.select("rid", "keys").join(classes.select(F.col("rep").alias("rid"), "copies"), "rid")
    nodes = reps.select("rid", F.posexplode("keys").alias("tree", "key"))
    many = nodes.groupBy("tree", "key").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    met = nodes.join(many, ["tree", "key"])
    # Blocks of a node: a class goes to each pair of blocks that has its own.
    parts = F.ceil(F.col("m") / block).cast("int")
    met = met.withColumn("parts", parts).withColumn("mine", F.pmod(F.xxhash64("rid"), F.col("parts")).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))) \
        .select("tree", "key", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"), "mine", "rid")
    pair = ["key", "tree", "lo", "hi"]
    met = met.join(reps, "rid").repartition(*pair).sortWithinPartitions(*pair, "rid")

    def needed(batches):
        for g in grouped(batches, pair):
            keys = np.array(g.column("keys").to_pylist(), dtype=np.int64)
            lo, hi, tree = (g.column(c)[0].as_py() for c in ("lo", "hi", "tree"))
            new = first_met(keys, tree, g.column("mine").to_numpy(), lo, hi)
            rows = np.flatnonzero(new.any(0) | new.any(1))
            if len(rows):
                yield from g.take(pa.array(rows)).combine_chunks().to_batches()

    wanted = stored(met.mapInArrow(needed, met.schema), "candidates")
    texts = wanted.join(base.select("rid", F.col("text").cast("binary").alias("text")), "rid") \
        .repartition(*pair).sortWithinPartitions(*pair, "rid")

    def verified(batches):
        for g in grouped(batches, pair):
            keys = np.array(g.column("keys").to_pylist(), dtype=np.int64)
            lo, hi, tree = (g.column(c)[0].as_py() for c in ("lo", "hi", "tree"))
            new = first_met(keys, tree, g.column("mine").to_numpy(), lo, hi)
            own = shingles(g.column("text").to_pylist(), width)
            size = np.array([len(s) for s in own])
            both = overlaps(own, new)
            linked = new & (both >= threshold * (size[:, None] + size[None, :] - both) - 1e-9)
            linked |= linked.T
            rows = np.flatnonzero(linked.any(1))
            if len(rows):
                rid, copies = g.column("rid").to_numpy(), g.column("copies").to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rid[rows]), pa.array((linked @ copies)[rows]),
                     pa.array(smallest_linked(linked, rid)[rows])], names=["rid", "links", "root"])

    links = stored(texts.mapInArrow(verified, "rid long, links long, root long"), "links")
    discard(wanted)
    members = sets.join(classes, ["s1", "s2"], "left").select("rid", "ord", "rep", "copy_id", "copies")
    return base, members, links, (sets, classes, links)


def join_classes(docs: DataFrame, text_col: str = "text", order_col: str = "doc_id", keep: list[str] | None = None,
                 width: int = SHINGLE, threshold: float = THRESHOLD, trees: int = TREES, longest: int = LONGEST,
                 recall: float = TARGET_RECALL, block: int = BLOCK) -> DataFrame:
    """Columns ``keep`` (default: all) of each document with its near-duplicate class.

    New columns: ``class_id`` (smallest ``order_col`` of the documents connected
    to it by links), ``copy_id`` (smallest among the documents with the same
    shingles), ``n_links long`` (other rows with a similarity of at least
    ``threshold``, copies included) and ``is_first boolean`` (the one row of the
    class with its smallest id; of equal ids, the first that Spark read).

    One row for each input row; repeated rows are copies of each other. A text of
    fewer words than ``width`` is one shingle; a null or wordless text has no
    links and is a class of its own. Null ids come last. An empty table gives an
    empty result. Input columns named like new ones give way.
    """
    keep = docs.columns if keep is None else keep
    base, members, links, used = linked_classes(docs, text_col, order_col, keep, width, threshold, trees, longest, recall,
                                          block)
    roots = components(links.where("rid <> root").select(F.col("rid").alias("a"), F.col("root").alias("b")))
    counted = links.groupBy("rid").agg(F.sum("links").alias("links")).withColumnRenamed("rid", "rep")
    # Documents without words have no representative and stay by themselves.
    rows = members.withColumn("rep", F.coalesce("rep", "rid")) \
        .join(roots.select(F.col("node").alias("rep"), "root"), "rep", "left").join(counted, "rep", "left") \
        .withColumn("root", F.coalesce("root", "rep"))
    rows = stored(rows.select("rid", "ord", "root", F.coalesce("copy_id", "ord").alias("copy_id"),
                              (F.coalesce("links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).alias("n_links")),
                  "grouped")
    discard(roots, *used)
    place = F.struct(F.col("ord").isNull().alias("last"), "ord", "rid")
    heads = rows.groupBy("root").agg(F.min(place).alias("p")) \
        .select("root", F.col("p.ord").alias("class_id"), F.col("p.rid").alias("head"))
    found = rows.join(heads, "root").select("rid", "class_id", "copy_id", "n_links", (F.col("rid") == F.col("head"))
                                            .alias("is_first"))
    return base.select("rid", "doc").join(found, "rid") \
        .select(*beside("doc", keep, ["class_id", "copy_id", "n_links", "is_first"]))


#: The result by its definition: all pairs of documents that share a shingle.
ORACLE = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER (ORDER BY doc_id) AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
s AS (SELECT DISTINCT r, array_to_string(w[p:p + 4], ' ') AS g
      FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
k AS (SELECT a.r AS x, b.r AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.r <> b.r GROUP BY ALL),
e AS (SELECT x, y, c, nx.n AS nx, ny.n AS ny FROM k JOIN n nx ON x = nx.r JOIN n ny ON y = ny.r
      WHERE c >= 0.8 * (nx.n + ny.n - c) - 1e-9),
reach AS (SELECT r AS x, r AS y FROM d UNION SELECT reach.x, e.y FROM reach JOIN e ON reach.y = e.x),
cls AS (SELECT x, min(doc_id) AS class_id, min(y) AS head FROM reach JOIN d ON reach.y = d.r GROUP BY x),
cop AS (SELECT x, min(doc_id) AS copy_id FROM e JOIN d ON e.y = d.r WHERE c = nx AND c = ny GROUP BY x),
lnk AS (SELECT x, count(*) AS n_links FROM e GROUP BY x)
SELECT doc_id, class_id, least(doc_id, coalesce(copy_id, doc_id)) AS copy_id,
       CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, head = r AS is_first
FROM d JOIN cls ON d.r = cls.x LEFT JOIN cop ON d.r = cop.x LEFT JOIN lnk ON d.r = lnk.x
"""
