"""Merkle manifest of a data set with an audit path for each row (operator 11).

Every row is a leaf digest. Per source, leaves in the order of their ids are
hashed sixteen at a time, level by level, to the source's subroot; the subroots
in the order of their sources are hashed likewise to one root.

The tree is kept as a content-addressed DAG: one record of digest and children
for each node, stored once however often the node occurs. Audit paths are found
by descent. A request's address is the base-16 digits of its source's number and
of its rank in the source; from the root on, a step reads the record of the
digest it stands at, goes on to the child that the next digit selects, and
collects the children that it does not select. Requests travel together until
their digits part, so a step has one row for each node met - never all requests
at the root's record. At the end the collected segments are reversed: a path
reads from the leaf up.

Ranks come from one range sort of the leaves (ids and digests, not texts). A
range partition numbers its own rows; the driver gets one row for each partition
and adds up where each begins, so a source that holds a third of all rows is
spread over its ranges. Groups are of sixteen nodes at most.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ASCII_UPPER, crc32_sql, discard, quoted, stored

FANOUT_BITS = 4
FANOUT = 1 << FANOUT_BITS
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
EMPTY_PATH = "array<struct<left:string,right:string>>"


def leaf_digest(values: list[Column]) -> Column:
    """Hash of values, each as its UTF-8 byte count, a colon and itself, or a dash for null."""
    def field(v: Column) -> Column:
        s = v.cast("string")
        return F.when(v.isNull(), "-").otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def node_digest(children: Column) -> Column:
    return F.sha2(F.concat_ws("", children), 256)


def lower_cased(text: Column, doc_id: Column) -> Column:
    """The tampering that audits must notice: A-Z in lower case in every fifth text, chosen by its id's checksum."""
    chosen = F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0
    return F.when(chosen, F.translate(text, ASCII_UPPER, ASCII_UPPER.lower())).otherwise(text)


@dataclass
class Manifest:
    """``leaves``: (s, rank, doc_id, leaf, now): source number, rank in it, digest and that of the row as it is now.

    ``records[h - 1]``: (s, i, digest, children) of the nodes of height h in the
    sources' trees, ``tops`` likewise above the subroots. ``subroots``: (s,
    digest, height). ``root``: one row with the digest, none for an empty table.
    """

    leaves: DataFrame
    records: list[DataFrame]
    tops: list[DataFrame]
    subroots: DataFrame
    root: DataFrame


def _numbered(leaves: DataFrame, order: list[str]) -> tuple[DataFrame, int, int]:
    """Leaves with source number and rank; the number of sources; at most how many leaves a source has."""
    spark = leaves.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = f"part int, s int, r long, {', '.join(f'{f.name} {f.dataType.simpleString()}' for f in leaves.schema.fields)}"
    at = leaves.columns.index("source")

    def number(batches):
        part, source, ordinal, rank = TaskContext.get().partitionId(), None, -1, 0
        for b in batches:
            if not b.num_rows:
                continue
            given = b.column(at)
            if ordinal < 0:
                source, ordinal = given[0], 0
            before = pa.concat_arrays([pa.array([source.as_py()], given.type), given.slice(0, len(given) - 1)])
            same = pc.or_(pc.fill_null(pc.equal(before, given), False), pc.and_(pc.is_null(before), pc.is_null(given)))
            new = ~same.to_numpy(zero_copy_only=False)
            place = np.arange(len(given))
            first = np.maximum.accumulate(np.where(new, place, -1))
            ranks = np.where(first < 0, rank + place, place - first)
            ordinals = ordinal + np.cumsum(new)
            source, ordinal, rank = given[-1], int(ordinals[-1]), int(ranks[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(given), part, np.int32)), pa.array(ordinals.astype(np.int32)),
                 pa.array(ranks.astype(np.int64)), *b.columns], names=["part", "s", "r", *b.schema.names])

    ranged = stored(leaves.repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(number, schema), "ranks")
    # One row for each range partition: bounded by their number, whatever the table's size.
    ends = ranged.groupBy("part").agg(
        F.min_by(F.struct("source"), "s").alias("first"), F.max_by(F.struct("source", "s", "r"), F.struct("s", "r")).alias("last"),
        F.max("r").alias("longest")).orderBy("part").collect()
    starts, n_sources, here, largest = [], 0, None, 0
    for e in ends:
        goes_on = here is not None and here[0] == e.first.source
        before = here[1] if goes_on else 0
        number_of_first = n_sources - int(goes_on)
        starts.append((e.part, number_of_first, before))
        n_sources = number_of_first + e.last.s + 1
        here = (e.last.source, e.last.r + 1 + (before if e.last.s == 0 else 0))
        largest = max(largest, before + e.longest + 1)
    begin = F.broadcast(spark.createDataFrame(starts, "part int, s0 long, r0 long"))
    rank = F.col("r") + F.when(F.col("s") == 0, F.col("r0")).otherwise(0)
    out = ranged.join(begin, "part").select((F.col("s0") + F.col("s")).alias("s"), rank.alias("rank"),
                                            *[c for c in leaves.columns if c != "source"])
    return out, n_sources, largest


def _levels(most: int) -> int:
    """Levels above a run of ``most`` nodes (an upper bound will do: further levels have no nodes)."""
    k = 0
    while most > 1:
        most, k = -(-most // FANOUT), k + 1
    return k


def _tree(nodes: DataFrame, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """Records of each level above ``nodes`` (s, i, digest), and the trees' roots (s, digest, height)."""
    records, roots = [], []
    for h in range(1, levels + 1):
        kids = F.sort_array(F.collect_list(F.struct((F.col("i") % FANOUT).alias("place"), "digest")))
        met = nodes.groupBy("s", F.shiftright("i", FANOUT_BITS).alias("i")).agg(F.transform(kids, lambda x: x["digest"]).alias("children"))
        # The first group of a tree holds a single node only where the tree has just that one: its root.
        level = stored(met.withColumn("done", (F.col("i") == 0) & (F.size("children") == 1))
                       .withColumn("digest", F.when(F.col("done"), F.col("children")[0]).otherwise(node_digest(F.col("children")))), "level")
        roots.append(level.where("done").select("s", "digest", F.lit(h - 1).alias("height")))
        records.append(level.where("not done").select("s", "i", "digest", "children"))
        nodes = records[-1]
    roots.append(nodes.select("s", "digest", F.lit(levels).alias("height")))
    out = roots[0]
    for r in roots[1:]:
        out = out.unionByName(r)
    return records, out


def build(docs: DataFrame, columns: tuple[str, ...] = COLUMNS, tamper=lower_cased) -> Manifest:
    """Leaves, records and root of ``docs``, written to the shared folder.

    ``columns``: id, source, ..., text, in the order in which a leaf hashes them.
    ``tamper(text, id)`` gives the texts that an audit is shown in place of the
    hashed ones. Nulls of any column hash as a dash; null sources form the first
    source, null ids stand first in theirs. Rows with equal ids stand in the
    order of their digests; repeated rows are leaves of their own with equal
    digests. An empty table has no root. Other columns are not hashed.
    """
    given = [quoted(c) for c in columns]
    now = [*given[:-1], tamper(given[-1], given[0])]
    leaves = stored(docs.select(given[0].alias("doc_id"), given[1].alias("source"), leaf_digest(given).alias("leaf"),
                                leaf_digest(now).alias("now")), "leaves")
    numbered, n_sources, largest = _numbered(leaves, ["source", "doc_id", "leaf"])
    discard(leaves)
    records, subroots = _tree(numbered.select("s", F.col("rank").alias("i"), F.col("leaf").alias("digest")), _levels(largest))
    subroots = stored(subroots, "subroots")
    tops, root = _tree(subroots.select(F.lit(0).alias("s"), F.col("s").alias("i"), "digest"), _levels(n_sources))
    return Manifest(numbered, records, tops, subroots, root)


def _entered(frontier: DataFrame, records: DataFrame) -> DataFrame:
    """Each stand of the descent with the children in the record of its digest."""
    return frontier.join(records.select("digest", "children").dropDuplicates(["digest"]), "digest")


def _segment(place: Column) -> Column:
    """The children not selected, to the left and to the right of the selected one."""
    kids = F.col("children")
    return F.struct(F.concat_ws("", F.slice(kids, F.lit(1), place)).alias("left"),
                    F.concat_ws("", F.slice(kids, place + 2, F.lit(FANOUT))).alias("right"))


def _stepped(entered: DataFrame, carry: list[str]) -> DataFrame:
    """One step down from ``entered`` to every child; the address ``i`` grows by the child's digit."""
    child = F.posexplode("children").alias("place", "child")
    return entered.select(*carry, "i", "path", "children", child).select(
        *carry, F.col("child").alias("digest"), (F.col("i") * FANOUT + F.col("place")).alias("i"),
        F.concat("path", F.array(_segment(F.col("place")))).alias("path"))


def paths(manifest: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """(s, rank, doc_id, leaf, now, subroot, root, segments) for each requested leaf.

    ``segments`` are the siblings to the left and right at each level, from the
    leaf up. ``requests`` are rows of the manifest's leaves (all of them where
    not given); the descent then enters only nodes on their way.
    """
    leaves = manifest.leaves if requests is None else requests

    def wanted(frontier: DataFrame, keys: list[Column]) -> DataFrame:
        if requests is None:
            return frontier
        return frontier.join(requests.select(*keys).distinct(), [c for c in ("s", "i") if c in frontier.columns], "left_semi")

    at = manifest.root.select(F.col("digest").alias("root"), "digest", F.lit(0).cast("long").alias("i"),
                              F.array().cast(EMPTY_PATH).alias("path"))
    for h in range(len(manifest.tops), 0, -1):
        at = wanted(_stepped(_entered(at, manifest.tops[h - 1]), ["root"]), [F.shiftright("s", FANOUT_BITS * (h - 1)).alias("i")])
    at = at.select(F.col("i").alias("s"), "root", "digest", F.col("digest").alias("subroot"), "path",
                   F.lit(0).cast("long").alias("i")) \
        .join(manifest.subroots.select("s", "height"), "s")
    carry = ["s", "root", "subroot"]
    alone = at.where("height = 0").select(*carry, "i", "path", F.lit(None).cast("array<string>").alias("children"))
    frontier = None
    for h in range(len(manifest.records), 0, -1):
        new = at.where(F.col("height") == h).select(*carry, "digest", "i", "path")
        frontier = new if frontier is None else frontier.unionByName(new)
        entered = _entered(frontier, manifest.records[h - 1])
        if h > 1:
            frontier = wanted(_stepped(entered, carry), ["s", F.shiftright("rank", FANOUT_BITS * (h - 1)).alias("i")])
    runs = alone if frontier is None else alone.unionByName(entered.select(*alone.columns))
    met = leaves.withColumn("i", F.shiftright("rank", FANOUT_BITS)).join(runs, ["s", "i"])
    place = (F.col("rank") % FANOUT).cast("int")
    last = F.when(F.col("children").isNull(), F.array().cast(EMPTY_PATH)).otherwise(F.array(_segment(place)))
    return met.select("s", "rank", "doc_id", "leaf", "now", "subroot", "root",
                      F.reverse(F.concat("path", last)).alias("segments"))


def folded(leaf: Column, segments: Column) -> Column:
    """The root that a leaf and its siblings hash to."""
    return F.aggregate(segments, leaf, lambda d, s: F.sha2(F.concat(s["left"], d, s["right"]), 256))


def audits(found: DataFrame) -> DataFrame:
    """Digest of each path, the root that the row as it is now leads to, and whether that is the root."""
    siblings = F.concat_ws("", F.transform("segments", lambda s: F.concat(s["left"], s["right"])))
    return found.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"),
                        folded(F.col("now"), F.col("segments")).alias("folded_root")) \
        .withColumn("verified", F.col("folded_root") == F.col("root"))


def oracle(source_levels: int = 4, top_levels: int = 3) -> str:
    """The manifest in SQL, for sources of up to 16**source_levels rows and 16**top_levels sources."""
    crc = crc32_sql("CAST(doc_id AS VARCHAR)")

    def leaf(text):
        def field(c):
            s = f"CAST({c} AS VARCHAR)"
            return f"CASE WHEN {c} IS NULL THEN '-' ELSE CAST(strlen({s}) AS VARCHAR) || ':' || {s} END"
        return "sha256(" + " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    lower = f"translate(text, '{ASCII_UPPER}', '{ASCII_UPPER.lower()}')"
    out = [f"""
t AS (SELECT *, CASE WHEN {crc} % 5 = 0 THEN {lower} ELSE text END AS shown FROM documents),
h AS (SELECT doc_id, source, {leaf('text')} AS leaf, {leaf('shown')} AS tampered FROM t),
d AS (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS s,
        row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM h),
a0 AS (SELECT s AS g, i, leaf AS digest FROM d)"""]

    def levels(name, n):
        for k in range(n):
            run = "PARTITION BY g, i // 16 ORDER BY i ROWS BETWEEN"
            out.append(f"""
{name}p{k} AS (SELECT g, i, digest, count(*) OVER (PARTITION BY g) > 1 AS many,
  coalesce(string_agg(digest, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
  coalesce(string_agg(digest, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{k}),
{name}{k + 1} AS (SELECT g, i // 16 AS i, CASE WHEN bool_and(many) THEN sha256(string_agg(digest, '' ORDER BY i))
  ELSE min(digest) END AS digest FROM {name}p{k} GROUP BY g, i // 16)""")

    levels("a", source_levels)
    out.append(f"b0 AS (SELECT 0 AS g, g AS i, digest FROM a{source_levels})")
    levels("b", top_levels)
    prior, k = "f0", 0
    out.append("f0 AS (SELECT d.*, '' AS siblings, tampered AS fold FROM d)")
    for name, n, at in (("a", source_levels, "f.i"), ("b", top_levels, "f.s")):
        for j in range(n):
            group = "f.s" if name == "a" else "0"
            k += 1
            out.append(f"""f{k} AS (SELECT f.* EXCLUDE (siblings, fold),
  f.siblings || CASE WHEN many THEN p.l || p.r ELSE '' END AS siblings,
  CASE WHEN many THEN sha256(p.l || f.fold || p.r) ELSE f.fold END AS fold
  FROM {prior} f JOIN {name}p{j} p ON p.g = {group} AND p.i = {at} // {16 ** j})""")
            prior = f"f{k}"
    return "WITH " + ",\n".join(out) + f"""
SELECT f.doc_id, f.leaf, sub.digest AS subroot, top.digest AS root, sha256(f.siblings) AS proof_sha256,
       f.fold AS folded_root, f.fold = top.digest AS verified
FROM {prior} f JOIN a{source_levels} sub ON sub.g = f.s CROSS JOIN b{top_levels} top"""
