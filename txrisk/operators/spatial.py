"""Radius join of customers and terminals.

Pairs with Euclidean distance strictly below r. Instead of a theta join (which
Spark can only run as a nested loop), points lie in the cells of a grid of side
r, targets are copied to the cells that they reach, and the two sides are
equi-joined on the cell, then filtered by the exact distance.

The grid adapts to measured counts. A cell with more than its share of the points
(all points / shuffle partitions) is split into four, and so are its heavy
children, down to ``DEEPEST`` levels; a target goes on to the children that it
reaches. What space cannot split - many points at one place, many targets that
reach one cell - is dealt in chunks: points by chunk a, copied to every chunk b
of the targets, and the other way round, so a cell that holds a third of all
points is many (cell, a, b) tasks. Without heavy cells none of this is in the
plan. The tables of heavy cells have at most one row for each shuffle partition
and level.

What a task costs are the pairs that it tries, points times targets of its cells,
however few bytes they are read from. So cells are also cut by pairs, and dealt to
as many tasks as the pairs of all cells ask for; neither sizes in bytes nor the
files of the input decide. Such cells are at most 64 for each shuffle partition.

Lists are as large as the pairs, so what is shuffled are points and targets, and
where they meet a point's list is made whole: a task gets all targets of a cell
and streams the points past them. Only the lists of cells with more targets than
a task holds, and of keys with points at several places, are gathered from parts.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

DEEPEST = 12
#: Fewer rows than this in a cell are never worth a task of their own.
LEAST = 10_000
#: Pairs that a part of a cell tries: no fewer than the first, and no more than the second unless parts get too many.
LEAST_PAIRS, MOST_PAIRS = 1_000_000, 16_000_000
#: Pairs that are tried at once where lists are made.
BLOCK = 1 << 20
#: Targets of a cell that a task of whole lists holds; where more reach a cell, its lists are made in parts.
MOST_TARGETS = 1 << 20
CELL = ["_d", "_cx", "_cy"]
#: Slack of the reach test in units of r: it may only keep too many; the exact distance decides.
SLACK = 1e-9


def _placed(df: DataFrame, key: str, x: str, y: str, r: float, side: str) -> DataFrame:
    """Key, coordinates and coordinates in units of r; rows without a finite place have no pairs."""
    found = df.select(F.col(key), F.col(x).cast("double").alias(f"_{side}x"), F.col(y).cast("double").alias(f"_{side}y"))
    finite = (F.abs(f"_{side}x") < F.lit(float("inf"))) & (F.abs(f"_{side}y") < F.lit(float("inf")))
    return found.where(finite).withColumns({"_qx": F.col(f"_{side}x") / F.lit(float(r)), "_qy": F.col(f"_{side}y") / F.lit(float(r))})


def _cell(q: str, depth) -> Column:
    # Doubling is exact, so a child's cell halves to its parent's.
    return F.floor(F.col(q) * F.pow(F.lit(2.0), depth)).cast("long")


def _share(n: int, partitions: int, least: int) -> int:
    return max(least, math.ceil(n / partitions))


def _heavy(df: DataFrame, cell: list[str], share: int, new: str) -> DataFrame | None:
    """Cells with more than ``share`` rows and their chunks, to be broadcast: fewer than rows / share."""
    counts = df.groupBy(*cell).count().where(F.col("count") > share)
    rows = counts.select(*cell, F.ceil(F.col("count") / share).cast("int").alias(new)).collect()
    return F.broadcast(df.sparkSession.createDataFrame(rows, ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in cell)
                                                       + f", {new} int")) if rows else None


def _split_points(p: DataFrame, share: int) -> tuple[DataFrame, list[DataFrame]]:
    """Points with the leaf of the quadtree that they lie in, and its heavy cells by level."""
    p = p.withColumns({"_d": F.lit(0), "_cx": _cell("_qx", F.lit(0)), "_cy": _cell("_qy", F.lit(0))})
    levels = []
    for d in range(DEEPEST):
        found = _heavy(p.where(F.col("_d") == d), CELL, share, "_heavy")
        if found is None:
            break
        levels.append(found)
        deeper = F.col("_heavy").isNotNull()
        p = p.join(found, CELL, "left").withColumn("_to", F.when(deeper, F.lit(d + 1)).otherwise(F.col("_d"))) \
            .withColumns({"_d": F.col("_to"), "_cx": _cell("_qx", F.col("_to")), "_cy": _cell("_qy", F.col("_to"))}) \
            .drop("_heavy", "_to")
    return p, levels


def _reached(t: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """Targets once for each leaf of the quadtree that has a place nearer than r."""
    def near():
        side = F.pow(F.lit(2.0), -F.col("_d"))
        gap = lambda q, c: F.greatest(F.col(c) * side - F.col(q), F.col(q) - (F.col(c) + 1) * side, F.lit(0.0))
        return F.pow(gap("_qx", "_cx"), 2) + F.pow(gap("_qy", "_cy"), 2) < 1 + SLACK

    own = {"x": _cell("_qx", F.lit(0)), "y": _cell("_qy", F.lit(0))}
    around = F.array(*[F.struct((own["x"] + dx).alias("x"), (own["y"] + dy).alias("y")) for dx in (-1, 0, 1) for dy in (-1, 0, 1)])
    t = t.withColumn("_c", F.explode(around)).withColumns({"_d": F.lit(0), "_cx": F.col("_c.x"), "_cy": F.col("_c.y")}) \
        .drop("_c").where(near())
    for found in levels:
        child = lambda i, j: F.struct((F.col("_d") + 1).alias("d"), (F.col("_cx") * 2 + i).alias("x"),
                                      (F.col("_cy") * 2 + j).alias("y"))
        children = F.array(*[child(i, j) for i in (0, 1) for j in (0, 1)])
        self_ = F.array(F.struct(F.col("_d").alias("d"), F.col("_cx").alias("x"), F.col("_cy").alias("y")))
        t = t.join(found, CELL, "left").withColumn("_c", F.explode(F.when(F.col("_heavy").isNotNull(), children).otherwise(self_))) \
            .withColumns({"_d": F.col("_c.d"), "_cx": F.col("_c.x"), "_cy": F.col("_c.y")}).drop("_c", "_heavy").where(near())
    return t


def _chunked(df: DataFrame, key: str, own: str, others: str, chunks: dict[str, DataFrame | None]) -> DataFrame:
    """Rows with their chunk ``own``, copied to every chunk of the other side in their cell."""
    for c in (own, others):
        df = df.withColumn(f"{c}n", F.lit(1)) if chunks[c] is None else \
            df.join(chunks[c], CELL, "left").withColumn(f"{c}n", F.coalesce(f"{c}n", F.lit(1)))
    return df.withColumns({own: F.pmod(F.xxhash64(key), F.col(f"{own}n")).cast("int"),
                           others: F.explode(F.sequence(F.lit(0), F.col(f"{others}n") - 1)),
                           "_parts": F.col(f"{others}n") > 1}).drop(f"{own}n", f"{others}n")


def _work(p: DataFrame, t: DataFrame, b: DataFrame | None, n: int, rows: float, least: int, most: int) -> tuple[DataFrame | None, int]:
    """Chunks of the points of cells with many pairs, or more than ``rows`` points, to be broadcast, and the number of tasks for all pairs."""
    cells = p.groupBy(*CELL).agg(F.count(F.lit(1)).alias("_np")).join(t.groupBy(*CELL).agg(F.count(F.lit(1)).alias("_nt")), CELL, "left") \
        .withColumn("_tried", F.col("_np").cast("double") * F.coalesce("_nt", F.lit(0)))
    total = cells.agg(F.coalesce(F.sum("_tried"), F.lit(0.0))).first()[0]
    share = max(least, min(most, total / (4 * n)), total / (64 * n))
    if b is not None:
        cells = cells.join(b, CELL, "left").withColumn("_tried", F.col("_tried") / F.coalesce("_bn", F.lit(1)))
    wanted = F.least(F.greatest(F.ceil(F.col("_tried") / share), F.ceil(F.col("_np") / F.lit(rows))), F.col("_np"))
    found = cells.where((F.col("_tried") > share) | (F.col("_np") > rows)).select(*CELL, wanted.cast("int").alias("_an")).collect()
    kind = ", ".join(f"{c} {p.schema[c].dataType.simpleString()}" for c in CELL) + ", _an int"
    return F.broadcast(p.sparkSession.createDataFrame(found, kind)) if found else None, max(n, math.ceil(total / share))


def _dealt(points: DataFrame, targets: DataFrame, r: float, pkey: str, px: str, py: str, tkey: str, tx: str, ty: str,
           least: int, pairs: tuple[int, int], most_targets: int = 0) -> tuple[DataFrame, DataFrame, list[str], int, bool]:
    """Points and targets with the columns on which they meet, these columns, the number of tasks, and whether some
    cell's targets are in chunks; points then have ``_parts``, whether theirs are. Chunks hold ``most_targets`` at least.
    """
    n = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    p = _placed(points, pkey, px, py, r, "p")
    share = _share(p.count(), n, least)
    p, levels = _split_points(p, share)
    t = _reached(_placed(targets, tkey, tx, ty, r, "t"), levels)
    chunks = {"_b": _heavy(t, CELL, max(most_targets, _share(t.count(), n, least)), "_bn")}
    chunks["_a"], tasks = _work(p, t, chunks["_b"], n, float(share) if len(levels) == DEEPEST else math.inf, *pairs)
    # Without heavy cells the level is one constant, which Spark would drop from the join's keys and deal the rows anew.
    keys = CELL if levels else CELL[1:]
    if any(c is not None for c in chunks.values()):
        keys = [*keys, "_a", "_b"]
        p, t = _chunked(p, pkey, "_a", "_b", chunks), _chunked(t, tkey, "_b", "_a", chunks)
    in_parts = chunks["_b"] is not None
    return p.select(pkey, "_px", "_py", *keys, *["_parts"] * in_parts), t.select(tkey, "_tx", "_ty", *keys), keys, tasks, in_parts


def within_radius(points: DataFrame, targets: DataFrame, r: float,
                  pkey: str, px: str, py: str, tkey: str, tx: str, ty: str, least: int = LEAST,
                  pairs: tuple[int, int] = (LEAST_PAIRS, MOST_PAIRS), lists: bool = False, whole: bool = False) -> DataFrame:
    """(pkey, tkey, distance) for every pair closer than r.

    Repeated keys are points of their own; rows without a finite place have no
    pairs. ``least``: cells with fewer rows stay whole. ``pairs``: parts of cells
    try no fewer and no more pairs. ``lists``: the same pairs as rows of (pkey,
    ascending array of tkey), one for each point and part of its cell that has
    any; integer keys only. ``whole``, with ``lists``: one row for each row of
    ``points``, with the whole array of all pairs of its key, empty for none.
    """
    if lists and whole:
        return _whole_lists(points, targets, r, pkey, px, py, tkey, tx, ty, least, pairs)
    p, t, keys, tasks, _ = _dealt(points, targets, r, pkey, px, py, tkey, tx, ty, least, pairs)
    if lists:
        return _lists(p, t, keys, tasks, r, pkey, tkey).where(F.size(tkey) > 0) \
            .select(pkey, tkey, F.explode(F.sequence(F.lit(1).cast("long"), "_n"))).select(pkey, tkey)
    dx, dy = F.col("_px") - F.col("_tx"), F.col("_py") - F.col("_ty")
    # A number of partitions that is asked for stays: their few bytes say nothing of their pairs.
    return (p.repartition(tasks, *keys).join(t.repartition(tasks, *keys).hint("shuffle_hash"), keys)
            .select(pkey, tkey, F.sqrt(dx * dx + dy * dy).alias("distance"))
            .where(F.col("distance") < F.lit(float(r))))


def _lists(p: DataFrame, t: DataFrame, keys: list[str], tasks: int, r: float, pkey: str, tkey: str) -> DataFrame:
    """(pkey, ascending tkeys, number _n of equal points) from the parts of cells, so that no pair is a row.

    Both sides come by cell, targets first, so a task holds the targets of one part of a cell and a block of points.
    """
    kinds = [p.schema[pkey].dataType, t.schema[tkey].dataType]
    # Keys that are null are left out: they are no numbers, and no list holds them.
    side = lambda df, key, x, y, i: df.where(F.col(key).isNotNull()).select(
        *keys, F.lit(i).alias("_side"), F.col(key).cast("long").alias("_id"), F.col(x).alias("_x"), F.col(y).alias("_y"))
    rows = side(t, tkey, "_tx", "_ty", 0).union(side(p, pkey, "_px", "_py", 1)).repartition(tasks, *keys) \
        .groupBy(*keys, "_side", "_id", "_x", "_y").agg(F.count(F.lit(1)).alias("_n")).sortWithinPartitions(*keys, "_side", "_x", "_y", "_id")
    found = [pa.int64() if k == T.LongType() else pa.int32() if k == T.IntegerType() else pa.int16() if k == T.ShortType() else pa.int8() for k in kinds]

    def met(ids, x, y, n, targets):
        tk, tx, ty = targets
        step = max(1, BLOCK // max(1, len(tk)))
        for lo in range(0, len(ids), step):
            hi = min(lo + step, len(ids))
            dx, dy = x[lo:hi, None] - tx[None, :], y[lo:hi, None] - ty[None, :]
            near = np.sqrt(dx * dx + dy * dy) < r
            ends = np.append(0, np.cumsum(near.sum(1))).astype(np.int32)
            values = pa.array(tk[np.nonzero(near)[1]]).cast(found[1])
            yield pa.RecordBatch.from_arrays([pa.array(ids[lo:hi]).cast(found[0]), pa.ListArray.from_arrays(ends, values), pa.array(n[lo:hi])],
                                             names=[pkey, tkey, "_n"])

    def run(batches):
        cell, parts, targets = None, [], None
        for b in batches:
            *at, side, ids, x, y, n = (c.to_numpy(zero_copy_only=False) for c in b.columns)
            if not len(ids):
                continue
            new = np.flatnonzero(np.append(True, np.any([c[1:] != c[:-1] for c in (*at, side)], axis=0)))
            for lo, hi in zip(new, np.append(new[1:], len(ids))):
                if (now := tuple(c[lo] for c in at)) != cell:
                    cell, parts, targets = now, [], None
                if side[lo] == 0:
                    parts.append([np.repeat(c[lo:hi], n[lo:hi]) for c in (ids, x, y)])
                    continue
                if targets is None:  # all of the cell's are here: points follow them
                    tk, tx, ty = (np.concatenate(c) for c in zip(*parts)) if parts else (ids[:0], x[:0], y[:0])
                    order = np.argsort(tk, kind="stable")
                    targets, parts = (tk[order], tx[order], ty[order]), []
                yield from met(ids[lo:hi], x[lo:hi], y[lo:hi], n[lo:hi], targets)

    return rows.mapInArrow(run, f"`{pkey}` {kinds[0].simpleString()}, `{tkey}` array<{kinds[1].simpleString()}>, _n long")


def _whole_lists(points: DataFrame, targets: DataFrame, r: float, pkey: str, px: str, py: str, tkey: str, tx: str, ty: str,
                 least: int, pairs: tuple[int, int]) -> DataFrame:
    """(pkey, ascending tkeys) for each row of points, all pairs of its key; lists are shuffled only where they are in parts."""
    p, t, keys, tasks, in_parts = _dealt(points, targets, r, pkey, px, py, tkey, tx, ty, least, pairs, MOST_TARGETS)
    place = [F.col(c).cast("double") for c in (px, py)]
    finite = F.coalesce((F.abs(place[0]) < F.lit(float("inf"))) & (F.abs(place[1]) < F.lit(float("inf"))), F.lit(False))
    # Keys with one place meet all their targets in one part of a cell, and so do their copies.
    here = [F.when(finite, c) for c in place]
    apart = points.where(F.col(pkey).isNotNull()).groupBy(pkey).agg(
        F.max(finite).alias("_any"), (F.min(finite) & (F.min(here[0]) == F.max(here[0])) & (F.min(here[1]) == F.max(here[1]))).alias("_one")) \
        .where(F.col("_any") & ~F.col("_one")).select(pkey)
    kind = f"array<{t.schema[tkey].dataType.simpleString()}>"
    none = points.where(~finite | F.col(pkey).isNull()).select(pkey, F.array().cast(kind).alias(tkey))
    gathered = None
    if apart.count():
        gathered = apart
    if in_parts:
        keyed = p.where("_parts").select(pkey).distinct()
        gathered = keyed if gathered is None else gathered.union(keyed).distinct()
    if gathered is not None:
        some = p.join(gathered, pkey, "left_semi")
        p, none = (df.join(gathered, pkey, "left_anti") for df in (p, none))
        parts = _lists(some, t.join(some.select(*keys).distinct(), keys, "left_semi"), keys, tasks, r, pkey, tkey).where(F.size(tkey) > 0)
        each = points.join(gathered, pkey, "left_semi")
        none = none.union(_gathered(each, parts.select(pkey, tkey, "_n"), pkey, tkey, tkey).select(pkey, tkey))
    lists = _lists(p, t, keys, tasks, r, pkey, tkey).select(pkey, _repeated(tkey), "_n")
    copies = F.explode(F.when(F.col("_n") > 1, F.sequence(F.lit(1).cast("long"), "_n")).otherwise(F.array(F.lit(1).cast("long"))))
    return lists.select(pkey, tkey, copies).select(pkey, tkey).union(none)


def _repeated(tkey: str) -> Column:
    """A list with each target as often as its points are there."""
    return F.when(F.col("_n") > 1, F.flatten(F.transform(tkey, lambda x: F.array_repeat(x, F.col("_n").cast("int"))))).otherwise(F.col(tkey)).alias(tkey)


def _gathered(points: DataFrame, pairs: DataFrame, pkey: str, tkey: str, list_col: str) -> DataFrame:
    """Points with the sorted list of their key's parts; only keys with several parts need a sort."""
    if "_n" in pairs.columns:
        pairs = pairs.select(pkey, _repeated(tkey))
    gathered = pairs.groupBy(pkey).agg(F.collect_list(tkey).alias("_parts"))
    lists = gathered.select(pkey, F.when(F.size("_parts") == 1, F.col("_parts")[0])
                            .otherwise(F.sort_array(F.flatten("_parts"))).alias(list_col))
    return _listed(points, lists, pkey, list_col)


def terminal_lists(points: DataFrame, pairs: DataFrame, pkey: str, tkey: str,
                   list_col: str = "available_terminals", count_col: str = "nb_terminals", chunk_bits: int = 16,
                   whole: bool = False) -> DataFrame:
    """Sorted list of terminals per customer and its length; customers with none get [].

    Lists are built by ranges of 2**chunk_bits terminal ids first and joined end
    to end, so no sort takes a whole list. Where ``pairs`` holds ascending arrays
    of terminals (``within_radius`` with ``lists``), only customers with several
    of them need a sort. ``whole``: ``pairs`` is that of ``within_radius`` with
    ``whole`` for these points, so nothing is left to gather or to join.
    """
    if whole:
        out = pairs.select(pkey, F.col(tkey).alias(list_col))
    elif isinstance(pairs.schema[tkey].dataType, T.ArrayType):
        out = _gathered(points, pairs, pkey, tkey, list_col)
    else:
        parts = pairs.groupBy(pkey, F.shiftright(F.col(tkey), chunk_bits).alias("_range")).agg(F.sort_array(F.collect_list(tkey)).alias("_part"))
        lists = parts.groupBy(pkey).agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("_range", "_part"))),
                                                              lambda x: x["_part"])).alias(list_col))
        out = _listed(points, lists, pkey, list_col)
    return out.withColumn(count_col, F.size(list_col))


def _listed(points: DataFrame, lists: DataFrame, pkey: str, list_col: str) -> DataFrame:
    out = points.select(pkey).join(lists, pkey, "left")
    return out.withColumn(list_col, F.coalesce(F.col(list_col), F.array().cast(lists.schema[list_col].dataType)))
