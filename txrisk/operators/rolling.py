"""Running sums over keyed event streams as a two-level prefix scan, and exact sums of doubles.

``scan`` sorts a stream of events by range - key, second, kind, tie - so a key,
a day or a single second may lie in several partitions. Each partition sums up
its own rows and says with which key it begins and ends and what that last key
adds up to: two rows for each partition. Prefix sums over those rows are what a
partition's first key starts with. So every event is shuffled and sorted once,
whatever the keys look like, and nothing is gathered by key.

Doubles are summed as integers: the exponents between the largest and the
smallest amount are cut into bands of ``BAND`` bits, and a double is the exact
sum of one signed integer for each band. Integer sums have no rounding and leave
nothing behind when a value is taken out again, over the whole range of doubles;
how many bands there are follows the data (four for amounts between a cent and
ten thousand, 88 between the smallest and the largest double). A window's total
is put together from its bands, the highest first, with the rounding of as many
additions of doubles as there are bands.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import written

#: Bits of a band: the sum of up to 2**39 values of a band fits in a long.
BAND = 24
LOWEST = -1074


class ExactSum:
    """Sums of a double column over frames, as long columns.

    NaN and infinities are counted apart: a frame with a NaN, or with both
    infinities, has the total NaN; one with an infinity has that. They leave with
    their rows. Nulls add nothing.
    """

    def __init__(self, df: DataFrame, column: str):
        x = F.col(column).cast("double")
        finite = F.abs(x) < F.lit(float("inf"))
        seen = df.agg(F.max(F.when(finite, F.abs(x))).alias("most"), F.min(F.when(finite & (x != 0), F.abs(x))).alias("least"),
                      F.max((~finite).cast("int")).alias("odd")).first()
        self.column, self.odd = column, bool(seen.odd)
        self.bands = []
        if seen.least is not None:
            low = max(math.frexp(seen.least)[1] - 53, LOWEST)
            self.bands = list(range(low, math.frexp(seen.most)[1], BAND))

    def parts(self) -> dict[str, Column]:
        """The columns to be summed, by name."""
        x = F.col(self.column).cast("double")
        finite = F.abs(x) < F.lit(float("inf"))
        out = {}
        for j, b in enumerate(self.bands):
            top = j == len(self.bands) - 1
            digit = (x if top else x % F.lit(2.0 ** (b + BAND))) / F.lit(2.0 ** b)
            out[f"_x{j}"] = F.when(finite, digit.cast("long")).otherwise(F.lit(0).cast("long"))
        if self.odd:
            for name, value in (("_nan", "nan"), ("_up", "inf"), ("_down", "-inf")):
                out[name] = F.coalesce((x == F.lit(float(value))).cast("long"), F.lit(0).cast("long"))
        return out

    def total(self, sums: dict[str, Column]) -> Column:
        """The double that the summed columns stand for."""
        out = F.lit(0.0)
        for j in reversed(range(len(self.bands))):
            out = out + sums[f"_x{j}"].cast("double") * F.lit(2.0 ** self.bands[j])
        if self.odd:
            nan, up, down = (sums[c] > 0 for c in ("_nan", "_up", "_down"))
            out = (F.when(nan | (up & down), F.lit(float("nan"))).when(up, F.lit(float("inf")))
                   .when(down, F.lit(float("-inf"))).otherwise(out))
        return out


#: Codes of an event: it adds to every window, changes nothing, or (code - 1) is the window that it leaves.
ENTER, NOTHING = 0, -1


def leaving(window: int) -> int:
    return window + 1


def scan(events: DataFrame, values: list[str], windows: int, partitions: int | None = None) -> DataFrame:
    """``_row`` and the sums of each value in each window, for every event that has a row.

    ``events`` has ``_key``, the order ``_sec``, ``_kind``, ``_tie``, the code
    ``_code``, the long columns ``values`` and the struct ``_row``, null in events
    that only change sums. An event's sums are those of its key's events up to
    itself: columns ``<value>_<window>``. Null keys form one key.

    The result reads a table written to the shared scratch folder.
    """
    n = partitions or int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["_key", "_sec", "_kind", "_tie"]
    sums = [f"{v}_{w}" for v in values for w in range(windows)]
    stream = events.select(*order, "_code", "_row", *values).repartitionByRange(n, *order).sortWithinPartitions(*order)
    schema = T.StructType([events.schema["_key"], events.schema["_row"]]).add("_part", T.IntegerType()) \
        .add("_mark", T.IntegerType()).add("_first", T.BooleanType())
    for c in sums:
        schema = schema.add(c, T.LongType())
    target = to_arrow_schema(schema)

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext
        part, width = TaskContext.get().partitionId(), len(values) * windows
        first_key, key, in_first, carry = None, None, True, np.zeros(width, np.int64)

        def batch(keys, rows, mark, first, table):
            size = len(keys)
            return pa.RecordBatch.from_arrays(
                [keys, rows, pa.array(np.full(size, part, np.int32)), pa.array(np.full(size, mark, np.int32)),
                 pa.array(first), *[pa.array(np.ascontiguousarray(table[:, j])) for j in range(width)]], schema=target)

        for b in batches:
            size = b.num_rows
            if not size:
                continue
            keys, code, rows = b.column(0), b.column(4).to_numpy(zero_copy_only=False), b.column(5)
            given = np.stack([c.to_numpy(zero_copy_only=False) for c in b.columns[6:]], axis=1).astype(np.int64, copy=False)
            if first_key is None:
                first_key = key = keys.slice(0, 1)
            before = pa.concat_arrays([key, keys.slice(0, size - 1)])
            same = pc.or_(pc.fill_null(pc.equal(before, keys), False), pc.and_(pc.is_null(before), pc.is_null(keys)))
            starts = np.flatnonzero(~same.to_numpy(zero_copy_only=False))
            table = np.empty((size, width), np.int64)
            for w in range(windows):
                sign = (code == 0).astype(np.int64) - (code == w + 1)
                table[:, w::windows] = given * sign[:, None]
            # Sums wrap around within a batch at most; differences of them do not.
            np.cumsum(table, axis=0, out=table)
            edges = np.concatenate(([0], starts))
            base = np.zeros((len(edges), width), np.int64)
            base[0] = carry
            base[1:] = -table[starts - 1] * (starts > 0)[:, None]
            table += np.repeat(base, np.diff(np.concatenate((edges, [size]))), axis=0)
            first = np.zeros(size, bool)
            if in_first:
                first[:starts[0] if len(starts) else size] = True
                in_first = not len(starts)
            key, carry = keys.slice(size - 1, 1), table[-1].copy()
            read = rows.is_valid()
            chosen = read.to_numpy(zero_copy_only=False)
            if chosen.any():
                yield batch(keys.filter(read), rows.filter(read), 0, first[chosen], table[chosen])
        if first_key is not None:
            none = pa.nulls(1, target.field("_row").type)
            yield batch(first_key, none, 1, np.array([True]), np.zeros((1, width), np.int64))
            yield batch(key, none, 2, np.array([in_first]), carry[None, :])

    scanned = written(stream.mapInArrow(run, schema), "scan")
    ends = scanned.where("_mark > 0").drop("_row")
    earlier = Window.partitionBy("_key").orderBy("_part").rangeBetween(Window.unboundedPreceding, -1)
    starts = ends.select("_part", "_mark", *[F.sum(F.when(F.col("_mark") == 2, F.col(c))).over(earlier).alias(f"{c}_before")
                                             for c in sums]).where("_mark = 1").drop("_mark")
    # One row for each range partition, whatever the table's size.
    met = scanned.where("_mark = 0").join(F.broadcast(starts), "_part")
    return met.select("_row", *[(F.col(c) + F.when(F.col("_first"), F.coalesce(f"{c}_before", F.lit(0))).otherwise(F.lit(0)))
                                .alias(c) for c in sums])
