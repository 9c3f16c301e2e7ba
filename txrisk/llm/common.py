"""Helpers shared by the text operators.

Texts travel to Python as binary, so no task decodes what it only splits into
words. A worker handles a slice of rows whose bytes stay below ``SLICE_BYTES``
(one row alone may exceed it), so its memory follows the longest text and not
the Arrow batch.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import scratch_path

# Words are runs of these characters once A-Z is lower case.
WORD_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SLICE_BYTES = 1 << 21

# Every byte of a word maps to itself or its lower case, every other byte to a
# space. All bytes of a character outside ASCII belong to words.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
              for b in range(256))

#: White space alone separates words.
BLANKS = bytes(32 if 9 <= b <= 13 else b for b in range(256))

_MULT = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold_words(text: bytes) -> list[bytes]:
    """Words of one UTF-8 text, A-Z lower-cased."""
    return text.translate(FOLD).split()


def slices(sizes: list[int], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts have at most ``limit`` bytes together, or one row."""
    lo, size = 0, 0
    for i, n in enumerate(sizes):
        if i > lo and size + n > limit:
            yield lo, i
            lo, size = i, 0
        size += n
    if lo < len(sizes):
        yield lo, len(sizes)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (the splitmix64 finalizer)."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX[0]
    x = x ^ (x >> np.uint64(27))
    x = x * _MIX[1]
    return x ^ (x >> np.uint64(31))


class Words:
    """Word hashes and places of some texts, without one object per word.

    ``hash[i]`` is a 64-bit hash of word i; words ``first[d]:first[d + 1]``
    belong to text d; ``buf[start[i]:end[i]]`` are the bytes of word i.
    """

    def __init__(self, texts: list, fold: bytes = FOLD):
        texts = [t if t is not None else b"" for t in texts]
        self.buf = b" ".join(texts).translate(fold)
        raw = np.frombuffer(self.buf, dtype=np.uint8)
        inside = np.zeros(len(raw) + 2, dtype=bool)
        inside[1:-1] = raw != 32
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        self.start, self.end = edge[0::2], edge[1::2]
        size = self.end - self.start
        self.n = len(size)
        if self.n:
            at = np.cumsum(size) - size
            power = np.full(int(size.max()), _MULT, dtype=np.uint64)
            power[0] = 1
            power = np.cumprod(power)
            value = raw[inside[1:-1]].astype(np.uint64)
            value *= power[np.arange(len(value)) - np.repeat(at, size)]
            self.hash = mix64(np.add.reduceat(value, at) + size.astype(np.uint64))
        else:
            self.hash = np.zeros(0, dtype=np.uint64)
        lengths = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
        begin = np.concatenate(([0], np.cumsum(lengths + 1)))
        self.first = np.searchsorted(self.start, begin)
        self.text = np.repeat(np.arange(len(texts)), np.diff(self.first))

    def word(self, i: int) -> bytes:
        return self.buf[self.start[i]:self.end[i]]

    def grams(self, k: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the k words from each place, and whether they lie in one text."""
        m = max(0, self.n - k + 1)
        out = np.full(m, np.uint64(seed + k), dtype=np.uint64)
        for j in range(k):
            out = (out ^ self.hash[j:j + m]) * _MULT
            out ^= out >> np.uint64(29)
        return mix64(out), self.text[:m] == self.text[k - 1:k - 1 + m]


class Memo(dict):
    """Bounded memo of a function of a short string, with two generations.

    When the young generation is full it becomes the old one; what is found in
    the old one moves back, so common strings stay and memory is bounded.
    """

    def __init__(self, entries: int, longest: int, make: Callable | None = None):
        super().__init__()
        self.entries, self.longest, self.make, self.old = entries, longest, make, {}

    def find(self, key: str):
        value = self.get(key)
        if value is None and (value := self.old.get(key)) is not None:
            self.put(key, value)
        return value

    def __missing__(self, key: str):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self.put(key, value)
        return value

    def put(self, key: str, value) -> None:
        if len(key) <= self.longest:
            if len(self) >= self.entries:
                self.old = dict(self)
                self.clear()
            self[key] = value


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def quoted(name: str) -> F.Column:
    return F.col("`" + name.replace("`", "``") + "`")


def beside(row: str, keep: list[str], new: list[str]) -> list[F.Column]:
    """Select list: kept input columns out of the struct ``row``, then new ones.

    An input column named like a new one (in any case) gives way to it.
    """
    taken = {c.lower() for c in new}
    old = [c for c in keep if c.lower() not in taken]
    return [F.col(row).getField(c).alias(c) for c in old] + [quoted(c) for c in new]


def map_texts(df: DataFrame, text_col: str, keep: list[str], new: str,
              make: Callable[[], Callable[..., dict]], args: list[str] | None = None) -> DataFrame:
    """``df`` with columns computed in Python from whole texts.

    ``make()`` runs once for each task and returns the function that turns a
    slice of texts (bytes or None) into a dict of Arrow arrays or lists for the
    columns that ``new`` declares (DDL). Columns in ``keep`` pass through; those
    in ``args`` are given to the function as further lists.
    """
    fields = StructType.fromDDL(new).fields
    names = [f.name for f in fields]
    src = df.select(F.struct(*[quoted(c) for c in keep]).alias("row"),
                    quoted(text_col).cast("binary").alias("text"),
                    *[quoted(c).alias(f"arg{i}") for i, c in enumerate(args or [])])
    schema = src.select("row").schema
    for f in fields:
        schema = schema.add(f)

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema
        target = to_arrow_schema(schema)
        compute = make()
        for b in batches:
            row, texts = b.column(0), b.column(1)
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
            for lo, hi in slices(sizes):
                got = compute(*[c.slice(lo, hi - lo).to_pylist() for c in b.columns[1:]])
                cols = [row.slice(lo, hi - lo)]
                for f in target:
                    if f.name in got:
                        c = got[f.name]
                        cols.append(c if isinstance(c, pa.Array) else pa.array(c, type=f.type))
                yield pa.RecordBatch.from_arrays(
                    [c.cast(f.type) if c.type != f.type else c for c, f in zip(cols, target)], schema=target)

    out = src.mapInArrow(run, schema)
    return out.select(*beside("row", keep, names))


#: Folders of stored tables that are still there, in order.
_folders: list[str] = []


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Later steps read the files, so an executor lost after this point costs no
    recomputation of what came before, and row ids given before stay fixed. The
    folder goes with ``discard`` or ``release``, at the latest when the
    application ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    fs, folder = _file_system(spark, path)
    fs.deleteOnExit(folder)
    _folders.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_in = path
    return out


def _file_system(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _remove(spark: SparkSession, path: str) -> None:
    if path in _folders:
        _folders.remove(path)
        fs, folder = _file_system(spark, path)
        fs.delete(folder, True)


def discard(*tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more."""
    for t in tables:
        _remove(t.sparkSession, t.stored_in)


def held() -> list[str]:
    """Folders of the stored tables that are there now."""
    return list(_folders)


def release(spark: SparkSession, folders: list[str]) -> None:
    for path in folders:
        _remove(spark, path)


def _filter_places(bits: int, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64((1 << bits) - 1)
    return (h & mask).astype(np.int64), (mix64(h) & mask).astype(np.int64)


class BitFilter:
    """Bloom filter of 64-bit hashes, of fixed size whatever it holds.

    Spark sets the bits and packs them into blocks of 8 KB; the driver gets at
    most ``2**bits / 8`` bytes however many hashes there are. A hash that is in
    always passes, one that is not mostly does not: it may only save work, never
    decide.
    """

    BLOCK_WORDS = 1024

    def __init__(self, hashes: DataFrame, bits: int):
        """``hashes`` has one long column."""
        self.bits = bits
        size = self.BLOCK_WORDS

        def places(batches):
            for b in batches:
                both = np.concatenate(_filter_places(bits, b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)))
                yield pa.RecordBatch.from_arrays([pa.array(both >> 6), pa.array((both & 63).astype(np.int32))],
                                                 names=["word", "bit"])

        def pack(batches):
            blocks: dict[int, np.ndarray] = {}
            for b in batches:
                word, value = (c.to_numpy(zero_copy_only=False) for c in b.columns[:2])
                for k in np.unique(word // size).tolist():
                    mine = word // size == k
                    blocks.setdefault(k, np.zeros(size, dtype=np.int64))[word[mine] % size] |= value[mine]
            if blocks:
                yield pa.RecordBatch.from_arrays([pa.array(list(blocks), pa.int64()),
                                                  pa.array([x.tobytes() for x in blocks.values()], pa.binary())],
                                                 names=["block", "bytes"])

        words = hashes.mapInArrow(places, "word long, bit int") \
            .groupBy("word").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("set")) \
            .withColumn("block", F.floor(F.col("word") / size)).repartition("block")
        self.words = np.zeros(1 << (bits - 6), dtype=np.int64)
        for block, packed in words.mapInArrow(pack, "block long, bytes binary").collect():
            self.words[block * size:(block + 1) * size] = np.frombuffer(packed, dtype=np.int64)

    def passes(self, h: np.ndarray) -> np.ndarray:
        a, b = _filter_places(self.bits, h)
        return ((self.words[a >> 6] >> (a & 63)) & (self.words[b >> 6] >> (b & 63)) & 1).astype(bool)


def folded(col) -> F.Column:
    """A-Z in lower case, for native plans."""
    return F.translate(F.coalesce(col, F.lit("")), ASCII_UPPER, ASCII_UPPER.lower())


def crc32_sql(text: str) -> str:
    """DuckDB SQL of the unsigned CRC-32 of an ASCII string: eight steps of one bit for each character."""
    bits = f"flatten(list_transform(string_split({text}, ''), lambda c: [CAST(ascii(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))"
    return f"""xor(CAST(4294967295 AS BIGINT), list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {bits}),
        lambda a, x: xor(xor(a, x) >> 1, 3988292384 * (xor(a, x) & 1))))"""
