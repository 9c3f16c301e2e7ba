"""Byte-level BPE encoding and decoding (operator 7).

A pre-token is encoded with a priority queue of merge ranks over a doubly
linked list of symbols: the queue gives the lowest rank, leftmost first;
entries whose symbols have changed since they were queued are stale and are
skipped. Decoding concatenates the vocabulary's byte strings.

Rows are independent, so the work is one map over whole texts without a
shuffle. Each Python worker keeps a bounded memo of pre-tokens, so its memory
does not follow the vocabulary of the corpus.
"""

from __future__ import annotations

import json
import re
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, map_texts

MEMO_ENTRIES = 1 << 19
MEMO_PIECE_CHARS = 64
LATIN_END = 0x250
ID_BITS = 24
PLACE_BITS = 40
PLACE_MASK = (1 << PLACE_BITS) - 1


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
    out = {b: chr(b) for b in shown}
    for b in range(256):
        out.setdefault(b, chr(256 + b - sum(x < b for x in shown)))
    return [out[b] for b in range(256)]


def latin_classes(pattern: str) -> str:
    """``pattern`` with its Unicode classes written out for characters below LATIN_END.

    The standard module finds the pieces of such texts in a third of the time
    that ``regex`` takes; other texts go through ``regex``, whose classes these are.
    """
    every = "".join(map(chr, range(LATIN_END)))
    chars = {name: "".join(map(re.escape, regex.findall(name, every))) for name in (r"\p{L}", r"\p{N}", r"\s")}
    pattern = pattern.replace(r"\S", f"[^{chars[chr(92) + 's']}]")
    for name, found in chars.items():
        pattern = re.sub(r"(\[\^?[^\]]*?)" + re.escape(name), lambda m, c=found: m[1] + c, pattern)
        pattern = pattern.replace(name, f"[{found}]")
    return pattern


class ByteBpe:
    """Encoder and decoder of one ``tokenizers`` JSON file of the byte-level BPE kind."""

    def __init__(self, path: str, pattern: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        alphabet = byte_alphabet()
        to_byte = {c: b for b, c in enumerate(alphabet)}
        size = max([*vocab.values(), *special.values()]) + 1
        self.strings = [b""] * size
        for token, i in vocab.items():
            self.strings[i] = bytes(to_byte[c] for c in token) if all(c in to_byte for c in token) else token.encode()
        for token, i in special.items():
            self.strings[i] = token.encode()
        self.byte_id = [vocab.get(c) for c in alphabet]
        # A rank names its pair, so the queue holds single numbers: rank, then place.
        self.rank: dict[int, int] = {}
        self.left, self.right, self.joined = [], [], []
        for rank, m in enumerate(spec["model"]["merges"]):
            left, right = m.split(" ") if isinstance(m, str) else m
            self.rank[vocab[left] << ID_BITS | vocab[right]] = rank
            self.left.append(vocab[left])
            self.right.append(vocab[right])
            self.joined.append(vocab[left + right])
        self.special = special
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") \
            if special else None
        self.any_pieces = regex.compile(pattern).findall
        self.latin_pieces = re.compile(latin_classes(pattern)).findall
        self.beyond_latin = re.compile(f"[^\\x00-{chr(LATIN_END - 1)}]").search
        self.memo = Memo(MEMO_ENTRIES, MEMO_PIECE_CHARS, self.encode_piece)

    def encode_piece(self, piece: str) -> tuple[int, ...]:
        ids = [self.byte_id[b] for b in piece.encode("utf-8")]
        n, rank_of = len(ids), self.rank.get
        queue = []
        for i in range(n - 1):
            if (r := rank_of(ids[i] << ID_BITS | ids[i + 1])) is not None:
                queue.append(r << PLACE_BITS | i)
        if not queue:
            return tuple(ids)
        heapify(queue)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        while queue:
            entry = heappop(queue)
            r, i = entry >> PLACE_BITS, entry & PLACE_MASK
            j = after[i]
            # Stale: the left symbol has grown or gone, or its neighbour has.
            if ids[i] != self.left[r] or j >= n or ids[j] != self.right[r]:
                continue
            ids[i] = joined = self.joined[r]
            ids[j] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := rank_of(joined << ID_BITS | ids[k])) is not None:
                    heappush(queue, r << PLACE_BITS | i)
            if (h := before[i]) >= 0 and (r := rank_of(ids[h] << ID_BITS | joined)) is not None:
                heappush(queue, r << PLACE_BITS | h)
        return tuple([x for x in ids if x >= 0])

    def pieces(self, text: str) -> list[str]:
        return self.any_pieces(text) if self.beyond_latin(text) else self.latin_pieces(text)

    def encode(self, text: str) -> list[int]:
        lookup = self.memo.__getitem__
        if self.split is None or not any(t in text for t in self.special):
            return list(chain.from_iterable(map(lookup, self.pieces(text))))
        out: list[int] = []
        for part in self.split.split(text):
            if part in self.special:
                out.append(self.special[part])
            elif part:
                out.extend(chain.from_iterable(map(lookup, self.pieces(part))))
        return out

    def decode(self, ids) -> str:
        return b"".join(map(self.strings.__getitem__, ids)).decode("utf-8", "replace")


def encode_and_decode(df: DataFrame, path: str, pattern: str, text_col: str = "text",
                      keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (default: all) with ``ids array<int>`` and ``decoded string``.

    One row for each input row, repeated rows too; an empty table gives none. A
    null or empty text has no ids and decodes to the empty string; a special token's string inside a text
    becomes that token, as the library does by default. Texts of any length are
    encoded whole. An input column named ``ids`` or ``decoded`` gives way.
    ``path`` must be readable by every executor, as the tokenizer files are.
    """
    def make():
        codec = ByteBpe(path, pattern)

        def compute(texts):
            sizes, flat, decoded = [0], [], []
            for t in texts:
                ids = codec.encode(t.decode("utf-8", "replace")) if t else []
                sizes.append(len(ids))
                flat.append(np.array(ids, dtype=np.int32))
                decoded.append(codec.decode(ids))
            offsets = np.cumsum(sizes)
            values = np.concatenate(flat) if flat else np.zeros(0, np.int32)
            return {"ids": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32())),
                    "decoded": pa.array(decoded, pa.string())}
        return compute

    return map_texts(df, text_col, df.columns if keep is None else keep, "ids array<int>, decoded string", make)


def digests(encoded: DataFrame, *more: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of encoded rows, and the columns ``more``."""
    return encoded.select(
        "doc_id", *more,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
