"""Portable hash keys for deterministic sampling.

The key is the first 32 bits of the MD5 of a text, read as an unsigned number.
DuckDB computes the same value with ``('0x' || substr(md5(s), 1, 8))::BIGINT``,
which makes hash-ordered samples checkable by SQL.
"""

from __future__ import annotations

import functools

import numpy as np
from pyspark.sql import Column, functions as F


def md5_key(*parts) -> Column:
    """Unsigned 32-bit key from md5 of the parts joined by ':'."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    text = F.concat_ws(":", *[c.cast("string") for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def md5_key_sql(*parts: str) -> str:
    """The DuckDB form of :func:`md5_key` for oracle SQL."""
    text = " || ':' || ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"CAST(('0x' || substr(md5({text}), 1, 8)) AS BIGINT)"


def md5_key60(*parts) -> Column:
    """Unsigned 60-bit key (first 15 hex digits of the md5), for indexes beyond 2^32."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    text = F.concat_ws(":", *[c.cast("string") for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def md5_key60_sql(*parts: str) -> str:
    text = " || ':' || ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"CAST(('0x' || substr(md5({text}), 1, 15)) AS BIGINT)"


#: MD5's constants (RFC 1321): the sines, and each step's word and rotation.
_SINES = np.floor(np.abs(np.sin(np.arange(1, 65))) * 2.0 ** 32).astype(np.uint64).astype(np.uint32)
_WORDS = [i if i < 16 else (5 * i + 1) % 16 if i < 32 else (3 * i + 5) % 16 if i < 48 else 7 * i % 16 for i in range(64)]
_TURNS = [(7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)]
_START = tuple(np.uint32(x) for x in (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476))
#: Texts that are hashed at once: arrays that stay in a core's cache.
_AT_ONCE = 1 << 13


def _md5_block(state: tuple, words: list) -> tuple:
    """MD5's state after one more block of 16 words, each an array or one number for all texts."""
    with np.errstate(over="ignore"):
        a, b, c, d = state
        for i in range(64):
            if i < 16:
                f = ((c ^ d) & b) ^ d
            elif i < 32:
                f = ((b ^ c) & d) ^ c
            elif i < 48:
                f = b ^ c ^ d
            else:
                f = c ^ (b | ~d)
            f = f + (a + (_SINES[i] + words[_WORDS[i]]))
            turn = _TURNS[i // 16][i % 4]
            a, d, c, b = d, c, b, b + ((f << np.uint32(turn)) | (f >> np.uint32(32 - turn)))
        return tuple(x + y for x, y in zip(state, (a, b, c, d)))


@functools.lru_cache(maxsize=64)
def _md5_of_blocks(blocks: bytes) -> tuple:
    state = _START
    for at in range(0, len(blocks), 64):
        state = _md5_block(state, list(np.frombuffer(blocks, dtype="<u4", count=16, offset=at)))
    return state


def md5_key60_numbered(prefix: str, start: int, end: int) -> np.ndarray:
    """:func:`md5_key60` of ``prefix`` followed by each number from ``start`` to ``end`` (excluded, none below 0), as uint64.

    All texts with equally long numbers are hashed at once; only the words that hold digits differ.
    """
    head = prefix.encode()
    whole = len(head) // 64 * 64
    rest, found = head[whole:], []
    while start < end:
        digits = len(str(start))
        n = min(end, 10 ** digits, start + _AT_ONCE) - start
        size = (len(rest) + digits + 9 + 63) // 64 * 64
        text = np.zeros((size, n), dtype=np.uint8)
        text[:len(rest)] = np.frombuffer(rest, dtype=np.uint8)[:, None]
        left = np.arange(start, start + n)
        for k in range(digits - 1, -1, -1):
            left, text[len(rest) + k] = left // 10, left % 10 + 48
        text[len(rest) + digits] = 128
        text[-8:] = np.frombuffer((8 * (len(head) + digits)).to_bytes(8, "little"), dtype=np.uint8)[:, None]
        state = _md5_of_blocks(head[:whole])
        for at in range(0, size, 64):
            block = []
            for w in range(at, at + 64, 4):
                own = text[w:w + 4]
                if w + 4 > len(rest) and w < len(rest) + digits:
                    b = own.astype(np.uint32)
                    block.append(b[0] | b[1] << np.uint32(8) | b[2] << np.uint32(16) | b[3] << np.uint32(24))
                else:
                    block.append(own[:, 0].copy().view("<u4")[0])
            state = _md5_block(state, block)
        high, low = (np.broadcast_to(x, n).astype("<u4").byteswap().astype(np.uint64) for x in state[:2])
        found.append((high << np.uint64(28)) | (low >> np.uint64(4)))
        start += n
    return np.concatenate(found) if found else np.zeros(0, dtype=np.uint64)
