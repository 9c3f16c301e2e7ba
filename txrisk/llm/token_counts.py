"""Token counts of a piece vocabulary by rank-synchronous merging (operator 3).

Texts are cut where no piece of the vocabulary can span the cut, into
pre-tokens: before space marks, and inside long words between any two characters
that no piece holds side by side. The pre-tokens of a slice that the worker does not know yet are
held together as one ragged array of symbols. In each round every pre-token
applies its lowest-rank pair, all at the same time, until none has a pair
left; then the surviving symbols are counted, a symbol without a piece of its
own as its UTF-8 bytes.

Rows are independent: one map over whole texts, no shuffle.
"""

from __future__ import annotations

from itertools import pairwise

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, map_texts, slices

SPACE = "▁"
MEMO_ENTRIES = 1 << 18
MEMO_PIECE_CHARS = 64
#: Words of more characters are cut further.
LONG_WORD = 64
#: Symbols that are merged together at most; a longer pre-token is merged alone.
RAGGED_SYMBOLS = 1 << 20
NO_RANK = np.int64(1) << 40


class PieceCounter:
    """Counts tokens as a sentencepiece BPE model with byte fallback gives them."""

    def __init__(self, path: str):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        # Control, unknown and byte pieces are never formed by merging.
        normal = [i for i in range(model.get_piece_size())
                  if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        pieces = {model.id_to_piece(i): model.get_score(i) for i in normal}
        chars = sorted({c for p in pieces for c in p})
        self.symbol = {s: i for i, s in enumerate(dict.fromkeys([*chars, *pieces]))}
        size = len(self.symbol)
        # Symbols in the model count once, a character outside it by its bytes.
        self.weight = np.array([1 if s in pieces else len(s.encode()) for s in self.symbol], dtype=np.int64)
        order = {score: r for r, score in enumerate(sorted(set(pieces.values()), reverse=True))}
        keys, ranks, joined, spans = [], [], [], set()
        for p, score in pieces.items():
            for cut in range(1, len(p)):
                left, right = self.symbol.get(p[:cut]), self.symbol.get(p[cut:])
                spans.add(p[cut - 1:cut + 1])
                if left is not None and right is not None:
                    keys.append(left * size + right)
                    ranks.append(order[score])
                    joined.append(self.symbol[p])
        at = np.argsort(np.array(keys, dtype=np.int64), kind="stable")
        self.size = size
        self.keys = np.array(keys, dtype=np.int64)[at]
        self.ranks = np.array(ranks, dtype=np.int64)[at]
        self.joined = np.array(joined, dtype=np.int64)[at]
        # A cut before a space mark is safe where no piece has another
        # character followed by one.
        inner = {a for a, b in spans if b == SPACE and a != SPACE}
        word = f"{SPACE}*[^{SPACE}]+|{SPACE}+"
        self.pieces = regex.compile(word).findall if not inner else (lambda text: [text])
        self.spans = np.sort(np.array([ord(a) * 0x110000 + ord(b) for a, b in spans], dtype=np.int64))
        # Symbol of each code point; minus its number of UTF-8 bytes where no piece holds it.
        point = np.arange(0x110000)
        self.of_char = -(1 + (point > 0x7F) + (point > 0x7FF) + (point > 0xFFFF)).astype(np.int32)
        self.of_char[[ord(c) for c in chars]] = [self.symbol[c] for c in chars]
        self.memo = Memo(MEMO_ENTRIES, MEMO_PIECE_CHARS)

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and joined symbol of neighbours; NO_RANK where they don't merge."""
        key = left * self.size + right
        key[(left < 0) | (right < 0)] = -1
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        return np.where(hit, self.ranks[at], NO_RANK), self.joined[at]

    def _merge(self, words: list[str]) -> np.ndarray:
        """Token counts of the words."""
        text = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        sym = self.of_char[text].astype(np.int64)
        length = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        seq = np.repeat(np.arange(len(words)), length)
        count = np.zeros(len(words), dtype=np.int64)
        while len(sym):
            last = np.append(seq[1:] != seq[:-1], True)
            first = np.flatnonzero(np.append(True, last[:-1]))
            rank, joined = self._pairs(sym, np.append(sym[1:], -1))
            rank[last] = NO_RANK
            lowest = np.minimum.reduceat(rank, first)
            low = np.repeat(lowest, np.diff(np.append(first, len(sym))))
            done = low == NO_RANK
            if done.any():
                np.add.at(count, seq[done], np.where(sym[done] < 0, -sym[done], self.weight[sym[done]]))
                sym, seq, rank, low, joined = (x[~done] for x in (sym, seq, rank, low, joined))
                if not len(sym):
                    break
            sym, seq = self._round(sym, seq, joined, rank == low)
        return count

    def _round(self, sym, seq, joined, hit):
        """One merge step: ``hit`` marks the left symbol of each lowest-rank pair."""
        at = np.flatnonzero(hit)
        # Of overlapping pairs in a run of neighbours, every second one counts.
        run = np.flatnonzero(np.append(True, np.diff(at) != 1))
        place = np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))
        at = at[place % 2 == 0]
        many = np.bincount(seq[at], minlength=seq[-1] + 1) > 1
        if many.any():
            # All pairs of a sequence at once gives what one at a time gives,
            # unless a new symbol has a pair of lower or equal rank at some
            # moment; such sequences apply their leftmost pair only.
            own = at[many[seq[at]]]
            rank = self._pairs(sym[own], sym[own + 1])[0]
            new = joined[own]
            nxt = np.minimum(own + 2, len(sym) - 1)
            right = np.where((own + 2 < len(sym)) & (seq[nxt] == seq[own]), sym[nxt], -1)
            left = np.where((own > 0) & (seq[own - 1] == seq[own]), sym[own - 1], -1)
            after = np.append(own[1:] == own[:-1] + 2, False)  # the next pair follows at once
            left_new = np.append(-1, np.where(after[:-1], new[:-1], -1))
            clash = (self._pairs(new, right)[0] <= rank) | (self._pairs(left, new)[0] <= rank) \
                | (self._pairs(left_new, new)[0] <= rank)
            if clash.any():
                slow = np.zeros(seq[-1] + 1, dtype=bool)
                slow[seq[own[clash]]] = True
                leftmost = np.append(True, seq[at[1:]] != seq[at[:-1]])
                at = at[leftmost | ~slow[seq[at]]]
        sym = sym.copy()
        sym[at] = joined[at]
        stay = np.ones(len(sym), dtype=bool)
        stay[at + 1] = False
        return sym[stay], seq[stay]

    def _parts(self, word: str) -> list[str]:
        """A long word, cut between characters that no piece holds side by side: no merge crosses these places."""
        point = np.frombuffer(word.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
        key = point[:-1] * 0x110000 + point[1:]
        at = np.minimum(np.searchsorted(self.spans, key), len(self.spans) - 1)
        places = [0, *(np.flatnonzero(self.spans[at] != key) + 1).tolist(), len(word)]
        return [word[a:b] for a, b in pairwise(places)]

    def _words(self, text: str) -> list[str]:
        words = self.pieces(SPACE + text.replace(" ", SPACE))
        if max(map(len, words)) <= LONG_WORD:
            return words
        return [p for w in words for p in (self._parts(w) if len(w) > LONG_WORD else (w,))]

    def count(self, texts: list[str]) -> list[int]:
        cut = [self._words(t) if t else [] for t in texts]
        known, fresh = {}, []
        for w in set().union(*cut):
            n = self.memo.find(w)
            if n is None:
                fresh.append(w)
            else:
                known[w] = n
        for lo, hi in slices(list(map(len, fresh)), RAGGED_SYMBOLS):
            for w, n in zip(fresh[lo:hi], self._merge(fresh[lo:hi]).tolist()):
                known[w] = n
                self.memo.put(w, n)
        count = known.__getitem__
        return [sum(map(count, words)) for words in cut]


def count_tokens(df: DataFrame, path: str, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (default: all) with ``n_bytes long`` and ``n_tokens long``.

    One row for each input row, repeated rows too. A null or empty text has 0
    bytes and 0 tokens; an empty table gives no rows. Texts of any length are counted
    whole. An input column named like a new one gives way. ``path`` must be readable by every executor.
    """
    def make():
        counter = PieceCounter(path)

        def compute(texts):
            return {"n_bytes": [len(t) if t else 0 for t in texts],
                    "n_tokens": counter.count([t.decode("utf-8", "replace") if t else "" for t in texts])}
        return compute

    return map_texts(df, text_col, df.columns if keep is None else keep, "n_bytes long, n_tokens long", make)


def with_limit(counted: DataFrame, limit: int = 4096) -> DataFrame:
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
