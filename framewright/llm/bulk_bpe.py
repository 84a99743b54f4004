"""The same ids as `bpe.WordBPE`, for many distinct words at once.

Where an operator only needs ids in bulk, the merges of a batch's new words run side by
side on matrices: in each round every word makes its merge of least rank (leftmost
first), which is what its priority queue would do next. Pair ranks come from an open
hash table.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np

from framewright.llm.bpe import CACHE_LETTERS, ID_BITS, WordBPE

_BITS = 18
_NONE = np.iinfo(np.int32).max


class BulkBPE:
    """ids of texts as little-endian 16-bit numbers (vocabularies under 65,536); words are cached in two generations."""

    def __init__(self, own: WordBPE, cache_words: int = 300_000):
        if len(own.tokens) > 1 << 16:
            raise ValueError("ids beyond 16 bits")
        self.own, self.limit = own, cache_words
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.inner, self.last = np.array(own.inner, np.int32), np.array(own.last, np.int32)
        pairs = np.fromiter(own.merges, np.int64, len(own.merges))
        self.new = np.array([m[1] for m in own.merges.values()], np.int32)  # in the order of ranks
        self.keys, self.ranks = np.full(1 << _BITS, -1, np.int64), np.full(1 << _BITS, _NONE, np.int32)
        slot, left = self._slot(pairs), np.arange(len(pairs))
        while len(left):  # every pair takes the first free slot from its own on
            free = np.flatnonzero(self.keys[slot[left]] < 0)
            taken, first = np.unique(slot[left[free]], return_index=True)
            self.keys[taken], self.ranks[taken] = pairs[left[free[first]]], left[free[first]]
            left = np.delete(left, free[first])
            slot[left] = np.where(self.keys[slot[left]] >= 0, (slot[left] + 1) & ((1 << _BITS) - 1), slot[left])

    @staticmethod
    def _slot(pairs: np.ndarray) -> np.ndarray:
        return ((pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _BITS)).astype(np.int64)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids; _NONE where a pair does not merge or an id is missing (negative)."""
        pairs = a.astype(np.int64) << ID_BITS | b
        pairs[(a < 0) | (b < 0)] = -2
        slot = self._slot(pairs)
        at = self.keys[slot]
        out = np.where(at == pairs, self.ranks[slot], np.int32(_NONE))
        open_ = np.flatnonzero((at != pairs) & (at >= 0) & (pairs >= 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & ((1 << _BITS) - 1)
            at = self.keys[slot[open_]]
            hit = at == pairs[open_]
            out[open_[hit]] = self.ranks[slot[open_[hit]]]
            open_ = open_[~hit & (at >= 0)]
        return out

    def merge(self, words: list[bytes]) -> list[bytes]:
        """The ids of words of at most a few dozen bytes."""
        size = np.array([len(w) for w in words])
        width = int(size.max())
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(-1, width)
        column = np.arange(width + 1)
        ids = np.full((len(words), width + 2), -1, np.int32)  # a spare column at either side
        ids[:, 1:-1] = np.where(column[:-1] < size[:, None], self.inner[raw], -1)
        row = np.arange(len(words))
        ids[row, size] = self.last[raw[row, size - 1]]
        ranks = self.rank(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(words), -1)
        done: list[bytes] = [b""] * len(words)
        while len(row):
            at = ranks.argmin(axis=1)
            k = np.arange(len(row))
            least = ranks[k, at]
            over = least == _NONE
            if over.any():
                for r, line in zip(row[over].tolist(), ids[over]):
                    done[r] = line[line >= 0].astype("<u2").tobytes()
                row, ids, ranks, at, least = row[~over], ids[~over], ranks[~over], at[~over], least[~over]
                k = np.arange(len(row))
                if not len(row):
                    break
            shift = column + (column > at[:, None])  # the merged pair's right half leaves
            ids = np.concatenate((np.take_along_axis(ids, shift, 1), np.full((len(row), 1), -1, np.int32)), 1)
            ids[k, at] = self.new[least]
            ranks = np.take_along_axis(ranks, np.minimum(shift, width), 1)
            ranks[:, -1] = _NONE
            ranks[k, at] = self.rank(ids[k, at], ids[k, at + 1])
            ranks[k, at - 1] = self.rank(ids[k, at - 1], ids[k, at])
        return done

    def learn(self, words: Iterable[str]) -> None:
        """Puts the ids of words into the cache: side by side if short, by the queue if long."""
        new = []
        for w in words:
            if (ids := self.old.get(w)) is not None:
                self.young[w] = ids
            else:
                new.append(w)
        coded = [w.encode() for w in new]
        order = sorted(range(len(new)), key=lambda i: len(coded[i]))
        for at in range(0, len(order), 8192):
            part = order[at : at + 8192]
            short = [i for i in part if len(coded[i]) <= CACHE_LETTERS]
            if short:
                self.young.update(zip([new[i] for i in short], self.merge([coded[i] for i in short])))
            self.young.update((new[i], np.array(self.own.merge(coded[i]), "<u2").tobytes()) for i in part[len(short) :])

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        pieces = [self.own.pieces(t) for t in texts]
        missing = {w for words in pieces for w in words} - self.young.keys()
        if len(self.young) + len(missing) > self.limit and self.young:
            self.old, self.young = self.young, {}
            missing = {w for words in pieces for w in words}
        special = {s: i.to_bytes(2, "little") for s, i in self.own.special.items()}
        self.young |= {s: special[s] for s in missing & special.keys()}
        self.learn(missing - special.keys())
        get = self.young.__getitem__
        return [b"".join(map(get, words)) for words in pieces]


_loaded: dict[str, BulkBPE] = {}


def load(path: str) -> BulkBPE:
    from framewright.llm import bpe

    if path not in _loaded:
        _loaded[path] = BulkBPE(bpe.load(path))
    return _loaded[path]
