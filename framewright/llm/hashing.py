"""Vectorised word splitting, polynomial prefix hashes and minimisers over whole batches of text."""

from __future__ import annotations

import numpy as np

U = np.uint64
_MASK = (1 << 64) - 1
#: Odd multipliers of the two prefix hashes.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) | U(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: dict[int, list[np.ndarray]] = {}


def powers(n: int, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """base ** i and base ** -i modulo 2 ** 64, for i up to n."""
    have = _powers.get(which)
    if have is None or len(have[0]) <= n:
        base, size = BASES[which], max(n + 1, 1 << 16)
        have = []
        for b in (base, pow(base, -1, 1 << 64)):
            steps = np.full(size, b, np.uint64)
            steps[0] = 1
            have.append(np.multiply.accumulate(steps))
        _powers[which] = have
    return have[0], have[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers after which all bits depend on all bits."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


class Prefixes:
    """Prefix sums of values * base ** i; any range's hash is one subtraction and one product."""

    def __init__(self, values: np.ndarray, which: int = 0):
        up, self.down = powers(len(values), which)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[: len(values)], out=self.sums[1:])

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.down[start]

    def grams(self, k: int) -> np.ndarray:
        """Hash of the k values from each place on."""
        n = len(self.sums) - k
        if n <= 0:
            return np.empty(0, np.uint64)
        return mix((self.sums[k:] - self.sums[:n]) * self.down[:n])


def byte_values(raw: np.ndarray) -> np.ndarray:
    return _BYTE[raw]


class Words:
    """The words [^\\x20\\x09-\\x0D]+ of a batch of texts: byte starts and ends, and the first word of each text."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, lower: bool = False):
        self.raw = _LOWER[raw] if lower else raw
        self.offsets = offsets
        solid = ~_SPACE[raw]
        before = np.zeros(len(raw), bool)
        before[1:] = solid[:-1]
        at = offsets[1:-1]
        at = at[at < len(raw)]
        before[at] = False
        self.starts = np.flatnonzero(solid & ~before)
        after = np.zeros(len(raw), bool)
        after[:-1] = solid[1:]
        after[at[at > 0] - 1] = False
        self.ends = np.flatnonzero(solid & ~after) + 1
        self.first = np.searchsorted(self.starts, offsets)

    def hashes(self) -> np.ndarray:
        sums = Prefixes(_BYTE[self.raw])
        return mix(sums.ranges(self.starts, self.ends) + (self.ends - self.starts).astype(np.uint64))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` consecutive values, by doubling."""
    have, m = 1, values
    while have * 2 <= width:
        m = np.minimum(m[:-have], m[have:])
        have *= 2
    return np.minimum(m[: len(m) - (width - have)], m[width - have :]) if width > have else m


def super_kmers(values: np.ndarray, first: np.ndarray, window: int, k: int) -> dict[str, np.ndarray]:
    """Runs of consecutive windows of one text that have the same minimiser.

    The minimiser of a window is its leftmost k-gram of least hash, so equal windows
    have equal minimisers at equal places. Each run gives doc (its number in the
    batch), lo and n (first window and number of windows, lo from the text's start),
    at (the minimiser's place from lo), a (the minimiser's hash) and v (the hash of the
    run's whole content, with at and length).
    """
    total = len(values)
    if total < window:
        none = np.empty(0, np.int64)
        return {"doc": none, "lo": none, "n": none, "at": none, "a": none.astype(np.uint64), "v": none.astype(np.uint64)}
    grams = Prefixes(values).grams(k)
    low = U((1 << 28) - 1)
    place = np.arange(len(grams), dtype=np.uint64)
    least = sliding_min((grams & ~low) | (place & low), window - k + 1)
    ends = np.repeat(first[1:], np.diff(first))[: len(least)]
    starts = np.flatnonzero(np.arange(window, window + len(least)) <= ends)
    if total < 1 << 28:
        best = (least[starts] & low).astype(np.int64)
    else:  # places beyond 28 bits: the low bits tell how far the minimiser is from the window's start
        best = starts + (((least[starts] & low).astype(np.int64) - starts) & ((1 << 28) - 1))
    edge = np.ones(len(starts) + 1, bool)
    edge[1:-1] = (np.diff(best) != 0) | (np.diff(starts) != 1)
    cut = np.flatnonzero(edge)
    lo, hi, m = starts[cut[:-1]], starts[cut[1:] - 1], best[cut[:-1]]
    doc = np.searchsorted(first, lo, "right") - 1
    content = Prefixes(values, 1).ranges(lo, hi + window)
    v = mix(content + mix((m - lo).astype(np.uint64) * U(1 << 32) + (hi - lo).astype(np.uint64)))
    return {"doc": doc, "lo": lo - first[doc], "n": hi - lo + 1, "at": m - lo, "a": grams[m], "v": v}
