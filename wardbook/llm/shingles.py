"""Hashed word shingles of texts, computed over whole batches of bytes with numpy."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

MASK = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Bytes hashed at a time. A single word may be longer.
PIECE = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every bit depends on all (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def constants(n: int, seed: int) -> np.ndarray:
    """``n`` odd 64-bit multipliers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_BASE) + np.uint64(seed)) | np.uint64(1)


class Powers:
    """Powers of an odd base and of its inverse modulo 2^64."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, PIECE)
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                steps = np.full(size, base, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up, self.down


POWERS = Powers()


def _piece_words(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    space = _SPACE[raw]
    edges = np.flatnonzero(np.diff(space.astype(np.int8), prepend=1, append=1))
    starts, ends = edges[::2], edges[1::2]
    up, down = POWERS.of(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum((_LOWER[raw].astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=sums[1:])
    return starts, mix((sums[ends] - sums[starts]) * down[starts])


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start of each word in ``data`` and a hash of its bytes, A-Z as a-z."""
    raw = np.frombuffer(data, dtype=np.uint8)
    starts, hashes, at = [], [], 0
    while at < len(raw):
        end = min(len(raw), at + PIECE)
        while end < len(raw) and not _SPACE[raw[end]]:  # a word stays in one piece
            rest = np.flatnonzero(_SPACE[raw[end : end + PIECE]])
            end = end + int(rest[0]) if len(rest) else min(len(raw), end + PIECE)
        s, h = _piece_words(raw[at:end])
        starts.append(s + at)
        hashes.append(h)
        at = end
    if not starts:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    return np.concatenate(starts), np.concatenate(hashes)


def shingle_sets(texts: Sequence[str | None], width: int) -> list[np.ndarray]:
    """Per text its sorted distinct shingle hashes; fewer than ``width`` words make one shingle."""
    encoded = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    starts, hashes = word_hashes(b"\n".join(encoded))
    bounds = np.cumsum([0] + [len(e) + 1 for e in encoded])
    cuts = np.searchsorted(starts, bounds)
    factors = constants(width, 5)
    n = max(0, len(hashes) - width + 1)
    runs = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        runs += hashes[k : k + n] * factors[k]
    runs = mix(runs + np.uint64(width))
    sets = []
    for low, high in zip(cuts[:-1], cuts[1:]):
        if high - low >= width:
            sets.append(np.unique(runs[low : high - width + 1]))
        elif high > low:
            whole = (hashes[low:high] * factors[: high - low]).sum(dtype=np.uint64)
            sets.append(mix(np.array([whole + np.uint64(high - low)], dtype=np.uint64)))
        else:
            sets.append(np.zeros(0, dtype=np.uint64))
    return sets


def slices(texts: Sequence[str | None], chars: int = PIECE // 2) -> Iterator[slice]:
    """Cut a batch into runs of about ``chars`` characters; a longer text is a run of its own."""
    low = total = 0
    for i, text in enumerate(texts):
        size = len(text or "")
        if total and total + size > chars:
            yield slice(low, i)
            low, total = i, 0
        total += size
    if low < len(texts):
        yield slice(low, len(texts))


def min_hash_keys(sets: Sequence[np.ndarray], rows: int, bands: int) -> np.ndarray:
    """Per non-empty set one key per band, each from ``rows`` minima over the set."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    factors, offsets = constants(rows * bands, 11), constants(rows * bands, 13)
    joins = constants(rows, 17)
    keys = np.zeros((len(sets), bands), dtype=np.uint64)
    for band in range(bands):
        key = np.full(len(sets), np.uint64(band))
        for row in range(rows):
            k = band * rows + row
            key += np.minimum.reduceat((flat ^ offsets[k]) * factors[k], starts) * joins[row]
        keys[:, band] = mix(key)
    return keys.view(np.int64)
