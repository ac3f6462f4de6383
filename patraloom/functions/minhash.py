"""MinHash signatures of character runs, vectorised over Arrow batches."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

MIX = np.uint64(0x9E3779B97F4A7C15)
STEP = np.uint64(0x100000001B3)


def permutations(n: int, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and masks, each pair one permutation of 32-bit numbers."""
    rng = np.random.default_rng(seed)
    return (rng.integers(0, 2**31, n, np.uint32) * np.uint32(2) + np.uint32(1)), rng.integers(0, 2**32, n, np.uint32)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * MIX
    return h ^ (h >> np.uint64(29))


def run_hashes(texts: Sequence[str], k: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all runs of ``k`` characters of the texts one after the
    other, and how many each text has (none below ``k`` characters)."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    h = np.zeros(max(len(codes) - k + 1, 0), np.uint64)
    for i in range(k):
        h *= STEP
        h += codes[i : i + len(h)]
    ends = np.cumsum(sizes)
    inside = np.ones(len(codes), bool)
    for i in range(k - 1):  # runs that would reach into the next text
        at = ends - 1 - i
        inside[at[(sizes > i) & (at >= 0)]] = False
    return mixed(h[inside[: len(h)]]), np.maximum(sizes - k + 1, 0)


def signatures(hashes: np.ndarray, n: np.ndarray, values: int, seed: int = 42, stride: int = 16) -> np.ndarray:
    """MinHash values (values x texts, 32 bits) of texts with at least one run.

    Every ``stride`` values begin with two permutations of the two halves of a
    run's hash, a start and a step; the others go on from the start by the step."""
    times, plus = permutations(2 * (values // stride + 1), seed)
    high, low = (hashes >> np.uint64(32)).astype(np.uint32), hashes.astype(np.uint32)
    starts = np.cumsum(n) - n
    out = np.empty((values, len(n)), np.uint32)
    at = 0
    while at < len(n):  # pieces that stay in the processor's cache
        end = max(at + 1, int(np.searchsorted(starts, starts[at] + 32768)))
        piece = slice(starts[at], starts[end - 1] + n[end - 1])
        first = starts[at:end] - starts[at]
        for v in range(values):
            g = v // stride * 2
            if v % stride == 0:
                now, step = (high[piece] ^ plus[g]) * times[g], (low[piece] ^ plus[g + 1]) * times[g + 1] | np.uint32(1)
            else:
                now += step
            np.minimum.reduceat(now, first, out=out[v, at:end])
        at = end
    return out
