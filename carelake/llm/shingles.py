"""Sets of word shingles, and their min-hashes."""

from __future__ import annotations

import numpy as np

WORDS = 5
#: Min-hash functions of a sketch.
SKETCH = 64

_rng = np.random.default_rng(977)
_BYTE = _rng.integers(1 << 63, size=256, dtype=np.int64).astype(np.uint64)
_BASE = int(_rng.integers(1 << 62)) * 2 + 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_FACTORS = _rng.integers(1 << 63, size=SKETCH, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Shingler:
    """Hashes the WORDS-word shingles of a text; words are parted by white space."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def __call__(self, text: str | None) -> np.ndarray:
        """The sorted distinct 64-bit hashes. A text of fewer words is one shingle; without words it has none."""
        words = (text or "").split()
        if not words:
            return np.zeros(0, dtype=np.uint64)
        data = np.frombuffer(" ".join(words).encode("utf-8", "surrogatepass"), dtype=np.uint8)
        if len(self.up) <= len(data):
            n = 2 * len(data) + 1
            self.up, self.down = _powers(_BASE, n), _powers(_INVERSE, n)
        # prefix sums of a polynomial: the hash of a range does not depend on where it stands
        sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(_BYTE[data] * self.up[: len(data)], dtype=np.uint64)])
        spaces = np.flatnonzero(data == 32)
        starts = np.concatenate([[0], spaces + 1])
        ends = np.concatenate([spaces, [len(data)]])
        k = min(WORDS, len(starts))
        starts, ends = starts[: len(starts) - k + 1], ends[k - 1:]
        return np.unique(mixed((sums[ends] - sums[starts]) * self.down[starts]))


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """sets x SKETCH min-hashes of 32 bits; no set may be empty."""
    line = np.concatenate(sets)
    starts = np.cumsum([0, *[len(s) for s in sets[:-1]]])
    out = np.empty((len(sets), SKETCH), dtype=np.uint32)
    for i, factor in enumerate(_FACTORS):
        out[:, i] = np.minimum.reduceat((line * factor) >> np.uint64(32), starts)
    return out
