"""Anchors of a text, and sorting of suffixes by multikey quicksort."""

from __future__ import annotations

import numpy as np

from carelake.llm.shingles import _BASE, _BYTE, _INVERSE, _powers, mixed

#: Segments up to this are sorted on all their words at once.
SMALL = 1024


_rng = np.random.default_rng(311)
_ODD = (_rng.integers(1 << 31, size=64, dtype=np.int64) * 2 + 1).astype(np.uint32)
_LOW = np.uint64(0xFFFFFFFF)


def _four_bytes(data: np.ndarray) -> np.ndarray:
    """The number that the four bytes from each place on are."""
    out = np.empty(len(data) - 3, dtype=np.uint32)
    for i in range(4):
        out[i::4] = np.frombuffer(data, dtype="<u4", count=(len(data) - i) // 4, offset=i)
    return out


class Anchors:
    """Content-defined places of byte strings of `length`: the least hashed `gram` of each.

    Equal strings have their anchor at the same place within them, so only suffixes that
    begin at anchors need to meet: about 2 of (length - gram + 2) of all. A gram has four bytes at least.
    """

    def __init__(self, length: int, gram: int):
        self.length, self.gram = length, gram
        self.up = self.down = np.ones(1, dtype=np.uint64)
        self.steps = [*range(0, gram - 3, 4), *([gram - 4] if gram % 4 else [])]

    def __call__(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Each anchor's hash and place, the start of the first string that it stands for,
        and how many strings, which start one after the other. Of equal hashes the leftmost counts."""
        return self.of_texts(np.frombuffer(data, dtype=np.uint8), np.array([0, len(data)]))[1:]

    def of_texts(self, data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The number of the text before the same, of texts that follow each other in `data`; the i-th ends at cuts[i + 1].

        No string spans two texts. Places are places in `data`. Short texts cost less together than one by one.
        """
        size, none = len(data), np.zeros(0, dtype=np.int64)
        if size < self.length:
            return none, none.astype(np.uint64), none, none, none
        words = _four_bytes(data)
        order = words * _ODD[0]
        order ^= order >> np.uint32(15)
        order *= _ODD[1]
        grams = size - self.gram + 1
        h = order[:grams] * _ODD[2]
        for i, step in enumerate(self.steps[1:], 3):
            h += order[step:step + grams] * _ODD[i % len(_ODD)]
        h ^= h >> np.uint32(16)
        h *= _ODD[1]
        h ^= h >> np.uint32(13)
        # the hash, then the place: the least is the leftmost of the least hashed
        least, width = (h.astype(np.uint64) << np.uint64(32)) | np.arange(grams, dtype=np.uint64), 1
        window = self.length - self.gram + 1
        while width < window:  # the least of a window is the lesser of two windows that cover it
            step = min(width, window - width)
            least = np.minimum(least[:-step], least[step:])
            width += step
        place = (least & _LOW).astype(np.uint32)
        new = np.ones(len(place), dtype=bool)
        np.not_equal(place[1:], place[:-1], out=new[1:])
        begin, end = cuts[:-1], cuts[1:] - self.length + 1  # of the strings of each text
        new[begin[begin < end]] = True
        for a, z in zip(np.maximum(begin, end).tolist(), cuts[1:].tolist()):
            new[a:z] = False
        start = np.flatnonzero(new)
        text = np.searchsorted(cuts, start, side="right") - 1
        at = place[start].astype(np.int64)
        gram = np.zeros(len(at), dtype=np.uint64)
        for i in range(0, len(self.steps), 2):
            pair = words[at + self.steps[i]].astype(np.uint64)
            if i + 1 < len(self.steps):
                pair |= words[at + self.steps[i + 1]].astype(np.uint64) << np.uint64(32)
            gram = mixed(gram + pair)
        return text, gram, at, start, np.minimum(np.append(start[1:], size), end[text]) - start

    def context_ids(self, data: bytes, at: np.ndarray, start: np.ndarray, n: np.ndarray) -> np.ndarray:
        """64 bits for the bytes of the `n` strings from `start`, and the place of the anchor `at` in them."""
        size = len(data)
        if len(self.up) <= size:
            self.up, self.down = _powers(_BASE, 2 * size + 1), _powers(_INVERSE, 2 * size + 1)
        sums = np.zeros(size + 1, dtype=np.uint64)
        np.cumsum(_BYTE[np.frombuffer(data, dtype=np.uint8)] * self.up[:size], out=sums[1:])
        ranges = (sums[start + n - 1 + self.length] - sums[start]) * self.down[start]
        return mixed(mixed(ranges) + (at - start).astype(np.uint64) * np.uint64(64) + n.astype(np.uint64)).view(np.int64)


def words(buffer: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """The strings of `length` bytes at `starts`, as big-endian 64-bit words that sort as they do."""
    wide = -(-length // 8) * 8
    out = np.zeros((len(starts), wide), dtype=np.uint8)
    out[:, :length] = np.lib.stride_tricks.sliding_window_view(buffer, length)[starts]
    return out.view(">u8").astype(np.uint64)


def multikey_order(rows: np.ndarray) -> np.ndarray:
    """The order of `rows` (of words) by three-way multikey quicksort.

    A segment is parted by a pivot of the word at its depth; rows equal to it go on at the
    next word, the others at the same one.
    """
    out = np.arange(len(rows))
    todo = [(0, len(rows), 0)]
    while todo:
        low, high, depth = todo.pop()
        if high - low < 2 or depth == rows.shape[1]:
            continue
        own = out[low:high]
        if high - low <= SMALL:
            out[low:high] = own[np.lexsort(rows[own][:, depth:].T[::-1])]
            continue
        word = rows[own, depth]
        pivot = np.partition(word[:: max(1, len(word) // 63)], len(word[:: max(1, len(word) // 63)]) // 2)[
            len(word[:: max(1, len(word) // 63)]) // 2]
        less, same = word < pivot, word == pivot
        a, b = int(less.sum()), int(same.sum())
        out[low:high] = np.concatenate([own[less], own[same], own[~(less | same)]])
        todo += [(low, low + a, depth), (low + a, low + a + b, depth + 1), (low + a + b, high, depth)]
    return out
