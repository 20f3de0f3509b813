"""Suffix arrays by induced sorting, for many short texts at once, with numpy.

The text is all segments one after another, each followed by its own separator. Separators are smaller than all bytes and grow from segment to
segment, so no two suffixes are equal and no comparison passes the end of a segment. Induction runs bucket by bucket over the 256 bytes; what one bucket induces is placed at once.
"""

from __future__ import annotations

import numpy as np

from tasador.llm.text import eights


class Segments:
    """Bytes of segments with a separator after each."""

    def __init__(self, flat: np.ndarray, lengths: np.ndarray):
        n = len(flat) + len(lengths)
        self.last = np.cumsum(lengths + 1) - 1  # places of separators
        self.start = self.last - lengths
        self.separator = np.zeros(n, bool)
        self.separator[self.last] = True
        self.data = np.zeros(n + 64, np.uint8)
        self.data[np.flatnonzero(~self.separator)] = flat
        self.byte = self.data[:n]


def _smaller_than_next(s: Segments) -> np.ndarray:
    """S-type: the suffix is smaller than the one that begins one place later."""
    n, byte, sep = len(s.byte), s.byte, s.separator
    differs = (byte[:-1] != byte[1:]) | sep[:-1] | sep[1:]
    less = np.where(sep[1:], False, np.where(sep[:-1], True, byte[:-1] < byte[1:]))
    at = np.flatnonzero(differs)
    out = np.ones(n, bool)
    out[: at[-1] + 1] = np.repeat(less[at], np.diff(at, prepend=-1))
    return out


def _push(array, edge, wave, byte, wanted, down: bool):
    """Place the suffixes one before those of the wave, if wanted, at the edges of their buckets in the order of the wave."""
    before = wave[wave > 0] - 1
    before = before[wanted[before]]
    if not len(before):
        return
    c = byte[before]
    order = np.argsort(c, kind="stable")
    c = c[order]
    counts = np.bincount(c, minlength=256)
    rank = np.arange(len(c)) - (np.cumsum(counts) - counts)[c]
    if down:
        array[edge[c] - 1 - rank] = before[order]
        edge -= counts
    else:
        array[edge[c] + rank] = before[order]
        edge += counts


def _induce(s: Segments, small: np.ndarray, leftmost: np.ndarray) -> np.ndarray:
    """Order of all suffixes from the order of the leftmost S-type ones (separators first, then by first byte)."""
    byte, k = s.byte, len(s.last)
    letters = ~s.separator
    size = np.bincount(byte[letters], minlength=256)
    begin = k + np.cumsum(size) - size
    array = np.empty(len(byte), np.int64)
    array[:k] = s.last
    large, head = ~small, begin.copy()
    own = leftmost[k:]
    cut = np.searchsorted(byte[own], np.arange(257))
    _push(array, head, s.last, byte, large, False)
    for c in range(256):
        done = begin[c]
        while done < head[c]:
            wave = array[done : head[c]].copy()
            done = head[c]
            _push(array, head, wave, byte, large, False)
        if cut[c] < cut[c + 1]:
            _push(array, head, own[cut[c] : cut[c + 1]], byte, large, False)
    tail, wanted = begin + size, small & letters
    for c in range(255, -1, -1):
        done = begin[c] + size[c]
        while done > tail[c]:
            wave = array[tail[c] : done][::-1].copy()
            done = tail[c]
            _push(array, tail, wave, byte, wanted, True)
        if head[c] > begin[c]:
            _push(array, tail, array[begin[c] : head[c]][::-1].copy(), byte, wanted, True)
    return array


def common_prefix(data: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Length of the common prefix from places a and b, ``most`` at the most; eight bytes at a time."""
    words, out, open_ = eights(data), np.zeros(len(a), np.int64), np.arange(len(a))
    for at in range(0, most, 8):
        apart = words[a[open_] + at] ^ words[b[open_] + at]
        same = apart == 0
        differ = apart[~same]
        out[open_[~same]] = at + (np.bitwise_count((differ & (~differ + np.uint64(1))) - np.uint64(1)) >> 3)
        open_ = open_[same]
    out[open_] = most
    return np.minimum(out, most)


def _order(names: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a reduced string: pairs of names get names, recursively, until all differ."""
    n, step = len(names), 1
    while True:
        ahead = np.concatenate([names[step:] + 1, np.zeros(min(step, n), np.int64)])
        key = names * (n + 2) + ahead
        order = np.argsort(key)
        new = np.empty(n, np.int64)
        new[order] = np.concatenate([[0], np.cumsum(key[order[1:]] != key[order[:-1]])])
        if new[order[-1]] == n - 1:
            return order
        names, step = new, step * 2


def suffix_array(s: Segments) -> np.ndarray:
    small = _smaller_than_next(s)
    is_left = np.zeros(len(small), bool)
    is_left[1:] = small[1:] & ~small[:-1]
    left = np.flatnonzero(is_left)  # every separator is among them if no segment is empty
    letters = left[~s.separator[left]]
    rough = np.concatenate([s.last, letters[np.argsort(s.byte[letters], kind="stable")]])
    first = _induce(s, small, rough)
    order = first[is_left[first]]
    # names of the leftmost S-type substrings, each up to the next one
    upto = np.zeros(len(small), np.int64)
    upto[left[:-1]] = np.diff(left) + 1
    a, b = order[:-1], order[1:]
    same = (upto[a] == upto[b]) & ~s.separator[a] & ~s.separator[b]
    ends = ~(s.separator[np.minimum(a + upto[a] - 1, len(small) - 1)] | s.separator[np.minimum(b + upto[b] - 1, len(small) - 1)])
    maybe = np.flatnonzero(same & ends)
    longest = int(upto[a[maybe]].max()) if len(maybe) else 0
    equal = np.zeros(len(a), bool)
    equal[maybe] = common_prefix(np.concatenate([s.data, np.zeros(longest, np.uint8)]), a[maybe], b[maybe], longest) >= upto[a[maybe]]
    names = np.empty(len(small), np.int64)
    names[order] = np.concatenate([[0], np.cumsum(~equal)])
    if equal.any():
        order = left[_order(names[left])]
    return _induce(s, small, order)


def permuted_prefixes(s: Segments, array: np.ndarray, most: int) -> np.ndarray:
    """By place in the text: how much the suffix there has in common with the one before it in ``array``; -1 where that is unknown."""
    before = np.full(len(s.byte), -1, np.int64)
    before[array[1:]] = array[:-1]
    at = np.flatnonzero(before >= 0)
    out = np.full(len(s.byte), -1, np.int64)
    out[at] = common_prefix(s.data, at, before[at], most)
    return out
