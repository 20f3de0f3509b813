"""Token ids of the distinct byte ranges of many texts, each found once and remembered while a worker runs."""

from __future__ import annotations

from collections.abc import Callable
from itertools import repeat

import numpy as np

from tasador.llm.text import gather, hash_spans, spans

#: Remembered ranges of a worker; when full, memory is emptied and filled anew.
REMEMBERED = 700_000
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123)]] = True
#: ASCII signs that can stand next to a word without being part of the same match; not the apostrophe.
SIGN = np.zeros(256, bool)
SIGN[[*range(33, 39), *range(40, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def _before(data: np.ndarray, n: int, k: int) -> np.ndarray:
    """The byte k places before each."""
    return np.concatenate([np.zeros(k, np.uint8), data[: max(n - k, 0)]])[:n]


def parts(data: np.ndarray, bounds: np.ndarray, lead: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cut rows after each run of visible characters: starts, ends, rows. With ``lead``, white space before a run belongs to it.

    Only ASCII white space cuts; with ``lead`` not if the character before it may be other white space, so that a run of white space is never cut.
    Without ``lead``, runs are also cut between Latin letters and signs, unless the text may hold special tokens.
    """
    n = int(bounds[-1])
    inside = ~SPACE[data[:n]]
    if lead:
        begin = np.zeros(n, bool)
        begin[1:] = ~inside[1:] & inside[:-1]
        begin &= ~((_before(data, n, 2) == 0xC2) | ((_before(data, n, 3) >= 0xE1) & (_before(data, n, 3) <= 0xE3)))
        firsts = bounds[:-1][np.diff(bounds) > 0]
        begin[firsts] = True
        starts = np.flatnonzero(begin)
        return starts, np.append(starts[1:], n), np.searchsorted(bounds, starts, "right") - 1
    starts, ends, rows = spans(inside, bounds)
    byte, before, second, after = data[:n], _before(data, n, 1), _before(data, n, 2), data[1 : n + 1]
    if not n or ((before == 60) & (byte == 124)).any():
        return starts, ends, rows
    whole = lambda lead, last: (lead == 0xC3) & (last != 0x97) & (last != 0xB7)  # noqa: E731  a Latin letter of two bytes
    cut = (LETTER[before] | whole(second, before)) & SIGN[byte] | SIGN[before] & (LETTER[byte] | whole(byte, after))
    cut[starts] = False
    more = np.flatnonzero(cut & inside)
    if len(more):
        starts, ends = np.sort(np.concatenate([starts, more])), np.sort(np.concatenate([ends, more]))
        rows = np.searchsorted(bounds, starts, "right") - 1
    return starts, ends, rows


class SpanCache:
    """``encode``: all ids of a list of byte strings in a row, and how many each has."""

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]):
        self.encode = encode
        self._forget()

    def _forget(self):
        self.known, self.flat, self.used = {}, np.zeros(1 << 16, np.uint32), 0
        self.offset, self.length = np.zeros(REMEMBERED, np.int64), np.zeros(REMEMBERED, np.int64)

    def _learn(self, names: list[int], texts: list[bytes]):
        have = len(self.known)
        if have + len(names) > len(self.offset):
            self.offset, self.length = (np.concatenate([x, np.zeros(len(names) + have, np.int64)]) for x in (self.offset, self.length))
        ids, lengths = self.encode(texts)
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used : self.used + len(ids)] = ids
        self.offset[have : have + len(names)] = self.used + np.cumsum(lengths) - lengths
        self.length[have : have + len(names)] = lengths
        self.used += len(ids)
        self.known.update(zip(names, range(have, have + len(names))))

    def ids(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all ranges in order, and how many each has. Ranges are told apart by a 64-bit hash."""
        key, first, place = np.unique(hash_spans(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.known) > REMEMBERED:
            self._forget()
        names = key.tolist()
        slot = np.fromiter(map(self.known.get, names, repeat(-1)), np.int64, len(names))
        new = np.flatnonzero(slot < 0)
        if len(new):
            raw, at = data.tobytes(), first[new]
            have = len(self.known)
            self._learn([names[i] for i in new.tolist()], [raw[s:e] for s, e in zip(starts[at].tolist(), ends[at].tolist())])
            slot[new] = have + np.arange(len(new))
        slot = slot[place]
        lengths = self.length[slot]
        return gather(self.flat, self.offset[slot], lengths), lengths
