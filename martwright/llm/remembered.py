"""A bounded memory of what stretches of text become, for many stretches at a time.

Texts repeat their words. A stretch is looked for by the 64-bit hash of its bytes and then compared by the bytes
themselves; its values (token ids, say) stand in one flat array. Whatever is not known is worked out once for all its
occurrences. Stretches whose hashes are equal and whose bytes are not are worked out each on its own. A full memory
keeps what it met again: most words of a large corpus are rare, and the common ones need not be learnt anew.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from martwright.llm.words import AT_ONCE, MASKS, eights, range_hashes

LONGEST = 64  # bytes; longer stretches are not remembered
MOST = 1 << 19  # stretches; beyond, those not met again since the last time are let go, or all if those met again are over 3/4 of this


def same_bytes(a: np.ndarray, a_starts: np.ndarray, b: np.ndarray, b_starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether stretches of equal length are equal, in two arrays as `eights` gives them."""
    same = np.ones(len(lengths), bool)
    some, left, done = np.flatnonzero(lengths > 0), lengths[lengths > 0], 0
    while len(some):
        same[some] &= ((a[a_starts[some] + done] ^ b[b_starts[some] + done]) & MASKS[np.minimum(left, 8)]) == 0
        more = (left > 8) & same[some]
        some, left, done = some[more], left[more] - 8, done + 8
    return same


def _unlike(mine: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, back: np.ndarray) -> np.ndarray:
    """Which stretches are longer than those remembered, or not equal to the first of their hash."""
    odd = np.empty(len(starts), bool)
    for k in range(0, len(starts), AT_ONCE):
        at = slice(k, k + AT_ONCE)
        one = first[back[at]]
        length = ends[at] - starts[at]
        odd[at] = (length != ends[one] - starts[one]) | (length > LONGEST)
        like = np.flatnonzero(~odd[at])
        odd[k + like] = ~same_bytes(mine, starts[at][like], mine, starts[one[like]], length[like])
    return odd


class Remembered:
    """`learn` gives the values of distinct stretches, as flat values and the number of values of each."""

    def __init__(self, learn: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], kind=np.int32):
        self.learn, self.kind = learn, kind
        self._forget()

    def _forget(self) -> None:
        self.keys, self.starts, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.places, self.lengths = np.zeros(0, np.int64), np.zeros(0, np.int32)  # of a key's bytes
        self.again = np.zeros(0, bool)  # met again
        self.values, self.bytes = np.zeros(0, self.kind), np.zeros(8, np.uint8)  # the bytes with eight zeros behind them

    def __call__(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values of the given ranges of `raw`, one after the other, and the number of values of each range."""
        mine = eights(raw)
        distinct, first, back = np.unique(range_hashes(raw, starts, ends), return_index=True, return_inverse=True)
        odd = _unlike(mine, starts, ends, first, back)  # these stand alone
        if odd.any():
            keep, at = np.flatnonzero(~odd), np.flatnonzero(odd)
            alone: dict[bytes, int] = {}
            data = raw.tobytes()
            numbers = [alone.setdefault(data[i:j], len(alone)) for i, j in zip(starts[at].tolist(), ends[at].tolist())]
            used, back_kept = np.unique(back[keep], return_inverse=True)
            back = np.empty(len(starts), np.int64)
            back[keep], back[at] = back_kept, len(used) + np.array(numbers)
            distinct, first = distinct[used], np.concatenate((first[used], at[np.unique(numbers, return_index=True)[1]]))
        n = len(distinct)  # those behind it are not remembered
        lengths = ends[first] - starts[first]
        at = np.searchsorted(self.keys, distinct)
        known = np.zeros(len(first), bool)
        known[:n] = at < len(self.keys)
        hit = np.flatnonzero(known)
        known[hit] = (self.keys[at[hit]] == distinct[hit]) & (self.lengths[at[hit]] == lengths[hit])
        hit = np.flatnonzero(known)
        kept = np.ndarray((len(self.bytes) - 7,), "<u8", self.bytes, strides=(1,))
        known[hit] = same_bytes(mine, starts[first[hit]], kept, self.places[at[hit]], lengths[hit])
        hit = np.flatnonzero(known)
        new = np.flatnonzero(~known)
        where, counts = np.zeros(len(first), np.int64), np.zeros(len(first), np.int32)
        where[hit], counts[hit] = self.starts[at[hit]], self.counts[at[hit]]
        self.again[at[hit]] = True
        values = self.values
        if len(new):
            a, b = starts[first[new]], ends[first[new]]
            data = raw.tobytes()
            fresh, fresh_counts = self.learn([data[i:j] for i, j in zip(a.tolist(), b.tolist())])
            fresh_starts = np.cumsum(fresh_counts) - fresh_counts
            where[new], counts[new] = len(values) + fresh_starts, fresh_counts
            values = np.concatenate((values, fresh))
            short = np.flatnonzero(new < n)
            found = np.searchsorted(self.keys, distinct[new[short]], "right") > at[new[short]]
            short = short[~found]  # a hash that another stretch has in the memory stays with that one
            if len(self.keys) + len(short) > MOST:
                self._let_go()
            self._keep(distinct[new[short]], fresh, fresh_starts[short], fresh_counts[short], raw, a[short], (b - a)[short])
        counts = counts[back]
        offsets = np.cumsum(counts, dtype=np.int64) - counts
        gather = np.repeat(where[back] - offsets, counts) + np.arange(int(counts.sum()))
        return values[gather], counts

    def _let_go(self) -> None:
        """Keep only what was met again, or nothing if that is too much."""
        kept = np.flatnonzero(self.again)
        old = [column[kept] for column in (self.keys, self.starts, self.counts, self.places, self.lengths)]
        keys, starts, counts, places, lengths = old
        values, letters = self.values, self.bytes
        self._forget()
        if len(kept) <= MOST * 3 // 4:
            self._keep(keys, values, starts, counts, letters, places, lengths)

    def _keep(self, keys: np.ndarray, values: np.ndarray, starts: np.ndarray, counts: np.ndarray, raw: np.ndarray, places: np.ndarray,
              lengths: np.ndarray) -> None:
        """Keep stretches in order of their keys, with only their own values and bytes."""
        at = np.searchsorted(self.keys, keys)
        own, offsets = ranges(values, starts, counts)
        letters, begins = ranges(raw, places, lengths)
        self.keys = np.insert(self.keys, at, keys)
        self.again = np.insert(self.again, at, False)
        self.starts = np.insert(self.starts, at, len(self.values) + offsets)
        self.counts = np.insert(self.counts, at, counts)
        self.places = np.insert(self.places, at, len(self.bytes) - 8 + begins)
        self.lengths = np.insert(self.lengths, at, lengths.astype(np.int32))
        self.values = np.concatenate((self.values, own.astype(self.kind)))
        self.bytes = np.concatenate((self.bytes[:-8], letters, np.zeros(8, np.uint8)))


def ranges(flat: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ranges of `flat` one after the other, and where each begins there."""
    offsets = np.cumsum(counts, dtype=np.int64) - counts
    return flat[np.repeat(starts - offsets, counts) + np.arange(int(counts.sum()))], offsets


def per_text(counts: np.ndarray, stretches: np.ndarray) -> np.ndarray:
    """Sums of `counts` over each text's number of stretches."""
    sums = np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))
    ends = np.cumsum(stretches)
    return sums[ends] - sums[ends - stretches]
