"""Words and word shingles of many texts at once, as 64-bit hashes.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and carriage
return; A to Z count as a to z. A word's hash is a polynomial over random byte values, taken from
running sums, so no word becomes an object of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

SPACES = (9, 10, 11, 12, 13, 32)
PIECE = 1 << 20  # bytes hashed at a time; a longer text is cut at a space

AT_ONCE = 1 << 15  # stretches hashed or compared at a time
SHORT = 64  # bytes; stretches up to here are hashed eight bytes at a time, longer ones by XXH3

_BASE = 0x9E6C63D0676A9A99
_LOWER = np.arange(256, dtype=np.uint8)  # in which A to Z count as a to z
_LOWER[65:91] += 32
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True
MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xCA9B0A7D1B8F5E35)
    return h ^ (h >> np.uint64(32))


def eights(raw: np.ndarray) -> np.ndarray:
    """For every place of `raw` the eight bytes from there on as one number; behind the end come zeros."""
    return np.ndarray((len(raw) + 1,), "<u8", np.concatenate((raw, np.zeros(8, np.uint8))), strides=(1,))


def range_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the given ranges of bytes.

    Two chains of 64 bits, of different build, take in a short range; no power of a fixed base is in them, so there are
    no words whose hashes are equal by construction. Ranges that must not be taken for each other are still compared.
    """
    eight, out = eights(raw), np.empty(len(starts), np.uint64)
    for k in range(0, len(starts), AT_ONCE):
        out[k:k + AT_ONCE] = _hashes(raw, eight, starts[k:k + AT_ONCE], ends[k:k + AT_ONCE] - starts[k:k + AT_ONCE])
    return out


def _hashes(raw: np.ndarray, eight: np.ndarray, starts: np.ndarray, length: np.ndarray) -> np.ndarray:
    one, two = mixed(length.astype(np.uint64) + np.uint64(_BASE)), length.astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
    some = np.flatnonzero((length > 0) & (length <= SHORT))
    at, left = starts[some], length[some]
    while len(some):
        part = eight[at] & MASKS[np.minimum(left, 8)]
        one[some] = mixed(one[some] ^ part)
        folded = (two[some] + part) * np.uint64(0xE7037ED1A0B428DB)
        two[some] = (folded << np.uint64(23) | folded >> np.uint64(41)) ^ part * np.uint64(0x8EBC6AF09C88C6E3)
        more = left > 8
        some, at, left = some[more], at[more] + 8, left[more] - 8
    for k in np.flatnonzero(length > SHORT).tolist():
        whole = xxhash.xxh3_128_intdigest(raw[starts[k]:starts[k] + length[k]].tobytes())
        one[k], two[k] = whole >> 64, whole & (1 << 64) - 1
    return mixed(one + mixed(two))


def word_ranges(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words start and end."""
    gap = np.ones(len(raw) + 2, bool)
    gap[1:-1] = _IS_SPACE[raw]
    edges = np.flatnonzero(gap[1:] != gap[:-1])
    return edges[::2], edges[1::2]


def _hash_piece(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = _LOWER[np.frombuffer(data, np.uint8)]
    starts, ends = word_ranges(raw)
    return range_hashes(raw, starts, ends), starts


def _pieces(data: bytes) -> Iterator[bytes]:
    start = 0
    while len(data) - start > PIECE:
        cuts = [c for c in (data.rfind(bytes([s]), start, start + PIECE) for s in SPACES) if c > start]
        if not cuts:  # one word longer than a piece
            cuts = [c for c in (data.find(bytes([s]), start + PIECE) for s in SPACES) if c > 0] or [len(data)]
            stop = min(cuts)
        else:
            stop = max(cuts)
        yield data[start:stop]
        start = stop
    yield data[start:]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the number of words of each text."""
    found, counts = [], np.zeros(len(texts), np.int64)
    i = 0
    while i < len(texts):
        if len(texts[i]) > PIECE:
            parts = [_hash_piece(p)[0] for p in _pieces(texts[i])]
            found += parts
            counts[i] = sum(map(len, parts))
            i += 1
            continue
        j, size = i, 0
        while j < len(texts) and size + len(texts[j]) <= PIECE:
            size += len(texts[j]) + 1
            j += 1
        hashes, starts = _hash_piece(b"\n".join(texts[i:j]))
        begins = np.cumsum([0] + [len(t) + 1 for t in texts[i:j]])
        counts[i:j] = np.diff(np.searchsorted(starts, begins))
        found.append(hashes)
        i = j
    return (np.concatenate(found) if found else np.zeros(0, np.uint64)), counts


def shingle_hashes(words: np.ndarray, n: int = 5) -> np.ndarray:
    """Hashes of all runs of `n` words of one text; of the whole text if it has fewer, but at least one."""
    size = min(n, len(words))
    if not size:
        return np.zeros(0, np.uint64)
    out = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):
        out = out * np.uint64(_BASE) + words[k:len(words) - size + 1 + k]
    return mixed(out)
