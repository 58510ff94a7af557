"""Byte-level BPE encoding and decoding of whole texts (method: prefix dynamic programming)."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, StructField, StructType

from martwright.llm.batches import SLAB, batchwise, lists, slabs, texts_of, with_columns
from martwright.llm.prefix_bpe import ManyTexts, Merges, bytes_as_text, from_ranks
from martwright.llm.remembered import Remembered, per_text, ranges

PIECE = 1 << 19  # bytes that are cut into stretches at a time, or one text

# First bytes of white space: ASCII, and those of U+0085, U+00A0, U+1680, U+2000 to U+205F, U+3000.
_MAY_BE_SPACE = np.zeros(256, bool)
_MAY_BE_SPACE[[9, 10, 11, 12, 13, 32, 0xC2, 0xE1, 0xE2, 0xE3]] = True


class Codec:
    """Ids of texts by a rank file and a pattern."""

    def __init__(self, ranks: bytes, pattern: str):
        self.merges = Merges(from_ranks(ranks.splitlines()))
        self.many = ManyTexts(self.merges)
        self.whole = {t.encode("latin-1"): self.merges.rank[t] for t in self.merges.unreached}
        self.pieces = regex.compile(pattern.replace(r"\S", r"\P{White_Space}").replace(r"\s", r"\p{White_Space}"))
        self.words = r"| ?\p{L}+|" in pattern  # a space and letters are one match, whatever stands around them
        self.remembered = Remembered(self.learn)

    def learn(self, stretches: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of stretches: each match of the pattern is a whole token or else the encoding of its bytes."""
        number: dict[bytes, int] = {}  # of each different match
        parts: list[int] = []
        several = np.zeros(len(stretches), np.int64)
        for k, data in enumerate(stretches):
            if self.words and data[:1] == b" " and (data[1:].isalpha() or data[1:].decode().isalpha()):
                parts.append(number.setdefault(data, len(number)))
                several[k] = 1
            else:
                found = self.pieces.findall(data.decode())
                parts += [number.setdefault(p, len(number)) for p in map(str.encode, found)]
                several[k] = len(found)
        ids, counts = self.many.encode_all(list(number), self.whole)
        ids, _ = ranges(ids, (np.cumsum(counts) - counts)[parts], counts[parts])
        return ids, per_text(counts[parts], several).astype(np.int32)

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the number of ids of each."""
        found, counts, i = [np.zeros(0, np.int32)], np.zeros(len(texts), np.int64), 0
        data = [t.encode() for t in texts]
        while i < len(data):
            j, size = i + 1, len(data[i])
            while j < len(data) and size + len(data[j]) <= PIECE:
                size += len(data[j])
                j += 1
            if size:
                raw, starts, ends, own = stretches(data[i:j])
                ids, of = self.remembered(raw, starts, ends)
                counts[i:j] = per_text(of, own)
                found.append(ids)
            i = j
        return np.concatenate(found), counts

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]


def stretches(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All texts in one array, starts and ends of their stretches, and the number of stretches of each text.

    A stretch begins with a text or with a space that has something else than white space behind it.
    There a match of the pattern always begins: white space before such a space ends its own match.
    """
    raw = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    begins = np.cumsum(sizes) - sizes
    border = np.zeros(len(raw) + 1, bool)
    border[:-2] = (raw[:-1] == 32) & ~_MAY_BE_SPACE[raw[1:]]
    last = (begins + sizes - 1)[sizes > 0]
    border[last[raw[last] == 32]] = False  # what stands behind is another text
    border[begins[sizes > 0]] = True
    starts = np.flatnonzero(border[:-1])
    return raw, starts, np.append(starts[1:], len(raw)), np.diff(np.searchsorted(starts, np.append(begins, len(raw))))


class Document:
    """One text kept ready for appends and edits.

    `pieces` are the matches of the pattern, `last` the last token of every prefix of each. Only
    pieces that an edit touches are matched and encoded again, and of those only the positions
    behind the edit.
    """

    def __init__(self, codec: Codec, text: str = ""):
        self.codec, self.pieces, self.last = codec, [], []
        self.edit(0, 0, text)

    @property
    def text(self) -> str:
        return "".join(self.pieces)

    def ids(self) -> list[int]:
        merges, out = self.codec.merges, []
        for piece, last in zip(self.pieces, self.last):
            whole = merges.rank.get(bytes_as_text(piece.encode()))
            out += merges.path(last) if whole is None else [whole]
        return out

    def append(self, text: str) -> None:
        n = sum(map(len, self.pieces))
        self.edit(n, n, text)

    def edit(self, start: int, stop: int, new: str) -> None:
        """Replace the characters `start` to `stop`."""
        ends = np.cumsum([0, *map(len, self.pieces)])
        # Two pieces before the edit: a match may look one character ahead.
        i = max(0, int(np.searchsorted(ends, start, "right")) - 3)
        middle = self.text[ends[i]:start] + new
        rest = self.text[stop:]
        olds = {int(e) - int(stop): k for k, e in enumerate(ends[:-1]) if e > stop}
        fresh, position, joined = [], 0, len(self.pieces)
        whole = middle + rest
        while position < len(whole):
            k = olds.get(position - len(middle))
            # An old border behind the edit, with the old piece after it: from here on all is as it was.
            match = self.codec.pieces.match(whole, position)
            if k is not None and k + 1 < len(self.pieces) and match[0] == self.pieces[k]:
                joined = k
                break
            fresh.append(match[0])
            position = match.end()
        merges, last = self.codec.merges, []
        for j, piece in enumerate(fresh):
            symbols = bytes_as_text(piece.encode())
            known: list[int] = []
            if i + j < len(self.pieces):
                old = bytes_as_text(self.pieces[i + j].encode())
                same = next((n for n, (a, b) in enumerate(zip(old, symbols)) if a != b), min(len(old), len(symbols)))
                known = list(self.last[i + j][:same])
            last.append(merges.last_tokens(symbols, known))
        self.pieces[i:joined], self.last[i:joined] = fresh, last


@lru_cache(4)
def codec(ranks: bytes, pattern: str) -> Codec:
    """One codec for each Python worker."""
    return Codec(ranks, pattern)


@lru_cache(4)
def spellings(ranks: bytes) -> dict[int, bytes]:
    """The bytes of every id."""
    return {r: t.encode("latin-1") for t, r in from_ranks(ranks.splitlines()).items()}


def encode(df: DataFrame, ranks: str, pattern: str, text: str = "text", out: str = "ids", decoded: str | None = None) -> DataFrame:
    """`df` with the token ids of each whole text as array<int>.

    Null and empty texts get no ids. A column named `out` gives way. `ranks` is a file of base64
    tokens and ranks; the driver reads it (its size is that of a vocabulary) and sends it with the tasks.
    With `decoded` the ids are decoded as well, in the same task, into a binary column of that name.
    """
    table = Path(ranks).read_bytes()

    def make(part: pa.RecordBatch) -> list:
        ids, counts = codec(table, pattern).encode_all(texts_of(part, text))
        columns = [lists(ids, counts, pa.int32())]
        if decoded:
            columns.append(pa.array([decoded_bytes(table, x.tolist()) for x in np.split(ids, np.cumsum(counts)[:-1])], pa.binary()))
        return columns

    return with_columns(df, text, f"`{out}` array<int>" + (f", `{decoded}` binary" if decoded else ""), make)


def decoded_bytes(ranks: bytes, ids: list[int]) -> bytes:
    return b"".join(map(spellings(ranks).__getitem__, ids))


def decode(df: DataFrame, ranks: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """`df` with the bytes that the ids stand for; null ids give empty bytes, an unknown id fails the job."""
    table = Path(ranks).read_bytes()
    kept = [f for f in df.schema.fields if f.name != out]
    names = [f.name for f in kept] + [out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slabs(batches, ids, SLAB // 8):
            found = [decoded_bytes(table, x or []) for x in part.column(part.schema.get_field_index(ids)).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(n) for n in names[:-1]] + [pa.array(found, pa.binary())], names=names)

    return df.select(*names[:-1]).mapInArrow(batchwise(run), StructType([*kept, StructField(out, BinaryType())]))
