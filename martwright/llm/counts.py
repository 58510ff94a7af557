"""Token counts of whole texts and of all their prefixes (method: prefix dynamic programming).

For a SentencePiece BPE model with byte fallback. The exact count of every prefix is known, so
whether a text fits a budget, and where it has to end to fit, needs no encoding of shortened texts.
"""

from __future__ import annotations

import re
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from martwright.llm.batches import lists, texts_of, with_columns
from martwright.llm.prefix_bpe import Merges
from martwright.llm.remembered import Remembered, per_text

PIECE = 1 << 20  # bytes that are cut into words at a time, or one text
SPACE = "▁"  # stands for a space in the model's pieces
_WORDS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


def stretches(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All texts in one array, starts and ends of their words, and the number of words of each text.

    Each text has its first space already. A word begins with a text, or with a space that has neither
    a space nor the last byte of a space sign before it.
    """
    raw = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    begins = np.cumsum(sizes) - sizes
    border = raw == 32
    border[1:] &= (raw[:-1] != 32) & (raw[:-1] != SPACE.encode()[-1])
    border[begins[sizes > 0]] = True
    starts = np.flatnonzero(border)
    return raw, starts, np.append(starts[1:], len(raw)), np.diff(np.searchsorted(starts, np.append(begins, len(raw))))


class Counter:
    """Counts by one model."""

    def __init__(self, model: bytes):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_proto=model)
        ids = range(sp.vocab_size())
        normal = [i for i in ids if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        pieces = {sp.id_to_piece(i): sp.get_score(i) for i in normal}
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            raise ValueError("pieces that go on behind a space cannot be counted word by word")
        self.merges = Merges({p: r for r, p in enumerate(sorted(pieces, key=lambda p: -pieces[p]))})
        self.remembered = Remembered(self.learn)

    @staticmethod
    def weight(token: int) -> int:
        """Tokens that one symbol becomes: an unknown character is spelled in bytes."""
        return 1 if token >= 0 else len(chr(-1 - token).encode())

    def learn(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The count of each word, a stretch of text that no piece reaches out of."""
        texts = [w.decode().replace(" ", SPACE) for w in words]
        order = sorted(range(len(texts)), key=texts.__getitem__)
        out = np.zeros(len(texts), np.int32)
        for k, ids in zip(order, self.merges.encode_all([texts[k] for k in order])):
            out[k] = len(ids) if not ids or min(ids) >= 0 else sum(map(self.weight, ids))
        return out, np.ones(len(texts), np.int32)

    def count_all(self, texts: list[str]) -> np.ndarray:
        counts, i = np.zeros(len(texts), np.int64), 0
        data = [(" " + t).encode() if t else b"" for t in texts]
        while i < len(data):
            j, size = i + 1, len(data[i])
            while j < len(data) and size + len(data[j]) <= PIECE:
                size += len(data[j])
                j += 1
            if size:
                raw, starts, ends, own = stretches(data[i:j])
                counts[i:j] = per_text(self.remembered(raw, starts, ends)[0], own)
            i = j
        return counts

    def count(self, text: str) -> int:
        return int(self.count_all([text])[0])

    @staticmethod
    def words(text: str) -> list[str]:
        """Words with the spaces before them; no piece reaches over their borders."""
        return _WORDS.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def prefix_counts(self, text: str) -> list[int]:
        """The count of every prefix of `text`, from one character on."""
        out, before = [], 0
        for word in self.words(text):
            inner = self.merges.prefix_counts(self.merges.last_tokens(word), self.weight)
            out += [before + c for c in inner]
            before = out[-1]
        return out[1:]  # without the sign put before the text

    def fitting(self, text: str, budget: int) -> int:
        """The largest number of leading characters that need at most `budget` tokens."""
        raw, starts, ends, _ = stretches([(" " + text).encode()])
        counts = self.remembered(raw, starts, ends)[0]
        sums = np.cumsum(counts, dtype=np.int64)
        full = int(np.searchsorted(sums, budget, "right"))
        if full == len(sums):
            return len(text)
        # A prefix may need more tokens than a longer one, but no fewer than its whole words. So the end
        # is in the first word that does not fit, or in a word that begins before the budget is used up.
        best = position = len(raw[:starts[full]].tobytes().decode()) - 1
        before, word = int(sums[full] - counts[full]), full
        while word < len(sums) and before <= budget:
            piece = raw[starts[word]:ends[word]].tobytes().decode().replace(" ", SPACE)
            for c in self.merges.prefix_counts(self.merges.last_tokens(piece), self.weight):
                position += 1
                if before + c <= budget:
                    best = max(best, position)
            before, word = int(sums[word]), word + 1
        return max(best, 0)


@lru_cache(4)
def counter(model: bytes) -> Counter:
    return Counter(model)


def token_counts(df: DataFrame, model: str, limit: int, text: str = "text") -> DataFrame:
    """`df` with `n_tokens` and `fitting_chars`, the most leading characters that need at most `limit` tokens.

    Null counts as empty: no tokens. Columns with these names give way. The driver reads the model
    file (its size is that of a vocabulary) and sends it with the tasks.
    """
    blob = Path(model).read_bytes()

    def make(part: pa.RecordBatch) -> list:
        own, texts = counter(blob), texts_of(part, text)
        counts = own.count_all(texts).tolist()
        fits = [len(t) if n <= limit else own.fitting(t, limit) for t, n in zip(texts, counts)]
        return [pa.array(counts, pa.int64()), pa.array(fits, pa.int64())]

    return with_columns(df, text, "n_tokens long, fitting_chars long", make)


def prefix_counts(df: DataFrame, model: str, text: str = "text", out: str = "prefix_counts") -> DataFrame:
    """`df` with the exact count of every prefix of each text, as array<int>; empty for null and empty texts."""
    blob = Path(model).read_bytes()

    def make(part: pa.RecordBatch) -> list:
        own = counter(blob)
        found = [np.array(own.prefix_counts(t), np.int32) for t in texts_of(part, text)]
        return [lists(np.concatenate(found), np.array([len(x) for x in found]), pa.int32())]

    return with_columns(df, text, f"`{out}` array<int>", make)
