"""Language identification by rank-order profiles of n-grams.

A language's profile is its most frequent n-grams (one to three bytes of letters, within words and
their borders) in order of frequency. A document's own most frequent n-grams are compared with each
profile by out-of-place distance: how far each stands from its place in the profile, and the
profile's length if it is not in it. The nearest profile gives the language.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martwright.llm.batches import batchwise, slabs, texts_of, with_columns
from martwright.llm.words import PIECE, _pieces

PROFILE = 400  # n-grams in a language's profile
LOOKED_AT = 300  # most frequent n-grams of a document that are compared
MOST_LANGUAGES = 2000  # profiles are sent to all tasks: at most 2000 x 400 rows
UNKNOWN = "und"
NEAR = 0.2  # documents with a lower score are in none of the languages

_LETTER = np.full(256, 32, np.uint8)  # all but letters and bytes of longer characters count as space
_LETTER[97:123] = np.arange(97, 123)
_LETTER[65:91] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)


def _codes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all n-grams, and the position of each. Each text has a space before and behind it."""
    c = data.astype(np.int64)
    letter = data != 32
    one = np.flatnonzero(letter)
    two = np.flatnonzero(letter[:-1] | letter[1:])
    three = np.flatnonzero(letter[1:-1])
    return np.concatenate((1 << 24 | c[one], 2 << 24 | c[two] << 8 | c[two + 1],
                           3 << 24 | c[three] << 16 | c[three + 1] << 8 | c[three + 2])), np.concatenate((one, two, three))


def _counted(keys: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and how often each occurs."""
    if weights is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys, weights = keys[order], weights[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    if weights is None:
        return keys[first], np.diff(first, append=len(keys))
    return keys[first], np.add.reduceat(weights, first) if len(first) else weights


def counted(texts: list[bytes]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """N-gram counts of texts in order: first and end of a run of texts; text in the run, code, count."""
    i = 0
    while i < len(texts):
        if len(texts[i]) > PIECE:
            codes = counts = np.zeros(0, np.int64)
            for piece in _pieces(texts[i]):
                more = _counted(_codes(_LETTER[np.frombuffer(b" " + piece + b" ", np.uint8)])[0])
                codes, counts = _counted(np.concatenate((codes, more[0])), np.concatenate((counts, more[1])))
            yield i, i + 1, np.zeros(len(codes), np.int64), codes, counts
            i += 1
            continue
        j, size = i, 0
        while j < len(texts) and j < i + 4096 and size + len(texts[j]) <= PIECE:
            size += len(texts[j]) + 2
            j += 1
        data = _LETTER[np.frombuffer(b"".join(b" " + t + b" " for t in texts[i:j]), np.uint8)]
        ends = np.cumsum([len(t) + 2 for t in texts[i:j]])
        of = np.repeat(np.arange(j - i), np.diff(ends, prepend=0))
        codes, at = _codes(data)
        # A run over a border has its text by its first byte; such a run of three has a letter in its middle.
        keys, counts = _counted(of[at] << 26 | codes)
        yield i, j, keys >> 26, keys & ((1 << 26) - 1), counts
        i = j


def learn(df: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """Profiles of all languages in `df`: lang, code, place (from 0). Counts cover all rows with a language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for part in slabs(batches, text):
            langs = part.column(part.schema.get_field_index(lang)).to_pylist()
            texts = [t.encode() for t in texts_of(part, text)]
            for i, j, of, codes, counts in counted(texts):
                own = np.array(langs[i:j], object)
                for name in set(langs[i:j]):
                    mine = (own == name)[of]
                    old = sums.get(name, (codes[:0], counts[:0]))
                    sums[name] = _counted(np.concatenate((old[0], codes[mine])), np.concatenate((old[1], counts[mine])))
        for name, (codes, counts) in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(codes)), pa.array(codes), pa.array(counts)], names=["lang", "code", "n"])

    known = df.filter(F.col(lang).isNotNull()).select(F.col(lang).alias(lang), text)
    counts = known.mapInArrow(batchwise(run), "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code")) - 1
    return counts.withColumn("place", place).filter(F.col("place") < PROFILE).select("lang", "code", "place")


class Profiles:
    """All profiles as one table: codes in order, and the place of each in each language."""

    def __init__(self, rows: list[tuple[str, int, int]]):
        self.langs = sorted({r[0] for r in rows})
        column = {name: k for k, name in enumerate(self.langs)}
        self.codes = np.unique(np.array([r[1] for r in rows], np.int64))
        self.places = np.full((len(self.codes) + 1, len(self.langs)), -1, np.int32)
        for name, code, place in rows:
            self.places[np.searchsorted(self.codes, code), column[name]] = place

    def nearest(self, texts: list[str]) -> tuple[list[str], list[float]]:
        """Language of each text and how near its profile is: 1 in full agreement, 0 with nothing in common."""
        found, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if not self.langs:
            return found, scores
        for i, j, of, codes, counts in counted([t.encode() for t in texts]):
            order = np.lexsort((codes, -counts, of))
            of, codes = of[order], codes[order]
            first = np.searchsorted(of, np.arange(j - i))
            place = np.arange(len(of)) - first[of]
            kept = place < LOOKED_AT
            of, codes, place = of[kept], codes[kept], place[kept]
            at = np.searchsorted(self.codes, codes)
            at[(at == len(self.codes)) | (self.codes[np.minimum(at, len(self.codes) - 1)] != codes)] = len(self.codes)
            places = self.places[at]
            apart = np.where(places < 0, PROFILE, np.abs(places - place[:, None].astype(np.int32)))
            first = np.flatnonzero(np.diff(of, prepend=-1))
            if not len(first):
                continue
            total, n = np.add.reduceat(apart, first), np.diff(first, append=len(of))
            best = total.argmin(1)  # of equal distances the first language in alphabetical order
            for row, k in enumerate(of[first]):
                if any(map(str.isalpha, texts[i + k])):
                    found[i + k] = self.langs[best[row]]
                    scores[i + k] = float(1 - total[row, best[row]] / (n[row] * PROFILE))
        return found, scores


def predict(df: DataFrame, profiles: DataFrame, text: str = "text") -> DataFrame:
    """`df` with lang_pred and score; columns with these names give way.

    Null texts and texts without a letter get `und` and 0, and so do all if there is no profile.
    """
    rows = [tuple(r) for r in profiles.select("lang", "code", "place").limit(PROFILE * MOST_LANGUAGES + 1).collect()]
    if len(rows) > PROFILE * MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    table = Profiles(rows)

    def make(part: pa.RecordBatch) -> list:
        found, scores = table.nearest(texts_of(part, text))
        return [pa.array(found, pa.string()), pa.array(scores, pa.float64())]

    return with_columns(df, text, "lang_pred string, score double", make)


def held_out(doc_id: str = "doc_id", modulus: int = 4, rest: int = 2) -> Column:
    """Whether a row is kept from learning, by the CRC-32 of its id as text; a null id counts as empty."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % modulus == rest


def in_known_language(df: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of `df` whose text is in one of the languages that its labelled rows teach."""
    profiles = learn(df.filter(~held_out(doc_id)), text, lang)
    columns = [c for c in df.columns if c not in ("lang_pred", "score")]
    found = predict(df.select(*columns), profiles, text)
    return found.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= NEAR)).select(*columns)
