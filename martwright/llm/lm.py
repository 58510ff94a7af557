"""N-gram language model in a memory-mapped trie of Elias-Fano levels.

Words are known by 64-bit hashes. Training counts pairs of neighbouring words (every text ends with
an end token, which also stands before its first word); the pairs hold the words' own counts, so the
corpus is read once. Pairs are dealt to shards by the first word's hash, and each shard becomes one
trie file:

    level 1: the hashes of its words, an Elias-Fano sequence, with quantised log probabilities of the
             words and quantised back-off weights
    pointers: where each word's followers begin on level 2, an Elias-Fano sequence
    level 2: the followers' hashes, relative to their context: context number and the upper 40 bits
             of the follower's hash form one monotone Elias-Fano sequence; with quantised log
             probabilities

A query finds its context on level 1, takes the two pointers around it, and searches the successor of
the follower between them. Absolute discounting takes DISCOUNT from each pair's count and gives it to
the words' own probabilities. Files are mapped, so a task holds in memory only what it touches.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.llm.batches import slabs, texts_of, with_columns
from martwright.llm.words import word_hashes
from martwright.session import cut, scratch_path

DISCOUNT = 0.75
END = np.uint64(1)  # stands for the end of a text; no word's hash is this in practice
STEP = 1 / 2048  # quantisation: log10 probabilities as 16-bit multiples of this
SHARD = 1 << 21  # pairs that one trie file holds, about
FOLLOWER = 40  # bits of a follower's hash on level 2
ROOM = 1 << 23  # words of a shard at most, so that context and follower fit 64 bits
BATCH = 8 << 20  # bytes of text that are counted or scored at once
HEAVY, SAMPLED = 1 / 1000, 64  # see _dealing


# ---- Elias-Fano ----

class Sequence:
    """A monotone sequence of 64-bit integers: lower bits packed, upper bits in unary with a directory."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, zeros: np.ndarray, ones: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.zeros, self.ones = n, low_bits, low, high, zeros, ones

    @classmethod
    def of(cls, values: np.ndarray) -> Sequence:
        values = values.astype(np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // max(n, 1)).bit_length() - 1)
        mask = np.uint64((1 << low_bits) - 1)
        low = np.zeros(-(-n * low_bits // 64) + 1, np.uint64)
        if low_bits:
            at = np.arange(n, dtype=np.uint64) * np.uint64(low_bits)
            word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            part = values & mask
            np.bitwise_or.at(low, word, part << shift)
            over = shift + np.uint64(low_bits) > 64
            np.bitwise_or.at(low, word[over] + 1, part[over] >> (np.uint64(64) - shift[over]))
        upper = (values >> np.uint64(low_bits)).astype(np.int64)
        length = (int(upper[-1]) if n else 0) + n + 1
        words = -(-length // 64)
        bits = np.zeros(-(-words // 8) * 8 * 64, np.uint8)
        bits[upper + np.arange(n)] = 1
        high = np.packbits(bits, bitorder="little").view(np.uint64)
        per_block = np.bitwise_count(high).reshape(-1, 8).sum(1).astype(np.int64)
        ones = np.concatenate(([0], np.cumsum(per_block)))
        return cls(n, low_bits, low, high, np.arange(len(ones)) * 512 - ones, ones)

    def _select(self, k: np.ndarray, ones: bool) -> np.ndarray:
        """Positions of the k-th one (or zero) of the unary part, counted from 0."""
        directory = self.ones if ones else self.zeros
        block = np.searchsorted(directory, k, "right") - 1
        left = k - directory[block]
        word = block * 8
        for _ in range(7):  # eight words a block
            w = self.high[np.minimum(word, len(self.high) - 1)]
            count = np.bitwise_count(w if ones else ~w).astype(np.int64)
            go = left >= count
            left, word = np.where(go, left - count, left), np.where(go, word + 1, word)
            if not go.any():
                break
        w = self.high[np.minimum(word, len(self.high) - 1)]
        w = w if ones else ~w
        bit = np.zeros(len(k), np.int64)
        for width in (32, 16, 8, 4, 2, 1):
            count = np.bitwise_count((w >> bit.astype(np.uint64)) & np.uint64((1 << width) - 1)).astype(np.int64)
            go = left >= count
            left, bit = np.where(go, left - count, left), np.where(go, bit + width, bit)
        return word * 64 + bit

    def _lower(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        at = i.astype(np.uint64) * np.uint64(self.low_bits)
        word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        out = self.low[word] >> shift
        over = shift + np.uint64(self.low_bits) > 64
        out = np.where(over, out | self.low[np.minimum(word + 1, len(self.low) - 1)] << ((np.uint64(64) - shift) & np.uint64(63)), out)
        return out & np.uint64((1 << self.low_bits) - 1)

    def at(self, i: np.ndarray) -> np.ndarray:
        """The values at places `i`."""
        if not len(i):
            return np.zeros(0, np.uint64)
        upper = (self._select(i, True) - i).astype(np.uint64)
        return upper << np.uint64(self.low_bits) | self._lower(i)

    def place(self, values: np.ndarray, start: np.ndarray | None = None, stop: np.ndarray | None = None) -> np.ndarray:
        """Place of each value between the places `start` and `stop`, or -1.

        The upper bits give the few places that can hold the value; among them the successor of its
        lower bits is searched by halving.
        """
        out = np.full(len(values), -1, np.int64)
        if not self.n or not len(values):
            return out
        upper = (values >> np.uint64(self.low_bits)).astype(np.int64)
        last = int(self.zeros[-1])
        inside = upper < min(last, 1 << 62)
        which = np.flatnonzero(inside)
        upper, wanted = upper[which], values[which] & np.uint64((1 << self.low_bits) - 1)
        low = np.zeros(len(which), np.int64)
        later = upper > 0
        low[later] = self._select(upper[later] - 1, False) - (upper[later] - 1)
        high = self._select(upper, False) - upper
        if start is not None:
            low, high = np.maximum(low, start[which]), np.minimum(high, stop[which])
        low, high = np.minimum(low, self.n), np.minimum(high, self.n)
        end = high.copy()
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            middle = (low[open_] + high[open_]) >> 1
            less = self._lower(middle) < wanted[open_]
            low[open_[less]] = middle[less] + 1
            high[open_[~less]] = middle[~less]
        hit = np.flatnonzero(low < end)
        found = hit[self._lower(low[hit]) == wanted[hit]]
        out[which[found]] = low[found]
        return out

    def parts(self) -> list[np.ndarray]:
        return [np.array([self.n, self.low_bits, len(self.low), len(self.high)], np.uint64), self.low, self.high, self.ones.astype(np.uint64)]

    @classmethod
    def read(cls, take) -> Sequence:
        n, low_bits, lows, highs = (int(x) for x in take(4))
        low, high, ones = take(lows), take(highs), take(highs // 8 + 1).view(np.int64)
        return cls(n, low_bits, low, high, np.arange(len(ones)) * 512 - ones, ones)


def quantised(values: np.ndarray) -> np.ndarray:
    """log10 values of at most 0 as 16-bit numbers, padded to whole 64-bit words."""
    levels = np.clip(np.round(-values / STEP), 0, 65535).astype(np.uint16)
    return np.concatenate((levels, np.zeros(-len(levels) % 4, np.uint16))).view(np.uint64)


class Shard:
    """One trie file."""

    def __init__(self, data):
        raw, at = np.frombuffer(data, np.uint64), 0

        def take(count: int) -> np.ndarray:
            nonlocal at
            at += count
            return raw[at - count:at]

        self.words, self.pointers, self.followers = (Sequence.read(take) for _ in range(3))
        n, m = self.words.n, self.followers.n
        self.counts = take(n)  # exact, for the base probabilities
        self.backoff = take(-(-n // 4)).view(np.uint16)
        self.pair = take(-(-m // 4)).view(np.uint16)

    @staticmethod
    def pack(first: np.ndarray, second: np.ndarray, count: np.ndarray) -> bytes:
        """From distinct pairs, sorted by first and second word."""
        starts = np.flatnonzero(np.concatenate(([True], first[1:] != first[:-1]))) if len(first) else np.zeros(0, np.int64)
        sizes = np.diff(starts, append=len(first))
        totals = np.add.reduceat(count, starts) if len(starts) else count
        context = np.repeat(np.arange(len(starts), dtype=np.uint64), sizes)
        if len(starts) > ROOM:
            raise ValueError("too many words for one shard")
        relative = context << np.uint64(FOLLOWER) | second >> np.uint64(64 - FOLLOWER)
        own = np.maximum(count - DISCOUNT, 1e-9) / np.repeat(totals, sizes)
        backoff = DISCOUNT * sizes / np.maximum(totals, 1)
        parts = [*Sequence.of(first[starts]).parts(), *Sequence.of(np.append(starts, len(first))).parts(), *Sequence.of(relative).parts(),
                 totals.astype(np.uint64), quantised(np.log10(np.minimum(backoff, 1))), quantised(np.log10(own))]
        return b"".join(np.ascontiguousarray(p).astype(np.uint64, copy=False).tobytes() for p in parts)

    def count(self, words: np.ndarray) -> np.ndarray:
        at = self.words.place(words)
        return np.where(at >= 0, self.counts[np.maximum(at, 0)] if self.words.n else 0, 0).astype(np.int64)

    def pairs(self, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Discounted share of `second` behind `first` in this file (0 if never seen), back-off weight, the file's count of `first`."""
        at = self.words.place(first)
        known = np.flatnonzero(at >= 0)
        own, weight, total = np.zeros(len(first)), np.ones(len(first)), np.zeros(len(first))
        c = at[known]
        start, stop = self.pointers.at(c).astype(np.int64), self.pointers.at(c + 1).astype(np.int64)
        value = c.astype(np.uint64) << np.uint64(FOLLOWER) | second[known] >> np.uint64(64 - FOLLOWER)
        place = self.followers.place(value, start, stop)
        seen = place >= 0
        own[known[seen]] = 10.0 ** (-STEP * self.pair[place[seen]].astype(np.float64))
        weight[known] = 10.0 ** (-STEP * self.backoff[c].astype(np.float64))
        total[known] = self.counts[c]
        return own, weight, total


@lru_cache(4096)
def opened(place: str) -> Shard | None:
    """A shard of the model, mapped where the folder is mounted; None if no pair fell into it."""
    system, path = fs.FileSystem.from_uri(place)
    if system.get_file_info(path).type == fs.FileType.NotFound:
        return None
    local = isinstance(system, fs.LocalFileSystem)
    return Shard(pa.memory_map(path).read_buffer() if local else system.open_input_file(path).read_buffer())


# ---- training ----

def texts_with_ends(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of all texts, each with its end, and the number of tokens of each."""
    words, counts = word_hashes(texts)
    return np.insert(words, np.cumsum(counts), END), counts + 1


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where rows of sorted columns differ from the row before."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _counted_pairs(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of neighbours in order of first and second word, and their counts.

    The end of one text stands before the first word of the next; so it does before the first text.
    """
    distinct, place = np.unique(words, return_inverse=True)
    end = np.searchsorted(distinct, END)
    before = np.concatenate(([end], place[:-1]))
    pairs, n = np.unique(before * len(distinct) + place, return_counts=True)
    first, second = np.divmod(pairs, len(distinct))
    return distinct[first], distinct[second], n


class Dealing:
    """To which shard a pair belongs: by its first word's hash; by its second word's if the first is a heavy word."""

    def __init__(self, bits: int, heavy: np.ndarray):
        self.bits, self.heavy = bits, heavy

    def shard(self, words: np.ndarray) -> np.ndarray:
        return (words >> np.uint64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(words), np.int64)

    def is_heavy(self, words: np.ndarray) -> np.ndarray:
        if not len(self.heavy):
            return np.zeros(len(words), bool)
        return self.heavy[np.minimum(np.searchsorted(self.heavy, words), len(self.heavy) - 1)] == words

    def of_pairs(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        return self.shard(np.where(self.is_heavy(first), second, first))


def _dealing(df: DataFrame, text: str) -> Dealing:
    """How to deal pairs, from the size of all texts and a sample of them.

    As with range partitioning, the sample decides only where work is done: words that make up at
    least `HEAVY` of a sample of one text in `SAMPLED` are heavy, of which there are 1 / HEAVY at most.
    """

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, words = 0, []
        for part in slabs(batches, text, BATCH):
            texts = texts_of(part, text)
            size += sum(map(len, texts))
            words.append(texts_with_ends([t.encode() for t in texts[::SAMPLED]])[0])
        if words:
            found, n = np.unique(np.concatenate(words), return_counts=True)
            total = int(n.sum())
            often = n >= total * HEAVY / 2
            yield pa.RecordBatch.from_arrays(
                [pa.array([size] + [0] * int(often.sum())), pa.array([total] + [0] * int(often.sum())),
                 pa.array(np.concatenate(([0], found[often].view(np.int64)))), pa.array(np.concatenate(([0], n[often])))], names=["size", "total", "word", "n"])

    seen = df.select(text).mapInArrow(look, "size long, total long, word long, n long").groupBy("word").agg(
        F.sum("size").alias("size"), F.sum("total").alias("total"), F.sum("n").alias("n"))
    rows = cut(seen)
    whole = rows.agg(F.sum("size"), F.sum("total")).first()
    size, total = whole[0] or 0, whole[1] or 0
    heavy = [r[0] for r in rows.filter((F.col("n") > 0) & (F.col("n") >= total * HEAVY)).select("word").collect()]
    bits = max(4, int(size // 8 // SHARD).bit_length())
    return Dealing(bits, np.sort(np.array(heavy, np.int64).view(np.uint64)))


def train(df: DataFrame, text: str = "text") -> Model:
    """Count pairs over all rows of `df` and write the trie below the shared folder.

    Null texts count as empty: one end.
    """
    spark, dealing = df.sparkSession, _dealing(df, text)
    folder = scratch_path(spark, "ngrams")
    place = folder if "://" in folder else f"file://{folder}"

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slabs(batches, text, BATCH):
            first, second, n = _counted_pairs(texts_with_ends([t.encode() for t in texts_of(part, text)])[0])
            shards = dealing.of_pairs(first, second)
            order = np.argsort(shards, kind="stable")
            first, second, n, shards = first[order], second[order], n[order], shards[order]
            starts = _starts(shards)
            cuts = list(zip(starts, np.append(starts[1:], len(shards))))
            yield pa.RecordBatch.from_arrays(
                [pa.array(shards[starts]), *(pa.array([column[a:b].tobytes() for a, b in cuts], pa.binary()) for column in (first, second, n.astype(np.uint32)))],
                names=["shard", "first", "second", "n"])

    def build(table: pa.Table) -> pa.Table:
        first, second = (np.frombuffer(b"".join(table.column(c).to_pylist()), np.uint64) for c in ("first", "second"))
        n = np.frombuffer(b"".join(table.column("n").to_pylist()), np.uint32).astype(np.int64)
        order = np.lexsort((second, first))
        first, second, n = first[order], second[order], n[order]
        starts = _starts(first, second)
        first, second, n = first[starts], second[starts], np.add.reduceat(n, starts)
        shard = table.column("shard")[0].as_py()
        system, base = fs.FileSystem.from_uri(place)
        system.create_dir(base, recursive=True)
        draft = f"{base}/.{shard}-{uuid.uuid4().hex}"
        with system.open_output_stream(draft) as out:
            out.write(Shard.pack(first, second, n))
        system.move(draft, f"{base}/{shard}")  # only whole files; every attempt writes the same one
        starts = _starts(first)
        words, totals, followers = first[starts], np.add.reduceat(n, starts), np.diff(starts, append=len(first))
        heavy = dealing.is_heavy(words)
        return pa.table({
            "word": np.concatenate(([0], words[heavy].view(np.int64))), "tokens": np.concatenate(([int(totals[~heavy].sum())], totals[heavy])),
            "words": np.concatenate(([int((~heavy).sum())], followers[heavy]))})

    dealt = df.select(text).mapInArrow(deal, "shard long, first binary, second binary, n binary")
    built = dealt.groupBy("shard").applyInArrow(build, "word long, tokens long, words long")
    # One row for all words that are not heavy, and one for each heavy word with its count and followers.
    sums = [tuple(r) for r in built.groupBy("word").agg(F.sum("tokens"), F.sum("words")).collect()]
    rest = next(((t, w) for word, t, w in sums if word == 0), (0, 0))
    heavy = sorted((int(np.int64(word).view(np.uint64)), t, w) for word, t, w in sums if word != 0)
    return Model(place, dealing, heavy, rest[0] + sum(h[1] for h in heavy), rest[1] + len(heavy))


# ---- scoring ----

class Model:
    """Where the trie is, how pairs were dealt, and what is known of all: heavy words (hash, count, followers), tokens, distinct tokens."""

    def __init__(self, place: str, dealing: Dealing, heavy: list[tuple[int, int, int]], tokens: int, distinct: int):
        self.place, self.dealing, self.tokens, self.distinct = place, dealing, tokens, distinct
        self.heavy = np.array([h[0] for h in heavy], np.uint64)
        self.heavy_counts = np.array([h[1] for h in heavy], np.float64)
        self.heavy_followers = np.array([h[2] for h in heavy], np.float64)

    def _by_shard(self, shards: np.ndarray) -> Iterator[tuple[Shard, np.ndarray]]:
        """Each shard that exists, and the places of the queries that go to it, in their order."""
        order = np.argsort(shards, kind="stable")
        starts = _starts(shards[order])
        for a, b in zip(starts, np.append(starts[1:], len(order))):
            shard = opened(f"{self.place}/{shards[order[a]]}")
            if shard:
                yield shard, order[a:b]

    def score(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each text: tokens, known tokens, base score, score."""
        words, counts = texts_with_ends(texts)
        starts = np.cumsum(counts) - counts
        distinct, place = np.unique(words, return_inverse=True)
        seen = np.zeros(len(distinct), np.float64)
        for shard, at in self._by_shard(self.dealing.shard(distinct)):
            seen[at] = shard.count(distinct[at])
        heavy, which = self._heavy(distinct)
        seen[heavy] = self.heavy_counts[which]
        base = (seen + 1) / (self.tokens + 1 * (self.distinct + 1))
        first = np.concatenate(([0], place[:-1]))
        first[starts] = np.searchsorted(distinct, END)  # before a text's first word stands an end
        pairs, back = np.unique(first * len(distinct) + place, return_inverse=True)
        f, s = np.divmod(pairs, len(distinct))
        own, weight, part = np.zeros(len(pairs)), np.ones(len(pairs)), np.zeros(len(pairs))
        for shard, at in self._by_shard(self.dealing.of_pairs(distinct[f], distinct[s])):
            own[at], weight[at], part[at] = shard.pairs(distinct[f[at]], distinct[s[at]])
        heavy, which = self._heavy(distinct[f])
        own[heavy] *= part[heavy] / self.heavy_counts[which]  # shares of a part of the followers so far
        weight[heavy] = DISCOUNT * self.heavy_followers[which] / self.heavy_counts[which]
        probability = np.minimum(own + weight * base[s], 1.0)

        def total(values: np.ndarray) -> np.ndarray:
            return np.add.reduceat(values, starts)

        return counts, total((seen > 0)[place].astype(np.int64)), total(np.log10(base)[place]), total(np.log10(probability)[back])

    def _heavy(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.heavy):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.heavy, words), len(self.heavy) - 1)
        hit = np.flatnonzero(self.heavy[at] == words)
        return hit, at[hit]


def score(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`df` with n_tokens, n_known, train_tokens, base_score and score; columns with these names give way.

    Scores are log10 probabilities of the whole text with its end: by the words' counts with one added,
    and by the model. Null texts count as empty.
    """

    def make(part: pa.RecordBatch) -> list:
        tokens, known, base, own = model.score([t.encode() for t in texts_of(part, text)])
        return [pa.array(tokens), pa.array(known), pa.array([model.tokens] * len(tokens), pa.int64()), pa.array(base), pa.array(own)]

    return with_columns(df, text, "n_tokens long, n_known long, train_tokens long, base_score double, score double", make)


def held_out(doc_id: str = "doc_id", modulus: int = 7, rest: int = 2) -> Column:
    """Whether a row is kept from learning, by the CRC-32 of its id as text; a null id counts as empty."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % modulus == rest
