"""Token ids in files that give every token by its address (method: directly addressable codes).

File format, all numbers little-endian:

    8 bytes "DACFILE1"; three u64: documents D, tokens T, levels L
    (D + 1) u64: first token of each document, and T
    D i64: document ids; D bytes: 1 where the id is null
    L times: u64 n; n bytes: chunks; ceil(n / 512) u64: rank directory; ceil(n / 8) bytes: continuation bitmap

Sections begin at multiples of 8 bytes. An id is split into chunks of 8 bits, lowest first. Chunk i
of a level is followed by a chunk on the next level if its bit is set, and that chunk's place is the
number of set bits before i: the directory's count for the 512 bits before, plus a few bytes' bits.
So any token is read with one look-up a level, and no block is decoded.

Files live in one folder that all executors reach. A task writes files of its own unique names and
returns them as rows; the table of these rows is the folder's list of files. A task that runs again
leaves files that no row names.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martwright.llm.batches import slabs, texts_of
from martwright.llm.remembered import Remembered, per_text, ranges
from martwright.llm.words import word_ranges
from martwright.session import scratch_path

MAGIC = b"DACFILE1"
CHUNK, BLOCK = 8, 512  # bits of an id on each level; bits that one entry of a rank directory covers
TOKENS_PER_FILE = 4 << 20  # a file ends with the document that reaches this
PIECE = 1 << 20  # bytes that are cut into words at a time, or one text
LINE = 200  # words that are encoded in one call
_PLAIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+").fullmatch  # one word to any tokenizer that splits between letters and others
_ONES = np.bitwise_count(np.arange(256, dtype=np.uint8)).astype(np.uint8)


def _padded(data: bytes) -> bytes:
    return data + b"\0" * (-len(data) % 8)


def pack(doc_ids: list[int | None], counts: np.ndarray, ids: np.ndarray) -> bytes:
    """One file's bytes."""
    starts = np.zeros(len(doc_ids) + 1, "<u8")
    np.cumsum(counts, out=starts[1:])
    levels, rest = [], ids.astype(np.uint64)
    while len(rest) or not levels:
        more = rest >= (1 << CHUNK)
        bits = np.packbits(more, bitorder="little")
        padded = np.zeros(-(-len(rest) // BLOCK) * BLOCK // 8, np.uint8)
        padded[:len(bits)] = bits
        ones = _ONES[padded].reshape(-1, BLOCK // 8).sum(1, dtype=np.uint64)
        directory = np.cumsum(ones, dtype="<u8") - ones
        levels.append((np.uint64(len(rest)).astype("<u8").tobytes(), (rest & np.uint64((1 << CHUNK) - 1)).astype(np.uint8).tobytes(),
                       directory.astype("<u8").tobytes(), padded.tobytes()))
        rest = rest[more] >> np.uint64(CHUNK)
    head = np.array([len(doc_ids), len(ids), len(levels)], "<u8").tobytes()
    named = np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes()
    parts = [MAGIC, head, starts.tobytes(), named, bytes(d is None for d in doc_ids), *(s for level in levels for s in level)]
    return b"".join(map(_padded, parts))


class TokenFile:
    """Reads tokens by address from a file's bytes, which may be a memory map."""

    def __init__(self, data):
        view, at = memoryview(data), 8
        if bytes(view[:8]) != MAGIC:
            raise ValueError("not a token file")

        def take(count: int, kind: str) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(view, kind, count, at)
            at += -(-out.nbytes // 8) * 8
            return out

        documents, self.tokens, levels = map(int, take(3, "<u8"))
        self.starts = take(documents + 1, "<u8").astype(np.int64)
        named, null = take(documents, "<i8"), take(documents, "u1")
        self.doc_ids = [None if n else int(d) for d, n in zip(named, null)]
        self.levels = []
        for _ in range(levels):
            n = int(take(1, "<u8")[0])
            blocks = -(-n // BLOCK)
            self.levels.append((take(n, "u1"), take(blocks, "<u8"), take(blocks * BLOCK // 8, "u1")))

    def at(self, i: int) -> int:
        """The token at address `i`, alone."""
        if not 0 <= i < self.tokens:
            raise IndexError(i)
        value = 0
        for level, (chunks, directory, bits) in enumerate(self.levels):
            value |= int(chunks[i]) << (CHUNK * level)
            if not bits[i >> 3] >> (i & 7) & 1:
                break
            first = i // BLOCK * (BLOCK // 8)
            i = int(directory[i // BLOCK]) + int(_ONES[bits[first:i >> 3]].sum()) + int(_ONES[bits[i >> 3] & ((1 << (i & 7)) - 1)])
        return value

    def between(self, start: int, stop: int) -> np.ndarray:
        """Tokens `start` to `stop`. On each level their chunks stand next to each other."""
        out, where = np.zeros(stop - start, np.uint32), np.arange(stop - start)
        for level, (chunks, directory, bits) in enumerate(self.levels):
            if start == stop:
                break
            out[where] |= chunks[start:stop].astype(np.uint32) << np.uint32(CHUNK * level)
            more = np.unpackbits(bits[start >> 3:(stop + 7) >> 3], bitorder="little")[start & 7:][:stop - start].astype(bool)
            where = where[more]
            block = start // BLOCK
            head = np.unpackbits(bits[block * (BLOCK // 8):(start >> 3) + 1], bitorder="little")[:start % BLOCK]
            start = int(directory[block]) + int(head.sum())
            stop = start + len(where)
        return out

    def document(self, k: int) -> np.ndarray:
        return self.between(int(self.starts[k]), int(self.starts[k + 1]))


class Words:
    """Ids of words between ASCII white space, by a tokenizer that drops white space and joins nothing over it.

    So the ids of a text are those of its words, one after the other, and each word is encoded once.
    """

    def __init__(self, model: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(model)
        self.remembered = Remembered(self.learn, np.uint32)

    def learn(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Encode many words in one call; each token goes to the word that it is of.

        Words of plain letters go by the tokenizer's own numbers of words, all others by the tokens' places in the line,
        which take longer to get.
        """
        texts = [w.decode() for w in words]
        plain = np.fromiter((_PLAIN(t) is not None for t in texts), bool, len(texts))
        ids, counts = [np.zeros(0, np.uint32)], np.zeros(len(texts), np.int64)
        order = np.concatenate((np.flatnonzero(plain), np.flatnonzero(~plain)))
        for first in range(0, len(order), LINE):
            at = order[first:first + LINE]
            some = [texts[k] for k in at.tolist()]
            found = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            ids.append(np.array(found.ids, np.uint32))
            of = self._by_number(found) if plain[at[-1]] else ()
            counts[at] = of if len(of) == len(some) else self._by_place(found, some)
        flat, of = np.concatenate(ids), counts[order]
        starts = np.empty(len(texts), np.int64)
        starts[order] = np.cumsum(of) - of
        return ranges(flat, starts, counts)[0], counts

    @staticmethod
    def _by_number(found) -> np.ndarray:
        """Tokens of each word that the tokenizer saw in a line; none if some token is of no word."""
        numbers = found.word_ids
        return np.unique([] if None in numbers else numbers, return_counts=True)[1]

    @staticmethod
    def _by_place(found, words: list[str]) -> np.ndarray:
        begins = np.cumsum([0] + [len(w) + 1 for w in words])
        return np.diff(np.searchsorted(np.array([a for a, _ in found.offsets], np.int64), begins))

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the number of ids of each."""
        found, counts, i = [np.zeros(0, np.uint32)], np.zeros(len(texts), np.int64), 0
        data = [t.encode() for t in texts]
        while i < len(data):
            j, size = i + 1, len(data[i])
            while j < len(data) and size + len(data[j]) < PIECE:
                size += len(data[j]) + 1
                j += 1
            raw = np.frombuffer(b"\n".join(data[i:j]), np.uint8)
            starts, ends = word_ranges(raw)
            begins = np.cumsum([0] + [len(t) + 1 for t in data[i:j]])
            ids, of = self.remembered(raw, starts, ends)
            counts[i:j] = per_text(of, np.diff(np.searchsorted(starts, begins)))
            found.append(ids)
            i = j
        return np.concatenate(found), counts


@lru_cache(4)
def words(model: str) -> Words:
    return Words(model)


def write(df: DataFrame, folder: str, model: str, end: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the ids of all texts, each document with the id `end` behind it, in ascending order of `doc_id`.

    Returns the list of files: place, file, n_docs, n_tokens; sorted by `place` the files follow each
    other. Null ids come first, null texts count as empty, equal ids are ordered by the texts' hash.
    `folder` is one that all executors reach.
    """
    spec = Path(model).read_text()
    where = f"{folder.rstrip('/')}/files"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(where if "://" in where else f"file://{where}")
        system.create_dir(base, recursive=True)
        own, place = words(spec), TaskContext.get().partitionId() << 32
        ids: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        docs: list[int | None] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal ids, counts, docs, held, place
            name = f"{base}/{uuid.uuid4().hex}.dac"
            with system.open_output_stream(name) as out:
                out.write(pack(docs, np.concatenate(counts), np.concatenate(ids)))
            row = pa.RecordBatch.from_pydict({"place": [place], "file": [name], "n_docs": [len(docs)], "n_tokens": [held]})
            ids, counts, docs, held, place = [], [], [], 0, place + 1
            return row

        for part in slabs(batches, text):
            docs += part.column(0).to_pylist()
            found, of = own.encode_all(texts_of(part, text))
            ids.append(np.insert(found, np.cumsum(of), end))
            counts.append(of + 1)
            held += len(ids[-1])
            if held >= TOKENS_PER_FILE:
                yield flush()
        if docs:
            yield flush()

    tied = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    ordered = df.select(F.col(doc_id).cast("long").alias("_id"), F.col(text).alias(text), tied.alias("_tie")).repartitionByRange("_id", "_tie")
    rows = ordered.sortWithinPartitions("_id", "_tie").select("_id", text)
    listing = f"{folder.rstrip('/')}/list"
    rows.mapInArrow(run, "place long, file string, n_docs long, n_tokens long").write.parquet(listing)
    return df.sparkSession.read.parquet(listing)


def read(files: DataFrame, scheme: str = "file") -> DataFrame:
    """Read all documents back: doc_id, start (ids of all documents before it), n_tokens, ids.

    `ids` are little-endian unsigned 32-bit integers in one binary value. The window runs over the
    list of files, one row for millions of tokens.
    """
    before = F.sum("n_tokens").over(Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1))
    placed = files.withColumn("start", F.coalesce(before, F.lit(0))).select("file", "start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start in zip(*(c.to_pylist() for c in batch.columns)):
                system, path = fs.FileSystem.from_uri(f"{scheme}://{name}")
                data = pa.memory_map(path).read_buffer() if scheme == "file" else system.open_input_file(path).read_buffer()
                file = TokenFile(data)
                for k in range(0, len(file.doc_ids), 2000):
                    some = range(k, min(k + 2000, len(file.doc_ids)))
                    counts = np.diff(file.starts[k:some[-1] + 2])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([file.doc_ids[i] for i in some], pa.int64()), pa.array(file.starts[some] + start, pa.int64()),
                         pa.array(counts, pa.int64()), pa.array([file.document(i).astype("<u4").tobytes() for i in some], pa.binary())],
                        names=["doc_id", "start", "n_tokens", "ids"])

    tasks = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # the list is small, the files are not
    return placed.repartition(tasks, "file").mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def write_and_read(spark: SparkSession, df: DataFrame, model: str, end: int) -> DataFrame:
    """Write `df` to a fresh folder below the shared one, and read the files back."""
    folder = scratch_path(spark, "tokens")
    return read(write(df, folder, model, end), folder.partition("://")[0] if "://" in folder else "file")
