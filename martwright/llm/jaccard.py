"""Near-duplicate documents by Jaccard similarity of word shingles (method: several global orders).

Two sets with similarity of at least `PERCENT` share at least l tokens among the first
(size - needed overlap + l) tokens of each, under whatever order all tokens are put in. So

1. under the order of hashes, sets whose leading tokens are too seldom shared with any other set
   have no partner and drop out (most do);
2. of what is left, sets meet that share one of their leading tokens under the order of rarity;
3. pairs must also share a leading token under the order of hashes and under a third order; if any
   pair of a block does, the whole sets of the block are counted and those pairs verified.

Equal sets are one class from the start. Sets that meet, directly or by way of others, form a family,
and a family is compared in square blocks of classes, so pairs are never rows and no task holds more
than two blocks. Links leave a block as a few edges and as sums.

Tokens are 64-bit hashes of shingles; classes are told apart by 128-bit digests of their sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.llm.batches import batchwise, groupwise, lists, slabs, texts_of, unused
from martwright.llm.components import components
from martwright.llm.words import mixed, shingle_hashes, word_hashes
from martwright.session import cut

PERCENT = 80  # sets link from this similarity on
SHINGLE = 5
CHUNK = 16 << 20  # bytes of text whose documents' leading tokens travel as one row
SHARD = 1 << 19  # leading tokens that one task compares
SQUARE = 512  # classes on each side of a block of comparisons
BUNDLE = 1024  # classes of small families that share a task
COLUMNS = 2048  # tokens of a block that are multiplied at a time
BROADCAST = 1 << 20  # documents left after the first filter, up to which their ids are broadcast


def overlap(n):
    """The smallest overlap that a set of `n` tokens has with a linked set."""
    return -(-PERCENT * n // 100)


def shared_least(n):
    """The number of leading tokens that linked sets of `n` tokens share under any order, as chosen here."""
    return 1 + n // 10


def leading(n):
    return n - overlap(n) + shared_least(n)


def token_sets(texts: list[bytes]) -> Iterator[np.ndarray]:
    """The sorted set of shingle hashes of each text."""
    words, counts = word_hashes(texts)
    ends = np.cumsum(counts)
    for start, end in zip(ends - counts, ends):
        yield np.unique(shingle_hashes(words[start:end], SHINGLE))


def digest(tokens: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(tokens.tobytes())


def _sketches(df: DataFrame, doc_id: str, text: str, bodies: bool = False) -> DataFrame:
    """One row for each chunk of documents: chunk, ids, sizes, digests, leading tokens under the order of hashes.

    If `bodies` is set, also the MD5 of each text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for part in slabs(batches, text, CHUNK):
            sizes, digests, heads = [], [], []
            texts = [t.encode() for t in texts_of(part, text)]
            for tokens in token_sets(texts):
                sizes.append(len(tokens))
                digests.append(digest(tokens) if len(tokens) else b"")
                heads.append(tokens[:leading(len(tokens))] if len(tokens) else tokens)
            ids = part.column(0)
            more = [pa.array([[hashlib.md5(t).digest() for t in texts]], pa.list_(pa.binary()))] if bodies else []
            yield pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([ids.to_pylist()], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int32())),
                 pa.array([digests], pa.list_(pa.binary())), lists(np.concatenate(heads).view(np.int64), np.array([sum(map(len, heads))]), pa.int64()), *more],
                names=["chunk", "ids", "sizes", "digests", "heads", *["bodies"] * bodies])
            number += 1

    read = df.select(F.col(doc_id).cast("long").alias("_id"), F.col(text).alias(text))
    kind = "chunk long, ids array<long>, sizes array<int>, digests array<binary>, heads array<long>"
    return cut(read.mapInArrow(batchwise(run), kind + ", bodies array<binary>" * bodies))


def _flat(column: pa.Array, row: int) -> np.ndarray:
    return column[row].values.to_numpy(zero_copy_only=False)


def _shared_heads(chunks: DataFrame) -> DataFrame:
    """chunk, tokens: its leading tokens that also lead a set of another class."""
    total = chunks.agg(F.sum(F.size("heads"))).first()[0] or 0
    bits = max(0, int(total // SHARD)).bit_length()

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                heads, _ = _active(batch, row)
                if not len(heads):
                    continue
                tokens, counts = np.unique(heads, return_counts=True)
                shards = (tokens >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(tokens), np.int64)
                first = np.flatnonzero(np.diff(shards, prepend=-1))
                pieces = list(zip(first, np.append(first[1:], len(tokens))))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shards[first]), pa.array([batch.column(0)[row].as_py()] * len(pieces), pa.int64()),
                     pa.array([tokens[a:b].tobytes() for a, b in pieces], pa.binary()),
                     pa.array([np.packbits(counts[a:b] > 1).tobytes() for a, b in pieces], pa.binary())],
                    names=["shard", "chunk", "tokens", "several"])

    def meet(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x, np.uint64) for x in table.column("tokens").to_pylist()]
        several = [np.unpackbits(np.frombuffer(x, np.uint8))[:len(p)] for x, p in zip(table.column("several").to_pylist(), parts)]
        every = np.concatenate(parts)
        order = np.argsort(every, kind="stable")
        first = np.flatnonzero(np.concatenate(([True], every[order][1:] != every[order][:-1])))
        seen = np.add.reduceat(np.concatenate(several)[order].astype(np.int64) + 1, first) > 1
        shared = np.empty(len(every), bool)
        shared[order] = np.repeat(seen, np.diff(first, append=len(every)))
        found = [p[s] for p, s in zip(parts, np.split(shared, np.cumsum([len(p) for p in parts])[:-1]))]
        return pa.table({"chunk": table.column("chunk"), "tokens": pa.array([f.tobytes() for f in found], pa.binary())})

    dealt = chunks.select("chunk", "sizes", "heads", "active").mapInArrow(batchwise(deal), "shard long, chunk long, tokens binary, several binary")
    return dealt.groupBy("shard").applyInArrow(groupwise(meet), "chunk long, tokens binary").filter(F.length("tokens") > 0)


def _active(batch: pa.RecordBatch, row: int) -> tuple[np.ndarray, list[tuple[int, int, np.ndarray]]]:
    """Leading tokens of the sets that stand for their class in this chunk: all together, and by place with size."""
    sizes = _flat(batch.column(batch.schema.get_field_index("sizes")), row).astype(np.int64)
    heads = _flat(batch.column(batch.schema.get_field_index("heads")), row).view(np.uint64)
    active = np.sort(_flat(batch.column(batch.schema.get_field_index("active")), row))
    ends = np.cumsum(np.where(sizes > 0, leading(sizes), 0))
    own = [(int(i), int(sizes[i]), heads[ends[i - 1] if i else 0:ends[i]]) for i in active]
    return (np.concatenate([h for _, _, h in own]) if own else heads[:0]), own


def _possible(chunks: DataFrame, shared: DataFrame) -> DataFrame:
    """_id, digest, n of the classes that share enough leading tokens with others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                known = np.sort(np.frombuffer(b"".join(batch.column(batch.schema.get_field_index("found"))[row].as_py()), np.uint64))
                _, own = _active(batch, row)
                left = []
                for place, n, head in own:
                    at = np.minimum(np.searchsorted(known, head), len(known) - 1)
                    if np.count_nonzero(known[at] == head) >= shared_least(overlap(n)):
                        left.append(place)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column(0)[row].as_py()] * len(left), pa.int64()), pa.array(left, pa.int32())], names=["chunk", "place"])

    found = shared.groupBy("chunk").agg(F.collect_list("tokens").alias("found"))  # no more than the chunk's own tokens
    return chunks.join(found, "chunk").select("chunk", "sizes", "heads", "active", "found").mapInArrow(batchwise(run), "chunk long, place int")


def _class_sets(df: DataFrame, possible: DataFrame, doc_id: str, text: str) -> DataFrame:
    """cls, digest, copies, tokens of the classes in `possible` (digest, _id, copies)."""
    ids = possible.select("_id").distinct()
    if ids.count() <= BROADCAST:
        ids = F.broadcast(ids)
    docs = df.select(F.col(doc_id).cast("long").alias("_key"), F.col(text).alias(text))
    docs = docs.join(ids, F.col("_key").eqNullSafe(F.col("_id")), "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slabs(batches, text):
            sets = list(token_sets([t.encode() for t in texts_of(part, text)]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([digest(s) if len(s) else b"" for s in sets], pa.binary()),
                 lists(np.concatenate(sets).view(np.int64), np.array([len(s) for s in sets]), pa.int64())], names=["digest", "tokens"])

    sets = docs.mapInArrow(batchwise(run), "digest binary, tokens array<long>").join(possible.select("digest", "copies"), "digest")
    return cut(sets.dropDuplicates(["digest"]).withColumn("cls", F.monotonically_increasing_id()))


def _families(classes: DataFrame) -> DataFrame:
    """cls, family of the classes that share a leading token under the order of rarity."""
    tokens = cut(classes.select("cls", F.explode("tokens").alias("token")))
    often = tokens.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1")
    ranked = tokens.join(often, "token").groupBy("cls").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("known"))
    n = F.size("tokens")
    # Tokens of one class only come first and meet nothing.
    places = (n - F.ceil(PERCENT * n / F.lit(100)) + 1 - (n - F.size("known"))).cast("int")
    heads = classes.join(ranked, "cls").withColumn("_places", places).filter("_places > 0")
    heads = cut(heads.select("cls", F.explode(F.slice("known", F.lit(1), F.col("_places"))["token"]).alias("token")))
    least = heads.groupBy("token").agg(F.min("cls").alias("v"))
    edges = heads.join(least, "token").select(F.col("cls").alias("u"), "v")
    return components(edges).select(F.col("node").alias("cls"), F.col("root").alias("family"))


def _counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many tokens each two of the sets share; only tokens of several sets are looked at."""
    m = len(sets)
    rows = np.repeat(np.arange(m), [len(s) for s in sets])
    every = np.concatenate(sets)
    order = np.argsort(every, kind="stable")
    every, rows = every[order], rows[order]
    same = np.zeros(len(every) + 1, bool)
    same[1:-1] = every[1:] == every[:-1]
    kept = same[1:] | same[:-1]
    every, rows = every[kept], rows[kept]
    columns = np.cumsum(np.concatenate(([0], (every[1:] != every[:-1]).astype(np.int64))))[:len(every)]
    out = np.zeros((m, m), np.float32)
    for first in range(0, int(columns[-1]) + 1 if len(columns) else 0, COLUMNS):
        a, b = np.searchsorted(columns, (first, first + COLUMNS))
        block = np.zeros((m, int(columns[b - 1]) - first + 1), np.float32)
        block[rows[a:b], columns[a:b] - first] = 1
        out += block @ block.T
    return out


def linked(sets: list[np.ndarray]) -> np.ndarray:
    """Which of the sets link, as a square matrix; candidates must pass the filters of two orders first."""
    sizes = np.array([len(s) for s in sets])
    heads = sizes - overlap(sizes) + 1
    first = _counts([s[:h] for s, h in zip(sets, heads)]) > 0
    third = [s[np.argsort(mixed(s), kind="stable")[:h]] for s, h in zip(sets, heads)]
    candidates = first & (_counts(third) > 0)
    np.fill_diagonal(candidates, False)
    if candidates.any():
        both = _counts(sets)
        candidates &= 100 * both >= PERCENT * (sizes[:, None] + sizes[None, :] - both)
    return candidates


def _links(classes: DataFrame, families: DataFrame) -> DataFrame:
    """cls, root, links: an edge to another class of its component (or itself), and the documents it links with."""
    members = classes.join(families, "cls").select("cls", "copies", "tokens", "family")
    sizes = families.groupBy("family").agg(F.count("*").alias("size"))
    total = sizes.agg(F.sum("size")).first()[0] or 0
    bundles = total // BUNDLE + 1
    members = members.join(sizes, "family").withColumn("blocks", F.ceil(F.col("size") / SQUARE).cast("int"))
    members = members.withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    placed = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    alone = F.col("blocks") == 1
    placed = placed.select(
        F.when(alone, F.pmod(F.xxhash64("family"), F.lit(bundles))).otherwise(F.col("family")).alias("place"), alone.alias("alone"),
        F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"), "family", "cls", "copies", "block", "tokens")

    def compare(table: pa.Table) -> pa.Table:
        family = table.column("family").to_numpy()
        order = np.argsort(family, kind="stable")
        cls, copies = table.column("cls").to_numpy()[order], table.column("copies").to_numpy()[order].astype(np.float64)
        block = table.column("block").to_numpy()[order]
        tokens = table.column("tokens").take(pa.array(order)).combine_chunks()
        offsets = tokens.offsets.to_numpy().astype(np.int64)
        flat = tokens.values.to_numpy().view(np.uint64)
        square = table.column("a")[0].as_py() == table.column("b")[0].as_py()
        firsts = np.flatnonzero(np.diff(family[order], prepend=family[order][0] - 1))
        out = []
        for a, b in zip(firsts, np.append(firsts[1:], len(order))):
            links = linked([flat[offsets[i]:offsets[i + 1]] for i in range(a, b)])
            near = np.arange(b - a)
            while True:  # the least class that can be reached inside this block
                least = np.where(links, near[None, :], b - a).min(1)
                new = np.minimum(near, least)
                new = np.minimum(new, new[new])
                if (new == near).all():
                    break
                near = new
            counted = links if square else links & (block[a:b][:, None] != block[a:b][None, :])
            degree = counted @ copies[a:b]
            out.append((cls[a:b], cls[a:b][near], degree.astype(np.int64)))
        return pa.table({k: pa.array(np.concatenate([o[i] for o in out])) for i, k in enumerate(("cls", "root", "links"))})

    return cut(placed.groupBy("place", "alone", "a", "b").applyInArrow(groupwise(compare), "cls long, root long, links long"))


def _labelled(df: DataFrame, doc_id: str, text: str, bodies: bool = False) -> tuple[DataFrame, DataFrame]:
    """The rows with a set: doc_id, n, label (equal in a component), n_links, if asked for body, the text's MD5; and all rows."""
    chunks = _sketches(df, doc_id, text, bodies)
    lists_of_rows = ["ids", "sizes", "digests", *["bodies"] * bodies]
    docs = chunks.select("chunk", F.posexplode(F.arrays_zip(*lists_of_rows)).alias("place", "d")).select(
        "chunk", "place", F.col("d.ids").alias("doc_id"), F.col("d.sizes").alias("n"), F.col("d.digests").alias("digest"), *[F.col("d.bodies").alias("body")] * bodies)
    more = ["body"] * bodies
    filled = docs.filter("n > 0")
    # A class is looked at where its first copy is.
    first = filled.groupBy("digest").agg(F.min(F.struct("chunk", "place", "doc_id", "n")).alias("f"), F.count("*").alias("copies"))
    first = cut(first.select("digest", "copies", "f.chunk", "f.place", F.col("f.doc_id").alias("_id"), "f.n"))
    active = first.groupBy("chunk").agg(F.collect_list("place").alias("active"))  # no more than the chunk's rows
    heads = chunks.select("chunk", "sizes", "heads").join(active, "chunk")
    possible = _possible(heads, _shared_heads(heads))
    possible = cut(first.join(possible, ["chunk", "place"]).select("digest", "copies", "_id"))
    classes = _class_sets(df, possible, doc_id, text)
    links = _links(classes, _families(classes))
    roots = components(links.select(F.col("cls").alias("u"), F.col("root").alias("v")).filter("u != v"))
    linked_classes = links.groupBy("cls").agg(F.sum("links").alias("links"))
    named = classes.select("cls", "digest").join(linked_classes, "cls").join(roots, F.col("cls") == F.col("node"), "left")
    label = F.coalesce(F.col("root"), F.col("cls")).cast("string")
    groups = first.select("digest", "copies").join(named.select("digest", label.alias("label"), "links"), "digest", "left")
    groups = groups.select("digest", F.coalesce("label", F.hex("digest")).alias("label"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    labelled = cut(filled.select("doc_id", "n", "digest", *more).join(groups, "digest").select("doc_id", "n", "label", "n_links", *more))
    return labelled, docs


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of `df`: doc_id, n_shingles, component_id, n_links.

    A row's set holds the distinct shingles of five words of its text; with fewer words the whole
    sequence. Null texts and texts without words have an empty set, link with nothing and are their own
    component. component_id is the smallest doc_id that links lead to; null ids do not count. n_links
    is the number of other rows with a linked set; rows with equal sets link. Ids are long integers.
    """
    labelled, docs = _labelled(df, doc_id, text)
    # Written, so that the join deals both sides anew and Spark can split a label with many rows.
    least = cut(labelled.groupBy("label").agg(F.min("doc_id").alias("component_id")))
    full = labelled.join(least, "label").select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id", "n_links")
    empty = docs.filter("n = 0").select("doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(0).cast("long").alias("n_links"))
    return full.unionByName(empty)


def one_of_each(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `df` whose id is the smallest of their component; rows without an id or a set stay.

    If rows of a component share that id, one of them stays. A row goes by its id and text, so one that
    shares no more than its id with another stays when that one goes.
    """
    rows = _labelled(df, doc_id, text, bodies=True)[0].filter("doc_id IS NOT NULL").select("label", F.struct("doc_id", "body").alias("key"))
    first = cut(rows.groupBy("label").agg(F.min("key").alias("first")))
    others = rows.join(first, "label").filter("key != first").select("key").distinct()
    mine, went = unused(df, "_key"), unused(df, "_went")
    keyed = df.withColumn(mine, F.struct(F.col(doc_id).cast("long").alias("doc_id"), F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))).alias("body")))
    same = (F.col(f"{mine}.doc_id") == F.col(f"{went}.doc_id")) & (F.col(f"{mine}.body") == F.col(f"{went}.body"))
    left = keyed.join(others.withColumnRenamed("key", went), same, "left_anti")
    repeated = cut(rows.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("key").alias(went)))
    if not repeated.isEmpty():  # rows with equal id and text
        once = left.join(repeated, same, "left_semi").dropDuplicates([mine])
        left = left.join(repeated, same, "left_anti").unionByName(once)
    return left.drop(mine)
