"""Which sources differ within a language, and by which terms (method: hash-consed segment trees).

The terms of a language that are in enough documents get numbers, frequent terms first. Every group (a
language and a source) has a segment tree over these numbers, whose leaves are its counts. Nodes are
hash-consed: a node is named by its two children, so equal subtrees, of one group or of two, are one
node. Two groups are compared by walking both trees together. A pair of nodes that comes up again is
not walked again but counted, so each distinct pair of subtrees is priced once; in the long tail,
where counts are nought or one, that is a few pairs for thousands of terms.

On Spark a tree is cut at the level of SPAN terms. A segment, with all groups of a language, is one task,
or several, each for two blocks of BLOCK sources, so that no task holds more than 2 * BLOCK * SPAN counts. The
segments' shares of a pair are summed, and of each segment the best terms of a group go on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martwright.llm.batches import slabs
from martwright.operators.ordered import Ordered
from martwright.session import cut

SPAN = 4096  # terms of a segment, a power of two
BLOCK = 64  # sources of a block
HELD = 1 << 20  # terms whose counts a task sums before it passes them on
UNIT = 1_000_000_000
LETTERS = "abcdefghijklmnopqrstuvwxyz"
NO_TERM = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"

_COUNTED = "lang string, source string, term string, n long, docs long"
_FOUND = "lang string, source string, part string, item string, value long"


def _count_slab(batch: pa.RecordBatch) -> pa.Table:
    """lang, source, term, n, docs of some documents (lang, source, text)."""
    words = pc.split_pattern_regex(batch.column(2), NO_TERM)
    row, word = pc.list_parent_indices(words), pc.list_flatten(words)
    keep = pc.not_equal(word, "")
    row, word = row.filter(keep).to_numpy().astype(np.int64), word.filter(keep).dictionary_encode()
    groups = pa.StructArray.from_arrays([batch.column(0), batch.column(1)], ["lang", "source"])
    names: dict[tuple, int] = {}
    group = np.array([names.setdefault((g["lang"], g["source"]), len(names)) for g in groups.to_pylist()], np.int64)
    size = max(len(word.dictionary), 1)
    in_docs, n = np.unique(row * size + word.indices.to_numpy(), return_counts=True)
    keys, back = np.unique(group[in_docs // size] * size + in_docs % size, return_inverse=True)
    who = list(names)
    take = keys // size
    return pa.table({
        "lang": pa.array([g[0] for g in who], pa.string()).take(pa.array(take)), "source": pa.array([g[1] for g in who], pa.string()).take(pa.array(take)),
        "term": word.dictionary.cast(pa.string()).take(pa.array(keys % size)),
        "n": np.bincount(back, n, len(keys)).astype(np.int64), "docs": np.bincount(back, minlength=len(keys)).astype(np.int64)})


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.Table] = []
    rows = 0
    for part in slabs(batches, "text"):
        held.append(_count_slab(part))
        rows += held[-1].num_rows
        if rows > HELD:  # what the slabs have in common is summed before it is passed on
            summed = pa.concat_tables(held).group_by(["lang", "source", "term"]).aggregate([("n", "sum"), ("docs", "sum")])
            held = [summed.rename_columns(["lang", "source", "term", "n", "docs"])]
            rows = held[0].num_rows
            if rows > HELD // 2:
                yield from held.pop().to_batches(65536)
                rows = 0
    if rows:
        summed = pa.concat_tables(held).group_by(["lang", "source", "term"]).aggregate([("n", "sum"), ("docs", "sum")])
        yield from summed.rename_columns(["lang", "source", "term", "n", "docs"]).to_batches(65536)


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents) of `docs` (lang, source, text); nulls count as ''."""
    lower = F.translate("text", LETTERS.upper(), LETTERS)
    known = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")], F.coalesce(lower, F.lit("")).alias("text"))
    return known.mapInArrow(_count, _COUNTED).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


# ---- what a segment's task does -----------------------------------------------------------------

def probability(count: np.ndarray, total: int) -> np.ndarray:
    """1 + floor(UNIT * count / total), exactly: long division, three decimal digits at a time."""
    share, rest = np.divmod(count, total)
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, total)
        share = share * 1000 + digits
    return share + 1


def price(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


class Forest:
    """Hash-consed trees over the rows of `counts`, whose width is a power of two."""

    def __init__(self, counts: np.ndarray):
        self.values, at = np.unique(counts, return_inverse=True)
        nodes = at.reshape(counts.shape).astype(np.int64)
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []  # left and right child of each node, leaves upwards
        size = len(self.values)
        while nodes.shape[1] > 1:
            pairs, at = np.unique(nodes[:, ::2] * size + nodes[:, 1::2], return_inverse=True)
            self.levels.append((pairs // size, pairs % size))
            nodes = at.reshape(nodes.shape[0], -1).astype(np.int64)
            size = len(pairs)
        self.roots = nodes[:, 0]

    def together(self, one: int, others: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The walk of tree `one` with each of `others`: (which other, value there, value here, times) of all pairs of leaves."""
        other, x, y = np.arange(len(others)), self.roots[others], np.full(len(others), self.roots[one])
        times = np.ones(len(others), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            left, right = self.levels[k]
            below = len(self.levels[k - 1][0]) if k else len(self.values)
            other = np.concatenate((other, other))
            x, y = np.concatenate((left[x], right[x])), np.concatenate((left[y], right[y]))
            pairs, at = np.unique((other * below + x) * below + y, return_inverse=True)
            times = np.bincount(at, np.concatenate((times, times)), len(pairs)).astype(np.int64)
            other, x, y = pairs // below // below, pairs // below % below, pairs % below
        return other, self.values[x], self.values[y], times


def _compare(top: int, batches: list[pa.Table]) -> pa.Table:
    """Shares of one segment for two blocks of sources. Rows of kind 0 name the sources, others have their counts."""
    rows = pa.concat_tables(batches)
    column = {c: rows.column(c).to_numpy() for c in ("kind", "n", "total", "at", "width", "terms", "block", "a", "b")}
    head, body = np.flatnonzero(column["kind"] == 0), np.flatnonzero(column["kind"] == 1)
    lang, sources = rows.column("lang")[0].as_py(), rows.column("source").take(pa.array(head)).to_pylist()
    order = sorted(range(len(sources)), key=lambda i: sources[i].encode())
    head, sources = head[order], [sources[i] for i in order]
    a, b, width, terms = (int(column[c][head[0]]) for c in ("a", "b", "width", "terms"))
    blocks, totals, whole = column["block"][head], column["n"][head], int(column["total"][head[0]])
    number = {s: i for i, s in enumerate(sources)}
    at, n = column["at"][body], column["n"][body]
    who = np.array([number[s] for s in rows.column("source").take(pa.array(body)).to_pylist()], np.int64)
    # The last tree is the language's own; the places behind the last term hold -1 in all of them.
    counts = np.full((len(sources) + 1, SPAN), -1, np.int64)
    counts[:, :width] = 0
    counts[who, at] = n
    counts[-1, at] = column["total"][body]
    forest, found = Forest(counts), []
    last = len(sources)

    def chances(values: np.ndarray, total: int | np.ndarray) -> np.ndarray:
        return probability(np.maximum(values, 0) + 2, total + 2 * terms)

    for i in range(last):
        others = np.array([j for j in range(last) if {blocks[i], blocks[j]} == {a, b} and j > i], np.int64)
        if len(others):
            shares = np.zeros(len(others), np.int64)
            if width:
                other, there, here, times = forest.together(i, others)
                real = here >= 0
                other, there, here, times = other[real], there[real], here[real], times[real]
                f = price(chances(here, int(totals[i])), chances(there, totals[others][other]))
                np.add.at(shares, other, f * times)
            for j, share in zip(others.tolist(), shares.tolist()):
                found += [(sources[i], "pair", sources[j], share), (sources[j], "pair", sources[i], share)]
        if a == b and width and (who == i).any():
            _, there, here, _ = forest.together(i, np.array([last]))
            p, q = chances(here, int(totals[i])), chances(there, whole)
            good = (here > 0) & (p > q)
            priced = {(x, y): f for x, y, f in zip(here[good].tolist(), there[good].tolist(), price(p, q)[good].tolist())}
            mine = body[who == i]
            best = sorted((-priced[x, y], r) for x, y, r in zip(column["n"][mine].tolist(), column["total"][mine].tolist(), mine.tolist()) if (x, y) in priced)
            if len(best) > top:
                best = [x for x in best if x[0] <= best[top - 1][0]]
            named = sorted((f, rows.column("term")[r].as_py().encode()) for f, r in best)[:top]
            found += [(sources[i], "term", term.decode(), -f) for f, term in named]
    return pa.table([
        pa.array([lang] * len(found), pa.string()), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.string()),
        pa.array([x[2] for x in found], pa.string()), pa.array([x[3] for x in found], pa.int64())], names=["lang", "source", "part", "item", "value"])


# ---- on Spark -----------------------------------------------------------------------------------

def _blocks_met(block: Column, blocks: Column) -> Column:
    """All pairs (a, b), a <= b, of blocks that hold `block`."""
    return F.transform(F.sequence(F.lit(0), blocks - 1), lambda o: F.struct(F.least(block, o).alias("a"), F.greatest(block, o).alias("b")))


def divergence(docs: DataFrame, least: int = 10, top: int = 10) -> DataFrame:
    """lang, source, part, item, value, rank.

    `docs` has lang, source and text; nulls count as '', other columns are not read. Every row is a document, also one that is
    there twice. Terms are runs of letters, in a language those in at least `least` documents. A term's share in a group is
    p = 1 + floor(UNIT * (count + 2) / (N + 2 * V)) for N counts of V terms, and two shares are (p - q)^2 / (p + q) apart, rounded down.
    Part `pair`: the distance to every other source of the language over all terms, 0 if there are none. Part `term`: the `top`
    terms that a source has more of than its language. Ranks fall by value, ties ascend by the bytes of the item.
    An empty table has no rows; a language with one source has no pairs.
    """
    counts = cut(term_counts(docs))
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs")).filter(F.col("docs") >= least).drop("docs")
    # Frequent terms first, in numbers from 0 within each language.
    numbered = Ordered.of(kept, ["lang", F.desc("total"), "term"]).row_number("number")
    langs = cut(numbered.rows.groupBy("lang").agg(
        F.min("number").alias("start"), F.count("*").alias("terms"), F.sum("total").alias("total")))
    terms = cut(numbered.rows.join(langs.select("lang", "start"), "lang").select("lang", "term", "total", (F.col("number") - F.col("start")).alias("id")))
    counts = cut(counts.select("lang", "source", "term", "n").join(terms, ["lang", "term"]))

    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    groups = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")]).distinct().join(totals, ["lang", "source"], "left")
    placed = Ordered.of(groups.fillna(0, ["n"]), ["lang", "source"]).row_number("number").rows
    firsts = placed.groupBy("lang").agg(F.min("number").alias("first"), F.count("*").alias("sources"))
    of_lang = cut(firsts.join(langs.select("lang", "terms", "total"), "lang", "left").fillna(0, ["terms", "total"]))
    groups = cut(placed.join(of_lang, "lang").select(
        "lang", "source", "n", "terms", "total", F.floor((F.col("number") - F.col("first")) / BLOCK).cast("int").alias("block"),
        F.ceil(F.col("sources") / BLOCK).cast("int").alias("blocks")))

    # The directory of every segment: the sources it compares. A language without terms has one segment without terms.
    directory = groups.withColumn("segment", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("terms") / SPAN), F.lit(1)).cast("int") - 1)))
    width = F.least(F.lit(SPAN), F.col("terms") - F.col("segment") * SPAN)
    directory = directory.select(
        "lang", "source", "block", "blocks", "segment", F.lit(0).alias("kind"), "n", "total", F.lit(0).cast("long").alias("at"),
        F.greatest(width, F.lit(0)).cast("long").alias("width"), "terms", F.lit("").alias("term"))
    body = counts.join(groups.select("lang", "source", "block", "blocks"), ["lang", "source"]).select(
        "lang", "source", "block", "blocks", F.floor(F.col("id") / SPAN).cast("int").alias("segment"), F.lit(1).alias("kind"), "n", "total",
        (F.col("id") % SPAN).alias("at"), F.lit(0).cast("long").alias("width"), F.lit(0).cast("long").alias("terms"), "term")
    rows = directory.unionByName(body).withColumn("met", F.explode(_blocks_met(F.col("block"), F.col("blocks")))).select("*", "met.a", "met.b").drop("met", "blocks")

    def compare(table: pa.Table) -> pa.Table:
        return _compare(top, [table])

    found = cut(rows.groupBy("lang", "segment", "a", "b").applyInArrow(compare, _FOUND))
    pairs = found.filter("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = pairs.withColumn("rank", F.row_number().over(order))
    best = found.filter("part = 'term'").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.unionByName(best)
