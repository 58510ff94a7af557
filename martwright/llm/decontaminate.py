"""Benchmark passages in documents (method: latent semantic retrieval).

Benchmark items are cut into passages. A randomised SVD of their TF-IDF vectors, worked out over Spark
partitions, gives a small latent space; term weights come from all documents. Stretches of every
document are projected into the space and compared with the passages: a stretch with `ALIKE` of a
passage's words has a product with its vector that is known from the passage alone, so words outside
the benchmark and the size of the corpus do not matter. The space holds no more passages than it has
dimensions, so it keeps each as a whole: those whose words are the commonest. All others are looked for by their rarest words: a stretch with `ALIKE` of a passage's words lacks few
of these. What is near enough is checked word by word: the longest common subsequence with the
passage, and, for the passage that ends an item, that with the item's last sentence, its answer. So
reworded copies are found as well as verbatim ones, and texts that only share topics are left alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.llm.batches import batchwise, slabs, texts_of, unused, with_columns
from martwright.llm.words import word_hashes

PASSAGE, OVERLAP = 64, 52  # words of a passage, words that two passages of an item share: each run of so many lies in one
SHORTEST = 8  # words; shorter items occur by chance, they match nothing
STEP = 8  # words between the beginnings of stretches
RANK, EXTRA, ROUNDS = 160, 16, 2  # dimensions of the latent space, and its passages at most; more for the search, and its rounds
KEPT = 0.999  # share of its norm that the space must keep of a passage; others are looked for by their rarest words
ALIKE = 0.8  # share of a passage's words, and of the answer's, that must occur in order
PART = 4 << 20  # characters of benchmark that one search holds; a larger benchmark is searched in parts
SLAB = 1 << 20  # bytes of text that are looked at together
MEETINGS = 1 << 21  # rare words of passages met in a slab that are looked at together, or those of one passage
LEAK = "array<struct<item_id: long, similarity: double, start: long, stop: long>>"


# Here a word is a run of letters and digits, so that punctuation put around a passage changes nothing.
_LETTERS = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in range(256))


def plain_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in order, and the number of words of each."""
    return word_hashes([t.encode().translate(_LETTERS) for t in texts])


def needed(n: int) -> int:
    """How many of a passage's `n` words a stretch must have."""
    return int(np.ceil(ALIKE * n - 1e-9))


class Passages:
    """Passages of some items: words, item, and the words of the answer at the end (0 if it ends no item)."""

    def __init__(self, items: list[tuple[int, str]]):
        found, at = [], 0
        self.begins: list[int] = []  # among the words of all items, as passages overlap
        self.ends: list[int] = []
        self.item: list[int] = []
        self.answer: list[int] = []
        for item, text in items:
            words, _ = plain_words([text])
            if len(words) < SHORTEST:
                continue
            last = len(plain_words([re.split(r"(?<=[.!?])\s+", text.strip())[-1]])[0])
            starts = list(range(0, max(len(words) - OVERLAP, 1), PASSAGE - OVERLAP))
            for s in starts:
                size = min(PASSAGE, len(words) - s)
                self.begins.append(at + s)
                self.ends.append(at + s + size)
                self.item.append(item)
                self.answer.append(min(last, size) if s == starts[-1] else 0)
            found.append(words)
            at += len(words)
        self.flat = np.concatenate(found) if found else np.zeros(0, np.uint64)
        self.terms, self.numbers = np.unique(self.flat, return_inverse=True)

    def __len__(self) -> int:
        return len(self.item)

    def words(self, passage: int) -> np.ndarray:
        return self.flat[self.begins[passage]:self.ends[passage]]

    def term(self, passage: int) -> np.ndarray:
        """Numbers among the terms of a passage's words."""
        return self.numbers[self.begins[passage]:self.ends[passage]]

    def place(self, words: np.ndarray) -> np.ndarray:
        """Number of each word among the terms, or the number of terms."""
        if not len(self.terms):
            return np.zeros(len(words), np.int64)
        at = np.searchsorted(self.terms, words)
        at[self.terms[np.minimum(at, len(self.terms) - 1)] != words] = len(self.terms)
        return at


def _document_frequencies(docs: DataFrame, passages: Passages, text: str) -> tuple[np.ndarray, int]:
    """In how many stretches of `PASSAGE` words of all documents each term occurs, and the number of stretches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(passages.terms)
        sums, stretches = np.zeros(n + 1, np.int64), 0
        for part in slabs(batches, text, SLAB):
            words, counts = plain_words(texts_of(part, text))
            term = passages.place(words)
            starts = np.cumsum(counts) - counts
            inside = (np.arange(len(words)) - np.repeat(starts, counts)) // PASSAGE
            per_text = -(-counts // PASSAGE)
            stretch = inside + np.repeat(np.cumsum(per_text) - per_text, counts)
            known = term < n
            pairs = np.unique(stretch[known] * n + term[known])
            sums[:n] += np.bincount(pairs % n, minlength=n) if n else 0
            stretches += int(per_text.sum())
        sums[n] = stretches
        filled = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(filled), pa.array(sums[filled])], names=["term", "n"])

    counted = docs.select(text).mapInArrow(batchwise(run), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    found = np.zeros(len(passages.terms) + 1, np.int64)
    for term, n in counted.collect():  # one row for each term of a part of the benchmark at most
        found[term] = n
    return found[:-1], int(found[-1])


class Rarest:
    """The rarest words of passages: of `lacking` words that a stretch may lack and `hits` more, it has at least `hits`."""

    def __init__(self, passages: Passages, frequencies: np.ndarray):
        hits, sizes, terms = [], [], [np.zeros(0, np.int64)]
        for passage in range(len(passages)):
            term = passages.term(passage)
            lacking = len(term) - needed(len(term))
            hits.append(max(1, len(term) // 8))
            own = np.unique(term[np.lexsort((term, frequencies[term]))][:lacking + hits[-1]])
            sizes.append(len(own))
            terms.append(own)
        self.hits, self.sizes, self.terms = np.array(hits, np.int64), np.array(sizes, np.int64), np.concatenate(terms)
        self.passage = np.repeat(np.arange(len(passages)), self.sizes)

    def only(self, kept: np.ndarray) -> None:
        """Leave the other passages out."""
        some = kept[self.passage]
        self.terms, self.passage = self.terms[some], self.passage[some]

    def candidates(self, term: np.ndarray, n: int, counts: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Text, passage and first word of each stretch that has as many of the rarest words as it must.

        `term` has the numbers of all texts' words, of `n` terms; a stretch is as long as `lengths` says
        for its passage, and STEP words on both sides.
        """
        often = np.bincount(term, minlength=n + 1)
        met = np.bincount(self.passage, often[self.terms], len(self.hits)).astype(np.int64)  # a passage's rarest words, in all texts
        possible = (met >= self.hits)[self.passage] & (often[self.terms] > 0)
        terms, passage = self.terms[possible], self.passage[possible]
        if not len(terms):
            return
        by_term = np.argsort(term, kind="stable")
        at_term = np.cumsum(often) - often
        ends = np.cumsum(counts)
        group = np.cumsum(often[terms]) // MEETINGS
        own = np.flatnonzero(np.diff(passage, prepend=-1))
        group = np.repeat(group[own], np.diff(own, append=len(passage)))  # a passage is in one group
        borders = np.append(np.flatnonzero(np.diff(group, prepend=-1)), len(group))
        for a, b in zip(borders[:-1], borders[1:]):
            each = often[terms[a:b]]
            inside = np.arange(int(each.sum())) - np.repeat(np.cumsum(each) - each, each)
            place = by_term[np.repeat(at_term[terms[a:b]], each) + inside]
            whose, place = np.divmod(np.sort(np.repeat(passage[a:b], each) * len(term) + place), len(term))
            last = np.arange(len(whose)) + self.hits[whose] - 1
            first = np.flatnonzero(last < len(whose))
            last = last[first]
            first, last = (x[whose[first] == whose[last]] for x in (first, last))
            whose, start, stop = whose[first], place[first], place[last]
            text = np.searchsorted(ends, start, "right")
            begin = ends[text] - counts[text]
            length = lengths[whose]
            # Stretches from STEP words before start * STEP on that hold both.
            least = np.maximum((stop - begin - length - STEP) // STEP + 1, 0)
            most = np.minimum((start - begin) // STEP + 1, (counts[text] - 1) // STEP)
            n_starts = np.where(stop < ends[text], np.maximum(most - least + 1, 0), 0)
            at = np.repeat(least - np.cumsum(n_starts) + n_starts, n_starts) + np.arange(int(n_starts.sum()))
            found = np.unique(np.stack([np.repeat(text, n_starts), np.repeat(whose, n_starts), at * STEP], 1), axis=0)
            yield from map(tuple, found.tolist())


class Space:
    """The latent space of some passages: weights of terms, projected terms, projected passages; the rarest words of the others."""

    def __init__(self, passages: Passages, rarest: Rarest, dense: np.ndarray, terms: np.ndarray, weights: np.ndarray, basis: np.ndarray):
        self.passages, self.rarest = passages, rarest
        self.row = np.full(len(passages.terms) + 1, len(terms), np.int64)  # of each term among those of the space
        self.row[terms] = np.arange(len(terms))
        own = weights[terms]
        vectors = np.zeros((len(dense), len(terms)))
        for i, passage in enumerate(dense):
            np.add.at(vectors[i], self.row[passages.term(passage)], 1)
        vectors *= own / np.linalg.norm(vectors * own, axis=1, keepdims=True)
        projected = vectors @ basis
        kept = np.linalg.norm(projected, axis=1) >= KEPT
        self.dense, self.vectors = dense[kept], projected[kept]
        missed = np.abs(vectors - projected @ basis.T)[kept] * own
        # What a word of a stretch adds to its product with each passage.
        adds = np.hstack((vectors[kept] * own, np.zeros((len(self.dense), 1))))
        self.terms = np.vstack((own[:, None] * basis, np.zeros(basis.shape[1]))).astype(np.float32)
        others = np.ones(len(passages), bool)
        others[self.dense] = False
        rarest.only(others)
        # A stretch this long, begun at every STEP words, holds each passage as a whole somewhere.
        self.lengths = np.array([-(-(len(passages.words(i)) + STEP) // 16) * 16 for i in range(len(passages))], np.int64)
        self.least = np.zeros(len(self.dense))
        for i, passage in enumerate(self.dense):
            row = self.row[passages.term(passage)]
            # The words that add least, less what the space may miss in a stretch, and rounding.
            product = np.sort(adds[i, row])[:needed(len(row))].sum()
            self.least[i] = 0.999 * product - missed[i].max() * (self.lengths[passage] + 2 * STEP) - 1e-3
        # Of passages of equal length: which, and the most that each word adds to a product with one of them.
        self.alike = []
        for length in np.unique(self.lengths[self.dense]):
            mine = np.flatnonzero(self.lengths[self.dense] == length)
            self.alike.append((int(length), mine, adds[mine].max(0), int(min(needed(len(passages.words(i))) for i in self.dense[mine]))))

    def candidates(self, words: np.ndarray, counts: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Text, passage and first word of the stretch (in the text), for stretches that are near."""
        if not len(words):
            return
        term = self.passages.place(words)
        yield from self.near(term, counts)
        yield from self.rarest.candidates(term, len(self.passages.terms), counts, self.lengths)

    def near(self, term: np.ndarray, counts: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """The candidates of the latent space: stretches, and STEP words on both sides, whose product is large enough."""
        row = self.row[term]
        ends = np.cumsum(counts)
        begins = ends - counts
        per_text = -(-counts // STEP)
        text = np.repeat(np.arange(len(counts)), per_text)
        starts = begins[text] + STEP * (np.arange(len(text)) - np.repeat(np.cumsum(per_text) - per_text, per_text))
        behind_text = np.cumsum(per_text)  # the end of each text, in blocks of STEP words
        block = np.arange(len(text))
        before = np.maximum(block - 1, (behind_text - per_text)[text])
        windows, wanted = [], np.zeros(len(text) + 1, np.int64)
        for length, mine, most, least in self.alike:
            behind = np.minimum(block + length // STEP + 1, behind_text[text])
            first, stops = starts[before], np.minimum(starts + length + STEP, ends[text])
            # The most that the words can add bounds the product, and enough of them must be known.
            sums, known = (np.concatenate(([0], np.cumsum(x))) for x in (most[row], most[row] > 0))
            some = np.flatnonzero((known[stops] - known[first] >= least) & (sums[stops] - sums[first] >= self.least[mine].min()))
            np.add.at(wanted, before[some], 1)
            np.add.at(wanted, behind[some], -1)
            windows.append((mine, some, before[some], behind[some]))
        wanted = np.cumsum(wanted)[:-1] > 0
        # Stretches that overlap share their blocks: a stretch is a difference of two running sums.
        at = starts[wanted]
        stop = np.minimum(at + STEP, ends[text[wanted]])
        padded = np.append(row, len(self.terms) - 1)
        sums = np.zeros((len(at) + 1, self.terms.shape[1]))
        for column in range(STEP):
            sums[1:] += self.terms[padded[np.where(at + column < stop, at + column, len(term))]]
        np.cumsum(sums, axis=0, out=sums)
        place = np.concatenate(([0], np.cumsum(wanted)))
        for mine, chosen, first, behind in windows:
            for some in np.array_split(np.arange(len(first)), -(-len(first) // 4096) or 1):
                vectors = sums[place[behind[some]]] - sums[place[first[some]]]
                products = vectors @ self.vectors[mine].T
                for i, j in zip(*np.nonzero(products >= self.least[mine])):
                    k = chosen[some[i]]
                    yield int(text[k]), int(self.dense[mine[j]]), int(starts[k] - begins[text[k]])

    def leaks(self, texts: list[str]) -> list[list[dict]]:
        """Of each text the items that it holds a passage of: the best match of each."""
        words, counts = plain_words(texts)
        begins = np.cumsum(counts) - counts
        out: list[dict[int, dict]] = [{} for _ in texts]
        sought: dict[tuple[int, int], list[int]] = {}
        for text, passage, start in self.candidates(words, counts):
            sought.setdefault((text, passage), []).append(start)
        for (text, passage), places in sorted(sought.items()):
            target = self.passages.words(passage)
            own = [x.tolist() for x in np.unique(target, return_counts=True)]
            for start in sorted(places):  # of equally good ones the first
                length = int(self.lengths[passage])
                first, stop = max(0, start - STEP), min(int(counts[text]), start + length + STEP)
                stretch = words[begins[text] + first:begins[text] + stop]
                present = set(stretch.tolist())
                if sum(n for word, n in zip(*own) if word in present) < needed(len(target)):
                    continue  # no more than these can be in common
                share = common(target, stretch) / len(target)
                answer = self.passages.answer[passage]
                if share < ALIKE or answer and common(target[-answer:], stretch) < int(ALIKE * answer):
                    continue
                item = self.passages.item[passage]
                if out[text].get(item, {}).get("similarity", 0) < share:
                    out[text][item] = {"item_id": item, "similarity": share, "start": first, "stop": stop}
                if share == 1:
                    break
        return [sorted(found.values(), key=lambda x: x["item_id"]) for found in out]


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, by one big integer of len(a) bits for each word of `b`."""
    places: dict[int, int] = {}
    for i, w in enumerate(a.tolist()):
        places[w] = places.get(w, 0) | 1 << i
    whole = (1 << len(a)) - 1
    row = whole
    for w in b.tolist():
        hit = places.get(w)
        if hit is not None:
            kept = row & hit
            row = (row + kept | row - kept) & whole
    return len(a) - row.bit_count()


def latent_space(benchmark: DataFrame, docs: DataFrame, passages: Passages, text: str) -> Space:
    """Weights from all documents, and the leading directions of weighted passages by randomised SVD.

    `benchmark` has item and text of the same items as `passages`. The space holds the RANK passages
    whose rarest words are the commonest. Each round sends the present directions (terms x dimensions,
    14 MB at most) to the partitions, which send back their share of A^T A times them.
    """
    frequencies, stretches = _document_frequencies(docs, passages, text)
    weights = np.log((1 + stretches) / (1 + frequencies)) + 1
    rarest = Rarest(passages, frequencies)
    work = np.bincount(rarest.passage, frequencies[rarest.terms], len(passages))
    dense = np.sort(np.argsort(-work, kind="stable")[:RANK])
    held = np.unique(np.concatenate([passages.term(i) for i in dense]))
    chosen = {passages.words(i).tobytes() for i in dense}
    names, own = passages.terms[held], weights[held]
    dimensions = min(len(dense), len(held))
    rows = benchmark.select("item", "text").repartition(8)  # a part of a benchmark

    def product(directions: np.ndarray) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            share = np.zeros_like(directions)
            for batch in batches:
                some = Passages(list(zip(*(c.to_pylist() for c in batch.columns))))
                for words in map(some.words, range(len(some))):
                    if words.tobytes() not in chosen:
                        continue
                    term, tf = np.unique(np.searchsorted(names, words), return_counts=True)
                    row = tf * own[term]
                    row = row / np.linalg.norm(row)
                    share[term] += row[:, None] * (row @ directions[term])[None, :]
            yield pa.RecordBatch.from_arrays([pa.array([share.tobytes()], pa.binary())], names=["share"])

        shares = rows.mapInArrow(batchwise(run), "share binary").toLocalIterator()
        return sum((np.frombuffer(s[0]).reshape(directions.shape) for s in shares), np.zeros_like(directions))

    directions = np.random.default_rng(7).standard_normal((len(held), min(dimensions + EXTRA, len(held))))
    for _ in range(ROUNDS):
        directions, _ = np.linalg.qr(product(directions))
    small = directions.T @ product(directions)
    values, turned = np.linalg.eigh((small + small.T) / 2)
    basis = directions @ turned[:, np.argsort(-values)[:dimensions]]
    return Space(passages, rarest, dense, held, weights, basis)


def find_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", out: str = "leaks") -> DataFrame:
    """`docs` with the benchmark items that each whole text holds, as an array of structs.

    `benchmark` has item_id and text. Each leak has item_id, similarity (share of the passage's words
    that occur in order) and the words start to stop of the text that hold it. Null and empty texts
    hold none; items without id or text, and items of fewer than `SHORTEST` words, occur in none; of
    repeated items each counts once. A column named `out` gives way.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item"), "text").dropna().distinct()
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = size // PART + 1
    found = []
    plain = docs.drop(out)
    for k in range(parts):
        some = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(parts)) == k)
        passages = Passages([tuple(r) for r in some.orderBy("item", "text").collect()])  # about PART characters
        if not len(passages):
            continue
        space = latent_space(some, docs, passages, text)
        name = unused(plain, f"{out}_{k}")
        found.append(name)
        plain = with_columns(plain, text, f"`{name}` {LEAK}", _finder(space, text), SLAB)
    every = F.concat(*found) if found else F.array().cast(LEAK)
    return plain.select(*[c for c in docs.columns if c != out], every.alias(out))


def _finder(space: Space, text: str):
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("similarity", pa.float64()), ("start", pa.int64()), ("stop", pa.int64())]))
    return lambda part: [pa.array(space.leaks(texts_of(part, text)), kind)]


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of `docs` whose texts hold no benchmark item."""
    leaks = unused(docs, "_leaks")
    return find_leaks(docs, benchmark, text, leaks).filter(F.size(leaks) == 0).drop(leaks)
