"""The divergence audit against counting with dictionaries."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from martwright.llm import divergence


def brute(docs, least, top):
    seen, counts = defaultdict(Counter), defaultdict(Counter)
    groups = {(lang or "", source or "") for lang, source, _ in docs}
    for lang, source, text in docs:
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower)
        seen[lang or ""].update(set(terms))
        counts[lang or "", source or ""].update(terms)
    rows = []
    for lang, source in groups:
        kept = [t for t, n in seen[lang].items() if n >= least]
        own = {s: counts[g, s] for g, s in groups if g == lang}
        whole = sum((Counter({t: c[t] for t in kept}) for c in own.values()), Counter())

        def shares(c):
            total = sum(c[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (c[t] + 2) // total for t in kept}

        def apart(p, q):
            return (p - q) ** 2 // (p + q)

        p = shares(own[source])
        pairs = []
        for other in own:
            if other != source:
                q = shares(own[other])
                pairs.append((-sum(apart(p[t], q[t]) for t in kept), other.encode()))
        rows += [(lang, source, "pair", o.decode(), -f, k + 1) for k, (f, o) in enumerate(sorted(pairs))]
        q = shares(whole)
        terms = sorted((-apart(p[t], q[t]), t.encode()) for t in kept if own[source][t] and p[t] > q[t])[:top]
        rows += [(lang, source, "term", t.decode(), -f, k + 1) for k, (f, t) in enumerate(terms)]
    return sorted(rows)


def some(n, seed, sources=5):
    rng, docs = random.Random(seed), []
    words = ["der", "Das", "é", "Éa", "x", "naïve", "zeta", "日本", "w1"] + [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(300)]
    for _ in range(n):
        source = rng.choice([None, *[f"s{i}" for i in range(sources)]])
        weight = hash(source or "") % 7
        text = " ".join(rng.choice(words[:9 + weight * 40] or words) + rng.choice(["", ".", "-", "\n", "3"]) for _ in range(rng.randint(0, 40)))
        docs.append((rng.choice(["en", "de", None]), source, rng.choice([text, text, text, text, None, ""])))
    return docs


def rows_of(df):
    return sorted((r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in df.collect())


@pytest.mark.parametrize("span,block", [(4096, 64), (16, 2), (8, 1)])
def test_equals_brute_force(spark, monkeypatch, span, block):
    monkeypatch.setattr(divergence, "SPAN", span)
    monkeypatch.setattr(divergence, "BLOCK", block)
    docs = some(300, span)
    df = spark.createDataFrame(docs, "lang string, source string, text string")
    assert rows_of(divergence.divergence(df, 4, 3)) == brute(docs, 4, 3)


def test_nothing_kept_one_source_and_extra_columns(spark):
    docs = [("en", "a", "one two"), ("en", "b", None), ("en", "b", None), ("fr", "a", "seul"), (None, None, "")]
    df = spark.createDataFrame([(*d, 1, 2) for d in docs], "lang string, source string, text string, n int, term int")
    assert rows_of(divergence.divergence(df)) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)] == brute(docs, 10, 10)


def test_an_empty_table(spark):
    assert divergence.divergence(spark.createDataFrame([], "lang string, source string, text string")).collect() == []


def test_very_long_texts(spark):
    docs = [("en", "a", "Alpha beta " * 300_000), ("en", "b", "beta gamma " * 100_000), ("en", "b", "x" * 3_000_000)]
    df = spark.createDataFrame(docs, "lang string, source string, text string")
    assert rows_of(divergence.divergence(df, 1, 2)) == brute(docs, 1, 2)


def test_equal_subtrees_are_one_node_and_priced_once():
    counts = np.zeros((3, 1024), np.int64)
    counts[:, :4] = [[5, 1, 0, 0], [5, 1, 0, 0], [7, 0, 0, 1]]
    forest = divergence.Forest(counts)
    assert forest.roots[0] == forest.roots[1] != forest.roots[2]
    assert all(len(left) <= 5 for left, _ in forest.levels)
    other, there, here, times = forest.together(0, np.array([1, 2]))
    assert sorted(zip(other.tolist(), here.tolist(), there.tolist(), times.tolist())) == [
        (0, 0, 0, 1022), (0, 1, 1, 1), (0, 5, 5, 1), (1, 0, 0, 1021), (1, 0, 1, 1), (1, 1, 0, 1), (1, 5, 7, 1)]


def test_shares_are_exact_beyond_64_bits():
    rng = random.Random(3)
    for _ in range(200):
        total = rng.randint(1, 9 * 10**15)
        count = rng.randint(0, total)
        assert divergence.probability(np.array([count]), total).tolist() == [1 + 10**9 * count // total]
