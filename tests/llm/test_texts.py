"""Language ID, language model, deduplication, decontamination, chats and URL rules on small cases."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from martwright.llm import chat, decontaminate, exact, jaccard, langid, lm, queries, urls, words
from martwright.llm.components import components

SMALL = "/root/testdata/sf0.001"


def documents(spark, folder=SMALL):
    return spark.read.parquet(f"{folder}/documents.parquet")


def table(spark, texts, **more):
    rows = [(i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string")


# ---- words ----

def test_word_hashes_tell_words_apart_and_nothing_else(monkeypatch):
    rng = random.Random(1)
    texts = [bytes(rng.choice(b" \t\nabAB\xc3\xa9.") for _ in range(rng.randint(0, 60))) for _ in range(500)] + [b"", b" ", b"x" * 300, b"a b " * 50]
    for piece in (words.PIECE, 64):
        monkeypatch.setattr(words, "PIECE", piece)
        hashes, counts = words.word_hashes(texts)
        split = [t.lower().split() for t in texts]
        assert counts.tolist() == [len(w) for w in split]
        of = {}
        for h, w in zip(hashes.tolist(), [x for w in split for x in w]):
            assert of.setdefault(w, h) == h
        assert len(set(of.values())) == len(of)


# ---- language ID ----

def brute_language(docs):
    """Profiles and predictions with plain dictionaries."""
    def grams(text):
        clean = bytes(b if 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in text.encode())
        padded, found = b" " + clean + b" ", Counter()
        for i, b in enumerate(padded):
            if b != 32:
                found[1, padded[i:i + 1]] += 1
            if padded[i:i + 2].strip() and i + 2 <= len(padded):
                found[2, padded[i:i + 2]] += 1
            if i + 3 <= len(padded) and padded[i + 1] != 32:
                found[3, padded[i:i + 3]] += 1
        return found

    def order(found, most):
        return {g: k for k, (g, _) in enumerate(sorted(found.items(), key=lambda x: (-x[1], x[0]))[:most])}

    sums = defaultdict(Counter)
    for doc_id, text, lang in docs:
        if lang is not None and zlib.crc32(str(doc_id).encode()) % 4 != 2:
            sums[lang] += grams(text or "")
    profiles = {lang: order(found, langid.PROFILE) for lang, found in sums.items()}
    out = {}
    for doc_id, text, _ in docs:
        own = order(grams(text or ""), langid.LOOKED_AT)
        if not any(map(str.isalpha, text or "")):
            out[doc_id] = ("und", 0.0)
            continue
        far = {lang: sum(abs(p[g] - k) if g in p else langid.PROFILE for g, k in own.items()) for lang, p in profiles.items()}
        best = min(sorted(far), key=far.get)
        out[doc_id] = (best, 1 - far[best] / (len(own) * langid.PROFILE))
    return out


def test_language_query_is_the_brute_force_one(spark):
    docs = [(r.doc_id, r.text, r.lang) for r in documents(spark).collect()]
    wanted = brute_language(docs)
    rows = queries.op6_language(spark, SMALL).collect()
    assert len(rows) == len(docs)
    for row in rows:
        assert row.lang_pred == wanted[row.doc_id][0] and row.score == pytest.approx(wanted[row.doc_id][1])
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 4 == 2)
    lang = {d: x for d, _, x in docs}
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)


def test_language_of_odd_texts(spark):
    profiles = langid.learn(spark.createDataFrame([("the thin then", "en"), ("der die das", "de"), ("x", None)], "text string, lang string"))
    odd = spark.createDataFrame([(None, 1), ("", 2), ("123 !?", 3), ("then " * 300000, 4), ("中文", 5)], "text string, score int")
    found = [(r.lang_pred, r.score) for r in langid.predict(odd, profiles).collect()]
    assert [f[0] for f in found] == ["und", "und", "und", "en", "de"]
    assert found[0][1] == 0 and found[4][1] == 0 and 0 < found[3][1] <= 1
    none = langid.learn(odd.select("text", F.lit(None).cast("string").alias("lang")))
    assert {r.lang_pred for r in langid.predict(odd, none).collect()} == {"und"}


def test_long_texts_are_counted_in_pieces(monkeypatch):
    text = "the quick brown fox jumps over the lazy dog ".encode() * 40
    whole = [x[3:] for x in langid.counted([text])][0]
    monkeypatch.setattr(langid, "PIECE", 200)
    monkeypatch.setattr(words, "PIECE", 200)
    parts = [x[3:] for x in langid.counted([text])][0]
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()


# ---- language model ----

def test_elias_fano_sequences():
    rng = np.random.default_rng(2)
    for n, top in [(0, 1), (1, 5), (10, 100), (1000, 2**63), (5000, 6000), (20000, 2**40), (3000, 2**64 - 1)]:
        values = np.sort(rng.integers(0, top, n, dtype=np.uint64, endpoint=True))
        sequence = lm.Sequence.of(values)
        assert (sequence.at(np.arange(n)) == values).all()
        asked = np.concatenate((values, rng.integers(0, top, 500, dtype=np.uint64, endpoint=True)))
        first = np.searchsorted(values, asked)
        hit = (first < n) & (values[np.minimum(first, n - 1)] == asked) if n else np.zeros(len(asked), bool)
        assert (sequence.place(asked) == np.where(hit, first, -1)).all()


def brute_model(docs):
    end, count, pairs, followers = object(), Counter(), Counter(), defaultdict(set)
    split = {d: [*(t or "").encode().lower().split(), end] for d, t in docs}
    for d, tokens in split.items():
        if zlib.crc32(str(d).encode()) % 7 != 2:
            count.update(tokens)
            for a, b in zip([end, *tokens], tokens):
                pairs[a, b] += 1
                followers[a].add(b)
    n, v = sum(count.values()), len(count)
    out = {}
    for d, tokens in split.items():
        base = [(count[t] + 1) / (n + 1 * (v + 1)) for t in tokens]
        own = [p if not count[a] else max(pairs[a, b] - lm.DISCOUNT, 0) / count[a] + lm.DISCOUNT * len(followers[a]) / count[a] * p
               for a, b, p in zip([end, *tokens], tokens, base)]
        out[d] = (len(tokens), sum(count[t] > 0 for t in tokens), n, sum(map(math.log10, base)), sum(math.log10(min(p, 1)) for p in own))
    return out


@pytest.mark.parametrize("heavy", [lm.HEAVY, 1 / 20, 2.0])
def test_model_is_the_brute_force_one(spark, monkeypatch, heavy):
    monkeypatch.setattr(lm, "HEAVY", heavy)
    wanted = brute_model([(r.doc_id, r.text) for r in documents(spark).collect()])
    rows = queries.op5_lm_score(spark, SMALL).collect()
    assert len(rows) == len(wanted)
    for row in rows:
        tokens, known, n, base, score = wanted[row.doc_id]
        assert (row.n_tokens, row.n_known, row.train_tokens) == (tokens, known, n)
        assert row.base_score == pytest.approx(base, rel=1e-9)
        assert abs(row.score - score) <= 2 * lm.STEP * tokens
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_model_of_odd_texts(spark):
    df = spark.createDataFrame([(1, None, 5.0), (2, "", 5.0), (2, "", 5.0), (None, "word", 5.0)], "doc_id long, text string, score double")
    rows = lm.score(df, lm.train(df)).collect()
    assert [r.n_tokens for r in rows] == [1, 1, 1, 2] and {r.train_tokens for r in rows} == {5}
    nothing = lm.score(df, lm.train(df.limit(0))).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 and r.score == 0 for r in nothing)


# ---- exact dedup ----

def test_exact_dedup_of_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(exact, "BLOCK", 4)
    rng = random.Random(3)
    texts = ["", None, " ", "\t\n", "a", "a ", "aa  b", "aa b", "é" * 9, "x" * 100, "x" * 101]
    texts += ["".join(rng.choice("ab ") for _ in range(rng.randint(0, 12))) for _ in range(200)]
    rows = [(None if i % 17 == 3 else 5000 - i, t, "kept") for i, t in enumerate(texts)] + [(9, "same", "x"), (9, "same", "x"), (4, "same", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    plain = lambda t: "".join(" " if c in " \t\n\v\f\r" else c for c in (t or ""))
    import re
    norm = lambda t: re.sub(" +", " ", plain(t))
    groups = defaultdict(list)
    for d, t, _ in rows:
        groups[norm(t)].append(d)
    found = exact.deduplicate(df).collect()
    assert len(found) == len(rows)
    from hashlib import sha256
    by = defaultdict(list)
    for r in found:
        by[r.text_sha256].append(r)
    for text, ids in groups.items():
        mine = by[sha256(text.encode()).hexdigest()]
        known = [d for d in ids if d is not None]
        assert len(mine) == len(ids) and {r.group_size for r in mine} == {len(ids)}
        assert {r.keep_id for r in mine} == {min(known) if known else None}
        assert [r.doc_id for r in mine if r.kept] == [min(known) if known else None]
    left = exact.distinct_texts(df)
    assert left.columns == df.columns and left.count() == len(groups)
    assert exact.deduplicate(df.limit(0)).count() == 0


# ---- n-gram Jaccard join ----

def brute_links(rows):
    sets = {}
    for d, t in rows:
        w = (t or "").encode().lower().split()
        sets[d] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())
    links = defaultdict(set)
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                links[a].add(b)
                links[b].add(a)
    out = {}
    for a in ids:
        seen, todo = {a}, [a]
        while todo:
            for b in links[todo.pop()] - seen:
                seen.add(b)
                todo.append(b)
        out[a] = (len(sets[a]), min(seen), len(links[a]))
    return out


def near_texts(seed, families, copies):
    """Families of texts that were changed a little from one text, or from one another, and a passage in all texts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    shared, out = [word() for _ in range(60)], []
    for _ in range(families):
        text = [word() for _ in range(rng.choice([3, 6, 30, 200]))] + (shared if rng.random() < 0.3 else [])
        for _ in range(rng.randint(1, copies)):
            own = list(text)
            for _ in range(rng.randint(0, max(1, len(text) // 40))):
                own[rng.randrange(len(own))] = word()
            if rng.random() < 0.5:
                text = own
            out.append((" " if rng.random() < 0.5 else "\n").join(own))
    return out + ["", None, " \n", "one", "ONE", "a b c d", "a b c d e", "A b c D e"]


@pytest.mark.parametrize("square", [jaccard.SQUARE, 8])
def test_links_are_the_brute_force_ones(spark, monkeypatch, square):
    monkeypatch.setattr(jaccard, "SQUARE", square)
    monkeypatch.setattr(jaccard, "CHUNK", 5000)
    monkeypatch.setattr(jaccard, "SHARD", 1000)
    texts = near_texts(4, 40, 25)
    wanted = brute_links(list(enumerate(texts)))
    df = table(spark, texts).withColumn("digest", F.lit("clash")).repartition(4)
    found = {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in jaccard.near_duplicates(df).collect()}
    assert found == wanted
    left = {r.doc_id for r in jaccard.one_of_each(df).collect()}
    assert left == {d for d, (_, c, _) in wanted.items() if c == d}


def test_links_of_odd_rows(spark):
    rows = [(None, "a b c d e f"), (5, "a b c d e f"), (5, "a b c d e f"), (None, None)]
    found = sorted(((r.doc_id, r.component_id, r.n_links) for r in jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert found == sorted([(None, 5, 2), (5, 5, 2), (5, 5, 2), (None, None, 0)], key=str)
    assert jaccard.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_one_of_each_with_repeated_ids(spark):
    base, clean = [f"w{i}" for i in range(60)], " ".join(f"c{i}" for i in range(40))
    near = lambda k: " ".join([*base[:-1], f"x{k}"])
    rows = [(1, near(1)), (2, near(2)), (2, clean),  # the near copy of id 2 goes, the other text of id 2 stays
            (3, clean.upper() + " end"), (7, "a b c d e f g"), (7, "A b c d e f g"), (8, "z y x"), (8, "z y x"), (9, ""), (9, None), (None, near(3))]
    left = [tuple(r) for r in jaccard.one_of_each(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()]
    wanted = [(1, near(1)), (2, clean), (8, "z y x"), (9, ""), (9, None), (None, near(3))]
    assert sorted((r for r in left if r[0] != 7), key=str) == sorted(wanted, key=str)
    assert len([r for r in left if r[0] == 7]) == 1


def test_components(spark):
    rng = random.Random(6)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1100)] + [(7, 7)]
    root = {n: n for e in edges for n in e}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    wanted = {n: find(n) for a, b in edges if a != b for n in (a, b)}
    assert {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()} == wanted


# ---- benchmark decontamination ----

def test_common_subsequence():
    rng = random.Random(7)
    for _ in range(200):
        a = np.array([rng.randint(0, 5) for _ in range(rng.randint(1, 30))])
        b = np.array([rng.randint(0, 5) for _ in range(rng.randint(0, 40))])
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        assert decontaminate.common(a, b) == best[-1][-1]


def test_leaks_are_found_and_nothing_else(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7)))
    common = [word() for _ in range(30)]
    prose = lambda n: [rng.choice(common) if rng.random() < 0.5 else word() for _ in range(n)]
    items = [(k, " ".join(prose(rng.choice([10, 20, 40, 150]))) + ". " + " ".join(prose(4)) + ".") for k in range(30)]
    docs, wanted = [], set()
    for d in range(120):
        body = prose(rng.choice([0, 20, 300]))
        if d % 3 == 0:
            item, text = rng.choice(items)
            own = text.split()
            if d % 2:  # reworded: one word in ten changed, marks around it
                for i in range(0, len(own) - 6, 10):
                    own[i] = word()
                own = ["***" + own[0], *own[1:-1], own[-1] + "%%%"]
            body[len(body) // 2:len(body) // 2] = own
            wanted.add((d, item))
        docs.append(" ".join(body))
    df = table(spark, docs + [None, ""])
    bench = spark.createDataFrame([*items, items[0], (99, None), (None, "x"), (98, "too few words")], "item_id long, text string")
    found = decontaminate.find_leaks(df, bench).collect()
    assert {(r.doc_id, x.item_id) for r in found for x in r.leaks} == wanted
    left = decontaminate.decontaminate(df, bench)
    assert {r.doc_id for r in left.collect()} == set(range(len(docs) + 2)) - {d for d, _ in wanted} and left.columns == df.columns
    assert decontaminate.decontaminate(df, bench.limit(0)).count() == len(docs) + 2
    assert decontaminate.find_leaks(df.limit(0), bench).count() == 0


def brute_leaks(docs, items):
    """(document, item) by the longest common subsequence of every stretch and passage."""
    passages, found = decontaminate.Passages(items), set()
    for d, text in enumerate(docs):
        words, _ = decontaminate.plain_words([text])
        known = np.concatenate(([0], np.cumsum(np.isin(passages.flat, words))))
        for k in np.flatnonzero(known[passages.ends] - known[passages.begins] >= 0.8 * np.subtract(passages.ends, passages.begins)):
            target, answer = passages.words(k), passages.answer[k]
            length = -(-(len(target) + 8) // 16) * 16
            for start in range(0, len(words), 8):
                stretch = words[max(0, start - 8):start + length + 8]
                if decontaminate.common(target, stretch) >= 0.8 * len(target) and (
                        not answer or decontaminate.common(target[-answer:], stretch) >= int(0.8 * answer)):
                    found.add((d, passages.item[k]))
    return found


def found_leaks(spark, docs, items):
    df = table(spark, docs).repartition(3)
    rows = decontaminate.find_leaks(df, spark.createDataFrame(items, "item_id long, text string")).collect()
    return {(r.doc_id, x.item_id) for r in rows for x in r.leaks}


def reworded(rng, text, share, word):
    """`text` with so many of its words changed, the last three left."""
    own = text.split()
    for i in rng.sample(range(len(own) - 3), int(share * len(own))):
        own[i] = word()
    return own


@pytest.mark.parametrize("meetings", [decontaminate.MEETINGS, 100])
def test_leaks_of_many_items_are_the_brute_force_ones(spark, monkeypatch, meetings):
    monkeypatch.setattr(decontaminate, "MEETINGS", meetings)
    rng = random.Random(9)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(3000)]
    word = lambda: vocabulary[int(3000 * rng.random() ** 3)]
    prose = lambda n: [word() for _ in range(n)]
    items = [(k, " ".join(prose(rng.randint(9, 60))) + ". " + " ".join(prose(3))) for k in range(1200)]
    docs = []
    for d in range(150):
        body = prose(rng.choice([0, 5, 60]))
        body[len(body) // 2:len(body) // 2] = reworded(rng, items[d * 8][1], rng.choice([0, 0.1, 0.2, 0.22]), word)
        docs.append(" ".join(body))
    wanted = brute_leaks(docs, items)
    assert len(wanted) > 100
    assert found_leaks(spark, docs, items) == wanted


def test_leaks_do_not_depend_on_the_size_of_the_corpus(spark):
    rng = random.Random(10)
    steady = ["".join(rng.choice("abcde") for _ in range(4)) for _ in range(80)]
    other = lambda: "".join(rng.choice("fghij") for _ in range(8))
    items = [(k, " ".join(rng.choice(steady) for _ in range(40)) + ".") for k in range(30)]
    docs = []
    for d in range(40):
        own = [other() for _ in range(30)]
        own[15:15] = reworded(rng, items[d % 30][1], 0.19, other)
        docs.append(" ".join(own))
    wanted = brute_leaks(docs, items)
    assert len(wanted) > 30
    # More documents, in which the words of the benchmark stay as frequent as they were.
    more = [" ".join([*rng.sample(steady, 60), *(other() for _ in range(20))]) for _ in range(4000)]
    assert found_leaks(spark, docs, items) == wanted
    found = found_leaks(spark, docs + more, items)
    assert {(d, k) for d, k in found if d < len(docs)} == wanted


@pytest.mark.parametrize("n", [65, 100, 200, 203])
def test_a_run_of_a_long_item_has_enough_of_a_passage(n):
    passages = decontaminate.Passages([(1, " ".join(f"w{i}" for i in range(n)))])
    words, run = passages.flat, decontaminate.needed(decontaminate.PASSAGE)
    for start in range(n - run + 1):
        assert any(decontaminate.common(passages.words(k), words[start:start + run]) >= decontaminate.needed(len(passages.words(k))) for k in range(len(passages)))


def test_a_benchmark_in_parts_gives_the_same(spark, monkeypatch):
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    docs = documents(spark).select("doc_id", "text")
    pairs = lambda: {(r.doc_id, x.item_id) for r in decontaminate.find_leaks(docs, bench).collect() for x in r.leaks}
    whole = pairs()
    texts = {r.item_id: r.text for r in bench.collect()}
    assert whole >= {(r.doc_id, k) for r in docs.collect() for k, t in texts.items() if t in (r.text or "")} and whole
    monkeypatch.setattr(decontaminate, "PART", 2000)
    assert pairs() == whole


# ---- chats ----

def test_snapshots_collapse(spark, monkeypatch):
    monkeypatch.setattr(chat, "STRETCH", 2)
    long = [("user", f"turn {k}") for k in range(7)]
    chats = {1: long[:3], 2: long, 3: long, 4: long[:6] + [("user", "other")], 5: long[:1], 6: [("system", None)], 7: long[1:], 8: [("user", "turn 0"), ("user", "turn 0")]}
    rows = [(c, 10 + 3 * k, r, t, "extra") for c, turns in chats.items() for k, (r, t) in enumerate(turns)] + [(None, 1, "user", "lost", "extra"), (9, None, None, None, "extra")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, part string").repartition(3)
    found = chat.format_chats(df).collect()
    kept = {r.conv_id: (r.n_turns, r.n_copies) for r in found}
    assert kept == {2: (7, 2), 4: (7, 1), 6: (1, 1), 7: (6, 1), 8: (2, 1), 9: (1, 1)}
    for c in kept:
        turns = chats.get(c, [("", "")])
        text = "".join(r.text for r in sorted((r for r in found if r.conv_id == c), key=lambda r: r.part))
        assert text == "".join(f"<|im_start|>{r}\n{t or ''}<|im_end|>\n" for r, t in turns)
    assert chat.format_chats(df.limit(0)).count() == 0


def test_conversations_whose_turns_have_no_or_one_number(spark, monkeypatch):
    """Groups of turns too large for one window, with repeated rows, beside small ones: the places are those of one sort."""
    monkeypatch.setattr(chat, "ONE_WINDOW", 20)
    monkeypatch.setattr(chat, "STRETCH", 16)
    rng = random.Random(4)
    rows = [(1, None, rng.choice(["user", None, "a"]), rng.choice(["x", "", None, f"t{k}"])) for k in range(150)]
    rows += [(1, rng.choice([-3, 7, 40, 41]), "user", f"u{k}") for k in range(40)] + [(2, 5, "user", "same")] * 90
    rows += [(3, k, "user", f"v{k}") for k in range(50)] + [(None, 1, "user", "lost")]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    found = [(r.conv_id, r.place, r.part, r.turn, r.role, r.text) for r in chat.placed(df).orderBy("conv_id", "place").collect()]
    want, filled = [], [(c, t, r or "", x or "") for c, t, r, x in rows if c is not None]
    for c in (1, 2, 3):
        ordered = sorted((r for r in filled if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        want += [(c, k, k // 16, *r[1:]) for k, r in enumerate(ordered)]
    assert found == want
    whole = {r.conv_id: r.n_turns for r in chat.format_chats(df).collect()}
    assert whole == {1: 190, 2: 90, 3: 50}


# ---- URL rules ----

def test_url_rules(spark):
    rules = spark.createDataFrame(
        [*queries.URL_RULES, ("a.com", "/x", "block"), ("com", "/xx.a", "allow"), (None, "/", "block"), ("net", "/es/", "block")], "host string, path string, verdict string")
    cases = {
        "http://EXAMPLE.com/en/1": ("example.com", "/en/1", "example.com/en/", "block"),
        "https://www.example.com/en/?q": ("www.example.com", "/en/", "www.example.com/en/", "allow"),
        "https://b.www.example.com/en/": ("b.www.example.com", "/en/", "www.example.com/en/", "allow"),
        "http://xexample.com/en/": ("xexample.com", "/en/", "com/", "allow"),
        "http://example.com": ("example.com", "", None, "allow"),
        "http://a.net/es/x#y": ("a.net", "/es/x", "net/es/", "block"),
        "http://a.net?/es/": ("a.net", "", None, "allow"),
        "http://net/fr/": ("net", "/fr/", "net/fr/", "block"),
        "ftp://a.com/xyz://b": ("a.com", "/xyz://b", "a.com/x", "block"),
        "no scheme.com/": ("", "", None, "allow"), "": ("", "", None, "allow"), None: ("", "", None, "allow"), "://": ("", "", None, "allow"),
        "http://..com/": ("..com", "/", "com/", "allow"),
    }
    rows = [(k, u, "r") for k, u in enumerate(cases)] + [(99, "http://net/fr/", "r"), (99, "http://net/fr/", "r")]
    df = spark.createDataFrame(rows, "page_id long, url string, rule string")
    found = urls.judge(df, rules).collect()
    assert len(found) == len(rows)
    for r in found:
        assert (r.host, r.path, r.rule, r.verdict) == cases[r.url], r.url
    assert urls.judge(df.limit(0), rules).count() == 0
    assert {r.verdict for r in urls.judge(df, rules.limit(0)).collect()} == {urls.DEFAULT}
