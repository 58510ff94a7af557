"""Different texts are not taken for each other, and callers' columns are not taken for the operators' own."""

import random
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from test_texts import brute_links, documents
from tokenizers import Tokenizer

import corpus_pipeline
from martwright.llm import bpe, counts, decontaminate, exact, jaccard, lm, queries, remembered, tokenfiles, urls, words

# Words of 1,024 letters that a polynomial with any odd base takes for one, modulo 2 ** 64.
TURNED = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
OTHER = TURNED.translate(str.maketrans("ab", "ba"))
TEXTS = [TURNED, OTHER, f"{TURNED} {OTHER}", f"{OTHER} {TURNED}", f"x {OTHER}", f"x {TURNED}"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")


def test_words_of_equal_polynomials_have_hashes_of_their_own():
    hashes, counts = words.word_hashes([t.encode() for t in TEXTS])
    assert len(set(hashes.tolist())) == 3 and counts.tolist() == [1, 1, 2, 2, 2, 2]
    rng = random.Random(1)
    many = list({bytes(rng.choice(b"abAB\xc3\xa9") for _ in range(n)) for n in (7, 8, 9, 15, 16, 17, 63, 64, 65) for _ in range(300)})
    hashes, _ = words.word_hashes(many)
    assert len(set(hashes.tolist())) == len({bytes(w).lower() for w in many})


def test_ids_come_back_as_their_own_text(spark, docs):
    both = bpe.encode(docs, public_tokenizers.path(queries.BYTE_RANKS), public_tokenizers.PATTERN, decoded="decoded").collect()
    assert {r.doc_id: r.decoded.decode() for r in both} == dict(enumerate(TEXTS))


def test_token_files_and_counts_are_the_libraries(spark, docs):
    path = public_tokenizers.path(queries.WORD_MODEL)
    library = Tokenizer.from_file(path)
    read = {r.doc_id: r for r in tokenfiles.write_and_read(spark, docs, path, queries.END_ID).collect()}
    pieces = public_tokenizers.path(queries.PIECE_MODEL)
    model = sentencepiece.SentencePieceProcessor(model_file=pieces)
    counted = {r.doc_id: r.n_tokens for r in counts.token_counts(docs, pieces, 100).collect()}
    for d, text in enumerate(TEXTS):
        ids = library.encode(text, add_special_tokens=False).ids + [queries.END_ID]
        assert zlib.crc32(bytes(read[d].ids)) == zlib.crc32(np.array(ids, "<u4").tobytes())
        assert counted[d] == len(model.encode(text))


def test_a_word_never_trained_on_is_unknown(spark, docs):
    scored = {r.doc_id: r.n_known for r in lm.score(docs, lm.train(docs.filter("doc_id = 0"))).collect()}
    assert scored == {0: 2, 1: 1, 2: 2, 3: 2, 4: 1, 5: 2}


def test_links_need_words_in_common(spark, docs):
    got = {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in jaccard.near_duplicates(docs).collect()}
    want = {d: tuple(x) for d, x in brute_links(list(enumerate(TEXTS))).items()}
    assert {d: x[1] for d, x in got.items()} == {d: x[1] for d, x in want.items()} and all(x[2] == 0 for x in got.values())


def test_the_pipeline_keeps_them(spark, docs):
    full = docs.selectExpr("doc_id", "text", "'en' AS lang", "'s' AS source", "1 AS n_chars")
    for name, stage in corpus_pipeline.STAGES[1:4]:
        assert {r.doc_id for r in stage(spark, full, "/root/testdata/sf0.001").collect()} == set(range(len(TEXTS))), name
    last = corpus_pipeline.STAGES[4][1](spark, full, "/root/testdata/sf0.001").collect()
    assert len(last) == len(TEXTS) and all(r.round_trip for r in last)


@pytest.mark.parametrize("bits", [0, 2])
def test_stretches_of_one_hash_are_compared(monkeypatch, bits):
    monkeypatch.setattr(remembered, "range_hashes", lambda raw, a, b: words.range_hashes(raw, a, b) & np.uint64((1 << bits) - 1))
    learnt = []

    def learn(stretches):
        learnt.extend(stretches)
        return np.array([len(x) * 1000 + zlib.crc32(x) % 1000 for x in stretches], np.int32), np.ones(len(stretches), np.int32)

    memory, rng = remembered.Remembered(learn), random.Random(bits)
    for _ in range(60):
        texts = [bytes(rng.choice(b"abc\x00") for _ in range(rng.choice([0, 1, 2, 3, 8, 9, 64, 65, 80]))) for _ in range(rng.randint(0, 30))]
        texts += texts[:5]
        ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
        values, n = memory(np.frombuffer(b"".join(texts), np.uint8), ends - [len(t) for t in texts], ends)
        assert values.tolist() == learn(texts)[0].tolist() and n.tolist() == [1] * len(texts)


def test_a_host_of_very_many_labels(spark):
    rules = spark.createDataFrame(queries.URL_RULES, "host string, path string, verdict string")
    long = "a." * 100_000
    pages = [(1, f"https://{long}example.com/en/x"), (2, f"https://{long}net/fr/"), (3, f"https://{long}"), (4, f"https://{long}www.Example.com/en/"), (5, "x://.com/")]
    df = spark.createDataFrame(pages, "page_id long, url string")
    urls.judge(df.limit(1), rules).collect()
    start = time.time()
    got = {r.page_id: (r.rule, r.verdict) for r in urls.judge(df, rules).collect()}
    assert time.time() - start < 10
    assert got == {1: ("example.com/en/", "block"), 2: ("net/fr/", "block"), 3: (None, "allow"), 4: ("www.example.com/en/", "allow"), 5: ("com/", "allow")}


OWN_NAMES = ["_id", "_sha", "_text_sha", "_url", "_best", "_key", "_went", "_leaks", "leaks_0", "_LEAKS", "label", "key", "first", "page", "_n", "digest"]


def named(df):
    return df.withColumns({c: F.concat(F.lit(c), F.col(df.columns[0]).cast("string")) for c in OWN_NAMES if c.lower() != "_leaks" or c == "_leaks"})


def kept(df, key):
    rows = df.collect()
    own = [c for c in OWN_NAMES if c in df.columns]
    assert len(own) == len(OWN_NAMES) - 1 and all(r[c] == f"{c}{r[key]}" for r in rows for c in own)
    return {r[key] for r in rows}


def test_callers_columns_stay(spark):
    df = named(documents(spark))
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    plain = documents(spark)
    assert kept(exact.distinct_texts(df), "doc_id") == {r.doc_id for r in exact.distinct_texts(plain).collect()}
    assert kept(jaccard.one_of_each(df), "doc_id") == {r.doc_id for r in jaccard.one_of_each(plain).collect()}
    assert kept(decontaminate.decontaminate(df, benchmark), "doc_id") == {r.doc_id for r in decontaminate.decontaminate(plain, benchmark).collect()}
    assert kept(decontaminate.find_leaks(df, benchmark), "doc_id") == {r.doc_id for r in plain.collect()}
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rules = spark.createDataFrame(queries.URL_RULES, "host string, path string, verdict string")
    assert kept(urls.judge(named(pages), rules), "page_id") == {r.page_id for r in pages.collect()}
