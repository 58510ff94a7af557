"""Encoding, decoding, counting and token files against the public libraries."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from martwright.llm import bpe, counts, queries, tokenfiles
from martwright.llm.prefix_bpe import ManyTexts, Merges, bytes_as_text, from_ranks

RANKS = public_tokenizers.path(queries.BYTE_RANKS)
PIECES = public_tokenizers.path(queries.PIECE_MODEL)
WORDS = public_tokenizers.path(queries.WORD_MODEL)
LETTERS = "  \n\tabcdethé▁Ａ½漢字​\x00\x1c　'sST.,!?0123\U0001f600 ́"
FIXED = ["", " ", "  ", "a", " a", "a ", "a  b", "\n", " \n b", "a▁b", "it's we'll", "<|endoftext|> <s>", "x" * 3000, "ab " * 500]


def strange_texts(n, seed):
    rng = random.Random(seed)
    return FIXED + ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 40))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    ranks = {t.encode("latin-1"): r for t, r in from_ranks(open(RANKS, "rb")).items()}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return bpe.codec(open(RANKS, "rb").read(), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def counter():
    return counts.counter(open(PIECES, "rb").read())


def test_ids_are_the_library_s(codec, library):
    texts = strange_texts(4000, 1)
    ids, n = codec.encode_all(texts)
    for text, own in zip(texts, np.split(ids, np.cumsum(n)[:-1])):
        assert own.tolist() == library.encode_ordinary(text), repr(text)


def test_a_full_memory_changes_nothing(codec, library, monkeypatch):
    from martwright.llm import remembered

    monkeypatch.setattr(remembered, "MOST", 7)
    small = remembered.Remembered(codec.learn)
    monkeypatch.setattr(codec, "remembered", small)
    for text in strange_texts(300, 2):
        assert codec.encode(text).tolist() == library.encode_ordinary(text)


def test_edits_give_what_encoding_anew_gives(codec, library):
    rng = random.Random(3)
    for text in strange_texts(500, 4)[len(FIXED):]:
        document = bpe.Document(codec, text)
        for _ in range(3):
            a = rng.randint(0, len(text))
            b = a if rng.random() < 0.3 else rng.randint(a, len(text))
            new = "".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 5)))
            text = text[:a] + new + text[b:]
            document.edit(a, b, new)
            assert document.text == text and document.ids() == library.encode_ordinary(text)
        document.append(" the end")
        assert document.ids() == library.encode_ordinary(text + " the end")


def test_last_tokens_behind_an_edit_are_taken_over(codec):
    rng, merges = random.Random(5), codec.merges
    for _ in range(100):
        text = "".join(rng.choice("abcdeth") for _ in range(rng.randint(0, 400)))
        a = rng.randint(0, len(text))
        b = rng.randint(a, min(len(text), a + 5))
        edited, last = merges.respliced(text, merges.last_tokens(text), a, b, "the")
        assert edited == text[:a] + "the" + text[b:] and last == merges.last_tokens(edited)


def test_each_prefix_has_its_last_token(codec):
    text = bytes_as_text(" antidisestablishment".encode())
    last = codec.merges.last_tokens(text)
    for i in range(1, len(text) + 1):
        assert codec.merges.encode(text[:i])[-1] == last[i - 1]


def test_texts_in_step_are_encoded_as_one_by_one(codec, monkeypatch):
    from martwright.llm import prefix_bpe

    rng = random.Random(11)
    small = Merges({t: r for r, t in enumerate(["a", "b", "c", "d", "ab", "bc", "abc", "dd", "cd", "abcd", "bb", "aaa", "ca", "xyz"])})
    assert small.unreached == {"aaa", "xyz"}  # no two tokens make these
    monkeypatch.setattr(prefix_bpe, "WIDE", 30)
    monkeypatch.setattr(prefix_bpe, "IN_STEP", 64)
    monkeypatch.setattr(prefix_bpe, "NOTED", 3)
    for merges, letters, n in ((small, "abcdx\xff", 800), (codec.merges, "etaonis h\xc3\xa9\xe2", 300)):
        many = ManyTexts(merges)
        texts = ["", *("".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(n)), "abcd"]
        ids, counts = many.encode_all([t.encode("latin-1") for t in texts], {b"xyz": 13})
        for text, own in zip(texts, np.split(ids, np.cumsum(counts)[:-1])):
            assert own.tolist() == merges.encode(text), repr(text)
        ids, counts = many.encode_all([b"xyz", b"xyza", b"abcd"], {b"xyz": 13})
        assert ids[0] == 13 and counts[0] == 1 and ids[1:].tolist() == merges.encode("xyza") + merges.encode("abcd")
    assert [a.tolist() for a in many.encode_all([], {})] == [[], []]


def test_pairs_are_judged_together_as_one_by_one(codec):
    rng, many = np.random.default_rng(12), ManyTexts(codec.merges)
    left, right = rng.integers(0, 3000, 20000), rng.integers(0, 3000, 20000)
    wanted = [codec.merges.follows(a, b) for a, b in zip(left.tolist(), right.tolist())]
    assert many.follows(left, right).tolist() == wanted and not all(wanted)
    for _ in range(2):
        assert many._follows_noted(left, right).tolist() == wanted


def test_a_full_memory_keeps_what_it_met_again(monkeypatch):
    from martwright.llm import remembered

    learnt = []

    def learn(words):
        learnt.extend(words)
        return np.array([len(w) for w in words], np.int32), np.ones(len(words), np.int32)

    def ask(words):
        ends = np.cumsum([len(w) for w in words])
        values, counts = memory(np.frombuffer(b"".join(words), np.uint8), np.append(0, ends[:-1]), ends)
        assert values.tolist() == [len(w) for w in words] and counts.tolist() == [1] * len(words)

    monkeypatch.setattr(remembered, "MOST", 20)
    memory = remembered.Remembered(learn)
    common = [b"often%d" % i + b"x" * i for i in range(8)]
    for k in range(30):
        ask(common + [b"rare%d_%d" % (k, i) for i in range(6)])
        assert len(memory.keys) <= 20
    assert all(learnt.count(w) == 1 for w in common) and len(learnt) == 8 + 30 * 6
    for k in range(4):  # more met again than stay
        ask([b"many%d" % i for i in range(19)])


def test_encode_and_decode_columns(spark, library):
    rows = [(i, t, "kept", "clash") for i, t in enumerate(strange_texts(50, 6))] + [(None, None, None, None), (3, "twice", "a", "b"), (3, "twice", "a", "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, other string, ids string")
    one = bpe.encode(df, RANKS, public_tokenizers.PATTERN, decoded="at_once")
    both = bpe.decode(one, RANKS).collect()
    assert len(both) == len(rows)
    for row in both:
        assert list(row.ids) == library.encode_ordinary(row.text or "")
        assert bytes(row.decoded) == bytes(row.at_once) == (row.text or "").encode()
    empty = bpe.encode(df.limit(0), RANKS, public_tokenizers.PATTERN)
    assert empty.count() == 0 and "other" in empty.columns


def test_counts_of_texts_and_all_prefixes(counter):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = strange_texts(2000, 7)
    assert counter.count_all(texts).tolist() == [len(library.encode(t)) for t in texts]
    for text in strange_texts(150, 8)[len(FIXED):]:
        wanted = [len(library.encode(text[:i])) for i in range(1, len(text) + 1)]
        assert counter.prefix_counts(text) == wanted
        for budget in (0, 1, 3, 8):
            assert counter.fitting(text, budget) == max([0] + [i + 1 for i, n in enumerate(wanted) if n <= budget])


def test_count_columns(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows = [(1, "one two  three"), (2, None), (3, ""), (None, "word " * 40), (1, "one two  three")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_tokens", F.lit("gives way"))
    for row in counts.token_counts(df, PIECES, 5).collect():
        assert row.n_tokens == len(library.encode(row.text or ""))
        assert len(library.encode((row.text or "")[:row.fitting_chars])) <= 5
    lists = {r.doc_id: r.prefix_counts for r in counts.prefix_counts(df.filter("doc_id = 2"), PIECES).collect()}
    assert lists == {2: []}


def test_any_token_is_read_by_its_address():
    rng = np.random.default_rng(9)
    ids = np.concatenate([rng.integers(0, top, 700) for top in (2, 256, 257, 65536, 1 << 20, 1 << 31)] + [np.zeros(513, np.int64)])
    rng.shuffle(ids)
    sizes = [0, 1, 511, 512, 513, len(ids) - 1537, 0]
    file = tokenfiles.TokenFile(tokenfiles.pack([5, None, -7, 8, 9, 10, 11], np.array(sizes), ids))
    assert [file.at(i) for i in range(len(ids))] == ids.tolist()
    assert file.doc_ids == [5, None, -7, 8, 9, 10, 11]
    ends = np.cumsum(sizes)
    for k, n in enumerate(sizes):
        assert file.document(k).tolist() == ids[ends[k] - n:ends[k]].tolist()
    with pytest.raises(IndexError):
        file.at(len(ids))
    assert tokenfiles.TokenFile(tokenfiles.pack([], np.zeros(0, np.int64), np.zeros(0, np.int64))).tokens == 0


def test_words_get_the_ids_of_their_own(monkeypatch):
    library, own = Tokenizer.from_file(WORDS), tokenfiles.Words(open(WORDS).read())
    plain = ["Straße", "naïve", "the", "THE", "øre", "Ångström", "xx" * 40] + [a + b for a in "abcdeé" for b in "xyzßÀ"] * 10
    odd = ["İstanbul", "it's", "a1b22", "\u0085", "e\u0301", "\u200b", "<|endoftext|>", "x×y", "0", "...", "ﬁne", "ſ", "漢字", "a÷", "'s"]
    words = [w for pair in zip(plain, odd * 20) for w in pair] + odd
    monkeypatch.setattr(tokenfiles, "LINE", 7)
    ids, counts = own.learn([w.encode() for w in words])
    for word, found in zip(words, np.split(ids, np.cumsum(counts)[:-1])):
        assert found.tolist() == library.encode(word, add_special_tokens=False).ids, repr(word)
    monkeypatch.setattr(own, "_by_place", None)  # places take long to get; plain words do without
    assert own.learn([w.encode() for w in plain])[1].tolist() == [len(library.encode(w, add_special_tokens=False).ids) for w in plain]


def test_words_that_the_tokenizer_joins_or_splits_go_by_place(monkeypatch):
    own = tokenfiles.Words(open(WORDS).read())
    wanted = [a.tolist() for a in own.learn([b"seven", b"words", b"antidisestablishment"])]
    for wrong in ([], [1, 2], [1, 1, 1, 1]):
        monkeypatch.setattr(own, "_by_number", lambda found, wrong=wrong: np.array(wrong))
        assert [a.tolist() for a in own.learn([b"seven", b"words", b"antidisestablishment"])] == wanted


def test_token_files_hold_the_library_s_ids(spark, monkeypatch):
    library = Tokenizer.from_file(WORDS)
    texts = strange_texts(300, 10)
    rows = [(7 * i % 1000, t, 1) for i, t in enumerate(texts)] + [(None, None, 2), (7, None, 3), (21, "x " * 2000, 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, start int").repartition(3)
    read = sorted(tokenfiles.write_and_read(spark, df, WORDS, 2).collect(), key=lambda r: r.start)
    assert len(read) == len(rows)
    wanted = sorted((-1 if d is None else d, library.encode(t or "", add_special_tokens=False).ids + [2]) for d, t, _ in rows)
    found = sorted((-1 if r.doc_id is None else r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in read)
    assert found == wanted
    assert [r.doc_id is not None and r.doc_id for r in read] == sorted(r.doc_id is not None and r.doc_id for r in read)
    position = 0
    for r in read:
        assert r.start == position and r.n_tokens == len(r.ids) // 4
        position += r.n_tokens
    assert tokenfiles.write_and_read(spark, df.limit(0), WORDS, 2).count() == 0


def test_query_of_files(spark):
    found = queries.op2_token_files(spark, "/root/testdata/sf0.001").collect()
    library = Tokenizer.from_file(WORDS)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()
    position = 0
    for row, doc in zip(sorted(found, key=lambda r: r.doc_id), docs):
        ids = library.encode(doc.text or "", add_special_tokens=False).ids + [2]
        assert (row.doc_id, row.start, row.n_tokens) == (doc.doc_id, position, len(ids))
        assert row.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        position += len(ids)


def test_queries_of_ids_and_counts(spark, library):
    from hashlib import sha256

    docs = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    rows = queries.op1_bpe(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(docs)
    for row in rows:
        ids = library.encode_ordinary(docs[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == sha256(docs[row.doc_id].encode()).hexdigest()
    pieces = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for row in queries.op9_token_counts(spark, "/root/testdata/sf0.001").collect():
        n = len(pieces.encode(docs[row.doc_id]))
        assert (row.n_bytes, row.n_tokens, row.over_limit) == (len(docs[row.doc_id].encode()), n, n > queries.TOKEN_LIMIT)
