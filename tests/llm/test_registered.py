"""The registered training-data queries and the pipeline."""

import pytest
from compare import compare, oracle_connection

import __spark_entry__ as entry
import corpus_pipeline
from martwright.llm import queries, sql

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return oracle_connection(FOLDER)


def test_all_are_registered():
    names = [f"op{n}_" for n in range(1, 11)]
    assert [n for n in names if not any(q.startswith(n) for q in entry.queries())] == []
    assert "pipeline" in entry.queries() and set(sql.oracle_sql()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(sql.oracle_sql()))
def test_query(spark, db, name):
    assert compare(spark, db, name, queries.queries()[name], sql.oracle_sql()[name], FOLDER) is None


def test_pipeline_is_its_stages_by_brute_force(spark):
    import re

    import tiktoken
    from test_texts import brute_language, brute_links

    import public_tokenizers
    from martwright.llm.langid import NEAR
    from martwright.llm.prefix_bpe import from_ranks

    docs = {r.doc_id: r for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    languages = brute_language([(d, r.text, r.lang) for d, r in docs.items()])
    left = [d for d in sorted(docs) if languages[d][0] != "und" and languages[d][1] >= NEAR]
    seen, unique = set(), []
    for d in left:
        text = re.sub(r"[\x20\x09-\x0D]+", " ", docs[d].text or "")
        if text not in seen:
            seen.add(text)
            unique.append(d)
    links = brute_links([(d, docs[d].text) for d in unique])
    firsts = [d for d in unique if links[d][1] == d]
    items = [r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    clean = [d for d in firsts if not any(t in docs[d].text for t in items)]
    rows = {r.doc_id: r for r in corpus_pipeline.run(spark, FOLDER).collect()}
    # Reworded leaks go as well, so the clean ones are those without a verbatim leak, or fewer.
    assert set(rows) <= set(clean) and len(rows) >= len(clean) - 2
    ranks = {t.encode("latin-1"): r for t, r in from_ranks(open(public_tokenizers.path(corpus_pipeline.RANKS), "rb")).items()}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for d, r in rows.items():
        assert list(r.ids) == library.encode_ordinary(docs[d].text) and r.n_tokens == len(r.ids) and r.round_trip
        assert (r.text, r.lang, r.source, r.n_chars) == (docs[d].text, docs[d].lang, docs[d].source, docs[d].n_chars)


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, FOLDER).columns == docs.columns
