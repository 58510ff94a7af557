"""The Merkle manifest against a tree built level by level."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from martwright.llm import merkle

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return sha("".join("-" if row[f] is None else f"{len(str(row[f]).encode())}:{row[f]}" for f in FIELDS))


def climb(nodes):
    """The root over `nodes`, and for every node its siblings level by level as (left, right)."""
    proofs, spans = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, above_spans = [], []
        for start in range(0, len(nodes), 8):
            run = nodes[start:start + 8]
            for k in range(len(run)):
                for i in spans[start + k]:
                    proofs[i].append((run[:k], run[k + 1:]))
            above.append(sha("".join(run)))
            above_spans.append([i for s in spans[start:start + 8] for i in s])
        nodes, spans = above, above_spans
    return nodes[0], proofs


def brute(rows):
    """(doc_id, leaf, subroot, root, siblings) for every row."""
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append((r["doc_id"], leaf_of(r)))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for g in order:
        leaves = sorted(groups[g], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees.append((leaves, *climb([leaf for _, leaf in leaves])))
    root, tops = climb([t[1] for t in trees])
    return [(d, leaf, sub, root, proof + top) for (leaves, sub, proofs), top in zip(trees, tops) for (d, leaf), proof in zip(leaves, proofs)]


def fold(leaf, proof):
    for left, right in proof:
        leaf = sha("".join(left + [leaf] + right))
    return leaf


def some(sizes, seed=1):
    rng, rows = random.Random(seed), []
    for lang, n in sizes.items():
        ids = rng.sample(range(10 * n + 1), n)
        rows += [dict(doc_id=i, text=rng.choice([None, "", "Añb\nC", "x" * rng.randint(1, 50)]), lang=lang, source=rng.choice([None, "", "s1"]),
                      n_chars=rng.choice([None, 3])) for i in ids]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in rows], SCHEMA)


@pytest.mark.parametrize("sizes,levels", [
    ({"a": 1}, 3), ({"a": 8}, 1), ({None: 9, "": 1, "b": 64}, 1), ({"a": 65, "é": 130, "zz": 2}, 1),
    ({f"l{i:02d}": 1 + i % 10 for i in range(20)}, 1), ({"a": 513, None: 700}, 3), ({"a": 521, "b": 600}, 1)])
def test_equals_a_tree_built_level_by_level(spark, sizes, levels):
    rows = some(sizes)
    made = merkle.manifest(frame(spark, rows), FIELDS, "lang", "doc_id", {"doc_id": F.col("doc_id")}, levels=levels)
    made = made.withColumns({"sha": merkle.proof_digest(F.col("proof")), "up": merkle.folded(F.col("leaf"), F.col("proof")),
                             "other": merkle.folded(F.lit("0" * 64), F.col("proof"))})
    got = sorted((r.doc_id, r.leaf, r.subroot, r.root, r.sha, r.up, r.other) for r in made.drop("proof").collect())
    want = sorted((d, leaf, sub, root, sha("".join("".join(a + b) for a, b in proof)), root, fold("0" * 64, proof)) for d, leaf, sub, root, proof in brute(rows))
    assert got == want


def test_nulls_repeated_rows_and_clashing_names(spark):
    rows = some({"a": 3})
    rows += [rows[0], dict(rows[1], text="other"), dict(rows[0], doc_id=None), dict(rows[0], doc_id=None, lang=None)]
    names = {"group": "group", "key": "key", "at": "n_chars", "row": "tree", "size": "part", "nodes_0": "digest"}
    df = frame(spark, rows).selectExpr("*", *[f"'{v}' AS `{k}`" for k, v in names.items()])
    carried = {c: F.col(c) for c in ["doc_id", *names]}
    made = merkle.manifest(df, FIELDS, "lang", "doc_id", carried).collect()
    assert sorted(((r.doc_id is None, r.doc_id or 0), r.leaf, r.root) for r in made) == sorted(
        ((d is None, d or 0), leaf, root) for d, leaf, _, root, _ in brute(rows))
    assert all(r[k] == v for r in made for k, v in names.items())


def test_an_empty_table_has_no_rows(spark):
    made = merkle.manifest(frame(spark, []), FIELDS, "lang", "doc_id", {"doc_id": F.col("doc_id")})
    assert made.collect() == [] and made.columns == ["doc_id", "leaf", "subroot", "root", "proof"]


def test_long_texts_and_crc(spark):
    rows = [dict(doc_id=i, text="Wort " * 400_000 + str(i), lang="de", source="s", n_chars=1) for i in range(3)]
    made = merkle.manifest(frame(spark, rows), FIELDS, "lang", "doc_id", {"doc_id": F.col("doc_id")})
    assert sorted(r.leaf for r in made.collect()) == sorted(map(leaf_of, rows))
    assert spark.sql("SELECT crc32('20') c").first().c == zlib.crc32(b"20")
