"""Nearest neighbours against brute force."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from martwright.llm import neighbours, queries, smallworld

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k=20):
    """{place of the query row: (its id, [(vec_id, score) of the nearest k])}"""
    real = [i for i, (d, v) in enumerate(rows) if d is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    found = {}
    for i in real:
        if rows[i][0] % 20 == 0:
            scores = [(-float(np.dot(np.array(rows[j][1], "f4").astype("f8"), np.array(rows[i][1], "f4").astype("f8"))), rows[j][0])
                      for j in real if j != i and len(rows[j][1]) == len(rows[i][1])]
            found[i] = (rows[i][0], [(d, -s) for s, d in sorted(scores)[:k]])
    return found


def lists(df):
    found = defaultdict(list)
    for r in df.orderBy("query_id", "rank").collect():
        found[r.query_id].append((r["rank"], r.vec_id, r.score))
    return found


def recall(got, want):
    hits = [len({d for _, d, _ in got[q]} & {d for d, _ in near}) / len(near) for q, near in want.values() if near]
    return sum(hits) / len(hits)


def test_the_query_finds_at_least_nine_tenths(spark):
    folder = "/root/testdata/sf0.1"
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    got, want = lists(queries.op13_nearest(spark, folder)), brute(rows)
    vectors = {d: np.array(v, "f4").astype("f8") for d, v in rows}
    assert set(got) == {q for q, _ in want.values()} and recall(got, want) >= 0.95
    for q, near in got.items():
        assert [k for k, _, _ in near] == list(range(1, 21)) and q not in {d for _, d, _ in near}
        assert near == sorted(near, key=lambda x: (-x[2], x[1]))
        assert all(abs(s - vectors[q] @ vectors[d]) < 1e-12 for _, d, s in near)


@pytest.mark.parametrize("shard_rows", [100, 5000])
def test_shards_and_lengths_of_all_kinds(spark, shard_rows):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(10, 16))
    rows = [(i, (centres[i % 10] * rng.uniform(0.5, 2) + rng.normal(size=16)).astype("f4").tolist()) for i in range(1500)]
    got, want = lists(neighbours.nearest(spark.createDataFrame(rows, SCHEMA), shard_rows=shard_rows)), brute(rows)
    assert recall(got, want) >= 0.9


def test_many_copies_ties_and_repeated_rows(spark):
    rng = np.random.default_rng(6)
    hot = rng.normal(size=8).astype("f4").tolist()
    rows = [(i, hot) for i in range(0, 3000, 3)] + [(i, rng.normal(size=8).astype("f4").tolist()) for i in range(1, 600, 3)]
    rows += [(20, hot), (7, [0.0, -0.0] * 4), (40, [x + 0.0 for x in hot])]
    want = brute(rows)
    got = neighbours.nearest(spark.createDataFrame(rows, SCHEMA).repartition(7)).collect()
    assert Counter(r.query_id for r in got) == Counter({q: 20 * n for q, n in Counter(q for q, _ in want.values()).items()})
    one = {q: near for q, near in want.values()}
    counted = Counter(q for q, _ in want.values())
    for q, found in lists(spark.createDataFrame(got)).items():
        if counted[q] == 1:
            assert [d for _, d, _ in found] == [d for d, _ in one[q]]


def test_rows_without_a_usable_vector_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.0, 0.0]), (40, None), (60, [nan, 1.0]), (80, [inf, 1.0]), (100, [None, 1.0]), (120, []), (None, [1.0, 1.0]),
            (1, [0.5, 0.5]), (2, [-1.0, 0.25]), (140, [1.0, 2.0, 3.0]), (160, [1.0, 1.0, 1.0])]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"row": F.lit(1), "number": F.lit("x"), "score": F.lit(None), "size": F.lit(0)})
    got = sorted(tuple(r) for r in neighbours.nearest(df).collect())
    assert got == [(0, 1, 1, 0.5), (0, 2, 2, -1.0), (140, 1, 160, 6.0), (160, 1, 140, 6.0)]
    assert neighbours.nearest(df.filter("vec_id = 1")).collect() == []
    assert neighbours.nearest(df.limit(0)).collect() == []


def test_every_node_can_be_reached():
    rng = np.random.default_rng(8)
    vectors = rng.normal(size=(3000, 24)).astype("f4")
    graph, order = smallworld.SmallWorld.build(smallworld.lifted(vectors))
    assert sorted(order.tolist()) == list(range(3000))
    seen, edge = {0}, [0]
    while edge:
        edge = [y for x in edge for y in graph.links[0][x].tolist() if y >= 0 and y not in seen and not seen.add(y)]
    assert len(seen) >= 2990
    assert all((graph.links[0][i] != i).all() for i in range(3000))
