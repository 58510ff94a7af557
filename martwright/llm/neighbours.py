"""Approximate nearest neighbours by inner product (method: a small-world graph per shard, results merged).

Equal vectors are one node, however many rows have them, and a node knows its first rows. Nodes are dealt to
shards of about `shard_rows` by a hash; each shard's task builds a hierarchical navigable small-world graph (`smallworld`)
and the index is a table with one row a shard: flat arrays of vectors, node numbers and links. Queries go, in
blocks, to every shard; a shard's best are scored anew in double precision and the shards' lists are merged.

The work of a search is queries x shards x the logarithm of a shard: with more vectors make shards larger, as large as
a task's memory allows (a vector, twice as 4-byte numbers, and 140 bytes of links a row).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martwright.llm.smallworld import SmallWorld, asking, lifted
from martwright.session import cut

SHARD_ROWS = 8192
QUERY_BLOCK = 1024
SEARCHED = 192  # nodes a search holds; recall against brute force is in the README

_INDEX = "size int, shard int, numbers binary, vectors binary, levels array<int>, links binary"
_FOUND = "asked long, number long, score double"


def usable(vector: Column) -> Column:
    """Not null, not zero, all components finite; the zero of length 0 too."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def nodes_of(df: DataFrame, vec_id: str, vector: str, queries: Column, k: int, shard_rows: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Nodes (number, vector, size, shards, shard, asked, blocks), their first k + 1 rows (number, vec_id, row) and query rows (the same)."""
    kind = df.schema[vector].dataType.elementType.simpleString()
    kind = kind if kind in ("float", "double") else "double"
    rows = df.filter(F.col(vec_id).isNotNull()).select(
        F.col(vec_id).alias("vec_id"), queries.alias("query"), F.col(vector).cast(f"array<{kind}>").alias("vector")).filter(usable(F.col("vector")))
    rows = cut(rows.select(  # adding 0 makes -0 and 0 one value
        F.monotonically_increasing_id().alias("row"), "vec_id", "query", F.transform("vector", lambda x: x + F.lit(0).cast(kind)).alias("vector")))
    distinct = cut(rows.groupBy("vector").agg(F.max("query").alias("asked")).select(
        F.monotonically_increasing_id().alias("number"), "vector", F.size("vector").alias("size"), "asked"))
    sizes = cut(distinct.groupBy("size").agg(
        F.ceil(F.count("*") / shard_rows).cast("int").alias("shards"), F.ceil(F.count_if("asked") / QUERY_BLOCK).cast("int").alias("blocks")))
    nodes = distinct.join(sizes, "size").withColumn("shard", F.pmod(F.xxhash64("number"), "shards").cast("int"))
    # Of a vector's rows only the first k + 1 can be among k nearest; they are cut off before the shuffle.
    first = rows.withColumn("place", F.row_number().over(Window.partitionBy("vector").orderBy("vec_id", "row"))).filter(F.col("place") <= k + 1)
    members = cut(first.join(distinct, "vector").select("number", "vec_id", "row"))
    asking_rows = cut(rows.filter("query").join(distinct, "vector").select("number", "vec_id", "row"))
    return cut(nodes), members, asking_rows


def _bytes(kind: str) -> np.dtype:
    return np.dtype("<f4" if kind == "float" else "<f8")


def build(nodes: DataFrame) -> DataFrame:
    """The index: for every size of vector and shard one row of flat arrays, the nodes from the highest level down."""
    dtype = _bytes(nodes.schema["vector"].dataType.elementType.simpleString())

    def shard(table: pa.Table) -> pa.Table:
        numbers = table.column("number").to_numpy()
        by = np.argsort(numbers)
        size = table.column("size")[0].as_py()
        vectors = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(-1, size)[by]
        graph, order = SmallWorld.build(lifted(vectors))
        return pa.table({
            "size": pa.array([size], pa.int32()), "shard": pa.array([table.column("shard")[0].as_py()], pa.int32()),
            "numbers": pa.array([numbers[by][order].astype("<i8").tobytes()], pa.binary()), "vectors": pa.array([vectors[order].tobytes()], pa.binary()),
            "levels": pa.array([graph.sizes], pa.list_(pa.int32())), "links": pa.array([b"".join(x.astype("<i4").tobytes() for x in graph.links)], pa.binary())})

    return nodes.select("size", "shard", "number", "vector").groupBy("size", "shard").applyInArrow(shard, _INDEX)


def _opened(row: dict, dtype: np.dtype) -> tuple[SmallWorld, np.ndarray, np.ndarray]:
    vectors = np.frombuffer(row["vectors"], dtype).reshape(-1, row["size"])
    flat, links, at = np.frombuffer(row["links"], "<i4"), [], 0
    whole = len(flat) // (sum(row["levels"]) + row["levels"][0])  # links a node; the lowest level has twice as many
    for k, n in enumerate(row["levels"]):
        width = whole if k else 2 * whole
        links.append(flat[at:at + n * width].reshape(n, width))
        at += n * width
    return SmallWorld(lifted(vectors), row["levels"], links), vectors, np.frombuffer(row["numbers"], "<i8")


def search(index: DataFrame, asked: DataFrame, nodes_kind: str, most: int) -> DataFrame:
    """For every query node of `asked` (size, shards, blocks, number, vector) up to `most` nodes of each shard: asked, number, score."""
    dtype = _bytes(nodes_kind)

    def meet(key, shard: pa.Table, queries: pa.Table) -> pa.Table:
        if not shard.num_rows or not queries.num_rows:
            return pa.table({"asked": pa.array([], pa.int64()), "number": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        graph, vectors, numbers = _opened(shard.to_pylist()[0], dtype)
        who = queries.column("number").to_numpy()
        here = queries.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(len(who), -1)
        found = graph.nearest(asking(here), max(SEARCHED, most))
        scores = np.full(found.shape, -np.inf)
        for i in range(len(who)):  # exactly, on the original vectors
            real = found[i] >= 0
            scores[i, real] = (vectors[found[i][real]].astype(np.float64) * here[i].astype(np.float64)).sum(axis=1)
        order = np.argsort(-scores, axis=1, kind="stable")[:, :most]
        best, ids = np.take_along_axis(scores, order, axis=1), np.take_along_axis(found, order, axis=1)
        keep = (ids >= 0).ravel()
        return pa.table({
            "asked": pa.array(np.repeat(who, order.shape[1])[keep]), "number": pa.array(numbers[ids.ravel()[keep]]), "score": pa.array(best.ravel()[keep])})

    blocks = asked.select("size", "blocks").distinct()
    shards = index.join(blocks, "size").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    sent = asked.withColumns({
        "block": F.pmod(F.xxhash64("number", F.lit(1)), "blocks").cast("int"), "shard": F.explode(F.sequence(F.lit(0), F.col("shards") - 1))})
    sent = sent.select("size", "shard", "block", "number", "vector")
    keys = ["size", "shard", "block"]
    return shards.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInArrow(meet, _FOUND)


def nearest(df: DataFrame, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding", queries: Column | None = None,
            shard_rows: int = SHARD_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the `k` rows found nearest to every query row, by inner product, ties to the smaller vec_id.

    Queries are the rows for which `queries` holds (without it those whose id is divisible by 20); candidates are all rows
    but the query's own. Rows with a null id, or a vector that is null, empty, zero or holds a null or non-finite component
    take no part. Vectors are compared with those of their own length. A row that is there twice is two candidates and two
    queries, so a query may find its own id in another row. An empty table, or one without queries, has no rows. Other columns are not read.
    """
    queries = F.col(vec_id) % 20 == 0 if queries is None else queries
    nodes, members, asking_rows = nodes_of(df, vec_id, vector, F.coalesce(queries, F.lit(False)), k, shard_rows)
    index = cut(build(nodes))
    found = cut(search(index, nodes.filter("asked"), nodes.schema["vector"].dataType.elementType.simpleString(), k + 1))
    best = Window.partitionBy("asked").orderBy(F.desc("score"), "number")
    found = found.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k + 1)
    rows = found.join(members, "number")
    best = Window.partitionBy("asked").orderBy(F.desc("score"), "vec_id", "row")
    rows = rows.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k + 1)
    lists = cut(rows.groupBy("asked").agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "row", "score"))).alias("near")))
    own = asking_rows.select(F.col("number").alias("asked"), F.col("vec_id").alias("query_id"), F.col("row").alias("own"))
    others = F.slice(F.filter("near", lambda x: x["row"] != F.col("own")), 1, k)
    out = own.join(lists, "asked").select("query_id", F.posexplode(others).alias("at", "x"))
    return out.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))
