"""Merkle manifest of a table (method: butterfly exchange). Runs in the JVM only.

Every row is a leaf. The leaves of a group stand in order of a key; every FANOUT neighbours become their
hash, level by level, until one node remains, the group's subroot; the subroots, in order of the
groups, become the root likewise.

Leaves are dealt to parts of FANOUT ** LEVELS neighbours, which hash their own subtree. From there on
parts meet in rounds. In round r the parts whose numbers differ only in digit r, to the base FANOUT,
swap the roots of their subtrees; each hashes what it got, so all of them hold the ancestor, and
writes down what it got as the next level of its proof. After a logarithmic number of rounds every
part has the subroot and all upper levels of the proofs of its leaves, and nothing goes down the tree.
Where the last subtree of a tree has fewer parts than its neighbours, each of them sends to several.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.operators.ordered import Ordered
from martwright.session import cut

FANOUT = 8
LEVELS = 3  # of a tree inside one part


def digest_of(*columns: Column | str) -> Column:
    """SHA-256, as lowercase hex, of the values one after the other: `-` for null, else bytes of the value, `:`, value."""
    values = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values]
    return F.sha2(F.concat(*parts), 256)


def proof_digest(proof: Column) -> Column:
    """Hash of all siblings of a proof, level by level, left to right."""
    return F.sha2(F.array_join(F.flatten(F.transform(proof, lambda level: level["others"])), ""), 256)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and the siblings of a proof give."""
    def up(node: Column, level: Column) -> Column:
        left = F.slice(level["others"], F.lit(1), level["place"])
        right = F.slice(level["others"], level["place"] + 1, F.lit(FANOUT))
        return F.sha2(F.array_join(F.concat(left, F.array(node), right), ""), 256)

    return F.aggregate(proof, leaf, up)


def _level(place: Column, others: Column) -> Column:
    return F.struct(place.cast("int").alias("place"), others.alias("others"))


def _without(nodes: Column, start: Column, place: Column) -> Column:
    """Of the run of nodes behind `start` all but the one in `place`."""
    return F.concat(F.slice(nodes, start + 1, place), F.slice(nodes, start + place + 2, F.lit(FANOUT) - place - 1))


def _runs(nodes: Column) -> Column:
    """Hashes of every FANOUT nodes."""
    firsts = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / FANOUT).cast("int"))
    return F.transform(firsts, lambda i: F.sha2(F.array_join(F.slice(nodes, i * FANOUT + 1, F.lit(FANOUT)), ""), 256))


def _rounds(most: int | None) -> int:
    """Levels above `most` nodes."""
    rounds = 0
    while FANOUT ** rounds < (most or 0):
        rounds += 1
    return rounds


def exchange(parts: DataFrame, rounds: int) -> DataFrame:
    """Parts (tree, n, part, digest, proof) after `rounds` rounds: digest is the tree's root, proof has all levels above the part.

    `part` counts from 0 to n - 1 within its tree. A tree that has one node already takes no part in a round.
    """
    for r in range(rounds):
        step = FANOUT ** r
        here = parts.withColumns({
            "place": F.floor(F.col("part") / step) % FANOUT, "low": F.col("part") % step,
            "base": F.col("part") - F.col("part") % (step * FANOUT), "on": F.col("n") > step})
        width = F.least(F.lit(step), F.col("n") - F.col("base") - F.col("place") * step)  # parts of the own subtree
        near = here.withColumn("width", width).withColumn(
            "digit", F.explode(F.when(F.col("on"), F.sequence(F.lit(0), F.lit(FANOUT - 1))).otherwise(F.array(F.col("place").cast("int")))))
        lows = F.when(F.col("on"), F.sequence(F.col("low"), F.lit(step - 1).cast("long"), F.col("width"))).otherwise(F.array("low"))
        sent = near.withColumn("to", F.explode(lows)).withColumn("to", F.col("to") + F.col("base") + F.col("digit") * step).filter("to < n")
        met = sent.groupBy("tree", "n", F.col("to").alias("part")).agg(
            F.sort_array(F.collect_list(F.struct("place", "digest"))).alias("got"),
            F.first(F.when(F.col("to") == F.col("part"), F.col("proof")), ignorenulls=True).alias("proof"))
        digests = F.col("got.digest")
        place = (F.floor(F.col("part") / step) % FANOUT).cast("int")
        level = _level(place, _without(digests, F.lit(0), place))
        parts = met.select(
            "tree", "n", "part", F.when(F.col("n") > step, F.sha2(F.array_join(digests, ""), 256)).otherwise(digests[0]).alias("digest"),
            F.when(F.col("n") > step, F.concat("proof", F.array(level))).otherwise(F.col("proof")).alias("proof"))
    return parts


def manifest(df: DataFrame, fields: Sequence[str], group: str, key: str, carried: dict[str, Column] | None = None,
             levels: int = LEVELS) -> DataFrame:
    """One row for each row of `df`: the carried columns, then leaf, subroot, root and proof.

    A row's leaf is the hash of its `fields`; the leaves of a group ascend by `key` (nulls first), rows
    with one key by leaf, and equal rows are leaves each. Groups ascend too, the null group first, strings
    by their bytes. `proof` has for every level the place in the run and the siblings, left to right.
    Nulls, empty and very long texts are hashed like any value; an empty table has no rows; `carried`
    columns may have any name but those four, other columns of `df` are not read. Carried values must be comparable.
    """
    carried = carried or {}
    span = FANOUT ** levels
    leaves = df.select(F.col(group).alias("group"), F.col(key).alias("key"), digest_of(*fields).alias("leaf"),
                       F.struct(F.lit(0).alias("_"), *[c.alias(name) for name, c in carried.items()]).alias("row"))
    # Written first: a global sort reads its input twice, and hashing whole texts is the larger part of the work.
    ordered = Ordered.of(cut(leaves), ["group", "key", "leaf"]).row_number("number")
    sizes = cut(ordered.rows.groupBy("group").agg(F.min("number").alias("start"), F.count("*").alias("size")))
    trees = Ordered.of(sizes, ["start"])
    n_trees, most = trees.count(), sizes.agg(F.max("size")).first()[0]
    trees = cut(trees.row_number("tree").rows.select(F.col("group").alias("of"), "start", "size", (F.col("tree") - 1).alias("tree")))

    placed = ordered.rows.join(trees, F.col("group").eqNullSafe(F.col("of"))).withColumn("at", F.col("number") - F.col("start"))
    blocks = placed.groupBy("tree", "size", F.floor(F.col("at") / span).alias("part")).agg(
        F.sort_array(F.collect_list(F.struct("at", "leaf", "row"))).alias("leaves")).withColumn("nodes_0", F.col("leaves.leaf"))
    for k in range(levels):  # a tree that has one node is done
        above = F.when(F.col("size") > FANOUT ** k, _runs(F.col(f"nodes_{k}"))).otherwise(F.col(f"nodes_{k}"))
        blocks = blocks.withColumn(f"nodes_{k + 1}", above)
    blocks = cut(blocks)

    none = F.array().cast("array<struct<place:int,others:array<string>>>")
    parts = blocks.select(
        "tree", F.ceil(F.col("size") / span).alias("n"), "part", F.col(f"nodes_{levels}")[0].alias("digest"), none.alias("proof"))
    parts = cut(exchange(parts, _rounds(-(-(most or 0) // span))))
    roots = parts.filter("part = 0").select(
        F.lit(0).alias("tree"), F.lit(n_trees).cast("long").alias("n"), F.col("tree").alias("part"), "digest", none.alias("proof"))
    roots = cut(exchange(roots, _rounds(n_trees)).select(
        F.col("part").alias("tree"), F.col("digest").alias("root"), F.col("proof").alias("top")))

    upper = parts.join(roots, "tree").select("tree", "part", F.col("digest").alias("subroot"), "root", F.concat("proof", "top").alias("upper"))

    def proven(x: Column, i: Column) -> Column:
        below = [F.when(F.col("size") > FANOUT ** k, _level(
            F.floor(i / FANOUT ** k) % FANOUT,
            _without(F.col(f"nodes_{k}"), F.floor(i / FANOUT ** (k + 1)).cast("int") * FANOUT, (F.floor(i / FANOUT ** k) % FANOUT).cast("int"))))
            for k in range(levels)]
        return F.struct(x["row"].alias("row"), x["leaf"].alias("leaf"), F.filter(F.array(*below), lambda level: level.isNotNull()).alias("lower"))

    out = blocks.join(upper, ["tree", "part"]).select(F.explode(F.transform("leaves", proven)).alias("x"), "subroot", "root", "upper")
    return out.select(*[F.col(f"x.row.`{c}`").alias(c) for c in carried], "x.leaf", "subroot", "root", F.concat("x.lower", "upper").alias("proof"))
