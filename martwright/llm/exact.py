"""Exact deduplication (method: deterministic block naming). Runs in the JVM only.

A text, with each run of white space as one space, is cut into blocks of a fixed number of bytes. The
distinct blocks are sorted and their places are their names. Then names are paired, neighbours by
neighbours, and the distinct pairs are sorted and named, until one name is left. Two texts have the
same number of blocks and the same last name exactly if they are equal.

A name stands for contents, not for a hash: block contents are compared when names are given. A
digest only carries a name back to its documents, and one that stood for two contents would stop the
job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.llm.batches import unused
from martwright.session import cut

BLOCK = 4096  # bytes


def normalised(text: Column) -> Column:
    """Each run of white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def blocks_of(data: Column) -> Column:
    """Blocks of a binary value; one empty block if it is empty."""
    count = F.greatest(F.ceil(F.length(data) / BLOCK), F.lit(1))
    return F.transform(F.sequence(F.lit(0), count.cast("int") - 1), lambda i: F.substring(data, i * BLOCK + 1, F.lit(BLOCK)))


def _named(distinct: DataFrame, *order: str) -> DataFrame:
    """Distinct rows with `name`, their place in the sorted rows of their partition behind all before it."""
    return cut(distinct.sortWithinPartitions(*order).withColumn("name", F.monotonically_increasing_id()))


def _block_names(texts: DataFrame) -> DataFrame:
    """digest -> name of all distinct blocks. `texts` has the column `_data`."""
    block = texts.select(F.explode(blocks_of(F.col("_data"))).alias("_block"))
    same = block.groupBy(F.unhex(F.sha2("_block", 256)).alias("digest")).agg(F.collect_set("_block").alias("_contents"))
    one = F.when(F.size("_contents") == 1, F.col("_contents")[0]).otherwise(F.raise_error(F.lit("one digest for two contents")))
    names = same.select("digest", one.alias("_block")).sortWithinPartitions("_block")
    return cut(names.select("digest", F.monotonically_increasing_id().alias("name"), F.length("_block").alias("size")))


def identities(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of `df`: row, doc_id, text_sha256, n_blocks, name.

    (n_blocks, name) is equal exactly for equal texts. `row` is a number of this table only.
    """
    data = df.select(F.col(doc_id).alias("doc_id"), normalised(F.col(text)).cast("binary").alias("_data"))
    digests = F.transform(blocks_of(F.col("_data")), lambda b: F.unhex(F.sha2(b, 256)))
    docs = cut(data.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.sha2("_data", 256).alias("text_sha256"), digests.alias("_digests")))
    names = _block_names(data)
    level = docs.select("row", F.size("_digests").alias("n"), F.posexplode("_digests").alias("at", "digest"))
    level = cut(level.join(names.select("digest", "name"), "digest").select("row", "n", "at", "name"))
    done = level.filter("n = 1").select("row", "name")
    most = level.agg(F.max("n")).first()[0] or 1
    width, level = 1, level.filter("n > 1")
    while width < most:
        # What had one name has ended; of the rest, neighbours meet two by two.
        width *= 2
        pair = level.groupBy("row", "n", F.shiftright("at", 1).alias("at")).agg(
            F.max(F.when(F.col("at") % 2 == 0, F.col("name"))).alias("a"),
            F.coalesce(F.max(F.when(F.col("at") % 2 == 1, F.col("name"))), F.lit(-1)).alias("b"))
        pair = cut(pair)
        given = _named(pair.select("a", "b").distinct(), "a", "b")
        level = cut(pair.join(given, ["a", "b"]).select("row", "n", "at", "name"))
        done = done.unionByName(level.filter(F.col("n") <= width).select("row", "name"))
        level = level.filter(F.col("n") > width)
    return docs.join(done, "row").select("row", "doc_id", "text_sha256", F.size("_digests").alias("n_blocks"), "name")


def deduplicate(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of `df`: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the smallest id stays (null ids last); if rows share that id, one of
    them. The smallest is an aggregate joined back, so a text with many copies is never one group.
    """
    rows = cut(identities(df, doc_id, text))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("_null"), "doc_id", "row")).alias("_first")
    # Written, so that the join deals both sides anew and Spark can split a group with many copies.
    groups = cut(rows.groupBy("n_blocks", "name").agg(first, F.count("*").alias("group_size")))
    return rows.join(groups, ["n_blocks", "name"]).select(
        "doc_id", F.col("_first.doc_id").alias("keep_id"), "group_size", (F.col("_first.row") == F.col("row")).alias("kept"), "text_sha256")


def distinct_texts(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `df` that `deduplicate` keeps, with all their columns; of rows with equal id and text one."""
    sha, kept_id, kept_sha = (unused(df, name) for name in ("_text_sha", "_id", "_sha"))
    kept = deduplicate(df.select(doc_id, text), doc_id, text).filter("kept").select(F.col("doc_id").alias(kept_id), F.col("text_sha256").alias(kept_sha))
    marked = df.withColumn(sha, F.sha2(normalised(F.col(text)).cast("binary"), 256))
    same = F.col(doc_id).eqNullSafe(F.col(kept_id)) & (F.col(sha) == F.col(kept_sha))
    return marked.join(kept, same, "left_semi").dropDuplicates([doc_id, sha]).drop(sha)
