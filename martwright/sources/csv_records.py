"""CSV records with line breaks in quoted values, read by as many tasks as the file has splits.

Whether a line break ends a record depends on how many quotes stand before it in the file. One pass counts
the quotes of every split; a running sum over splits, one small row each, tells for each split whether it
begins inside quotes. Only splits that begin so, or hold a line with an odd number of quotes, have their lines sorted
and put together; all others are parsed line by line and never shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martwright.session import cut

CORRUPT = "_corrupt"  # the text of a record that has too few or too many fields
MOST_LINES = 10_000  # of a record; beyond that a quote is missing somewhere, and every line counts as corrupt

_SPLIT = ["file", "block"]


def with_mark(header: Sequence[str]) -> tuple[str, str]:
    """The schema of a file's columns, as text, and one more for corrupt records, whose name the file does not have."""
    mark = CORRUPT
    while mark in header:
        mark += "_"
    return ", ".join(f"`{c}` string" for c in [*header, mark]), mark


def _lines(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.option("lineSep", "\n").text(path)
    odd = (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2
    return lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"), odd.alias("odd"), "value")


def _put_together(lines: DataFrame) -> DataFrame:
    """The records of splits in which a line break may stand in quotes: block, value, endless."""
    in_order = Window.partitionBy(*_SPLIT).orderBy("line")
    after = (F.col("inside") + F.sum("odd").over(in_order)) % 2
    parts = cut(lines.withColumn("ends", F.when(after == 0, 1).otherwise(0)))
    ended = parts.groupBy(*_SPLIT).agg(F.sum("ends").alias("n"))
    earlier = F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    ended = ended.select(*_SPLIT, F.coalesce(earlier, F.lit(0)).alias("earlier"))
    here = F.coalesce(F.sum("ends").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    numbered = cut(parts.withColumn("here", here).join(ended, _SPLIT).select(
        *_SPLIT, "line", "value", (F.col("earlier") + F.col("here")).alias("record")))
    long = cut(numbered.groupBy("file", "record").agg(F.count("*").alias("n")).filter(F.col("n") > MOST_LINES).select("file", "record"))
    endless = numbered.join(long, ["file", "record"], "left_semi").select("block", "value", F.lit(True).alias("endless"))
    joined = numbered.join(long, ["file", "record"], "left_anti").groupBy("file", "record").agg(
        F.min("block").alias("block"), F.array_join(F.transform(
            F.sort_array(F.collect_list(F.struct("block", "line", "value"))), lambda x: x["value"]), "\n").alias("value"))
    return joined.select("block", "value", F.lit(False).alias("endless")).unionByName(endless)


def read_records(spark: SparkSession, path: str, options: dict, columns: Sequence[str]) -> DataFrame:
    """The named columns, as text, of a headered CSV file or folder, and `_corrupt`; records may hold line breaks in quotes.

    `_corrupt` is null for records with as many fields as the header. Empty lines are left out, and so are lines that
    repeat the header in the first split of a file. A record of more than `MOST_LINES` lines is one corrupt record a line.
    """
    lines = _lines(spark, path)
    header = spark.read.options(**options, inferSchema=False).csv(path).columns
    first_line = spark.read.option("lineSep", "\n").text(path).filter("_metadata.file_block_start = 0").first()
    first_line = first_line.value if first_line else ""

    splits = lines.groupBy(*_SPLIT).agg(F.sum("odd").alias("n_odd"))
    before = F.sum("n_odd").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    splits = splits.withColumn("inside", F.coalesce(before, F.lit(0)) % 2)
    broken = cut(splits.filter("inside = 1 OR n_odd > 0").select(*_SPLIT, "inside"))

    if broken.isEmpty():  # no record of the file has a line break
        records = lines.select("block", "value", F.lit(False).alias("endless"))
    else:
        whole = lines.join(broken, _SPLIT, "left_anti").select("block", "value", F.lit(False).alias("endless"))
        records = whole.unionByName(_put_together(lines.join(broken, _SPLIT)))
    records = records.filter(~((F.col("block") == 0) & (F.col("value") == F.lit(first_line))))
    records = records.withColumn("value", F.regexp_replace("value", "\r$", "")).filter("value <> ''")
    schema, mark = with_mark(header)
    parsed = F.from_csv("value", F.lit(schema), {**{k: str(v) for k, v in options.items() if k != "header"}, "columnNameOfCorruptRecord": mark})
    parsed = records.select("value", "endless", parsed.alias("r"))
    broken_record = F.when(F.col("endless") | F.col("r").isNull(), F.col("value")).otherwise(F.col(f"r.{mark}"))
    return parsed.select(*[F.col(f"r.`{c}`").alias(c) for c in columns], broken_record.alias(CORRUPT))
