"""Landed JSON records whose schema changes from file to file.

The type of every field is worked out per file, where Spark reads it, and compared with the declared one:

* `same`: the declared type, or nothing but nulls;
* `widened`: whole numbers or decimals where a wider number is declared; read as the declared type;
* `added`: a field that is not declared; left out;
* `missing`: a declared field that no record of the file has; NULL;
* `changed`: any other type. The file's records go to quarantine, as they stand.

Fields of objects and lists are compared as one type each. Numbers with a point are decimals in JSON.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, DoubleType, FloatType, IntegralType, NumericType, StringType, StructType

from martwright.session import cut

VERSIONS = "file string, column string, declared string, found string, verdict string"


def landed_records(spark: SparkSession, path: str) -> DataFrame:
    """file, value: the lines of all files below a path (or pattern) that are not blank."""
    lines = spark.read.text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), "value").filter(F.trim("value") != "")


def _fields(records: DataFrame) -> Column:
    """The fields of a record by name; NULL for what is no JSON object."""
    parsed = F.try_parse_json("value")
    return F.when(F.schema_of_variant(parsed).startswith("OBJECT<"), parsed).try_cast("map<string, variant>")


def _fits(found: Column, declared: DataType) -> Column:
    """Whether values of a variant's type are whole within a declared type of another name."""
    decimal = found.startswith("DECIMAL(")
    whole = found == "BIGINT"
    if isinstance(declared, (DoubleType, FloatType)):
        return whole | decimal | (found == "DOUBLE")
    digits = [F.regexp_extract(found, r"\((\d+),(\d+)\)", k).try_cast("int") for k in (1, 2)]
    if isinstance(declared, DecimalType):
        room = declared.precision - declared.scale
        return (whole & F.lit(room >= 19)) | (decimal & (digits[1] <= declared.scale) & (digits[0] - digits[1] <= room))
    return F.lit(False)


def _is(found: Column, declared: DataType) -> Column:
    if isinstance(declared, IntegralType):
        return found == "BIGINT"
    if isinstance(declared, StringType):
        return found == "STRING"
    if isinstance(declared, NumericType):
        return F.lit(False)  # decided by _fits
    if declared.typeName() in ("struct", "map"):
        return found.startswith("OBJECT<")
    if declared.typeName() == "array":
        return found.startswith("ARRAY<")
    # JSON has no dates; they come as text.
    return (found == declared.simpleString().upper()) | ((found == "STRING") & F.lit(declared.typeName() in ("date", "timestamp", "timestamp_ntz")))


def schema_versions(records: DataFrame, ddl: str) -> DataFrame:
    """One row per file and field, declared or found: file, column, declared, found, verdict.

    Each task reduces its records to one row per file and field before the shuffle. Names are compared as they are
    written. A file without any JSON object misses all fields.
    """
    schema = StructType.fromDDL(ddl)
    seen = records.select("file", F.explode_outer(_fields(records)).alias("column", "held"))
    found = seen.groupBy("file", "column").agg(F.schema_of_variant_agg("held").alias("found"))
    wanted = F.array(*[F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("declared")) for f in schema.fields])
    files = records.select("file").distinct().select("file", F.inline(wanted))
    both = files.join(found.filter("column IS NOT NULL"), ["file", "column"], "full_outer")
    good, wide = F.lit(False), F.lit(False)
    for field in schema.fields:
        mine = F.col("column") == field.name
        good |= mine & _is(F.col("found"), field.dataType)
        wide |= mine & _fits(F.col("found"), field.dataType)
    verdict = (
        F.when(F.col("declared").isNull(), "added").when(F.col("found").isNull(), "missing").when((F.col("found") == "VOID") | good, "same")
        .when(wide, "widened").otherwise("changed"))
    return both.select("file", "column", "declared", "found", verdict.alias("verdict"))


def read_evolving(spark: SparkSession, path: str, ddl: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The records of the declared type, the quarantined ones (file, value, problem), and `schema_versions`.

    Quarantined are all records of files in which a field changed its type, lines that are no JSON object, and records with a
    value that the declared type does not hold (a day that does not exist, a number too large). The files are read twice: for their
    types, and for their records.
    """
    records = landed_records(spark, path)
    versions = cut(schema_versions(records, ddl))
    changed = versions.filter("verdict = 'changed'").groupBy("file").agg(
        F.concat_ws(", ", F.array_sort(F.collect_list(F.concat("column", F.lit(": "), "declared", F.lit(" became "), "found")))).alias("_changed"))
    columns = StructType.fromDDL(ddl).names
    mark = "_corrupt"
    while mark in columns:
        mark += "_"
    read = F.from_json("value", f"{ddl}, {mark} string", {"columnNameOfCorruptRecord": mark})
    marked = records.join(changed, "file", "left").withColumn("r", read).withColumn("problem", F.coalesce(
        "_changed", F.when(_fields(records).isNull(), "no JSON object"), F.when(F.col(f"r.{mark}").isNotNull(), "a value of another kind")))
    good = marked.filter("problem IS NULL").select(*[F.col(f"r.`{c}`").alias(c) for c in columns])
    return good, marked.filter("problem IS NOT NULL").select("file", "value", "problem"), versions
