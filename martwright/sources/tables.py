"""Readers and sinks: CSV, Parquet snapshots with a commit point, JSON landing files, reports.

Parquet has no in-place update, so a refresh writes whole new snapshot folders and then adds one row
to a commit table. Readers take the newest committed snapshot: they never see half a refresh, a
failed one leaves no trace, and several tables commit together.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from martwright.sources import schemas
from martwright.sources.csv_records import CORRUPT, read_records, with_mark

COMMITS = "_commits"
CSV = {"header": True, "quote": '"', "escape": '"'}  # quotes are doubled inside quotes
PART_COMMITS = "_part_commits"
PART_COMMIT_SCHEMA = "snapshot string, committed_at timestamp, table_name string, parts array<int>"
COMMIT_SCHEMA = "snapshot string, committed_at timestamp, tables array<string>"


def pick(tables: Mapping, table: str, *columns: str) -> DataFrame:
    """The named columns of a table.

    A table is a DataFrame, or a function of the wanted columns for one whose columns cost joins.
    """
    source = tables[table]
    return source(*columns) if callable(source) else source.select(*columns)


def typed(df: DataFrame, ddl: str) -> DataFrame:
    """The columns of a declared type, cast to it."""
    fields = StructType.fromDDL(ddl).fields
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whichever file system it names."""
    context = spark.sparkContext
    where = context._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(context._jsc.hadoopConfiguration()).exists(where)


def read_parquet(spark: SparkSession, path: str, ddl: str | StructType) -> DataFrame:
    """A Parquet folder of a declared type; an empty frame when nothing was written there yet."""
    if exists(spark, path):
        return spark.read.schema(ddl).parquet(path)
    return spark.createDataFrame([], ddl)


def read_csv(spark: SparkSession, path: str, columns: Sequence[str], line_breaks: bool = True) -> DataFrame:
    """The named columns of a headered UTF-8 CSV as text, and the text of records whose number of fields is not the
    header's in `_corrupt`; the cleaning step casts the columns and puts corrupt records into quarantine.

    Quoted values may hold line breaks. Without `line_breaks`, for files known to have none, each line is a record and the
    pass that counts quotes is spared; pieces of a broken record are then corrupt records.
    """
    if line_breaks:
        return read_records(spark, path, CSV, columns)
    header = spark.read.options(**CSV, inferSchema=False).csv(path).columns
    schema, mark = with_mark(header)
    # A reader of fewer columns would not notice that a record has too few.
    reader = spark.read.options(**CSV, columnNameOfCorruptRecord=mark, columnPruning=False).schema(schema)
    return reader.csv(path).select(*columns, F.col(mark).alias(CORRUPT))


def read_csv_star(spark: SparkSession, folder: str, line_breaks: bool = True) -> dict[str, DataFrame]:
    """The six landing files of the star by warehouse table name."""
    return {
        table: read_csv(spark, f"{folder.rstrip('/')}/{file}", schemas.names(schemas.STAR[table]), line_breaks)
        for table, file in schemas.STAR_FILES.items()
    }


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**CSV).csv(path)


def read_json_landing(spark: SparkSession, path: str | list[str], ddl: str) -> DataFrame:
    """Landed JSON documents, one object or array per file; several paths give their union.

    Elements of an array become rows. `_file` names the file of each row.
    """
    return spark.read.schema(ddl).option("multiLine", True).json(path).withColumn("_file", F.input_file_name())


def landed_files(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that a pattern of landing files names, in order; none when there are none."""
    context = spark.sparkContext
    where = context._jvm.org.apache.hadoop.fs.Path(pattern)
    found = where.getFileSystem(context._jsc.hadoopConfiguration()).globStatus(where)
    return sorted(status.getPath().toString() for status in found or [])


def latest_run(files: Sequence[str]) -> list[str]:
    """The files of the newest landing run.

    A run is named by the time stamp in its files' names (`weather_20240101_120000.json`); what follows
    the stamp tells the files of one run apart (`..._120000_part2.json`). A name without stamp is a run.
    """
    def run(file: str) -> str:
        stamp = re.search(r"\d{8}_\d{6}", name := file.rsplit("/", 1)[-1])
        return stamp.group() if stamp else name

    newest = max(map(run, files), default=None)
    return [file for file in files if run(file) == newest]


def read_quality_reports(spark: SparkSession, folder: str) -> DataFrame:
    """The newest report of a folder of reports, by file name."""
    df = read_json_landing(spark, folder, schemas.QUALITY_REPORT)
    return df.filter(F.col("_file") == df.agg(F.max("_file")).scalar())


def read_lineage(spark: SparkSession, path: str) -> DataFrame:
    """One row per task run of a run-record file."""
    return read_json_landing(spark, path, schemas.LINEAGE).select(F.inline("lineage"))


def write_json_report(report: DataFrame, path: str) -> None:
    """A report of one row as one JSON file in a folder of its own."""
    report.coalesce(1).write.mode("errorifexists").json(path)


# snapshots --------------------------------------------------------------------------------------


def new_snapshot() -> str:
    """A snapshot's name, by the time."""
    return dt.datetime.now(dt.timezone.utc).strftime("%Y%m%d%H%M%S%f")


def snapshot_path(root: str, table: str, snapshot: str) -> str:
    return f"{root.rstrip('/')}/{table}/snapshot={snapshot}"


def write_snapshot(df: DataFrame, root: str, table: str, snapshot: str, columns: Sequence[str] | None = None,
                   partition_by: Sequence[str] = ()) -> int:
    """Write the chosen columns of one table and return how many rows that were.

    The count is observed while writing, so the plan runs once.
    """
    observed = Observation()
    rows = df.select(*columns) if columns else df
    writer = rows.observe(observed, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(snapshot_path(root, table, snapshot))
    return observed.get["rows"]


def commit(spark: SparkSession, root: str, snapshot: str, tables: Sequence[str]) -> None:
    """Make the snapshot visible for all its tables at once."""
    row = spark.createDataFrame([(snapshot, dt.datetime.now(dt.timezone.utc), list(tables))], COMMIT_SCHEMA)
    row.coalesce(1).write.mode("append").parquet(f"{root.rstrip('/')}/{COMMITS}")


def current_snapshot(spark: SparkSession, root: str, table: str) -> str | None:
    """The newest committed snapshot that holds `table`."""
    commits = read_parquet(spark, f"{root.rstrip('/')}/{COMMITS}", COMMIT_SCHEMA)
    mine = commits.filter(F.array_contains("tables", table))
    return mine.agg(F.max_by("snapshot", "committed_at").alias("snapshot")).first().snapshot


def read_table(spark: SparkSession, root: str, table: str, ddl: str | StructType) -> DataFrame:
    """The committed rows of a table; an empty frame of the declared type when there are none."""
    snapshot = current_snapshot(spark, root, table)
    if snapshot is None:
        return spark.createDataFrame([], ddl)
    return read_parquet(spark, snapshot_path(root, table, snapshot), ddl)


def read_all(spark: SparkSession, root: str, table: str, ddl: str | StructType) -> DataFrame:
    """The rows of all committed snapshots of a table whose snapshots add to one another."""
    commits = read_parquet(spark, f"{root.rstrip('/')}/{COMMITS}", COMMIT_SCHEMA)
    mine = commits.filter(F.array_contains("tables", table)).select("snapshot").distinct().collect()  # one row per batch
    paths = [snapshot_path(root, table, row.snapshot) for row in mine]
    return spark.read.schema(ddl).parquet(*paths) if paths else spark.createDataFrame([], ddl)


# tables in parts --------------------------------------------------------------------------------
#
# A table in parts (months, or buckets of a key) replaces some of them at a time. A snapshot holds the new parts, and a commit
# row names them; a reader takes each part from the newest commit that has it. Parts that a write does not touch are
# neither read nor written. (Overwriting partitions in place would change one table after the other.)


def commit_parts(spark: SparkSession, root: str, snapshot: str, parts: Mapping[str, Sequence[int]]) -> None:
    """Make the snapshot's parts of all its tables visible at once."""
    at = dt.datetime.now(dt.timezone.utc)
    rows = spark.createDataFrame([(snapshot, at, table, list(some)) for table, some in parts.items()], PART_COMMIT_SCHEMA)
    rows.coalesce(1).write.mode("append").parquet(f"{root.rstrip('/')}/{PART_COMMITS}")


def held_parts(spark: SparkSession, root: str, table: str) -> dict[int, str]:
    """The newest committed snapshot of every part of a table: as many entries as the table has parts."""
    commits = read_parquet(spark, f"{root.rstrip('/')}/{PART_COMMITS}", PART_COMMIT_SCHEMA).filter(F.col("table_name") == table)
    newest = commits.select(F.explode("parts").alias("part"), "snapshot", "committed_at").groupBy("part").agg(
        F.max_by("snapshot", F.struct("committed_at", "snapshot")).alias("snapshot"))
    return {row.part: row.snapshot for row in newest.collect()}


def read_parts(spark: SparkSession, root: str, table: str, ddl: str | StructType, column: str, parts: Sequence[int] | None = None) -> DataFrame:
    """The rows of all parts, or of those asked for, with the partition `column`; a part without rows has none."""
    schema = StructType(StructType.fromDDL(ddl).fields if isinstance(ddl, str) else list(ddl.fields)).add(column, IntegerType())
    by_snapshot: dict[str, list[int]] = {}
    for part, snapshot in held_parts(spark, root, table).items():
        if parts is None or part in parts:
            by_snapshot.setdefault(snapshot, []).append(part)
    found = spark.createDataFrame([], schema)
    for snapshot, mine in sorted(by_snapshot.items()):  # as many as writes whose parts still stand
        rows = read_parquet(spark, snapshot_path(root, table, snapshot), schema)
        found = found.unionByName(rows.filter(F.col(column).isin(sorted(mine))))
    return found


def read_warehouse(spark: SparkSession, root: str, ddls: Mapping[str, str] = schemas.STAR) -> dict[str, DataFrame]:
    return {table: read_table(spark, root, table, ddl) for table, ddl in ddls.items()}


def create_if_absent(spark: SparkSession, root: str, ddls: Mapping[str, str] = schemas.STAR) -> list[str]:
    """Commit an empty snapshot for every declared table that has none; returns their names."""
    absent = [table for table in ddls if current_snapshot(spark, root, table) is None]
    for table in absent:
        write_snapshot(spark.createDataFrame([], ddls[table]), root, table, "0")
    if absent:
        commit(spark, root, "0", absent)
    return absent


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Make tables available to `spark.sql` by name."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)
