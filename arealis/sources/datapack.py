"""Dirty profile CSVs to typed wide tables, with an outcome per file."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arealis.operators.dictionary import REGION_ID, profile_schema
from arealis.operators.keys import cluster_by
from arealis.session import remove, scratch_path
from arealis.sources.files import discover, with_file_keys

# The cell that means NULL, and the characters deleted everywhere.
NULL_CELL = ".."
DELETED_CHARS = " \u001a"
# The files are comma-separated, so this never occurs; it keeps lines whole.
LINE_SEPARATOR = "\u0001"

SUCCESS = "SUCCESS"


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Data lines of CSV files with their ``file``; blank lines and each file's
    first non-blank line (the header) are gone. Files stay splittable."""
    return (
        spark.read.schema("line string")
        .option("header", True)
        .option("enforceSchema", True)
        .option("sep", LINE_SEPARATOR)
        .option("quote", "")
        .option("comment", "")
        .csv(paths)
        .select("line", F.col("_metadata.file_path").alias("file"))
    )


def clean_line(line: Column | str) -> Column:
    """Delete every space and every substitute character."""
    c = F.col(line) if isinstance(line, str) else line
    return F.translate(c, DELETED_CHARS, "")


def parse_profile(lines: DataFrame, schema: T.StructType, line: str = "line") -> DataFrame:
    """Parse text lines by position; adds ``_error``, NULL for a good row.

    A row is bad when it has the wrong number of cells, an empty cell where a
    number belongs, a malformed number, or no region id.
    """
    others = [c for c in lines.columns if c != line]
    cleaned = lines.withColumn("_text", clean_line(line)).filter(F.col("_text") != "")
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields) + ", _corrupt string"
    options = {"nullValue": NULL_CELL, "columnNameOfCorruptRecord": "_corrupt", "mode": "PERMISSIVE"}
    # a generated column: the optimizer would parse again for every filter on the result
    parsed = cleaned.withColumn("_row", F.explode(F.array(F.from_csv("_text", ddl, options))))

    width = len(schema.fields)
    # commas counted by length, compiled; only lines with quotes need the regular expression
    plain = F.when(F.col("_text").contains('"'), F.regexp_replace("_text", '"[^"]*"', "q")).otherwise(F.col("_text"))
    parsed = parsed.withColumn("_cells", F.length(plain) - F.length(F.translate(plain, ",", "")) + 1)
    cells, text = F.col("_cells"), F.col("_text")
    error = (
        F.when(cells < width, F.lit("missing data for a column"))
        .when(cells > width, F.lit("extra data after the last column"))
        .when(text.contains(",,") | text.endswith(","), F.lit("empty cell where a number belongs"))
        .when(F.col("_row._corrupt").isNotNull(), F.lit("malformed number"))
        .when(F.col(f"_row.{schema.fields[0].name}").isNull(), F.lit("region id is null"))
    )
    return parsed.select(*others, *[F.col(f"_row.`{f.name}`") for f in schema.fields], error.alias("_error"))


def read_profile_csv(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, strict: bool = True) -> DataFrame:
    """Typed rows of profile CSVs. ``strict`` raises on the first bad row, as one
    bad row fails its file; otherwise rows keep ``file`` and ``_error``."""
    rows = parse_profile(read_lines(spark, paths), schema)
    if not strict:
        return rows
    # a filter, so that no later column pruning can lose the check
    refuse = F.raise_error(F.concat_ws(": ", "file", "_error")).cast("boolean")
    return rows.filter(F.when(F.col("_error").isNotNull(), refuse).otherwise(F.lit(True))).drop("file", "_error")


def file_report(rows: DataFrame) -> DataFrame:
    """Outcome per file of non-strict rows: ``file, rows, status, error``.

    Two-step: repeated region ids are counted per (file, id) first, so no file,
    however large, gathers in one task.
    """
    per_key = rows.groupBy("file", REGION_ID).agg(
        F.count(F.lit(1)).alias("n"), F.min("_error").alias("bad")
    )
    return (
        per_key.groupBy("file")
        .agg(
            F.sum("n").alias("rows"),
            F.min("bad").alias("bad"),
            F.max(F.when(F.col("bad").isNull() & (F.col("n") > 1), F.col(REGION_ID))).alias("twice"),
        )
        .select(
            "file",
            "rows",
            F.when(F.col("bad").isNull() & F.col("twice").isNull(), SUCCESS).otherwise("FAILED").alias("status"),
            F.coalesce(
                "bad", F.when(F.col("twice").isNotNull(), F.concat(F.lit("duplicate region id "), "twice"))
            ).alias("error"),
        )
    )


def good_rows(rows: DataFrame, report: DataFrame) -> DataFrame:
    """Rows of the files that loaded; one bad file does not stop the rest."""
    ok = report.filter(F.col("status") == SUCCESS).select("file")
    return rows.join(ok, "file", "left_semi").drop("_error")


def profile_path(root: str, boundary: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}/boundary={boundary}"


def write_profile(df: DataFrame, root: str, boundary: str, table: str) -> None:
    """Replace the ``{boundary}_{table}`` profile, clustered on the region id."""
    cluster_by(df, REGION_ID).write.mode("overwrite").parquet(profile_path(root, boundary, table))


def read_profile(spark: SparkSession, root: str, boundary: str, table: str) -> DataFrame:
    return spark.read.parquet(profile_path(root, boundary, table))


# profile tables loaded at the same time
AT_ONCE = 4


def load_all(spark: SparkSession, directory: str, stats: DataFrame, root: str, exact: bool = False, at_once: int = AT_ONCE) -> DataFrame:
    """Load every data file under ``directory``.

    Files of one profile table share a schema, so each table is one parse over all its
    files, kept as typed rows until their outcome per file is known, and one write of the
    good ones, partitioned by boundary. Tables are loaded side by side, each in a
    scheduler pool of its own. Returns ``file, table, boundary, rows, status, error``.
    """
    files = with_file_keys(discover(spark, directory))
    # names of files and tables only; the data itself stays in Spark
    listing = [r.asDict() for r in files.select("path", "name", "table", "boundary").orderBy("path").collect()]
    if not listing:
        raise ValueError(f"no data files under {directory}")
    by_table: dict[str, list[dict]] = {}
    for f in listing:
        by_table.setdefault(f["table"], []).append(f)
    load = inheritable_thread_target(spark)(lambda item: _load_table(spark, *item, stats, root, exact))
    with ThreadPoolExecutor(min(at_once, len(by_table))) as pool:
        reports = list(pool.map(load, sorted(by_table.items())))
    result = reports[0]
    for r in reports[1:]:
        result = result.unionByName(r)
    return result


def _load_table(spark: SparkSession, table: str, members: list[dict], stats: DataFrame, root: str, exact: bool) -> DataFrame:
    """Load the files of one profile table; the outcome per file."""
    spark.sparkContext.setLocalProperty("spark.scheduler.pool", table)
    keys = spark.createDataFrame(
        [(f["path"], f["table"], f["boundary"]) for f in members], "path string, table string, boundary string"
    )
    try:
        schema = profile_schema(stats, table, exact)
    except ValueError as failure:
        return keys.select(
            F.col("path").alias("file"), "table", "boundary", F.lit(0).cast("long").alias("rows"),
            F.lit("FAILED").alias("status"), F.lit(str(failure)).alias("error"),
        )
    parsed = scratch_path(spark, "parsed")
    read_profile_csv(spark, [f["path"] for f in members], schema, strict=False).write.parquet(parsed)
    rows = spark.read.parquet(parsed)
    report = _report_with_keys(file_report(rows), keys)
    target = f"{root.rstrip('/')}/_report/{table}"
    report.write.mode("overwrite").parquet(target)
    report = spark.read.parquet(target)
    _write_table(rows, report, root, table)
    remove(spark, parsed)
    return report


def _report_with_keys(report: DataFrame, keys: DataFrame) -> DataFrame:
    """Attach table and boundary; files without data rows load as empty tables.

    Of several good files for one boundary only the last by path stays, as each
    load replaces the table."""
    normal = F.regexp_replace(F.col("path"), "^file:/+", "file:/")
    file_normal = F.regexp_replace(F.col("file"), "^file:/+", "file:/")
    joined = keys.withColumn("_k", normal).join(
        report.withColumn("_k", file_normal).drop("file"), "_k", "left"
    )
    full = joined.select(
        F.col("path").alias("file"),
        "table",
        "boundary",
        F.coalesce("rows", F.lit(0)).cast("long").alias("rows"),
        F.coalesce("status", F.lit(SUCCESS)).alias("status"),
        "error",
    )
    last = (
        full.filter(F.col("status") == SUCCESS)
        .groupBy("boundary")
        .agg(F.max("file").alias("_last"))
    )
    replaced = (F.col("status") == SUCCESS) & (F.col("file") != F.col("_last"))
    return full.join(last, "boundary", "left").select(
        "file", "table", "boundary", "rows",
        F.when(replaced, "REPLACED").otherwise(F.col("status")).alias("status"),
        "error",
    )


def _write_table(rows: DataFrame, report: DataFrame, root: str, table: str) -> None:
    ok = report.filter(F.col("status") == SUCCESS).select(
        F.regexp_replace("file", "^file:/+", "file:/").alias("_k"), "boundary"
    )
    good = (
        rows.withColumn("_k", F.regexp_replace("file", "^file:/+", "file:/"))
        .join(ok, "_k")
        .drop("_k", "file", "_error")
    )
    (
        cluster_by(good, ["boundary", REGION_ID])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("boundary")
        .parquet(f"{root.rstrip('/')}/{table}")
    )
