"""Sources, the dictionary, keys and layouts."""

from __future__ import annotations

import io
import uuid
import zipfile
from xml.sax.saxutils import escape

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arealis.operators import dictionary as M
from arealis.operators import keys as K
from arealis.session import scratch_path
from arealis.sources import datapack, files, spatial, workbook
from workload.derived import (
    DICTIONARY_SQL,
    REGIONS_SQL,
    dictionary,
    regions,
    table,
    with_sql,
)

ORDER_SCHEMA = T.StructType(
    [T.StructField("region_id", T.StringType())] + [T.StructField(f"g{i}", T.DoubleType()) for i in (1, 2, 3)]
)


# --- file names -----------------------------------------------------------------------------------


def _file_names(spark: SparkSession, sf: str) -> DataFrame:
    """File names in the published form, some upper-case, national or foreign."""
    k = F.col("o_orderkey")
    number = F.lpad((k % 60 + 1).cast("string"), 2, "0")
    area = F.element_at(F.array(*[F.lit(a) for a in ("SA1", "SA2", "LGA", "POA")]), (k % 4 + 1).cast("int"))
    name = F.concat(F.lit("2021Census_G"), number, F.lit("_AUST_"), area, F.when(k % 3 == 0, ".CSV").otherwise(".csv"))
    national = F.concat(F.lit("2021Census_G"), number, F.lit("_AUS.csv"))
    return table(spark, sf, "orders").select(
        k.alias("file_id"), F.when(k % 10 == 0, national).when(k % 10 == 1, F.concat(F.lit("notes_"), number, F.lit(".csv"))).otherwise(name).alias("name")
    )


FILE_NAMES_SQL = """
names AS (
  SELECT o_orderkey AS file_id, CASE
    WHEN o_orderkey % 10 = 0 THEN '2021Census_G' || lpad(CAST(o_orderkey % 60 + 1 AS VARCHAR), 2, '0') || '_AUS.csv'
    WHEN o_orderkey % 10 = 1 THEN 'notes_' || lpad(CAST(o_orderkey % 60 + 1 AS VARCHAR), 2, '0') || '.csv'
    ELSE '2021Census_G' || lpad(CAST(o_orderkey % 60 + 1 AS VARCHAR), 2, '0') || '_AUST_' ||
      ['SA1', 'SA2', 'LGA', 'POA'][CAST(o_orderkey % 4 + 1 AS INT)] || CASE WHEN o_orderkey % 3 = 0 THEN '.CSV' ELSE '.csv' END
    END AS name FROM orders)
"""


def file_discovery(spark, sf):
    names = _file_names(spark, sf)
    return names.filter(files.name_matches(F.col("name"), files.DATA_PREFIX, files.DATA_SUFFIX))


def write_files(lines: DataFrame, root: str) -> None:
    """Text files of their own names from rows file, seq, line."""

    def run(batches):
        from pyarrow import fs

        name, out, count = None, None, 0
        for batch in batches:
            for file, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if file != name:
                    if out:
                        out.close()
                    files, path = fs.FileSystem.from_uri(f"{root}/{file}")
                    files.create_dir(path.rsplit("/", 1)[0], recursive=True)
                    name, out = file, files.open_output_stream(path)
                out.write(f"{line}\n".encode())
                count += 1
        if out:
            out.close()
        yield pa.RecordBatch.from_pydict({"lines": [count]})

    dealt = lines.repartition("file").sortWithinPartitions("file", "seq").select("file", "line")
    dealt.mapInArrow(run, "lines long").agg(F.sum("lines")).collect()


def discovered(spark, sf):
    """Files written under their names, in folders, and found again."""
    root = scratch_path(spark, "files")
    folder = (F.floor(F.col("file_id") / 50) % 3).cast("string")
    lines = _file_names(spark, sf).select(F.concat(F.lit("pack"), folder, F.lit("/"), "name").alias("file"), F.col("file_id").alias("seq"), F.col("file_id").cast("string").alias("line"))
    write_files(lines, root)
    found = files.with_file_keys(files.discover(spark, root))
    return found.select("name", F.element_at(F.split("path", "/"), -2).alias("folder"), "table", "boundary")


def file_keys(spark, sf):
    return files.with_file_keys(file_discovery(spark, sf)).select("file_id", "table", "boundary")


# --- workbooks --------------------------------------------------------------------------------------


def _sheet(rows: list[list]) -> str:
    lines = []
    for i, row in enumerate(rows, 1):
        cells = "".join(
            f'<c r="{chr(65 + j)}{i}" t="inlineStr"><is><t>{escape(str(v))}</t></is></c>' for j, v in enumerate(row) if v is not None
        )
        lines.append(f'<row r="{i}">{cells}</row>')
    return f'<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>{"".join(lines)}</sheetData></worksheet>'


def workbook_bytes(tables: list[list], stats: list[list]) -> bytes:
    """A two-sheet workbook with preamble rows above each marker row."""
    first = [["Some title"], [None, "notes"], ["Table Number", "Table Name", "Table Description"], *tables]
    second = [["Some title"], ["Sequential", "Short", "Long", "Table", "Profile", "Heading", "x", "y", "z"], *[r + ["a", "b", "c"] for r in stats]]
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as book:
        book.writestr("xl/worksheets/sheet1.xml", _sheet(first))
        book.writestr("xl/worksheets/sheet2.xml", _sheet(second))
    return buffer.getvalue()


def _workbooks(spark: SparkSession, sf: str) -> DataFrame:
    """The dictionary packed into workbooks of up to 1,000 statistics each."""
    stats = dictionary(spark, sf).withColumn("book", F.floor(F.col("sequential_id").substr(2, 20).cast("long") / 1000))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        book = int(pdf["book"].iloc[0])
        rows = pdf[list(M.STAT_COLUMNS)].values.tolist()
        heads = [[f"T{book}", f"Table {book}", f"{len(rows)} statistics"], [None, "a row without a number", ""]]
        return pd.DataFrame({"path": [f"Metadata_{book}.xlsx"], "content": [workbook_bytes(heads, rows)]})

    return stats.groupBy("book").applyInPandas(build, "path string, content binary")


def workbook_cells(spark, sf):
    cells = workbook.parse_workbooks(_workbooks(spark, sf))
    return cells.groupBy("sheet").agg(
        F.count(F.lit(1)).alias("rows"), F.max(F.size("cells")).alias("widest"), F.countDistinct("file").alias("books")
    )


def workbook_below_marker(spark, sf):
    below = workbook.skip_preamble(workbook.parse_workbooks(_workbooks(spark, sf)))
    return below.filter(F.col("sheet") == 1).select(F.get("cells", F.lit(0)).alias("sequential_id"), F.size("cells").alias("width"))


def metadata_stats(spark, sf):
    return workbook.load_metadata(workbook.parse_workbooks(_workbooks(spark, sf)))[1]


def metadata_tables(spark, sf):
    return workbook.load_metadata(workbook.parse_workbooks(_workbooks(spark, sf)))[0]


BOOKS_SQL = "books AS (SELECT p_partkey // 1000 AS book, count(*) AS n FROM part GROUP BY 1)"


# --- dirty CSV ----------------------------------------------------------------------------------------


def _dirty_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Order rows as text with stray spaces, substitute characters and ``..``."""
    k = F.col("o_orderkey").cast("string")
    cents = F.col("o_totalprice").cast("string")
    second = F.when(F.col("o_orderstatus") == "P", "..").otherwise(F.col("o_custkey").cast("string"))
    line = F.concat(F.lit("O "), k, F.lit(" , "), cents, F.lit(","), second, F.lit(" ,1 "), F.lpad((F.col("o_orderkey") % 100).cast("string"), 2, "0"), F.lit("\u001a"))
    return table(spark, sf, "orders").select(F.col("o_orderkey"), F.concat(F.lit("f"), (F.col("o_orderkey") % 7).cast("string")).alias("file"), line.alias("line"))


def profile_csv(spark, sf):
    """Written as headed text files, read back through the dirty-CSV parser."""
    path = scratch_path(spark, "csv")
    lines = _dirty_lines(spark, sf).select(F.col("line").alias("region_id g1 g2 g3"))
    lines.write.option("header", True).option("quote", "").option("escape", "").option("sep", "\u0001").csv(path)
    return datapack.read_profile_csv(spark, path, ORDER_SCHEMA)


PROFILE_CSV_SQL = """
SELECT 'O' || CAST(o_orderkey AS VARCHAR) AS region_id, o_totalprice AS g1,
  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_custkey AS DOUBLE) END AS g2,
  CAST('1' || lpad(CAST(o_orderkey % 100 AS VARCHAR), 2, '0') AS DOUBLE) AS g3 FROM orders
"""


def _broken_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The dirty lines with one fault per kind in files f1 to f4."""
    k, line = F.col("o_orderkey"), F.col("line")
    broken = (
        F.when(k == 1, F.concat(line, F.lit(",9")))
        .when(k == 2, F.lit("O2,1"))
        .when(k == 3, F.lit("O3,1,,4"))
        .when(k == 4, F.lit("O4,1,x2,4"))
        .when(k == 12, F.lit("O5,1,2,3"))
    )
    lines = _dirty_lines(spark, sf).select("file", F.coalesce(broken, line).alias("line"))
    return datapack.parse_profile(lines, ORDER_SCHEMA)


def load_report(spark, sf):
    return datapack.file_report(_broken_rows(spark, sf)).orderBy("file")


LOAD_REPORT_SQL = """
WITH f AS (SELECT 'f' || CAST(o_orderkey % 7 AS VARCHAR) AS file, count(*) AS rows FROM orders GROUP BY 1)
SELECT file, rows, CASE WHEN file IN ('f1', 'f2', 'f3', 'f4', 'f5') THEN 'FAILED' ELSE 'SUCCESS' END AS status,
  CASE file WHEN 'f1' THEN 'extra data after the last column' WHEN 'f2' THEN 'missing data for a column'
    WHEN 'f3' THEN 'empty cell where a number belongs' WHEN 'f4' THEN 'malformed number'
    WHEN 'f5' THEN 'duplicate region id O5' END AS error FROM f
"""


def good_files(spark, sf):
    rows = _broken_rows(spark, sf)
    return datapack.good_rows(rows, datapack.file_report(rows)).select("file", "region_id", "g1")


GOOD_FILES_SQL = """
SELECT 'f' || CAST(o_orderkey % 7 AS VARCHAR) AS file, 'O' || CAST(o_orderkey AS VARCHAR) AS region_id, o_totalprice AS g1
FROM orders WHERE o_orderkey % 7 IN (0, 6)
"""


def _pack(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as a datapack of 16 files: three known tables and one that the dictionary
    lacks, four boundaries; one file per fault among them."""
    k = F.col("o_orderkey")
    area = F.element_at(F.array(*[F.lit(a) for a in ("SA1", "SA2", "LGA", "POA")]), (F.floor(k / 4) % 4 + 1).cast("int"))
    name = F.concat(F.lit("2021Census_G0"), (k % 4 + 1).cast("string"), F.lit("_AUST_"), area, F.lit(".csv"))
    broken = F.when(k == 1, F.concat("line", F.lit(",9"))).when(k == 6, F.lit("O6,1,,4")).when(k == 8, F.lit("O8,1,x2,4"))
    rows = _dirty_lines(spark, sf).withColumn("broken", broken)
    lines = rows.select(name.alias("file"), k.alias("seq"), F.coalesce("broken", "line").alias("line"))
    heads = lines.groupBy("file").agg(F.lit(-1).cast("long").alias("seq"), F.lit("region_id,a,b,c").alias("line"))
    return heads.unionByName(lines)


def loaded_pack(spark, sf):
    """The whole load: files found, parsed, checked, good ones written by boundary and
    read back; what each file came to and what is in its place afterwards."""
    source, root = scratch_path(spark, "pack"), scratch_path(spark, "profiles")
    write_files(_pack(spark, sf), source)
    known = [(f"G{t}{i}", f"s{t}{i}", f"long {t} {i}", f"G0{t}", "p", "Persons") for t in (1, 2, 3) for i in (1, 2, 3)]
    stats = spark.createDataFrame(known, ", ".join(f"{c} string" for c in M.STAT_COLUMNS))
    report = datapack.load_all(spark, source, stats, root)
    found = None
    for t in (1, 2, 3):
        rows = spark.read.parquet(f"{root}/g0{t}")
        total = rows.groupBy(F.lit(f"g0{t}").alias("table"), "boundary").agg(F.count("*").alias("stored"), F.sum(f"g{t}1").alias("total"), F.count(f"g{t}2").alias("known"))
        found = total if found is None else found.unionByName(total)
    name = F.element_at(F.split("file", "/"), -1)
    return report.select(name.alias("name"), "table", "boundary", "rows", "status", "error").join(found, ["table", "boundary"], "left").select(
        "name", "table", "boundary", "rows", "status", "error", "stored", F.round("total", 2).alias("total"), "known"
    )


LOAD_ALL_SQL = """
WITH k AS (SELECT o_orderkey % 4 + 1 AS t, ['SA1', 'SA2', 'LGA', 'POA'][CAST(o_orderkey // 4 % 4 + 1 AS INT)] AS area, * FROM orders),
f AS (SELECT t, area, count(*) AS n, sum(o_totalprice) AS total, count(*) FILTER (o_orderstatus <> 'P') AS known, max(CASE o_orderkey WHEN 1 THEN 'extra data after the last column'
    WHEN 6 THEN 'empty cell where a number belongs' WHEN 8 THEN 'malformed number' END) AS error FROM k GROUP BY t, area),
g AS (SELECT *, error IS NULL AND t < 4 AS good FROM f)
SELECT '2021Census_G0' || t || '_AUST_' || area || '.csv' AS name, 'g0' || t AS "table", lower(area) AS boundary, CASE WHEN t = 4 THEN 0 ELSE n END AS rows, CASE WHEN good THEN 'SUCCESS' ELSE 'FAILED' END AS status,
  CASE WHEN t = 4 THEN 'the dictionary has no statistics for table ' || chr(39) || 'g04' || chr(39) ELSE error END AS error, CASE WHEN good THEN n END AS stored, CASE WHEN good THEN round(total, 2) END AS total, CASE WHEN good THEN known END AS known FROM g
"""


def typed_write(spark, sf):
    root = scratch_path(spark, "profile")
    lines = _dirty_lines(spark, sf).select("file", "line")
    rows = datapack.parse_profile(lines, ORDER_SCHEMA).drop("file", "_error")
    datapack.write_profile(rows, root, "lga", "g01")
    return datapack.read_profile(spark, root, "lga", "g01")


# --- keys and layouts ------------------------------------------------------------------------------------


def clustered(spark, sf):
    """Clustered rows, with what makes them prunable: key order inside each partition."""
    laid = K.cluster_by(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", 8)
    return laid.groupBy(F.spark_partition_id().alias("part")).agg(
        F.min("o_orderkey").alias("lo"), F.max("o_orderkey").alias("hi"), F.count(F.lit(1)).alias("rows")
    ).agg(F.sum("rows").alias("rows"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def layout_of(laid: DataFrame, key: str, spark: SparkSession) -> DataFrame:
    """What a written layout is like, read back from its files: rows, whether rows ascend
    inside each file, whether the ranges of the files follow one another without overlap,
    and whether no file has nearly all rows."""
    path = scratch_path(spark, "layout")
    laid.write.parquet(path)
    back = spark.read.parquet(path).select(key, F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    before = F.lag(key).over(Window.partitionBy("file").orderBy("at"))
    per_file = back.withColumn("up", F.coalesce(before <= F.col(key), F.lit(True))).groupBy("file").agg(
        F.count(F.lit(1)).alias("n"), F.min(key).alias("lo"), F.max(key).alias("hi"), F.min("up").alias("up")
    )
    # one row per file
    follows = F.coalesce(F.lag("hi").over(Window.orderBy("lo", "hi")) <= F.col("lo"), F.lit(True))
    return per_file.withColumn("apart", follows).agg(
        F.sum("n").alias("rows"), F.min("up").alias("ascending"), F.min("apart").alias("apart"), (F.count(F.lit(1)) > 1).alias("several"), (F.max("n") / F.sum("n") < 0.9).alias("spread")
    )


def clustered_files(spark, sf):
    """A key that a quarter of the rows share is cut between files."""
    orders = table(spark, sf, "orders").select(F.when(F.col("o_orderkey") % 4 == 0, 7).otherwise(F.col("o_custkey")).alias("key"), "o_orderkey")
    return layout_of(K.cluster_by(orders, "key", 8), "key", spark)


def key_range_files(spark, sf):
    laid = spatial.read_partitioned(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 500)
    return layout_of(laid.sortWithinPartitions("o_orderkey"), "o_orderkey", spark)


LAYOUT_SQL = "SELECT count(*) AS rows, true AS ascending, true AS apart, true AS several, true AS spread FROM orders"


def listed_tables(spark, sf):
    """Tables saved under names to export and names to leave out, in a database of their
    own: those listed for export, with their rows."""
    database = f"listing_{uuid.uuid4().hex}"
    orders = table(spark, sf, "orders")
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_path(spark, 'database')}'")
    for name in ("lga_g01", "lga_2011_g01", "g02_analysis", "sa1_display_z", "qa", "sa2_g03"):
        orders.filter(F.col("o_orderkey") % 6 == len(name) % 6).select("o_orderkey").write.saveAsTable(f"{database}.{name}")
    names = [r["table_name"] for r in spatial.list_tables(spark, database).collect()]
    found = None
    for name in names:
        rows = spark.table(f"{database}.{name}").agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows"))
        found = rows if found is None else found.unionByName(rows)
    return found


def duplicates(spark, sf):
    return K.duplicate_keys(table(spark, sf, "orders").select("o_custkey"), "o_custkey")


def key_range_scan(spark, sf):
    return spatial.read_partitioned(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 2000)


def row_ids(spark, sf):
    orders = table(spark, sf, "orders").select("o_totalprice", "o_orderkey")
    return K.with_row_id(orders, ["o_totalprice", "o_orderkey"]).select("gid", "o_orderkey")


def chunks(spark, sf):
    return K.range_chunks(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 12)


CHUNKS_SQL = """
WITH b AS (SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders),
p AS (SELECT lo - 1 AS start, CASE WHEN (hi - lo) / 12.0 < 10 THEN 10 ELSE (hi - lo) // 12 + 1 END AS width FROM b),
c AS (SELECT CAST(ceil((o_orderkey - start) / CAST(width AS DOUBLE)) AS INT) AS chunk, start, width FROM orders, p)
SELECT chunk, start + (chunk - 1) * width AS lo, start + chunk * width AS hi, count(*) AS rows FROM c GROUP BY chunk, start, width
"""


def catalog_listing(spark, sf):
    """The name filter over table names made from the dictionary."""
    number = F.lower("table_number")
    name = (
        F.when(F.col("profile_table") == "Brand#1", F.concat(F.lit("lga_2011_"), number))
        .when(F.col("profile_table") == "Brand#2", F.concat(number, F.lit("_analysis")))
        .when(F.col("profile_table") == "Brand#3", F.concat(number, F.lit("_display_z")))
        .when(F.col("profile_table") == "Brand#4", F.lit("qa"))
        .otherwise(F.concat(F.lit("lga_"), number))
    )
    names = dictionary(spark, sf).select("sequential_id", name.alias("table_name"))
    return names.filter(spatial.exportable("table_name"))


CATALOG_SQL = with_sql(
    DICTIONARY_SQL,
    """names AS (SELECT sequential_id, CASE profile_table WHEN 'Brand#1' THEN 'lga_2011_' || lower(table_number)
      WHEN 'Brand#2' THEN lower(table_number) || '_analysis' WHEN 'Brand#3' THEN lower(table_number) || '_display_z'
      WHEN 'Brand#4' THEN 'qa' ELSE 'lga_' || lower(table_number) END AS table_name FROM dictionary)""",
    body="""SELECT * FROM names WHERE table_name <> 'qa' AND table_name NOT LIKE '%_2011_%'
      AND table_name NOT LIKE '%_analysis%' AND table_name NOT LIKE '%_display%'""",
)


def column_list(spark, sf):
    from arealis.operators.stats import attributes

    return attributes(regions(spark, sf)).select("code", "name", "state", "area_sqkm")


# --- dictionary ----------------------------------------------------------------------------------------------


def schema_columns(spark, sf):
    """Columns a profile table would get, in order (prefix match on ``g1``)."""
    found = M.profile_stats(dictionary(spark, sf), "g1")
    return found.select(F.lower("sequential_id").alias("column_name"), "table_number", M.id_number().alias("number"))


def lookup(spark, sf):
    stats = dictionary(spark, sf)
    by_id = M.find_stat(stats, "T101").select("sequential_id", "long_id")
    by_table = M.find_stat(stats, table="G12", heading="Persons").select("sequential_id", "long_id")
    return by_id.unionByName(by_table)


def ensure(spark, sf):
    codes = dictionary(spark, sf).select("sequential_id", F.when(F.col("profile_table") > "Brand#2", F.concat(F.lit("IARE"), "sequential_id")).otherwise(F.col("sequential_id")).alias("code"))
    return M.ensure_prefix(M.ensure_prefix(codes, "code", "IARE"), "code", "IARE")


def appended(spark, sf):
    """Parts of the dictionary written apart and read back as one table."""
    root = scratch_path(spark, "append")
    stats = dictionary(spark, sf)
    for letter in "GTIB":
        M.list_profile(stats, letter).write.mode("append").parquet(root)
    return spark.read.parquet(root)


def long_form(spark, sf):
    from workload.derived import region_profile

    profile = region_profile(spark, sf)
    return M.to_long(profile, dictionary(spark, sf)).select("region_id", "stat_id", "value", "long_id")


def descriptors(spark, sf):
    ids = [f"{letter}{n}" for n in (100, 201, 302, 403, 504) for letter in "gtib"]
    return M.stat_descriptors(dictionary(spark, sf), ids)


DICT = DICTIONARY_SQL
QUERIES = {
    "s01_file_discovery": (file_discovery, with_sql(FILE_NAMES_SQL, body="SELECT * FROM names WHERE lower(name) LIKE '2021census\\_%.csv' ESCAPE '\\'")),
    "s02_file_keys": (
        file_keys,
        with_sql(
            FILE_NAMES_SQL,
            body="""SELECT file_id, split_part(split_part(lower(name), '.', 1), '_', 2) AS "table",
              CASE WHEN lower(name) LIKE '%\\_aus.%' ESCAPE '\\' THEN 'aust' ELSE split_part(split_part(lower(name), '.', 1), '_', 4) END AS boundary
              FROM names WHERE lower(name) LIKE '2021census\\_%.csv' ESCAPE '\\'""",
        ),
    ),
    "s01_discover": (
        discovered,
        with_sql(FILE_NAMES_SQL, body="""SELECT DISTINCT name, 'pack' || CAST(file_id // 50 % 3 AS VARCHAR) AS folder, split_part(split_part(lower(name), '.', 1), '_', 2) AS "table",
            CASE WHEN lower(name) LIKE '%\\_aus.%' ESCAPE '\\' THEN 'aust' ELSE split_part(split_part(lower(name), '.', 1), '_', 4) END AS boundary
            FROM names WHERE lower(name) LIKE '2021census\\_%.csv' ESCAPE '\\'"""),
    ),
    "s10_clustered_files": (clustered_files, LAYOUT_SQL),
    "s11_load_all": (loaded_pack, LOAD_ALL_SQL),
    "s13_key_range_files": (key_range_files, LAYOUT_SQL),
    "s16_list_tables": (listed_tables, "SELECT 'lga_g01' AS table_name, count(*) AS rows FROM orders WHERE o_orderkey % 6 = 1 UNION ALL SELECT 'sa2_g03', count(*) FROM orders WHERE o_orderkey % 6 = 1"),
    "s03_workbook_scan": (
        workbook_cells,
        with_sql(BOOKS_SQL, body="""SELECT 0 AS sheet, CAST(5 * count(*) AS BIGINT) AS rows, 3 AS widest, count(*) AS books FROM books
            UNION ALL SELECT 1, CAST(sum(n) + 2 * count(*) AS BIGINT), 9, count(*) FROM books"""),
    ),
    "s04_skip_preamble": (workbook_below_marker, with_sql(DICT, body="SELECT sequential_id, 9 AS width FROM dictionary")),
    "s05_excess_columns": (metadata_stats, with_sql(DICT, body="SELECT * FROM dictionary")),
    "s06_metadata_clean": (
        metadata_tables,
        with_sql(BOOKS_SQL, body="""SELECT 'T' || CAST(book AS VARCHAR) AS table_number, 'Table ' || CAST(book AS VARCHAR) AS table_name,
            CAST(n AS VARCHAR) || ' statistics' AS table_description FROM books"""),
    ),
    "s07_profile_schema": (
        schema_columns,
        with_sql(DICT, body="SELECT lower(sequential_id) AS column_name, table_number, CAST(substr(sequential_id, 2) AS INT) AS number FROM dictionary WHERE lower(table_number) LIKE 'g1%'"),
    ),
    "s08_profile_csv": (profile_csv, PROFILE_CSV_SQL),
    "s09_typed_write": (typed_write, PROFILE_CSV_SQL),
    "s10_key_clustering": (clustered, "SELECT count(*) AS rows, min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders"),
    "s11_load_report": (load_report, LOAD_REPORT_SQL),
    "s11_good_files": (good_files, GOOD_FILES_SQL),
    "s12_duplicate_keys": (duplicates, "SELECT o_custkey, count(*) AS rows FROM orders GROUP BY o_custkey HAVING count(*) > 1 OR o_custkey IS NULL"),
    "s13_key_range_scan": (key_range_scan, "SELECT o_orderkey, o_totalprice FROM orders"),
    "s14_row_id": (row_ids, "SELECT row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS gid, o_orderkey FROM orders"),
    "s15_range_chunks": (chunks, CHUNKS_SQL),
    "s16_catalog_filter": (catalog_listing, CATALOG_SQL),
    "s17_attributes": (column_list, with_sql(REGIONS_SQL, body="SELECT code, name, state, w * w * 40000 + 1 AS area_sqkm FROM regions")),
    "p01_find_stat": (
        lookup,
        with_sql(DICT, body="""SELECT sequential_id, long_id FROM dictionary WHERE sequential_id = 'T101'
            UNION ALL SELECT sequential_id, long_id FROM dictionary WHERE table_number = 'G12' AND column_heading_description = 'Persons'"""),
    ),
    "p02_search_stats": (
        lambda spark, sf: M.search_stats(dictionary(spark, sf), "medi", "T"),
        with_sql(DICT, body="SELECT sequential_id, replace(long_id, '_', ' ') AS long_id FROM dictionary WHERE lower(long_id) LIKE '%medi%' AND sequential_id LIKE 'T%'"),
    ),
    "p03_list_profile": (
        lambda spark, sf: M.list_profile(dictionary(spark, sf), "G"),
        with_sql(DICT, body="SELECT * FROM dictionary WHERE left(sequential_id, 1) = 'G'"),
    ),
    "p07_strip_prefix": (
        lambda spark, sf: M.strip_prefix(regions(spark, sf).select("k", "code"), "code", 3),
        with_sql(REGIONS_SQL, body="SELECT k, substr(code, 4) AS code FROM regions"),
    ),
    "p08_ensure_prefix": (ensure, with_sql(DICT, body="SELECT sequential_id, 'IARE' || sequential_id AS code FROM dictionary")),
    "p12_stat_descriptors": (
        descriptors,
        with_sql(DICT, body="""SELECT lower(sequential_id) AS id, replace(long_id, '_', ' ') AS description, column_heading_description AS type,
            CASE WHEN column_heading_description = 'Persons' THEN 'percent' ELSE 'values' END AS maptype, lower(table_number) AS "table"
            FROM dictionary WHERE CAST(substr(sequential_id, 2) AS INT) IN (100, 201, 302, 403, 504)"""),
    ),
    "a01_profile_counts": (
        lambda spark, sf: M.profile_counts(dictionary(spark, sf)),
        with_sql(DICT, body="SELECT left(sequential_id, 1) AS profile, count(*) AS count FROM dictionary GROUP BY 1"),
    ),
    "a15_key_bounds": (
        lambda spark, sf: K.key_bounds(table(spark, sf, "orders"), "o_orderkey"),
        "SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders",
    ),
    "o02_dictionary_order": (
        lambda spark, sf: dictionary(spark, sf).select("sequential_id", "table_number").orderBy("table_number", M.id_number()),
        with_sql(DICT, body="SELECT sequential_id, table_number FROM dictionary"),
    ),
    "o06_append": (appended, with_sql(DICT, body="SELECT * FROM dictionary")),
}
