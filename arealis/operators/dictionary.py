"""The data dictionary: lookups, searches and the schemas it dictates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLE_COLUMNS = ("table_number", "table_name", "table_description")
STAT_COLUMNS = (
    "sequential_id",
    "short_id",
    "long_id",
    "table_number",
    "profile_table",
    "column_heading_description",
)
REGION_ID = "region_id"


def id_number(column: Column | str = "sequential_id") -> Column:
    """The integer after the first letter of a statistic id."""
    c = F.col(column) if isinstance(column, str) else column
    return F.substring(c, 2, 2147483647).cast("int")


def profile_stats(stats: DataFrame, table: str, exact: bool = False) -> DataFrame:
    """Statistics of a profile table in column order.

    The table is matched as a prefix (``g1`` also takes ``g10``) unless ``exact``.
    """
    number = F.lower("table_number")
    match = number == table.lower() if exact else number.startswith(table.lower())
    return stats.filter(match).orderBy("table_number", id_number())


def profile_schema(stats: DataFrame, table: str, exact: bool = False) -> T.StructType:
    """Schema of a profile table: the region id and one double per statistic.

    Only column names reach the driver, as any schema must.
    """
    names = [r[0] for r in profile_stats(stats, table, exact).select(F.lower("sequential_id")).collect()]
    if not names:
        raise ValueError(f"the dictionary has no statistics for table {table!r}")
    fields = [T.StructField(REGION_ID, T.StringType())]
    return T.StructType(fields + [T.StructField(n, T.DoubleType()) for n in names])


def find_stat(stats: DataFrame, stat_id: str | None = None, table: str | None = None, heading: str | None = None) -> DataFrame:
    """Dictionary rows by id, or by table and column heading."""
    found = stats
    if stat_id is not None:
        found = found.filter(F.col("sequential_id") == stat_id)
    if table is not None:
        found = found.filter(F.col("table_number") == table)
    if heading is not None:
        found = found.filter(F.col("column_heading_description") == heading)
    return found


def search_stats(stats: DataFrame, term: str, prefix: str | None = None) -> DataFrame:
    """Ids and readable descriptions that contain ``term``, in id order."""
    hits = stats.filter(F.lower("long_id").contains(term.lower()))
    if prefix:
        hits = hits.filter(F.col("sequential_id").startswith(prefix))
    return hits.select(
        "sequential_id", F.replace(F.col("long_id"), F.lit("_"), F.lit(" ")).alias("long_id")
    ).orderBy("sequential_id")


def list_profile(stats: DataFrame, letter: str) -> DataFrame:
    """All statistics of one profile letter, by table then id (text order)."""
    return stats.filter(F.left(F.col("sequential_id"), F.lit(1)) == letter).orderBy(
        "table_number", "sequential_id"
    )


def profile_counts(stats: DataFrame) -> DataFrame:
    """Number of statistics per profile letter."""
    return stats.groupBy(F.substring("sequential_id", 1, 1).alias("profile")).agg(
        F.count(F.lit(1)).alias("count")
    )


def stat_descriptors(stats: DataFrame, ids: Sequence[str], percent_types: Sequence[str] = ("Persons",)) -> DataFrame:
    """Map descriptors ``id, description, type, maptype, table`` of the asked ids.

    Counts of ``percent_types`` are mapped as percents of population, anything
    else (medians, averages, rates) as values.
    """
    wanted = [i.lower() for i in ids]
    heading = F.col("column_heading_description")
    return stats.filter(F.lower("sequential_id").isin(wanted)).select(
        F.lower("sequential_id").alias("id"),
        F.replace(F.col("long_id"), F.lit("_"), F.lit(" ")).alias("description"),
        heading.alias("type"),
        F.when(heading.isin(list(percent_types)), "percent").otherwise("values").alias("maptype"),
        F.lower("table_number").alias("table"),
    )


def strip_prefix(df: DataFrame, column: str, n: int) -> DataFrame:
    """Drop the first ``n`` characters of a code."""
    return df.withColumn(column, F.substring(F.col(column), F.lit(n + 1), F.length(column)))


def ensure_prefix(df: DataFrame, column: str, prefix: str) -> DataFrame:
    """Put ``prefix`` before codes that lack it; running it twice changes nothing."""
    c = F.col(column)
    return df.withColumn(column, F.when(~c.startswith(prefix), F.concat(F.lit(prefix), c)).otherwise(c))


def to_long(df: DataFrame, stats: DataFrame | None = None, key: str = REGION_ID) -> DataFrame:
    """Wide profile to ``region_id, stat_id, value``, labelled from the dictionary.

    The dictionary side is cut to the profile's own columns, so its size is
    bounded by the width of the schema and it may be broadcast.
    """
    columns = [c for c in df.columns if c != key]
    long = df.unpivot([key], columns, "stat_id", "value")
    if stats is None:
        return long
    labels = stats.filter(F.lower("sequential_id").isin(columns)).select(
        F.lower("sequential_id").alias("stat_id"), "long_id", "table_number"
    )
    return long.join(F.broadcast(labels), "stat_id", "left")
