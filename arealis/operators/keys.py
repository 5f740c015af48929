"""Keys: constraint checks, exact row numbers, ranges and clustered layouts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arealis.session import checkpointed


def duplicate_keys(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Key values that break a primary key: repeated, or NULL."""
    keys = [key] if isinstance(key, str) else list(key)
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    return counts.filter((F.col("rows") > 1) | missing)


def assert_unique(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """``df`` itself, once its key is known to be unique and not NULL."""
    offenders = duplicate_keys(df, key).limit(5).collect()
    if offenders:
        raise ValueError(f"key {key!r} is not unique and not null, e.g. {[r.asDict() for r in offenders]}")
    return df


# --- ordered prefixes without a one-task window ------------------------------------


def ordered_slices(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows cut into globally ordered slices, numbered in ``_slice``.

    Range partitioning samples its bounds, so a recomputed task could cut
    elsewhere; the slices are checkpointed to pin them. ``order`` must end in a
    unique key, which is also what lets a hot value spread over many slices.
    """
    ranged = df.repartitionByRange(*[F.col(c).asc_nulls_last() for c in order])
    return checkpointed(ranged.withColumn("_slice", F.spark_partition_id()))


def with_row_id(df: DataFrame, order: str | Sequence[str], name: str = "gid") -> DataFrame:
    """Gap-free row numbers from 1 in key order, numbered slice by slice."""
    keys = [order] if isinstance(order, str) else list(order)
    sliced = ordered_slices(df, keys)
    # one row per slice, so this window holds as many rows as there are partitions
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy("_slice")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_slice", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    within = Window.partitionBy("_slice").orderBy(*[F.col(k).asc_nulls_last() for k in keys])
    return (
        sliced.withColumn(name, F.row_number().over(within).cast("long"))
        .join(F.broadcast(offsets), "_slice")
        .withColumn(name, F.col(name) + F.col("_offset"))
        .drop("_slice", "_offset")
    )


def run_rank(df: DataFrame, class_col: str, order: str | Sequence[str], name: str = "rank") -> DataFrame:
    """Number the runs of equal ``class_col`` met in ``order`` (gaps and islands).

    The first row, a NULL class before it, and any change open a run. Each slice
    numbers its own runs; the slice totals then give every slice its start.
    """
    keys = [order] if isinstance(order, str) else list(order)
    sliced = ordered_slices(df, keys)
    sort = [F.col(k).asc_nulls_last() for k in keys]
    within = Window.partitionBy("_slice").orderBy(*sort)
    cls = F.col(class_col)
    previous = F.lag(cls).over(within)
    first_in_slice = F.row_number().over(within) == 1
    opened = F.when(first_in_slice, 0).when(previous.isNull(), 1).when(cls == previous, 0).otherwise(1)
    marked = sliced.select("*", opened.alias("_open"), first_in_slice.alias("_head"))

    position = F.struct(*[c for k in keys for c in (F.col(k).isNull(), F.col(k))])
    totals = marked.groupBy("_slice").agg(
        F.sum("_open").alias("_opened"),
        F.max(F.when(F.col("_head"), F.struct(cls.alias("c")))).getField("c").alias("_first"),
        F.max_by(F.struct(cls.alias("c")), position).getField("c").alias("_last"),
    )
    ordered = Window.orderBy("_slice")
    prior = F.lag("_last").over(ordered)
    joins = F.when(prior.isNull(), 1).when(F.col("_first") == prior, 0).otherwise(1)
    starts = totals.select("_slice", "_opened", joins.alias("_joins")).select(
        "_slice",
        (
            F.sum(F.col("_opened") + F.col("_joins")).over(
                ordered.rowsBetween(Window.unboundedPreceding, 0)
            )
            - F.col("_opened")
        ).alias("_start"),
    )
    running = F.sum("_open").over(within.rowsBetween(Window.unboundedPreceding, 0))
    return (
        marked.withColumn(name, running)
        .join(F.broadcast(starts), "_slice")
        .withColumn(name, F.col(name) + F.col("_start"))
        .drop("_slice", "_open", "_head", "_start")
    )


# --- ranges ------------------------------------------------------------------------


def key_bounds(df: DataFrame, key: str) -> DataFrame:
    """Smallest and largest key, for partition bounds."""
    return df.agg(F.min(key).alias("lo"), F.max(key).alias("hi"))


def chunk_plan(df: DataFrame, key: str, n: int) -> tuple[int, int, int]:
    """``(start, width, chunks)`` that cut an integer key into about ``n`` ranges.

    Ranges are ``(start + i*width, start + (i+1)*width]``; short key spans use
    width 10 and fewer chunks.
    """
    lo, hi = key_bounds(df, key).first()
    if lo is None:
        raise ValueError("cannot chunk an empty table")
    span = hi - lo
    if span / n < 10:
        return lo - 1, 10, span // 10 + 1
    return lo - 1, span // n + 1, n


def chunk_of(key: Column | str, start: int, width: int) -> Column:
    """1-based chunk number of a key."""
    k = F.col(key) if isinstance(key, str) else key
    return F.ceil((k - F.lit(start)) / F.lit(float(width))).cast("int")


def range_chunks(df: DataFrame, key: str, n: int) -> DataFrame:
    """Rows per key range ``(lo, hi]``: shows skew before a chunked export."""
    start, width, _ = chunk_plan(df, key, n)
    return (
        df.groupBy(chunk_of(key, start, width).alias("chunk"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(
            "chunk",
            (F.lit(start) + (F.col("chunk") - 1) * width).cast("long").alias("lo"),
            (F.lit(start) + F.col("chunk") * width).cast("long").alias("hi"),
            "rows",
        )
    )


def sorted_ranges(df: DataFrame, columns: Sequence[Column], partitions: int | None = None) -> DataFrame:
    """Range partitions in the order of ``columns``, sorted inside.

    The row's position breaks ties, so a value that many rows share, even as
    exact copies, spreads over several partitions and stays in order.
    """
    tied = df.withColumn("_tie", F.monotonically_increasing_id())
    by = [*columns, F.col("_tie")]
    ranged = tied.repartitionByRange(partitions, *by) if partitions else tied.repartitionByRange(*by)
    return ranged.sortWithinPartitions(*columns).drop("_tie")


def cluster_by(df: DataFrame, key: str | Sequence[str], partitions: int | None = None) -> DataFrame:
    """Key-clustered layout, so that Parquet min/max statistics prune by key."""
    keys = [key] if isinstance(key, str) else list(key)
    return sorted_ranges(df, [F.col(k) for k in keys], partitions)


def analyze_table(spark: SparkSession, name: str) -> None:
    """Refresh optimizer statistics of a saved table."""
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR ALL COLUMNS")


def first_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """One whole row per key, the first in ``order``.

    ``min_by`` combines map-side, so a hot key reaches its reducer as one row per task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    row = F.struct(*[F.col(c) for c in df.columns])
    picked = df.groupBy(*keys).agg(F.min_by(row, F.struct(*order)).alias("_row"))
    return picked.select("_row.*")
