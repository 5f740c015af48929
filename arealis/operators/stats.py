"""Joins, rates, totals, histograms and ordered results over statistics."""

from __future__ import annotations

import builtins
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealis.functions import geometry as G
from arealis.functions.scalars import ratio, round_half_even_int
from arealis.operators.dictionary import REGION_ID


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- joins --------------------------------------------------------------------------


def attach_stats(bdy: DataFrame, stats: DataFrame, bdy_key: str, how: str = "left") -> DataFrame:
    """Boundaries with their statistics; ``left`` keeps regions without any.

    The join strategy is left to AQE, which sees the real sizes.
    """
    return bdy.join(stats, bdy[bdy_key] == stats[REGION_ID], how).drop(stats[REGION_ID])


def join_profiles(profiles: Sequence[DataFrame] | Mapping[str, DataFrame], key: str = REGION_ID) -> DataFrame:
    """Profile tables side by side. Given as a mapping, columns whose names clash
    are prefixed with the profile's name."""
    named = profiles if isinstance(profiles, Mapping) else {f"p{i + 1}": p for i, p in enumerate(profiles)}
    seen: dict[str, int] = {}
    for df in named.values():
        for c in df.columns:
            seen[c] = seen.get(c, 0) + 1
    renamed = [
        df.select(key, *[F.col(c).alias(f"{name}_{c}" if seen[c] > 1 else c) for c in df.columns if c != key])
        for name, df in named.items()
    ]
    return reduce(lambda a, b: a.join(b, key), renamed)


# --- filters -------------------------------------------------------------------------


def valid_geom(df: DataFrame, geom: str = "geom") -> DataFrame:
    """Rows whose geometry exists, has vertices and a box with area."""
    return df.filter(F.col(geom).isNotNull() & ~G.is_empty(geom) & (G.envelope_area(geom) > 0))


def significant_centres(df: DataFrame, name: str = "name", population: str = "population", min_population: int = 1000) -> DataFrame:
    """Named centres above a population, without the leftovers of each state."""
    # Fixed value: how the leftover areas are named.
    leftover = F.col(name).startswith("Remainder of State/Territory")
    return df.filter(~leftover & (F.col(population) > min_population))


def in_viewport(df: DataFrame, left: float, bottom: float, right: float, top: float) -> DataFrame:
    """Features whose box meets the viewport; plain range predicates, so they
    reach the Parquet row-group statistics."""
    return df.filter(
        (F.col("xmax") >= left) & (F.col("xmin") <= right) & (F.col("ymax") >= bottom) & (F.col("ymin") <= top)
    )


# --- rates and totals ------------------------------------------------------------------


def density(df: DataFrame, stat: str, area: str, name: str = "density", on_zero: str = "error") -> DataFrame:
    """Statistic per unit area, rounded half to even like a float-to-integer cast."""
    return df.withColumn(name, round_half_even_int(ratio(stat, area, on_zero)))


def percent_of(df: DataFrame, stat: str, population: str, name: str = "percent") -> DataFrame:
    """Statistic as a percent of population; NULL without population, never capped."""
    return df.withColumn(name, F.lit(100.0) * ratio(stat, population, "null"))


def weighted_total(df: DataFrame, value: str, weight: str, k: float = 52.25) -> DataFrame:
    """``sum(value*weight*k)`` and ``sum(weight)``; a NULL value leaves the first
    sum but its weight still counts."""
    return df.agg(
        F.sum(F.col(value) * F.col(weight) * k).alias("total"), F.sum(weight).alias("total_weight")
    )


def share_of_total(df: DataFrame, amount: Column | str, total: float | None = None, name: str = "share") -> DataFrame:
    """Percent of a given total, or of the column's own sum (a scalar subquery)."""
    c = _col(amount)
    whole = F.lit(float(total)) if total is not None else df.agg(F.sum(c)).scalar()
    return df.withColumn(name, c / whole * 100.0)


def percent_population(df: DataFrame, population: str, total: float, name: str = "percent_population") -> DataFrame:
    """Percent of a national total as ``decimal(4,1)``, ties away from zero."""
    percent = F.col(population).cast("double") / F.lit(float(total)) * 100.0
    return df.withColumn(name, percent.cast("decimal(4,1)"))


# --- histograms --------------------------------------------------------------------------


def with_bucket(df: DataFrame, value: Column | str, lo, hi, n: int, name: str = "bucket") -> DataFrame:
    """Equal-width bucket 1..n; below ``lo`` is 0, at or above ``hi`` is n+1."""
    v = _col(value).cast("double")
    low = lo if isinstance(lo, Column) else F.lit(float(lo))
    high = hi if isinstance(hi, Column) else F.lit(float(hi))
    return df.withColumn(name, F.width_bucket(v, low, high, F.lit(n)))


def histogram(df: DataFrame, value: Column | str, lo: float | None = None, hi: float | None = None, n: int = 10, with_range: bool = False) -> DataFrame:
    """Rows per bucket, ``bucket, freq``; bounds default to the data's min and max.

    ``with_range`` adds the half-open integer range the bucket's values span.
    """
    v = _col(value)
    if lo is None or hi is None:
        # one subquery for both ends, so the table is read once for them
        bounds = df.agg(F.struct(F.min(v).cast("double").alias("lo"), F.max(v).cast("double").alias("hi"))).scalar()
        low = bounds["lo"] if lo is None else F.lit(float(lo))
        high = bounds["hi"] if hi is None else F.lit(float(hi))
    else:
        low, high = lo, hi
    bucketed = with_bucket(df, v, low, high, n)
    aggregates = [F.count(F.lit(1)).alias("freq")]
    if with_range:
        aggregates += [F.min(v).alias("_lo"), F.max(v).alias("_hi")]
    counted = bucketed.groupBy("bucket").agg(*aggregates)
    if with_range:
        lower, upper = round_half_even_int("_lo"), round_half_even_int("_hi") + 1
        counted = counted.withColumn("range", F.struct(lower.alias("lo"), upper.alias("hi"))).drop("_lo", "_hi")
    return counted.orderBy(F.col("bucket").asc_nulls_last())


# A bar's mark and the length of the longest one.
BAR_MARK, BAR_WIDTH = "■", 30


def histogram_bar(df: DataFrame, freq: str = "freq", width: int = BAR_WIDTH, name: str = "bar") -> DataFrame:
    """A text bar per bucket, scaled to the largest."""
    largest = df.agg(F.max(freq).cast("double")).scalar()
    length = round_half_even_int(F.col(freq).cast("double") / largest * width)
    return df.withColumn(name, F.repeat(F.lit(BAR_MARK), length))


# --- map ranges and flags ------------------------------------------------------------------


def map_value(maptype: Column | str, value: Column | str, percent: Column | str) -> Column:
    """The number a map is coloured by."""
    kind = F.lit(maptype) if isinstance(maptype, str) else maptype
    return F.when(kind == "values", _col(value)).otherwise(_col(percent))


def map_range(df: DataFrame, maptype: str, min_population: int, value: str = "value", percent: str = "percent", population: str = "population") -> DataFrame:
    """Value range ``map_min, map_max`` over significant regions; the top of a
    percent range is held to 100."""
    shown = map_value(maptype, value, percent)
    agg = df.filter(F.col(population) > min_population).agg(
        F.min(shown).alias("map_min"), F.max(shown).alias("map_max")
    )
    if maptype == "percent":
        agg = agg.withColumn("map_max", F.least("map_max", F.lit(100.0)))
    return agg


def pop_class(population: Column | str, min_population: Column | int) -> Column:
    """``none``, ``low`` or ``normal``."""
    p = _col(population)
    return F.when(p == 0, "none").when(p <= min_population, "low").otherwise("normal")


# --- geometry summaries ------------------------------------------------------------------------


def geometry_summary(df: DataFrame, id_col: str, geom: str = "geom") -> DataFrame:
    """Counts and vertex statistics of the rows that have a geometry."""
    points = df.filter(F.col(geom).isNotNull()).select(F.col(id_col).alias("_id"), G.npoints(geom).alias("_n"))
    return points.agg(
        F.count(F.lit(1)).alias("num_geoms"),
        F.countDistinct("_id").alias("num_ids"),
        F.sum("_n").alias("points"),
        F.round(F.avg("_n")).cast("int").alias("avg_points"),
        F.min("_n").alias("min_points"),
        F.max("_n").alias("max_points"),
    )


def thinning_report(before: DataFrame, after: DataFrame, id_col: str, geom: str = "geom") -> DataFrame:
    """Vertex totals before and after thinning, and the percent that is left."""
    a = geometry_summary(before, id_col, geom).select("num_geoms", F.col("points").alias("points_before"))
    # one subquery for both figures, so the layer is thinned once for them
    b = geometry_summary(after, id_col, geom).select(F.struct("num_geoms", "points")).scalar()
    return a.select(
        "num_geoms",
        b["num_geoms"].alias("num_geoms_after"),
        "points_before",
        b["points"].alias("points_after"),
    ).withColumn("percent_left", F.try_divide(F.col("points_after") * 100.0, F.col("points_before")))


def collect_parts(df: DataFrame, id_col: str, order: str, geom: str = "geom") -> DataFrame:
    """All parts of an id as one geometry, in ``order``.

    One row per id is what the operator means, so the parts of an id must fit one
    row; leave them as the rows they are where they would not.
    """
    gathered = df.groupBy(id_col).agg(
        F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col(geom).alias("g")))).alias("_parts")
    )
    return gathered.select(id_col, F.flatten(F.col("_parts.g")).alias(geom))


# --- ordering and set operations ------------------------------------------------------------------


def order_by(df: DataFrame, *columns: str) -> DataFrame:
    """Ascending with NULLs last, as SQL databases sort."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in columns])


def random_rows(df: DataFrame, k: int, seed: int = 0, key: str | None = None) -> DataFrame:
    """``k`` random rows. With a ``key`` the draw hashes it, so the same rows come
    back however the table is partitioned. Planned as a top-k: no full sort."""
    draw = F.xxhash64(F.col(key), F.lit(seed)) if key else F.rand(seed)
    return df.orderBy(draw).limit(k)


def union_tagged(tables: Mapping[str, DataFrame], tag: str = "tag") -> DataFrame:
    """UNION ALL of the tables, each row tagged with its table's name."""
    tagged = [df.select(F.lit(name).alias(tag), *df.columns) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, tagged)


def attributes(df: DataFrame, exclude: Sequence[str] = ("geom",)) -> DataFrame:
    """Every column but the geometry."""
    return df.select(*[c for c in df.columns if c not in exclude])


def row_count(df: DataFrame, name: str = "rows") -> DataFrame:
    """Row count with its display text."""
    return df.agg(F.count(F.lit(1)).alias(name)).withColumn(
        f"{name}_text", F.format_number(F.col(name), 0)
    )


def with_xy(df: DataFrame, point: str = "geom") -> DataFrame:
    """``latitude decimal(7,5)`` and ``longitude decimal(8,5)`` of a point."""
    return df.withColumns(
        {
            "latitude": G.y(point).cast("decimal(7,5)"),
            "longitude": G.x(point).cast("decimal(8,5)"),
        }
    )


def save_as(df: DataFrame, name: str) -> DataFrame:
    """Create or replace a saved table from a query."""
    df.write.mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def boundary_for_zoom(zooms: DataFrame, zoom: Column | int, override: str | None = None, min_zoom: int = 4, max_zoom: int = 16) -> DataFrame:
    """The ``zoom, name, min`` row for a zoom level held to the valid range."""
    if not isinstance(zoom, Column):
        zoom = F.lit(builtins.min(builtins.max(zoom, min_zoom), max_zoom))
    level = zooms.filter(F.col("zoom") == zoom)
    return level.withColumn("name", F.lit(override)) if override else level


def clamp_zoom(zoom: Column | str, min_zoom: int = 4, max_zoom: int = 16) -> Column:
    return F.least(F.greatest(_col(zoom), F.lit(min_zoom)), F.lit(max_zoom))


def with_boundary_level(df: DataFrame, zooms: DataFrame, zoom: str = "zoom", override: str | None = None, override_min: float | None = None) -> DataFrame:
    """Boundary level per row's zoom. There is one row per zoom level (at most 13
    after clamping), so the zoom table is broadcast. An override names one boundary
    and, with it, the one minimum population (NULL if not given) for every zoom."""
    levels = zooms.select(F.col("zoom").alias("_z"), F.col("name").alias("boundary"), F.col("min").alias("min_population"))
    joined = df.withColumn("_z", clamp_zoom(zoom)).join(F.broadcast(levels), "_z", "left").drop("_z")
    if not override:
        return joined
    return joined.withColumns({"boundary": F.lit(override), "min_population": F.lit(override_min).cast(joined.schema["min_population"].dataType)})
