"""The rows behind one map request."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealis.functions.scalars import DEFAULT_RAMP, LOW_POP_COLOUR, colour_ramp, tenths
from arealis.operators.stats import (
    attach_stats,
    in_viewport,
    map_range,
    map_value,
    percent_of,
    pop_class,
)


def map_extract(
    bdy: DataFrame,
    stats: DataFrame,
    stat: str,
    population: str,
    maptype: str,
    min_population: int,
    bdy_key: str,
    name: str,
    viewport: tuple[float, float, float, float] | None = None,
    colours: Sequence[str] = DEFAULT_RAMP,
) -> DataFrame:
    """Features of a viewport with ``population, value, percent, map_value,
    pop_class, colour``.

    The colour domain is the range of the significant regions in view, to one
    decimal; when they all share one value the ramp's first colour is used.
    """
    shown = in_viewport(bdy, *viewport) if viewport else bdy
    numbers = stats.select("region_id", F.col(stat).alias("value"), F.col(population).alias("population"))
    features = percent_of(attach_stats(shown, numbers, bdy_key), "value", "population")
    bounds = map_range(features, maptype, min_population)
    # one subquery for both ends
    domain = bounds.select(F.struct(tenths("map_min").alias("low"), tenths("map_max").alias("high"))).scalar()
    # columns of their own: the ramp refers to each of them many times
    scaled = features.withColumn("map_value", map_value(maptype, "value", "percent")).withColumns(
        {"_t": tenths("map_value"), "_low": domain["low"], "_high": domain["high"]}
    )
    colour = F.when(F.col("population") <= min_population, F.lit(LOW_POP_COLOUR)).otherwise(
        colour_ramp("_t", "_low", "_high", colours, on_flat="start")
    )
    geometry = [c for c in ("geom",) if c in bdy.columns]
    return (
        scaled.withColumn("pop_class", pop_class("population", min_population))
        .withColumn("colour", colour)
        .select(F.col(bdy_key).alias("id"), F.col(name).alias("name"), "population", "value", "percent", "map_value", "pop_class", "colour", *geometry)
    )
