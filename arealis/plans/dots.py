"""Random points in regions and dot-density maps."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealis.functions import geometry as G
from arealis.functions.arrow_geometry import drawn_points
from arealis.functions.scalars import round_half_even_int
from arealis.operators.stats import valid_geom, with_xy

# Points drawn by one call; a region that needs more becomes several rows first.
DRAW_SIZE = 5000


def random_points(df: DataFrame, n: Column | str, id_col: str, seed: int = 0, geom: str = "geom", draw_size: int = DRAW_SIZE) -> DataFrame:
    """``n`` random points strictly inside each region: every other column,
    ``point_no`` from 1, and the point in ``geom``.

    A region with most of the points is cut into draws of bounded size that are
    spread over the cluster. Each draw is seeded from the region id, its number
    and ``seed``, so the points do not depend on the partitioning.
    """
    count = F.col(n) if isinstance(n, str) else n
    others = [c for c in df.columns if c != geom]
    needed = df.withColumn("_n", count.cast("long")).filter(F.col("_n") > 0)
    draws = needed.withColumn("_draw", F.explode(F.sequence(F.lit(0).cast("long"), (F.col("_n") - 1).cast("long"), F.lit(draw_size).cast("long"))))
    spread = draws.repartition(F.col(id_col), F.col("_draw"))
    size = F.least(F.lit(draw_size), F.col("_n") - F.col("_draw")).cast("int")
    points = spread.select(
        *others,
        "_draw",
        F.posexplode(drawn_points(geom, size, F.xxhash64(F.col(id_col), F.col("_draw"), F.lit(seed)))).alias("_i", "_p"),
    )
    return points.select(
        *others, (F.col("_draw") + F.col("_i") + 1).alias("point_no"), F.col("_p").alias(geom)
    )


def dot_counts(bdy: DataFrame, stats: DataFrame, tags: Mapping[str, str], bdy_key: str, per_dot: int = 10, geom: str = "geom") -> DataFrame:
    """``id, tag, dots, geom`` of every region and category with at least one person.

    Categories are unpivoted before the join, so one pass serves them all.
    """
    labelled = ", ".join(f"'{tag}', `{column}`" for tag, column in tags.items())
    long = stats.select("region_id", F.expr(f"stack({len(tags)}, {labelled}) AS (tag, _amount)"))
    people = long.select("region_id", "tag", round_half_even_int("_amount").alias("_people")).filter(F.col("_people") > 0)
    shapes = valid_geom(bdy, geom).select(F.col(bdy_key).alias("id"), geom)
    return people.join(shapes, people["region_id"] == shapes["id"]).select(
        "id", "tag", F.expr(f"_people div {int(per_dot)}").cast("int").alias("dots"), geom
    )


def dot_density_many(bdy: DataFrame, stats: DataFrame, tags: Mapping[str, str], bdy_key: str, per_dot: int = 10, seed: int = 0, tag: str = "tag") -> DataFrame:
    """Dots of several categories: ``id, tag, latitude, longitude``."""
    counts = dot_counts(bdy, stats, tags, bdy_key, per_dot)
    keyed = counts.withColumn("_key", F.concat_ws("|", "id", "tag"))
    dots = with_xy(random_points(keyed, "dots", "_key", seed))
    return dots.select("id", F.col("tag").alias(tag), "latitude", "longitude")


def dot_density(bdy: DataFrame, stats: DataFrame, stat: str, bdy_key: str, per_dot: int = 10, seed: int = 0) -> DataFrame:
    """One dot per ``per_dot`` people: ``id, latitude, longitude, geom``."""
    counts = dot_counts(bdy, stats, {"all": stat}, bdy_key, per_dot)
    return with_xy(random_points(counts, "dots", "id", seed)).select("id", "latitude", "longitude", "geom")
