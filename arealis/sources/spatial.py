"""Spatial Parquet, line GeoJSON, WKT text and partitioned reads and writes."""

from __future__ import annotations

import math
import time
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arealis.functions import geometry as G
from arealis.functions.arrangement import generated, make_valid
from arealis.functions.arrow_geometry import subdivided
from arealis.operators.keys import key_bounds, sorted_ranges, with_row_id
from arealis.session import spread
from arealis.sources.files import discover

BBOX = ("xmin", "ymin", "xmax", "ymax")
# Rows per partition of a keyed read, and the patterns of tables
# that are not exported.
ROWS_PER_PARTITION = 100_000
FETCH_SIZE = 1000
EXCLUDED_NAMES = ("qa",)
EXCLUDED_PATTERNS = ("%_2011_%", "%_analysis%", "%_display%")
DATUM_SUFFIX = "_gda94"


# --- catalog and schema inspection --------------------------------------------------------


def geometry_columns(df: DataFrame) -> list[dict]:
    """``column, kind, srid`` of every geometry column of a table."""
    kinds = {
        G.GEOM_TYPE: "MULTIPOLYGON",
        f"array<{G.RING_TYPE}>": "POLYGON",
        G.RING_TYPE: "LINESTRING",
        G.POINT_TYPE: "POINT",
    }
    return [
        {"column": f.name, "kind": kinds[f.dataType.simpleString()], "srid": f.metadata.get("srid")}
        for f in df.schema.fields
        if f.dataType.simpleString() in kinds
    ]


def is_spatial(df: DataFrame) -> bool:
    return bool(geometry_columns(df))


def exportable(name: Column | str) -> Column:
    """Whether a table is one of those to export (``_`` stands for any character)."""
    c = F.col(name) if isinstance(name, str) else name
    keep = ~c.isin(list(EXCLUDED_NAMES))
    for pattern in EXCLUDED_PATTERNS:
        keep = keep & ~c.like(pattern)
    return keep


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Base tables of a database that are to be exported, by name."""
    rows = [(t.name, t.tableType) for t in spark.catalog.listTables(database)]
    tables = spark.createDataFrame(rows, "table_name string, table_type string")
    return (
        tables.filter(F.col("table_type").isin("MANAGED", "EXTERNAL") & exportable("table_name"))
        .select("table_name")
        .orderBy("table_name")
    )


# --- partitioned reads ----------------------------------------------------------------------


def partition_options(lo: int, hi: int, key: str, rows_per_part: int = ROWS_PER_PARTITION) -> dict[str, str]:
    """JDBC options for a parallel read over a key range."""
    parts = max(1, math.ceil((hi - lo) / rows_per_part))
    return {
        "partitionColumn": key,
        "lowerBound": str(lo),
        "upperBound": str(hi),
        "numPartitions": str(parts),
        "fetchsize": str(FETCH_SIZE),
    }


def read_jdbc(spark: SparkSession, query: str, key: str, connection: Mapping[str, str], rows_per_part: int = ROWS_PER_PARTITION) -> DataFrame:
    """Parallel read of a query through a user-supplied JDBC driver."""
    reader = spark.read.format("jdbc").options(**connection)
    bounds = reader.option("query", f"SELECT min({key}) AS lo, max({key}) AS hi FROM ({query}) q").load().first()
    if bounds["lo"] is None:
        return reader.option("dbtable", f"({query}) q").load()
    options = partition_options(int(bounds["lo"]), int(bounds["hi"]), key, rows_per_part)
    return reader.option("dbtable", f"({query}) q").options(**options).load()


def read_partitioned(df: DataFrame, key: str, rows_per_part: int = ROWS_PER_PARTITION) -> DataFrame:
    """A table cut by key range into partitions of about ``rows_per_part`` keys."""
    lo, hi = key_bounds(df, key).first()
    if lo is None:
        return df
    return df.repartitionByRange(max(1, math.ceil((hi - lo) / rows_per_part)), key)


# --- Parquet ----------------------------------------------------------------------------------


def geohash_sort(df: DataFrame, precision: int = 5, geom: str = "geom") -> DataFrame:
    """Range-partition and sort by geohash, so that near features share files."""
    hashed = df.withColumn("_gh", G.geohash(geom, precision))
    return sorted_ranges(hashed, [F.col("_gh")]).drop("_gh")


def export_table(df: DataFrame, name: str, path: str, spatial: bool | None = None, compression: str = "snappy", block_bytes: int | None = None, key: str | None = None, max_vertices: int = 256, with_wkt: bool = False) -> str:
    """Write a table as Parquet and return where.

    A spatial table is taken to longitude/latitude, given bounding-box columns and
    sorted by geohash; polygons are dumped to parts, repaired and subdivided first.
    Rows get a ``gid`` when there is none and a ``key`` to number them by is given.
    """
    spatial = is_spatial(df) if spatial is None else spatial
    if key and "gid" not in df.columns:
        df = with_row_id(df, key)
    target = f"{path.rstrip('/')}/{name.replace(DATUM_SUFFIX, '') if spatial else name}"
    if spatial:
        df = spatial_layout(df, max_vertices, with_wkt, geometry_columns(df)[0]["column"])
    writer = df.write.mode("overwrite").option("compression", compression)
    if block_bytes:
        writer = writer.option("parquet.block.size", block_bytes)
    writer.parquet(target)
    return target


def spatial_layout(df: DataFrame, max_vertices: int = 256, with_wkt: bool = False, geom: str = "geom") -> DataFrame:
    """The rows a spatial export writes.

    Polygons become one row per piece, so NULL and empty ones go. Points and lines
    stay the rows and the type they are; a NULL one has a NULL box and sorts first.
    """
    srid = G.get_srid(df, geom)
    kind = next(c["kind"] for c in geometry_columns(df) if c["column"] == geom)
    if kind in ("POINT", "LINESTRING"):
        return _unpolygonal_layout(df, geom, kind, srid, with_wkt)
    repaired = generated(generated(spread(df), geom, G.clean_rings(nested(geom, kind))), geom, make_valid(geom))
    if srid is not None and srid != 4326:
        repaired = G.to_wgs84(repaired, geom, srid)
    parts = G.dump_parts(repaired, geom).drop("part_no")
    others = [c for c in parts.columns if c != geom]
    pieces = parts.select(*others, F.explode(subdivided(geom, max_vertices)).alias(geom))
    # the sort below samples its input before it runs; kept in a shuffle, the
    # geometry work is not done a second time for that
    boxed = G.with_bbox(pieces.hint("rebalance"), geom)
    if with_wkt:
        boxed = boxed.withColumn("wkt_geom", G.to_wkt(geom))
    return G.set_srid(geohash_sort(boxed, 5, geom), 4326, geom)


# array levels between a geometry of a kind and a multipolygon's
_LEVELS_UP = {"MULTIPOLYGON": 0, "POLYGON": 1, "LINESTRING": 2, "POINT": 3}


def nested(geom: str, kind: str) -> Column:
    """A geometry of any kind in the form of a multipolygon."""
    lifted = F.col(geom)
    for _ in range(_LEVELS_UP[kind]):
        lifted = F.array(lifted)
    return F.when(F.col(geom).isNotNull(), lifted)


def _unpolygonal_layout(df: DataFrame, geom: str, kind: str, srid: int | None, with_wkt: bool) -> DataFrame:
    """Points or lines with their boxes, sorted by geohash. The nested form lends
    them the polygons' expressions and is given up again."""
    lifted = df.withColumn(geom, nested(geom, kind))
    if srid is not None and srid != 4326:
        lifted = G.to_wgs84(lifted, geom, srid)
    boxed = G.with_bbox(lifted, geom)
    hashed = boxed.withColumn("_gh", G.geohash_xy((F.col("xmin") + F.col("xmax")) / 2, (F.col("ymin") + F.col("ymax")) / 2))
    back = F.col(geom)
    for _ in range(_LEVELS_UP[kind]):
        back = F.get(back, F.lit(0))
    flat = hashed.withColumn(geom, back)
    if with_wkt:
        flat = flat.withColumn("wkt_geom", G.point_wkt(geom) if kind == "POINT" else G.line_wkt(geom))
    return G.set_srid(sorted_ranges(flat, [F.col("_gh")]).drop("_gh"), 4326, geom)


def read_spatial(spark: SparkSession, path: str, srid: int | None = None) -> DataFrame:
    """A spatial Parquet table; its SRID comes from the column metadata."""
    df = spark.read.parquet(path)
    return G.set_srid(df, srid) if srid is not None else df


def export_all(tables: Mapping[str, DataFrame], path: str, keys: Mapping[str, str] | None = None) -> DataFrame:
    """Export every table: ``table_name, path, spatial, rows, seconds, status``.

    Only the loop over names is on the driver; empty tables are reported, and one
    failure does not stop the rest.
    """
    spark = next(iter(tables.values())).sparkSession
    report = []
    for name, df in tables.items():
        begun = time.monotonic()
        spatial = is_spatial(df)
        try:
            if df.isEmpty():
                report.append((name, None, spatial, 0, time.monotonic() - begun, "EMPTY"))
                continue
            target = export_table(df, name, path, spatial, key=(keys or {}).get(name))
            rows = spark.read.parquet(target).count()
            report.append((name, target, spatial, rows, time.monotonic() - begun, "SUCCESS"))
        except Exception as failure:  # noqa: BLE001 - the outcome goes into the report
            message = f"FAILED: {str(failure).splitlines()[0][:300]}"
            report.append((name, None, spatial, None, time.monotonic() - begun, message))
    return spark.createDataFrame(
        report, "table_name string, path string, spatial boolean, rows long, seconds double, status string"
    )


# --- text ---------------------------------------------------------------------------------------


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def geojson_feature(properties: Sequence[str], geom: str = "geom", feature_id: str | None = None) -> Column:
    """A GeoJSON feature as text: a MultiPolygon of ``[x, y]`` positions."""
    positions = F.transform(
        F.col(geom), lambda part: F.transform(part, lambda ring: F.transform(ring, lambda v: F.array(v["x"], v["y"])))
    )
    fields = [F.lit("Feature").alias("type")]
    if feature_id:
        fields.append(F.col(feature_id).alias("id"))
    fields.append(F.struct(*properties).alias("properties"))
    fields.append(
        F.when(F.col(geom).isNotNull(), F.struct(F.lit("MultiPolygon").alias("type"), positions.alias("coordinates"))).alias("geometry")
    )
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def to_geojson_feature(df: DataFrame, geom: str = "geom", feature_id: str | None = None) -> DataFrame:
    properties = [c for c in df.columns if c != geom]
    return df.select(geojson_feature(properties, geom, feature_id).alias("feature"))


def write_geojsonl(df: DataFrame, path: str, geom: str = "geom", feature_id: str | None = None) -> None:
    """One feature per line, so files split and concatenate."""
    to_geojson_feature(df, geom, feature_id).write.mode("overwrite").text(path)


def read_geojsonl(spark: SparkSession, path: str, properties: str, broken: str | None = None) -> DataFrame:
    """Features, one per line; ``properties`` is a DDL schema. A part of ``geom`` is
    ``[[ [x, y], ... ], ...]``; a point is a part of one vertex and a line a part of
    one open ring, so every kind comes in the same form. Blank lines are skipped. A
    malformed line, one that is no feature and an unknown kind of geometry fail the
    read; with ``broken`` they are kept, in a column of this name."""
    lines = spark.read.text(path).filter(F.trim("value") != "").select(
        "value", F.from_json("value", f"type string, properties struct<{_as_struct(properties)}>, geometry struct<type:string,coordinates:string>").alias("f")
    )
    text, kind = F.col("f.geometry.coordinates"), F.col("f.geometry.type")

    def at(form: str, name: str) -> Column:
        return F.when(kind == name, F.from_json(text, form))

    point, line, rings = "array<double>", "array<array<double>>", "array<array<array<double>>>"
    parts = F.coalesce(
        at(f"array<{rings}>", "MultiPolygon"),
        F.when(kind == "Polygon", F.array(at(rings, "Polygon"))),
        F.when(kind == "LineString", F.array(F.array(at(line, "LineString")))),
        F.when(kind == "Point", F.array(F.array(F.array(at(point, "Point"))))),
        F.transform(at(rings, "MultiLineString"), lambda x: F.array(x)),
        F.transform(at(line, "MultiPoint"), lambda x: F.array(F.array(x))),
    )
    geom = F.transform(
        parts, lambda part: F.transform(part, lambda ring: F.transform(ring, lambda p: G.make_point(F.get(p, F.lit(0)), F.get(p, F.lit(1)))))
    )
    lines = lines.withColumn("geom", geom)
    fine = F.coalesce(F.col("f.type") == "Feature", F.lit(False)) & (F.col("f.geometry").isNull() | F.col("geom").isNotNull())
    if broken:
        return lines.select("f.properties.*", "geom", F.when(~fine, F.col("value")).alias(broken))
    checked = F.when(fine, F.col("geom")).otherwise(F.raise_error(F.concat(F.lit("malformed feature: "), F.col("value"))))
    return lines.select("f.properties.*", checked.alias("geom"))


def _as_struct(ddl: str) -> str:
    return ",".join(":".join(field.strip().split(None, 1)) for field in ddl.split(","))


def swap_xy(geom: Column | str) -> Column:
    """Latitude-first positions to longitude-first and back."""
    return G.map_vertices(geom, lambda v: G.make_point(v["y"], v["x"]))


def read_wkt_csv(spark: SparkSession, path: str, schema: str, wkt: str = "wkt_geom") -> DataFrame:
    """A CSV with a WKT column, parsed into ``geom``."""
    df = spark.read.schema(schema).option("header", True).csv(path)
    return df.withColumn("geom", G.from_wkt(wkt)).drop(wkt)


def load_layers(spark: SparkSession, directory: str, pattern: str, properties: str | None = None) -> dict[str, DataFrame]:
    """Every layer file whose name contains ``pattern``, by file stem.

    Parquet, line GeoJSON and WKT CSV are told apart by suffix.
    """
    found = discover(spark, directory, "", "").filter(F.lower("name").contains(pattern.lower()))
    layers = {}
    for path, name in found.select("path", "name").orderBy("path").collect():
        stem, _, suffix = name.partition(".")
        kind = suffix.lower()
        if kind.endswith("parquet"):
            layers[stem] = spark.read.parquet(path)
        elif kind in ("geojsonl", "geojson", "json"):
            layers[stem] = read_geojsonl(spark, path, properties)
        elif kind == "csv":
            layers[stem] = read_wkt_csv(spark, path, f"{properties}, wkt_geom string")
    return layers
