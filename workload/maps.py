"""Map products, exports and layers."""

from __future__ import annotations

from pyspark.sql import functions as F

from arealis.functions import geometry as G
from arealis.functions import scalars as X
from arealis.operators import stats as A
from arealis.plans import map_extract as E
from arealis.plans import thinning, tiles
from arealis.session import scratch_path
from arealis.sources import spatial as S
from workload.ingest import layout_of, write_files
from workload.derived import (
    POINTS_SQL,
    PROFILE_SQL,
    RAGGED_SQL,
    REGIONS_SQL,
    order_points,
    ragged,
    region_profile,
    regions,
    table,
    with_sql,
)
from workload.spatial import geohash_sql
from workload.statistics import ZOOM_NAMES, zoom_levels

VIEW = (115.0, -38.0, 150.0, -14.0)


def extract(spark, sf, maptype):
    boxed = G.with_bbox(regions(spark, sf))
    made = E.map_extract(boxed, region_profile(spark, sf), "g4", "g1", maptype, 7000, "code", "name", VIEW)
    return made.drop("geom")


def extract_sql(maptype: str) -> str:
    number = "value" if maptype == "values" else "percent"
    top = "max(shown)" if maptype == "values" else "least(max(shown), 100.0::DOUBLE)"
    channels = []
    for at in (1, 3, 5):
        a, b = (int(c[at : at + 2], 16) for c in X.DEFAULT_RAMP)
        channels.append(f"printf('%02x', CAST(floor({float(b - a)}::DOUBLE / (hi - lo) * (least(greatest(t, lo), hi) - lo) + {a} + 0.5) AS INT))")
    return with_sql(
        REGIONS_SQL,
        PROFILE_SQL,
        f"""seen AS (SELECT r.code AS id, r.name, g1 AS population, g4 AS value, CASE WHEN g1 <> 0 THEN 100.0::DOUBLE * (g4 / g1) END AS percent
          FROM regions r JOIN boxes b USING (k) LEFT JOIN profile ON r.code = region_id
          WHERE xmax >= {VIEW[0]} AND xmin <= {VIEW[2]} AND ymax >= {VIEW[1]} AND ymin <= {VIEW[3]})""",
        f"shown AS (SELECT *, {number} AS shown FROM seen)",
        f"""span AS (SELECT CAST(floor(min(shown) * 10 + 0.5) AS DOUBLE) AS lo, CAST(floor({top} * 10 + 0.5) AS DOUBLE) AS hi FROM shown WHERE population > 7000)""",
        "scaled AS (SELECT *, CAST(floor(shown * 10 + 0.5) AS DOUBLE) AS t FROM shown, span)",
        body=f"""SELECT id, name, population, value, percent, shown AS map_value,
          CASE WHEN population = 0 THEN 'none' WHEN population <= 7000 THEN 'low' ELSE 'normal' END AS pop_class,
          CASE WHEN population <= 7000 THEN '#422' WHEN t IS NOT NULL THEN '#' || {' || '.join(channels)} END AS colour FROM scaled""",
    )


# --- thinning and tiles ---------------------------------------------------------------------------


def web_layer(spark, sf):
    thin = thinning.thin_layer(ragged(spark, sf), 5)
    return thin.select("code", G.npoints("geom").alias("n"))


WEB_TOLERANCE_SQL = "7 * pow(156543.03390625::DOUBLE / 64, 2) / pow(2 * pi() * 6378137 / 360, 2)"


def thinning_ratio(spark, sf):
    before = ragged(spark, sf)
    return A.thinning_report(before, thinning.thin_layer(before, 5), "code")


def tile_rows(spark, sf):
    """Features that reach a tile, and whether every pixel lies in its tile and margin."""
    cut = tiles.tile_features(regions(spark, sf).select("code", "geom"), 6)
    low, high = -tiles.BUFFER, tiles.EXTENT + tiles.BUFFER
    inside = (G.xmin("geom") >= low) & (G.ymin("geom") >= low) & (G.xmax("geom") <= high) & (G.ymax("geom") <= high)
    return cut.groupBy("z").agg(F.countDistinct("code").alias("features"), F.min(inside).alias("inside"))


def tile_counts(spark, sf):
    return tiles.tile_summary(tiles.tile_features(ragged(spark, sf).select("code", "geom"), 7))


# tile of every square or ring outline, which covers every tile its box meets
TILES_SQL = with_sql(
    RAGGED_SQL,
    """box AS (SELECT s_suppkey AS k, w, (s_suppkey * 7919 % 40960) / 1024.0::DOUBLE + 113 AS cx, (s_suppkey * 104729 % 30720) / 1024.0::DOUBLE - 42 AS cy
      FROM supplier JOIN ragged ON s_suppkey = k)""",
    """units AS (SELECT k, (cx - w + 180) / 360 * 128 AS u0, (cx + w + 180) / 360 * 128 AS u1,
      (1 - ln(tan(pi() / 4 + radians(cy + w) / 2)) / pi()) * 64 AS v0, (1 - ln(tan(pi() / 4 + radians(cy - w) / 2)) / pi()) * 64 AS v1 FROM box)""",
    "xs AS (SELECT *, unnest(range(CAST(floor(u0 - 0.0625) AS BIGINT), CAST(floor(u1 + 0.0625) AS BIGINT) + 1)) AS tile_x FROM units)",
    "ys AS (SELECT *, unnest(range(CAST(floor(v0 - 0.0625) AS BIGINT), CAST(floor(v1 + 0.0625) AS BIGINT) + 1)) AS tile_y FROM xs)",
    body="SELECT 7 AS z, CAST(tile_x AS INT) AS tile_x, CAST(tile_y AS INT) AS tile_y, count(*) AS features FROM ys GROUP BY ALL",
)


def tile_features_count(spark, sf):
    return tile_counts(spark, sf).select("z", "tile_x", "tile_y", "features")


# --- exports ----------------------------------------------------------------------------------------


def parquet_export(spark, sf):
    """A plain table: numbered, written with a codec and block size, read back."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    target = S.export_table(orders, "orders_2021", scratch_path(spark, "export"), compression="zstd", block_bytes=1 << 20, key="o_orderkey")
    return spark.read.parquet(target)


def spatial_export(spark, sf):
    """Dumped, repaired, subdivided, boxed, sorted by geohash, written, read back."""
    layer = G.set_srid(ragged(spark, sf).select("code", "geom"), 4283)
    target = S.export_table(layer, "ragged_2021_aust_gda94", scratch_path(spark, "export"), max_vertices=128)
    back = S.read_spatial(spark, target, 4326)
    checked = back.groupBy("code").agg(
        F.round(F.sum(G.area("geom")), 9).alias("area"), (F.max(G.npoints("geom")) <= 128).alias("within"), F.min(F.col("xmin") == G.xmin("geom")).alias("boxed")
    )
    return checked.withColumn("srid", F.lit(G.get_srid(back)))


def point_export(spark, sf):
    """Points under a name of their own: boxed, sorted by geohash, written, read back."""
    layer = order_points(spark, sf).select("point_id", G.make_point("x", "y").alias("place"))
    target = S.export_table(G.set_srid(layer, 4283, "place"), "orders_2021_aust_gda94", scratch_path(spark, "export"))
    back = S.read_spatial(spark, target)
    return back.select(
        "point_id",
        G.x("place").alias("px"),
        G.y("place").alias("py"),
        ((F.col("xmin") == G.x("place")) & (F.col("ymax") == G.y("place"))).alias("boxed"),
        F.lit(S.geometry_columns(back)[0]["kind"]).alias("kind"),
        F.lit(G.get_srid(back, "place")).alias("srid"),
    )


def geohash_layout(spark, sf):
    kept = A.valid_geom(regions(spark, sf).select("code", "geom"))
    return S.geohash_sort(kept).select("code", G.geohash("geom", 5).alias("hash"))


def export_job(spark, sf):
    tables = {
        "orders": table(spark, sf, "orders").select("o_orderkey", "o_totalprice"),
        "parts": table(spark, sf, "part"),
        "regions_gda94": A.valid_geom(regions(spark, sf).select("code", "geom")).transform(lambda d: G.set_srid(d, 4283)),
        "places": order_points(spark, sf).select("point_id", G.make_point("x", "y").alias("place")).transform(lambda d: G.set_srid(d, 4283, "place")),
        "outlines": A.valid_geom(regions(spark, sf)).select("code", F.get(F.get("geom", F.lit(0)), F.lit(0)).alias("outline")).transform(lambda d: G.set_srid(d, 4283, "outline")),
        "nothing": table(spark, sf, "orders").filter(F.col("o_orderkey") < 0),
    }
    return S.export_all(tables, scratch_path(spark, "job")).select("table_name", "spatial", "rows", "status")


EXPORT_JOB_SQL = with_sql(
    REGIONS_SQL,
    body="""SELECT 'orders' AS table_name, false AS spatial, count(*) AS rows, 'SUCCESS' AS status FROM orders
    UNION ALL SELECT 'parts', false, count(*), 'SUCCESS' FROM part
    UNION ALL SELECT 'regions_gda94', true, count(*), 'SUCCESS' FROM (SELECT DISTINCT k, part FROM verts)
    UNION ALL SELECT 'places', true, count(*), 'SUCCESS' FROM orders
    UNION ALL SELECT 'outlines', true, count(*), 'SUCCESS' FROM (SELECT DISTINCT k FROM verts)
    UNION ALL SELECT 'nothing', false, 0, 'EMPTY'""",
)


def csv_export(spark, sf):
    path = scratch_path(spark, "csv")
    S.export_csv(table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal"), path)
    return spark.read.schema("c_custkey long, c_name string, c_acctbal double").option("header", True).csv(path)


def geojson_round_trip(spark, sf):
    path = scratch_path(spark, "geojson")
    S.write_geojsonl(regions(spark, sf).select("code", "state", "geom"), path)
    back = S.read_geojsonl(spark, path, "code string, state string")
    swapped = back.withColumn("geom", S.swap_xy(S.swap_xy("geom")))
    return swapped.select("code", "state", G.npoints("geom").alias("n"), G.area("geom").alias("area"))


def geojson_text(spark, sf):
    return S.to_geojson_feature(regions(spark, sf).select("state", "code", "geom"))


def geojson_text_all(spark, sf):
    return S.to_geojson_feature(regions(spark, sf).select("code", "geom"))


def loaded_layers(spark, sf):
    """Layers written as files of their own names, found by datum and loaded as a set."""
    root = scratch_path(spark, "layer-files")
    kept = A.valid_geom(regions(spark, sf).select("k", "code", "geom"))
    features = S.to_geojson_feature(kept.select("code", "geom")).select(F.lit("regions_gda94.geojsonl").alias("file"), F.col("feature").alias("line"))
    other = features.withColumn("file", F.lit("regions_gda2020.geojsonl"))
    quoted = kept.select(F.lit("flat/Outlines_GDA94.csv").alias("file"), F.concat("code", F.lit(',"'), G.to_wkt("geom"), F.lit('"')).alias("line"))
    rows = features.unionByName(other).unionByName(quoted).withColumn("seq", F.lit(1))
    head = spark.createDataFrame([("flat/Outlines_GDA94.csv", "code,wkt_geom", 0)], "file string, line string, seq int")
    write_files(rows.unionByName(head), root)
    found = None
    for name, layer in sorted(S.load_layers(spark, root, "_gda94", "code string").items()):
        rows = layer.select(F.lit(name).alias("layer"), "code", G.npoints("geom").alias("n"), F.round(G.area("geom"), 9).alias("area"))
        found = rows if found is None else found.unionByName(rows)
    return found


def geohash_files(spark, sf):
    """The sorted layer read back from its files: hashes ascend in and across them."""
    laid = S.geohash_sort(A.valid_geom(regions(spark, sf).select("code", "geom"))).select(G.geohash("geom", 5).alias("hash"))
    return layout_of(laid, "hash", spark).select("rows", "ascending", "apart")


def layer_set(spark, sf):
    """Two layers written as files, found by datum and loaded."""
    root = scratch_path(spark, "layers")
    kept = A.valid_geom(regions(spark, sf).select("code", "geom"))
    wkt = kept.select("code", G.to_wkt("geom").alias("wkt_geom"))
    S.export_csv(wkt, f"{root}/csv")
    G.with_bbox(kept).write.parquet(f"{root}/parquet")
    loaded = S.read_wkt_csv(spark, f"{root}/csv", "code string, wkt_geom string").select("code", G.area("geom").alias("from_wkt"))
    return loaded.join(S.read_spatial(spark, f"{root}/parquet").select("code", G.area("geom").alias("from_parquet")), "code")


def geometry_kinds(spark, sf):
    """Geometry columns of a layer, per state: what a spatial export keys on."""
    layer = G.set_srid(regions(spark, sf), 4283)
    found = S.geometry_columns(layer)[0]
    return layer.groupBy("state").agg(F.count("geom").alias("rows")).select(
        "state", "rows", F.lit(found["column"]).alias("geom_column"), F.lit(found["kind"]).alias("kind"), F.lit(found["srid"]).alias("srid")
    )


def zoomed_extract(spark, sf):
    """Every order's view: boundary level by zoom and its population floor."""
    asked = table(spark, sf, "orders").select("o_orderkey", (F.col("o_orderkey") % 30 - 5).cast("int").alias("zoom"))
    return A.with_boundary_level(asked, zoom_levels(spark), override="sa1", override_min=250).select("o_orderkey", "boundary", "min_population")


_ZOOMS = ", ".join(f"({z + 4}, {10 * (z + 1)})" for z, _ in enumerate(ZOOM_NAMES))
VALID = "shape IS NOT NULL AND shape <> 'empty'"
GEOJSON_TEXTS = (
    """ring_texts AS (SELECT k, part, ring, '[' || string_agg('[' || CAST(x AS VARCHAR) || ',' || CAST(y AS VARCHAR) || ']', ',' ORDER BY seq) || ']' AS t
      FROM verts GROUP BY k, part, ring)""",
    "part_texts AS (SELECT k, part, '[' || string_agg(t, ',' ORDER BY ring) || ']' AS t FROM ring_texts GROUP BY k, part)",
    "texts AS (SELECT k, string_agg(t, ',' ORDER BY part) AS t FROM part_texts GROUP BY k)",
)
QUERIES = {
    "c08_map_extract_values": (lambda spark, sf: extract(spark, sf, "values"), extract_sql("values")),
    "c08_map_extract_percent": (lambda spark, sf: extract(spark, sf, "percent"), extract_sql("percent")),
    "p11_boundary_override": (
        zoomed_extract,
        f"""WITH zooms(z, m) AS (VALUES {_ZOOMS}) SELECT o_orderkey, 'sa1' AS boundary, 250 AS min_population FROM orders
          JOIN zooms ON z = least(greatest(CAST(o_orderkey % 30 - 5 AS INT), 4), 16)""",
    ),
    "c05_web_layer": (
        web_layer,
        with_sql(RAGGED_SQL, body=f"SELECT code, CAST(CASE WHEN w * step / 256 < {WEB_TOLERANCE_SQL} THEN 5 ELSE 4 * steps + 1 END AS INT) AS n FROM raggeds"),
    ),
    "a12_thinning_report": (
        thinning_ratio,
        with_sql(
            RAGGED_SQL,
            f"n AS (SELECT 4 * steps + 1 AS a, CASE WHEN w * step / 256 < {WEB_TOLERANCE_SQL} THEN 5 ELSE 4 * steps + 1 END AS b FROM raggeds)",
            body="""SELECT count(*) AS num_geoms, count(*) AS num_geoms_after, CAST(sum(a) AS BIGINT) AS points_before, CAST(sum(b) AS BIGINT) AS points_after,
              CAST(sum(b) AS BIGINT) * 100.0::DOUBLE / CAST(sum(a) AS BIGINT) AS percent_left FROM n""",
        ),
    ),
    "c06_tile_features": (tile_features_count, TILES_SQL),
    "c06_tile_bounds": (tile_rows, with_sql(REGIONS_SQL, body=f"SELECT 6 AS z, count(*) AS features, true AS inside FROM regions WHERE {VALID}")),
    "s19_parquet_sink": (parquet_export, "SELECT row_number() OVER (ORDER BY o_orderkey) AS gid, o_orderkey, o_totalprice FROM orders"),
    "c10_spatial_export": (spatial_export, with_sql(RAGGED_SQL, body="SELECT code, round(area, 9) AS area, true AS within, true AS boxed, 4326 AS srid FROM raggeds")),
    "c10_point_export": (
        point_export,
        with_sql(POINTS_SQL, body="SELECT point_id, x AS px, y AS py, true AS boxed, 'POINT' AS kind, 4326 AS srid FROM points"),
    ),
    "o04_geohash_sort": (
        geohash_layout,
        with_sql(REGIONS_SQL, body=f"SELECT code, {geohash_sql('((xmin + xmax) / 2)', '((ymin + ymax) / 2)')} AS hash FROM boxes"),
    ),
    "s18_geometry_columns": (
        geometry_kinds,
        with_sql(REGIONS_SQL, body="SELECT state, count(shape) AS rows, 'geom' AS geom_column, 'MULTIPOLYGON' AS kind, 4283 AS srid FROM regions GROUP BY state"),
    ),
    "s20_export_all": (export_job, EXPORT_JOB_SQL),
    "s21_spatial_source": (
        lambda spark, sf: layer_set(spark, sf).select("code", "from_parquet"),
        with_sql(REGIONS_SQL, body="SELECT code, area AS from_parquet FROM areas JOIN regions USING (k)"),
    ),
    "s22_csv_sink": (csv_export, "SELECT c_custkey, c_name, c_acctbal FROM customer"),
    "s23_geojson": (
        geojson_round_trip,
        with_sql(REGIONS_SQL, body="""SELECT r.code, state, CAST(CASE WHEN shape = 'empty' THEN 0 ELSE n END AS INT) AS n, CASE WHEN shape = 'empty' THEN 0 ELSE area END AS area
          FROM regions r LEFT JOIN boxes USING (k) LEFT JOIN areas USING (k)"""),
    ),
    "s23_geojson_text": (
        geojson_text,
        with_sql(
            REGIONS_SQL,
            *GEOJSON_TEXTS,
            body="""SELECT '{"type":"Feature","properties":{"state":"' || state || '","code":"' || code || '"},"geometry":' || CASE WHEN shape IS NULL THEN 'null'
              ELSE '{"type":"MultiPolygon","coordinates":[' || coalesce(t, '') || ']}' END || '}' AS feature FROM regions LEFT JOIN texts USING (k)""",
        ),
    ),
    "s23_geojson_text_all": (
        geojson_text_all,
        with_sql(
            REGIONS_SQL,
            *GEOJSON_TEXTS,
            body="""SELECT '{"type":"Feature","properties":{"code":"' || code || '"},"geometry":' || CASE WHEN shape IS NULL THEN 'null'
              ELSE '{"type":"MultiPolygon","coordinates":[' || coalesce(t, '') || ']}' END || '}' AS feature FROM regions LEFT JOIN texts USING (k)""",
        ),
    ),
    "o04_geohash_files": (geohash_files, with_sql(REGIONS_SQL, body=f"SELECT count(*) AS rows, true AS ascending, true AS apart FROM regions WHERE {VALID}")),
    "s24_load_layers": (
        loaded_layers,
        with_sql(REGIONS_SQL, body="SELECT layer, code, n, round(area, 9) AS area FROM boxes JOIN areas USING (k), (VALUES ('Outlines_GDA94'), ('regions_gda94')) AS l(layer)"),
    ),
    "s24_layer_set": (layer_set, with_sql(REGIONS_SQL, body="SELECT code, area AS from_wkt, area AS from_parquet FROM areas JOIN regions USING (k)")),
}
