"""Joins, aggregates, windows, ordering and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from arealis.functions import scalars as X
from arealis.functions.register import register
from arealis.operators import classify as C
from arealis.operators import dictionary as M
from arealis.operators import keys as K
from arealis.operators import stats as A
from arealis.plans import income as I
from arealis.plans.equation import equation_view, stat_equation
from arealis.sources.datapack import parse_profile
from workload.derived import (
    DICTIONARY_SQL,
    INCOME_SQL,
    PROFILE_SQL,
    REGIONS_SQL,
    dictionary,
    medians,
    populations,
    region_profile,
    regions,
    table,
    with_sql,
)


def bdy(spark, sf):
    return A.attributes(regions(spark, sf))


def income(spark, sf):
    return A.join_profiles({"t02": medians(spark, sf), "t01": populations(spark, sf)})


# --- joins, rates -----------------------------------------------------------------------------


def left_join(spark, sf):
    return A.attach_stats(bdy(spark, sf), region_profile(spark, sf), "code").select("code", "name", "g1", "g2")


def inner_join(spark, sf):
    return A.attach_stats(bdy(spark, sf), region_profile(spark, sf), "code", "inner").select("code", "state", "g3")


def side_by_side(spark, sf):
    other = region_profile(spark, sf).withColumn("g2", -F.col("g2"))
    joined = A.join_profiles({"a": region_profile(spark, sf).select("region_id", "g1", "g2"), "b": other.select("region_id", "g2", "g5")})
    return joined.select("region_id", "g1", "a_g2", "b_g2", "g5")


def min_max_beside_rows(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    low, high = (orders.agg(f("o_totalprice")).scalar() for f in (F.min, F.max))
    return orders.withColumns({"lo": low, "hi": high})


def densities(spark, sf):
    joined = A.attach_stats(bdy(spark, sf), region_profile(spark, sf), "code")
    return A.density(joined, "g1", "area_sqkm").select("code", "name", "g1", "area_sqkm", "density").orderBy("code")


def density_from_text(spark, sf):
    """The whole way: dirty text lines, typed profile, left join, density."""
    profile = region_profile(spark, sf)
    cells = [F.col("region_id"), *[F.concat(F.lit(" "), F.col(f"g{i}").cast("string")) for i in range(1, 7)]]
    lines = profile.select(F.concat(F.concat_ws(",", *cells), F.lit("\u001a")).alias("line"))
    schema = T.StructType([T.StructField("region_id", T.StringType())] + [T.StructField(f"g{i}", T.DoubleType()) for i in range(1, 7)])
    typed = parse_profile(lines, schema)
    broken = F.raise_error(F.concat(F.lit("malformed line: "), F.col("_error")))
    typed = typed.withColumn("region_id", F.when(F.col("_error").isNull(), F.col("region_id")).otherwise(broken)).drop("_error")
    joined = A.attach_stats(bdy(spark, sf), typed, "code")
    return A.density(joined, "g1", "area_sqkm").select("code", "name", "g1", "area_sqkm", "density").orderBy("code")


DENSITY_SQL = with_sql(
    REGIONS_SQL,
    PROFILE_SQL,
    body="""SELECT code, name, g1, w * w * 40000 + 1 AS area_sqkm, CAST(round_even(g1 / (w * w * 40000 + 1), 0) AS INT) AS density
      FROM regions LEFT JOIN profile ON code = region_id""",
)


def zero_safe_ratio(spark, sf):
    profile = region_profile(spark, sf)
    return profile.select("region_id", X.round_half_even_int(X.ratio(F.col("g2") * 1000, "g1", "null")).alias("per_mille"))


def percents(spark, sf):
    return A.percent_of(region_profile(spark, sf), "g2", "g1").select("region_id", "g2", "g1", "percent")


def shares(spark, sf):
    return A.share_of_total(region_profile(spark, sf), "g1").select("region_id", "g1", "share")


def centre_percent(spark, sf):
    return A.percent_population(region_profile(spark, sf), "g1", 1000000.0).select("region_id", F.col("percent_population").cast("double").alias("percent_population"))


def positive_people(spark, sf):
    named = region_profile(spark, sf).select(
        "region_id", F.col("g1").alias("population"), F.when(F.col("region_id").endswith("4"), "Remainder of State/Territory (X)").otherwise("Town").alias("name")
    )
    return A.significant_centres(named)


# --- histograms ---------------------------------------------------------------------------------


def fixed_histogram(spark, sf):
    return A.histogram(table(spark, sf, "orders"), "o_totalprice", 50000, 450000, 19)


def data_histogram(spark, sf):
    found = A.histogram(table(spark, sf, "orders"), "o_totalprice", n=9, with_range=True)
    return found.select("bucket", "freq", F.col("range.lo").alias("lo"), F.col("range.hi").alias("hi"))


def bars(spark, sf):
    return A.histogram_bar(A.histogram(table(spark, sf, "orders"), "o_totalprice", n=9))


def freq_beside_max(spark, sf):
    counted = A.histogram(table(spark, sf, "lineitem"), "l_extendedprice", 0, 100000, 40)
    return counted.withColumn("top", counted.agg(F.max("freq")).scalar())


def _bucket_sql(value: str, lo: str, hi: str, n: int) -> str:
    return f"""CAST(CASE WHEN {value} < {lo} THEN 0 WHEN {value} >= {hi} THEN {n + 1}
      ELSE floor(CAST({n} AS DOUBLE) * ({value} - {lo}) / ({hi} - {lo})) + 1 END AS BIGINT)"""


DATA_HISTOGRAM = f"""
b AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
h AS (SELECT {_bucket_sql("o_totalprice", "lo", "hi", 9)} AS bucket, count(*) AS freq, min(o_totalprice) AS mn, max(o_totalprice) AS mx FROM orders, b GROUP BY 1)
"""


# --- map ranges -----------------------------------------------------------------------------------


def _features(spark, sf):
    joined = A.attach_stats(bdy(spark, sf), region_profile(spark, sf), "code")
    named = joined.select("code", F.col("g4").alias("value"), F.col("g1").alias("population"))
    return A.percent_of(named, "value", "population")


FEATURES_SQL = """
features AS (SELECT code, g4 AS value, g1 AS population, CASE WHEN g1 <> 0 THEN 100.0::DOUBLE * (g4 / g1) END AS percent
  FROM regions LEFT JOIN profile ON code = region_id)
"""


def map_ranges(spark, sf):
    features = _features(spark, sf)
    values = A.map_range(features, "values", 7).select(F.lit("values").alias("maptype"), "map_min", "map_max")
    percents = A.map_range(features, "percent", 7).select(F.lit("percent").alias("maptype"), "map_min", "map_max")
    return values.unionByName(percents)


def map_values(spark, sf):
    kind = F.when(F.col("code") > "R000000050", "percent").otherwise("values")
    return _features(spark, sf).select("code", A.map_value(kind, "value", "percent").alias("shown"))


def population_flags(spark, sf):
    return _features(spark, sf).select("code", "population", A.pop_class("population", 15000).alias("pop_class"))


ZOOM_NAMES = ("ste", "ste", "sa4", "sa4", "sa3", "sa3", "sa2", "sa2", "sa1", "sa1", "sa1", "sa1", "mb")


def zoom_levels(spark):
    rows = [(z + 4, name, 10 * (z + 1)) for z, name in enumerate(ZOOM_NAMES)]
    return spark.createDataFrame(rows, "zoom int, name string, min int")


def boundary_levels(spark, sf):
    asked = table(spark, sf, "orders").select("o_orderkey", (F.col("o_orderkey") % 22).cast("int").alias("zoom"))
    return A.with_boundary_level(asked, zoom_levels(spark))


BOUNDARY_LEVELS_SQL = f"""
WITH zooms(z, boundary, min_population) AS (VALUES {", ".join(f"({z + 4}, '{n}', {10 * (z + 1)})" for z, n in enumerate(ZOOM_NAMES))})
SELECT o_orderkey, CAST(o_orderkey % 22 AS INT) AS zoom, boundary, min_population
FROM orders JOIN zooms ON z = least(greatest(CAST(o_orderkey % 22 AS INT), 4), 16)
"""


# --- classes ------------------------------------------------------------------------------------------


def breaks(spark, sf):
    return C.class_breaks(table(spark, sf, "events"), "value", 7)


def classes(spark, sf):
    return C.kmeans_classes(table(spark, sf, "events"), "value", 6).select("event_id", "value", "class_id")


def ratio_classes(spark, sf):
    """Classes of a statistic per area."""
    joined = A.attach_stats(bdy(spark, sf), region_profile(spark, sf), "code", "inner")
    rated = joined.select("code", (F.col("g1") / F.col("area_sqkm")).alias("value"))
    return C.kmeans_classes(rated, "value", 6).groupBy("class_id").agg(F.count(F.lit(1)).alias("rows"), F.max("value").alias("break"))


def outlier_classes(spark, sf):
    """Classes of prices of which a few are ten million times as large."""
    price = F.when(F.col("o_orderkey") % 997 == 0, F.col("o_totalprice") * 10_000_000).otherwise(F.col("o_totalprice"))
    priced = table(spark, sf, "orders").select(price.alias("v"))
    return C.kmeans_classes(priced, "v", 7).groupBy("class_id").agg(F.count(F.lit(1)).alias("rows"), F.max("v").alias("break"))


def kmeans_sql(source: str, k: int, final: str) -> str:
    """The same k-means as recursive SQL over ``source`` (columns ``v, w``)."""
    nearest = f"list_sum([CASE WHEN abs(v - c[i]) < abs(v - c[i - 1]) THEN 1 ELSE 0 END FOR i IN range(2, {k + 1})])"
    return f"""
WITH RECURSIVE {source},
seeds(n, c) AS (
  SELECT 2, (SELECT [min(v), max(v)] FROM vals)
  UNION ALL
  SELECT n + 1, list_sort(list_append(c, (SELECT v FROM vals ORDER BY list_min([abs(v - q) FOR q IN c]) DESC, v LIMIT 1))) FROM seeds WHERE n < {k}),
start AS (SELECT c FROM seeds WHERE n = {k}),
steps(i, c, held, done) AS (
  SELECT 0, c, []::HUGEINT[], false FROM start
  UNION ALL
  SELECT i + 1, nc, nh, nh = held FROM (
    SELECT i, held, (SELECT list(m ORDER BY a) FROM (SELECT {nearest} AS a, sum(v * w) / sum(w) AS m FROM vals GROUP BY 1)) AS nc,
      (SELECT list(s ORDER BY a) FROM (SELECT {nearest} AS a, CAST(sum(w) AS HUGEINT) AS s FROM vals GROUP BY 1)) AS nh
    FROM steps WHERE NOT done)),
final AS (SELECT c FROM steps WHERE done),
classed AS (SELECT v, w, CAST({nearest} + 1 AS INT) AS class_id FROM vals, final)
{final}
"""


OUTLIER_VALUES = "vals AS (SELECT CASE WHEN o_orderkey % 997 = 0 THEN o_totalprice * 10000000 ELSE o_totalprice END AS v, count(*) AS w FROM orders GROUP BY 1)"
EVENT_VALUES = "vals AS (SELECT value AS v, count(*) AS w FROM events GROUP BY value)"
RATED_VALUES = f"""{REGIONS_SQL.strip()}, {PROFILE_SQL.strip()},
vals AS (SELECT g1 / (w * w * 40000 + 1) AS v, count(*) AS w FROM regions JOIN profile ON code = region_id GROUP BY 1)"""


def class_runs(spark, sf):
    events = table(spark, sf, "events").select("event_id", "value", "event_type")
    return K.run_rank(events, "event_type", ["value", "event_id"]).select("event_id", "rank")


RUNS_SQL = """
SELECT event_id, CAST(sum(incr) OVER (ORDER BY value, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS rank FROM (
  SELECT event_id, value, CASE WHEN lag(event_type) OVER o IS NULL THEN 1 WHEN event_type = lag(event_type) OVER o THEN 0 ELSE 1 END AS incr
  FROM events WINDOW o AS (ORDER BY value, event_id))
"""


# --- reports and equations --------------------------------------------------------------------------------


# Fixed value: the total that the published shares are of.
ALL_INCOME = 505153066305.0


def weighted(spark, sf):
    return A.weighted_total(income(spark, sf), "t205", "t3")


def income_shares(spark, sf):
    return I.income_shares(income(spark, sf), "t205", "t3", ALL_INCOME)


def income_histogram(spark, sf):
    return I.income_histogram(income(spark, sf), "t205", "t3", 0.0, 1e8, 19)


def _profile_tables(spark, sf):
    """Two profile tables and the dictionary that names their columns."""
    profile = region_profile(spark, sf)
    tables = {"g01": profile.select("region_id", "g1", "g2"), "g02": profile.select("region_id", "g4", "g5", "g6")}
    rows = [(c.upper(), t.upper()) for t, df in tables.items() for c in df.columns if c != M.REGION_ID]
    return tables, spark.createDataFrame(rows, "sequential_id string, table_number string")


def equation(spark, sf):
    """An equation over ids of two profile tables, found through a dictionary."""
    tables, stats = _profile_tables(spark, sf)
    return stat_equation(tables.__getitem__, stats, "G2 * (g4 + G5) / (g6 + 1) - 2.5")


def equation_as_view(spark, sf):
    """A named view of the regions with an equation's value, queried by its name."""
    tables, stats = _profile_tables(spark, sf)
    register(spark)
    equation_view("vw_share", regions(spark, sf), "code", tables.__getitem__, stats, "g2 / (G1 + 1) * 100", "share")
    return spark.sql("SELECT code, state, share, st_npoints(geom) AS n, st_area(geom) AS area FROM vw_share")


# --- order and sets ------------------------------------------------------------------------------------------


def nulls_last(spark, sf):
    return A.order_by(medians(spark, sf), "t205", "region_id").select("region_id", "t205")


def sample(spark, sf):
    return A.random_rows(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), 5, 7, "o_orderkey")


def samples(spark, sf):
    """Eight draws: how many rows each has, how many are different, how many are rows of
    the table, and whether the draws differ from one another."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    drawn = None
    for seed in range(8):
        one = A.random_rows(orders, 5, seed, "o_orderkey").withColumn("draw", F.lit(seed))
        drawn = one if drawn is None else drawn.unionByName(one)
    met = drawn.join(orders.withColumn("there", F.lit(1)), ["o_orderkey", "o_orderstatus"], "left")
    each = met.groupBy("draw").agg(F.count("*").alias("n"), F.countDistinct("o_orderkey").alias("different"), F.sum("there").alias("there"), F.sort_array(F.collect_list("o_orderkey")).alias("keys"))
    return each.agg(F.sum("n").alias("n"), F.sum("different").alias("different"), F.sum("there").alias("there"), (F.countDistinct("keys") > 6).alias("apart"))


def tagged_union(spark, sf):
    customers = table(spark, sf, "customer")
    pick = {s.title(): customers.filter(F.col("c_mktsegment") == s).select("c_custkey", "c_acctbal") for s in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")}
    return A.union_tagged(pick, "segment")


def first_order(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return K.first_per_key(orders, "o_custkey", ["o_totalprice", "o_orderkey"])


def saved(spark, sf):
    densities(spark, sf).createOrReplaceTempView("vw_region_density")
    return spark.sql("SELECT code, density FROM vw_region_density WHERE density > 0")


# --- scalars -----------------------------------------------------------------------------------------------------


def tolerance(spark, sf):
    zoom = 4 + F.col("o_orderkey") % 13
    return table(spark, sf, "orders").select("o_orderkey", F.round(X.zoom_tolerance(zoom), 6).alias("tolerance"))


def decimals(spark, sf):
    zoom = 4 + F.col("o_orderkey") % 13
    return table(spark, sf, "orders").select("o_orderkey", X.zoom_decimals(zoom).alias("places"))


def tenth(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", X.tenths("o_totalprice").alias("tenths"))


def texts(spark, sf):
    kind = F.when(F.col("o_orderkey") % 3 == 0, "percent").otherwise("values")
    unit = F.when(F.col("o_orderkey") % 2 == 0, "$/week").otherwise("Persons")
    return table(spark, sf, "orders").select("o_orderkey", X.number_text("o_totalprice", kind, unit).alias("text"))


# the exact decimal expansion of the double decides the tie
_TENTHS_SQL = """
exact AS (SELECT o_orderkey, o_totalprice AS v, CAST(round(o_totalprice * 100) AS BIGINT) AS cents, printf('%.40f', o_totalprice) AS digits FROM orders),
tenth AS (SELECT o_orderkey, v, cents, CAST(split_part(digits, '.', 1) AS BIGINT) * 10 + CAST(substr(split_part(digits, '.', 2), 1, 1) AS BIGINT)
  + CASE WHEN substr(split_part(digits, '.', 2), 2, 1) >= '5' THEN 1 ELSE 0 END AS t FROM exact)
"""


def ramp(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", X.colour_ramp("o_totalprice", F.lit(20000.0), F.lit(480000.0)).alias("colour"))


def three_colours(spark, sf):
    colours = ("#ff0000", "#ffff00", "#0000ff")
    return table(spark, sf, "orders").select("o_orderkey", X.colour_ramp("o_totalprice", F.lit(20000.0), F.lit(480000.0), colours).alias("colour"))


def ramp_sql(colours) -> str:
    n = len(colours) - 1
    held = "least(greatest(o_totalprice, 20000.0::DOUBLE), 480000.0::DOUBLE)"
    width = f"(460000.0::DOUBLE / {n})"
    index = f"least(CAST(floor(({held} - 20000.0::DOUBLE) / {width}) AS INT), {n - 1})"
    channels = []
    for at in (1, 3, 5):
        cases = []
        for i in range(n):
            a, b = (int(c[at : at + 2], 16) for c in colours[i : i + 2])
            lo, hi = f"(20000.0::DOUBLE + {width} * {i})", f"(20000.0::DOUBLE + {width} * {i + 1})"
            cases.append(f"WHEN {index} = {i} THEN floor({float(b - a)}::DOUBLE / ({hi} - {lo}) * (least(greatest({held}, {lo}), {hi}) - {lo}) + {a} + 0.5)")
        channels.append(f"printf('%02x', CAST(CASE {' '.join(cases)} END AS INT))")
    return f"SELECT o_orderkey, '#' || {' || '.join(channels)} AS colour FROM orders"


def strings(spark, sf):
    c = F.col("p_name")
    return table(spark, sf, "part").select(
        "p_partkey", F.lower(c).alias("low"), F.upper(c).alias("up"), F.left(c, F.lit(3)).alias("l3"), F.right(c, F.lit(3)).alias("r3"),
        F.length(c).alias("n"), F.repeat(F.lit(A.BAR_MARK), F.length(c)).alias("bar"), F.get(F.split(c, " "), F.lit(1)).alias("second"),
        c.startswith("red").alias("red"), c.like("%bolt%").alias("bolt"), F.replace(c, F.lit(" "), F.lit("_")).alias("under"),
    )


def arithmetic(spark, sf):
    v = F.col("o_totalprice")
    return table(spark, sf, "orders").select(
        "o_orderkey", F.floor(v / 7).alias("fl"), F.ceil(v / 7).alias("ce"), X.round_half_even_int(F.col("o_orderkey") / 2).alias("even"),
        X.round_half_up_int(F.col("o_orderkey") / 2).alias("up"), F.expr("o_orderkey div 10").alias("tens"), F.pow(F.col("o_orderkey") % 9, F.lit(2)).alias("sq"),
    )


def cases(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.nullif(F.col("o_orderstatus"), F.lit("P")).isNull(), 1).when(F.col("o_orderstatus") == "O", 0).otherwise(2).alias("flag")
    )


def draws(spark, sf):
    """Uniform draws: count, and how many fall in each tenth roughly evenly."""
    drawn = table(spark, sf, "orders").select(F.rand(11).alias("r"))
    return drawn.agg(
        F.count(F.lit(1)).alias("rows"), ((F.min("r") >= 0) & (F.max("r") < 1)).alias("in_range"), (F.abs(F.avg("r") - 0.5) < 0.05).alias("centred")
    )


def counted(spark, sf):
    return A.row_count(table(spark, sf, "lineitem"))


QUERIES = {
    "j01_left_join": (left_join, with_sql(REGIONS_SQL, PROFILE_SQL, body="SELECT code, name, g1, g2 FROM regions LEFT JOIN profile ON code = region_id")),
    "j02_join_profiles": (side_by_side, with_sql(PROFILE_SQL, body="SELECT region_id, g1, g2 AS a_g2, -g2 AS b_g2, g5 FROM profile")),
    "j03_inner_join": (inner_join, with_sql(REGIONS_SQL, PROFILE_SQL, body="SELECT code, state, g3 FROM regions JOIN profile ON code = region_id")),
    "j07_one_row_stats": (min_max_beside_rows, "SELECT o_orderkey, o_totalprice, (SELECT min(o_totalprice) FROM orders) AS lo, (SELECT max(o_totalprice) FROM orders) AS hi FROM orders"),
    "a02_density": (densities, DENSITY_SQL),
    "density_from_text": (density_from_text, DENSITY_SQL),
    "p04_ratio": (zero_safe_ratio, with_sql(PROFILE_SQL, body="SELECT region_id, CAST(round_even(CASE WHEN g1 <> 0 THEN g2 * 1000 / g1 END, 0) AS INT) AS per_mille FROM profile")),
    "p05_numeric_guards": (
        positive_people,
        with_sql(PROFILE_SQL, body="SELECT region_id, g1 AS population, 'Town' AS name FROM profile WHERE g1 > 1000 AND right(region_id, 1) <> '4'"),
    ),
    "a03_percent": (percents, with_sql(PROFILE_SQL, body="SELECT region_id, g2, g1, CASE WHEN g1 <> 0 THEN 100.0::DOUBLE * (g2 / g1) END AS percent FROM profile")),
    "a04_weighted_total": (weighted, with_sql(INCOME_SQL, body="SELECT sum(t205 * t3 * 52.25::DOUBLE) AS total, sum(t3) AS total_weight FROM income")),
    "a05_share_of_total": (shares, with_sql(PROFILE_SQL, body="SELECT region_id, g1, g1 / (sum(g1) OVER ()) * 100.0::DOUBLE AS share FROM profile")),
    "a05_percent_population": (
        centre_percent,
        with_sql(PROFILE_SQL, body="SELECT region_id, floor(g1 / 1000000.0::DOUBLE * 100.0::DOUBLE * 10 + 0.5) / 10 AS percent_population FROM profile"),
    ),
    "a06_histogram": (fixed_histogram, f"SELECT {_bucket_sql('o_totalprice', '50000', '450000', 19)} AS bucket, count(*) AS freq FROM orders GROUP BY 1"),
    "a10_bucket_range": (
        data_histogram,
        with_sql(DATA_HISTOGRAM, body="SELECT bucket, freq, CAST(round_even(mn, 0) AS INT) AS lo, CAST(round_even(mx, 0) AS INT) + 1 AS hi FROM h"),
    ),
    "a11_bars": (bars, with_sql(DATA_HISTOGRAM, body="SELECT bucket, freq, repeat('■', CAST(round_even(CAST(freq AS DOUBLE) / (max(freq) OVER ()) * 30, 0) AS BIGINT)) AS bar FROM h")),
    "w02_whole_set_max": (
        freq_beside_max,
        f"SELECT bucket, freq, max(freq) OVER () AS top FROM (SELECT {_bucket_sql('l_extendedprice', '0', '100000', 40)} AS bucket, count(*) AS freq FROM lineitem GROUP BY 1)",
    ),
    "a07_map_range": (
        map_ranges,
        with_sql(REGIONS_SQL, PROFILE_SQL, FEATURES_SQL, body="""SELECT 'values' AS maptype, min(value) AS map_min, max(value) AS map_max FROM features WHERE population > 7
          UNION ALL SELECT 'percent', min(percent), least(max(percent), 100.0::DOUBLE) FROM features WHERE population > 7"""),
    ),
    "p13_map_value": (map_values, with_sql(REGIONS_SQL, PROFILE_SQL, FEATURES_SQL, body="SELECT code, CASE WHEN code > 'R000000050' THEN percent ELSE value END AS shown FROM features")),
    "p14_pop_class": (
        population_flags,
        with_sql(REGIONS_SQL, PROFILE_SQL, FEATURES_SQL, body="SELECT code, population, CASE WHEN population = 0 THEN 'none' WHEN population <= 15000 THEN 'low' ELSE 'normal' END AS pop_class FROM features"),
    ),
    "p11_boundary_for_zoom": (boundary_levels, BOUNDARY_LEVELS_SQL),
    "a09_class_breaks": (breaks, kmeans_sql(EVENT_VALUES, 7, "SELECT class_id, max(v) AS break FROM classed GROUP BY class_id")),
    "c01_kmeans_outliers": (outlier_classes, kmeans_sql(OUTLIER_VALUES, 7, "SELECT class_id, CAST(sum(w) AS BIGINT) AS rows, max(v) AS break FROM classed GROUP BY class_id")),
    "c01_kmeans_classes": (classes, kmeans_sql(EVENT_VALUES, 6, "SELECT event_id, value, class_id FROM events JOIN classed ON value = v")),
    "w04_cluster_window": (ratio_classes, kmeans_sql(RATED_VALUES, 6, "SELECT class_id, CAST(sum(w) AS BIGINT) AS rows, max(v) AS break FROM classed GROUP BY class_id")),
    "w01_run_rank": (class_runs, RUNS_SQL),
    "w03_row_number": (
        lambda spark, sf: K.with_row_id(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"),
                                        ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"], "row_no").select("row_no", "l_orderkey"),
        "SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS row_no, l_orderkey FROM lineitem",
    ),
    "c11_income_shares": (
        income_shares,
        with_sql(INCOME_SQL, body=f"SELECT region_id, t205 * t3 * 52.25::DOUBLE / {ALL_INCOME}::DOUBLE * 100.0::DOUBLE AS proportion, t205 * 52.25::DOUBLE AS median_income, t3 AS population FROM income"),
    ),
    "c11_income_histogram": (
        income_histogram,
        with_sql(INCOME_SQL, body=f"SELECT {_bucket_sql('v', '0', '100000000', 19)} AS bucket, count(*) AS freq FROM (SELECT t205 * t3 * 52.25::DOUBLE AS v FROM income) WHERE v IS NOT NULL GROUP BY 1 UNION ALL SELECT NULL, count(*) FROM income WHERE t205 IS NULL"),
    ),
    "c07_stat_equation": (equation, with_sql(PROFILE_SQL, body="SELECT region_id, g2 * (g4 + g5) / (g6 + 1) - 2.5::DOUBLE AS value FROM profile")),
    "u02_equation_view": (
        equation_as_view,
        with_sql(REGIONS_SQL, PROFILE_SQL, body="""SELECT r.code, state, g2 / (g1 + 1) * 100 AS share, CAST(CASE WHEN shape = 'empty' THEN 0 ELSE n END AS INT) AS n, CASE WHEN shape = 'empty' THEN 0 ELSE area END AS area
          FROM regions r LEFT JOIN boxes USING (k) LEFT JOIN areas USING (k) LEFT JOIN profile ON region_id = r.code"""),
    ),
    "c09_long_form": (
        lambda spark, sf: M.to_long(region_profile(spark, sf), dictionary(spark, sf)).select("region_id", "stat_id", "value", "long_id"),
        with_sql(PROFILE_SQL, DICTIONARY_SQL, body="""SELECT region_id, stat_id, value, long_id FROM
          (UNPIVOT profile ON g1, g2, g3, g4, g5, g6 INTO NAME stat_id VALUE value) LEFT JOIN dictionary ON lower(sequential_id) = stat_id"""),
    ),
    "o01_order_by": (nulls_last, with_sql(INCOME_SQL, body="SELECT region_id, t205 FROM medians")),
    "o03_random_rows": (sample, None),
    "o03_draws": (samples, "SELECT 8 * least(count(*), 5) AS n, 8 * least(count(*), 5) AS different, 8 * least(count(*), 5) AS there, true AS apart FROM orders"),
    "o05_union_tagged": (
        tagged_union,
        "SELECT left(c_mktsegment, 1) || lower(substr(c_mktsegment, 2)) AS segment, c_custkey, c_acctbal FROM customer",
    ),
    "o07_first_per_key": (
        first_order,
        "SELECT DISTINCT ON (o_custkey) o_custkey, o_orderkey, o_totalprice FROM orders ORDER BY o_custkey, o_totalprice, o_orderkey",
    ),
    "p15_view": (saved, f"SELECT code, density FROM ({DENSITY_SQL}) WHERE density > 0"),
    "x01_zoom_tolerance": (tolerance, "SELECT o_orderkey, round(pow(156543.03390625::DOUBLE / pow(2, 5 + o_orderkey % 13), 2) * 7, 6) AS tolerance FROM orders"),
    "x02_zoom_decimals": (
        decimals,
        """SELECT o_orderkey, CAST(length(regexp_extract(split_part(printf('%.9f', 156543.03390625::DOUBLE / pow(2, 4 + o_orderkey % 13) / (2 * pi() * 6378137 / 360)), '.', 2), '^0*')) + 1 AS INT) AS places FROM orders""",
    ),
    "x03_tenths": (tenth, with_sql(_TENTHS_SQL, body="SELECT o_orderkey, t AS tenths FROM tenth")),
    "x04_number_text": (
        texts,
        with_sql(_TENTHS_SQL, body="""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN CAST(t // 10 AS VARCHAR) || '.' || CAST(t % 10 AS VARCHAR) || '%'
          ELSE CASE WHEN o_orderkey % 2 = 0 THEN '$' ELSE '' END || format('{:,}', cents // 100) ||
            CASE WHEN cents % 100 = 0 THEN '' ELSE '.' || rtrim(lpad(CAST(cents % 100 AS VARCHAR), 2, '0'), '0') END END AS text FROM tenth"""),
    ),
    "x05_colour_ramp": (ramp, ramp_sql(X.DEFAULT_RAMP)),
    "x05_three_colours": (three_colours, ramp_sql(("#ff0000", "#ffff00", "#0000ff"))),
    "x06_strings": (
        strings,
        """SELECT p_partkey, lower(p_name) AS low, upper(p_name) AS up, left(p_name, 3) AS l3, right(p_name, 3) AS r3, CAST(length(p_name) AS INT) AS n,
          repeat('■', length(p_name)) AS bar, split_part(p_name, ' ', 2) AS second, starts_with(p_name, 'red') AS red, p_name LIKE '%bolt%' AS bolt,
          replace(p_name, ' ', '_') AS under FROM part""",
    ),
    "x07_math": (
        arithmetic,
        """SELECT o_orderkey, CAST(floor(o_totalprice / 7) AS BIGINT) AS fl, CAST(ceil(o_totalprice / 7) AS BIGINT) AS ce, CAST(round_even(o_orderkey / 2, 0) AS INT) AS even,
          CAST(floor(o_orderkey / 2 + 0.5) AS INT) AS up, o_orderkey // 10 AS tens, pow(o_orderkey % 9, 2) AS sq FROM orders""",
    ),
    "x08_random": (draws, "SELECT count(*) AS rows, true AS in_range, true AS centred FROM orders"),
    "x09_case": (cases, "SELECT o_orderkey, CAST(CASE WHEN nullif(o_orderstatus, 'P') IS NULL THEN 1 WHEN o_orderstatus = 'O' THEN 0 ELSE 2 END AS INT) AS flag FROM orders"),
    "a13_row_count": (counted, "SELECT count(*) AS rows, format('{:,}', count(*)) AS rows_text FROM lineitem"),
}
