import decimal
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from arealis.functions import scalars as X
from arealis.operators import classify as C
from arealis.operators import stats as A
from arealis.plans import income as I
from arealis.plans.equation import equation_ids, stat_equation
from arealis.plans.map_extract import map_extract


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_zoom_known_values(spark):
    zooms = spark.createDataFrame([(z,) for z in (4, 8, 12, 16)], "z int")
    rows = zooms.select(X.zoom_tolerance("z").alias("t"), X.zoom_decimals("z").alias("d")).collect()
    want = [167519580.3242318, 654373.3606415305, 2556.1459400059784, 9.984945078148353]
    assert [r["t"] for r in rows] == pytest.approx(want, rel=1e-14)
    assert [r["d"] for r in rows] == [2, 3, 4, 5]


def test_tenths_are_exact(spark):
    rng = random.Random(1)
    values = [0.0, 0.25, 0.15, 12.35, -12.35, -0.04, 100.05, 1e9 + 0.05] + [round(rng.uniform(-1e5, 1e5), 2) for _ in range(3000)]
    got = spark.createDataFrame([(v,) for v in values], "v double").select("v", X.tenths("v").alias("t"), X.one_decimal("v").alias("s")).collect()
    for r in got:
        exact = decimal.Decimal(abs(r["v"])).quantize(decimal.Decimal("0.1"), rounding=decimal.ROUND_HALF_UP)
        want = int(exact * 10) * (-1 if r["v"] < 0 else 1)
        assert r["t"] == want, r
        assert r["s"] == ("-" if want < 0 else "") + str(exact)


def test_number_text(spark):
    assert one(spark, X.number_text(F.lit(1234567.5), F.lit("values"), F.lit("$/week"))) == "$1,234,567.5"
    assert one(spark, X.number_text(F.lit(1234.0), F.lit("values"), F.lit("Persons"))) == "1,234"
    assert one(spark, X.number_text(F.lit(12.345), F.lit("percent"), F.lit("Persons"))) == "12.3%"
    assert one(spark, X.number_text(F.lit(0.0), F.lit("values"), F.lit("Persons"))) == "0"


def test_ramp(spark):
    def at(v, lo=0.0, hi=1.0, **kw):
        return one(spark, X.colour_ramp(F.lit(v), F.lit(lo), F.lit(hi), **kw))

    assert at(0.0) == "#1f1f1f" and at(1.0) == "#e45427"
    assert at(0.5)[1:3] == "82"
    assert at(-5.0) == "#1f1f1f" and at(9.0) == "#e45427"
    three = ("#ff0000", "#00ff00", "#0000ff")
    assert at(0.5, colours=three) == "#00ff00" and at(1.0, colours=three) == "#0000ff"
    assert at(3.0, 3.0, 3.0, on_flat="start") == "#1f1f1f"
    with pytest.raises(Exception, match="high > low"):
        at(3.0, 3.0, 3.0)


def test_rounding(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-2.5,)], "v double")
    assert [r[0] for r in df.select(X.round_half_even_int("v")).collect()] == [0, 2, 2, -2]
    assert [r[0] for r in df.select(X.round_half_up_int("v")).collect()] == [1, 2, 3, -3]


def test_density_zero_area(spark):
    df = spark.createDataFrame([("a", 10.0, 4.0), ("b", 10.0, 0.0), ("c", None, 2.0)], "code string, g1 double, area double")
    kept = A.density(df, "g1", "area", on_zero="null").collect()
    assert [r["density"] for r in kept] == [2, None, None]
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        A.density(df, "g1", "area").collect()


def test_weighted_total_counts_null_values(spark):
    df = spark.createDataFrame([("a", 100.0, 10.0), ("b", None, 5.0)], "region_id string, m double, p double")
    row = A.weighted_total(df, "m", "p").first()
    assert (row["total"], row["total_weight"]) == (52250.0, 15.0)
    report = I.income_report(df, "m", "p", hi=1e5, n=10)
    assert [r["proportion"] for r in report["shares"].orderBy("region_id").collect()] == [100.0, None]
    assert sum(r["freq"] for r in report["histogram"].collect()) == 2


def test_histogram_edges(spark):
    df = spark.createDataFrame([(v,) for v in (-1.0, 0.0, 4.9, 5.0, 9.99, 10.0, 11.0, None)], "v double")
    assert {r["bucket"]: r["freq"] for r in A.histogram(df, "v", 0, 10, 2).collect()} == {0: 1, 1: 2, 2: 2, 3: 2, None: 1}
    ranged = A.histogram(df.filter("v is not null"), "v", n=3, with_range=True).collect()
    assert [(r["range"]["lo"], r["range"]["hi"]) for r in ranged] == [(-1, 1), (5, 6), (10, 11), (11, 12)]
    bars = A.histogram_bar(spark.createDataFrame([(1, 30), (2, 1)], "bucket int, freq long")).orderBy("bucket").collect()
    assert [len(r["bar"]) for r in bars] == [30, 1]


def test_percent_population(spark):
    df = spark.createDataFrame([(23355119.0,), (1167756.0,), (None,)], "p double")
    assert [r[0] for r in A.percent_population(df, "p", 23355119.0).select("percent_population").collect()] == [decimal.Decimal("100.0"), decimal.Decimal("5.0"), None]


def test_map_range_and_classes(spark):
    rows = [(1.0, 200.0, 100.0), (5.0, 20.0, 50.0), (9.0, 1.0, 7.0), (2.0, None, 0.0)]
    df = spark.createDataFrame(rows, "value double, percent double, population double")
    assert tuple(A.map_range(df, "values", 7).first()) == (1.0, 5.0)
    assert tuple(A.map_range(df, "percent", 7).first()) == (20.0, 100.0)
    assert [r[0] for r in df.select(A.pop_class("population", 7)).collect()] == ["normal", "normal", "low", "none"]


def test_zoom_levels(spark):
    zooms = spark.createDataFrame([(z, f"b{z}", z) for z in range(4, 17)], "zoom int, name string, min int")
    assert A.boundary_for_zoom(zooms, 2).first()["name"] == "b4"
    assert A.boundary_for_zoom(zooms, 20).first()["name"] == "b16"
    assert A.boundary_for_zoom(zooms, 9, "lga").first()["name"] == "lga"


def test_map_extract_one_feature(spark):
    bdy = spark.createDataFrame([("a", "A", 0.0, 0.0, 1.0, 1.0), ("b", "B", 8.0, 8.0, 9.0, 9.0)], "code string, name string, xmin double, ymin double, xmax double, ymax double")
    stats = spark.createDataFrame([("a", 5.0, 50.0), ("b", 6.0, 3.0)], "region_id string, g2 double, g1 double")
    rows = map_extract(bdy, stats, "g2", "g1", "values", 7, "code", "name", (-1, -1, 2, 2)).collect()
    assert [(r["id"], r["colour"], r["percent"]) for r in rows] == [("a", "#1f1f1f", 10.0)]
    low = map_extract(bdy, stats, "g2", "g1", "percent", 7, "code", "name").orderBy("id").collect()
    assert [(r["pop_class"], r["colour"]) for r in low] == [("normal", "#1f1f1f"), ("low", "#422")]


def lloyd(values, k):
    v = np.array(sorted(values))
    centres = [v[0], v[-1]]
    distinct = np.unique(v)
    while len(centres) < k:
        gap = np.min(np.abs(distinct[:, None] - np.array(centres)), axis=1)
        centres.append(distinct[np.argmax(gap)])
    centres = sorted(centres)
    held = None
    for _ in range(1000):
        c = np.array(centres)
        cls = (np.abs(v[:, None] - c)[:, 1:] < np.abs(v[:, None] - c)[:, :-1]).sum(axis=1)
        if held is not None and (cls == held).all():
            break
        held = cls
        centres = sorted(v[cls == i].mean() if (cls == i).any() else c[i] for i in range(k))
    return centres


@pytest.mark.parametrize("bins", [65536, 16])
def test_kmeans_matches_plain_lloyd(spark, monkeypatch, bins):
    monkeypatch.setattr(C, "MAX_BINS", bins)
    rng = random.Random(5)
    # a third of all rows hold one value
    values = [7.0] * 300 + [round(rng.expovariate(0.02), 3) for _ in range(600)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    for k in (2, 5):
        assert C.kmeans_centres(df, "v", k) == pytest.approx(lloyd(values, k), rel=1e-9)


@pytest.mark.parametrize("far", [[5e11, 7e11, 1e12], [10.0**e for e in range(3, 60, 6)]])
def test_kmeans_far_outliers(spark, far):
    rng = random.Random(3)
    values = [rng.random() for _ in range(1000)] + far
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert C.kmeans_centres(df, "v", 7) == pytest.approx(lloyd(values, 7), rel=1e-9)


def test_kmeans_refuses(spark):
    df = spark.createDataFrame([(float(v),) for v in range(50)] + [(math.inf,)], "v double")
    with pytest.raises(ValueError, match="finite"):
        C.kmeans_centres(df, "v", 5)
    with pytest.raises(RuntimeError):
        C.kmeans_centres(df.filter("v < 100"), "v", 5, max_iterations=1)


def test_kmeans_separated_groups(spark):
    values = [1.0, 1.1, 1.2, 50.0, 51.0, 900.0, 901.5]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (math.nan,)], "v double")
    assert [r["break"] for r in C.class_breaks(df, "v", 3).collect()] == [1.2, 51.0, 901.5]
    rows = C.kmeans_classes(df, "v", 3).collect()
    assert [r["class_id"] for r in rows] == [1, 1, 1, 2, 2, 3, 3, None, None]
    with pytest.raises(ValueError):
        C.kmeans_centres(df, "v", 8)


def test_equation(spark):
    assert equation_ids("B23 * (b45+b678)") == ["b23", "b45", "b678"]
    for bad in ("g1; drop table x", "sum(g1)", "g1 + 'a'", "g1 -- g2", ""):
        with pytest.raises(ValueError):
            equation_ids(bad)
    stats = spark.createDataFrame([("G1", "G01"), ("G2", "G01"), ("T9", "T01")], "sequential_id string, table_number string")
    tables = {
        "g01": spark.createDataFrame([("a", 2.0, 3.0), ("b", 1.0, None)], "region_id string, g1 double, g2 double"),
        "t01": spark.createDataFrame([("a", 4.0), ("b", 5.0)], "region_id string, t9 double"),
    }
    rows = stat_equation(tables.__getitem__, stats, "g1*(G2 + t9)").orderBy("region_id").collect()
    assert [r["value"] for r in rows] == [14.0, None]
    with pytest.raises(ValueError, match="unknown"):
        stat_equation(tables.__getitem__, stats, "g1+g77")


def test_order_union_sample_first(spark):
    df = spark.createDataFrame([(2, "b"), (None, "n"), (1, "a")], "v int, s string")
    assert [r["v"] for r in A.order_by(df, "v").collect()] == [1, 2, None]
    both = A.union_tagged({"x": df, "y": df.filter("v = 1")})
    assert {r["tag"]: r["n"] for r in both.groupBy("tag").agg(F.count("*").alias("n")).collect()} == {"x": 3, "y": 1}
    big = spark.range(1000).repartition(3)
    assert A.random_rows(big, 5, 1, "id").collect() == A.random_rows(big.repartition(9), 5, 1, "id").collect()


def test_join_profiles_prefixes_clashes(spark):
    a = spark.createDataFrame([("r", 1.0)], "region_id string, g1 double")
    joined = A.join_profiles({"x": a, "y": a})
    assert joined.columns == ["region_id", "x_g1", "y_g1"]
