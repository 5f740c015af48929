import os

import pytest
from pyspark.sql import functions as F

from arealis.operators import dictionary as M
from arealis.operators import keys as K
from arealis.sources import datapack, files, spatial, workbook
from workload.ingest import workbook_bytes


@pytest.fixture
def stats(spark):
    rows = [(f"G{i}", f"s{i}", f"Long_{i}_Median" if i == 5 else f"Long_{i}", "G01", "p", "Persons") for i in range(1, 13)]
    rows += [("G13", "x", "Other", "G02", "p", "Males"), ("G10065", "y", "Far", "G10", "p", "Persons"), ("T3", "t", "Total_persons", "T01", "p", "Persons")]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in M.STAT_COLUMNS))


def test_discovery_and_keys(spark, tmp_path):
    names = ["2021Census_G01_AUST_LGA.csv", "2021census_I01A_AUST_IREG.CSV", "2021Census_G02_AUS.csv", "notes.csv", "2021Census_G01.txt"]
    for i, n in enumerate(names):
        folder = tmp_path / f"d{i}" / "deep er"
        folder.mkdir(parents=True)
        (folder / n).write_text("x")
    found = files.with_file_keys(files.discover(spark, str(tmp_path))).select("name", "table", "boundary").collect()
    assert sorted(map(tuple, found)) == [
        ("2021Census_G01_AUST_LGA.csv", "g01", "lga"),
        ("2021Census_G02_AUS.csv", "g02", "aust"),
        ("2021census_I01A_AUST_IREG.CSV", "i01a", "ireg"),
    ]


def test_profile_schema(stats):
    assert M.profile_schema(stats, "g01").names == ["region_id"] + [f"g{i}" for i in range(1, 13)]
    # a prefix match takes longer table numbers too
    assert M.profile_schema(stats, "g1").names == ["region_id", "g10065"]
    assert M.profile_schema(stats, "g0").names[-1] == "g13"
    with pytest.raises(ValueError):
        M.profile_schema(stats, "g1", exact=True)


def _lines(spark, lines):
    return spark.createDataFrame([(line,) for line in lines], "line string")


def test_dirty_rows(spark, stats):
    schema = M.profile_schema(stats, "g02")
    parsed = datapack.parse_profile(
        _lines(spark, [" A 1 , 1 2 \x1a", "B,..", "C,", "D,1,2", "E", "F,1x", "..,4", "   ", '"G",1e3']), schema
    )
    got = {r["region_id"] or r["_error"]: (r["g13"], r["_error"]) for r in parsed.collect()}
    assert got["A1"] == (12.0, None) and got["B"] == (None, None) and got["G"] == (1000.0, None)
    assert got["C"][1] == "empty cell where a number belongs"
    assert got["D"][1] == "extra data after the last column"
    assert got["E"][1] == "missing data for a column"
    assert got["F"][1] == "malformed number"
    assert "region id is null" in got
    assert len(got) == 8


def test_header_skipped_per_file(spark, stats, tmp_path):
    (tmp_path / "a.csv").write_text("\n  \nregion_id,anything\nA,1\nB,2\n\n")
    (tmp_path / "b.csv").write_text("99,98\nC,3")
    rows = datapack.read_profile_csv(spark, str(tmp_path), M.profile_schema(stats, "g02")).collect()
    assert sorted(map(tuple, rows)) == [("A", 1.0), ("B", 2.0), ("C", 3.0)]


def test_strict_read_raises(spark, stats, tmp_path):
    (tmp_path / "a.csv").write_text("h,h\nA,bad\n")
    with pytest.raises(Exception, match="malformed number"):
        datapack.read_profile_csv(spark, str(tmp_path), M.profile_schema(stats, "g02")).collect()
    with pytest.raises(Exception, match="malformed number"):
        datapack.read_profile_csv(spark, str(tmp_path), M.profile_schema(stats, "g02")).select("region_id").collect()


def test_load_all(spark, stats, tmp_path):
    source, root = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    good = "region_id,g13\nA,1\nB,..\n"
    (source / "2021Census_G02_AUST_LGA.csv").write_text(good)
    (source / "2021Census_G02_AUST_SA1.csv").write_text("region_id,g13\nA,1\nA,2\n")
    (source / "2021Census_G02_AUST_SA2.csv").write_text("region_id,g13\nA,oops\n")
    (source / "2021Census_G02_AUS.csv").write_text("region_id,g13\nX,7\n")
    (source / "2021Census_Z99_AUST_LGA.csv").write_text(good)
    (source / "2021Census_G02_AUST_POA.csv").write_text("region_id,g13\n")
    report = {(r["table"], r["boundary"]): (r["rows"], r["status"], r["error"]) for r in datapack.load_all(spark, str(source), stats, root).collect()}
    assert report[("g02", "lga")] == (2, "SUCCESS", None)
    assert report[("g02", "aust")] == (1, "SUCCESS", None)
    assert report[("g02", "sa1")] == (2, "FAILED", "duplicate region id A")
    assert report[("g02", "sa2")] == (1, "FAILED", "malformed number")
    assert report[("g02", "poa")][1] == "SUCCESS"
    assert report[("z99", "lga")][1] == "FAILED"
    assert sorted(map(tuple, datapack.read_profile(spark, root, "lga", "g02").collect())) == [("A", 1.0), ("B", None)]
    assert not os.path.exists(datapack.profile_path(root, "sa1", "g02"))
    # loading again replaces
    (source / "2021Census_G02_AUST_LGA.csv").write_text("region_id,g13\nC,5\n")
    datapack.load_all(spark, str(source), stats, root)
    assert [tuple(r) for r in datapack.read_profile(spark, root, "lga", "g02").collect()] == [("C", 5.0)]
    assert [tuple(r) for r in datapack.read_profile(spark, root, "aust", "g02").collect()] == [("X", 7.0)]


def test_workbooks(spark, tmp_path):
    tables = [["G01", "Name & more", "text"], [None, "no number", "x"]]
    stats = [["G1", "a", "A_long", "G01", "p", "Persons"], ["G2", "", "B", "G01", "p", None]]
    (tmp_path / "Metadata_one.xlsx").write_bytes(workbook_bytes(tables, stats))
    (tmp_path / "metadata_TWO.XLSX").write_bytes(workbook_bytes([["G02", "n", "d"]], [["G3", "c", "C", "G02", "p", "Males"]]))
    (tmp_path / "other.xlsx").write_bytes(b"not read")
    t, s = workbook.load_metadata(workbook.read_workbooks(spark, str(tmp_path)))
    assert sorted(r["table_number"] for r in t.collect()) == ["G01", "G02"]
    assert {r["sequential_id"]: (r["short_id"], r["column_heading_description"]) for r in s.collect()} == {
        "G1": ("a", "Persons"), "G2": (None, None), "G3": ("c", "Males"),
    }
    assert [r["table_name"] for r in t.filter("table_number = 'G01'").collect()] == ["Name & more"]


def test_marker_rules(spark):
    cells = "file string, sheet int, row_no int, cells array<string>"
    # a marker in the first row is not seen, the second one is
    rows = [("f", 0, 1, ["Table Number"]), ("f", 0, 2, ["x"]), ("f", 0, 3, ["TABLE NUMBER"]), ("f", 0, 4, ["G01"])]
    assert [r["row_no"] for r in workbook.skip_preamble(spark.createDataFrame(rows, cells)).collect()] == [4]
    with pytest.raises(Exception, match="no marker row"):
        workbook.skip_preamble(spark.createDataFrame(rows[:2], cells)).collect()


def test_duplicate_metadata_refused(spark, tmp_path):
    (tmp_path / "Metadata_a.xlsx").write_bytes(workbook_bytes([["G01", "n", "d"], ["G01", "m", "e"]], [["G1", "a", "b", "G01", "p", "h"]]))
    with pytest.raises(ValueError, match="not unique"):
        workbook.load_metadata(workbook.read_workbooks(spark, str(tmp_path)))


def test_keys(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "k string")
    assert sorted((r["k"], r["rows"]) for r in K.duplicate_keys(df, "k").collect() if r["k"]) == [("a", 2)]
    assert K.duplicate_keys(df, "k").count() == 2
    with pytest.raises(ValueError):
        K.assert_unique(df, "k")


def test_row_ids_and_runs_match_a_plain_scan(spark):
    values = [(i * 37 % 101, i, ["x", "y", None][(i // 7) % 3] if i % 5 else "x") for i in range(400)]
    df = spark.createDataFrame(values, "v int, id int, c string").repartition(7)
    ordered = sorted(values)
    ids = {r["id"]: r["gid"] for r in K.with_row_id(df, ["v", "id"]).collect()}
    assert ids == {row[1]: n for n, row in enumerate(ordered, 1)}
    expected, rank = {}, 0
    for n, row in enumerate(ordered):
        before = ordered[n - 1][2] if n else None
        if before is None or row[2] != before:
            rank += 1
        expected[row[1]] = rank
    assert {r["id"]: r["rank"] for r in K.run_rank(df, "c", ["v", "id"]).collect()} == expected


@pytest.mark.parametrize("keys, n", [(range(1, 1001), 7), (range(5, 60), 12), ([3], 4), (range(-50, 500, 3), 10)])
def test_range_chunks(spark, keys, n):
    lo, hi = min(keys), max(keys)
    width = 10 if (hi - lo) / n < 10 else (hi - lo) // n + 1
    want = {}
    for k in keys:
        want[(k - (lo - 1) - 1) // width + 1] = want.get((k - (lo - 1) - 1) // width + 1, 0) + 1
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    got = K.range_chunks(df, "k", n).collect()
    assert {r["chunk"]: r["rows"] for r in got} == want
    assert all(r["hi"] - r["lo"] == width for r in got)


def test_partition_options():
    assert spatial.partition_options(1, 250001, "gid")["numPartitions"] == "3"
    assert spatial.partition_options(5, 5, "gid")["numPartitions"] == "1"


def test_dictionary_searches(spark, stats):
    assert [r[0] for r in M.search_stats(stats, "MEDIAN").collect()] == ["G5"]
    assert [r["sequential_id"] for r in M.list_profile(stats, "G").collect()][:3] == ["G1", "G10", "G11"]
    assert {r["profile"]: r["count"] for r in M.profile_counts(stats).collect()} == {"G": 14, "T": 1}
    assert M.stat_descriptors(stats, ["G13"]).first()["maptype"] == "values"


def test_prefixes(spark):
    df = spark.createDataFrame([("123456",), ("IARE7",)], "c string")
    once = M.ensure_prefix(df, "c", "IARE")
    assert [r[0] for r in once.collect()] == ["IARE123456", "IARE7"]
    assert [r[0] for r in M.ensure_prefix(once, "c", "IARE").collect()] == ["IARE123456", "IARE7"]
    assert [r[0] for r in M.strip_prefix(df, "c", 3).collect()] == ["456", "E7"]


def test_catalog_filter(spark):
    names = ["lga_2021", "lga_2011_aust", "x_analysis", "x_display_1", "qa", "qab"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r[0] for r in df.filter(spatial.exportable("n")).orderBy("n").collect()] == ["lga_2021", "qab"]


def test_long_form(spark, stats):
    wide = spark.createDataFrame([("A", 1.0, None)], "region_id string, g1 double, g13 double")
    rows = M.to_long(wide, stats).orderBy("stat_id").collect()
    assert [(r["stat_id"], r["value"], r["long_id"]) for r in rows] == [("g1", 1.0, "Long_1"), ("g13", None, "Other")]


def test_saved_tables_are_listed_and_exported(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS lists")
    for name in ("lga_g01", "lga_2011_g01", "qa"):
        spark.sql(f"DROP TABLE IF EXISTS lists.{name}")
    try:
        for name in ("lga_g01", "lga_2011_g01", "qa"):
            spark.range(3).withColumn("v", F.lit(1.0)).write.option("path", str(tmp_path / name)).saveAsTable(f"lists.{name}")
        assert [r[0] for r in spatial.list_tables(spark, "lists").collect()] == ["lga_g01"]
        K.analyze_table(spark, "lists.lga_g01")
        report = spatial.export_all({"lga_g01": spark.table("lists.lga_g01")}, str(tmp_path / "out")).first()
        assert (report["rows"], report["status"], report["spatial"]) == (3, "SUCCESS", False)
    finally:
        spark.sql("DROP DATABASE lists CASCADE")
