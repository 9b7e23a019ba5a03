import gzip

import numpy as np
import pytest
from pyspark.sql import types as T

from tillwise import schemas
from tillwise.operators import quality
from tillwise.sources import files

CSV = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType())])


def test_bad_lines(spark, tmp_path):
    (tmp_path / "r.csv").write_text('id,text\n1,plain\n2,"two\nlines, one cell"\n3,a,surplus\n4\nx,bad id\n5,"say ""hi"""\n')
    got = {(r["id"], r["text"]) for r in files.src_csv_skip_bad(spark, str(tmp_path / "r.csv"), CSV).collect()}
    assert got == {(1, "plain"), (2, "two\nlines, one cell"), (4, None), (None, "bad id"), (5, 'say "hi"')}


def test_encodings(spark, tmp_path):
    (tmp_path / "l.csv").write_bytes("id,text\n1,café\n".encode("latin-1"))
    (tmp_path / "u.csv").write_bytes("id,text\n1,café\n".encode("utf-8"))
    for name in ("l.csv", "u.csv"):
        assert files.src_csv_encoding_fallback(spark, str(tmp_path / name), CSV).first()["text"] == "café"
    assert files.src_csv_encoding_fallback(spark, str(tmp_path / "none.csv"), CSV) is None


def test_union_extracts(spark, tmp_path):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([(2, "y")], "id int, b string")
    a.write.parquet(str(tmp_path / "a"))
    files.sink_table(b, str(tmp_path / "b.csv"), "csv")
    paths = [str(tmp_path / p) for p in ("a", "gone", "b.csv")]
    got = files.src_union_extracts(spark, [paths[0], paths[1]], clean=False)
    assert got.collect() == a.collect()
    assert files.src_union_extracts(spark, paths, clean=False).columns == ["id", "a", "b"]
    with pytest.raises(ValueError):
        files.src_union_extracts(spark, paths[1:2])


def test_catalog(spark, tmp_path):
    root = str(tmp_path / "out")
    assert files.src_load_catalog(spark, root) == {}
    traffic = spark.createDataFrame([("f", "1", 2)], schemas.FOOT_TRAFFIC)
    files.sink_table(traffic, f"{root}/somewhere.csv", "csv")
    files.sink_table(spark.createDataFrame([("k", 1.0, "negative")], schemas.REVIEW_KEYWORDS), f"{root}/review_keywords")
    tables = files.src_load_catalog(spark, root, views=True)
    assert sorted(tables) == ["cv_foot_traffic", "review_keywords"]
    assert spark.table("cv_foot_traffic").count() == 1
    status = {r["name"]: (r["exists"], r["found"], r["n_cols"]) for r in files.src_outputs_status(spark, root).collect()}
    assert status["cv_foot_traffic"] == (False, True, 3)
    assert status["review_keywords"] == (True, True, 3) and status["sales_forecast"] == (False, False, 0)
    assert files.src_discover_by_columns(spark, root, ["nope"]) is None


def test_stopword_file(spark, tmp_path):
    (tmp_path / "w.txt").write_text("The\n  and \n\nthe\n")
    assert sorted(r["word"] for r in files.src_stopwords(spark, str(tmp_path / "w.txt")).collect()) == ["and", "the"]
    assert files.src_stopwords(spark, str(tmp_path / "absent.txt")).count() == 0
    words = spark.createDataFrame([("b",), ("a",), ("b",)], "word string")
    path = files.sink_stopwords(words, str(tmp_path / "out"))
    assert [r["value"] for r in spark.read.text(path).collect()] == ["a", "b"]


def test_pictures_and_annotations(spark, tmp_path):
    for zone, names in {"41": ["frame_000000.png", "frame_000001.jpg", "frame_000001.png", "note.txt"], "2": ["second_frame_07.JPG"]}.items():
        folder = tmp_path / zone / "images"
        folder.mkdir(parents=True)
        for n in names:
            (folder / n).write_bytes(b"x")
        (tmp_path / zone / "annotations.xml").write_text(
            '<annotations><track id="0" label="person">'
            '<box frame="0" outside="0" xtl="10" ytl="20" xbr="30" ybr="60" occluded="0"/>'
            '<box frame="1" outside="1" xtl="1" ytl="2" xbr="3" ybr="4"/>'
            '<box frame="1" xtl="0" ytl="0" xbr="100" ybr="50"/></track>'
            '<track id="1" label="person"><box frame="7" outside="0" xtl="0" ytl="0" xbr="50" ybr="50"/></track></annotations>')
    listed = files.src_image_listing(spark, str(tmp_path))
    assert {(r["camera"], r["image"]) for r in listed.collect()} == {
        ("41", "frame_000000.png"), ("41", "frame_000001.jpg"), ("41", "frame_000001.png"), ("2", "second_frame_07.JPG")}
    boxes = files.src_box_annotations(spark, str(tmp_path / "*" / "annotations.xml"))
    assert boxes.count() == 6
    sizes = listed.selectExpr("camera", "image", "100 AS width", "100 AS height")
    got = {(r["camera"], r["image"]): (r["x_center"], r["y_center"], r["box_width"], r["box_height"])
           for r in files.src_box_annotations(spark, str(tmp_path / "*" / "annotations.xml"), sizes).collect()}
    assert got == {("41", "frame_000000.png"): (0.2, 0.4, 0.2, 0.4), ("41", "frame_000001.png"): (0.5, 0.25, 1.0, 0.5),
                   ("2", "second_frame_07.JPG"): (0.25, 0.25, 0.5, 0.5)}


def test_schema_adherence(spark):
    df = spark.createDataFrame([("k", 1, None)], "keyword string, score int, extra string")
    got = {r["column_name"]: (r["declared_type"], r["actual_type"], r["matches"], r["n_filled"])
           for r in quality.schema_adherence(df, schemas.REVIEW_KEYWORDS).collect()}
    assert got == {"keyword": ("string", "string", True, 1), "score": ("double", "int", False, 1),
                   "sentiment": ("string", None, False, 0), "extra": (None, "string", False, 0)}


def test_broken_extracts_are_left_out_and_named(spark, tmp_path):
    spark.range(100).repartition(2).write.parquet(str(tmp_path / "a"))
    spark.range(100, 130).write.parquet(str(tmp_path / "b"))
    spark.range(0).write.parquet(str(tmp_path / "empty"))
    parts = sorted((tmp_path / "a").glob("part-*.parquet"))
    lost = spark.read.parquet(str(parts[0])).count()
    parts[0].write_bytes(parts[0].read_bytes()[:-40])               # the footer is cut
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "part-0.parquet").write_bytes(b"no table at all")
    (tmp_path / "z.csv").mkdir()
    (tmp_path / "z.csv" / "x.csv.gz").write_bytes(gzip.compress(b"id\n" + b"7\n" * 9000)[:-30])
    (tmp_path / "z.csv" / "y.csv.gz").write_bytes(gzip.compress(b"id\n500\n"))
    paths = [str(tmp_path / p) for p in ("a", "b", "c", "empty", "gone", "z.csv")]
    report = files.extract_report(spark, paths).collect()
    broken = {r["file"].rsplit("/", 1)[1] for r in report if not r["is_read"] and r["file"]}
    assert broken == {parts[0].name, "part-0.parquet", "x.csv.gz"}
    assert all(r["why"] for r in report if not r["is_read"])
    assert [r["why"] for r in report if r["file"] is None] == ["not found"]
    assert sum(r["n_rows"] for r in report if r["path"] in paths[:4]) == 130 - lost
    got = files.src_union_extracts(spark, paths[:5], clean=False)
    assert got.count() == 130 - lost
    assert [r["id"] for r in files.src_union_extracts(spark, paths[5:], clean=False).collect()] == ["500"]
    with pytest.raises(ValueError):
        files.src_union_extracts(spark, [paths[2], paths[4]], clean=False)


def test_outliers_of_all_measures(spark):
    rows = [(float(i % 7), None if i % 3 else float(i), None) for i in range(60)] + [(1000.0, -5000.0, None)] * 2
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = {r["measure"]: r for r in quality.outlier_profile(df, ["a", "b", "c"]).collect()}
    for name, at in (("a", 0), ("b", 1)):
        v = np.array([r[at] for r in rows if r[at] is not None])
        q1, q3 = np.quantile(v, [0.25, 0.75])
        step = 1.5 * (q3 - q1)
        r = got[name]
        assert (r["q1"], r["q3"], r["n"]) == (pytest.approx(q1), pytest.approx(q3), len(v))
        assert (r["n_low"], r["n_high"]) == ((v < q1 - step).sum(), (v > q3 + step).sum())
    assert tuple(got["c"]) == ("c", 0, 0, 0, None, None)
    assert quality.outlier_profile(df.limit(0), ["a"]).first()["n"] == 0
