import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from boxloom.functions import boxes, images, names
from boxloom.operators import annotations as A
from boxloom.operators import conversions, dedup
from boxloom.plans import catalogue
from boxloom.sources import readers, workdir, writers

TABLES = "orders lineitem events documents".split()
SF = "/root/testdata/sf0.001"


def values(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want, got = con.sql(catalogue.ORACLES[name]).df(), catalogue.QUERIES[name](spark, SF).toPandas()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    got, want = (x[cols].sort_values(cols).reset_index(drop=True).astype(str) for x in (got, want))
    pd.testing.assert_frame_equal(got, want)


def test_stems_follow_the_last_dot(spark):
    df = spark.createDataFrame([("a.b.c",), (".x",), ("a..b",), ("a.",), ("plain",)], "n string")
    assert [r[0] for r in df.select(names.stem(F.col("n"))).collect()] == ["a.b", ".x", "a.", "a", "plain"]


def test_coco_and_back_restores_integer_corners(spark):
    df = spark.createDataFrame([(3.0, 4.0, 10.0, 12.0)], "xmin double, ymin double, xmax double, ymax double")
    made = df.select(*(c.alias(n) for n, c in boxes.corners_to_coco(*(F.col(c) for c in df.columns), 0, False).items()))
    back = made.select(*(c.alias(n) for n, c in boxes.coco_to_corners(*(F.col(c) for c in "xywh")).items()))
    assert tuple(back.first()) == (3, 4, 10, 12)


def test_strict_labels_fail(spark):
    rows = spark.createDataFrame([(1, "cat"), (1, "cow")], "image_key int, name string")
    known = spark.createDataFrame([("cat", 1), ("cat", 5)], "name string, category_id bigint")
    assert values(A.with_category(rows, known).select("name", "category_id")) == [("cat", 5), ("cow", None)]
    with pytest.raises(Exception, match="unknown label"):
        A.with_category(rows, known, strict=True).collect()


def test_split_sizes_sum(spark):
    rows = spark.range(101).withColumnRenamed("id", "k")
    got = dict(A.split_by_share(rows, "k", {"train": 0.9, "val": 0.1, "test": 0.0}).groupBy("split").count().collect())
    assert got == {"train": 90, "val": 11} and sum(got.values()) == 101
    with pytest.raises(ValueError):
        A.split_by_share(rows, "k", {"train": 0.5})


def test_one_file_stays_for_each_digest(spark):
    rows = spark.createDataFrame([("a", "x", 3), ("b", "x", 1), ("c", "y", 2)], "path string, digest string, modificationTime int")
    assert values(dedup.ranked(rows, "oldest").where("kept").select("path")) == [("b",)]
    assert values(dedup.ranked(rows, "last").where("kept").select("path")) == [("b",)]


def test_destination_suffixes(spark):
    rows = spark.createDataFrame([("p/a.jpg",), ("q/a.jpg",), ("r/b.jpg",)], "path string")
    taken = spark.createDataFrame([("b.jpg",)], "dest string")
    got = dedup.destinations(rows, names.basename(F.col("path")), taken)
    assert values(got.select("dest")) == [("a.jpg",), ("a_1.jpg",), ("b_1.jpg",)]


@pytest.mark.parametrize("paths, taken", [(["p/a.jpg", "q/a.jpg", "r/a_1.jpg"], []), (["p/a.jpg"], ["a.jpg", "a_1.jpg"]), (["p/a.jpg", "q/a.jpg", "r/a.jpg", "s/a_2.jpg", "t/a_2.jpg"], ["a_1.jpg", "a_4.jpg"]), (["p/x", "q/x", "r/x_1", "s/.h", "t/.h"], ["x_01"])])
def test_destinations_never_clash(spark, paths, taken):
    rows = spark.createDataFrame([(p,) for p in paths], "path string")
    there = spark.createDataFrame([(t,) for t in taken], "dest string")
    got = [r.dest for r in dedup.destinations(rows, names.basename(F.col("path")), there).collect()]
    assert len(set(got)) == len(paths) and not set(got) & set(taken)
    assert len({r.dest for r in dedup.destinations(rows, names.basename(F.col("path"))).collect()}) == len(paths)


def test_moves_never_replace_a_file(spark, tmp_path):
    for name, text in (("a.txt", "1"), ("b.txt", "2")):
        (tmp_path / name).write_text(text)
    rows = spark.createDataFrame([(f"file://{tmp_path}/a.txt", f"file://{tmp_path}/b.txt"), (f"file://{tmp_path}/gone", f"file://{tmp_path}/c")], "src string, dst string")
    assert [r.done for r in writers.carry_out(rows, move=True).collect()] == [False, False]
    assert (tmp_path / "b.txt").read_text() == "2" and (tmp_path / "a.txt").exists()


def test_duplicates_from_files_to_manifest(spark, tmp_path):
    for name, data in (("x/a.bin", b"\xff" * 9000), ("y/a.bin", b"\xff" * 9000), ("y/b.bin", b"\xff" * 8999 + b"!"), ("c.bin", b"\xff" * 50)):
        (tmp_path / "in" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / name).write_bytes(data)
    files = readers.files(spark, str(tmp_path / "in"))
    for fast, want in ((True, ["y/a.bin", "y/b.bin"]), (False, ["y/a.bin"])):  # the sample misses the last byte
        found = dedup.deduplicate(files, f"file:{tmp_path}/in", "/dup", fast=fast)
        assert sorted(r.dst for r in found["manifest"].collect()) == [f"/dup/{w}" for w in want]
        assert found["report"].first().moved == len(want) and found["report"].first().scanned == 4
    grouped = dedup.deduplicate(files, f"file:{tmp_path}/in", "/dup", fast=False, grouped=True)["manifest"].first().dst
    assert grouped.startswith("/dup/group_") and grouped.endswith("/a.bin")


def test_image_formats(spark):
    rows = [("FFD8FF00", "jpeg"), ("49492B00", "tiff"), ("4D4D00FF", "tiff"), ("52494646000000005745425000", "webp"), ("", None), (None, None)]
    df = spark.createDataFrame(rows, "h string, want string").select(names.magic_format(F.unhex("h")).alias("got"), "want")
    assert all(r.got == r.want for r in df.collect())


def test_the_first_listed_name_counts(spark):
    rows, known = spark.createDataFrame([(1,), (2,)], "category_id bigint"), spark.createDataFrame([(1, "zebra", 0), (1, "ant", 1)], "category_id bigint, name string, pos int")
    assert values(A.with_name(rows, known)) == [(1, "zebra"), (2, None)]
    assert values(A.with_name(rows, known.drop("pos").coalesce(1))) == [(1, "zebra"), (2, None)]


def test_an_empty_difficult_ends_its_image(spark):
    rows = spark.createDataFrame([("i", 1, "a", "0"), ("i", 2, "a", ""), ("i", 3, "a", "0"), ("j", 1, "a", None), ("j", 2, "a", " 1 "), ("j", 3, "b", "0")], "image_key string, obj_ord int, name string, difficult string")
    assert [r[:2] for r in values(A.trainable(rows, ["a"]))] == [("i", 1), ("j", 1)]


def test_strict_boxes_fail(spark):
    rows = spark.createDataFrame([("i", 1, 3.0, 1.0, 3.9, 5.0)], "image_key string, obj_ord bigint, xmin double, ymin double, xmax double, ymax double")
    assert A.require_valid(rows, 0, False).count() == 1 and len(A.require_valid(rows, 1, True).collect()) == 1
    with pytest.raises(Exception, match="no extent"):
        A.require_valid(rows.withColumn("xmax", F.lit(2.0)), 0, False).collect()


def test_names_of_images_in_documents(spark):
    rows = spark.createDataFrame([("/x/s7.xml", "/data/other.png", "f.gif"), ("/x/s8.xml", None, "f.gif"), ("/x/s9.xml", "/p/none", "f.bmp")], "src_path string, path string, filename string")
    assert [r[0] for r in rows.select(conversions.image_record()).collect()] == ["s7.png", "s8.gif", "s9"]
    assert [r[0] for r in rows.select(conversions.image_record(False)).collect()] == ["s7.gif", "s8.jpg", "s9.bmp"]


def test_documents_in_other_charsets(spark, tmp_path):
    body = "<annotation><filename>{}</filename><size><width>5</width><height>6</height></size></annotation>"
    texts = {"a": ("gbk", "猫", "gbk"), "b": ("GB2312", "狗", "gb18030"), "c": ("gb18030", "鱼", "gb18030"), "d": ("utf-8", "é", "utf-8"), "e": ("ISO-8859-1", "ñ", "latin-1"), "g": (None, "鸟", "gb18030"), "h": ("nonesuch", "x", "utf-8")}
    for name, (declared, word, code) in texts.items():
        head = f'<?xml version="1.0" encoding="{declared}"?>' if declared else ""
        (tmp_path / f"{name}.xml").write_bytes((head + body.format(word)).encode(code))
    (tmp_path / "f.xml").write_bytes(b"\xff\xfe" + body.format("u").encode("utf-16-le"))
    (tmp_path / "i.xml").write_bytes(b'<?xml version="1.0" encoding="utf-8"?>' + body.format("é").encode("latin-1"))
    rows = readers.voc(spark, str(tmp_path), None).select(names.stem(names.basename(F.col("src_path"))).alias("k"), "filename", F.col("corrupt").isNotNull().alias("bad")).collect()
    want = {k: w for k, (_, w, _) in texts.items() if k != "h"} | {"f": "u"}
    assert {r.k: r.filename for r in rows if not r.bad} == want and {r.k for r in rows if r.bad} == {"h", "i"}


def test_coco_ids_as_text_or_numbers(spark, tmp_path):
    import json

    for name, ids in (("text", ["a1", "b"]), ("zeros", ["007", "8"]), ("numbers", [7, 8]), ("digits", ["7", "8"])):
        (tmp_path / name).mkdir()
        doc = {"images": [{"id": i, "file_name": f"{i}.jpg", "width": 1, "height": 1} for i in ids], "annotations": [{"id": 1, "image_id": ids[0], "category_id": 1, "bbox": [0, 0, 1, 1]}], "categories": []}
        (tmp_path / name / "c.json").write_text(json.dumps(doc))
        data = readers.coco(spark, str(tmp_path / name))
        joined = data["annotations"].join(data["images"].select(F.col("id").alias("image_id"), "file_name"), "image_id")
        assert [r.file_name for r in joined.collect()] == [f"{ids[0]}.jpg"]
        assert dict(data["images"].dtypes)["id"] == ("bigint" if name in ("numbers", "digits") else "string")


def test_coco_to_voc_and_a_written_data_set(spark):
    data = {"images": spark.createDataFrame([("a", "a.jpg", 4, 3), ("b", "b.jpg", 4, 3)], "id string, file_name string, width int, height int"), "annotations": spark.createDataFrame([(10, "a", 2, [0.5, 1.0, 2.6, 1.2]), (9, "a", 1, [0.0, 0.0, 1.0, 1.0])], "id bigint, image_id string, category_id bigint, bbox array<double>"), "categories": spark.createDataFrame([(1, "x"), (2, "y")], "id bigint, name string")}
    again = readers.coco(spark, writers.write_coco(data, workdir.fresh_dir(spark, "test"), info=True))
    row = conversions.coco_to_voc(again).first()
    assert row.image_key == "a" and [tuple(o) for o in row.object] == [("x", 0, 0, 1, 1), ("y", 0, 1, 3, 2)]
    empty = {k: v.limit(0) for k, v in data.items()}
    again = readers.coco(spark, writers.write_coco(empty, workdir.fresh_dir(spark, "test")))
    assert all(v.count() == 0 for v in again.values())


def test_a_listed_image_without_document_fails(spark):
    shapes = spark.createDataFrame([("/x/a.json", None, 4, 3, 0, "l", "polygon", [[0.0, 0.0], [2.0, 2.0], [0.0, 2.0]], True)], "src_path string, file_name string, width int, height int, shape_ord int, label string, shape_type string, points array<array<double>>, usable boolean")
    listed = spark.createDataFrame([("a", "a.png"), ("b", "b.png")], "stem string, file_name string")
    made = conversions.shapes_to_coco(shapes, listed.where("stem = 'a'"))
    assert made["annotations"].first().bbox == [0.0, 0.0, 2.0, 2.0] and made["images"].first().file_name == "a.png"
    with pytest.raises(Exception, match="no document"):
        conversions.shapes_to_coco(shapes, listed)["images"].collect()


def test_a_shared_folder_is_needed_on_a_cluster(spark, monkeypatch):
    class Context:
        master, applicationId = "spark://host", "x"
        getConf = lambda self: {}

    class Session:
        conf, sparkContext = {}, Context()

    with pytest.raises(ValueError, match="share"):
        workdir.shared_dir(Session())


def test_image_headers():
    png = b"\x89PNG\r\n\x1a\n" + b"\0\0\0\rIHDR" + (7).to_bytes(4, "big") + (5).to_bytes(4, "big") + b"\x08\x02\0\0\0"
    assert images.image_size(png) == (7, 5, 3)
    assert images.image_size(b"GIF89a" + (4).to_bytes(2, "little") + (6).to_bytes(2, "little")) == (4, 6, 3)
    jpeg = b"\xff\xd8\xff\xe0\0\x04ab\xff\xc0\0\x11\x08\0\x09\0\x0b\x03" + b"\0" * 12
    assert images.image_size(jpeg) == (11, 9, 3)
    assert images.image_size(b"text") is None


def test_raster_box_clips_to_the_image():
    assert images.raster([[1, 1], [4, 1], [4, 3]], 10, 10) == (1, 1, 3, 2)
    assert images.raster([[-5, 2], [20, 2], [20, 4]], 10, 10) == (0, 2, 9, 1)  # the slope reaches y = 3.12 at the last column
    assert images.raster([[50, 50], [60, 60], [50, 60]], 10, 10) is None
