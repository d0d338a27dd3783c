import json
import random
import time

import pytest
from pyspark.sql import functions as F

from boxloom.operators import tracks as T
from boxloom.sources import readers, writers
from boxloom.streaming.lines import Counter, count_stream

TRACK = "camera_id string, seq bigint, pid bigint, cx double, cy double"
LINE = "camera_id string, line_ord int, line string, ax double, ay double, bx double, by double"


def frames(spark, updates, lines):
    return spark.createDataFrame([("c", k, *u) for k, u in enumerate(updates)], TRACK), spark.createDataFrame([("c", k, *x) for k, x in enumerate(lines)], LINE)


def counts(df):
    return {r.line: (r.up_count, r.down_count) for r in df.collect()}


def test_two_tracks_cross_down(spark):
    line = [("line1", 730.0, 408.0, 1150.0, 408.0)]
    updates = [(p, 953.0 if k == 0 else 950.0, y) for p in (1, 2) for k, y in enumerate((252.0, 607.0) if p == 2 else (252.0, 607.0, 610.0))]
    assert counts(T.totals(*frames(spark, updates, line))) == {"line1": (0, 2)}


@pytest.mark.parametrize("between, want", [(49, 1), (50, 2)])
def test_a_track_counts_again_after_fifty_others(spark, between, want):
    updates = [(1, 5.0, 0.0), (1, 5.0, 20.0), *[(2, 900.0, 900.0)] * 1, (1, 5.0, 0.0)]
    updates += [(k + 10, 900.0, 900.0) for k in range(between)] + [(1, 5.0, 20.0)]
    assert counts(T.totals(*frames(spark, updates, [("l", 0.0, 10.0, 10.0, 10.0)])))["l"][1] == want


def test_windows_equal_the_loop(spark):
    rng = random.Random(5)
    lines = [("a", 0.0, 50.0, 100.0, 50.0), ("b", 50.0, 0.0, 50.0, 100.0), ("c", 0.0, 0.0, 100.0, 100.0)]
    updates = [(rng.randint(1, 40), float(rng.randint(0, 100)), float(rng.randint(0, 100))) for _ in range(400)]
    loop = Counter([dict(zip(("line", "ax", "ay", "bx", "by"), x)) for x in lines])
    for u in updates:
        loop.update(*u)
    want = {x[0]: tuple(t) for x, t in zip(lines, loop.state["totals"])}
    assert counts(T.totals(*frames(spark, updates, lines))) == want


def test_stream_equals_batch(spark, tmp_path):
    rng = random.Random(6)
    lines = [("a", 0.0, 50.0, 100.0, 50.0), ("b", 50.0, 0.0, 50.0, 100.0)]
    updates = [(rng.randint(1, 9), float(rng.randint(0, 100)), float(rng.randint(0, 100))) for _ in range(120)]
    rows, line_rows = frames(spark, updates, lines)
    for k in range(3):
        rows.where(f"seq BETWEEN {40 * k} AND {40 * k + 39}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(TRACK).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    named = {"c": [dict(zip(("line", "ax", "ay", "bx", "by"), x)) for x in lines]}
    got: dict = {}

    def take(batch, _):
        got.update(counts(batch))

    query = count_stream(source, named).writeStream.outputMode("update").foreachBatch(take).option("checkpointLocation", str(tmp_path / "state")).start()
    query.processAllAvailable()
    query.stop()
    assert got == counts(T.totals(rows, line_rows))


def test_a_stream_takes_a_time_out(spark, tmp_path):
    rows, _ = frames(spark, [(1, 5.0, 0.0), (1, 5.0, 20.0)], [("l", 0.0, 10.0, 10.0, 10.0)])
    lines = {"c": [{"line": "l", "ax": 0.0, "ay": 10.0, "bx": 10.0, "by": 10.0}]}
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    got = []
    source = spark.readStream.schema(TRACK).parquet(str(tmp_path / "in"))
    query = count_stream(source, lines, 60_000).writeStream.outputMode("update").foreachBatch(lambda b, _: got.append(counts(b))).option("checkpointLocation", str(tmp_path / "state")).start()
    for _ in range(300):  # with a time-out there are empty batches without end
        if any(got):
            break
        time.sleep(0.1)
    query.stop()
    assert [g for g in got if g] == [{"l": (0, 1)}]


def test_voc_files_round_trip(spark, tmp_path):
    docs = spark.createDataFrame([("a", "a.jpg", None, 64, 48, 3, [("cat", 1.5, 2.5, 9.0, 8.0)]), ("b", "b.jpg", None, 10, 10, 3, [])], "image_key string, file_name string, path string, width int, height int, depth int, object array<struct<name:string,xmin:double,ymin:double,xmax:double,ymax:double>>")
    made = docs.select(F.concat("image_key", F.lit(".xml")).alias("name"), writers.voc_xml().alias("value"))
    assert writers.write_files(made, f"file://{tmp_path}/x", "name").count() == 2
    (tmp_path / "x" / "bad.xml").write_text("<annotation><size>")
    got = readers.voc(spark, str(tmp_path / "x"))
    objects = readers.voc_objects(got.where("corrupt IS NULL")).drop("difficult").collect()
    assert [tuple(r) for r in objects] == [("a", 1, "cat", 2.0, 2.0, 9.0, 8.0)]
    assert {r.image_key: r.width for r in readers.voc_images(got).collect()}["b"] == 10
    assert got.where("corrupt IS NOT NULL").count() == 1


def test_json_scans(spark, tmp_path):
    (tmp_path / "lm").mkdir()
    (tmp_path / "lm" / "a.json").write_text(json.dumps({"imageHeight": 5, "imageWidth": 6, "imagePath": "d\\a.jpg", "shapes": [{"label": "x", "shape_type": "circle", "points": [[1, 2]]}, {"label": "y", "shape_type": "polygon", "points": [[1, 2], [3, 4], [1, 5]]}]}))
    rows = readers.labelme(spark, str(tmp_path / "lm")).collect()
    assert [(r.file_name, r.shape_ord, r.usable) for r in rows] == [("a.jpg", 0, False), ("a.jpg", 1, True)]
    (tmp_path / "co").mkdir()
    (tmp_path / "co" / "c.json").write_text(json.dumps({"images": [{"id": 1, "file_name": "a.jpg", "width": 4, "height": 3}], "annotations": [{"id": 1, "image_id": 1, "category_id": 2, "bbox": [0, 0, 2, 2]}], "categories": [{"id": 2, "name": "cat"}]}))
    coco = readers.coco(spark, str(tmp_path / "co"))
    assert coco["annotations"].first().bbox == [0.0, 0.0, 2.0, 2.0]
    value = json.loads(writers.coco_json(coco["images"], coco["annotations"], coco["categories"], info=True).first()[0])
    assert [x["id"] for x in value["images"]] == [1] and value["info"]["version"] == "1.0"


def test_lists_and_yolo_text(spark, tmp_path):
    (tmp_path / "l.txt").write_text("edible oil\ncat\n")
    assert [tuple(r) for r in readers.label_tokens(spark, str(tmp_path / "l.txt")).collect()] == [("edible", 1), ("oil", 2), ("cat", 3)]
    assert [tuple(r) for r in readers.label_lines(spark, str(tmp_path / "l.txt")).collect()] == [("edible oil", 0), ("cat", 1)]
    (tmp_path / "y").mkdir()
    (tmp_path / "y" / "a.txt").write_text("0 .5 .5 1 1\n1 2 3\nx y z w v\n")
    assert [r.class_id for r in readers.yolo(spark, str(tmp_path / "y")).collect()] == ["0"]
    rows = spark.createDataFrame([("a", 1, 0, 0.00001, 0.5, 1.0, 1.0)], "image_key string, obj_ord int, class_id int, cx double, cy double, w double, h double")
    every = spark.createDataFrame([("a",), ("b",)], "image_key string")
    assert sorted(map(tuple, writers.yolo_text(rows, every).collect())) == [("a", "0 1e-05 0.5 1.0 1.0\n"), ("b", "")]


def test_manifest_copies(spark, tmp_path):
    (tmp_path / "a.txt").write_text("1")
    rows = spark.createDataFrame([(f"file://{tmp_path}/a.txt", f"file://{tmp_path}/d/b.txt"), (f"file://{tmp_path}/none", f"file://{tmp_path}/d/c.txt")], "src string, dst string")
    assert sorted(r.done for r in writers.carry_out(rows).collect()) == [False, True]
    assert (tmp_path / "d" / "b.txt").read_text() == "1"
