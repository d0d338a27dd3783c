import json
import tarfile
from io import BytesIO
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from boxloom.functions import images
from boxloom.operators import annotations
from boxloom.plans import catalogue, views
from boxloom.sources import archives, cocofile, readers, workdir, writers

SF = "/root/testdata/sf0.001"


def below(folder):
    return [p for p in Path(folder.removeprefix("file://")).rglob("*") if p.is_file() and p.suffix != ".crc"]


@pytest.mark.parametrize("name", ["voc_to_coco_files", "labelme_to_coco", "cityscapes_to_coco", "yolo_to_voc_files", "tool_json_files"])
def test_documents_are_members_of_few_files(spark, monkeypatch, tmp_path, name):
    monkeypatch.setattr(catalogue.workdir, "fresh_dir", lambda s, kind: f"file://{tmp_path}/{kind}{len(list(tmp_path.iterdir()))}")
    rows = catalogue.QUERIES[name](spark, SF).collect()
    assert len(rows) > 1000 and len(below(str(tmp_path))) < 60


def test_archives_keep_names_and_bytes(spark, monkeypatch, tmp_path):
    want = {"a.json": "x" * 700, "ü/b.json": "", f"{'l' * 150}.json": "zü", "c.json": "q" * 512, "d.xml": "<a/>"}
    rows = spark.createDataFrame(list(want.items()), "name string, value string").coalesce(1)
    made = archives.write_archives(rows, f"file://{tmp_path}/x", "name").collect()
    assert [r.files for r in made] == [5] and len(below(f"{tmp_path}/x")) == 1
    with pa.input_stream(str(below(f"{tmp_path}/x")[0]), compression="zstd") as f, tarfile.open(fileobj=BytesIO(f.read())) as tar:
        assert {m.name: tar.extractfile(m).read().decode() for m in tar} == want
    got = readers.documents(spark, f"{tmp_path}/x", ".json", archived=True).collect()
    assert {r.path.partition("/x/")[2]: r.content.decode() for r in got} == {n: v for n, v in want.items() if n.endswith(".json")}


def test_members_that_other_tools_write():
    with tarfile.open(fileobj=(buffer := BytesIO()), mode="w", format=tarfile.GNU_FORMAT) as tar:
        for n, v in (("plain", b"1"), ("n" * 200, b"2" * 600), ("after", b"")):
            info = tarfile.TarInfo(n)
            info.size = len(v)
            tar.addfile(info, BytesIO(v))
        folder = tarfile.TarInfo("folder")
        folder.type = tarfile.DIRTYPE
        tar.addfile(folder)
    assert list(archives.members(buffer.getvalue())) == [("plain", b"1"), ("n" * 200, b"2" * 600), ("after", b"")]
    with pytest.raises(ValueError):
        list(archives.members(archives.header(b"a", 100) + b"cut"))


@pytest.mark.parametrize("indent", [None, 1])
def test_a_large_coco_file_is_read_by_ranges(spark, monkeypatch, tmp_path, indent):
    odd = ['"annotations": [{', "\\", 'a\\"b', "]}{[", "ü\n", "\\\\\\"]
    doc = {
        "info": {"description": 'x"images": [', "contributor": "{"},
        "other": [{"id": 5}, [{"id": 6}]],
        "images": [{"id": k, "file_name": odd[k % 6] * (1 + k % 3), "width": 4, "height": 3, "more": {"a": [{}]}} for k in range(40)],
        "annotations": [{"id": k, "image_id": k % 40, "category_id": 1, "bbox": [0, 1.5, 2, k], "segmentation": [[1, 2, 3]]} for k in range(90)],
        "categories": [{"id": 1, "name": "\\"}],
        "licenses": [],
    }
    (tmp_path / "a.json").write_text(json.dumps(doc, indent=indent, ensure_ascii=bool(indent)))
    (tmp_path / "b.json").write_text(json.dumps({"categories": [{"id": 2, "name": "z"}], "images": []}))
    (tmp_path / "cut.json").write_text(json.dumps(doc)[:-30])
    whole = {k: sorted(map(str, v.collect())) for k, v in readers.coco(spark, str(tmp_path)).items()}
    assert [len(whole[k]) for k in cocofile.LISTS] == [40, 90, 2]
    monkeypatch.setattr(readers, "_json", None)  # no document is one value
    monkeypatch.setattr(cocofile, "WHOLE", 0)
    for size in (900, 1337):
        monkeypatch.setattr(cocofile, "RANGE", size)
        assert {k: sorted(map(str, v.collect())) for k, v in readers.coco(spark, str(tmp_path)).items()} == whole


def test_records_of_a_large_coco_file_are_not_taken_for_few(spark, monkeypatch, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"images": [{"id": 1, "width": 4}], "annotations": [{"id": 2, "image_id": 1}], "categories": []}))
    monkeypatch.setattr(cocofile, "WHOLE", 0)
    monkeypatch.setattr(cocofile, "FEW", 10, raising=False)
    data = readers.coco(spark, str(tmp_path))
    rows = data["annotations"].join(data["images"].select(F.col("id").alias("image_id"), "width"), "image_id")
    # how large they are is known once they are read: before that, no side is broadcast
    assert "Broadcast" not in (plan := lambda df: df._jdf.queryExecution().executedPlan().toString())(rows)
    # while the classes of a data set are few, and cost no shuffle of its objects
    assert "BroadcastHashJoin" in plan(data["annotations"].join(data["categories"].withColumnRenamed("id", "category_id"), "category_id"))
    assert "BroadcastHashJoin" in plan(annotations.with_category(spark.range(9).select(F.col("id").cast("string").alias("name")), views.categories(spark)))
    assert [(r.id, r.width) for r in rows.collect()] == [(2, 4.0)]


def test_a_written_coco_file_is_sorted_and_has_a_record_a_line(spark):
    ids = spark.range(0, 5000, 1, 7).select((F.col("id") * 7 % 5000).alias("id"))
    data = {"images": ids, "annotations": ids.withColumn("v", F.lit('a"b')), "categories": ids.limit(0)}
    path = writers.write_coco(data, folder := workdir.fresh_dir(spark, "test"))
    text = Path(path.removeprefix("file://")).read_text()
    doc = json.loads(text)
    assert [r["id"] for r in doc["annotations"]] == [r["id"] for r in doc["images"]] == list(range(5000)) and doc["categories"] == []
    assert len(text.splitlines()) >= 10_000 and [p.name for p in below(folder)] == ["data.json"]


def test_boxes_of_whole_batches_are_those_of_each_polygon():
    r = np.random.default_rng(1)
    polygons = [(r.uniform(-10, 70, (k % 6, 2)) if k % 2 else r.uniform(1, 48, (k % 6, 2))).tolist() for k in range(300)]
    polygons[5] = None
    got = images.raster_boxes(pa.array(polygons, pa.list_(pa.list_(pa.float64()))), pa.array([50] * 300), pa.array([60] * 300))
    want = [images.raster(p, 50, 60) if p is not None else None for p in polygons]
    assert [None if np.isnan(g).all() else tuple(g) for g in got] == [w and tuple(w) for w in want]
