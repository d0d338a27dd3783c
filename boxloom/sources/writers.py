"""Sinks: nested documents as text columns, and one file for each row.

Documents are made by expressions; write_files() puts each row's text in a file of its
own. Moves and copies are manifests (src, dst): frames to look at before carry_out().
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import images
from . import cocofile, workdir


def voc_xml(database: str = "Unknown", folder: str = "VOC") -> Column:
    """The document of a row (file_name, path, width, height, depth, object) as XML."""
    box = lambda o: F.struct(*(F.bround(o[c].cast("double")).cast("int").alias(c) for c in ("xmin", "ymin", "xmax", "ymax")))
    objects = F.transform("object", lambda o: F.struct(o["name"].alias("name"), F.lit("Unspecified").alias("pose"), F.lit(0).alias("truncated"), F.lit(0).alias("occluded"), F.lit(0).alias("difficult"), box(o).alias("bndbox")))
    size = F.struct("width", "height", F.col("depth"))
    return F.to_xml(F.struct(F.lit(folder).alias("folder"), F.col("file_name").alias("filename"), "path", F.struct(F.lit(database).alias("database")).alias("source"), size.alias("size"), F.lit(0).alias("segmented"), objects.alias("object")), {"rowTag": "annotation"})


def minimal_voc_xml() -> Column:
    """Only filename, size, and the objects' names and boxes."""
    box = lambda o: F.struct(*(o[c].cast("int").alias(c) for c in ("xmin", "ymin", "xmax", "ymax")))
    objects = F.transform("object", lambda o: F.struct(o["name"].alias("name"), box(o).alias("bndbox")))
    return F.to_xml(F.struct(F.col("file_name").alias("filename"), F.struct("width", "height", "depth").alias("size"), objects.alias("object")), {"rowTag": "annotation"})


def element_voc_xml(folder: str = "VOC_dataset") -> Column:
    """The short document of a row (file_name, width, height, depth, object): objects with
    pose, truncated and difficult, but no path, source, segmented or occluded."""
    box = lambda o: F.struct(*(o[c].cast("int").alias(c) for c in ("xmin", "ymin", "xmax", "ymax")))
    objects = F.transform("object", lambda o: F.struct(o["name"].alias("name"), F.lit("Unspecified").alias("pose"), F.lit(0).alias("truncated"), F.lit(0).alias("difficult"), box(o).alias("bndbox")))
    return F.to_xml(F.struct(F.lit(folder).alias("folder"), F.col("file_name").alias("filename"), F.struct("width", "height", "depth").alias("size"), objects.alias("object")), {"rowTag": "annotation"})


def write_coco(data: dict[str, DataFrame], folder: str, info: bool = False) -> str:
    """The data set as one JSON file below folder, a record a line: the lists are sorted and
    written as pieces in parallel, and one task copies the pieces. Returns its path."""
    spark, target = data["images"].sparkSession, f"{folder}/data.json"
    head = spark.range(1).select(F.to_json(F.struct(default_info().alias("info")))).first()[0] if info else '{"type": "instances"}'
    texts = []
    for start, name in zip(('{"images": [\n', '\n], "annotations": [\n', '\n], "categories": [\n'), cocofile.LISTS):
        texts += [start, cocofile.write_list(data[name], "id", f"{folder}/pieces/{name}")]
    cocofile.join_pieces(spark, [*texts, "\n], " + head[1:]], target)
    workdir.remove(spark, f"{folder}/pieces")
    return target


def coco_json(image_rows: DataFrame, annotations: DataFrame, categories: DataFrame, info: bool = False, pretty: bool = False) -> DataFrame:
    """One row with the data set as a COCO document. It is one value, as the format asks;
    write the three frames as tables where that is too large."""
    part = lambda df, order, name: df.agg(F.array_sort(F.collect_list(F.struct(order, F.struct(*df.columns).alias("v")))).alias("a")).select(F.transform("a", lambda x: x["v"]).alias(name))
    rows = part(image_rows, "id", "images").crossJoin(part(annotations, "id", "annotations")).crossJoin(part(categories, "id", "categories"))
    head = [default_info().alias("info"), F.array(F.struct(F.lit("").alias("name"))).alias("licenses")] if info else [F.lit("instances").alias("type")]
    return rows.select(F.to_json(F.struct("images", *head, "annotations", "categories"), {"pretty": str(pretty).lower()}).alias("value"))


def default_info() -> Column:
    today = F.date_format(F.current_date(), "yyyy-MM-dd")
    return F.struct(F.lit("").alias("description"), F.lit("1.0").alias("version"), F.substring(today, 1, 4).alias("year"), F.lit("").alias("contributor"), today.alias("date_created"))


def tool_json() -> Column:
    """The labelling tool's document of a row (image_key, width, height, depth, object)."""
    boxes = F.transform("object", lambda o: F.struct(o["name"].alias("name"), F.struct(*(o[c].alias(c) for c in ("xmin", "ymin", "xmax", "ymax"))).alias("bndbox")))
    path = F.concat(F.lit("JPEGImages/"), F.col("image_key").cast("string"), F.lit(".jpg"))
    return F.to_json(F.struct(path.alias("path"), F.struct(boxes.alias("object")).alias("outputs"), F.unix_timestamp().alias("time_labeled"), F.lit(True).alias("labeled"), F.struct("width", "height", "depth").alias("size")))


def yolo_text(rows: DataFrame, every: DataFrame | None = None) -> DataFrame:
    """(image_key, value) of rows (image_key, obj_ord, class_id, cx, cy, w, h); with every
    (image_key), an image without rows has an empty text."""
    line = F.concat_ws(" ", F.col("class_id").cast("string"), *(images.float_text(c) for c in ("cx", "cy", "w", "h")))
    made = rows.select("image_key", "obj_ord", line.alias("line")).groupBy("image_key").agg(F.array_sort(F.collect_list(F.struct("obj_ord", "line"))).alias("a"))
    made = made.select("image_key", F.concat(F.array_join(F.transform("a", lambda x: x["line"]), "\n"), F.lit("\n")).alias("value"))
    return made if every is None else every.select("image_key").join(made, "image_key", "left").fillna({"value": ""})


def write_files(rows: DataFrame, folder: str, name: str, value: str = "value") -> DataFrame:
    """A file for each row, named by its column `name`; returns (path, bytes) when run. A
    task that runs again writes the same files again."""

    def put(batches):
        import pyarrow as pa
        from pyarrow.fs import FileSystem

        for batch in batches:
            paths, sizes = [], []
            for n, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                fs, base = FileSystem.from_uri(folder)
                target = f"{base}/{n}"
                fs.create_dir(target.rpartition("/")[0], recursive=True)
                with fs.open_output_stream(target, compression=None) as f:
                    f.write((v or "").encode())
                paths.append(f"{folder}/{n}")
                sizes.append(len((v or "").encode()))
            yield pa.RecordBatch.from_pydict({"path": paths, "bytes": sizes})

    return rows.select(F.col(name).cast("string"), F.col(value).cast("string")).mapInArrow(put, "path string, bytes bigint")


def write_labels(objects: DataFrame, folder: str) -> None:
    """A text list of the classes, one a line, in alphabetical order."""
    objects.select("name").distinct().orderBy("name").select(F.col("name").alias("value")).coalesce(1).write.mode("overwrite").text(folder)


def write_lists(rows: DataFrame, folder: str, by: str = "split", column: str = "image_key", mode: str = "overwrite") -> None:
    """Text lists of a column, a folder for each split; mode append adds to lists."""
    rows.select(by, F.col(column).cast("string").alias("value")).write.mode(mode).partitionBy(by).text(folder)


def carry_out(manifest: DataFrame, move: bool = False) -> DataFrame:
    """Copies or moves each row's src to dst (URIs of one file system); returns (dst, done).
    A target that exists is never replaced: that row is not done, unless an earlier attempt of
    the task moved it, so that its source is gone, or copied it, so that both are as long."""

    def run(batches):
        import pyarrow as pa
        from pyarrow.fs import FileSystem, FileType

        for batch in batches:
            done = []
            for src, dst in zip(batch.column("src").to_pylist(), batch.column("dst").to_pylist()):
                fs, a = FileSystem.from_uri(src)
                b = FileSystem.from_uri(dst)[1]
                source, target = fs.get_file_info(a), fs.get_file_info(b)
                if source.type != FileType.File:
                    done.append(move and target.type == FileType.File)
                elif target.type != FileType.NotFound:
                    done.append(not move and target.size == source.size)
                else:
                    fs.create_dir(b.rpartition("/")[0], recursive=True)
                    (fs.move if move else fs.copy_file)(a, b)
                    done.append(True)
            yield pa.RecordBatch.from_pydict({"dst": batch.column("dst"), "done": done})

    return manifest.select("src", "dst").mapInArrow(run, "dst string, done boolean")


def patch_info(doc: DataFrame) -> DataFrame:
    """COCO documents with a default info where they have none."""
    return doc.withColumn("info", F.coalesce("info", default_info()))
