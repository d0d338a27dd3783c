"""Whole conversions between formats: frames in, the frames of the other format out.

A data set in COCO form is a dict of three frames, images, annotations and categories,
whose rows are the records of the format; writers.coco_json() nests them. Readers give
the frames in; `folder to file` needs no more than a reader, one of these and a writer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import boxes, images, names
from ..sources import readers
from . import annotations as A

CORNERS = ("xmin", "ymin", "xmax", "ymax")
#: Fixed value: the supercategory of categories found in drawn shapes; of listed ones it is none.
COMPONENT = "component"


def annotation_record(box: dict[str, Column], segmentation: Column | None = None, ignore: bool = True) -> list[Column]:
    """bbox, area, iscrowd and segmentation, and unless left out ignore, of a box."""
    outline = F.array().cast("array<array<double>>") if segmentation is None else segmentation
    flags = [F.lit(0).alias("iscrowd"), *([F.lit(0).alias("ignore")] if ignore else [])]
    return [F.array(*(box[c].cast("double") for c in "xywh")).alias("bbox"), box["area"].cast("double").alias("area"), *flags, outline.cast("array<array<double>>").alias("segmentation")]


def category_records(categories: DataFrame, supercategory: str = "none") -> DataFrame:
    return categories.select(F.col("category_id").alias("id"), "name", F.lit(supercategory).alias("supercategory"))


def image_record(by_path: bool = True) -> Column:
    """The file name of a VOC document: its own stem with the extension of a recorded name.

    by_path: of the recorded path, or without one of the recorded filename. Else of the
    filename if there is a path, and .jpg if there is none."""
    stem = names.stem(names.basename(F.col("src_path")))
    recorded = F.coalesce("path", "filename") if by_path else F.when(F.col("path").isNotNull(), F.col("filename")).otherwise(".jpg")
    own = names.basename(recorded)
    return F.concat(stem, F.when(own == ".jpg", ".jpg").otherwise(names.extension(own)))


def voc_to_coco(docs: DataFrame, categories: DataFrame, numeric_ids: bool = False, by_path: bool = True, integer: bool = True) -> dict[str, DataFrame]:
    """docs (of readers.voc) and categories (name, category_id) as a COCO data set.

    Documents that do not parse are left out; an unknown label or a box without extent
    fails the query. Image ids are stems, or with numeric_ids the first digits in them.
    Annotations are numbered from 1 by file and place. integer: corners truncated, the
    near ones one less; else as they are, without ignore."""
    docs = docs.where("corrupt IS NULL")
    key = names.stem(names.basename(F.col("src_path")))
    id_of = names.digits if numeric_ids else (lambda c: c)
    image_rows = docs.select(id_of(key).alias("id"), image_record(by_path).alias("file_name"), *(boxes.trunc_int(F.col(f"size.{c}")).alias(c) for c in ("width", "height")))
    rows = A.require_valid(A.with_category(readers.voc_objects(docs), categories, strict=True), int(integer), integer)
    rows = A.numbered(rows, ["image_key", "obj_ord"], "id", 1)
    box = boxes.corners_to_coco(*(F.col(c) for c in CORNERS), int(integer), integer)
    rows = rows.select("id", id_of(F.col("image_key")).alias("image_id"), "category_id", *annotation_record(box, ignore=integer))
    return {"images": image_rows, "annotations": rows, "categories": category_records(categories)}


def shapes_to_coco(shapes: DataFrame, listed: DataFrame | None = None, raster: bool = True) -> dict[str, DataFrame]:
    """Drawn shapes (of readers.labelme or readers.cityscapes) as a COCO data set.

    Images are numbered from 1 in the order of their files, shapes over all files from 1;
    a shape that is neither polygon nor rectangle has no row but uses up its number and
    registers its label. Categories are numbered by first appearance. listed (stem,
    file_name): the images to convert, under their listed names; one without a document
    fails the query. raster: polygon boxes by painted pixels, else by vertices."""
    stem = names.stem(names.basename(F.col("src_path")))
    rows = shapes.withColumn("stem", stem)
    if listed is not None:
        named = listed.select("stem", F.col("file_name").alias("__listed"))
        rows = named.join(rows, "stem", "left")
        rows = rows.withColumn("src_path", boxes.require(F.col("src_path").isNotNull(), F.col("src_path"), "a listed image has no document", "string"))
        rows = rows.withColumn("file_name", F.coalesce("file_name", "__listed")).drop("__listed")
    head = rows.groupBy("src_path").agg(*(F.first(c).alias(c) for c in ("file_name", "width", "height")))
    head = A.numbered(head, ["src_path"], "image_id", 1)
    own = A.numbered(rows.where("shape_ord IS NOT NULL"), ["src_path", "shape_ord"], "id", 1)
    categories = A.first_seen(own.withColumnRenamed("label", "name"), ["src_path", "shape_ord"])
    own = own.where("usable").join(head.select("src_path", "image_id"), "src_path").join(F.broadcast(categories.withColumnRenamed("name", "label")), "label")
    corner = lambda k, i: F.get(F.get("points", k), i)
    rectangle = boxes.rectangle_to_coco(corner(0, 0), corner(0, 1), corner(1, 0), corner(1, 1))
    outline = boxes.polygon_box(F.col("points"), F.col("width"), F.col("height"))
    if raster:
        own = own.withColumn("__box", images.raster_box("points", "width", "height"))
        outline |= {c: F.col(f"__box.{c}") for c in "xywh"} | {"area": F.col("__box.w") * F.col("__box.h")}
    is_box = F.col("shape_type") == "rectangle"
    box = {c: F.when(is_box, rectangle[c].cast("double")).otherwise(outline[c].cast("double")) for c in ("x", "y", "w", "h", "area")}
    made = own.select("id", "image_id", "category_id", *annotation_record(box, F.when(is_box, rectangle["segmentation"]).otherwise(outline["segmentation"]), ignore=False))
    image_rows = head.select(F.col("image_id").alias("id"), "file_name", "width", "height")
    return {"images": image_rows, "annotations": made, "categories": category_records(categories, COMPONENT)}


def faces_to_coco(faces: DataFrame, sizes: DataFrame, prefix: str = "") -> dict[str, DataFrame]:
    """Face records (of readers.parse_wider) and sizes (file_name, width, height) of the
    images that exist. Image ids count all records from 0, annotations those of existing
    images from 1; the only category is human_face, 0."""
    known = sizes.select(F.col("file_name").alias("__name"), "width", "height")
    heads = faces.select("record", "file_name").distinct().join(known, F.col("file_name") == F.col("__name"))
    image_rows = heads.select(F.col("record").alias("id"), F.concat(F.lit(prefix), F.col("file_name")).alias("file_name"), "width", "height")
    rows = A.numbered(faces.join(heads.select(F.col("record").alias("__r")).distinct(), F.col("record") == F.col("__r"), "left_semi"), ["record", "face"], "id", 1)
    box = {c: F.col(c) for c in "xywh"} | {"area": F.col("w") * F.col("h")}
    more = ("blur", "expression", "illumination", "invalid", "occlusion", "pose")
    made = rows.select("id", F.col("record").alias("image_id"), F.lit(0).cast("bigint").alias("category_id"), *annotation_record(box), *more).drop("segmentation")
    categories = faces.sparkSession.createDataFrame([(0, "human_face", "none")], "id bigint, name string, supercategory string")
    return {"images": image_rows, "annotations": made, "categories": categories}


def yolo_to_voc(lines: DataFrame, stems: DataFrame, image_files: DataFrame, classes: DataFrame, order: tuple[str, ...] = (".jpg", ".jpeg", ".png")) -> DataFrame:
    """One VOC document for each of stems (stem) that has an image: (stem, file_name, width,
    height, depth, object), for writers.element_voc_xml().

    lines: of readers.yolo; image_files (stem, ext, width, height, depth), of which the
    first extension in order counts; classes (class_id text, name), unknown where missing."""
    chosen = A.pick_image(stems.select("stem"), image_files, order).join(image_files, ["stem", "ext"])
    rows = lines.join(chosen.select("stem", "width", "height"), "stem").join(F.broadcast(classes), "class_id", "left")
    corners = boxes.yolo_to_corners(*(F.col(c) for c in ("cx", "cy", "w", "h", "width", "height")))
    rows = rows.select(F.col("stem").alias("image_key"), F.col("line_no").alias("obj_ord"), F.coalesce("name", F.lit("unknown")).alias("name"), *(c.alias(n) for n, c in corners.items()))
    nested = A.nest(rows).withColumnRenamed("image_key", "stem")
    docs = chosen.join(nested, "stem", "left").withColumn("object", F.coalesce("object", F.array().cast(nested.schema["object"].dataType)))
    return docs.select("stem", F.concat("stem", "ext").alias("file_name"), "width", "height", "depth", "object")


def coco_to_voc(data: dict[str, DataFrame]) -> DataFrame:
    """One VOC document for each image of a COCO data set (of readers.coco) that has
    annotations: (image_key, file_name, width, height, object). A category that is not
    listed has a null name."""
    known = data["categories"].select(F.col("id").alias("category_id"), "name")
    rows = A.with_name(data["annotations"].withColumnRenamed("id", "obj_ord"), known)
    corners = boxes.coco_to_corners(*(F.get("bbox", k) for k in range(4)))
    rows = rows.select(F.col("image_id").alias("image_key"), "obj_ord", "name", *(c.alias(n) for n, c in corners.items()))
    heads = data["images"].select(F.col("id").alias("image_key"), "file_name", F.col("width").cast("int").alias("width"), F.col("height").cast("int").alias("height"))
    return heads.join(A.nest(rows), "image_key")
