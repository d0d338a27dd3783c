"""Scans of annotation files. Schemas are explicit: documents with no, one or many
objects read alike, and leaf text is typed in the next projection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql import types as T

from ..functions import boxes, images, names
from . import archives, cocofile

BOX = "struct<xmin:string,ymin:string,xmax:string,ymax:string>"
VOC = (
    "folder string, filename string, path string, source struct<database:string>, size struct<width:string,height:string,depth:string>, segmented string, "
    f"object array<struct<name:string,pose:string,truncated:string,occluded:string,difficult:string,bndbox:{BOX}>>"
)
COCO = (
    "images array<struct<id:string,file_name:string,width:double,height:double>>, "
    "annotations array<struct<id:bigint,image_id:string,category_id:bigint,bbox:array<double>,area:double,iscrowd:int,ignore:int,segmentation:array<array<double>>>>, "
    "categories array<struct<id:bigint,name:string,supercategory:string>>, info struct<description:string,version:string,year:string,contributor:string,date_created:string>"
)
LABELME = "imageHeight int, imageWidth int, imagePath string, shapes array<struct<label:string,shape_type:string,points:array<array<double>>>>"
CITYSCAPES = "imgHeight int, imgWidth int, objects array<struct<label:string,polygon:array<array<double>>>>"
TOOL = "path string, time_labeled bigint, labeled boolean, size struct<width:int,height:int,depth:int>, outputs struct<object:array<struct<name:string,bndbox:struct<xmin:double,ymin:double,xmax:double,ymax:double>>>>"
FACE = ("x", "y", "w", "h", "blur", "expression", "illumination", "invalid", "occlusion", "pose")


def _options(recursive: bool) -> dict[str, str]:
    return {"recursiveFileLookup": str(recursive).lower()}


def files(spark: SparkSession, path: str, pattern: str = "*", recursive: bool = True) -> DataFrame:
    """path, length, modificationTime, content: content is read only where it is used."""
    return spark.read.format("binaryFile").options(pathGlobFilter=pattern, **_options(recursive)).load(path)


def documents(spark: SparkSession, path: str, ending: str, archived: bool = False) -> DataFrame:
    """(path, content) of the files with the ending below path; archived: of those in its archives."""
    return archives.read_archives(spark, path, ending) if archived else files(spark, path, "*" + ending).select("path", "content")


def voc(spark: SparkSession, path: str, charset: str | None = "UTF-8", archived: bool = False) -> DataFrame:
    """One row for each XML file, `corrupt` set for what does not parse or decode. charset None: guessed for each file."""
    raw = documents(spark, path, ".xml", archived)
    code = F.lit(charset) if charset else images.guess_charset("content")
    # the declaration no longer holds for the decoded text
    text = F.regexp_replace(images.decoded("content", code), r"^\s*<\?xml[^>]*\?>", "")
    return parse_voc(raw.select(F.col("path").alias("src_path"), F.coalesce(text, F.lit("not decoded")).alias("xml")))


def parse_voc(rows: DataFrame) -> DataFrame:
    """rows (src_path, xml) with the document's fields, and `corrupt` for text that is no such document."""
    options = {"rowTag": "annotation", "ignoreSurroundingSpaces": "false", "columnNameOfCorruptRecord": "corrupt", "mode": "PERMISSIVE"}
    doc = F.from_xml("xml", VOC + ", corrupt string", options)
    return rows.withColumn("__d", doc).select("src_path", "__d.*")


def voc_images(docs: DataFrame, lenient: bool = True) -> DataFrame:
    """images of VOC documents; missing sizes default to 1920 x 1080 x 3."""
    size = (lambda c, d: boxes.or_default(F.col(c), d)) if lenient else (lambda c, d: boxes.strict_int(F.col(c)))
    return docs.select(names.stem(names.basename(F.col("src_path"))).alias("image_key"), F.col("filename").alias("file_name"), F.col("path"), size("size.width", 1920).alias("width"), size("size.height", 1080).alias("height"), boxes.or_default(F.col("size.depth"), 3).alias("depth"), "src_path")


def voc_objects(docs: DataFrame) -> DataFrame:
    rows = docs.select(names.stem(names.basename(F.col("src_path"))).alias("image_key"), F.posexplode("object").alias("p", "o"))
    return rows.select("image_key", (F.col("p") + 1).alias("obj_ord"), "o.name", F.coalesce(boxes.strip(F.col("o.difficult")), F.lit("0")).alias("difficult"), *(F.col(f"o.bndbox.{c}").cast("double").alias(c) for c in ("xmin", "ymin", "xmax", "ymax")))


def _json(spark: SparkSession, path: str, schema: str, archived: bool = False) -> DataFrame:
    if archived:
        text = F.regexp_replace(F.col("content").cast("string"), "^\ufeff", "")
        doc = F.from_json(text, schema + ", corrupt string", {"columnNameOfCorruptRecord": "corrupt"})
        return documents(spark, path, ".json", True).select(F.col("path").alias("src_path"), doc.alias("__d")).select("__d.*", "src_path")
    return spark.read.schema(schema + ", corrupt string").options(multiLine="true", columnNameOfCorruptRecord="corrupt", recursiveFileLookup="true", pathGlobFilter="*.json").json(path).withColumn("src_path", F.col("_metadata.file_path"))


def coco(spark: SparkSession, path: str, numeric: bool | None = None) -> dict[str, DataFrame]:
    """images, annotations and categories of a COCO file. Files have image ids as numbers or
    as text: they are read as text, and made bigint if numeric, or if that is None and a look
    at the images finds only whole numbers without leading zeros.

    A file larger than cocofile.WHOLE bytes is never one value: its records are found range by range."""
    sizes = files(spark, path, "*.json").select("path", "length").collect()
    if any(f.length > cocofile.WHOLE for f in sizes) and all(cocofile.reachable(f.path) for f in sizes):
        data = cocofile.records(spark, [tuple(f) for f in sizes], T.StructType.fromDDL(COCO))
    else:
        doc = _json(spark, path, COCO)
        data = {k: doc.select(F.inline(k)) for k in cocofile.LISTS}
    if numeric is None:
        numeric = bool(data["images"].agg(F.bool_and(F.col("id").rlike("^(0|[1-9][0-9]{0,17})$"))).first()[0])
    if not numeric:
        return data
    return data | {"images": data["images"].withColumn("id", F.col("id").cast("bigint")), "annotations": data["annotations"].withColumn("image_id", F.col("image_id").cast("bigint"))}


def labelme(spark: SparkSession, path: str, archived: bool = False) -> DataFrame:
    """A row for each shape; a shape that is no polygon or rectangle keeps its place, so that ids can count it."""
    doc = _json(spark, path, LABELME, archived)
    rows = doc.select("src_path", F.col("imageWidth").alias("width"), F.col("imageHeight").alias("height"), names.basename_any(F.col("imagePath")).alias("file_name"), F.posexplode_outer("shapes").alias("shape_ord", "s"))
    return rows.select("src_path", "file_name", "width", "height", "shape_ord", "s.label", "s.shape_type", "s.points", F.col("s.shape_type").isin("polygon", "rectangle").alias("usable"))


def cityscapes(spark: SparkSession, path: str, listed: DataFrame | None = None, archived: bool = False) -> DataFrame:
    """A row for each polygon. The document does not name its image: file_name is that of
    listed (stem, file_name), or null without it."""
    doc = _json(spark, path, CITYSCAPES, archived).withColumn("stem", names.stem(names.basename(F.col("src_path"))))
    doc = doc.withColumn("file_name", F.lit(None).cast("string")) if listed is None else doc.join(listed.select("stem", "file_name"), "stem", "left")
    rows = doc.select("src_path", "file_name", F.col("imgWidth").alias("width"), F.col("imgHeight").alias("height"), F.posexplode_outer("objects").alias("shape_ord", "s"))
    return rows.select("src_path", "file_name", "width", "height", "shape_ord", "s.label", F.lit("polygon").alias("shape_type"), F.col("s.polygon").alias("points"), F.lit(True).alias("usable"))


def tool(spark: SparkSession, path: str, archived: bool = False) -> DataFrame:
    return _json(spark, path, TOOL, archived)


def lines_of(rows: DataFrame, key: str, text: str) -> DataFrame:
    """(key, line_no from 0, line) of each text."""
    return rows.select(key, F.posexplode(F.split(text, "\n")).alias("line_no", "line"))


def parse_yolo(rows: DataFrame, key: str = "stem", text: str = "value") -> DataFrame:
    """rows (stem, value) to (stem, line_no, class_id, cx, cy, w, h): lines that have not five tokens, or no numbers, go."""
    tokens = lines_of(rows, key, text).select(key, "line_no", F.split(boxes.strip(F.col("line")), r"\s+").alias("t"))
    number = [F.get("t", k).try_cast("double").alias(n) for k, n in enumerate(("cx", "cy", "w", "h"), 1)]
    return tokens.where(F.size("t") == 5).select(key, "line_no", F.get("t", 0).alias("class_id"), *number).dropna(subset=["cx", "cy", "w", "h"])


def yolo(spark: SparkSession, path: str, archived: bool = False) -> DataFrame:
    if archived:
        raw = documents(spark, path, ".txt", True)
        return parse_yolo(raw.select(names.stem(names.basename(F.col("path"))).alias("stem"), F.col("content").cast("string").alias("value")))
    raw = spark.read.option("pathGlobFilter", "*.txt").text(path, wholetext=True)
    return parse_yolo(raw.select(names.stem(names.basename(F.col("_metadata.file_path"))).alias("stem"), "value"))


def parse_wider(rows: DataFrame, key: str = "key", text: str = "value") -> DataFrame:
    """Records of a name line, a count n and n lines of ten numbers (one placeholder for
    n = 0) to (key, record, file_name, face, x .. pose). Records are numbered from 0, also those without faces.

    A record starts at a line that holds a file name, so its lines are found by a running count."""
    own = lines_of(rows, key, text).where(boxes.strip(F.col("line")) != "")
    by = W.partitionBy(key).orderBy("line_no")
    own = own.withColumn("record", F.sum(F.col("line").rlike(r"[A-Za-z]").cast("int")).over(by) - 1)
    within = W.partitionBy(key, "record").orderBy("line_no")
    own = own.withColumns({"face": F.row_number().over(within) - 3, "file_name": F.first("line").over(within), "n": F.nth_value("line", 2).over(within.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)).cast("int")})
    own = own.where((F.col("face") >= 0) & (F.col("face") < F.col("n"))).withColumn("t", F.split(boxes.strip(F.col("line")), r"\s+"))
    return own.select(key, F.col("record").cast("bigint").alias("record"), boxes.strip(F.col("file_name")).alias("file_name"), "face", *(F.get("t", k).cast("int").alias(c) for k, c in enumerate(FACE)))


def wider(spark: SparkSession, path: str) -> DataFrame:
    return parse_wider(spark.read.text(path, wholetext=True).select(F.lit(path).alias("key"), "value"))


def label_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Labels between white space, ids from 1: a label of two words is two labels."""
    rows = spark.read.text(path, wholetext=True).select(F.posexplode(F.split(boxes.strip(F.col("value")), r"\s+")).alias("p", "name"))
    return rows.select("name", (F.col("p") + 1).cast("bigint").alias("category_id"))


def label_lines(spark: SparkSession, path: str) -> DataFrame:
    """One label a line, ids from 0; a blank line is the label ''. The line end at the end of the file is none."""
    rows = spark.read.text(path, wholetext=True).select(F.posexplode(F.split(F.regexp_replace("value", r"\n\z", ""), "\n")).alias("p", "name"))
    return rows.select(boxes.strip(F.col("name")).alias("name"), F.col("p").cast("bigint").alias("category_id"))


def id_list(spark: SparkSession, path: str, last_token: bool = False) -> DataFrame:
    """(pos, image_key) of a list, a line each, without a .xml ending; last_token: of lines like `path id`."""
    rows = spark.read.text(path, wholetext=True).select(F.posexplode(F.split(F.regexp_replace("value", r"\n\z", ""), "\n")).alias("pos", "v"))
    v = boxes.strip(F.col("v"))
    v = F.element_at(F.split(v, " "), -1) if last_token else v
    return rows.select("pos", F.regexp_replace(v, r"\.xml$", "").alias("image_key"))


def annotation_paths(ids: DataFrame, folder: str, ext: str = "xml") -> DataFrame:
    return ids.select("pos", F.concat_ws("", F.lit(folder.rstrip("/") + "/"), "image_key", F.lit("." + ext)).alias("path"))


def path_list(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True).select(F.posexplode(F.split(boxes.strip(F.col("value")), r"\s+")).alias("pos", "path"))


def image_sizes(rows: DataFrame, channels: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(readable, rejected) of files(): with width, height and depth from the header.
    channels: the depth of all images once they are decoded to so many, such as 3."""
    sized = rows.select("path", images.dimensions("content").alias("s")).select("path", "s.*")
    if channels:
        sized = sized.withColumn("depth", F.when(F.col("width").isNotNull(), channels))
    return sized.where("width IS NOT NULL"), sized.where("width IS NULL").select("path")
