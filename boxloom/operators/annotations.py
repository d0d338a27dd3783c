"""Operators over annotation frames: filters, joins, ids, merges, splits, statistics.

images (image_key, width, height, ...), objects (image_key, obj_ord, name, difficult,
xmin, ymin, xmax, ymax), categories (category_id, name). Documents nest their objects
in one array column `object`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import boxes, names
from ..sources.workdir import shared_dir

#: Classes that the labelling-tool export leaves out, and those the co-occurrence filter wants.
DENIED = ("mask", "helmet", "hline", "head", "face")
DETECTOR = {"imgsz": 1280, "iou": 0.45, "conf": 0.4}


# Filters


def allow(objects: DataFrame, wanted: list[str]) -> DataFrame:
    """Objects of the wanted classes; an empty list keeps all."""
    return objects.where(F.col("name").isin(list(wanted))) if wanted else objects


def deny(objects: DataFrame, unwanted: list[str] = DENIED) -> DataFrame:
    return objects.where(~F.col("name").isin(list(unwanted))) if unwanted else objects


def filter_nested(docs: DataFrame, wanted: list[str]) -> DataFrame:
    """Within each document's object array, by trimmed name: documents left without objects stay."""
    return docs.withColumn("object", F.filter("object", lambda o: boxes.strip(o["name"]).isin(list(wanted))))


def trainable(objects: DataFrame, wanted: list[str]) -> DataFrame:
    """Wanted classes that are not difficult; a missing flag is 0. A flag that is there but
    is no number ends its image: that row and those after it go. Without obj_ord, only
    the row goes."""
    flag = F.coalesce(F.col("difficult").cast("string"), F.lit("0"))
    number = boxes.strip(flag).try_cast("int")
    rows = objects.withColumn("__flag", number)
    if dict(objects.dtypes)["difficult"] == "string" and "obj_ord" in objects.columns:
        broken = rows.where("__flag IS NULL").groupBy(F.col("image_key").alias("__key")).agg(F.min("obj_ord").alias("__end"))
        rows = rows.join(broken, F.col("image_key").eqNullSafe(F.col("__key")), "left").where("__end IS NULL OR obj_ord < __end")
    return rows.where(F.col("name").isin(list(wanted)) & (F.col("__flag") != 1)).select(*objects.columns)


def cooccurring(objects: DataFrame, needed: list[str], rider: str = "person") -> DataFrame:
    """Of images with a needed class: its rows of those classes, and the rider's, which
    come after them. `rank` is the order within the image."""
    has = F.max(F.col("name").isin(list(needed))).over(W.partitionBy("image_key"))
    rows = objects.withColumn("__has", has).where(F.col("__has") & F.col("name").isin([*needed, rider])).drop("__has")
    order = W.partitionBy("image_key").orderBy((F.col("name") == rider) & ~F.lit(rider in needed), "obj_ord")
    return rows.withColumn("rank", F.row_number().over(order))


def split_valid(objects: DataFrame, origin: int = 0, integer: bool = False) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) boxes, compared after the origin's shift."""
    box = boxes.corners_to_coco(*(F.col(c) for c in ("xmin", "ymin", "xmax", "ymax")), origin, integer)
    ok = F.coalesce((box["w"] > 0) & (box["h"] > 0), F.lit(False))
    return objects.where(ok), objects.where(~ok)


def require_valid(objects: DataFrame, origin: int = 0, integer: bool = False) -> DataFrame:
    """objects; a box without extent, compared after the origin's shift, fails the query."""
    box = boxes.corners_to_coco(*(F.col(c) for c in ("xmin", "ymin", "xmax", "ymax")), origin, integer)
    ok = F.coalesce((box["w"] > 0) & (box["h"] > 0), F.lit(False))
    return objects.withColumn("obj_ord", boxes.require(ok, F.col("obj_ord"), "a box has no extent"))


# Joins


def with_category(objects: DataFrame, categories: DataFrame, strict: bool = False, duplicates: str = "last") -> DataFrame:
    """objects with category_id. Of a label listed twice, the last id or the first counts.
    strict: an unknown label fails the query; else its id is null."""
    pick = F.max("category_id") if duplicates == "last" else F.min("category_id")
    known = categories.groupBy("name").agg(pick.alias("category_id"))
    rows = objects.join(known, "name", "left")
    if strict:
        rows = rows.withColumn("category_id", boxes.require(F.col("category_id").isNotNull(), F.col("category_id"), "unknown label"))
    return rows


def with_name(annotations: DataFrame, categories: DataFrame, default: str | None = None) -> DataFrame:
    """annotations with the name of category_id, the first listed where it is listed twice:
    at the least `pos` if categories have one, else in the order of their rows."""
    at = F.col("pos") if "pos" in categories.columns else F.monotonically_increasing_id()
    known = categories.select("category_id", "name", at.alias("__at")).groupBy("category_id").agg(F.min_by("name", "__at").alias("name"))
    rows = annotations.join(known, "category_id", "left")
    return rows if default is None else rows.withColumn("name", F.coalesce("name", F.lit(default)))


def missing(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows of left without a partner: images that lack annotations."""
    return left.join(right.select(key), key, "left_anti")


def matching(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows of left with a partner, once each: annotations of duplicate images."""
    return left.join(right.select(key), key, "left_semi")


def empty_documents(images: DataFrame) -> DataFrame:
    """Annotations without objects for images that have none."""
    return images.withColumn("object", F.array().cast("array<struct<name:string,xmin:double,ymin:double,xmax:double,ymax:double>>"))


def merge_documents(left: DataFrame, right: DataFrame, key: str = "image_key") -> DataFrame:
    """left's documents with right's objects after their own; right's other documents go.
    The header is left's, but a depth becomes 3."""
    other = right.select(key, F.col("object").alias("__more"))
    joined = left.join(other, key, "left")
    return joined.withColumn("object", F.concat("object", F.coalesce("__more", F.array().cast(left.schema["object"].dataType)))).drop("__more").withColumns({"depth": F.lit(3)} if "depth" in left.columns else {})


def listed_name(rows: DataFrame, listed: DataFrame) -> DataFrame:
    """rows (image_key, file_name) with the listed name (stem, name, pos) of the image where
    the recorded one ends in .xml: of equal stems the last listed; none leaves it as it is."""
    last = listed.groupBy(F.col("stem").alias("__stem")).agg(F.max_by("name", "pos").alias("__name"))
    own = rows.join(last, F.col("image_key") == F.col("__stem"), "left")
    name = F.when(F.col("file_name").endswith(".xml"), F.coalesce("__name", "file_name")).otherwise(F.col("file_name"))
    return own.withColumn("file_name", name).drop("__stem", "__name")


def pick_image(texts: DataFrame, images: DataFrame, order: tuple[str, ...] = (".jpg", ".jpeg", ".png")) -> DataFrame:
    """texts (stem) with the image (stem, ext) of the first extension in order; no image, no row."""
    rank = F.array_position(F.array(*map(F.lit, order)), F.col("ext"))
    best = images.where(rank > 0).groupBy("stem").agg(F.min_by("ext", rank).alias("ext"))
    return texts.join(best, "stem")


# Ids


def with_checkpoints(spark: SparkSession) -> None:
    """Sets a checkpoint folder if the session has none, in the shared folder."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(spark))


def numbered(rows: DataFrame, order: list[str], column: str, start: int = 1, parts: int | None = None) -> DataFrame:
    """rows with consecutive numbers along order, which must be unique for a stable result.

    No task sees all rows: ranges of the order are numbered each, and the numbers of
    rows in the ranges before them, one small row for each range, are added. The ranges
    are checkpointed, so that the counts and the rows are of the same ranges."""
    spark = rows.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("__id", F.monotonically_increasing_id())
    with_checkpoints(spark)
    dealt = dealt.checkpoint()
    dealt = dealt.withColumns({"__part": F.shiftright("__id", 33), "__row": F.col("__id").bitwiseAND((1 << 33) - 1)})
    sizes = dealt.groupBy("__part").agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1))
    base = sizes.select("__part", F.coalesce(before, F.lit(0)).alias("__base"))
    return dealt.join(F.broadcast(base), "__part").withColumn(column, F.col("__base") + F.col("__row") + start).drop("__id", "__part", "__row", "__base")


def first_seen(objects: DataFrame, order: list[str], start: int = 1, group: str | None = None) -> DataFrame:
    """Categories numbered by first appearance along order, and with group (a rank of
    data sets that share the numbering) the first of them that has each."""
    cols = ([group] if group else []) + order
    seen = objects.groupBy("name").agg(F.min(F.struct(*cols)).alias("at"))
    keys = [F.col("at." + c).alias("__" + c) for c in cols]
    ranked = numbered(seen.select("name", *keys), ["__" + c for c in cols], "category_id", start, 1)
    return ranked.select("name", "category_id", *([F.col("__" + group).alias(group)] if group else []))


# Splits


def split_points(n: Column, parts: list[float]) -> list[Column]:
    """Cut points floor(n * p1), floor(n * (p1 + p2)), ... in doubles."""
    sums, total = [], 0.0
    for p in parts[:-1]:
        total += p
        sums.append(F.floor(n * F.lit(total)))
    return sums


def split_by_share(images: DataFrame, key: str, shares: dict[str, float], seed: int = 0, order: Column | None = None) -> DataFrame:
    """images with `split`: a seeded order by digest is cut at the shares of the count.

    order, a column, cuts the listing order instead. What is left over by rounding is in
    the last split, also where its share is 0: no image is lost."""
    if abs(sum(shares.values()) - 1) > 1e-5 or any(s < 0 for s in shares.values()):
        raise ValueError("shares are at least 0 and sum to 1")
    ordered = images.withColumn("__o", order if order is not None else F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))))
    ranked = numbered(ordered, ["__o", key], "__r", 0)
    n = images.agg(F.count("*").alias("__n"))
    rows = ranked.crossJoin(F.broadcast(n))  # one row
    cuts = split_points(F.col("__n"), list(shares.values()))
    split = F.lit(list(shares)[-1])
    for name, cut in reversed(list(zip(shares, cuts))):
        split = F.when(F.col("__r") < cut, name).otherwise(split)
    return rows.withColumn("split", split).drop("__o", "__r", "__n")


def split_totals(images: DataFrame) -> DataFrame:
    """One row for each split (n of total)."""
    counts = images.groupBy("split").agg(F.count("*").alias("n"))
    return counts.crossJoin(F.broadcast(images.agg(F.count("*").alias("total"))))  # one row


def append_lists(base: DataFrame, more: DataFrame) -> DataFrame:
    """All rows of both, repeats kept."""
    return base.unionByName(more)


# Statistics


def class_counts(objects: DataFrame, *by: str) -> DataFrame:
    return objects.groupBy(*by, boxes.strip(F.col("name")).alias("name")).agg(F.count("*").alias("n"))


def labels(objects: DataFrame) -> DataFrame:
    return objects.select("name").distinct()


def box_sizes(objects: DataFrame) -> DataFrame:
    return objects.select("image_key", "obj_ord", (F.col("xmax") - F.col("xmin")).alias("box_w"), (F.col("ymax") - F.col("ymin")).alias("box_h"))


def outcome(rows: DataFrame, ok: Column) -> DataFrame:
    return rows.agg(F.count_if(ok).alias("succeeded"), F.count_if(~ok).alias("failed"))


# Nesting


def nest(objects: DataFrame, fields: tuple[str, ...] = ("name", "xmin", "ymin", "xmax", "ymax")) -> DataFrame:
    """One row for each image, its objects in order in the array `object`."""
    made = F.collect_list(F.struct("obj_ord", *fields))
    return objects.groupBy("image_key").agg(F.transform(F.array_sort(made), lambda o: F.struct(*(o[f].alias(f) for f in fields))).alias("object"))


def unnest(docs: DataFrame) -> DataFrame:
    return docs.select("image_key", F.posexplode("object").alias("__p", "o")).select("image_key", (F.col("__p") + 1).alias("obj_ord"), "o.*")


def detector_objects(results: DataFrame, classes: DataFrame, ignored: list[str] = ()) -> DataFrame:
    """Detections (image_key, obj_ord, cls, x1 .. y2, conf) as objects: corners truncated,
    conf to three places, classes by id, ignored ones left out."""
    rows = results.join(classes.select(F.col("category_id").alias("cls"), "name"), "cls", "left")
    rows = deny(rows, list(ignored))
    return rows.select("image_key", "obj_ord", "name", *(F.col(c).cast("int").alias(n) for c, n in zip(("x1", "y1", "x2", "y2"), ("xmin", "ymin", "xmax", "ymax"))), F.round("conf", 3).alias("conf"))


def detect(files: DataFrame, predict, ignored: list[str] = ()) -> DataFrame:
    """Runs predict (an iterator of pandas frames (path, content) to frames of
    detections) once for each partition: the hook for a model of the caller's own."""
    found = files.select("path", "content").mapInPandas(predict, "path string, obj_ord int, name string, x1 double, y1 double, x2 double, y2 double, conf double")
    rows = deny(found, list(ignored))
    return rows.select(names.stem(names.basename(F.col("path"))).alias("image_key"), "obj_ord", "name", *(F.col(c).cast("int").alias(n) for c, n in zip(("x1", "y1", "x2", "y2"), ("xmin", "ymin", "xmax", "ymax"))), F.round("conf", 3).alias("conf"))
