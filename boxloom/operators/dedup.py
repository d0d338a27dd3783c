"""Exact duplicate files: groups by digest, which one stays, and where the others go."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import names
from .annotations import numbered


def eligible(files: DataFrame, least: int = 4096) -> DataFrame:
    """Files (path, length, ...) of the least size whose size occurs more than once: only
    they can have a copy. A first pass over sizes needs no content."""
    rows = files.where(F.col("length") >= least)
    often = rows.groupBy("length").count().where("count > 1").select("length")
    return rows.join(often, "length", "left_semi")


def groups(files: DataFrame, digest: Column) -> DataFrame:
    """(digest, n, first_path, last_path) of contents that several files have."""
    rows = files.select("path", digest.alias("digest"))
    return rows.groupBy("digest").agg(F.count("*").alias("n"), F.min("path").alias("first_path"), F.max("path").alias("last_path")).where("n > 1")


def group_paths(files: DataFrame, digest: Column) -> DataFrame:
    """groups() with the sorted list of all `paths`: a row holds a whole group, so this is for reports."""
    rows = files.select("path", digest.alias("digest"))
    return rows.groupBy("digest").agg(F.count("*").alias("n"), F.sort_array(F.collect_list("path")).alias("paths")).where("n > 1")


def ranked(files: DataFrame, keep: str = "first", stamp: str = "modificationTime") -> DataFrame:
    """files (digest, path, ...) of repeated digests with `kept`: the first path, the last,
    or (any other mode) the oldest, by path among equals.

    The file that stays is found by an aggregate with partial sums and joined back, so
    no task sorts the files of one digest."""
    best = {"first": F.min(F.struct("path")), "last": F.max(F.struct("path"))}.get(keep, F.min(F.struct(stamp, "path")))
    stay = files.groupBy("digest").agg(best["path"].alias("__stay"), F.count("*").alias("n")).where("n > 1")
    return files.join(stay, "digest").withColumn("kept", F.col("path") == F.col("__stay")).drop("__stay", "n")


def destinations(moved: DataFrame, dest: Column, taken: DataFrame | None = None) -> DataFrame:
    """moved (path) with `dest`, made unique: of equal names the first path keeps it, the
    next ones get _1, _2, ... before the extension. taken (dest) lists names that exist
    already. A number is passed over if it makes a taken name or one that another file
    has by itself, so no two files get one name, and none a taken one.

    Names are numbered over ranges of (name, path), so no task needs all files of a name."""
    rows = moved.withColumn("__d", dest)
    stem = lambda c: F.regexp_replace(c, r"^(.*?)(\.[^./]*)?$", "$1")
    ext = lambda c: F.regexp_extract(c, r"(\.[^./]*)$", 1)
    planned = rows.select("__d").distinct()
    used = planned if taken is None else planned.union(taken.select("dest")).distinct()
    # numbers that a name cannot use, by the name that they belong to
    parts = used.select(F.concat(F.regexp_replace(stem(F.col("__d")), r"_[1-9][0-9]{0,17}$", ""), ext(F.col("__d"))).alias("__d"), F.regexp_extract(stem(F.col("__d")), r"_([1-9][0-9]{0,17})$", 1).alias("__k"))
    barred = parts.where("__k != ''").groupBy("__d").agg(F.sort_array(F.collect_set(F.col("__k").cast("bigint"))).alias("__barred"))
    there = (taken.select(F.col("dest").alias("__d")) if taken is not None else planned.limit(0)).distinct().withColumn("__there", F.lit(1))
    ordered = numbered(rows, ["__d", "path"], "__n", 0)
    first = ordered.groupBy("__d").agg(F.min("__n").alias("__first")).join(barred, "__d", "left").join(there, "__d", "left")
    placed = ordered.join(first, "__d")
    k = F.col("__n") - F.col("__first") + F.coalesce("__there", F.lit(0))
    free = F.aggregate(F.coalesce("__barred", F.array().cast("array<bigint>")), k, lambda c, r: F.when(r <= c, c + 1).otherwise(c))
    made = F.when(k == 0, F.col("__d")).otherwise(F.concat(stem(F.col("__d")), F.lit("_"), free.cast("string"), ext(F.col("__d"))))
    return placed.withColumn("dest", made).select(*moved.columns, "dest")


def manifest(files: DataFrame, source: str, folder: str, grouped: bool = False, taken: DataFrame | None = None) -> DataFrame:
    """(src, dst) of the files of ranked() that do not stay: below folder, under their path
    relative to source, or grouped in group_ and the digest's first eight letters."""
    moved = files.where("NOT kept").select("path", "digest")
    own = names.relative(F.col("path"), source)
    name = F.concat(F.lit("group_"), F.substring("digest", 1, 8), F.lit("/"), names.basename(own)) if grouped else own
    placed = destinations(moved, F.concat(F.lit(folder.rstrip("/") + "/"), name), taken)
    return placed.select(F.col("path").alias("src"), F.col("dest").alias("dst"))


def deduplicate(files: DataFrame, source: str, folder: str, least: int = 4096, fast: bool = True, threshold: int = 0, keep: str = "first", grouped: bool = False) -> dict[str, DataFrame]:
    """Everything about the duplicates among files (path, length, modificationTime, content):
    ranked, manifest and report. fast: digests of samples, of files over the threshold."""
    digest = names.sampled_digest(F.col("content"), threshold, "binary") if fast else names.full_digest(F.col("content"))
    rows = ranked(eligible(files, least).select("path", "length", "modificationTime", digest.alias("digest")), keep)
    return {"ranked": rows, "manifest": manifest(rows, source, folder, grouped), "report": report(rows, files.select("path"))}


def report(files: DataFrame, scanned: DataFrame) -> DataFrame:
    """One row: files scanned, groups, files moved, bytes and MB freed. files: of ranked()."""
    moved = ~F.col("kept")
    found = files.agg(F.count_distinct("digest").alias("groups"), F.count_if(moved).alias("moved"), F.coalesce(F.sum(F.when(moved, F.col("length"))), F.lit(0)).cast("bigint").alias("freed_bytes"))
    return found.crossJoin(scanned.agg(F.count("*").alias("scanned"))).withColumn("freed_mb", F.round(F.col("freed_bytes") / (1024.0 * 1024.0), 2))
