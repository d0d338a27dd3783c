"""File names, ids in names, and content digests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def basename_any(path: Column) -> Column:
    """After the last backslash if there is one, else after the last slash."""
    return F.when(F.instr(path, "\\") > 0, F.element_at(F.split(path, r"\\"), -1)).otherwise(basename(path))


def stem(name: Column) -> Column:
    """Without the extension: from the last dot on, but leading dots are no extension."""
    return F.regexp_replace(name, r"^(\.*[^.].*)\.[^.]*$", "$1")


def extension(name: Column) -> Column:
    return F.substring(name, F.length(stem(name)) + 1, F.length(name))


def first_stem(name: Column) -> Column:
    """Up to the first dot."""
    return F.substring_index(name, ".", 1)


def drop_suffix(name: Column, letters: int = 4) -> Column:
    return F.substring(name, F.lit(1), F.greatest(F.length(name) - letters, F.lit(0)))


def digits(name: Column) -> Column:
    """The first run of digits as bigint; none is an error under ANSI."""
    return F.regexp_extract(name, "[0-9]+", 0).cast("bigint")


def image_file(name: Column) -> Column:
    """Listed image suffixes, case by case: BMP or Jpg are not images."""
    return F.element_at(F.split(name, r"\."), -1).isin("bmp", "jpg", "jpeg", "png", "JPEG", "JPG", "PNG")


def full_digest(content: Column) -> Column:
    return F.sha2(content, 256)


def sampled_digest(content: Column, threshold: int = 0, kind: str = "string") -> Column:
    """kind: string counts characters, binary bytes. Of 4096 of them at the start, the middle (over 8192) and the end (over 12288);
    of everything up to the threshold. Different files may agree: that is the speed it buys."""
    size, none = F.length(content), F.lit("").cast(kind)
    part = F.concat(
        F.substring(content, 1, 4096),
        F.when(size > 8192, F.substring(content, (F.floor(size / 2) - 2047).cast("int"), F.lit(4096))).otherwise(none),
        F.when(size > 12288, F.substring(content, -4096, 4096)).otherwise(none),
    )
    return F.sha2(F.when(size > threshold, part).otherwise(content), 256)


def magic_format(head: Column) -> Column:
    """Image format by its first bytes, null for none. head: at least 12 bytes."""
    starts = lambda x: F.substring(F.hex(head), 1, len(x)) == x
    return (
        F.when(starts("FFD8"), "jpeg")
        .when(starts("89504E470D0A1A0A"), "png")
        .when(starts("474946383761") | starts("474946383961"), "gif")
        .when(starts("4949") | starts("4D4D"), "tiff")
        .when(starts("424D"), "bmp")
        .when(starts("52494646") & (F.substring(F.hex(head), 17, 8) == "57454250"), "webp")
    )


def relative(path: Column, folder: str) -> Column:
    """path below folder, or the path as it is if it is not below it."""
    root = folder.rstrip("/") + "/"
    return F.when(path.startswith(root), F.substring(path, F.lit(len(root) + 1), F.length(path))).otherwise(path)


def megabytes(size: Column) -> Column:
    return F.round(size / (1024.0 * 1024.0), 2)
