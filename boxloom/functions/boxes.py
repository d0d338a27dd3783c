"""Box and label expressions. All take and give columns; nothing here is a UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def trunc_int(c: Column) -> Column:
    """Number text or double to int, toward zero; text that is no number is an error under ANSI."""
    return c.cast("double").cast("int")


def strict_int(c: Column) -> Column:
    """Integer text only: '12.7' is an error."""
    return c.cast("int")


def or_default(c: Column, default: int) -> Column:
    """Lenient number: null, or text that is no number, becomes the default."""
    return F.coalesce(c.cast("string").try_cast("double").try_cast("int"), F.lit(default))


def half_even(c: Column) -> Column:
    return F.bround(c, 0).cast("int")


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends; trim() drops blanks only."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def corners_to_coco(xmin: Column, ymin: Column, xmax: Column, ymax: Column, origin: int = 1, integer: bool = True) -> dict[str, Column]:
    """x, y, w, h, area. origin 1 shifts the near corner only, so w and h grow by one."""
    x1, y1, x2, y2 = (trunc_int(c) if integer else c.cast("double") for c in (xmin, ymin, xmax, ymax))
    x, y = x1 - origin, y1 - origin
    return {"x": x, "y": y, "w": x2 - x, "h": y2 - y, "area": (x2 - x) * (y2 - y)}


def coco_to_corners(x: Column, y: Column, w: Column, h: Column) -> dict[str, Column]:
    """The sum is truncated, not its parts."""
    return {"xmin": x.cast("int"), "ymin": y.cast("int"), "xmax": (x + w).cast("int"), "ymax": (y + h).cast("int")}


def corners_to_yolo(xmin: Column, ymin: Column, xmax: Column, ymax: Column, width: Column, height: Column) -> dict[str, Column]:
    """Centre and size in shares of the image: times the reciprocal, at most 1, not clamped below."""

    def share(v: Column, size: Column) -> Column:
        part = v * (F.lit(1.0) / size.cast("double"))
        return F.when(part >= 1, F.lit(1.0)).otherwise(part)

    return {"cx": share((xmin + xmax) / 2.0 - 1, width), "cy": share((ymin + ymax) / 2.0 - 1, height), "w": share(xmax - xmin, width), "h": share(ymax - ymin, height)}


def yolo_to_corners(cx: Column, cy: Column, w: Column, h: Column, width: Column, height: Column) -> dict[str, Column]:
    """Near corners are at least 0, far ones at most size - 1, all truncated."""

    def near(c: Column, s: Column, size: Column) -> Column:
        return F.greatest(F.lit(0), (c * size - s * size / 2).cast("int"))

    def far(c: Column, s: Column, size: Column) -> Column:
        return F.least(size.cast("int") - 1, (c * size + s * size / 2).cast("int"))

    return {"xmin": near(cx, w, width), "ymin": near(cy, h, height), "xmax": far(cx, w, width), "ymax": far(cy, h, height)}


def rectangle_to_coco(ax: Column, ay: Column, bx: Column, by: Column) -> dict[str, Column]:
    """Two opposite corners in any order; the outline goes down the left side first."""
    x1, y1, x2, y2 = F.least(ax, bx), F.least(ay, by), F.greatest(ax, bx), F.greatest(ay, by)
    return {"x": x1, "y": y1, "w": x2 - x1, "h": y2 - y1, "area": (x2 - x1) * (y2 - y1), "segmentation": F.array(F.array(x1, y1, x1, y2, x2, y2, x2, y1))}


def polygon_box(points: Column, width: Column, height: Column) -> dict[str, Column]:
    """Box of a polygon (array of [x, y]) from its vertices, clipped to the image and
    rounded: max - min. For the box of the painted pixels see images.raster_box."""
    xs = F.transform(points, lambda p: F.round(F.least(F.greatest(p[0], F.lit(0.0)), width - 1.0)))
    ys = F.transform(points, lambda p: F.round(F.least(F.greatest(p[1], F.lit(0.0)), height - 1.0)))
    w, h = F.array_max(xs) - F.array_min(xs), F.array_max(ys) - F.array_min(ys)
    return {"x": F.array_min(xs), "y": F.array_min(ys), "w": w, "h": h, "area": w * h, "segmentation": F.array(F.flatten(points))}


def valid_box(xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    return (xmax > xmin) & (ymax > ymin)


def require(ok: Column, value: Column, message: str, kind: str = "bigint") -> Column:
    """value where ok holds; the query fails with the message where it does not."""
    return F.when(ok, value).otherwise(F.raise_error(F.lit(message)).cast(kind))
