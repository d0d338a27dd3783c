"""Line crossings of tracked objects, as windows.

tracks (camera_id, seq, pid, cx, cy): seq counts a camera's updates in arrival order
without gaps. lines (camera_id, line_ord, line, ax, ay, bx, by). A track counts at most
once up and once down in a session, over all lines together. A session ends when
WINDOW or more entries came between two updates of the track, where each update of
another track makes as many entries as the camera has lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import geometry as g

WINDOW = 50


def steps(tracks: DataFrame, lines: DataFrame) -> DataFrame:
    """Each update with the point before it (itself at first sight) and its session."""
    by = W.partitionBy("camera_id", "pid").orderBy("seq")
    rows = tracks.select("camera_id", "seq", "pid", F.col("cx").cast("int").alias("mx"), F.col("cy").cast("int").alias("my"))
    rows = rows.withColumns({"px": F.coalesce(F.lag("mx").over(by), F.col("mx")), "py": F.coalesce(F.lag("my").over(by), F.col("my")), "__last": F.lag("seq").over(by)})
    count = lines.groupBy("camera_id").agg(F.count("*").alias("__lines"))
    rows = rows.join(count, "camera_id")
    new = F.col("__last").isNull() | ((F.col("seq") - F.col("__last") - 1) * F.col("__lines") >= WINDOW)
    return rows.withColumn("session", F.sum(new.cast("int")).over(by)).drop("__last", "__lines")


def hits(moves: DataFrame, lines: DataFrame) -> DataFrame:
    """Steps joined with each line of their camera that they cross, and the direction."""
    rows = moves.join(lines, "camera_id")  # broadcast by the planner while its size allows
    mid, before = (F.col("mx"), F.col("my")), (F.col("px"), F.col("py"))
    a, b = (F.col("ax"), F.col("ay")), (F.col("bx"), F.col("by"))
    x, y = g.cross_point(a, b, mid, before)
    rows = rows.where(g.intersects(mid, before, a, b)).withColumns({"x": x, "y": y, "axis": g.axis(F.col("bx") - F.col("ax"), F.col("by") - F.col("ay"))}).where("x IS NOT NULL")
    level = F.col("axis") == "updown"
    way = g.direction(F.when(level, F.col("my")).otherwise(F.col("mx")), F.when(level, F.col("y")).otherwise(F.col("x")), F.when(level, F.col("py")).otherwise(F.col("px")))
    return rows.withColumn("dir", way)


def crossings(tracks: DataFrame, lines: DataFrame) -> DataFrame:
    """The crossings that count: the first of each track, session and direction."""
    rows = hits(steps(tracks, lines), lines)
    first = F.row_number().over(W.partitionBy("camera_id", "pid", "session", "dir").orderBy("seq", "line_ord"))
    return rows.withColumn("__k", first).where("__k = 1").drop("__k")


def totals(tracks: DataFrame, lines: DataFrame) -> DataFrame:
    """Per line up_count and down_count, zeros included."""
    found = crossings(tracks, lines).groupBy("camera_id", "line").agg(F.count_if(F.col("dir") == "up").alias("u"), F.count_if(F.col("dir") == "down").alias("d"))
    rows = lines.select("camera_id", "line").join(found, ["camera_id", "line"], "left")
    return rows.select("camera_id", "line", F.coalesce("u", F.lit(0)).alias("up_count"), F.coalesce("d", F.lit(0)).alias("down_count"))
