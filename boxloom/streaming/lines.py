"""The line counter over a stream, one state for each camera.

Sessions depend on the updates of all of a camera's tracks, so the camera is the key.
Updates of one batch are taken in seq order; there is no watermark, as in the batch
form. State lasts as long as the query unless the caller sets a time-out, after which a
camera that is silent for so long is forgotten, and its counts begin anew.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.tracks import WINDOW

OUT = "camera_id string, line string, up_count bigint, down_count bigint"


def _turn(a, b, c) -> bool:
    return (c[1] - a[1]) * (b[0] - a[0]) > (b[1] - a[1]) * (c[0] - a[0])


class Counter:
    """The state of one camera: per track its last point, the number of updates at that
    time and the directions counted in this session; per line its totals."""

    def __init__(self, lines: list[dict], state: dict | None = None):
        self.lines = lines
        self.state = state or {"seen": 0, "tracks": {}, "totals": [[0, 0] for _ in lines]}

    def update(self, pid, cx: float, cy: float) -> None:
        state, point = self.state, [int(cx), int(cy)]
        before, last, done = state["tracks"].get(str(pid), (point, None, [False, False]))
        if last is None or (state["seen"] - last - 1) * len(self.lines) >= WINDOW:
            done = [False, False]
        for k, line in enumerate(self.lines):
            a, b = (line["ax"], line["ay"]), (line["bx"], line["by"])
            if _turn(point, a, b) == _turn(before, a, b) or _turn(point, before, a) == _turn(point, before, b):
                continue
            down = self._down(point, before, a, b)
            if down is not None and not done[down]:
                done[down] = True
                state["totals"][k][down] += 1
        state["tracks"][str(pid)] = (point, state["seen"], done)
        state["seen"] += 1

    @staticmethod
    def _down(point, before, a, b) -> int | None:
        """1 down, 0 up, None if the lines are parallel."""
        (dx, dy), (ex, ey) = (b[0] - a[0], b[1] - a[1]), (before[0] - point[0], before[1] - point[1])
        det = dx * ey - dy * ex
        if not det:
            return None
        share = ((point[0] - a[0]) * ey - (point[1] - a[1]) * ex) / det
        k = 1 if abs(dy) < abs(dx) else 0
        at = a[k] + share * (dy if k else dx)
        return int(at < point[k] or (at == point[k] and not point[k] < before[k]))


def count_stream(tracks: DataFrame, lines: dict[str, list[dict]], timeout_ms: int | None = None) -> DataFrame:
    """A streaming frame of tracks to each camera's totals after each batch (update mode).

    lines: per camera a list of {line, ax, ay, bx, by}; a camera without lines counts nothing."""

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        own = lines.get(str(key[0]), [])
        counter = Counter(own, json.loads(state.get[0]) if state.exists else None)
        frame = pd.concat(list(frames)).sort_values("seq")
        for pid, cx, cy in zip(frame["pid"], frame["cx"], frame["cy"]):
            counter.update(pid, cx, cy)
        state.update((json.dumps(counter.state),))
        if timeout_ms:
            state.setTimeoutDuration(timeout_ms)
        yield pd.DataFrame({"camera_id": [str(key[0])] * len(own), "line": [x["line"] for x in own], "up_count": [t[0] for t in counter.state["totals"]], "down_count": [t[1] for t in counter.state["totals"]]})

    return tracks.groupBy("camera_id").applyInPandasWithState(step, OUT, "state string", "update", GroupStateTimeout.ProcessingTimeTimeout if timeout_ms else GroupStateTimeout.NoTimeout)
