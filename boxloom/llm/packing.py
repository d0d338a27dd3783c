"""Best-fit packing of tokenised documents into sequences of bounded length.

Hierarchical residual packing: pieces are dealt by hash to nodes of some tens of
thousands; each node packs its own by best fit, largest first. Bins filled to within
`slack` of the capacity are final. The others go up a tree as items of their own size:
each level deals them to as many nodes as hold them at that size and packs them by best
fit again, until one node has all. An open bin is passed on if its room could take the
smallest open bin; no other is left behind, however many they are. A level that merges
under one in STALL of its items is the last: what is left does not fit together.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import store
from .codec import codec, default_path, spans, trim
from .tokenfiles import END_ID
from .wordhash import runs

CAPACITY = 4096
SLACK = 32
GROUP = 32_768
STALL = 1000


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best fit of items, largest first: per item its bin and offset, per bin its fill.

    The bin chosen has the least room that is enough; ties go to the latest bin."""
    bins, offsets, fills = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64), []
    with_room: dict[int, list[int]] = {}
    rooms = 0  # bit r: some bin has room r
    for k in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[k])
        if above := rooms >> size:
            room = size + (above & -above).bit_length() - 1
            at = with_room[room].pop()
            if not with_room[room]:
                rooms &= ~(1 << room)
        else:
            room, at = capacity, len(fills)
            fills.append(0)
        bins[k], offsets[k] = at, fills[at]
        fills[at] += size
        if left := room - size:
            with_room.setdefault(left, []).append(at)
            rooms |= 1 << left
    return bins, offsets, np.array(fills, np.int64)


PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, uid bigint"


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Tokenises docs (doc_id, text), appends end_id to each, and cuts those over
    the capacity into pieces of it, the last as long as it comes. start counts the
    document's ids before the piece. uid tells rows apart, for a stored result."""
    tokenizer = tokenizer or default_path()
    names, kinds = [x.split()[0] for x in PIECES.split(", ")], (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())

    def cut(batches):
        from pyspark import TaskContext

        trim()  # what an operator before this one has left in the worker
        coder, uid = codec(tokenizer), TaskContext.get().partitionId() << 40
        for batch in batches:
            for rows in runs(batch):
                ids, ends = coder.ended(rows.column("text"), end_id)
                counts = -(-np.diff(ends) // capacity)
                doc, piece = np.repeat(np.arange(rows.num_rows), counts), spans(np.zeros(len(counts), np.int64), counts)
                begin = ends[doc] + piece * capacity
                stop = np.minimum(begin + capacity, ends[doc + 1])
                sums = [zlib.crc32(ids[a:b]) for a, b in zip(begin.tolist(), stop.tolist())]
                made = (piece, begin - ends[doc], stop - begin, sums, np.arange(uid, uid + len(doc)))
                uid += len(doc)
                yield pa.RecordBatch.from_arrays([rows.column("doc_id").take(pa.array(doc)).cast(kinds[0]), *(pa.array(x, kind) for x, kind in zip(made, kinds[1:]))], names=names)

    return docs.select("doc_id", "text").mapInArrow(cut, PIECES)


STEP = "item bigint, bin bigint, offset bigint, fill bigint, open boolean"


def _pack_node(level: int, capacity: int, slack: int, last: bool):
    def pack(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["size", "item"], ascending=[False, True])  # the same bins in every attempt
        bins, offsets, fills = best_fit(frame["size"].to_numpy(), capacity)
        opened = (capacity - fills > slack) & (not last)
        names = (level << 56) + (int(key[0]) << 28) + bins
        return pd.DataFrame({"item": frame["item"].to_numpy(), "bin": names, "offset": offsets, "fill": fills[bins], "open": opened[bins]})

    return pack


def pack(items: DataFrame, capacity: int = CAPACITY, slack: int = SLACK, group: int = GROUP) -> DataFrame:
    """items (uid, length: 1 to capacity) to (uid, sequence_id, offset)."""
    todo, count, level, steps = items.select(F.col("uid").alias("item"), F.col("length").alias("size")), items.count(), 0, []
    while True:
        nodes = max(1, -(-count // group))
        dealt = todo.withColumn("node", F.pmod(F.xxhash64("item", F.lit(level)), F.lit(nodes)))
        step = store.table(dealt.groupBy("node").applyInPandas(_pack_node(level, capacity, slack, nodes == 1), STEP), f"bins{level}")
        steps.append(step)
        if nodes == 1:
            break
        carried = store.table(step.where("open").groupBy("bin").agg(F.first("fill").alias("size")), "open")
        least = carried.agg(F.min("size")).first()[0]
        if least is None:
            break
        todo, seen = store.counted(carried.where(F.lit(capacity) - F.col("size") >= least).select(F.col("bin").alias("item"), "size"), "carried")
        if not seen["n"] or (level and seen["n"] > count * (1 - 1 / STALL)):
            break
        count, level = seen["n"], level + 1
    moved = None  # of bins that went up: where they ended
    for step in steps[:0:-1]:
        own = step.select(F.col("item").alias("was"), "bin", "offset")
        if moved is not None:
            own = own.join(moved.select(F.col("was").alias("bin"), F.col("to"), F.col("by")), "bin", "left")
            own = own.select("was", F.coalesce("to", "bin").alias("bin"), (F.col("offset") + F.coalesce("by", F.lit(0))).alias("offset"))
        moved = own.select("was", F.col("bin").alias("to"), F.col("offset").alias("by"))
    placed = steps[0].select(F.col("item").alias("uid"), "bin", "offset")
    if moved is None:
        return placed.withColumnRenamed("bin", "sequence_id")
    placed = placed.join(store.small(store.table(moved, "moved")), F.col("bin") == F.col("was"), "left")
    return placed.select("uid", F.coalesce("to", "bin").alias("sequence_id"), (F.col("offset") + F.coalesce("by", F.lit(0))).alias("offset"))


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, **tuning) -> DataFrame:
    """Per piece of docs: doc_id, piece, start, length, ids_crc32, sequence_id and
    offset. Repeated rows are packed as often as they occur; null ids stay null."""
    cut = store.table(pieces(docs, tokenizer, capacity, end_id), "pieces")
    return cut.join(pack(cut.select("uid", "length"), capacity, **tuning), "uid").drop("uid")
