"""COCO files of any size: one JSON document, written from sorted pieces and read by ranges.

Neither side holds the document. The writer's tasks write pieces of lists, which one task
copies into the file. The reader's tasks look at ranges of the file. A first pass finds for
both cases, that a range begins within a string or not, how its brackets change the depth;
so the true case and the depth at the start of each range are known. The records of a
list, objects at depth 3, are then found in each range alone.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LISTS = ("images", "annotations", "categories")
#: Bytes of a file that is still read as one value, and of a range of a larger one.
WHOLE = 32 << 20
RANGE = 8 << 20
#: Bytes of a list whose records may be broadcast.
FEW = 4 << 20
#: Bytes of records in a batch.
BATCH_BYTES = 4 << 20

_KIND = np.zeros(256, np.int8)
_KIND[list(b'"')], _KIND[list(b"{[")], _KIND[list(b"}]")] = 2, 1, -1
_KEY = re.compile(rb'"([^"]*)"\s*:\s*\Z')


def _store(path: str):
    from pyarrow.fs import FileSystem, LocalFileSystem

    return (LocalFileSystem(), re.sub(r"^file:/+", "/", path)) if path.startswith("file:/") else FileSystem.from_uri(path)


def reachable(path: str) -> bool:
    """Whether ranges of a file can be read: Spark knows more stores than pyarrow does."""
    try:
        return bool(_store(path))
    except (OSError, ValueError):
        return False


def _read(path: str, start: int, end: int) -> bytes:
    fs, base = _store(path)
    with fs.open_input_file(base) as f:
        return f.read_at(end - start, start)


def _plain(path: str, start: int, end: int) -> bytes:
    """The bytes of a range with all that is escaped by a backslash replaced, place by place."""
    data = _read(path, start, end)
    back, run = 64, 0
    while start:
        before = _read(path, max(0, start - back), start)
        run = len(before) - len(before.rstrip(b"\\"))
        if run < len(before) or back >= start:
            break
        back *= 64
    if run % 2:
        data = b"_" + data[1:]
    return data.replace(b"\\\\", b"__").replace(b'\\"', b"__") if b"\\" in data else data


def _marks(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places and steps (1, -1) of all brackets, and whether the quotes before each are odd in number."""
    kind = _KIND[np.frombuffer(data, np.uint8)]
    at = np.flatnonzero(kind)
    step = kind[at]
    quote = step == 2
    bracket = np.flatnonzero(~quote)
    odd = np.cumsum(quote, dtype=np.uint8)[bracket] & 1
    return at[bracket], step[bracket].astype(np.int64), odd


def _brackets(data: bytes, inside: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places and steps (1, -1) of the brackets outside strings."""
    at, step, odd = _marks(data)
    free = odd == int(inside)
    return at[free], step[free]


def _spans(sizes: list[tuple[str, int]]) -> list[tuple[str, int, int]]:
    return [(path, a, min(a + RANGE, n)) for path, n in sizes for a in range(0, n, RANGE)]


def _each(spark: SparkSession, tasks: list, run, schema: str, few: bool = True) -> DataFrame:
    """The batches of run(task) of all tasks, each by a task of Spark.

    By the size of spark.range() Spark takes the rows for few and broadcasts them in joins.
    Unless they are, the numbers of the tasks are an RDD, of which it assumes no size."""

    def go(batches):
        for batch in batches:
            for k in batch.column("id").to_pylist():
                yield from run(tasks[k])

    n = max(1, len(tasks))
    if few:
        return spark.range(0, len(tasks), 1, n).mapInArrow(go, schema)
    numbers = spark.sparkContext.parallelize([(k,) for k in range(len(tasks))], n)
    return spark.createDataFrame(numbers, "id bigint").mapInArrow(go, schema)


def _look(span):
    import pyarrow as pa

    data = _plain(*span)
    row = {"path": span[0], "start": span[1], "odd": data.count(b'"') % 2}
    _, steps, odd = _marks(data)
    for inside in (0, 1):
        step = steps[odd == inside]
        row[f"change{inside}"], row[f"least{inside}"] = int(step.sum()), int(min(np.cumsum(step).min(initial=0), 0))
    yield pa.RecordBatch.from_pylist([row])


def _sections(task):
    """(path, at, list): the lists and objects that open at depth 1 of a range, by their
    keys; an end of one, or of the document, has no key."""
    import pyarrow as pa

    (path, start, end), inside, depth = task
    data = _plain(path, start, end)
    at, step = _brackets(data, inside)
    after = depth + np.cumsum(step)
    rows = []
    for k in np.flatnonzero(((after == 2) & (step > 0)) | (after <= 1)):
        place, key = start + int(at[k]), None
        if after[k] == 2 and data[at[k]] == ord("["):
            found = _KEY.search(_read(path, max(0, place - 4096), place))
            key = found and found[1].decode("utf-8", "replace")
        rows.append({"path": path, "at": place, "list": key if key in LISTS else None})
    yield pa.RecordBatch.from_pylist(rows, pa.schema([("path", pa.string()), ("at", pa.int64()), ("list", pa.string())]))


def _find(task):
    """The records of a list that begin in a range, between low and high."""
    import pyarrow as pa

    (path, start, end), inside, depth, low, high = task
    more, own = 1 << 16, end
    while True:
        data = _plain(path, start, min(own + more, high + 1))
        at, step = _brackets(data, inside)
        after, place = depth + np.cumsum(step), at + start
        begin = place[(after == 3) & (step > 0) & (place > low) & (place < min(own, high))]
        close = place[(after == 2) & (step < 0) & (place > low) & (place < high)]
        first = np.searchsorted(close, begin)
        if not len(begin) or first[-1] < len(close) or own + more > high:
            break
        more *= 8
    begin, first = begin[first < len(close)], first[first < len(close)]
    raw = _read(path, start, start + len(data))
    values, size = [], 0
    for a, b in zip((begin - start).tolist(), (close[first] - start + 1).tolist()):
        values.append(raw[a:b])
        size += b - a
        if size > BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(values, pa.binary()).cast(pa.string())], names=["value"])
            values, size = [], 0
    yield pa.RecordBatch.from_arrays([pa.array(values, pa.binary()).cast(pa.string())], names=["value"])


def records(spark: SparkSession, sizes: list[tuple[str, int]], schema: T.StructType) -> dict[str, DataFrame]:
    """The lists of COCO files (path, bytes) as frames. A file that ends before its document does gives none."""
    spans = _spans(sizes)
    looked = _each(spark, spans, _look, "path string, start bigint, odd bigint, change0 bigint, least0 bigint, change1 bigint, least1 bigint")
    seen = {(r.path, r.start): r for r in looked.collect()}
    states, state, broken = [], (False, 0), set()
    for path, start, end in spans:
        inside, depth = state if start else (False, 0)
        r = seen[path, start]
        states.append(((path, start, end), inside, depth, depth + (r.least1 if inside else r.least0)))
        state = inside != bool(r.odd), depth + (r.change1 if inside else r.change0)
        if end == dict(sizes)[path] and state != (False, 0):
            broken.add(path)
    shallow = [s[:3] for s in states if s[3] <= 1 and s[0][0] not in broken]
    marks = sorted((r.path, r.at, r.list) for r in _each(spark, shallow, _sections, "path string, at bigint, list string").collect())
    lists = [(name, path, at, stop) for (path, at, name), (_, stop, _) in zip(marks, marks[1:]) if name]
    kinds = {f.name: f.dataType.elementType for f in schema.fields if f.name in LISTS}
    data = {}
    for name in LISTS:
        tasks = [(s, inside, depth, low, high) for own, path, low, high in lists if own == name for s, inside, depth, _ in states if s[0] == path and s[1] <= high and s[2] > low]
        few = sum(high - low for own, _, low, high in lists if own == name) <= FEW
        data[name] = _each(spark, tasks, _find, "value string", few).select(F.from_json("value", kinds[name]).alias("r")).select("r.*")
    return data


def write_list(rows: DataFrame, order: str, folder: str) -> list[str]:
    """The records of a list in the order of a column, as compressed pieces below folder, which are returned in order."""

    def put(batches):
        import pyarrow as pa
        from pyarrow.fs import FileSystem
        from pyspark import TaskContext

        context = TaskContext.get()
        fs, base = FileSystem.from_uri(folder)
        fs.create_dir(base, recursive=True)
        file, empty = f"{context.partitionId():06d}-{context.taskAttemptId()}.zst", True
        with fs.open_output_stream(f"{base}/{file}", compression="zstd") as f:
            for batch in batches:
                if batch.num_rows:
                    f.write((("" if empty else ",\n") + ",\n".join(batch.column(0).to_pylist())).encode())
                    empty = False
        yield pa.RecordBatch.from_pydict({"part": [context.partitionId()], "file": [None if empty else f"{folder}/{file}"]}, pa.schema([("part", pa.int32()), ("file", pa.string())]))

    # numbers sort as they are, which costs less than by text
    whole = isinstance(rows.schema[order].dataType, T.IntegralType)
    ordered = rows.orderBy(order if whole else F.lpad(F.col(order).cast("string"), 24, "0"))
    text = ordered.select(F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("value"))
    made = text.mapInArrow(put, "part int, file string").collect()
    return [r.file for r in sorted(made, key=lambda r: r.part) if r.file]


def join_pieces(spark: SparkSession, texts: list[str | list[str]], target: str) -> None:
    """The file target of texts and of lists of pieces, copied by one task that holds no more than a block."""

    def put(batches):
        import pyarrow as pa
        from pyarrow.fs import FileSystem

        for _ in batches:
            fs, base = FileSystem.from_uri(target)
            fs.create_dir(base.rpartition("/")[0], recursive=True)
            with fs.open_output_stream(base, compression=None) as f:
                for text in texts:
                    if isinstance(text, str):
                        f.write(text.encode())
                        continue
                    for k, piece in enumerate(text):
                        f.write(b",\n" if k else b"")
                        with fs.open_input_stream(FileSystem.from_uri(piece)[1], compression="zstd") as source:
                            while block := source.read(4 << 20):
                                f.write(block)
            yield pa.RecordBatch.from_pydict({"done": [True]})

    spark.range(0, 1, 1, 1).mapInArrow(put, "done boolean").collect()
