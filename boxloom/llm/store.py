"""Tables and files in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir. Where that is unset, a temporary folder
    of this session on a local master, where all tasks see it; an error on a cluster."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = "file://" + tempfile.mkdtemp(prefix="boxloom-")
    return _OWN[app]


def fresh_dir(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


#: While a table is written: the bytes of an Arrow batch, since texts can be long, and
#: shuffle files removed once it is, since no later step reads them.
CONF = {"spark.sql.execution.arrow.maxBytesPerBatch": str(2 << 20), "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


@contextmanager
def _writing(spark: SparkSession):
    before = {key: spark.conf.get(key, None) for key in CONF}
    for key, value in CONF.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def table(df: DataFrame, name: str) -> DataFrame:
    """Cuts the lineage: df written as Parquet to the shared folder, and reread.

    Replicated storage holds the rows, so a lost executor costs no recomputation, and
    the shuffle files that made them go at once. Rows go to Python in bounded batches."""
    spark = df.sparkSession
    path = fresh_dir(spark, name)
    with _writing(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def counted(df: DataFrame, name: str, **more: Column) -> tuple[DataFrame, dict[str, int]]:
    """table(), and what was counted while it was written: its rows as `n`, and further aggregates."""
    seen = Observation()
    written = table(df.observe(seen, F.count(F.lit(1)).alias("n"), *(c.alias(k) for k, c in more.items())), name)
    return written, seen.get


#: Arrow bytes of a row group of a table that Python writes.
GROUP_BYTES = 16 << 20


def _files(path: str, through):
    """Writes what `through` makes of a task's batches to a file of this attempt, and gives its path and rows."""
    def write(batches):
        from pyarrow.parquet import ParquetWriter

        out, held, size, n = None, [], 0, 0
        fs, folder = open_fs(path)
        name = f"{uuid.uuid4().hex}.parquet"
        try:
            for batch in through(batches) if through else batches:
                if not batch.num_rows:
                    continue
                if out is None:
                    fs.create_dir(folder, recursive=True)
                    out = ParquetWriter(f"{folder}/{name}", batch.schema, filesystem=fs)
                held.append(batch)
                size, n = size + batch.nbytes, n + batch.num_rows
                if size >= GROUP_BYTES:
                    out.write_table(pa.Table.from_batches(held))
                    held, size = [], 0
            if held:
                out.write_table(pa.Table.from_batches(held))
        finally:
            if out is not None:
                out.close()
        if n:
            yield pa.RecordBatch.from_pydict({"file": [f"{path}/{name}"], "n": [n]})

    return write


def handed(df: DataFrame, name: str, through=None, schema: str | None = None, **more: Column) -> tuple[DataFrame, dict[str, int]]:
    """counted() of df, or of what df.mapInArrow(through, schema) makes of it. Where the
    shared folder is a local or mounted one, Python writes the files.

    There Hadoop starts two chmods for each file that a JVM creates, and some for each
    folder, which adds up over many small tables. Only files of tasks that ended are
    reread, so nothing is renamed, and what a lost task left is not seen. Not for what
    Python makes in another way, which would take a second worker for each task."""
    spark = df.sparkSession
    made = df.mapInArrow(through, schema) if through else df
    path = fresh_dir(spark, name)
    if not path.startswith("file:"):
        return counted(made, name, **more)
    seen = Observation()
    rows = df.observe(seen, *(c.alias(k) for k, c in more.items())) if more else df
    with _writing(spark):
        files = rows.mapInArrow(_files(path, through), "file string, n bigint").collect()
    found = {"n": sum(row.n for row in files)} | (seen.get if more else {})
    if not files:
        return spark.createDataFrame([], made.schema), found
    return spark.read.schema(made.schema).parquet(*(row.file for row in files)), found


#: Narrow rows that are worth a task of their own.
TASK_ROWS = 50_000


def fitted(df: DataFrame, rows: int) -> DataFrame:
    """df, the aggregate of a shuffle, in as many tasks as that many rows are worth: the
    many shuffle partitions of a large cluster would make each small step slow. Not for
    sort-merge joins, whose sorters would all be held by one task."""
    return df.coalesce(max(1, min(partitions(df.sparkSession), -(-rows // TASK_ROWS))))


def drop(spark: SparkSession, path: str) -> None:
    """Removes a folder that a written table no longer needs."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


#: Rows of a table that may be broadcast: of narrow rows, some tens of MB.
BROADCAST_ROWS = 200_000
#: Bytes of the texts or lists of a table that may be broadcast.
BROADCAST_BYTES = 64 << 20


def small(df: DataFrame, limit: int = BROADCAST_ROWS, size: Column | None = None, rows: int | None = None) -> DataFrame:
    """df, a written table, marked for broadcast if its rows, counted here or before, are
    within the limit. Beyond it the join shuffles. Where rows hold texts or lists, `size`
    is the bytes of one row, whose sum must be within BROADCAST_BYTES too."""
    if (df.limit(limit + 1).count() if rows is None else rows) > limit:
        return df
    if size is not None and (df.agg(F.sum(size)).first()[0] or 0) > BROADCAST_BYTES:
        return df
    return F.broadcast(df)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def open_fs(uri: str):
    """(filesystem, path) for use on executors; any store that pyarrow knows."""
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(uri)
