"""Token-id files: flat unsigned integers, with 64-bit document offsets.

A data set is a folder of parts and a manifest. `part-*.bin` holds the ids of the
part's documents one after another, little-endian, 16 bits wide where the
vocabulary allows it and else 32. `part-*.idx` holds int64 values: the number n of
documents, n ids, n + 1 offsets in tokens within the part, then n flags (1: the id
is null). `manifest.json` lists the parts in ascending doc_id order, each with its
base, the number of tokens in all parts before it: a prefix sum over the parts.
Parts that are not in the manifest (a task that ran twice) do not count.
"""

from __future__ import annotations

import json
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import store
from .codec import codec, default_path
from .wordhash import runs

END_ID = 1
#: Bytes of text and index of a part, and those that the index has for a document.
PART_BYTES, INDEX_BYTES = 256 << 20, 24
SCHEMA = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def _writer(folder: str, tokenizer: str, end_id: int):
    def write(batches):
        coder, sink, part = codec(tokenizer), None, ""
        ids, nulls, ends, total, count = [], [], [np.zeros(1, np.int64)], 0, 0
        for batch in batches:
            for rows in runs(batch):
                if sink is None:
                    part = f"part-{uuid.uuid4().hex}"
                    fs, path = store.open_fs(folder)
                    sink = fs.open_output_stream(f"{path}/{part}.bin")
                keys = rows.column("doc_id")
                own, cuts = coder.ended(rows.column("text"), end_id)
                sink.write(own.astype(coder.dtype))
                ends.append(cuts[1:] + total)
                total, count = total + len(own), count + rows.num_rows
                ids.append(keys.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"))
                nulls.append(keys.is_null().to_numpy(zero_copy_only=False).astype("<i8"))
        if sink is None:
            return
        sink.close()
        with fs.open_output_stream(f"{path}/{part}.idx") as f:
            f.write(np.concatenate([[count], *ids, *ends, *nulls]).astype("<i8"))
        from pyspark import TaskContext

        yield pa.RecordBatch.from_pydict({"place": [TaskContext.get().partitionId()], "part": [part], "docs": [count], "tokens": [total]})

    return write


def write(docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = END_ID, part_bytes: int = PART_BYTES) -> dict:
    """Writes the token files of docs (doc_id, text) and returns their manifest.

    One shuffle, by ranges of doc_id and a hash of the text, so that the parts' order is
    the ids' order; null ids come first, and rows with equal ids may span parts, in the
    order of that hash. A part holds about part_bytes of text and index, so tasks stay
    as large whatever the input; a longer text is a part of its own. The driver gets one
    row for each part. An empty table gives a manifest without parts."""
    tokenizer = tokenizer or default_path()
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("__order"))
    size = docs.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + INDEX_BYTES).alias("n")).first()["n"] or 0
    spread = rows.repartitionByRange(max(1, -(-size // part_bytes)), "doc_id", "__order").sortWithinPartitions("doc_id", "__order").select("doc_id", "text")
    fs, path = store.open_fs(folder)
    fs.create_dir(path, recursive=True)
    written = spread.mapInArrow(_writer(folder, tokenizer, end_id), "place bigint, part string, docs bigint, tokens bigint").collect()
    base, listed = 0, []
    for row in sorted(written):
        listed.append({"part": row.part, "docs": row.docs, "tokens": row.tokens, "base": base})
        base += row.tokens
    manifest = {"dtype": codec(tokenizer).dtype.str, "end_id": end_id, "tokens": base, "parts": listed}
    with fs.open_output_stream(f"{path}/manifest.json.new") as f:
        f.write(json.dumps(manifest).encode())
    fs.move(f"{path}/manifest.json.new", f"{path}/manifest.json")
    return manifest


def open_part(folder: str, part: dict, dtype: str):
    """(doc ids as an Arrow array, offsets, file): local files are memory-mapped."""
    from pyarrow.fs import LocalFileSystem

    fs, path = store.open_fs(folder)
    index = np.frombuffer(fs.open_input_file(f"{path}/{part['part']}.idx").read(), "<i8")
    n = int(index[0])
    ids = pa.array(index[1 : n + 1], mask=index[2 * n + 2 :].astype(bool))
    name = f"{path}/{part['part']}.bin"
    return ids, index[n + 1 : 2 * n + 2], pa.memory_map(name) if isinstance(fs, LocalFileSystem) else fs.open_input_file(name)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Per document of the data set: doc_id, start (ids before it in all parts),
    n_tokens and the CRC-32 of its ids as little-endian 32-bit integers. One task
    reads one part, of bounded size, some documents at a time."""
    fs, path = store.open_fs(folder)
    manifest = json.loads(fs.open_input_file(f"{path}/manifest.json").read())
    parts, dtype = manifest["parts"], manifest["dtype"]
    if not parts:
        return spark.createDataFrame([], SCHEMA)

    def scan(batches):
        width = np.dtype(dtype).itemsize
        for batch in batches:
            for k in batch.column("id").to_pylist():
                ids, offsets, data = open_part(folder, parts[k], dtype)
                for at in range(0, len(ids), 4096):
                    ends = offsets[at : at + 4097]
                    data.seek(int(ends[0]) * width)
                    sums = [zlib.crc32(np.frombuffer(data.read_buffer(n * width), dtype).astype("<u4")) for n in np.diff(ends).tolist()]
                    yield pa.RecordBatch.from_arrays([ids.slice(at, 4096), pa.array(ends[:-1] + parts[k]["base"]), pa.array(np.diff(ends)), pa.array(sums, pa.int64())], names=[c.split()[0] for c in SCHEMA.split(", ")])

    return spark.range(0, len(parts), 1, len(parts)).mapInArrow(scan, SCHEMA)


def round_trip(docs: DataFrame, tokenizer: str | None = None, part_bytes: int = PART_BYTES) -> DataFrame:
    """Writes docs as token files in the shared folder and reads them back."""
    spark = docs.sparkSession
    folder = store.fresh_dir(spark, "tokens")
    write(docs, folder, tokenizer, part_bytes=part_bytes)
    return read(spark, folder)
