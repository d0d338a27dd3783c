"""Size-tiered compaction of table shards, in DataFrame functions.

A store is a folder of immutable Parquet shards and of manifests. A manifest lists
the shards of one version. Arrivals are appended as small shards. Compaction sorts
the shards below the target size into tiers by powers of TIER_BASE, and merges the
shards of a tier that has at least FAN of them, or all small ones when told so, into
files near the target. A version is committed by creating its manifest file, which
fails if the version exists; shards that no manifest names (a task that ran twice, a
writer that lost) do not count, and readers of an older version keep their files
until vacuum(). An arrival is a number of small shards that grows with it, so tiers and
merges work alike at every size.

A merge reads its shards with fewer tasks and writes one file for each: no shuffle.
"""

from __future__ import annotations

import json
import math
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TARGET_BYTES = 128 << 20
TIER_BASE, FAN = 4, 4
#: Shards of an arrival for each target size of text in it, and at least, rows permitting.
ARRIVAL_SHARDS = 8
#: A shard that no manifest names may be of a writer at work for so long.
GRACE_SECONDS = 3600


class Conflict(Exception):
    """Another writer has committed this version."""


class ShardStore:
    """Shards of rows of one schema below `folder`, in any store that Spark reads.

    An empty table is a version without shards. Nulls and repeated rows are kept as
    they are: the store holds each appended row once, under any columns."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._paths = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._paths(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # Manifests: small text files, written and listed by the driver.

    def versions(self) -> list[int]:
        where = self._paths(f"{self.folder}/manifests")
        if not self._fs.exists(where):
            return []
        return sorted(int(s.getPath().getName()[1:-5]) for s in self._fs.listStatus(where) if s.getPath().getName().endswith(".json"))

    def manifest(self, version: int | None = None) -> dict:
        """{version, schema, shards: [{path, bytes}]} of a version, by default the last."""
        found = self.versions()
        if not found and version is None:
            return {"version": -1, "schema": None, "shards": []}
        version = found[-1] if version is None else version
        text = self.spark.read.text(f"{self.folder}/manifests/v{version:08d}.json", wholetext=True).first()
        return json.loads(text[0])

    def _commit(self, before: dict, schema: str, shards: list[dict]) -> dict:
        made = {"version": before["version"] + 1, "schema": schema, "shards": sorted(shards, key=lambda s: s["path"])}
        draft = self._paths(f"{self.folder}/drafts/{uuid.uuid4().hex}")
        out = self._fs.create(draft)
        out.write(bytearray(json.dumps(made).encode()))
        out.close()
        final = self._paths(f"{self.folder}/manifests/v{made['version']:08d}.json")
        self._fs.mkdirs(final.getParent())
        # a rename onto a version that exists fails, so one of two writers wins
        if self._fs.exists(final) or not self._fs.rename(draft, final):
            self._fs.delete(draft, False)
            raise Conflict(f"version {made['version']}")
        return made

    def _files(self, folder: str) -> list[dict]:
        return [{"path": s.getPath().toString(), "bytes": s.getLen()} for s in self._fs.listStatus(self._paths(folder)) if s.getPath().getName().endswith(".parquet")]

    def _write(self, rows: DataFrame, shard_rows: int = 0) -> list[dict]:
        folder = f"{self.folder}/shards/{uuid.uuid4().hex}"
        rows.write.option("maxRecordsPerFile", shard_rows).parquet(folder)
        return self._files(folder)

    # Versions

    def append(self, rows: DataFrame, shard_rows: int = 0) -> dict:
        """Commits a version with the rows added, in shards of at most shard_rows, or if
        that is 0 one for each of their partitions."""
        before = self.manifest()
        return self._commit(before, rows.schema.json(), before["shards"] + self._write(rows, shard_rows))

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, with its shard's path in `shard`, or in _shard, __shard,
        ... if the rows have that column themselves."""
        from pyspark.sql.types import StructType

        manifest = self.manifest(version)
        schema = StructType.fromJson(json.loads(manifest["schema"]))
        name = "shard"
        while name.lower() in (c.lower() for c in schema.names):
            name = "_" + name
        if not manifest["shards"]:
            return self.spark.createDataFrame([], schema).withColumn(name, F.lit(""))
        rows = self.spark.read.schema(schema).parquet(*(s["path"] for s in manifest["shards"]))
        return rows.withColumn(name, F.col("_metadata.file_path"))

    @staticmethod
    def plan(shards: list[dict], target: int, base: int = TIER_BASE, fan: int = FAN, everything: bool = False) -> list[list[dict]]:
        """The merges: runs of similarly sized shards. Shards of the target size or
        more are left alone; so is a tier of fewer than fan shards, unless everything."""
        tiers: dict[int, list[dict]] = {}
        for shard in shards:
            if shard["bytes"] < target:
                tiers.setdefault(0 if everything else int(math.log(target / max(shard["bytes"], 1), base)), []).append(shard)
        least = 2 if everything else fan
        return [sorted(tier, key=lambda s: (s["bytes"], s["path"])) for _, tier in sorted(tiers.items()) if len(tier) >= least]

    def compact(self, target: int = TARGET_BYTES, everything: bool = False) -> dict:
        """Merges until no tier is full, then commits one version; the merged shards
        stay for readers of older versions. Without a merge no version is made."""
        before = self.manifest()
        shards, passes = before["shards"], 0
        while merges := self.plan(shards, target, everything=everything):
            from pyspark.sql.types import StructType

            schema = StructType.fromJson(json.loads(before["schema"]))
            gone: set[str] = set()
            made: list[dict] = []
            for run in merges:
                files = max(1, math.floor(sum(s["bytes"] for s in run) / target + 0.5))
                if files >= len(run):
                    continue
                made += self._write(self.spark.read.schema(schema).parquet(*(s["path"] for s in run)).coalesce(files))
                gone |= {s["path"] for s in run}
            if not gone:
                break
            shards, passes = [s for s in shards if s["path"] not in gone] + made, passes + 1
            if everything:
                break
        return self._commit(before, before["schema"], shards) if passes else before

    def vacuum(self, grace_seconds: float = GRACE_SECONDS) -> int:
        """Removes the manifests before the last version and all shards that it does not
        name: those of older versions, and those that no manifest names and that are older
        than the grace period, left by failed writers or merged away within one
        compact(). Returns how many shards. Not for use beside readers of older versions."""
        found = self.versions()
        kept = {s["path"] for s in self.manifest()["shards"]}
        old = {s["path"] for v in found[:-1] for s in self.manifest(v)["shards"]} - kept
        late = int((time.time() - grace_seconds) * 1000)
        old |= {path for path, changed in self._stored() if path not in kept and changed <= late}
        for path in old:
            self._fs.delete(self._paths(path), False)
        for version in found[:-1]:
            self._fs.delete(self._paths(f"{self.folder}/manifests/v{version:08d}.json"), False)
        return len(old)

    def _stored(self) -> list[tuple[str, int]]:
        """(path, time of change in ms) of every shard file, named or not."""
        where = self._paths(f"{self.folder}/shards")
        listed, found = self._fs.listFiles(where, True) if self._fs.exists(where) else None, []
        while listed is not None and listed.hasNext():
            status = listed.next()
            if status.getPath().getName().endswith(".parquet"):
                found.append((status.getPath().toString(), status.getModificationTime()))
        return found


def shard_documents(docs: DataFrame, folder: str, target: int = TARGET_BYTES, text: str = "text") -> tuple[DataFrame, dict]:
    """docs arrives in a store below folder as small shards, is compacted, and read back
    with each row's shard. Also what holds then: versions committed, rows_before in the
    version before the compaction, arrivals_left (shards of the arrival still named),
    unnamed (files beside the named shards) and surplus_shards, more than twice as many
    as the target asks for."""
    store = ShardStore(docs.sparkSession, folder)
    size = docs.agg(F.count("*").alias("n"), F.sum(F.octet_length(text)).alias("bytes")).first()
    share = max(ARRIVAL_SHARDS, (size["bytes"] or 0) * ARRIVAL_SHARDS // target)
    arrived = store.append(docs, max(1, size["n"] // share))
    rows_before = store.read(arrived["version"]).count()
    store.compact(target)
    final = store.compact(target, everything=True)
    versions = len(store.versions())
    store.vacuum(0)
    named, first = {s["path"] for s in final["shards"]}, {s["path"] for s in arrived["shards"]}
    least = 2 * max(1, math.ceil(sum(s["bytes"] for s in final["shards"]) / target))
    state = {"versions": versions, "rows_before": rows_before, "arrivals_left": len(named & first) if len(first) > 1 else 0, "unnamed": len({p for p, _ in store._stored()} - named), "surplus_shards": max(0, len(named) - least)}
    return store.read(final["version"]), state
