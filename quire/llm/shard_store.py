"""Sharding by size-tiered compaction, with a versioned manifest.

Arrivals are appended as runs of immutable Parquet files. Runs of similar size
form a tier (powers of ``FAN_IN`` over ``SMALLEST`` bytes); ``FAN_IN`` runs of
one tier are merged into one run of files of about the target size, which
belongs to a higher tier, so every row is rewritten a logarithmic number of
times. The state of the store is its newest manifest, a small JSON file whose
name is its version. A commit writes a temporary file and renames it to the
next version without overwriting: it happens whole or not at all, and of two
writers one starts again. That rests on a rename that is atomic and refuses an existing name,
as on HDFS; on a local folder the refusal is a check before the rename, and on an
object store a rename is a copy, so there writers must not run at the same time.
Readers of a version see exactly its files. Files that
no recent version names, such as those of jobs that were lost, go with vacuum().

Merges of different runs are independent: those of one round run side by side.

Defined results: an empty arrival makes a run without rows (none with append_all); all columns, nulls
and repeated rows are kept as they are; arrivals need the same schema; merging
keeps no order between rows.
"""

from __future__ import annotations

import json
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TARGET_BYTES, SMALLEST, FAN_IN = 128 << 20, 1 << 20, 4
RETRIES = 100
#: Merges of a round that run at the same time.
SIDE_BY_SIDE = 8


class Conflict(Exception):
    """Another writer committed this version first."""


class ShardStore:
    def __init__(self, spark: SparkSession, path: str, target_bytes: int = TARGET_BYTES, smallest: int = SMALLEST, fan_in: int = FAN_IN) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.target, self.smallest, self.fan_in = target_bytes, smallest, fan_in
        jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(self._conf)
        self._context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path(self.path).toUri(), self._conf)
        self._none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        for part in ("data", "manifests"):
            self._fs.mkdirs(self._path(f"{self.path}/{part}"))

    # the manifest

    def versions(self) -> list[int]:
        names = [f.getPath().getName() for f in self._fs.listStatus(self._path(f"{self.path}/manifests"))]
        return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))

    def manifest(self, version: int | None = None) -> dict:
        """{version, schema, runs}; a run is {id, files, bytes, rows is not counted}. Version 0 is the empty store."""
        have = self.versions()
        version = (have[-1] if have else 0) if version is None else version
        if version == 0:
            return {"version": 0, "schema": None, "runs": []}
        stream = self._fs.open(self._path(self._name(version)))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _name(self, version: int) -> str:
        return f"{self.path}/manifests/v{version:012d}.json"

    def _commit(self, manifest: dict) -> None:
        """Make manifest the next version, or raise Conflict."""
        temporary = self._path(f"{self.path}/manifests/.{uuid.uuid4().hex}")
        stream = self._fs.create(temporary)
        stream.write(bytearray(json.dumps(manifest).encode()))
        stream.close()
        try:
            self._context.rename(temporary, self._path(self._name(manifest["version"])), self._none)
        except Exception as error:
            self._fs.delete(temporary, False)
            if "AlreadyExists" in str(error):
                raise Conflict(manifest["version"]) from error
            raise

    def _change(self, added: dict, removed: set[str], schema: str) -> bool:
        """Commit on top of whatever is newest; False if a removed run is gone already."""
        for _ in range(RETRIES):
            now = self.manifest()
            if now["schema"] not in (None, schema):
                raise ValueError("the arrival's schema differs from the store's")
            if not removed <= {r["id"] for r in now["runs"]}:
                return False
            runs = [r for r in now["runs"] if r["id"] not in removed] + [added]
            try:
                self._commit({"version": now["version"] + 1, "schema": schema, "runs": runs})
                return True
            except Conflict:
                continue
        raise Conflict("too many writers")

    # data

    def _write(self, df: DataFrame) -> dict:
        run = uuid.uuid4().hex
        df.write.parquet(f"{self.path}/data/{run}")
        return self._listed(run)

    def _listed(self, run: str) -> dict:
        found = [f for f in self._fs.listStatus(self._path(f"{self.path}/data/{run}")) if f.getPath().getName().endswith(".parquet")]
        return {"id": run, "files": sorted(f"data/{run}/{f.getPath().getName()}" for f in found), "bytes": sum(f.getLen() for f in found)}

    def append(self, arrival: DataFrame) -> None:
        """Add an arrival as one run."""
        self._change(self._write(arrival), set(), arrival.schema.json())

    def append_all(self, rows: DataFrame, by: Column, arrivals: int) -> int:
        """Add rows as that many arrivals, dealt by a hash of ``by``: one write, then a commit each. The number of runs."""
        run = uuid.uuid4().hex
        at = f"{self.path}/data/{run}"
        name = "_arrival"
        while name in (c.lower() for c in rows.columns):
            name = "_" + name
        rows.withColumn(name, F.pmod(F.xxhash64(by), F.lit(arrivals)).cast("int")).write.partitionBy(name).parquet(at)
        parts = sorted((f.getPath().getName() for f in self._fs.listStatus(self._path(at)) if f.isDirectory()), key=lambda p: int(p.split("=")[1]))
        for part in parts:
            self._change(self._listed(f"{run}/{part}"), set(), rows.schema.json())
        return len(parts)

    def tier(self, size: int) -> int:
        n = 0
        while size >= self.smallest and n < 60:
            size, n = size // self.fan_in, n + 1
        return n

    def compact(self, vacuum: bool = False) -> int:
        """Merge until no tier has fan_in runs that are worth it, optionally with vacuum() after each round; the number of merges."""
        merges = 0
        while True:
            now = self.manifest()
            tiers: dict[int, list[dict]] = {}
            for r in now["runs"]:
                if r["bytes"] < self.target * self.fan_in * max(1, len(r["files"])) and not self._done(r):
                    tiers.setdefault(self.tier(r["bytes"]), []).append(r)
            full = [own[i : i + self.fan_in] for own in tiers.values() for i in range(0, len(own) - self.fan_in + 1, self.fan_in)]
            if not full:
                return merges
            with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
                list(pool.map(lambda runs: self.merge(runs, now["schema"]), full))
            merges += len(full)
            if vacuum:
                self.vacuum()

    def _done(self, run: dict) -> bool:
        """A run whose files have the target size already gains nothing from a merge."""
        return run["bytes"] >= 0.75 * self.target * len(run["files"]) > 0

    def merge(self, runs: list[dict], schema: str) -> None:
        """Replace runs by one with files of about the target size."""
        size = sum(r["bytes"] for r in runs)
        df = self._frame([f for r in runs for f in r["files"]], schema).coalesce(max(1, round(size / self.target)))
        self._change(self._write(df), {r["id"] for r in runs}, schema)

    def _frame(self, files: list[str], schema: str) -> DataFrame:
        kind = T.StructType.fromJson(json.loads(schema))
        if not files:
            return self.spark.createDataFrame([], kind)
        return self.spark.read.schema(kind).parquet(*(f"{self.path}/{f}" for f in files))

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, by default the newest."""
        now = self.manifest(version)
        if now["schema"] is None:
            raise ValueError("the store is empty")
        return self._frame([f for r in now["runs"] for f in r["files"]], now["schema"])

    def vacuum(self, keep: int = 1) -> None:
        """Delete manifests but the newest ``keep``, and runs that none of these names. Not beside a writer."""
        versions = self.versions()
        named = {r["id"] for v in versions[-keep:] for r in self.manifest(v)["runs"]}
        for v in versions[:-keep]:
            self._fs.delete(self._path(self._name(v)), False)
        heads = {n.split("/")[0] for n in named}
        for f in self._fs.listStatus(self._path(f"{self.path}/data")):
            name = f.getPath().getName()
            if name not in heads:
                self._fs.delete(f.getPath(), True)
            elif name not in named:  # a batch of arrivals: each of them is a run
                for part in self._fs.listStatus(f.getPath()):
                    if part.isDirectory() and f"{name}/{part.getPath().getName()}" not in named:
                        self._fs.delete(part.getPath(), True)
