"""A keyed state in hash buckets, of which a write touches only those that have an incoming key.

``data/<version>/state_bucket=<k>`` holds the parquet files that one write made for a bucket; a manifest names the versions that each bucket is read from.
A write first puts its files under a version of its own, then its manifest into place with one rename.  Until then readers see the
manifest before it, and what a killed writer leaves is in no manifest.  Two writers that began from one manifest both want the next
number, and the later one fails.  This needs a file system whose rename is atomic, such as HDFS.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cohortline.operators import keys as by_key
from cohortline.session import staged

BUCKET = "state_bucket"
MANIFESTS, DATA = "manifests", "data"


class Conflict(RuntimeError):
    """Another writer has put its manifest into place first."""


@dataclass(frozen=True)
class Manifest:
    """What a state consists of: ``files[bucket]`` are the versions that hold the bucket's rows."""

    number: int
    keys: list[str]
    buckets: int
    schema: StructType
    files: dict[int, list[str]]

    def text(self) -> str:
        return json.dumps(
            {"keys": self.keys, "buckets": self.buckets, "schema": self.schema.jsonValue(), "files": {str(b): v for b, v in sorted(self.files.items())}}
        )


class BucketedState:
    """A state table under ``path``; every method reads the newest manifest anew."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    @staticmethod
    def create(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> BucketedState:
        """A new state from ``df``, which holds one row per key."""
        state = BucketedState(df.sparkSession, path)
        if state._numbers():
            raise FileExistsError(path)
        empty = Manifest(0, list(keys), buckets, df.schema, {})
        state._publish(empty, state._write(df, empty), replaced=set())
        return state

    def manifest(self) -> Manifest:
        numbers = self._numbers()
        if not numbers:
            raise FileNotFoundError(f"no state under {self.path}")
        name = f"{self.path}/{MANIFESTS}/{numbers[-1]:010d}.json"
        found = json.loads("".join(r.value for r in self.spark.read.text(name, wholetext=True).collect()))
        files = {int(b): v for b, v in found["files"].items()}
        return Manifest(numbers[-1], found["keys"], found["buckets"], StructType.fromJson(found["schema"]), files)

    def read(self) -> DataFrame:
        """The state as the newest manifest has it."""
        now = self.manifest()
        return self._read(now, now.files)

    def replace(self, incoming: DataFrame) -> Manifest:
        """Put: incoming rows replace the stored rows of their keys."""
        return self._rewrite(incoming, lambda old, new, now: by_key.upsert_replace(old, new, now.keys))

    def patch(self, patch: DataFrame, columns: Sequence[str], create: bool = False) -> Manifest:
        """Update the named columns of stored keys; with ``create`` an unknown key becomes a row."""
        return self._rewrite(patch, lambda old, new, now: by_key.upsert_patch(old, new, now.keys, columns, create))

    def insert(self, incoming: DataFrame) -> Manifest:
        """Insert if absent.  Stored files stay as they are; a bucket with new keys gets one more version to be read with it."""
        now = self.manifest()
        fresh = staged(self._checked(incoming, now), "state-incoming")
        old = self._read(now, self._touched(fresh, now))
        absent = by_key.absent_from(fresh, old, now.keys).select(*now.schema.names)
        return self._publish(now, self._write(absent, now), replaced=set())

    def compact(self, more_than: int = 8) -> Manifest:
        """Rewrite the buckets that are read from more than so many versions."""
        now = self.manifest()
        many = {b for b, versions in now.files.items() if len(versions) > more_than}
        if not many:
            return now
        return self._publish(now, self._write(self._read(now, many), now), replaced=many)

    def vacuum(self) -> None:
        """Delete versions and manifests that the newest manifest doesn't need; no reader or writer of older ones may be at work."""
        now, (system, path) = self.manifest(), self._system()
        needed = {v for versions in now.files.values() for v in versions}
        for folder, keep in ((DATA, needed), (MANIFESTS, {f"{now.number:010d}.json"})):
            for status in system.listStatus(path(f"{self.path}/{folder}")):
                if status.getPath().getName() not in keep:
                    system.delete(status.getPath(), True)

    def _rewrite(self, incoming: DataFrame, change: Callable[[DataFrame, DataFrame, Manifest], DataFrame]) -> Manifest:
        """Change the buckets that have an incoming key, and no others."""
        now = self.manifest()
        fresh = staged(self._keyed(incoming, now), "state-incoming")
        touched = self._touched(fresh, now)
        changed = change(self._read(now, touched), fresh, now)
        return self._publish(now, self._write(changed, now), replaced=touched)

    def _keyed(self, incoming: DataFrame, now: Manifest) -> DataFrame:
        """``incoming`` with its keys in the state's types, so that equal keys share a bucket."""
        types = {f.name: f.dataType for f in now.schema}
        return incoming.withColumns({k: F.col(k).cast(types[k]) for k in now.keys})

    def _checked(self, incoming: DataFrame, now: Manifest) -> DataFrame:
        if sorted(incoming.columns) != sorted(now.schema.names):
            raise ValueError(f"columns on one side only: {sorted(set(incoming.columns) ^ set(now.schema.names))}")
        return self._keyed(incoming, now).select(*now.schema.names)

    def _touched(self, incoming: DataFrame, now: Manifest) -> set[int]:
        """Buckets of the incoming keys: at most one value for each bucket."""
        return {r[BUCKET] for r in incoming.select(bucket_of(now)).distinct().collect()}

    def _read(self, now: Manifest, buckets: set[int] | dict) -> DataFrame:
        paths = [f"{self.path}/{DATA}/{v}/{BUCKET}={b}" for b in sorted(buckets) for v in now.files.get(b, [])]
        if not paths:
            return self.spark.createDataFrame([], now.schema)
        return self.spark.read.schema(now.schema).parquet(*paths)

    def _write(self, df: DataFrame, now: Manifest) -> str:
        """Files of a new version; its name is unknown to any manifest yet."""
        version = f"{now.number + 1:010d}-{uuid.uuid4().hex}"
        rows = df.select(*now.schema.names, bucket_of(now)).repartition(BUCKET).sortWithinPartitions(BUCKET, *now.keys)
        rows.write.partitionBy(BUCKET).parquet(f"{self.path}/{DATA}/{version}")
        return version

    def _publish(self, now: Manifest, version: str, replaced: set[int]) -> Manifest:
        """Put the next manifest into place, after the files that it names."""
        system, path = self._system()
        names = [s.getPath().getName() for s in system.listStatus(path(f"{self.path}/{DATA}/{version}"))]
        written = {int(n.partition("=")[2]) for n in names if n.startswith(BUCKET + "=")}
        files = {b: v for b, v in now.files.items() if b not in replaced}
        for b in written:
            files[b] = [*files.get(b, []), version]
        after = Manifest(now.number + 1, now.keys, now.buckets, now.schema, files)
        attempt = path(f"{self.path}/{MANIFESTS}/_{uuid.uuid4().hex}")
        out = system.create(attempt, False)
        out.write(bytearray(after.text().encode()))
        out.close()
        self._swap(attempt, path(f"{self.path}/{MANIFESTS}/{after.number:010d}.json"))
        return after

    def _swap(self, attempt, final) -> None:
        """The one rename that makes a write visible; it never replaces another writer's manifest."""
        jvm, context = self.spark._jvm, self.spark.sparkContext
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), context._jsc.hadoopConfiguration())
        none = context._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            files.rename(attempt, final, none)
        except Exception as error:
            if "FileAlreadyExistsException" in str(error):
                raise Conflict(f"{final} is another writer's") from error
            raise

    def _system(self):
        """The file system of the state, and a function that makes its paths."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        return path(self.path).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def _numbers(self) -> list[int]:
        system, path = self._system()
        folder = path(f"{self.path}/{MANIFESTS}")
        if not system.exists(folder):
            return []
        names = [s.getPath().getName() for s in system.listStatus(folder)]
        return sorted(int(n[:10]) for n in names if n.endswith(".json") and not n.startswith("_"))


def bucket_of(now: Manifest) -> Column:
    return F.pmod(F.xxhash64(*now.keys), F.lit(now.buckets)).cast("int").alias(BUCKET)
