"""A table in hash buckets with a manifest for each version, so that an upsert rewrites only the buckets it touches.

    <path>/data/<part>/om_bucket=<b>/*.parquet     rows, in the part that last wrote their bucket
    <path>/manifest/<version>.json                 which part holds each bucket, the schema, and what has been applied

A write goes to a new part; the manifest that names it comes last, by a rename that fails if that version exists. So a
reader sees the old version or the new one, a job that dies in between leaves an unnamed part, and of two writers one
fails. A manifest has one entry a bucket: its size is set when the table is made and does not grow with the rows.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dedup import dedup_by_key
from ..session import materialize

BUCKETS = 1024
_BUCKET = "om_bucket"


class VersionConflict(RuntimeError):
    """Another writer has committed the same version."""


@dataclass(frozen=True)
class Manifest:
    version: int
    keys: list[str]
    buckets: int
    schema: T.StructType
    parts: dict[int, str]  # bucket: part; empty buckets have none
    applied: dict[str, int]  # source of batches: the last one that is in

    def to_json(self) -> str:
        return json.dumps({**self.__dict__, "schema": self.schema.jsonValue()}, sort_keys=True)

    @staticmethod
    def from_json(text: str) -> Manifest:
        raw = json.loads(text)
        return Manifest(**{**raw, "schema": T.StructType.fromJson(raw["schema"]), "parts": {int(b): p for b, p in raw["parts"].items()}})


class _Files:
    """The few file operations the driver needs, on whatever file system a path names."""

    def __init__(self, spark: SparkSession, root: str):
        self._context = spark.sparkContext
        self._jvm = self._context._jvm
        self._conf = self._context._jsc.hadoopConfiguration()
        self.root = root
        self._fs = self._path(root).getFileSystem(self._conf)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def names(self, folder: str) -> list[str]:
        path = self._path(f"{self.root}/{folder}")
        return [f.getPath().getName() for f in self._fs.listStatus(path)] if self._fs.exists(path) else []

    def delete(self, name: str) -> None:
        self._fs.delete(self._path(f"{self.root}/{name}"), True)

    def read(self, name: str) -> str:
        stream = self._fs.open(self._path(f"{self.root}/{name}"))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def commit(self, name: str, text: str) -> None:
        """Write under another name, then rename without replacing."""
        draft = f"{self.root}/drafts/{uuid.uuid4().hex}"
        stream = self._fs.create(self._path(draft), False)
        stream.write(bytearray(text.encode()))
        stream.close()
        target = self._path(f"{self.root}/{name}")
        self._fs.mkdirs(target.getParent())
        options = self._context._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        files = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
        try:
            files.rename(self._path(draft), target, options)
        except Exception as error:
            self._fs.delete(self._path(draft), False)
            if self._fs.exists(target):
                raise VersionConflict(f"{name} was committed by another writer") from error
            raise


def _any_null(keys: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


class BucketedTable:
    """Rows by key in `buckets` buckets. Keys must hash as they compare, so floating point columns are refused.

    Rows with a null in the key match no row of the table: an upsert keeps those that are there and adds the delta's,
    in which a null counts as one more key. They are dealt out by all their values, not gathered under the null.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self._files = spark, path, _Files(spark, path)

    # --- reading

    def versions(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in self._files.names("manifest") if n.endswith(".json"))

    def manifest(self, version: int | None = None) -> Manifest:
        known = self.versions()
        if not known or (version is not None and version not in known):
            raise FileNotFoundError(f"{self.path} has no version {'at all' if version is None else version}")
        return Manifest.from_json(self._files.read(f"manifest/{known[-1] if version is None else version:010d}.json"))

    def _rows(self, manifest: Manifest, buckets: set[int] | None = None) -> DataFrame:
        folders = [self._folder(b, p) for b, p in sorted(manifest.parts.items()) if buckets is None or b in buckets]
        if not folders:
            return self.spark.createDataFrame([], manifest.schema)
        return self.spark.read.schema(manifest.schema).parquet(*[f"{self.path}/{f}" for f in folders])

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, the latest by default."""
        return self._rows(self.manifest(version))

    def lookup(self, keys: DataFrame) -> DataFrame:
        """Rows whose key is among the given ones; only the buckets these fall into are read."""
        now = self.manifest()
        wanted = self._dealt(self._typed_keys(keys.select(*now.keys), now), now).distinct()
        wanted = materialize(wanted, "wanted")
        found = self._rows(now, _buckets_of(wanted))
        return found.join(wanted.drop(_BUCKET), now.keys, "left_semi")

    # --- writing

    @staticmethod
    def create(rows: DataFrame, path: str, keys: list[str], buckets: int = BUCKETS) -> BucketedTable:
        """Version 0, from rows as they are; repeated keys stay repeated until an upsert replaces them."""
        inexact = [f.name for f in rows.select(*keys).schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
        if inexact or not keys:
            raise ValueError(f"keys must be exact columns, not {inexact}")
        table = BucketedTable(rows.sparkSession, path)
        if table.versions():
            raise VersionConflict(f"{path} holds a table already")
        start = Manifest(0, list(keys), buckets, T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields]), {}, {})
        table._commit(replace(start, parts=table._write(table._dealt(rows, start))))
        return table

    def upsert(self, delta: DataFrame, order_by: list, source: str | None = None, batch: int | None = None) -> int:
        """Replace or add whole rows by key and return the version that holds them.

        Of delta rows with one key the first by `order_by` counts. Columns the delta lacks become null, others than the
        table's are left out. A batch of a source that is in already changes nothing, so a retry gives the same version.
        Rows of untouched buckets are neither read nor written. Base rows go by an anti join, which Spark can split where
        one key of the base has very many rows.
        """
        now = self.manifest()
        if source is not None and batch is not None and now.applied.get(source, -1) >= batch:
            return now.version
        latest = dedup_by_key(self._typed_keys(delta, now), now.keys, order_by)
        columns = [(F.col(f.name) if f.name in delta.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in now.schema.fields]
        new = materialize(self._dealt(latest.select(*columns), now), "delta")
        touched = _buckets_of(new)
        applied = {**now.applied, **({source: batch} if source is not None and batch is not None else {})}
        parts = dict(now.parts)
        if touched:
            names = new.filter(~_any_null(now.keys)).select(*now.keys)
            kept = self._rows(now, touched).join(names, now.keys, "left_anti").select(*now.schema.names)
            parts.update(self._write(self._dealt(kept, now).unionByName(new)))
        elif applied == now.applied:
            return now.version
        self._commit(replace(now, version=now.version + 1, parts=parts, applied=applied))
        return now.version + 1

    def vacuum(self, keep: int = 2) -> None:
        """Forget all but the last `keep` versions and remove the parts and buckets that none of these name.

        Not to be run while a write is under way: its part has no name yet. Readers of a removed version fail.
        """
        known = self.versions()
        kept = [self.manifest(v) for v in known[-keep:]]
        used = {(p, b) for m in kept for b, p in m.parts.items()}
        old = {(p, b) for v in known[:-keep] for b, p in self.manifest(v).parts.items()} - used
        for version in known[:-keep]:  # first the names, then what they named
            self._files.delete(f"manifest/{version:010d}.json")
        alive = {p for p, _ in used}
        for part in self._files.names("data"):
            if part not in alive:
                self._files.delete(f"data/{part}")
        for part, bucket in old:
            if part in alive:
                self._files.delete(self._folder(bucket, part))

    # --- inside

    @staticmethod
    def _folder(bucket: int, part: str) -> str:
        return f"data/{part}/{_BUCKET}={bucket}"

    @staticmethod
    def _typed_keys(rows: DataFrame, manifest: Manifest) -> DataFrame:
        """Keys in the table's own types, as an int and a long of one value hash differently."""
        return rows.withColumns({k: F.col(k).cast(manifest.schema[k].dataType) for k in manifest.keys})

    @staticmethod
    def _dealt(rows: DataFrame, manifest: Manifest) -> DataFrame:
        by = F.when(_any_null(manifest.keys), F.xxhash64(*[F.col(c) for c in rows.columns])).otherwise(F.xxhash64(*manifest.keys))
        return rows.withColumn(_BUCKET, F.pmod(by, F.lit(manifest.buckets)).cast("int"))

    def _write(self, dealt: DataFrame) -> dict[int, str]:
        """A new part. Rows are clustered by bucket, so a task opens few files; a bucket that is too large is split."""
        part = uuid.uuid4().hex
        dealt.hint("rebalance", _BUCKET).write.partitionBy(_BUCKET).parquet(f"{self.path}/data/{part}")
        prefix = f"{_BUCKET}="
        return {int(n.removeprefix(prefix)): part for n in self._files.names(f"data/{part}") if n.startswith(prefix)}

    def _commit(self, manifest: Manifest) -> None:
        self._files.commit(f"manifest/{manifest.version:010d}.json", manifest.to_json())


def _buckets_of(dealt: DataFrame) -> set[int]:
    """At most as many numbers as the table has buckets."""
    return {r[0] for r in dealt.select(_BUCKET).distinct().collect()}
