"""A base kept in buckets of its key.

The base of a cycle is large and changes little. It is a Parquet table
partitioned by bucket and version and clustered by the key, so that

* a join with it on the key reads it as it lies: only the other side is
  exchanged, to the base's buckets;
* a cycle rewrites the buckets with a change and no others.

Which version of each bucket is the current one stands in a manifest, a few
numbers a bucket, kept as versioned snapshots: a cycle writes its buckets under
a new version first and commits the manifest last. A run that fails in between
leaves the base as it was; its retry replaces what was written. Folders that
no kept manifest names are removed by ``vacuum``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .state import SnapshotStore, _fs

BUCKET, VERSION = "_bucket", "_version"


class BucketedBase:
    """The base under ``root``, ``buckets`` buckets of ``keys``; ``schema``
    holds the keys and the other columns. Rows with a NULL key are not kept."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, keys: Sequence[str], buckets: int):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.keys, self.buckets = list(keys), buckets
        self.manifest = SnapshotStore(spark, f"{self.root}/manifest")
        self.table = f"base_{hashlib.md5(self.root.encode()).hexdigest()}"  # noqa: S324 - a name, not a secret
        self._define()

    def _define(self) -> None:
        """The table over the folder, anew, so that its files are listed again."""
        def quoted(names):
            return ", ".join(f"`{n}`" for n in names)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema)
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
        self.spark.sql(
            f"CREATE TABLE {self.table} ({columns}, `{BUCKET}` INT, `{VERSION}` INT) USING parquet "
            f"PARTITIONED BY ({quoted([BUCKET, VERSION])}) CLUSTERED BY ({quoted(self.keys)}) INTO {self.buckets} BUCKETS "
            f"LOCATION '{self.root}/data'")
        fs, data = _fs(self.spark, f"{self.root}/data")
        if fs.exists(data):
            self.spark.catalog.recoverPartitions(self.table)

    def bucket_of(self) -> F.Column:
        """The bucket that Spark's clustering gives a row."""
        return F.pmod(F.hash(*self.keys), F.lit(self.buckets)).cast("int")

    def current(self, version: int | None = None) -> dict[int, int]:
        """Version of each bucket that has been written (one number a bucket)."""
        rows = self.manifest.read(T.StructType([T.StructField(BUCKET, T.IntegerType()), T.StructField(VERSION, T.IntegerType())]), version)
        return {r[BUCKET]: r[VERSION] for r in rows.collect()}

    def version(self) -> int:
        return self.manifest.latest() or 0

    def read(self, only: Sequence[int] | None = None) -> DataFrame:
        """The committed base, or some of its buckets. The filter is on the
        partition columns alone, so no other folder is read."""
        wanted = {b: v for b, v in self.current().items() if only is None or b in set(only)}
        by_version: dict[int, list[int]] = {}
        for b, v in wanted.items():
            by_version.setdefault(v, []).append(b)
        kept = F.lit(False)
        for v, bs in by_version.items():
            kept = kept | ((F.col(VERSION) == v) & F.col(BUCKET).isin(bs))
        return self.spark.table(self.table).filter(kept).select(*self.schema.fieldNames())

    def rewrite(self, rows: DataFrame, changed: Sequence[int], tag: str | None = None) -> int:
        """Make ``rows`` the content of the buckets ``changed`` (those without
        a row become empty) and commit; the other buckets stay as they are."""
        nxt = self.version() + 1
        fs, _ = _fs(self.spark, self.root)
        for b in changed:  # what a failed run left; a bucket without rows would not overwrite it
            fs.delete(_fs(self.spark, f"{self.root}/data/{BUCKET}={b}/{VERSION}={nxt}")[1], True)
        before = self.spark.conf.get("spark.sql.sources.partitionOverwriteMode", "static")
        self.spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        try:
            (rows.select(*self.schema.fieldNames(), self.bucket_of().alias(BUCKET), F.lit(nxt).alias(VERSION))
             .repartition(max(1, min(len(changed), self.buckets)), BUCKET).write.insertInto(self.table, overwrite=True))
        finally:
            self.spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
        manifest = {**self.current(), **{b: nxt for b in changed}}
        self.manifest.commit(self.spark.createDataFrame(sorted(manifest.items()), f"{BUCKET} int, {VERSION} int").coalesce(1),
                             tag=tag, version=nxt)
        self._define()
        return nxt

    def vacuum(self, keep: int = 2) -> int:
        """Remove bucket folders that none of the last ``keep`` manifests names;
        the number of folders removed."""
        named = {(b, v) for n in self.manifest.versions()[-keep:] for b, v in self.current(n).items()}
        fs, data = _fs(self.spark, f"{self.root}/data")
        removed = 0
        for bucket in fs.listStatus(data) if fs.exists(data) else []:
            b = bucket.getPath().getName().partition("=")
            if b[0] != BUCKET:
                continue
            for version in fs.listStatus(bucket.getPath()):
                v = version.getPath().getName().partition("=")
                if v[0] == VERSION and (int(b[2]), int(v[2])) not in named and int(v[2]) <= self.version():
                    fs.delete(version.getPath(), True)
                    removed += 1
        self._define()
        return removed
