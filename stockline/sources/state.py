"""State between runs (S7, S9, S10): versioned snapshots, ledgers, audit.

The reference overwrites one CSV "base" in place. Here each run writes
version n+1 next to version n, so a plan never overwrites its own input
and a failed or retried run leaves the last committed version intact.
A version counts only once Spark's commit protocol has written its
``_SUCCESS`` marker; a half-written folder from a lost executor or a
killed job is ignored and simply rewritten by the retry.
"""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _order(tag: str):
    """Snapshot ids in their order: numbers by value, before other names."""
    return (0, int(tag), "") if tag.isdigit() else (1, 0, tag)


class SnapshotStore:
    """Versioned Parquet snapshots under ``root``: ``root/v=00000001`` …, or
    ``root/v=00000001-<tag>`` for one that a snapshot with an id produced:
    the id is committed with the data, by the same ``_SUCCESS``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _committed(self) -> dict[int, str]:
        fs, p = _fs(self.spark, self.root)
        if not fs.exists(p):
            return {}
        out = {}
        for st in fs.listStatus(p):
            name = st.getPath().getName()
            if st.isDirectory() and name.startswith("v="):
                ok = self.spark._jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")
                if fs.exists(ok):
                    out[int(name[2:].partition("-")[0])] = name
        return out

    def versions(self) -> list[int]:
        return sorted(self._committed())

    def path(self, version: int, tag: str | None = None) -> str:
        """Folder of a committed version, or the one to write it to."""
        name = self._committed().get(version) or f"v={version:08d}" + (f"-{tag}" if tag is not None else "")
        return f"{self.root}/{name}"

    def latest(self) -> int | None:
        v = self.versions()
        return v[-1] if v else None

    def read(self, schema: StructType | None = None, version: int | None = None) -> DataFrame | None:
        """The committed snapshot (latest by default); ``None`` when there is
        none yet, or an empty frame of ``schema`` if one is given."""
        v = self.latest() if version is None else version
        if v is None:
            return self.spark.createDataFrame([], schema) if schema is not None else None
        return self.spark.read.parquet(self.path(v))

    def commit(self, df: DataFrame, tag: str | None = None, version: int | None = None) -> int:
        """Write ``df`` as version ``version`` (default: the next one) and
        return its number. ``tag`` is the id of the snapshot behind it."""
        nxt = (self.latest() or 0) + 1 if version is None else version
        df.write.mode("overwrite").parquet(self.path(nxt, tag))
        return nxt

    def latest_tag(self) -> str | None:
        """The highest snapshot id committed so far, if any."""
        tags = [t for t in (name.partition("-")[2] for name in self._committed().values()) if t]
        return max(tags, key=_order, default=None)

    def applied(self, tag: str) -> bool:
        """Whether a snapshot id is at or below the last committed one."""
        last = self.latest_tag()
        return last is not None and _order(tag) <= _order(last)


def append_ledger(df: DataFrame, path: str, run_ts: str) -> None:
    """Add a run's processed keys to a ledger (S10) as the partition of that
    run, which a retry overwrites; readers take the union."""
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/run_ts={quote(run_ts, safe="")}")


def write_audit(df: DataFrame, path: str, run_ts: str) -> None:
    """Run-stamped audit log (S7): one partition a run, overwritten by a
    retry."""
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/run_ts={quote(run_ts, safe="")}")
