"""The reference runs on a schedule and diffs each new export against a
base file. As a stream: snapshots land in a folder as Parquet with a
``snapshot_id`` column and, as their mark of completeness, the number of
rows of the whole snapshot in ``snapshot_rows``. A micro-batch stages the
rows it has of each snapshot; a snapshot is applied once all its rows are
staged, however many triggers they took, in id order and against the
committed base: changes are written to the outbox, then the next base
version is committed together with the id. Ids at or below the last
committed one are skipped, so a replay changes nothing.

State of the stream: staged rows lie in folders by trigger and snapshot;
only those of open snapshots are read, and a snapshot's folders are removed
once it is applied or passed over, so staging holds open snapshots only.

Defined cases: a file that lands twice counts once (equal rows of a snapshot
are one row); an empty snapshot is announced by one row whose other columns
are NULL and whose ``snapshot_rows`` is 0, and every key leaves; a snapshot
without a row count, with several counts or with more rows than announced never
becomes complete. A snapshot that is not complete holds back later ones until
``patience`` of them are complete; then it is passed over (each snapshot is
whole, so the base follows the later one) and listed under ``<state>-skipped``.
``trigger(availableNow=True)`` processes what has landed and stops, so a
scheduler can run it like the batch job.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..plans.cycles import SNAPSHOT_KEYS, run_cycle, snapshots
from ..session import ensure_checkpoint_dir
from ..sources import SnapshotStore
from ..sources.state import _fs

MARKS = ["snapshot_id", "snapshot_rows"]


class Staging:
    """Rows of open snapshots under ``root``: ``epoch=<e>/snapshot_id=<s>``."""

    def __init__(self, spark: SparkSession, root: str, schema: StructType):
        self.spark, self.root, self.schema = spark, root, schema

    def add(self, batch: DataFrame, epoch_id: int) -> None:
        """One folder per trigger, overwritten when the trigger is repeated."""
        (batch.withColumn("_id", F.col("snapshot_id")).filter("snapshot_id IS NOT NULL")
         .write.mode("overwrite").partitionBy("_id").parquet(f"{self.root}/epoch={epoch_id}"))

    def rows(self, after: int | None) -> DataFrame | None:
        """Staged rows of the snapshots after an id; folders of others are not
        read. Equal rows are one; marks of empty snapshots have no keys."""
        fs, path = _fs(self.spark, self.root)
        if not fs.exists(path):
            return None
        schema = StructType(list(self.schema.fields)).add("_id", "long").add("epoch", "long")
        staged = self.spark.read.schema(schema).option("basePath", self.root).parquet(self.root)
        if after is not None:
            staged = staged.filter(F.col("_id") > after)
        return staged.drop("_id", "epoch").distinct()

    def drop_up_to(self, snapshot_id: int) -> None:
        """Remove the folders of the snapshots up to an id."""
        fs, path = _fs(self.spark, self.root)
        for epoch in fs.listStatus(path) if fs.exists(path) else []:
            left = 0
            for st in fs.listStatus(epoch.getPath()):
                name = st.getPath().getName()
                if name.startswith("_id=") and int(name[4:]) <= snapshot_id:
                    fs.delete(st.getPath(), True)
                else:
                    left += name.startswith("_id=")
            if not left:
                fs.delete(epoch.getPath(), True)


def _open_snapshots(staged: DataFrame) -> list:
    """One row for each open snapshot, in order: id, rows, whether complete."""
    data = [c for c in staged.columns if c not in MARKS]
    is_mark = F.lit(True)
    for c in data:
        is_mark = is_mark & F.col(c).isNull()
    found = (staged.withColumn("_mark", is_mark & (F.col("snapshot_rows") == 0)).groupBy("snapshot_id")
             .agg(F.count_if(~F.coalesce("_mark", F.lit(False))).alias("n"), F.min("snapshot_rows").alias("rows"),
                  (F.count_if(F.col("snapshot_rows").isNull()) == 0).alias("announced"),
                  (F.min("snapshot_rows") == F.max("snapshot_rows")).alias("agreed")))
    complete = F.col("announced") & F.coalesce("agreed", F.lit(False)) & (F.col("n") == F.col("rows"))
    return found.select("snapshot_id", "n", "rows", F.coalesce(complete, F.lit(False)).alias("complete")).orderBy("snapshot_id").collect()


def to_apply(found: list, patience: int | None) -> tuple[list, list]:
    """(ids to apply in order, rows of snapshots passed over) of the open
    snapshots: up to the first that is not complete, and past it once
    ``patience`` later ones are."""
    apply, skipped = [], []
    for k, snapshot in enumerate(found):
        if snapshot["complete"]:
            apply.append(snapshot["snapshot_id"])
        elif patience is not None and sum(s["complete"] for s in found[k + 1:]) >= patience:
            skipped.append(snapshot)
        else:
            break
    return apply, skipped


def start_stream_cycle(spark: SparkSession, snapshot_dir: str, schema: StructType, state_dir: str,
                       outbox_path: str, keys=SNAPSHOT_KEYS, name: str = "stream_cycle",
                       patience: int | None = None) -> StreamingQuery:
    """Start the cycle over ``snapshot_dir``; ``schema`` includes the columns
    of ``MARKS``. ``patience``: complete snapshots after which an incomplete
    one is passed over (None: it is waited for)."""
    ckpt = f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{name}"
    store = SnapshotStore(spark, state_dir)
    staging = Staging(spark, f"{state_dir.rstrip('/')}-staging", schema)

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        staging.add(batch, epoch_id)
        last = store.latest_tag()
        last = int(last) if last is not None and last.isdigit() else None
        staged = staging.rows(last)
        if staged is None:
            return
        apply, skipped = to_apply(_open_snapshots(staged), patience)
        if skipped:
            rows = [(s["snapshot_id"], s["n"], s["rows"], epoch_id) for s in skipped]
            (spark.createDataFrame(rows, "snapshot_id long, n long, snapshot_rows long, epoch long").coalesce(1)
             .write.mode("overwrite").parquet(f"{state_dir.rstrip('/')}-skipped/epoch={epoch_id}"))
        for snapshot_id in apply:
            # the rows of the snapshot; a mark of emptiness has no key
            rows = staged.filter(F.col("snapshot_id") == snapshot_id).drop(*MARKS).dropna(subset=list(keys))
            run_cycle(store, rows, outbox_path, keys, tag=str(snapshot_id))
        if apply:
            staging.drop_up_to(apply[-1])

    src = spark.readStream.schema(schema).parquet(snapshot_dir)
    return (src.writeStream.foreachBatch(on_batch).option("checkpointLocation", ckpt)
            .trigger(availableNow=True).start())


def with_marks(snapshot: DataFrame, snapshot_id: int) -> DataFrame:
    """The snapshot with its id and its number of distinct rows."""
    return snapshot.withColumn("snapshot_id", F.lit(snapshot_id)).withColumn("snapshot_rows", F.lit(snapshot.distinct().count()))


def empty_mark(schema: StructType, spark: SparkSession, snapshot_id: int) -> DataFrame:
    """The row that announces an empty snapshot; ``schema`` as the stream's."""
    one = spark.range(1)
    return one.select(*[F.lit(snapshot_id if f.name == "snapshot_id" else 0 if f.name == "snapshot_rows" else None)
                        .cast(f.dataType).alias(f.name) for f in schema])


def stream_cycle(spark: SparkSession, d: str) -> DataFrame:
    """Registered form (§2.12): land the base and today's snapshots of the
    binding (``orders``), run the stream over them to its end and return
    the committed base — equal to ``cycle_next_base``."""
    today, base = snapshots(spark, d)
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stream-cycle/{uuid.uuid4().hex}"
    with_marks(base, 1).write.parquet(f"{root}/snapshots/1")
    with_marks(today, 2).write.parquet(f"{root}/snapshots/2")
    schema = spark.read.parquet(f"{root}/snapshots/1").schema
    q = start_stream_cycle(spark, f"{root}/snapshots/*", schema, f"{root}/state", f"{root}/outbox",
                           name=f"stream-cycle-{uuid.uuid4().hex}")
    q.awaitTermination()
    return SnapshotStore(spark, f"{root}/state").read()
