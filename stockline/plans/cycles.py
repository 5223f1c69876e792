"""Stateful cycles between runs.

State is a versioned snapshot (``SnapshotStore``): a run reads version n,
computes its changes and the next base as one plan, writes the outbox,
then commits version n+1. A failed run leaves n in place and the retry
recomputes the same changes; nothing is overwritten in place.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import ROWS_A_TASK, key_changes, parts_of, row_diff, row_diff_both
from ..session import ensure_checkpoint_dir
from ..sources import BucketedBase, SnapshotStore, read_delimited, read_table, write_delimited
from . import bindings as B
from .feeds import first_error, response_of

SNAPSHOT_KEYS = ["order_key"]


def snapshots(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(today, base) snapshots of (key, status, price) from ``orders``
    (binding): today drops key % 10 = 0, base drops key % 10 = 1 and shows
    status 'X' where key % 7 = 0."""
    o = read_table(spark, d, "orders").select(F.col("o_orderkey").alias("order_key"),
                                              F.col("o_orderstatus").alias("status"),
                                              F.col("o_totalprice").alias("price"))
    today = o.filter(F.col("order_key") % 10 != 0)
    base = o.filter(F.col("order_key") % 10 != 1).withColumn(
        "status", F.when(F.col("order_key") % 7 == 0, F.lit("X")).otherwise(F.col("status")))
    return today, base


def cycle_row_diff(today: DataFrame, base: DataFrame) -> DataFrame:
    """Rows of today absent from base over all columns."""
    return row_diff(today, base)


def cycle_flags(today: DataFrame, base: DataFrame) -> DataFrame:
    """Additions flagged active, removals inactive."""
    return row_diff_both(today, base, flag="is_active")


def _parts(today: DataFrame, base: DataFrame, rows_a_task: int | None) -> int | None:
    return parts_of(today, base, rows_a_task=rows_a_task) if rows_a_task else None


def cycle_diff(today: DataFrame, base: DataFrame, keys=SNAPSHOT_KEYS, rows_a_task: int | None = None) -> DataFrame:
    """Keys entering and leaving (C3); ``rows_a_task`` bounds the rows of a
    task of the joins."""
    return key_changes(today, base, keys, parts=_parts(today, base, rows_a_task)).filter(F.col("change") != "keep")


def cycle_next_base(today: DataFrame, base: DataFrame, keys=SNAPSHOT_KEYS, rows_a_task: int | None = None) -> DataFrame:
    """Next base = base ∪ enter ∖ leave."""
    return key_changes(today, base, keys, parts=_parts(today, base, rows_a_task)).filter(F.col("change") != "leave").drop("change")


def run_cycle(store: SnapshotStore, today: DataFrame, outbox_path: str, keys=SNAPSHOT_KEYS,
              tag: str | None = None) -> int | None:
    """One scheduled cycle (S9): changes against the committed base go to
    the outbox, then the next base is committed as a new version. With no
    base yet, today becomes version 1 and everything counts as entering.

    Retry-safe: the outbox partition is named after the version being
    produced and overwritten, so a run that failed after writing it and is
    retried replaces, not duplicates, its changes. A snapshot whose ``tag``
    is at or below the last committed one was already applied and is
    skipped (a replayed stream batch)."""
    if tag is not None and store.applied(str(tag)):
        return store.latest()
    base = store.read()
    if base is None:
        base = today.filter(F.lit(False))  # no committed base yet: empty, same schema
    nxt = (store.latest() or 0) + 1
    changes = cycle_diff(today, base, keys, ROWS_A_TASK)
    changes.write.mode("overwrite").parquet(f"{outbox_path.rstrip('/')}/version={nxt}")
    return store.commit(cycle_next_base(today, base, keys, ROWS_A_TASK), tag=None if tag is None else str(tag), version=nxt)


def run_bucketed_cycle(base: BucketedBase, today: DataFrame, outbox_path: str, tag: str | None = None) -> list[int]:
    """One scheduled cycle (S9, C3) over a base kept in buckets; the buckets it
    rewrote. The join exchanges today's rows only; the changes go to the outbox
    partition of the new version (overwritten by a retry), and the base's
    changed buckets are made from it and their own old rows."""
    if tag is not None and base.manifest.applied(str(tag)):
        return []
    out = f"{outbox_path.rstrip('/')}/version={base.version() + 1}"
    key_changes(today, base.read(), base.keys).filter(F.col("change") != "keep").write.mode("overwrite").parquet(out)
    changes = base.spark.read.parquet(out)
    changed = sorted(r[0] for r in changes.select(base.bucket_of()).distinct().collect())  # at most one number a bucket
    columns = base.schema.fieldNames()
    stay = base.read(changed).join(changes.filter("change = 'leave'").select(*base.keys).distinct(), base.keys, "left_anti")
    base.rewrite(stay.select(*columns).unionByName(changes.filter("change = 'enter'").select(*columns)), changed,
                 tag=None if tag is None else str(tag))
    return changed


def bucketed_next_base(spark: SparkSession, d: str, buckets: int | None = None) -> DataFrame:
    """Registered form: the binding's base is laid in buckets, today's cycle is
    run over it and the committed base is read; equal to ``cycle_next_base``."""
    today, old = snapshots(spark, d)
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/bucketed/{uuid.uuid4().hex}"
    # with fewer buckets than shuffle partitions Spark would exchange both sides
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = BucketedBase(spark, f"{root}/base", today.schema, SNAPSHOT_KEYS, n)
    run_bucketed_cycle(base, old, f"{root}/outbox", tag="1")
    run_bucketed_cycle(base, today, f"{root}/outbox", tag="2")
    return base.read()


def ledger_sets(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(input, done, failed) for the idempotent work list: input is every item
    code; done and failed are read from the landed responses to the codes that
    were sent (binding: keys divisible by 4 in a run that applied them, keys
    divisible by 9 in one that rejected them). A code sent in both runs has an
    entry in either ledger."""
    it = B.items(spark, d).select("code", "item_key")

    def run(every: int, rejected: bool) -> DataFrame:
        return it.filter(F.col("item_key") % every == 0).select("code", response_of(F.lit(rejected)).alias("response"))

    settled = run(4, False).unionByName(run(9, True)).select("code", first_error(F.col("response")).alias("message"))
    return (it.select("code"), settled.filter("message IS NULL").select("code"),
            settled.filter("message IS NOT NULL").select("code"))


def ledger_todo(todo_input: DataFrame, done: DataFrame, failed: DataFrame | None = None, key: str = "code") -> DataFrame:
    """Work still to do (C11): input ∖ done ∖ failed."""
    out = todo_input.join(done.select(key), key, "left_anti")
    if failed is not None:
        out = out.join(failed.select(key), key, "left_anti")
    return out


def ledger_append(done: DataFrame, processed: DataFrame) -> DataFrame:
    """The ledger after a run (S10, U4): old entries plus this run's."""
    return done.unionByName(processed, allowMissingColumns=True)


def audit_log(changes: DataFrame, run_ts: str) -> DataFrame:
    """Run-stamped audit rows (S7); ``sources.write_audit`` appends them
    partitioned by ``run_ts``."""
    return changes.withColumn("run_ts", F.lit(run_ts))


CSV_SCHEMA = T.StructType([
    T.StructField("variant_id", T.StringType()), T.StructField("sku", T.StringType()),
    T.StructField("title", T.StringType()), T.StructField("price", T.DoubleType()),
    T.StructField("compare_at_price", T.DoubleType()), T.StructField("inventory_quantity", T.LongType()),
    T.StructField("product_id", T.StringType()), T.StructField("product_title", T.StringType()),
    T.StructField("total_inventory", T.LongType()), T.StructField("total_variants", T.LongType()),
    T.StructField("media_count", T.LongType()), T.StructField("sku_2", T.StringType()),
])


def csv_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Delimited write and read back with a declared schema (S3, S4): the
    store variants through a ';' file in the shared checkpoint folder."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/csv/{uuid.uuid4().hex}"
    write_delimited(B.channel_variants(spark, d), path)
    return read_delimited(spark, path, CSV_SCHEMA)
