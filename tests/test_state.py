"""Versioned state, cycles across runs and the streaming re-aim."""

import os
import uuid

from pyspark.sql import functions as F

from stockline.plans.cycles import run_cycle
from stockline.session import ensure_checkpoint_dir
from stockline.sources import SnapshotStore


def _root(spark):
    return f"{ensure_checkpoint_dir(spark)}/test-{uuid.uuid4().hex}"


def test_snapshot_versions_and_cycles(spark):
    root = _root(spark)
    store = SnapshotStore(spark, f"{root}/state")
    out = f"{root}/outbox"
    day1 = spark.createDataFrame([(i, f"s{i}") for i in range(10)], "order_key long, status string")
    day2 = spark.createDataFrame([(i, f"s{i}") for i in range(5, 15)], "order_key long, status string")
    assert store.latest() is None
    assert run_cycle(store, day1, out) == 1
    assert run_cycle(store, day2, out) == 2
    assert sorted(r.order_key for r in store.read().collect()) == list(range(5, 15))
    ch = spark.read.parquet(out)
    assert ch.filter("change = 'enter'").count() == 15 and ch.filter("change = 'leave'").count() == 5
    # the same day again changes nothing
    assert run_cycle(store, day2, out) == 3
    assert spark.read.parquet(out).count() == 20


def test_uncommitted_version_is_ignored(spark):
    root = _root(spark)
    store = SnapshotStore(spark, root)
    store.commit(spark.range(3))
    os.makedirs(f"{root}/v=00000002")  # a half-written folder without _SUCCESS
    assert store.versions() == [1]


def test_stream_cycle(spark):
    from stockline.streaming import start_stream_cycle
    root = _root(spark)
    snaps = f"{root}/snapshots"
    schema = "order_key long, status string, snapshot_id int, snapshot_rows long"
    # snapshot 1 spans two files; both must be applied as one snapshot
    spark.createDataFrame([(1, "a", 1, 3), (2, "b", 1, 3), (5, "e", 1, 3)], schema).repartition(2).write.parquet(f"{snaps}/d1")
    spark.createDataFrame([(2, "new", 2, 2), (3, "c", 2, 2)], schema).coalesce(1).write.parquet(f"{snaps}/d2")
    st = spark.read.parquet(f"{snaps}/d1").schema
    q = start_stream_cycle(spark, f"{snaps}/*", st, f"{root}/state", f"{root}/outbox", name=uuid.uuid4().hex)
    q.awaitTermination()
    store = SnapshotStore(spark, f"{root}/state")
    assert store.latest() == 2 and store.latest_tag() == "2"
    assert sorted((r.order_key, r.status) for r in store.read().collect()) == [(2, "b"), (3, "c")]  # a kept key keeps its row
    out = spark.read.parquet(f"{root}/outbox")
    assert out.filter(F.col("change") == "enter").count() == 4 and out.filter(F.col("change") == "leave").count() == 2


def test_audit_and_ledger_append(spark):
    from stockline.sources import append_ledger, write_audit
    root = _root(spark)
    df = spark.createDataFrame([("a", 1), ("b", -2)], "sku string, delta int")
    write_audit(df, f"{root}/audit", "2024-01-01T00:00:00")
    write_audit(df.limit(1), f"{root}/audit", "2024-01-02T00:00:00")
    a = spark.read.parquet(f"{root}/audit")
    assert a.count() == 3 and a.select("run_ts").distinct().count() == 2
    for _ in range(2):  # a retry of the same run adds nothing
        write_audit(df.limit(1), f"{root}/audit", "2024-01-02T00:00:00")
        append_ledger(df.select("sku"), f"{root}/ledger", "2024-01-01")
        append_ledger(spark.createDataFrame([("c",)], "sku string"), f"{root}/ledger", "2024-01-02")
    assert spark.read.parquet(f"{root}/audit").count() == 3
    assert sorted(r.sku for r in spark.read.parquet(f"{root}/ledger").collect()) == ["a", "b", "c"]


def test_ledger_append_keeps_applied_codes_that_a_later_run_rejected(spark, sf001):
    from stockline.plans import bindings as B
    from stockline.plans import cycles as CY
    keys = {r.code: r.item_key for r in B.items(spark, sf001).select("code", "item_key").collect()}
    todo, done, failed = CY.ledger_sets(spark, sf001)
    both = {c for c, k in keys.items() if k % 36 == 0}
    assert both
    assert sorted(r.code for r in done.collect()) == sorted(c for c, k in keys.items() if k % 4 == 0)
    assert sorted(r.code for r in failed.collect()) == sorted(c for c, k in keys.items() if k % 9 == 0)
    ledger = sorted(r.code for r in CY.ledger_append(done, CY.ledger_todo(todo, done, failed)).collect())
    assert ledger == sorted(c for c, k in keys.items() if k % 4 == 0 or k % 9 != 0)


def test_j8_header_key_unique(spark, sf001):
    """The order header self-join (J8) is dropped because the key is unique."""
    o = spark.read.parquet(f"{sf001}/orders.parquet")
    assert o.count() == o.select("o_orderkey").distinct().count()


def test_cycle_retry_is_idempotent(spark):
    root = _root(spark)
    store = SnapshotStore(spark, f"{root}/state")
    out = f"{root}/outbox"
    day1 = spark.createDataFrame([(i, "x") for i in range(6)], "order_key long, status string")
    day2 = spark.createDataFrame([(i, "x") for i in range(3, 9)], "order_key long, status string")
    run_cycle(store, day1, out, tag="1")
    run_cycle(store, day2, out, tag="2")
    n = spark.read.parquet(out).count()
    # a replayed snapshot is skipped: no new version, no new changes
    assert run_cycle(store, day2, out, tag="2") == 2
    assert spark.read.parquet(out).count() == n
    assert run_cycle(store, day1, out, tag="1") == 2  # and so is an earlier one
    assert spark.read.parquet(out).count() == n and store.latest() == 2
    # a run that wrote its outbox but failed before committing, then retried,
    # overwrites the same outbox partition instead of appending twice
    from stockline.plans.cycles import cycle_diff
    day3 = spark.createDataFrame([(i, "y") for i in range(5)], "order_key long, status string")
    cycle_diff(day3, store.read(), ["order_key"]).write.mode("overwrite").parquet(f"{out}/version=3")
    run_cycle(store, day3, out, tag="3")
    v3 = spark.read.parquet(out).filter("version = 3")
    assert v3.count() == cycle_diff(day3, spark.read.parquet(store.path(2)), ["order_key"]).count()


def test_daily_run(spark, sf001):
    """Retries add nothing; flags are sent only where they differ from the last run."""
    from dataclasses import replace

    from stockline.jobs import bound_extracts, daily_run
    from stockline.registry import QUERIES
    root = _root(spark)
    x = bound_extracts(spark, sf001)

    def run(extracts, run_ts):
        return daily_run(spark, extracts, f"{root}/outbox", run_ts, f"{root}/state")

    def flags(run_ts):
        return spark.read.parquet(f"{root}/outbox/feed=flags/run_ts={run_ts}").count()

    paths = run(x, "2024-01-01T00")
    assert [p.split("feed=")[1].split("/")[0] for p in paths] == ["activation", "stock", "price", "flags"]
    first = flags("2024-01-01T00")
    run(x, "2024-01-01T00")  # retry of the same run
    ob = spark.read.parquet(f"{root}/outbox")
    assert ob.filter("feed = 'stock'").count() == QUERIES["feed_stock"](spark, sf001).count()
    assert ob.filter("feed = 'price'").count() == QUERIES["feed_price"](spark, sf001).count()
    assert ob.select("run_ts").distinct().count() == 1 and flags("2024-01-01T00") == first > 0
    run(x, "2024-01-02T00")  # nothing changed
    assert flags("2024-01-02T00") == 0
    one = F.col("item_key") == x.items.agg(F.min("item_key")).first()[0]
    changed = x.items.withColumn("type", F.when(one, F.lit("NEW")).otherwise(F.col("type")))
    run(replace(x, items=changed), "2024-01-03T00")
    assert flags("2024-01-03T00") == 1


def test_stream_waits_for_the_whole_snapshot(spark):
    """A snapshot whose files reach two triggers is applied once, whole."""
    from stockline.streaming import start_stream_cycle
    root = _root(spark)
    snaps = f"{root}/snapshots"
    schema = "order_key long, status string, snapshot_id int, snapshot_rows long"
    store = SnapshotStore(spark, f"{root}/state")

    def land(name, rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{snaps}/{name}")
        st = spark.read.parquet(f"{snaps}/{name}").schema
        start_stream_cycle(spark, f"{snaps}/*", st, f"{root}/state", f"{root}/outbox", name=f"whole-{root[-12:]}").awaitTermination()

    land("a", [(1, "a", 1, 2)])
    assert store.latest() is None
    land("b", [(2, "b", 1, 2), (7, "z", 2, 1)])
    assert sorted(r.order_key for r in store.read().collect()) == [7]
    out = spark.read.parquet(f"{root}/outbox")
    assert sorted((r.order_key, r.change) for r in out.collect()) == [(1, "enter"), (1, "leave"), (2, "enter"), (2, "leave"), (7, "enter")]


def test_cluster_session_must_name_its_folder():
    import pytest

    from stockline.session import ensure_checkpoint_dir as ensure

    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class Context:
        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure(Session())
