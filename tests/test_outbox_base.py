"""The bucketed base, the closed outbox loop, stream staging and forward fill."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from stockline.operators import ffill_by_key
from stockline.plans import outbox as OB
from stockline.plans.cycles import cycle_diff, cycle_next_base, run_bucketed_cycle
from stockline.sources import BucketedBase, SnapshotStore
from stockline.streaming import start_stream_cycle
from stockline.streaming.cycle import empty_mark, to_apply


def root_of(spark):
    return f"{spark.conf.get('spark.checkpoint.dir')}/{uuid.uuid4().hex}"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


# ---- base in buckets ---------------------------------------------------------

SNAPSHOT = "order_key long, status string"


def snapshot(spark, keys, status="x"):
    return spark.createDataFrame([(k, status) for k in keys], SNAPSHOT)


def base_of(spark, root, buckets=16):
    return BucketedBase(spark, f"{root}/base", snapshot(spark, [1]).schema, ["order_key"], buckets)


def folders(root):
    data = f"{root}/base/data"
    return {(b, v) for b in os.listdir(data) if b.startswith("_bucket=") for v in os.listdir(f"{data}/{b}") if v.startswith("_version=")}


def test_bucketed_cycle_equals_the_plain_one(spark):
    root = root_of(spark)
    base, plain = base_of(spark, root), snapshot(spark, [])
    for day, keys in enumerate([range(0, 200), range(50, 260), [], [7, None, 9], range(0, 40)], start=1):
        today = snapshot(spark, keys, f"day{day}")
        want_changes, want_base = cycle_diff(today, plain, ["order_key"]), cycle_next_base(today, plain, ["order_key"])
        run_bucketed_cycle(base, today, f"{root}/outbox", tag=str(day))
        assert rows(base.read()) == rows(want_base)
        assert rows(spark.read.parquet(f"{root}/outbox/version={day}")) == rows(want_changes)
        plain = spark.createDataFrame(rows(want_base), SNAPSHOT)
    assert run_bucketed_cycle(base, snapshot(spark, [1]), f"{root}/outbox", tag="5") == []  # applied before
    again = base_of(spark, root)  # another session's object over the same folder
    assert rows(again.read()) == rows(plain) and again.version() == 5


def test_one_changed_row_writes_one_bucket(spark):
    root = root_of(spark)
    base = base_of(spark, root)
    run_bucketed_cycle(base, snapshot(spark, range(500)), f"{root}/outbox")
    before = folders(root)
    assert len(before) == 16
    changed = run_bucketed_cycle(base, snapshot(spark, range(501)), f"{root}/outbox")
    assert len(changed) == 1 and folders(root) - before == {(f"_bucket={changed[0]}", "_version=2")}
    assert run_bucketed_cycle(base, snapshot(spark, range(501)), f"{root}/outbox") == []
    run_bucketed_cycle(base, snapshot(spark, range(1, 501)), f"{root}/outbox")
    kept = rows(base.read())
    assert base.vacuum(keep=1) >= 1 and rows(base.read()) == kept and len(folders(root)) == 16


def test_base_is_not_exchanged(spark):
    root = root_of(spark)
    base = base_of(spark, root)
    run_bucketed_cycle(base, snapshot(spark, range(300)), f"{root}/outbox")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = cycle_diff(snapshot(spark, range(20, 320)), base.read(), ["order_key"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "Bucketed: true" in text
    for branch in text.split("Exchange hashpartitioning")[1:]:
        # what is below an exchange, up to the next join, holds no scan of the base
        assert "FileScan" not in branch.split("Join")[0].split("Scan ExistingRDD")[0], text


def test_failed_run_leaves_the_base(spark):
    root = root_of(spark)
    base = base_of(spark, root)
    run_bucketed_cycle(base, snapshot(spark, range(50)), f"{root}/outbox")
    kept = rows(base.read())
    commit, base.manifest.commit = base.manifest.commit, None
    with pytest.raises(TypeError):
        run_bucketed_cycle(base, snapshot(spark, range(90)), f"{root}/outbox")
    base.manifest.commit = commit
    base._define()
    assert rows(base.read()) == kept
    run_bucketed_cycle(base, snapshot(spark, range(25, 60)), f"{root}/outbox")
    assert rows(base.read()) == [(k, "x") for k in sorted(range(25, 60), key=lambda k: str((k, "x")))]


# ---- outbox loop -------------------------------------------------------------

def wanted(spark, pairs):
    return OB.changes(spark.createDataFrame(pairs, "sku string, payload string"), "price", "sku")


def answer(messages):
    """Responses by key: None applied, a text rejected; other keys get none."""
    def respond(sent):
        keys = list(messages)
        bad = F.create_map(*[x for k in keys for x in (F.lit(k), F.lit(messages[k]))]) if keys else None
        picked = sent.filter(F.col("key").isin(keys))
        return picked.select("payload_hash", OB.response_of(F.get(F.array(bad[F.col("key")]), 0).isNotNull(), "no").alias("response"))
    return respond


def test_outbox_retries_up_to_a_limit_and_settles_by_payload(spark):
    path = root_of(spark)
    todo = wanted(spark, [("a", "1"), ("b", "1b"), ("c", "1c"), ("a", "1")])
    ledger = OB.run_outbox(spark, todo, answer({"a": None, "b": "no"}), path, "01", 2)
    assert {(r.key, r.attempts, r.state, r.message) for r in OB.states(ledger, 2).collect()} == {("a", 1, "done", None), ("b", 1, "retry", "no")}
    # replaying the responses of a run changes nothing
    before = rows(ledger)
    ledger = OB.run_outbox(spark, todo, answer({"a": None, "b": "no"}), path, "01", 2)
    assert rows(ledger) == before
    assert {r.key for r in OB.to_send(todo, ledger, 2).collect()} == {"b", "c"}
    ledger = OB.run_outbox(spark, todo, answer({"b": "no", "c": None}), path, "02", 2)
    assert {(r.key, r.state) for r in OB.states(ledger, 2).collect()} == {("a", "done"), ("b", "dead"), ("c", "done")}
    assert OB.to_send(todo, ledger, 2).count() == 0
    # a new payload of a dead or done key is a new change
    assert {r.key for r in OB.to_send(wanted(spark, [("b", "2"), ("a", "2"), ("c", "1c")]), ledger, 2).collect()} == {"a", "b"}


def test_what_a_run_sends_is_worked_out_once(spark):
    path, seen = root_of(spark), []

    def respond(sent):
        seen.append((sent.inputFiles(), sorted(r.key for r in sent.collect())))
        return answer({"a": None})(sent)

    todo = wanted(spark, [("a", "1"), ("b", "1b")])
    runs = ["01", "01", "02"]  # a repeated run lands what it sends anew
    for run in runs:
        OB.run_outbox(spark, todo, respond, path, run)
    assert all(files and all(f"-sent/run_ts={run}/" in f for f in files) for (files, _), run in zip(seen, runs))
    assert [keys for _, keys in seen] == [["a", "b"], ["a", "b"], ["b"]]
    assert [(r.key, r.attempts) for r in OB.states(OB.read_ledger(spark, path)).collect()] == [("a", 1)]


def test_unreadable_and_repeated_responses(spark):
    sent = wanted(spark, [("a", "1"), ("b", "2")])
    h = {r.key: r.payload_hash for r in sent.collect()}
    good = spark.range(1).select(OB.response_of(F.lit(False)).alias("r")).first().r
    responses = spark.createDataFrame([(h["a"], "not json"), (h["b"], "{}"), (h["b"], good), ("unknown", good)],
                                      "payload_hash string, response string")
    got = {r.key: (r.applied, r.message) for r in OB.settle(sent, responses).collect()}
    assert got == {"a": (False, "unreadable response"), "b": (True, None)}


# ---- stream staging ----------------------------------------------------------

STREAM = "order_key long, status string, snapshot_id int, snapshot_rows long"


class Stream:
    def __init__(self, spark, patience=None):
        self.spark, self.root, self.patience = spark, root_of(spark), patience
        self.store = SnapshotStore(spark, f"{self.root}/state")
        self.schema = spark.createDataFrame([], STREAM).schema

    def land(self, *frames):
        for df in frames:
            df = self.spark.createDataFrame(df, STREAM) if isinstance(df, list) else df
            df.coalesce(1).write.parquet(f"{self.root}/snapshots/{uuid.uuid4().hex}")
        start_stream_cycle(self.spark, f"{self.root}/snapshots/*", self.schema, f"{self.root}/state", f"{self.root}/outbox",
                           name=f"s-{self.root[-12:]}", patience=self.patience).awaitTermination()

    def keys(self):
        base = self.store.read()
        return None if base is None else sorted(r.order_key for r in base.collect())

    def staged(self):
        staging = f"{self.root}/state-staging"
        return sorted(s for e in os.listdir(staging) if e.startswith("epoch") for s in os.listdir(f"{staging}/{e}") if s.startswith("_id="))


def test_staging_holds_open_snapshots_only(spark):
    s = Stream(spark)
    s.land([(1, "a", 1, 2), (2, "b", 1, 2)])
    assert s.keys() == [1, 2] and s.staged() == []
    s.land([(3, "c", 2, 2)])
    assert s.keys() == [1, 2] and s.staged() == ["_id=2"]
    s.land([(3, "c", 2, 2)])  # the same file again is no second row
    assert s.keys() == [1, 2]
    s.land([(4, "d", 2, 2), (9, "z", 3, 1)])
    assert s.keys() == [9] and s.staged() == []


def test_empty_snapshot_and_missing_count(spark):
    s = Stream(spark)
    s.land([(1, "a", 1, 1)], empty_mark(s.schema, spark, 2))
    assert s.keys() == [] and s.store.latest_tag() == "2"
    s.land([(5, "a", 3, None)], [(6, "b", 4, 1)])
    assert s.keys() == [] and s.staged() == ["_id=3", "_id=4"]


def test_incomplete_snapshot_is_passed_over(spark):
    s = Stream(spark, patience=2)
    s.land([(1, "a", 1, 1), (2, "b", 2, 5), (3, "c", 3, 1)])
    assert s.keys() == [1]
    s.land([(4, "d", 4, 1)])
    assert s.keys() == [4] and s.staged() == []
    skipped = spark.read.parquet(f"{s.root}/state-skipped")
    assert [(r.snapshot_id, r.n, r.snapshot_rows) for r in skipped.collect()] == [(2, 1, 5)]


def test_to_apply():
    def one(i, complete):
        return {"snapshot_id": i, "complete": complete}
    found = [one(1, True), one(2, False), one(3, True), one(4, False), one(5, True)]
    assert to_apply(found, None) == ([1], [])
    assert to_apply(found, 2) == ([1, 3], [found[1]])
    assert to_apply(found, 1) == ([1, 3, 5], [found[1], found[3]])


# ---- forward fill ------------------------------------------------------------

def test_fill_does_not_depend_on_partitions(spark):
    """NULL keys are a key; rows of one sequence number have an order."""
    data = [(None if i % 3 == 0 else f"k{i % 4}", i // 4, None if i % 5 else float(i), f"t{i % 7}") for i in range(200)]
    data += [(None, None, 7.0, "n"), ("k1", None, None, "n"), (None, 3, None, None)]
    df = spark.createDataFrame(data, "k string, s int, v double, t string")
    got = [rows(ffill_by_key(df, "k", "s", ["v"], partitions=n)) for n in (1, 4, 64)]
    assert got[0] == got[1] == got[2]
    want, last = [], {}
    for k, s, v, t in sorted(data, key=lambda r: (r[0] is not None, r[0] or "", r[1] is not None, r[1] or 0, r[2] is not None, r[2] or 0,
                                                  r[3] is not None, r[3] or "")):
        last[k] = v if v is not None else last.get(k)
        want.append((k, s, last[k], t))
    assert got[0] == sorted(want, key=str)
