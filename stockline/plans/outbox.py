"""Closed outbox loop (C11, P14, S10): what was sent, what came back, what is
left to send.

Each change is known by its feed, its key and the hash of its payload. A
response names the payload it answers by that hash, so a response to an older
payload of the same key settles nothing. The ledger has one row per attempt
(change and run), kept in one partition per run that a repeated run overwrites:
replaying a response file changes nothing. A change is done when an attempt of
it was applied, dead after ``max_attempts`` rejected ones, and to be sent again
otherwise; an attempt without a response counts as not made.
"""

from __future__ import annotations

import uuid
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ..sources import append_ledger
from .feeds import feed_stock, first_error, response_of

CHANGE = ["feed", "key", "payload_hash"]
LEDGER = "feed string, key string, payload_hash string, applied boolean, message string, run_ts string"
MAX_ATTEMPTS = 3


def changes(payloads: DataFrame, feed: str, *keys: str) -> DataFrame:
    """Payload rows as changes: feed, key, payload_hash, payload."""
    return payloads.select(F.lit(feed).alias("feed"), F.concat_ws("@", *keys).alias("key"),
                           F.sha2("payload", 256).alias("payload_hash"), "payload").distinct()


def settle(sent: DataFrame, responses: DataFrame) -> DataFrame:
    """Attempts of one run: each sent change with its response (payload_hash,
    response). Several responses to one change are one attempt, applied if any
    of them has no error."""
    error = first_error(F.col("response"))
    answered = responses.select("payload_hash", error.alias("message")).groupBy("payload_hash").agg(
        F.bool_or(F.col("message").isNull()).alias("applied"), F.min("message").alias("message"))
    return (sent.select(*CHANGE).distinct().join(answered, "payload_hash")
            .select(*CHANGE, "applied", F.when(~F.col("applied"), F.col("message")).alias("message")))


def states(ledger: DataFrame, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """State of every change with an attempt: attempts, state (done, retry or
    dead) and the last error. One partial aggregate per change."""
    found = ledger.groupBy(*CHANGE).agg(
        F.count("*").alias("attempts"), F.bool_or("applied").alias("_applied"),
        F.max_by("message", F.when(~F.col("applied"), F.col("run_ts"))).alias("message"))
    state = F.when(F.col("_applied"), "done").when(F.col("attempts") >= max_attempts, "dead").otherwise("retry")
    return found.select(*CHANGE, "attempts", state.alias("state"), "message")


def to_send(wanted: DataFrame, ledger: DataFrame, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """The wanted changes that are neither done nor dead; a changed payload of
    a key is a new change."""
    settled = states(ledger, max_attempts).filter("state <> 'retry'").select(*CHANGE)
    return wanted.join(settled, CHANGE, "left_anti")


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """All attempts so far; an empty ledger before the first run."""
    from ..sources.state import _fs
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(path)


def land(df: DataFrame, path: str) -> DataFrame:
    """The rows written to ``path`` and read again; a retry writes them anew."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def run_outbox(spark: SparkSession, wanted: DataFrame, respond, path: str, run_ts: str,
               max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """One run: send what is left (the rows given to ``respond``, which lands
    the responses), settle it and put the attempts into the run's partition. A
    run that is repeated sends what it sent: its own partition is left out of
    the ledger it starts from. What is sent is landed beside the ledger first,
    so it is worked out once and not again for the responses."""
    before = read_ledger(spark, path).filter(F.col("run_ts") < run_ts)
    sent = land(to_send(wanted, before, max_attempts), f"{path.rstrip('/')}-sent/run_ts={quote(run_ts, safe='')}")
    append_ledger(settle(sent, respond(sent)), path, run_ts)
    return read_ledger(spark, path)


# ---- registered form --------------------------------------------------------

def landed_answers(run: int, floor: int = -50):
    """Responses of the store (binding): a change below ``floor`` is always
    rejected, one divisible by three in the first run only."""
    def respond(sent: DataFrame) -> DataFrame:
        delta = F.get_json_object("payload", "$.changes.delta").cast("bigint")
        bad = (delta < floor) | ((delta % 3 == 0) & F.lit(run == 1))
        return sent.select("payload_hash", response_of(bad).alias("response"))
    return respond


def outbox_loop(spark: SparkSession, change_set: DataFrame, runs: int = 4) -> DataFrame:
    """Runs of the loop over the stock feed, then the state of every change."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/outbox/{uuid.uuid4().hex}"
    # landed once: every run would work out the change set again
    wanted = land(changes(feed_stock(change_set), "stock", "variant_sku", "location_id"), f"{path}-wanted")
    ledger = read_ledger(spark, path)
    for run in range(1, runs + 1):
        ledger = run_outbox(spark, wanted, landed_answers(run), path, f"2024-01-0{run}")
    return states(ledger).select("key", "attempts", "state", "message")
