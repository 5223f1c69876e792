"""The daily run as a Spark job.

The reference runs, in order: store levels → ERP extracts → activation →
stock updates → prices → orderable flag → in-stock flag, posting each row
itself. Here each step is a feed written to the outbox table, one
partition per (feed, run_ts), in the same order; another process sends
them. Each partition is overwritten on retry, so re-running a failed run
with the same ``run_ts`` replaces its output instead of duplicating it.

    python -m stockline.jobs --tables /path/to/tables --outbox /shared/outbox --run-ts 2024-01-01T00 --state /shared/state
"""

from __future__ import annotations

import argparse
from dataclasses import dataclass
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import row_diff
from .plans import bindings as B
from .plans import campaign as CP
from .plans import feeds as FD
from .plans import flags as FL
from .plans import intake as IN
from .plans import prices as P
from .plans import stock as S
from .sources import SnapshotStore, read_jdbc_even


@dataclass(frozen=True)
class Extracts:
    """What a run reads: landed store exports and ERP extracts."""
    levels: DataFrame
    variants: DataFrame
    items: DataFrame
    erp_stock: DataFrame
    orderables: DataFrame
    stock_by_site: DataFrame


def bound_extracts(spark: SparkSession, d: str) -> Extracts:
    """The extracts as the bindings derive them from the tables in ``d``."""
    return Extracts(B.channel_levels(spark, d), B.channel_variants(spark, d), B.items(spark, d), S.erp_stock(spark, d),
                    S.orderable_sizes(spark, d), S.stock_by_site(spark, d))


def daily_feeds(x: Extracts) -> list[tuple[str, DataFrame]]:
    """(feed name, rows with a ``payload`` column) in apply order."""
    orderable = FL.flag_orderable(x.levels)
    return [
        ("activation", FD.feed_activation(x.variants, IN.ACTIVATION_LOCATIONS)),
        ("stock", FD.feed_stock(S.stock_change_set(x.levels, x.erp_stock, x.orderables))),
        ("price", P.feed_price(P.ring_price_feed(x.variants, x.items, x.levels))),
        ("flags", CP.feed_flags(orderable, FL.flag_in_stock(x.variants, orderable),
                                FL.ready_list(x.stock_by_site, x.variants), x.items)),
    ]


#: Relations that a run reads, and the key that cuts each into parts.
RELATIONS = {"part": "p_partkey", "supplier": "s_suppkey", "lineitem": "l_orderkey", "orders": "o_orderkey",
             "customer": "c_custkey", "nation": "n_nationkey"}


def land_relations(spark: SparkSession, url: str, folder: str, parts: int = 64, properties: dict | None = None,
                   relations: dict[str, str] | None = None, read=read_jdbc_even) -> list[str]:
    """Extract the relations over JDBC, in parts of about equal size, and land
    each as Parquet in ``folder``; the paths. A repeated run lands them anew."""
    paths = []
    for name, key in (relations or RELATIONS).items():
        paths.append(f"{folder.rstrip('/')}/{name}.parquet")
        read(spark, url, name, key, parts, properties).write.mode("overwrite").parquet(paths[-1])
    return paths


#: Feeds that send only rows that differ from the last run.
DIFFED = ["flags"]


def _partition(outbox: str, feed: str, run_ts: str) -> str:
    return f"{outbox.rstrip('/')}/feed={feed}/run_ts={quote(run_ts, safe='')}"


def daily_run(spark: SparkSession, x: Extracts, outbox: str, run_ts: str, state: str) -> list[str]:
    """Write every feed of the run to the outbox; returns the paths.

    The feeds in ``DIFFED`` are compared with their rows of the last run, kept
    as versioned snapshots under ``state``; the run's own rows are committed
    after its outbox partition, together with the run's time. A retry writes
    the same partitions again; a feed whose rows are committed is done."""
    paths = []
    for i, (name, df) in enumerate(daily_feeds(x), start=1):
        path = _partition(outbox, name, run_ts)
        paths.append(path)
        store, tag = SnapshotStore(spark, f"{state.rstrip('/')}/{name}"), quote(run_ts, safe="")
        if name in DIFFED:
            if store.applied(tag):
                continue
            base = store.read()
            changed = df if base is None else row_diff(df, base)
            changed.withColumn("step", F.lit(i)).write.mode("overwrite").parquet(path)
            store.commit(df, tag=tag)
        else:
            df.withColumn("step", F.lit(i)).write.mode("overwrite").parquet(path)
    return paths


def main() -> None:
    ap = argparse.ArgumentParser(description="daily catalog and stock reconciliation run")
    ap.add_argument("--tables", required=True)
    ap.add_argument("--outbox", required=True)
    ap.add_argument("--run-ts", required=True)
    ap.add_argument("--state", required=True)
    ap.add_argument("--jdbc-url", help="land the relations from this database in the tables folder first")
    a = ap.parse_args()
    spark = SparkSession.builder.appName("stockline-daily").getOrCreate()
    if a.jdbc_url:
        land_relations(spark, a.jdbc_url, a.tables)
    for p in daily_run(spark, bound_extracts(spark, a.tables), a.outbox, a.run_ts, a.state):
        print(p)


if __name__ == "__main__":
    main()
