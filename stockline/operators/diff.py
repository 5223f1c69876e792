"""Snapshot differences."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _null_safe_on(left: DataFrame, right: DataFrame, cols: Sequence[str]):
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in cols])


def row_diff(today: DataFrame, base: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows of ``today`` with no equal row in ``base`` over ``cols`` (all
    columns by default). NULL equals NULL, as in a row-tuple ``isin``;
    duplicates in ``today`` are kept (T7). Runs as one hash anti join:
    Catalyst turns each ``<=>`` into hashable keys."""
    cols = list(cols or today.columns)
    # only existence matters on the base side: de-duplicating first
    # collapses a hot group of identical copies map-side to one row
    b = base.select(*cols).distinct().alias("b")
    t = today.alias("t")
    cond = reduce(lambda a, c: a & c, [F.col(f"t.`{c}`").eqNullSafe(F.col(f"b.`{c}`")) for c in cols])
    return t.join(b, cond, "left_anti")


def row_diff_both(today: DataFrame, base: DataFrame, cols: Sequence[str] | None = None,
                  flag: str = "is_active") -> DataFrame:
    """Two-way row diff with a flag column: additions ``true``, removals
    ``false`` (C2)."""
    cols = list(cols or today.columns)
    add = row_diff(today.select(*cols), base.select(*cols), cols).withColumn(flag, F.lit(True))
    rem = row_diff(base.select(*cols), today.select(*cols), cols).withColumn(flag, F.lit(False))
    return add.unionByName(rem)


#: Rows of either side in a task of the key cycle.
ROWS_A_TASK = 500_000


def parts_of(*sides: DataFrame, rows_a_task: int = ROWS_A_TASK) -> int:
    """Parts that hold ``rows_a_task`` rows of the largest side each."""
    return max(1, *[-(-side.count() // rows_a_task) for side in sides])


def key_changes(today: DataFrame, base: DataFrame, keys: Sequence[str],
                status: str = "change", parts: int | None = None) -> DataFrame:
    """Key cycle (C3, J16): 'enter' = today's rows whose key is not in base,
    'leave' = base rows whose key is not today, 'keep' = base rows whose key
    is also today. A kept key keeps its base values (the price to restore,
    say), so ``status <> 'leave'`` is the next base (base ∪ enter ∖ leave).

    Semi and anti joins against the *distinct* keys of the other side: they
    never multiply rows, so duplicate keys cannot pair up, and a hot key
    collapses map-side before the shuffle. NULL keys are dropped first: they
    never match (T6).

    ``parts``: number of parts of the joins (see ``parts_of``), which keeps a
    task's sorts and sets of keys small at any size; Spark merges parts by
    their compressed bytes, and keys compress to a few bytes. The keys are then
    made distinct behind the shuffle. Not for a base that is kept in buckets."""
    keys = list(keys)
    vals = [c for c in today.columns if c not in keys]
    t = today.dropna(subset=keys)
    b = base.dropna(subset=keys)
    if parts and parts > 1:
        t, b = t.repartition(parts, *keys), b.repartition(parts, *keys)
    t_keys = t.select(*keys).distinct()
    b_keys = b.select(*keys).distinct()
    enter = t.join(b_keys, keys, "left_anti").withColumn(status, F.lit("enter"))
    b_vals = [F.col(c) if c in base.columns else F.lit(None).cast(today.schema[c].dataType).alias(c) for c in vals]
    b = b.select(*keys, *b_vals)
    keep = b.join(t_keys, keys, "left_semi").withColumn(status, F.lit("keep"))
    leave = b.join(t_keys, keys, "left_anti").withColumn(status, F.lit("leave"))
    return enter.unionByName(keep).unionByName(leave).select(*keys, *vals, status)
