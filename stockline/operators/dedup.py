"""Keep-first per key with an explicit order.

pandas' ``drop_duplicates(keep='first')`` depends on row order, which
Spark does not have; every caller names its order. We express "first"
as a ``min`` over a struct whose leading fields are the order columns.
That is an ordinary hash aggregate: it combines map-side before the
shuffle, so a key holding a third of all rows costs one partial row per
task instead of one task holding the whole group (a ``row_number``
window would sort the hot key inside a single task). Spark runs it sorted, as
its buffer holds strings, so the rows are dealt first, by a hash of their key:
a split of a scan holds as many rows as its file is well compressed, a dealt
part as many as fit the advisory size, and a larger one is split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                  descending: bool = False) -> DataFrame:
    """One row per ``keys``: the row with the smallest ``order`` tuple
    (largest if ``descending``). NULL order values sort first ascending
    and last descending (Spark's struct ordering). Ties on the full order
    tuple are broken by the remaining columns, so the result is
    deterministic. Output keeps ``df``'s column order."""
    keys = list(keys)
    order = [c for c in order if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    fields = [F.col(c).alias(f"_o{i}") for i, c in enumerate(order)] + [F.col(c) for c in rest]
    pick = F.max if descending else F.min
    # by an expression of the keys: parts by the keys would count as grouped, and not be split
    dealt = df.withColumn("_dealt", F.xxhash64(*keys)).hint("rebalance", F.col("_dealt"))
    agg = dealt.groupBy(*keys).agg(pick(F.struct(*fields)).alias("_first"))
    out = agg.select(*keys, *[F.col(f"_first._o{i}").alias(c) for i, c in enumerate(order)],
                     *[F.col(f"_first.{c}").alias(c) for c in rest])
    return out.select(*df.columns)
