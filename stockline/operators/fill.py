"""Forward fill within a key (W1), without one task per hot key.

``last(x, ignorenulls) over (partition by key order by seq)`` puts every
row of a key into one task. Here the rows are range-partitioned by
(key, seq), so a hot key spreads over as many partitions as its share of
the rows, and the partition number is fixed by a checkpoint: (1) fill
inside each (key, partition), (2) summarise it by its last non-null value
— one row per key and partition that holds it, so the summaries of one
key are at most as many as partitions, (3) carry the last non-null
summary of earlier partitions with a window over the summaries, (4) join
the carry back and take the local value when there is one.

NULL keys are one key like any other (joined null-safe). Rows with an equal
``seq`` are ordered by ``ties``, so the result is the same for any number of
partitions; NULL sorts first.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir


def ffill_by_key(df: DataFrame, key: str | Sequence[str], seq: str, cols: Sequence[str],
                 partitions: int | None = None, ties: Sequence[str] | None = None) -> DataFrame:
    """Replace NULLs in ``cols`` with the last non-null value of the same
    key at a smaller ``seq``. Never without a partition key.
    ``partitions``: range partitions (spark.sql.shuffle.partitions).
    ``ties``: columns that order rows of one ``seq`` (all that can be ordered)."""
    keys = [key] if isinstance(key, str) else list(key)
    cols = list(cols)
    if ties is None:
        ties = [f.name for f in df.schema if f.name not in (*keys, seq) and not _holds_map(f.dataType)]
    order = [seq, *ties]
    ensure_checkpoint_dir(df.sparkSession)
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    b = df.repartitionByRange(n, *keys, *order).withColumn("_part", F.spark_partition_id()).checkpoint()
    w_local = (Window.partitionBy(*keys, "_part").orderBy(*order)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = b.select("*", *[F.last(c, ignorenulls=True).over(w_local).alias(f"_loc_{c}") for c in cols])
    summary = b.groupBy(*keys, "_part").agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.struct(*order))).alias(f"_sum_{c}") for c in cols])
    w_carry = (Window.partitionBy(*keys).orderBy("_part")
               .rowsBetween(Window.unboundedPreceding, -1))
    names = {k: f"_key_{i}" for i, k in enumerate([*keys, "_part"])}
    carry = summary.select(*[F.col(k).alias(name) for k, name in names.items()],
                           *[F.last(f"_sum_{c}", ignorenulls=True).over(w_carry).alias(f"_car_{c}") for c in cols])
    match = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(name)) for k, name in names.items()])
    j = local.join(carry, match, "left")
    out = [F.coalesce(F.col(f"_loc_{c}"), F.col(f"_car_{c}")).alias(c) if c in cols else F.col(c)
           for c in df.columns]
    return j.select(*out)


def _holds_map(kind: T.DataType) -> bool:
    """Whether values of a type cannot be ordered."""
    if isinstance(kind, T.StructType):
        return any(_holds_map(f.dataType) for f in kind)
    return _holds_map(kind.elementType) if isinstance(kind, T.ArrayType) else isinstance(kind, T.MapType | T.VariantType)
