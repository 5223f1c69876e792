"""Union with priority: first source wins per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dedup import first_per_key


def union_priority(frames: Sequence[DataFrame], keys: Sequence[str],
                   tie: Sequence[str] = ()) -> DataFrame:
    """Stack ``frames`` (by name) and keep, per key, the row of the earliest
    frame; within one frame ``tie`` columns break ties."""
    tagged = [f.withColumn("_src", F.lit(i)) for i, f in enumerate(frames)]
    stacked = tagged[0]
    for f in tagged[1:]:
        stacked = stacked.unionByName(f, allowMissingColumns=True)
    return first_per_key(stacked, keys, ["_src", *tie]).drop("_src")
