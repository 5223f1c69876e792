"""CASE-style lookups expressed as `when` chains built from parameters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def case_map(x: Column, mapping: Mapping, default=None) -> Column:
    """CASE x WHEN k THEN v ... ELSE default END (X10). The mapping is a
    small fixed table, so it stays an expression (no join, no broadcast)."""
    out = None
    for k, v in mapping.items():
        out = F.when(x == F.lit(k), F.lit(v)) if out is None else out.when(x == F.lit(k), F.lit(v))
    if out is None:
        return F.lit(default)
    return out.otherwise(F.lit(default))


def price_band(price: Column, metal: Column, bands: Mapping[str, Sequence[tuple]], default: str = "") -> Column:
    """Price band by metal (X11). ``bands[metal]`` is an ordered list of
    ``(upper_bound_or_None, label)``; the first bound with price <= bound
    wins and ``None`` closes the list ("above")."""
    out = None
    for m, arms in bands.items():
        for bound, label in arms:
            cond = (metal == F.lit(m)) if bound is None else ((price <= F.lit(bound)) & (metal == F.lit(m)))
            out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(default)) if out is not None else F.lit(default)


def floor_zero(x: Column) -> Column:
    """CASE WHEN x > 0 THEN x ELSE 0 END: a NULL becomes 0."""
    return F.when(x > 0, x).otherwise(F.lit(0))
