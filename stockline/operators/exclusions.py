"""Exclusion and selection rules kept as a table.

A rule is a row (branch, column, op, value): a row of the data stays in a branch
if all of the branch's rules hold. Rules are compiled to one predicate of plain
comparisons, so that Catalyst can push it to the scan. As in SQL, a comparison
with NULL does not hold.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rules up to which a table is compiled to a predicate.
MOST_RULES = 10_000


class Rule(NamedTuple):
    """One row of the table; ``in`` and ``not_in`` take one value a row."""

    branch: str
    column: str
    op: str
    value: str | None = None


_COMPARE = {
    "eq": lambda c, v: c == v, "ne": lambda c, v: c != v, "gt": lambda c, v: c > v, "ge": lambda c, v: c >= v,
    "lt": lambda c, v: c < v, "le": lambda c, v: c <= v,
}
_LIKE = {"like": lambda c, v: c.like(v), "not_like": lambda c, v: ~c.like(v)}
_LIST = {"in": lambda c, vs: c.isin(vs), "not_in": lambda c, vs: ~c.isin(vs)}


def rules_of(table: DataFrame, most: int = MOST_RULES) -> list[Rule]:
    """Rules of a table with the columns branch, column, op and value."""
    rows = table.select("branch", "column", "op", F.col("value").cast("string")).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rules: keep long lists as a table and use a semi or anti join")
    return [Rule(*r) for r in rows]


def predicate(rules: Iterable[Rule], branch: str, types: T.StructType) -> Column:
    """What a row must fulfil in ``branch``; values take the column's type."""
    tests, lists = [], {}
    for rule in rules:
        if rule.branch != branch:
            continue
        column = F.col(rule.column)
        value = F.lit(rule.value).cast(types[rule.column].dataType)
        if rule.op in _COMPARE:
            tests.append(_COMPARE[rule.op](column, value))
        elif rule.op in _LIKE:
            tests.append(_LIKE[rule.op](column, rule.value))
        elif rule.op in _LIST:
            lists.setdefault((rule.column, rule.op), []).append(value)
        elif rule.op == "filled":
            tests.append(F.trim(column) != "")
        else:
            raise ValueError(f"unknown operator {rule.op!r} in {rule}")
    tests += [_LIST[op](F.col(column), values) for (column, op), values in lists.items()]
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def keep(df: DataFrame, rules: Iterable[Rule], branch: str) -> DataFrame:
    """The rows of ``df`` that ``branch`` keeps."""
    return df.filter(predicate(rules, branch, df.schema))
