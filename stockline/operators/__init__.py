"""Relational building blocks that Spark lacks as one call."""

from .dedup import first_per_key
from .diff import ROWS_A_TASK, key_changes, parts_of, row_diff, row_diff_both
from .exclusions import Rule, keep, predicate, rules_of
from .fill import ffill_by_key
from .roles import join_roles
from .unions import union_priority

__all__ = ["Rule", "first_per_key", "join_roles", "keep", "predicate", "rules_of", "key_changes", "parts_of", "ROWS_A_TASK", "row_diff", "row_diff_both", "ffill_by_key",
           "union_priority"]
