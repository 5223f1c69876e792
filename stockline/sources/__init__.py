"""Sources and sinks: tables, delimited files, JSON Lines, landed API
pages, versioned state, ledgers and audit logs."""

from .bucketed import BucketedBase
from .tables import read_table, read_jdbc, read_jdbc_even
from .files import (TooManyBadLines, parse_json_lines, read_delimited, read_jsonl, read_jsonl_checked, split_json_lines,
                    write_delimited)
from .state import SnapshotStore, append_ledger, write_audit

__all__ = ["read_table", "read_jdbc", "read_jdbc_even", "read_jsonl_checked", "split_json_lines", "TooManyBadLines", "read_delimited", "write_delimited", "read_jsonl",
           "parse_json_lines", "BucketedBase", "SnapshotStore", "append_ledger", "write_audit"]
