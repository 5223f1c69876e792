"""Helpers shared by the operators: column expressions, lineage cuts and the
numpy view of Arrow text batches used inside tasks."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: White space of the word rule ``[^\x20\x09-\x0D]+``.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_CLASS = r"[\x20\x09-\x0D]+"

#: Characters handled together inside a task; a longer text is taken alone.
CHARS_AT_ONCE = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Words of a text as an array; null or blank text: empty array."""
    t = F.trim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, BLANK_CLASS))


def crc_mod(key: str, n: int) -> Column:
    """crc32 of the key written as text, modulo n (null key: null)."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % n


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def release() -> None:
    """Hand memory that is free inside this Python worker back to the system:
    workers outlive their tasks and share the executor's memory."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # a C library without it
        ctypes.CDLL(None).malloc_trim(0)


def releasing(function):
    """A function of one Arrow table that releases memory when it is done."""
    def run(group):
        out = function(group)
        release()
        return out
    return run


def releasing_both(function):
    """The same for a function of two co-grouped tables."""
    def run(left, right):
        out = function(left, right)
        release()
        return out
    return run


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text",
                limit: int = CHARS_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """Cut record batches into runs of rows whose texts hold at most ``limit``
    bytes together (a longer text is a run of its own)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        total = np.cumsum(sizes)
        at = 0
        while at < batch.num_rows:
            base = total[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(total, base + limit, side="right")))
            yield batch.slice(at, end - at)
            at = end
        release()


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    return [t or "" for t in batch.column(column).to_pylist()]


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, one newline after each, and the start of each
    text (one entry more than texts)."""
    joined = "\n".join(texts) + "\n"
    cps = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=starts[1:])
    return cps, starts


_LETTERS: np.ndarray | None = None


def letters() -> np.ndarray:
    """For each code point whether it is a Unicode letter."""
    global _LETTERS
    if _LETTERS is None:
        _LETTERS = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _LETTERS


#: Rows up to which a side of a join may be broadcast (about 32 MB of ids).
BROADCAST_ROWS = 1_000_000


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it counts at most ``rows`` rows; beyond
    that it is left to a shuffled join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
