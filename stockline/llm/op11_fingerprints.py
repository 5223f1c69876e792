"""Document fingerprints: a homomorphic hash of the multiset of paragraphs.

Each paragraph (``\\n``-split line, empty ones included) hashes to a wide vector
of 16-bit lanes; a document's fingerprint is the sum of its paragraphs' vectors,
each lane modulo 2^16. The sum does not depend on the order of paragraphs, and
inserting or deleting a paragraph adds or subtracts its vector (``with_edits``),
without the rest of the text.

* ``EXACT`` lanes hold a 512-bit digest of the whole paragraph: two documents
  agree there if (and, but for chance, only if) they hold the same paragraphs,
  each as often.
* ``ALIKE`` lanes hold the signed sum of the paragraph's runs of ``GRAM``
  characters (from each character on, cut at the paragraph's end), each dealt to
  one lane with one sign. Inner products of such sums estimate those of the run
  counts, so ``likeness`` (Dice form, 0 to 1) can be told from two fingerprints
  alone; its standard error is about 1/16.

Handling: a null text counts as empty (one empty paragraph); texts of any length
go through in pieces of ``CHARS_AT_ONCE`` characters; rows with equal ids or
texts are rows of their own; a null id is the smallest; an empty table gives an
empty result; extra columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
from base64 import b64decode, b64encode
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import CHARS_AT_ONCE, code_points, release, shuffle_partitions, text_slices, texts_of

EXACT, ALIKE = 32, 256
WIDTH = EXACT + ALIKE
#: Characters of a run that counts for the likeness.
GRAM = 8
_STEP, _MIX = 0x9E3779B97F4A7C15, np.uint64(0xD6E8FEB86659FD93)


# ---- inside tasks ----------------------------------------------------------

def exact_lanes(texts: list[str]) -> np.ndarray:
    """Sums of the paragraph digests of each text."""
    out = np.zeros((len(texts), EXACT), np.uint16)
    for row, text in zip(out, texts, strict=True):
        digests = b"".join(hashlib.blake2b(p).digest() for p in text.encode("utf-8", "surrogatepass").split(b"\n"))
        row += np.frombuffer(digests, "<u2").reshape(-1, EXACT).sum(0, dtype=np.uint16)
    return out


def _runs(pieces: list[str], starts: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the run at each of the first ``starts`` characters of each piece,
    and the piece it belongs to; newlines start no run."""
    cps, at = code_points(pieces)
    ends = np.flatnonzero(cps == 10)
    left = np.repeat(ends, np.diff(ends, prepend=-1)) - np.arange(len(cps))
    h = (cps.astype(np.uint64) + np.uint64(1)) * _MIX
    for ahead in (1, 2, 4):
        follow = np.zeros_like(h)
        follow[:-ahead] = h[ahead:]
        follow[left <= ahead] = 0
        h = h * np.uint64(pow(_STEP, ahead, 1 << 64)) + follow
    owner = np.repeat(np.arange(len(pieces)), np.diff(at))
    first = (left > 0) & (np.arange(len(cps)) - at[owner] < np.asarray(starts)[owner])
    h = h[first]
    h = (h ^ (h >> np.uint64(29))) * _MIX
    return h ^ (h >> np.uint64(32)), owner[first]


def _pieces(texts: list[str]) -> Iterator[list[tuple[int, str, int]]]:
    """Lists of (text, piece, starts) of at most CHARS_AT_ONCE characters; a
    piece runs GRAM - 1 characters past its last start."""
    held, size = [], 0
    for k, text in enumerate(texts):
        for s in range(0, len(text), CHARS_AT_ONCE):
            n = min(CHARS_AT_ONCE, len(text) - s)
            if held and size + n > CHARS_AT_ONCE:
                yield held
                held, size = [], 0
            held.append((k, text[s:s + n + GRAM - 1], n))
            size += n
    if held:
        yield held


def alike_lanes(texts: list[str]) -> np.ndarray:
    """Signed sums of the runs of each text, modulo 2^16."""
    out = np.zeros((len(texts), ALIKE), np.int64)
    for part in _pieces(texts):
        whose, pieces, starts = zip(*part, strict=True)
        h, owner = _runs(list(pieces), list(starts))
        lane = owner * ALIKE + (h >> np.uint64(8)).astype(np.int64) % ALIKE
        sums = np.bincount(lane, 1.0 - 2.0 * (h & np.uint64(1)), len(pieces) * ALIKE)
        np.add.at(out, np.asarray(whose), sums.reshape(-1, ALIKE).astype(np.int64))
    return (out % 65536).astype(np.uint16)


def vectors(texts: list[str]) -> np.ndarray:
    """Fingerprint of each text as a row of WIDTH lanes."""
    return np.hstack([exact_lanes(texts), alike_lanes(texts)])


def paragraph_vectors(paragraphs: list[str]) -> np.ndarray:
    """Vector of each paragraph; a newline inside it makes it several."""
    return vectors(paragraphs)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Likeness of the fingerprints in the rows of ``a`` and ``b``: 1 for equal
    ones, else 1 - |a-b|^2 / (|a|^2 + |b|^2) over the ALIKE lanes, 0 at least."""
    x, y = (v[:, EXACT:].astype(np.int16) for v in (a, b))
    apart = (x - y).astype(np.float64)
    both = (x.astype(np.float64) ** 2).sum(1) + (y.astype(np.float64) ** 2).sum(1)
    near = 1 - (apart ** 2).sum(1) / np.where(both > 0, both, 1)
    near = np.where(both > 0, np.clip(near, 0, 1), 0.0)
    return np.where((a == b).all(1), 1.0, near)


def written(v: np.ndarray) -> list[str]:
    return [b64encode(row.astype("<u2").tobytes()).decode() for row in v]


def lanes_of(fingerprints: list[str | None]) -> np.ndarray:
    """The reverse of ``written``; null: the empty multiset."""
    raw = b"".join(b64decode(f) if f else bytes(2 * WIDTH) for f in fingerprints)
    return np.frombuffer(raw, "<u2").reshape(-1, WIDTH).astype(np.uint16)


# ---- over DataFrames -------------------------------------------------------

def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, n_chars and fingerprint of each row; no shuffle."""
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("text"))

    def each(batches):
        for b in text_slices(batches):
            texts = texts_of(b)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(written(vectors(texts)))],
                ["k", "n_chars", "fingerprint"])

    schema = T.StructType([rows.schema["k"], T.StructField("n_chars", T.LongType()), T.StructField("fingerprint", T.StringType())])
    return rows.mapInArrow(each, schema).withColumnRenamed("k", key)


def likeness_of(a: Column, b: Column) -> Column:
    """Likeness of two fingerprint columns (null: the empty multiset)."""
    @F.pandas_udf("double")
    def near(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series(likeness(lanes_of(list(x)), lanes_of(list(y))))
    return near(a, b)


def with_edits(prints: DataFrame, edits: DataFrame, key: str = "doc_id") -> DataFrame:
    """Fingerprints after paragraphs were inserted or deleted.

    ``prints`` has ``key`` and fingerprint; ``edits`` has ``key``, paragraph and
    change (times inserted; negative: deleted). Edits with a null paragraph,
    change or key and those of unknown keys have no effect. Sums are taken per
    batch first and merged lane by lane, so a document with very many edits
    makes no large group.
    """
    rows = edits.select(F.col(key).alias("k"), F.col("paragraph").cast("string").alias("text"),
                        F.col("change").cast("long").alias("change")).dropna()

    def partial(batches):
        for b in text_slices(batches):
            change = b.column("change").to_numpy().astype(np.int64)
            keys, owner = np.unique(np.asarray(b.column("k").to_pylist(), dtype=object), return_inverse=True)
            sums = np.zeros((len(keys), WIDTH), np.int64)
            np.add.at(sums, owner, paragraph_vectors(texts_of(b)).astype(np.int64) * (change % 65536)[:, None])
            at, lane = np.nonzero(sums % 65536)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[at].tolist(), b.column("k").type), pa.array(lane.astype(np.int32)),
                 pa.array(sums[at, lane] % 65536)], ["k", "lane", "value"])

    schema = T.StructType([rows.schema["k"], T.StructField("lane", T.IntegerType()), T.StructField("value", T.LongType())])
    summed = (rows.mapInArrow(partial, schema).groupBy("k", "lane").agg(F.sum("value").alias("value"))
              .groupBy("k").agg(F.collect_list(F.struct("lane", "value")).alias("sums")))  # at most WIDTH entries

    @F.pandas_udf("string")
    def add(old: pd.Series, sums: pd.Series) -> pd.Series:
        v = lanes_of(list(old)).astype(np.int64)
        for row, entries in zip(v, sums, strict=True):
            for e in entries if entries is not None else ():
                row[e["lane"]] += e["value"]
        return pd.Series(written((v % 65536).astype(np.uint16)))

    base = prints.select(F.col(key).alias("k"), "fingerprint")
    return base.join(summed, "k", "left").select(F.col("k").alias(key), add("fingerprint", "sums").alias("fingerprint"))


def _ranges(rows: DataFrame) -> tuple[list, list]:
    """Smallest and largest (k, h) of each range of rows, in order; as many
    entries as shuffle partitions at most."""
    ids = rows.select("k", "h")
    found = (ids.repartitionByRange(shuffle_partitions(rows.sparkSession), "k", "h")
             .groupBy(F.spark_partition_id().alias("p"))
             .agg(F.min(F.struct("k", "h")).alias("low"), F.max(F.struct("k", "h")).alias("high")).orderBy("p").collect())
    return [r["low"] for r in found], [r["high"] for r in found]


def edited_neighbours(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document beside its edited text and the next document.

    Next means next by descending ``key`` (ties by the text's hash), after the
    last the first; the edited text is the document with its last
    floor(n_chars/2) characters replaced by the first as many of the next.
    Texts are shuffled once, by range; the largest row of each range is sent to
    the range above it too, whose smallest row it follows. Tasks read their
    range in order and hold one slice of texts.
    """
    rows = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    kind = rows.schema["k"]
    low, high = _ranges(rows)
    if not low:
        low = high = [(None, 0)]

    def constant(values):
        return F.array(*[F.struct(F.lit(v[0]).cast(kind.dataType).alias("k"), F.lit(v[1]).cast("long").alias("h")) for v in values])

    own, lows, highs = F.struct("k", "h"), constant(low), constant(high)
    # the number of ranges that start at or below the row, by halving steps
    steps = [1 << i for i in reversed(range(len(low).bit_length()))]
    found = F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda at, step: F.when(
        F.try_element_at(lows, at + step) <= own, at + step).otherwise(at))
    rows = rows.withColumn("range", F.greatest(found, F.lit(1)))
    here = F.struct(F.col("range").alias("range"), F.lit(0).alias("extra"))
    above = F.struct((F.col("range") % len(low) + 1).alias("range"), F.lit(1).alias("extra"))
    dealt = rows.withColumn("to", F.explode(F.when(own == F.element_at(highs, F.col("range")), F.array(here, above))
                                            .otherwise(F.array(here)))).select("to.range", "to.extra", "k", "h", "text")
    dealt = (dealt.repartition(max(len(low), 1), "range")
             .sortWithinPartitions("range", "extra", F.col("k").desc(), F.col("h").desc()))

    def each(batches):
        last = None  # (range, extra, key, text, vector) of the row before
        for b in text_slices(batches, limit=CHARS_AT_ONCE // 2):
            texts = texts_of(b)
            held = list(zip(b.column("range").to_pylist(), b.column("extra").to_pylist(), b.column("k").to_pylist(),
                            texts, vectors(texts), strict=True))
            held = ([last] if last else []) + held
            last = held[-1]
            pairs = [(x, y) for x, y in zip(held, held[1:]) if x[0] == y[0] and not x[1]]
            if pairs:
                yield _beside(pairs, b.column("k").type)
        release()

    out = T.StructType([T.StructField("k", kind.dataType), T.StructField("n_chars", T.LongType()),
                        *[T.StructField(c, T.StringType()) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")],
                        T.StructField("near_edited", T.DoubleType()), T.StructField("near_next", T.DoubleType())])
    return dealt.mapInArrow(each, out).withColumnRenamed("k", key)


def _beside(pairs: list[tuple], key_type: pa.DataType) -> pa.RecordBatch:
    """Result rows of consecutive (document, next document)."""
    halves = [len(x[3]) // 2 for x, _ in pairs]
    edited = [x[3][:len(x[3]) - n] + y[3][:n] for (x, y), n in zip(pairs, halves, strict=True)]
    mine, following, changed = np.stack([x[4] for x, _ in pairs]), np.stack([y[4] for _, y in pairs]), vectors(edited)
    return pa.RecordBatch.from_arrays(
        [pa.array([x[2] for x, _ in pairs], key_type), pa.array([len(x[3]) for x, _ in pairs], pa.int64()),
         pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited]),
         pa.array(written(mine)), pa.array(written(changed)),
         pa.array(likeness(mine, changed)), pa.array(likeness(mine, following))],
        ["k", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
