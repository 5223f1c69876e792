"""Exact substring de-duplication with fixed-block anchors.

A window is a run of ``WINDOW`` words of one document. A word goes if a window
that covers it also starts, word for word, in a document with a smaller id.

1. Index and probes. The reference blocks are the non-overlapping runs of
   ``BLOCK`` words at places 0, BLOCK, 2 BLOCK, ... of every document; the
   probes are all its runs of BLOCK words. Since WINDOW >= 2 BLOCK - 1, every
   window holds a reference block whole, so two equal windows always meet in a
   block of one and a probe of the other. Both sides are hashed and packed by
   hash range; a part marks the hashes that occur in two documents and are a
   block in one of them.
2. Extension. Only windows that hold a marked run can repeat. Each gets a
   96-bit hash, and the smallest id of every window hash is found; runs of
   windows that match are the maximal repeats of WINDOW words or more.
3. The words under a window whose smallest id is below the document's go.

Documents are dealt into buckets by a hash of the row, of ``BUCKET_BYTES`` of
text on average (spark.sql.shuffle.partitions of them at least); the three steps
read the same shuffle. A task hashes its bucket in slices of ``AT_ONCE`` bytes
and holds the distinct hashes only, so its memory follows ``BUCKET_BYTES`` and
the longest text. Before anything is sent, a bucket keeps each hash once, so a
passage that a third of all documents share costs one entry a bucket.

Defined results: null, empty and blank texts have no words; texts under WINDOW
words lose nothing, texts of any length are taken whole; windows are judged on
the input; rows with equal ids do not remove each other's words; rows without an
id lose nothing and remove nothing; an empty table gives an empty result; columns
besides doc_id and text are carried along unchanged, but those named n_words,
n_removed or kept are replaced by the operator's (``without_repeats`` keeps
them). Ids are integers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import releasing, releasing_both, shuffle_partitions
from .wordhash import Words, mix, part_of, runs, unpack, window_hash

WINDOW = 50
BLOCK = 25
#: Text of a bucket, and text whose hashes make a part, on average.
BUCKET_BYTES = PART_BYTES = 16 << 20
#: Text hashed together inside a task; a longer text is taken alone.
AT_ONCE = 1 << 20
SECOND_BASE = 0xA0761D6478BD642F
#: Columns that travel with the rows inside the operator.
BUCKET, ID, TEXT = "_op8_bucket", "_op8_id", "_op8_text"


def _slices(group: pa.Table):
    """(first row, ids, words) of runs of rows of about AT_ONCE bytes; rows
    without an id take no part."""
    column = group.column(TEXT).combine_chunks()
    ids, there = group.column(ID).fill_null(0).to_numpy(), group.column(ID).is_valid().to_numpy()
    sizes = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(column):
        base = sizes[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(sizes, base + AT_ONCE, side="right")))
        texts = [t if t and ok else "" for t, ok in zip(column.slice(at, end - at).to_pylist(), there[at:end])]
        yield at, ids[at:end].astype(np.int64), Words(texts)
        at = end


def _rows(rows, schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows)) or [[] for _ in schema]
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _distinct(keys: tuple[np.ndarray, ...], ids: np.ndarray, flags: np.ndarray) -> tuple[tuple[np.ndarray, ...], np.ndarray, np.ndarray]:
    """Sorted distinct keys with the smallest id of each and its flags together;
    SEVERAL where the ids differ."""
    order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0])
    keys, ids, flags = tuple(k[order] for k in keys), ids[order], flags[order]
    first = np.flatnonzero(runs(*keys))
    if not len(first):
        return keys, ids, flags
    least = np.minimum.reduceat(ids, first)
    flags = np.bitwise_or.reduceat(flags, first) | np.where(np.maximum.reduceat(ids, first) != least, SEVERAL, 0).astype(np.uint8)
    return tuple(k[first] for k in keys), least, flags


def _merged(found: list) -> tuple[tuple[np.ndarray, ...], np.ndarray, np.ndarray] | None:
    """The slices' distinct keys as those of the bucket; empties ``found``."""
    if not found:
        return None
    keys = tuple(np.concatenate(k) for k in zip(*(f[0] for f in found)))
    ids, flags = (np.concatenate([f[i] for f in found]) for i in (1, 2))
    found.clear()
    return _distinct(keys, ids, flags)


_PACKED = pa.schema([("part", pa.int32()), (BUCKET, pa.int32()), ("low", pa.binary()), ("flags", pa.binary())])
PACKED = f"part int, {BUCKET} int, low binary, flags binary"
SEVERAL, ALIGNED = 1, 2


def _probe(group: pa.Table, parts: int) -> pa.Table:
    """Distinct run hashes of a bucket with two flags: met in two documents
    of the bucket, is a reference block."""
    found = []
    for _, ids, w in _slices(group):
        at, h = w.windows(BLOCK)
        enough = w.n[w.text[at]] >= WINDOW
        at, h = at[enough], h[enough]
        found.append(_distinct((h,), ids[w.text[at]], (w.place[at] % BLOCK == 0).astype(np.uint8) * np.uint8(ALIGNED)))
    (h,), _, flags = _merged(found) or ((np.zeros(0, np.uint64),), None, None)
    if not len(h):
        return _rows([], _PACKED)
    border = np.searchsorted(part_of(h, parts), np.arange(parts + 1))
    bucket = group.column(BUCKET)[0].as_py()
    return _rows([(p, bucket, h[a:b].astype(np.uint32).tobytes(), flags[a:b].tobytes())
                  for p, (a, b) in enumerate(zip(border[:-1], border[1:])) if b > a], _PACKED)


_MARKED = pa.schema([(BUCKET, pa.int32()), ("part", pa.int32()), ("low", pa.binary())])
MARKED = f"{BUCKET} int, part int, low binary"


def _match(group: pa.Table) -> pa.Table:
    """Marked hashes of each bucket: in two documents, a block in one."""
    lows = group.column("low").to_pylist()
    low, flags = unpack(lows, np.uint32), unpack(group.column("flags").to_pylist(), np.uint8)
    bucket = np.repeat(group.column(BUCKET).to_numpy(), [len(x) // 4 for x in lows])
    order = np.argsort(low)
    first = np.flatnonzero(runs(low[order]))
    size = np.diff(np.append(first, len(low)))
    any_flag = np.bitwise_or.reduceat(flags[order], first) if len(first) else flags[:0]
    hit = ((size > 1) | (any_flag & SEVERAL > 0)) & (any_flag & ALIGNED > 0)
    rows = order[np.repeat(hit, size)]
    rows = rows[np.lexsort((low[rows], bucket[rows]))]
    edge = np.append(np.flatnonzero(runs(bucket[rows])), len(rows))
    part = group.column("part")[0].as_py()
    return _rows([(int(bucket[rows[a]]), part, low[rows[a:b]].tobytes()) for a, b in zip(edge[:-1], edge[1:])], _MARKED)


def _window_hashes(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, 64-bit and 32-bit hash of every window."""
    at, h = w.windows(WINDOW)
    second = window_hash(w.hash * np.uint64(0xC2B2AE3D27D4EB4F) ^ (w.hash >> np.uint64(17)), WINDOW, SECOND_BASE)[at]
    return at, h, (mix(second) >> np.uint64(32)).astype(np.uint32)


_CANDIDATES = pa.schema([("part", pa.int32()), (BUCKET, pa.int32()), ("h", pa.binary()), ("g", pa.binary()), ("ids", pa.binary()),
                         ("flags", pa.binary())])
CANDIDATES = f"part int, {BUCKET} int, h binary, g binary, ids binary, flags binary"


def _extend(group: pa.Table, marks: pa.Table, parts: int) -> pa.Table:
    """Windows around marked runs: distinct hashes of the bucket, the smallest
    id of each and whether the bucket has it under several ids."""
    if not group.num_rows or not marks.num_rows:
        return _rows([], _CANDIDATES)
    lows = marks.column("low").to_pylist()
    marked = np.repeat(marks.column("part").to_numpy().astype(np.uint64), [len(x) // 4 for x in lows])
    marked = np.sort((marked << np.uint64(32)) | unpack(lows, np.uint32))
    found = []
    for _, ids, w in _slices(group):
        at, h = w.windows(BLOCK)
        key = (part_of(h, parts).astype(np.uint64) << np.uint64(32)) | (h & np.uint64(0xFFFFFFFF))
        hits = np.zeros(len(w.start) + 1, np.int32)
        hits[at[marked[np.minimum(np.searchsorted(marked, key), len(marked) - 1)] == key] + 1] = 1
        if not hits.any():
            continue
        hits = np.cumsum(hits, dtype=np.int32)
        first, h, g = _window_hashes(w)
        chosen = hits[first + WINDOW - BLOCK + 1] > hits[first]
        doc = ids[w.text[first[chosen]]]
        found.append(_distinct((h[chosen], g[chosen]), doc, np.zeros(len(doc), np.uint8)))
    merged = _merged(found)
    if merged is None or not len(merged[1]):
        return _rows([], _CANDIDATES)
    (h, g), least, flags = merged
    border = np.searchsorted(part_of(h, parts), np.arange(parts + 1))
    bucket = group.column(BUCKET)[0].as_py()
    return _rows([(p, bucket, h[a:b].tobytes(), g[a:b].tobytes(), least[a:b].tobytes(), flags[a:b].tobytes())
                  for p, (a, b) in enumerate(zip(border[:-1], border[1:])) if b > a], _CANDIDATES)


_EARLIER = pa.schema([(BUCKET, pa.int32()), ("h", pa.binary()), ("g", pa.binary()), ("ids", pa.binary())])
EARLIER = f"{BUCKET} int, h binary, g binary, ids binary"


def _earliest(group: pa.Table) -> pa.Table:
    """For each bucket its windows that a document with a smaller id has, in
    any bucket, and the smallest id of each."""
    cells = group.column("h").to_pylist()
    h, g, ids, flags = (unpack(group.column(c).to_pylist(), t)
                        for c, t in (("h", np.uint64), ("g", np.uint32), ("ids", np.int64), ("flags", np.uint8)))
    bucket = np.repeat(group.column(BUCKET).to_numpy(), [len(x) // 8 for x in cells])
    order = np.lexsort((g, h))
    h, g, ids, bucket, flags = h[order], g[order], ids[order], bucket[order], flags[order]
    first = np.flatnonzero(runs(h, g))
    least = np.repeat(np.minimum.reduceat(ids, first), np.diff(np.append(first, len(h)))) if len(first) else ids
    later = np.flatnonzero((least < ids) | (flags > 0))
    later = later[np.argsort(bucket[later], kind="stable")]
    edge = np.append(np.flatnonzero(runs(bucket[later])), len(later))
    return _rows([(int(bucket[later[a]]), h[later[a:b]].tobytes(), g[later[a:b]].tobytes(), least[later[a:b]].tobytes())
                  for a, b in zip(edge[:-1], edge[1:])], _EARLIER)


def _cut(group: pa.Table, earlier: pa.Table, names: list[str], kinds: pa.Schema) -> pa.Table:
    """The rows of the bucket with n_words, n_removed and the kept text."""
    if not group.num_rows:
        return kinds.empty_table()
    eh, eg, least = (unpack(earlier.column(c).to_pylist(), t)
                     for c, t in (("h", np.uint64), ("g", np.uint32), ("ids", np.int64)))
    order = np.lexsort((eg, eh))
    eh, eg, least = eh[order], eg[order], least[order]
    counts, removed_counts, kept = [], [], []
    texts = group.column(TEXT)
    for base, ids, w in _slices(group):
        cover = np.zeros(len(w.start) + 1, np.int32)
        if len(eh):
            first, h, g = _window_hashes(w)
            doc, gone = ids[w.text[first]], np.zeros(len(first), bool)
            # equal 64-bit hashes with different 32-bit ones are looked up one by one
            a, b = np.searchsorted(eh, h), np.searchsorted(eh, h, side="right")
            for step in range(int((b - a).max(initial=0))):
                open_ = np.flatnonzero(a + step < b)
                gone[open_] |= (eg[a[open_] + step] == g[open_]) & (least[a[open_] + step] < doc[open_])
            np.add.at(cover, first[gone], 1)
            np.add.at(cover, first[gone] + WINDOW, -1)
        stays = np.cumsum(cover, dtype=np.int32)[:-1] <= 0
        n_words = w.n.copy()
        n_removed = np.bincount(w.text[~stays], minlength=len(w.n))
        for i, n in enumerate(n_words.tolist()):
            own, at, some = w, w.first[i] + np.flatnonzero(stays[w.first[i]:w.first[i + 1]]), n
            if not some and (text := texts[base + i].as_py()):  # a row without an id, or a blank text
                own = Words([text])
                n_words[i], at = own.n[0], np.arange(own.n[0])
            kept.append(b" ".join([own.raw[s:e] for s, e in zip(own.start[at].tolist(), own.end[at].tolist())])
                        .decode("utf-8", "surrogatepass"))
        counts.append(n_words)
        removed_counts.append(n_removed)
    columns = [group.column(n) for n in names] + [pa.array(np.concatenate(c).astype(np.int64)) for c in (counts, removed_counts)]
    return pa.table([*columns, pa.array(kept, pa.string())], names=[*names, *ADDED]).cast(kinds)


#: Columns that the operator adds.
ADDED = ["n_words", "n_removed", "kept"]


def remove_repeats(docs: DataFrame, added: list[str] | None = None) -> DataFrame:
    """``docs`` with n_words, n_removed and kept (the kept words, one blank
    between them; null texts: empty). ``added`` names these columns otherwise;
    columns of ``docs`` with those names are replaced."""
    added = added or ADDED
    docs = docs.select([c for c in docs.columns if c not in added])
    if not isinstance(docs.schema["doc_id"].dataType, T.IntegralType):
        raise TypeError(f"doc_id must be an integer, not {docs.schema['doc_id'].dataType.simpleString()}")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts, buckets = (max(shuffle_partitions(docs.sparkSession), -(-size // each)) for each in (PART_BYTES, BUCKET_BYTES))
    # inside, columns have names of their own, so that no column can clash
    names = [{"doc_id": ID, "text": TEXT}.get(c, f"c{k}") for k, c in enumerate(docs.columns)]
    fields = [T.StructField(n, f.dataType) for n, f in zip(names, docs.schema.fields)]
    schema = T.StructType([*fields, *[T.StructField(n, t) for n, t in zip(ADDED, (T.LongType(), T.LongType(), T.StringType()))]])
    kinds = to_arrow_schema(schema)
    dealt = docs.toDF(*names).withColumn(BUCKET, F.pmod(F.xxhash64(ID, TEXT), F.lit(buckets)).cast("int"))
    probes = dealt.groupBy(BUCKET).applyInArrow(releasing(lambda g: _probe(g, parts)), PACKED)
    marks = probes.groupBy("part").applyInArrow(releasing(lambda g: _match(g)), MARKED)
    windows = (dealt.groupBy(BUCKET).cogroup(marks.groupBy(BUCKET))
               .applyInArrow(releasing_both(lambda g, m: _extend(g, m, parts)), CANDIDATES))
    earlier = windows.groupBy("part").applyInArrow(releasing(lambda g: _earliest(g)), EARLIER)
    out = (dealt.groupBy(BUCKET).cogroup(earlier.groupBy(BUCKET))
           .applyInArrow(releasing_both(lambda g, e: _cut(g, e, names, kinds)), schema))
    return out.toDF(*docs.columns, *added)


def without_repeats(docs: DataFrame) -> DataFrame:
    """Pipeline stage: documents that lose words get their kept text (and its
    length in n_chars where there is such a column); those that lose all go."""
    added = ["_" * max(map(len, docs.columns)) + c for c in ADDED]  # longer than any name
    total, gone, kept = added
    out = remove_repeats(docs, added).filter(F.col(gone).isin(0) | (F.col(gone) < F.col(total)))
    changed = F.col(gone) > 0
    columns = [F.when(changed, F.col(kept)).otherwise(F.col("text")).alias(c) if c == "text" else
               F.when(changed, F.length(kept).cast(docs.schema[c].dataType)).otherwise(F.col(c)).alias(c) if c == "n_chars"
               else F.col(f"`{c}`") for c in docs.columns]
    return out.select(columns)
