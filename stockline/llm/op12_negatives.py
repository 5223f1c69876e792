"""Hard-negative mining: top scores in a window, by threshold joins.

For each anchor the best rows of its own label (positives), and for each of
those the best rows of other labels whose score lies in a window below the
positive's. Scores are exact integer inner products.

Both searches are the same threshold join, run inside tasks over a block of
anchors and slices of packed rows:

* At threshold t an inverted index of a slice (per group of dimensions, the rows
  that have it) omits a row's last dimensions as far as the norm of that suffix
  times the largest anchor norm stays below t: a pair that meets in omitted
  dimensions only can't reach t.
* Partial scores are accumulated over the indexed dimensions; after every group
  rows that can't reach any anchor's threshold with the norms that remain are
  dropped. The pairs left are verified with their exact inner product.
* Thresholds start high and are lowered, for the anchors whose windows are not
  yet full, until they are full or the window ends. A full window's last entry
  is the anchor's threshold for all further slices.

Anchors are cut into blocks of ``BLOCK``, rows are dealt to streams; a task
reads one (block, stream) in order, slice by slice, so its memory holds a block,
its windows and one slice, whatever the number of rows. The streams' windows
are merged per anchor. A row is shipped once per block, a block once per stream.

Handling: rows with a null id, label or vector, or a null or non-finite
component take no part; of rows with equal ids the one with the smallest (label,
vector) does; shorter vectors count as filled with zeros; ties go by smaller id;
an empty table, or one without anchors, gives an empty result; extra columns are
ignored. Ids and labels are integers; a scaled component of 2^28 or more counts
as not finite.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, release

#: Anchors of a block, rows of a slice, anchors scored together, rows of a stream.
BLOCK, SLICE, TOGETHER, STREAM = 65_536, 2_048, 256, 8_192
#: Dimensions of a posting group, and the thresholds tried as parts of the largest possible score.
GROUP, LEVELS = 8, (0.8, 0.65, 0.5, 0.4, 0.3, 0.2, 0.1, 0.0)
#: Components from here on count as not finite, so that scores fit in a long.
LARGEST = 1 << 28
NEVER = np.iinfo(np.int64).min // 2


# ---- inside tasks: the threshold join --------------------------------------

def prepared(x: np.ndarray) -> dict:
    """Integer vectors with their double form and the norms of x[:, c:] for
    c = 0, GROUP, ... (the last is 0)."""
    v = x.astype(np.float64)
    groups = np.add.reduceat(v * v, np.arange(0, v.shape[1], GROUP), axis=1)
    tail = np.cumsum(groups[:, ::-1], axis=1)[:, ::-1]
    return {"x": x, "v": v, "norms": np.sqrt(np.hstack([tail, np.zeros((len(v), 1))]))}


def pairs_at_least(anchors: dict, rows: dict, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, score) of all pairs with score >= least[anchor]."""
    a, a_norms, y, y_norms = anchors["v"], anchors["norms"], rows["v"], rows["norms"]
    least, exact = least.astype(np.float64), least
    # bounds are taken in double: half a point and its rounding stay below them
    least = least - 0.5 - 1e-12 * a_norms[:, 0] * y_norms[:, 0].max()
    t = least.min()
    # index: groups a row keeps; the norm of the omitted suffix can't reach t alone
    kept = (y_norms * a_norms[:, 0].max() >= t).sum(1) if t > 0 else np.full(len(y), y_norms.shape[1] - 1)
    kept = np.minimum(kept, y_norms.shape[1] - 1)
    order = np.argsort(-kept, kind="stable")
    order = order[kept[order] > 0] if t > 0 else order
    partial = np.zeros((len(a), len(order)))
    for g in range(y_norms.shape[1] - 1):
        n = int(np.searchsorted(-kept[order], -g, side="left"))  # rows with this group indexed come first
        if not n:
            break
        dims = slice(g * GROUP, (g + 1) * GROUP)
        partial[:, :n] += a[:, dims] @ y[order[:n], dims].T
        if g % 2 and t > 0:
            rest = np.minimum(kept[order], g + 1)
            reach = partial + a_norms[:, rest] * y_norms[order, rest]
            live = (reach >= least[:, None]).any(0)
            if not live.all():
                order, partial = order[live], partial[:, live]
    reach = partial + a_norms[:, kept[order]] * y_norms[order, kept[order]]
    i, j = np.nonzero(reach >= least[:, None])
    j = order[j]
    score = np.empty(len(i), np.int64)
    for s in range(0, len(i), 65_536):  # verification
        p = slice(s, s + 65_536)
        score[p] = np.einsum("ij,ij->i", anchors["x"][i[p]], rows["x"][j[p]])
    good = score >= exact[i]
    return i[good], j[good], score[good]


class Windows:
    """Best ``size`` (score, id) of each window: window w of anchor w // per
    takes scores from low[w] to high[w]."""

    def __init__(self, low: np.ndarray, high: np.ndarray, per: int, size: int):
        self.low, self.high, self.per, self.size = low, high, per, size
        self.score = np.full((len(low), size), NEVER)
        self.id = np.zeros((len(low), size), np.int64)

    def floor(self) -> np.ndarray:
        """Per anchor the least score that can still enter one of its windows."""
        last = np.maximum(self.score[:, -1], self.low)
        return np.where(self.low > self.high, np.iinfo(np.int64).max // 2, last).reshape(-1, self.per).min(1)

    def offer(self, anchor: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        w = (anchor[:, None] * self.per + np.arange(self.per)).ravel()
        s, k = np.repeat(score, self.per), np.repeat(ids, self.per)
        fits = (s >= np.maximum(self.low, self.score[:, -1])[w]) & (s <= self.high[w])
        w, s, k = w[fits], s[fits], k[fits]
        if not len(w):
            return
        touched = np.unique(w)
        w = np.concatenate([w, np.repeat(touched, self.size)])
        s = np.concatenate([s, self.score[touched].ravel()])
        k = np.concatenate([k, self.id[touched].ravel()])
        order = np.lexsort((k, -s, w))
        w, s, k = w[order], s[order], k[order]
        rank = np.arange(len(w)) - np.searchsorted(w, w)
        best = rank < self.size
        self.score[w[best], rank[best]], self.id[w[best], rank[best]] = s[best], k[best]


def search(windows: Windows, a: dict, y: dict, same_label: bool) -> None:
    """Offer the windows every pair of anchors ``a`` and rows ``y`` that can
    enter, thresholds falling until nothing is missing."""
    for s in range(0, len(a["id"]), TOGETHER):
        part = np.arange(s, min(s + TOGETHER, len(a["id"])))
        # positives: only equal labels meet, so anchors and rows go label by label
        for label in np.unique(a["label"][part]) if same_label else [None]:
            mine = part if label is None else part[a["label"][part] == label]
            rows = np.arange(len(y["id"])) if label is None else np.flatnonzero(y["label"] == label)
            if not len(rows):
                continue
            near = {c: y[c][rows] for c in ("x", "v", "norms")}
            most = a["norms"][mine, 0] * y["norms"][rows, 0].max()
            above = np.full(len(mine), np.iinfo(np.int64).max // 2)
            for level in (*LEVELS, None):
                floor = windows.floor()[mine]
                least = floor if level is None else np.maximum(floor, np.ceil(level * most).astype(np.int64))
                least = np.minimum(least, above)
                todo = np.flatnonzero((least < above) & (floor < above))
                if not len(todo):
                    break
                i, j, score = pairs_at_least({c: a[c][mine[todo]] for c in ("x", "v", "norms")}, near, least[todo])
                i = todo[i]
                new = score < above[i]
                anchor, row = mine[i], rows[j]
                new &= (a["id"][anchor] != y["id"][row]) if same_label else (a["label"][anchor] != y["label"][row])
                windows.offer(anchor[new], score[new], y["id"][row][new])
                above = least


# ---- packing ---------------------------------------------------------------

#: A packed row: ids, labels and vectors (the narrowest integers that hold
#: them) of many rows, and of anchors their positives.
PACKED = "block int, ids binary, labels binary, vectors binary, width int, size int, positives binary"
PACKED_COLUMNS = [c.split()[0] for c in PACKED.split(", ")]
PACKED_TYPE = pa.schema([("block", pa.int32()), ("ids", pa.binary()), ("labels", pa.binary()), ("vectors", pa.binary()),
                         ("width", pa.int32()), ("size", pa.int32()), ("positives", pa.binary())])


def _packed(block: int, rows: list[dict], positives: int) -> dict:
    width = max(1, *(len(r["x"]) for r in rows))
    flat = np.zeros((len(rows), width), np.int64)
    best = np.full((len(rows), positives, 2), NEVER)
    for k, r in enumerate(rows):
        flat[k, :len(r["x"])] = r["x"]
        for m, entry in enumerate(r["positives"] or ()):
            best[k, m] = entry["positive_id"], entry["positive_score"]
    most = int(np.abs(flat).max(initial=0))
    size = 2 if most < 1 << 15 else 4 if most < 1 << 31 else 8
    return {"block": block, "ids": np.array([r["vec_id"] for r in rows], np.int64).tobytes(),
            "labels": np.array([r["label"] for r in rows], np.int64).tobytes(),
            "vectors": flat.astype(f"<i{size}").tobytes(), "width": width, "size": size, "positives": best.tobytes()}


def _unpacked(row: dict) -> dict:
    n = len(row["ids"]) // 8
    return {"id": np.frombuffer(row["ids"], np.int64), "label": np.frombuffer(row["labels"], np.int64),
            "x": np.frombuffer(row["vectors"], f"<i{row['size']}").reshape(n, row["width"]).astype(np.int64)}


def _pack(rows: DataFrame, limit: int, positives: int = 0) -> DataFrame:
    """Rows (block, vec_id, label, x, positives) as packed rows of one block
    and at most ``limit`` rows each."""
    def each(batches):
        held: dict[int, list[dict]] = {}

        def out(block):
            return pa.RecordBatch.from_pylist([_packed(block, held.pop(block), positives)], PACKED_TYPE)
        for b in batches:
            for row in b.to_pylist():
                held.setdefault(row["block"], []).append(row)
                if len(held[row["block"]]) == limit:
                    yield out(row["block"])
        for block in list(held):
            yield out(block)
        release()

    return rows.select("block", "vec_id", "label", "x", "positives").mapInArrow(each, PACKED)


def _rows(packed: DataFrame) -> DataFrame:
    """Rows (vec_id, label, x) of packed ones."""
    def each(batches):
        for b in batches:
            for row in b.to_pylist():
                u = _unpacked(row)
                at = np.arange(len(u["id"]) + 1, dtype=np.int32) * row["width"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(u["id"]), pa.array(u["label"]), pa.ListArray.from_arrays(at, u["x"].ravel())],
                    ["vec_id", "label", "x"])
    return packed.mapInArrow(each, "vec_id long, label long, x array<long>")


# ---- a block of anchors against a stream of slices -------------------------

def _wide(x: np.ndarray, width: int) -> np.ndarray:
    return x if x.shape[1] == width else np.hstack([x, np.zeros((len(x), width - x.shape[1]), x.dtype)])


class Block:
    """Anchors of a cell, their windows, and the slices that pass by."""

    def __init__(self, parts: list[dict]):
        self.parts = parts
        rows = [_unpacked(p) for p in parts]
        width = max(1, *(r["x"].shape[1] for r in rows))
        self.a = {c: np.concatenate([r[c] for r in rows]) for c in ("id", "label")}
        x = np.vstack([_wide(r["x"], width) for r in rows])
        # dimensions by falling energy, so that suffixes are short
        self.order = np.argsort(-(x.astype(np.float64) ** 2).sum(0), kind="stable")
        self.a |= prepared(x[:, self.order])
        self.windows = self.make_windows()

    def add(self, row: dict) -> None:
        y = _unpacked(row)  # dimensions that no anchor has add nothing
        y |= prepared(_wide(y["x"][:, :len(self.order)], len(self.order))[:, self.order])
        search(self.windows, self.a, y, self.same_label)

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, id, score) of all entries."""
        w, r = np.nonzero(self.windows.score > NEVER)
        return w, self.windows.id[w, r], self.windows.score[w, r]


class Positives(Block):
    """The best ``size`` other rows of the anchor's label."""

    same_label, size = True, 0
    schema = "anchor_id long, positive_id long, positive_score long"

    def make_windows(self) -> Windows:
        n = len(self.a["id"])
        return Windows(np.full(n, NEVER + 1), np.full(n, -NEVER), 1, self.size)

    def results(self) -> list[np.ndarray]:
        w, ids, score = self.found()
        return [self.a["id"][w], ids, score]


class Negatives(Block):
    """The best ``size`` rows of other labels in the window of each positive."""

    same_label, size, per, low, high = False, 0, 0, 0, 0
    schema = "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"

    def make_windows(self) -> Windows:
        best = np.concatenate([np.frombuffer(p["positives"], np.int64).reshape(-1, 2) for p in self.parts])
        self.positive, score = best[:, 0], best[:, 1]
        self.score, there = score, score > NEVER
        p = np.where(there, score, 0)
        return Windows(np.where(there, -((-self.low * p) // 100), 1), np.where(there, (self.high * p) // 100, 0),
                       self.per, self.size)

    def results(self) -> list[np.ndarray]:
        w, ids, score = self.found()
        return [self.a["id"][w // self.per], self.positive[w], self.score[w], ids, score]


def _join(slices: DataFrame, anchors: DataFrame, blocks: int, streams: int, kind: type[Block], **settings: int) -> DataFrame:
    """The windows of every (block, stream). Anchors come first in their cell,
    so a task keeps one block and reads slices one by one."""
    job = type(kind.__name__, (kind,), settings)
    schema = kind.schema
    names = [c.split()[0] for c in schema.split(", ")]
    left = anchors.select("*", F.explode(F.sequence(F.lit(0), F.lit(streams - 1))).alias("stream"), F.lit(0).alias("kind"))
    right = (slices.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("kind", F.lit(1)))
    cells = (left.select(*right.columns).unionByName(right).repartition(blocks * streams, "block", "stream")
             .sortWithinPartitions("block", "stream", "kind"))

    def each(batches):
        cell, parts, block = None, [], None

        def out():
            if block:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in block.results()], names)
        for b in batches:
            for k in range(b.num_rows):
                row = b.slice(k, 1).to_pylist()[0]
                if (row["block"], row["stream"]) != cell:
                    yield from out()
                    cell, parts, block = (row["block"], row["stream"]), [], None
                if row["kind"] == 0:
                    parts.append(row)
                elif parts:
                    block = block or job(parts)
                    block.add(row)
        yield from out()
        release()

    return cells.mapInArrow(each, schema)


# ---- over DataFrames -------------------------------------------------------

def scaled(vectors: DataFrame, factor: int = 256, label: Column | str = "label", vec_id: str = "vec_id",
           vector: str = "embedding") -> DataFrame:
    """(vec_id, label, x): components as floor(factor * c) in double; rows that
    take no part are gone, one row per id."""
    c = F.col(vector)
    bad = F.exists(c, lambda v: v.isNull() | F.isnan(v) | (F.abs(v.cast("double") * factor) >= float(LARGEST)))
    return (vectors.select(F.col(vec_id).cast("long").alias("vec_id"),
                           (F.col(label) if isinstance(label, str) else label).cast("long").alias("label"),
                           F.when(c.isNotNull() & ~bad, F.transform(
                               c, lambda v: F.floor(F.lit(float(factor)) * v.cast("double")))).alias("x"))
            .dropna().groupBy("vec_id").agg(F.min(F.struct("label", "x")).alias("row"))
            .select("vec_id", "row.label", "row.x"))


def hard_negatives(rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 3,
                   low: int = 50, high: int = 95) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and
    negative_score, for rows (vec_id, label, x) as ``scaled`` gives them.

    Positives of an anchor are its best ``positives`` other rows of the same
    label; the negatives of a positive are the best ``negatives`` rows of other
    labels with low * positive_score <= 100 * score <= high * positive_score.
    """
    none = F.lit(None).cast("array<struct<positive_id:long,positive_score:long>>")
    slices = cut(_pack(rows.select("*", F.lit(0).alias("block"), none.alias("positives")), SLICE))
    counted = slices.agg(F.sum(F.length("ids") / 8).cast("long").alias("n")).first()["n"] or 0
    streams = max(1, -(-counted // STREAM))
    slices = slices.withColumn("stream", F.pmod(F.xxhash64("ids"), F.lit(streams)).cast("int"))
    chosen = _rows(slices.select(*PACKED_COLUMNS)).filter(anchor)
    blocks = max(1, -(-chosen.count() // BLOCK))
    chosen = chosen.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")).repartition(blocks, "block")

    found = _join(slices, _pack(chosen.withColumn("positives", none), SLICE), blocks, streams, Positives, size=positives)
    best = _best(found, ["anchor_id"], "positive", positives)
    best = best.groupBy(F.col("anchor_id").alias("vec_id")).agg(  # at most ``positives`` entries
        F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    seeded = _pack(chosen.join(best, "vec_id").repartition(blocks, "block"), SLICE, positives)
    mined = _join(slices, seeded, blocks, streams, Negatives, size=negatives, per=positives, low=low, high=high)
    return _best(mined, ["anchor_id", "positive_id", "positive_score"], "negative", negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _best(found: DataFrame, keys: list[str], what: str, size: int) -> DataFrame:
    """The best ``size`` per key of all streams' windows, ranked; a key has at
    most ``size`` rows a stream."""
    w = Window.partitionBy(*keys).orderBy(F.col(f"{what}_score").desc(), f"{what}_id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= size)
