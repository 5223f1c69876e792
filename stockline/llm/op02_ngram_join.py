"""Exact Jaccard self-join on word shingles with prefix filtering.

A document is the set of its distinct shingles (A-Z lower-cased); two link
when 100 * intersection >= 90 * union for the three words and the ratio of
``NGRAM_JOIN``; other rules are a number of words and a ratio of integers.
Equal texts are one text from the first task on, so a group of copies is never
compared with itself.

1. Each task hashes the shingles of its distinct texts and sends them, packed
   by hash range, to the part that counts in how many texts each occurs; there
   is a part for each ``PART_BYTES`` of text (spark.sql.shuffle.partitions at
   least), so that what a task holds does not follow that setting.
2. The parts answer with the shingles that occur in two texts or more. A text
   orders its shingles rare first (frequency, then hash); those of one text
   only come first and match nothing. A text whose prefix, n - ceil(0.9 n) + 1
   shingles, holds only such has no partner and is done.
3. The prefix shingles of the others are the join keys. Texts that share one
   are put into the same chunk or into a pair of chunks (of ``CHUNK`` texts at
   most on average), and each pair of chunks is compared once: pairs come from
   the prefix shingles, pass the length, positional and suffix filters at
   their first common shingle, and are verified once by counting common
   shingles. A group of thousands of near copies is thus spread over many
   tasks and its pairs are never rows.
4. Components of the links (star edges per pair of chunks) by repeated minima.

Shingles are compared by 48 bits of their hash together with their frequency,
equal texts by their 64-bit hash.

Defined results: null and wordless texts have no shingle and link with
nothing, not even with each other; a text with fewer words than a shingle is one;
repeated rows are copies; a null id takes part but is never a component id;
ties do not arise (links are decided on integers); texts of any length are taken
whole; an empty table gives an empty result; extra columns are ignored
(``one_of_each`` keeps them, whatever their names).
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, releasing, shuffle_partitions, text_slices, texts_of
from .graph import components
from .wordhash import WORD_BASE, Words, mix, part_of, runs, unpack

#: Text whose shingles make a part, on average.
PART_BYTES = 16 << 20
CHUNK = 512
CHUNK_SHINGLES = 1_000_000
SUFFIX_RANGES = 16
#: Frequencies at or above this are one class in the order.
MOST_FREQUENT = 32_767
LOW48 = np.uint64((1 << 48) - 1)

PACKED = "part int, low binary, mid binary, owner binary, keys binary, meta_keys binary, meta_n binary"


class Rule(NamedTuple):
    """Words of a shingle and the least Jaccard similarity, num / den."""
    shingle: int
    num: int
    den: int

    def least_common(self, n, m):
        """Shingles that two linked texts of n and m shingles must share at least."""
        return -(-self.num * (n + m) // (self.num + self.den))

    def prefix(self, n):
        """Shingles of a text of n of which a partner must share one."""
        return n - (self.num * n + self.den - 1) // self.den + 1


#: The rule of the query op2_ngram_join.
NGRAM_JOIN = Rule(3, 90, 100)
#: The rule of near-duplicate stages.
NEAR_DUPLICATE = Rule(5, 80, 100)


def _shingles(texts: list[str], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (hash, text), sorted by hash."""
    w = Words(texts, lower=True)
    at, h = w.windows(size)
    text = w.text[at]
    few = np.flatnonzero((w.n > 0) & (w.n < size))
    if len(few):
        ends = np.append(w.hash, np.zeros(size, np.uint64))  # words past a short text count as nothing
        whole = sum((np.where(j < w.n[few], ends[w.first[few] + j], 0) * np.uint64(pow(WORD_BASE, j, 1 << 64)) for j in range(size)),
                    np.zeros(len(few), np.uint64))
        whole = mix(whole + w.n[few].astype(np.uint64))
        h, text = np.concatenate([h, whole]), np.concatenate([text, few])
    order = np.argsort(h)
    h, text = h[order], text[order]
    same = np.flatnonzero(~runs(h))
    if len(same):  # order the few equal hashes by text and drop repeats
        at = np.unique(np.concatenate([same, same - 1]))
        inner = np.lexsort((text[at], h[at]))
        text[at] = text[at][inner]
        keep = runs(h, text)
        h, text = h[keep], text[keep]
    return h, text


def _pack_batches(batches, parts: int, size: int):
    seen: set[int] = set()
    for batch in text_slices(batches, limit=2_000_000):
        keys = batch.column("k").to_numpy(zero_copy_only=False)
        new = []
        for i, k in enumerate(keys.tolist()):
            if k not in seen:
                seen.add(k)
                new.append(i)
        if not new:
            continue
        keys = keys[new]
        h, text = _shingles(texts_of(batch.take(pa.array(new))), size)
        n = np.bincount(text, minlength=len(new))
        border = np.searchsorted(part_of(h, parts), np.arange(parts + 1))
        home = np.mod(keys, parts)
        rows = []
        for p in range(parts):
            a, b = border[p], border[p + 1]
            mine = home == p
            if a == b and not mine.any():
                continue
            present, owner = np.unique(text[a:b], return_inverse=True)
            low = h[a:b]
            rows.append((p, low.astype(np.uint32).tobytes(), (low >> np.uint64(32)).astype(np.uint16).tobytes(),
                         owner.astype(np.uint32 if len(present) > 65_535 else np.uint16).tobytes(),
                         keys[present].tobytes(), keys[mine].tobytes(), n[mine].astype(np.int64).tobytes()))
        yield _rows(rows, [pa.int32()] + [pa.binary()] * 6, ["part", "low", "mid", "owner", "keys", "meta_keys", "meta_n"])


def _rows(rows, kinds, names):
    columns = list(zip(*rows)) or [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


ANSWER = "bucket int, counts binary, keys binary, shingles binary, meta_keys binary, meta_n binary"


def _count_part(group: pa.Table, buckets: int) -> pa.Table:
    """Shingles of one part that occur in two texts or more, by bucket of the
    text, and the sizes of the texts that came with the part."""
    hashes, owners = [], []
    for low, mid, owner, keys in zip(*(group.column(c).to_pylist() for c in ("low", "mid", "owner", "keys"))):
        k = np.frombuffer(keys, np.int64)
        hashes.append(np.frombuffer(low, np.uint32) | (np.frombuffer(mid, np.uint16).astype(np.uint64) << np.uint64(32)))
        owners.append(k[np.frombuffer(owner, np.uint32 if len(k) > 65_535 else np.uint16)])
    h, k = np.concatenate(hashes), np.concatenate(owners)
    order = np.argsort(h)
    h, k = h[order], k[order]
    shared = ~runs(h)
    shared[:-1] |= shared[1:]  # all rows of a run of two or more
    h, k = h[shared], k[shared]
    order = np.lexsort((k, h))
    h, k = h[order], k[order]
    keep = runs(h, k)  # the same text from several tasks
    h, k = h[keep], k[keep]
    new = runs(h)
    frequency = np.diff(np.append(np.flatnonzero(new), len(h)))
    frequency = np.repeat(frequency, frequency)
    h, k, frequency = h[frequency > 1], k[frequency > 1], frequency[frequency > 1]
    shingle = (np.minimum(frequency, MOST_FREQUENT).astype(np.uint64) << np.uint64(48)) | h
    bucket = np.mod(k, buckets)
    order = np.lexsort((k, bucket))
    shingle, k, bucket = shingle[order], k[order], bucket[order]
    meta_k, meta_n = unpack(group.column("meta_keys").to_pylist(), np.int64), unpack(group.column("meta_n").to_pylist(), np.int64)
    meta_b = np.mod(meta_k, buckets)
    order = np.argsort(meta_b, kind="stable")
    meta_k, meta_n, meta_b = meta_k[order], meta_n[order], meta_b[order]
    rows = []
    edge, meta_edge = (np.searchsorted(x, np.arange(buckets + 1)) for x in (bucket, meta_b))
    for b in range(buckets):
        s, m = slice(edge[b], edge[b + 1]), slice(meta_edge[b], meta_edge[b + 1])
        if s.start == s.stop and m.start == m.stop:
            continue
        first = np.flatnonzero(runs(k[s]))
        counts = np.diff(np.append(first, s.stop - s.start))
        rows.append((b, counts.astype(np.int32).tobytes(), k[s][first].tobytes(), shingle[s].tobytes(),
                     meta_k[m].tobytes(), meta_n[m].tobytes()))
    return pa.Table.from_batches([_rows(rows, [pa.int32()] + [pa.binary()] * 5,
                                        ["bucket", "counts", "keys", "shingles", "meta_keys", "meta_n"])])


def _assemble(group: pa.Table, rule: Rule) -> pa.Table:
    """k, n and, where a partner is possible, the shared shingles rare first."""
    counts = unpack(group.column("counts").to_pylist(), np.int32)
    keys = np.repeat(unpack(group.column("keys").to_pylist(), np.int64), counts)
    shingles = unpack(group.column("shingles").to_pylist(), np.uint64)
    order = np.lexsort((shingles, keys))
    keys, shingles = keys[order], shingles[order].astype(np.int64)
    k, at = np.unique(unpack(group.column("meta_keys").to_pylist(), np.int64), return_index=True)
    n = unpack(group.column("meta_n").to_pylist(), np.int64)[at]
    a, b = np.searchsorted(keys, k), np.searchsorted(keys, k, side="right")
    prefix = rule.prefix(n)
    alone = n - (b - a)
    lists = [shingles[x:y] if s < p and y > x else None for x, y, s, p in zip(a, b, alone, prefix)]
    return pa.table({"k": pa.array(k), "n": pa.array(n), "alone": pa.array(alone),
                     "shingles": pa.array(lists, pa.list_(pa.int64()))})


class _Side:
    def __init__(self, rows: dict):
        self.k = np.array(rows["k"], np.int64)
        self.n = np.array(rows["n"], np.int64)
        self.alone = np.array(rows["alone"], np.int64)
        self.shingles = [np.asarray(s, np.int64) for s in rows["shingles"]]


def _candidates(x: _Side, y: _Side, same: bool, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (index in x, index in y) that share a prefix shingle and pass the
    length, positional and suffix filters."""
    def prefixes(side, which):
        out = []
        for i, s in enumerate(side.shingles):
            p = s[:max(0, rule.prefix(int(side.n[i])) - int(side.alone[i]))]
            out.append(np.stack([p, np.full(len(p), i), np.arange(len(p)) + side.alone[i], np.full(len(p), which)]))
        return np.concatenate(out, axis=1) if out else np.zeros((4, 0), np.int64)

    rows = prefixes(x, 0) if same else np.concatenate([prefixes(x, 0), prefixes(y, 1)], axis=1)
    rows = rows[:, np.argsort(rows[0], kind="stable")]  # rare shingles first
    edge = np.append(np.flatnonzero(runs(rows[0])), rows.shape[1])
    met = np.zeros((len(x.k), len(y.k)), bool)
    out = []
    for a, b in zip(edge[:-1], edge[1:]):
        if b - a < 2:
            continue
        doc, place, side = rows[1, a:b], rows[2, a:b], rows[3, a:b]
        ia, ib = (slice(None), slice(None)) if same else (side == 0, side == 1)
        da, pa_, db, pb = doc[ia], place[ia], doc[ib], place[ib]
        if not len(da) or not len(db):
            continue
        fresh = ~met[np.ix_(da, db)]
        if same:
            fresh &= da[:, None] < db[None, :]
        if not fresh.any():
            continue
        met[np.ix_(da, db)] = True
        i, j = np.nonzero(fresh)
        nx, ny = x.n[da[i]], y.n[db[j]]
        fits = rule.den * np.minimum(nx, ny) >= rule.num * np.maximum(nx, ny)
        fits &= 1 + np.minimum(nx - pa_[i], ny - pb[j]) - 1 >= rule.least_common(nx, ny)
        out.append((da[i[fits]], db[j[fits]]))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    i, j = (np.concatenate(z) for z in zip(*out))
    # suffix filter: no more can be common than the smaller count in each range of shingles
    every = np.concatenate([s for s in (*x.shingles, *([] if same else y.shingles))])
    cuts = np.unique(np.quantile(every, np.linspace(0, 1, SUFFIX_RANGES + 1)[1:-1], method="nearest"))

    def spread(side):
        return np.array([np.diff(np.concatenate([[0], np.searchsorted(s, cuts), [len(s)]])) for s in side.shingles], np.int32)

    sx = spread(x)
    sy = sx if same else spread(y)
    fits = np.zeros(len(i), bool)
    for a in range(0, len(i), 100_000):
        b = slice(a, a + 100_000)
        fits[b] = np.minimum(sx[i[b]], sy[j[b]]).sum(1) >= rule.least_common(x.n[i[b]], y.n[j[b]])
    return i[fits], j[fits]


def _common(x: _Side, y: _Side, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Number of common shingles of each pair."""
    docs = [*x.shingles, *y.shingles]
    need = np.unique(np.concatenate([i, j + len(x.shingles)]))
    every, code = np.unique(np.concatenate([docs[d] for d in need]), return_inverse=True)
    words = -(-len(every) // 64)
    if len(i) < 32 or words * len(need) * 8 > 64 << 20:
        return np.array([len(np.intersect1d(x.shingles[a], y.shingles[b], assume_unique=True)) for a, b in zip(i, j)], np.int64)
    row = np.repeat(np.arange(len(need)), [len(docs[d]) for d in need])
    bits = np.zeros((len(need), words * 64), bool) if words * 64 * len(need) <= 32 << 20 else None
    if bits is not None:
        bits[row, code] = True
        packed = np.packbits(bits, axis=1).view(np.uint64)
    else:
        packed = np.zeros((len(need), words), np.uint64)
        np.bitwise_or.at(packed, (row, code // 64), np.uint64(1) << (code % 64).astype(np.uint64))
    pi, pj = np.searchsorted(need, i), np.searchsorted(need, j + len(x.shingles))
    out = np.empty(len(i), np.int64)
    step = max(1, (4 << 20) // words)
    for a in range(0, len(i), step):
        out[a:a + step] = np.bitwise_count(packed[pi[a:a + step]] & packed[pj[a:a + step]]).sum(1)
    return out


def _stars(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Node and least node of its component, for the links of one unit."""
    nodes, code = np.unique(np.concatenate([left, right]), return_inverse=True)
    a, b = code[:len(left)], code[len(left):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        after = root.copy()
        np.minimum.at(after, a, low)
        np.minimum.at(after, b, low)
        np.minimum.at(after, root[a], low)
        np.minimum.at(after, root[b], low)
        after = after[after]
        if (after == root).all():
            return nodes, nodes[root]
        root = after


def _verify(group: pa.Table, rule: Rule) -> pa.Table:
    """Links of the units (pairs of chunks) in one group: k, root, links."""
    out = []
    units = group.column("unit").to_numpy()
    order = np.argsort(units, kind="stable")
    edge = np.append(np.flatnonzero(runs(units[order])), len(order))
    for a, b in zip(edge[:-1], edge[1:]):
        rows = group.take(pa.array(order[a:b]))
        side = rows.column("side").to_numpy()
        same = not side.any()

        def part(which):
            t = rows.filter(pa.array(side == which))
            t = t.take(pa.array(np.argsort(t.column("k").to_numpy())))
            return _Side({"k": t.column("k").to_numpy(), "n": t.column("n").to_numpy(), "alone": t.column("alone").to_numpy(),
                          "shingles": [c.values.to_numpy() for c in t.column("shingles")]})

        x = part(0)
        y = x if same else part(1)
        i, j = _candidates(x, y, same, rule)
        if not len(i):
            continue
        both = _common(x, y, i, j)
        linked = both >= rule.least_common(x.n[i], y.n[j])
        if not linked.any():
            continue
        left, right = x.k[i[linked]], y.k[j[linked]]
        k, root = _stars(left, right)
        links = np.bincount(np.searchsorted(k, np.concatenate([left, right])), minlength=len(k))
        out.append(pa.table({"k": k, "root": root, "links": links.astype(np.int64)}))
    empty = pa.table({"k": pa.array([], pa.int64()), "root": pa.array([], pa.int64()), "links": pa.array([], pa.int64())})
    return pa.concat_tables([empty, *out])


def shared_shingles(texts: DataFrame, rule: Rule = NGRAM_JOIN) -> DataFrame:
    """k, n, alone, shingles for every distinct text (k, text)."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(shuffle_partitions(texts.sparkSession), -(-size // PART_BYTES))
    packed = texts.mapInArrow(lambda it: _pack_batches(it, parts, rule.shingle), PACKED)
    counted = packed.groupBy("part").applyInArrow(releasing(lambda g: _count_part(g, parts)), ANSWER)
    return counted.groupBy("bucket").applyInArrow(releasing(lambda g: _assemble(g, rule)), "k long, n long, alone long, shingles array<long>")


def linked_texts(sets: DataFrame, rule: Rule = NGRAM_JOIN) -> DataFrame:
    """Star edges and numbers of links of the texts in ``sets``."""
    possible = sets.filter("shingles IS NOT NULL")
    prefix = F.expr(f"slice(shingles, 1, cast(n - ({rule.num} * n + {rule.den - 1}) div {rule.den} + 1 - alone as int))")
    postings = possible.select("k", F.size("shingles").alias("w"), F.explode(prefix).alias("s"))
    shared = postings.groupBy("s").agg(F.count("*").alias("c"), F.min("k").alias("hub")).filter("c > 1")
    postings = cut(postings.join(shared.select("s", "hub"), "s"))
    # the least text reachable over two shared shingles is the home of a text
    home = postings.groupBy("k").agg(F.min("hub").alias("home"), F.first("w").alias("w"))
    hubs = postings.select("s", "k").join(home.select("k", "home"), "k").groupBy("s").agg(F.min("home").alias("hub"))
    home = (postings.select("s", "k", "w").join(hubs, "s").groupBy("k")
            .agg(F.min("hub").alias("home"), F.first("w").alias("w")))
    load = home.groupBy("home").agg(F.ceil(F.greatest(F.count("*") / CHUNK, F.sum("w") / CHUNK_SHINGLES)).alias("pieces"))
    chunks = cut(home.join(load, "home").select(
        "k", F.xxhash64("home", F.pmod(F.xxhash64("k"), "pieces")).alias("chunk")))
    met = postings.select("s", "k").join(chunks, "k").groupBy("s").agg(F.sort_array(F.collect_set("chunk")).alias("c"))
    pairs = met.select(F.explode(F.expr(
        "flatten(transform(c, (x, i) -> transform(slice(c, i + 1, size(c)), y -> struct(x as a, y as b))))")).alias("u")).select("u.*")
    units = pairs.distinct().withColumn("unit", F.xxhash64("a", "b"))
    sides = units.select("unit", F.col("a").alias("chunk"), F.lit(0).alias("side")).union(
        units.filter("a <> b").select("unit", F.col("b").alias("chunk"), F.lit(1).alias("side")))
    rows = sides.join(chunks, "chunk").join(possible, "k")
    return (rows.select(F.pmod("unit", F.lit(4 * shuffle_partitions(sets.sparkSession))).alias("g"), "unit", "side", "k", "n",
                        "alone", "shingles")
            .groupBy("g").applyInArrow(releasing(lambda g: _verify(g, rule)), "k long, root long, links long"))


def _members(docs: DataFrame, rule: Rule) -> DataFrame:
    """doc_id, k (hash of the text), n, n_links and least (the least id of the
    component, null without a shingle) for every row."""
    keyed = docs.select("doc_id", F.xxhash64("text").alias("k"))
    sets = cut(shared_shingles(docs.filter("text IS NOT NULL").select("text", F.xxhash64("text").alias("k")), rule))
    links = cut(linked_texts(sets, rule))
    roots = components(links.select(F.col("k").alias("a"), F.col("root").alias("b")))
    degree = links.groupBy("k").agg(F.sum("links").alias("n_links"))
    texts = (sets.select("k", "n").join(roots.withColumnRenamed("node", "k"), "k", "left").join(degree, "k", "left")
             .select("k", "n", F.coalesce("root", "k").alias("root"), F.coalesce("n_links", F.lit(0)).alias("n_links")))
    members = keyed.join(texts, "k", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    least = members.filter("n > 0").groupBy("root").agg(F.min("doc_id").alias("least"))
    return members.join(least, "root", "left").select("doc_id", "k", "n", "n_links", F.when(F.col("n") > 0, F.col("least")).alias("least"))


def near_duplicates(docs: DataFrame, rule: Rule = NGRAM_JOIN) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links (different texts linked with
    the document's) for every row of ``docs``."""
    return _members(docs, rule).select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def one_of_each(docs: DataFrame, rule: Rule = NGRAM_JOIN) -> DataFrame:
    """Pipeline stage: of each component the row with the least id stays (one
    row of equal rows); rows without an id stay. Rows are told apart by id and
    text, so an id that stands for two texts loses only the linked one."""
    i, k = ("_" * max(map(len, docs.columns)) + c for c in ("id", "k"))  # longer than any name
    lost = _members(docs, rule).filter("least < doc_id").select(F.col("doc_id").alias(i), F.col("k").alias(k)).distinct()
    keyed = docs.select("*", F.col("doc_id").alias(i), F.xxhash64("text").alias(k))
    kept = keyed.join(lost, [i, k], "left_anti")
    named = kept.filter(F.col(i).isNotNull()).dropDuplicates([i, k])
    return named.unionByName(kept.filter(F.col(i).isNull())).drop(i, k).select([f"`{c}`" for c in docs.columns])
