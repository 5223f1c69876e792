"""Benchmark decontamination by SimHash windows, with DataFrame functions only.

Texts are lower-cased and split into runs of letters and digits. A shingle is
a run of five words (a shorter item is one shingle of its own length). For a
benchmark item of L words the windows of a document are its runs of L words:

1. Lossless narrowing: two bags of m and v shingles with similarity 0.8 share
   0.8 (m + v) / 1.8 or more. Shingle hashes of all documents are joined to
   those of the benchmark; a slide over the sorted places found for one item
   size gives every start whose window holds that many of them, wherever they
   stand in the item. A text shorter than the item is one window.
2. Each such window and each item gets a 64-bit SimHash over its shingles,
   each counted as often as it occurs.
3. Multi-index search: the fingerprint is cut into ``BLOCKS`` blocks. Two
   fingerprints within ``RADIUS`` bits differ by at most RADIUS // BLOCKS bits
   in some block, so joining windows with every such variant of the items'
   blocks (and the window size) finds all pairs within the radius.
4. Pairs within the radius are verified exactly: weighted Jaccard of the
   shingles, the weight being the number of occurrences, of 0.8 or more.

A true similarity of 0.8 means a cosine of 0.89 at least and about 10
different bits expected; the radius of 23 is more than four standard
deviations above.

Scale: the shingles of all documents are exploded in a generated
loop and joined to the benchmark's without a shuffle while the benchmark has
at most ``BROADCAST_ROWS`` shingles; beyond that the join is shuffled. The
starts found (a few numbers each) are kept by a checkpoint; the texts of the
documents that have one are read again to cut out the windows. Identical items
are one item until the last join.

Defined results: null or wordless texts and items match nothing; equal items
are all reported; repeated document rows give one result row per (doc_id,
item_id); rows without an id are never reported and never removed; on ties
the first window is reported; extra columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, cut, small
from .op06_quality import windows

SHINGLE = 5
SIMILARITY = 0.8
BITS = 64
BLOCKS = 8
RADIUS = 23


def _with_words(df: DataFrame, *keep: str) -> DataFrame:
    """The columns ``keep`` and ``w``, the words of the text. Two projections,
    so that the cleaned text is computed once for both of its uses."""
    clean = F.trim(F.regexp_replace(F.lower(F.coalesce(F.col("text"), F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    return df.select(*keep, clean.alias("_t")).select(
        *keep, F.when(F.col("_t") == "", F.array().cast("array<string>")).otherwise(F.split("_t", " ")).alias("w"))


def simhash(shingles: str) -> Column:
    """64-bit SimHash of an array of 64-bit hashes."""
    return F.expr(f"aggregate(sequence(0, {BITS - 1}), 0L, (f, b) -> f | if(aggregate({shingles}, 0, (s, x) -> "
                  "s + if(shiftright(x, b) & 1L = 1L, 1, -1)) > 0, shiftleft(1L, b), 0L))")


def _block(fingerprint: str, j: str) -> str:
    width = BITS // BLOCKS
    return f"cast(shiftright({fingerprint}, {j} * {width}) & {2 ** width - 1}L as int)"


def _numbered(shingles: str) -> Column:
    """Each repeated hash made distinct by its number of occurrence, so that
    set operations count occurrences."""
    return F.expr(f"if(size(array_distinct({shingles})) = size({shingles}), {shingles}, transform({shingles}, (x, i) -> "
                  f"if(array_position({shingles}, x) = i + 1, x, "
                  f"xxhash64(x, size(filter(slice({shingles}, 1, i + 1), y -> y = x))))))")


def _items(benchmark: DataFrame) -> DataFrame:
    """Distinct items: text_id, n (words), k (shingle size), s (shingles), f."""
    w = (_with_words(benchmark).filter("size(w) > 0").distinct()
         .withColumn("n", F.size("w")).withColumn("k", F.least(F.lit(SHINGLE), "n")))
    s = F.coalesce(*[F.when(F.col("k") == k, windows("w", k)) for k in range(1, SHINGLE + 1)])
    return (w.withColumn("s", s).withColumn("text_id", F.xxhash64("w")).withColumn("f", simhash("s"))
            .select("text_id", "n", "k", "s", "f"))


def _starts(hits: DataFrame, similarity: float) -> DataFrame:
    """doc_id, len, k, n, v (shingles of a window) and starts: every start whose
    window holds as many of the places p as the similarity needs."""
    places = (hits.groupBy("doc_id", "len", "k", "n").agg(F.sort_array(F.collect_set("p")).alias("ps"))
              .withColumn("v", F.expr("least(n - k + 1, len)"))
              .withColumn("need", F.ceil(similarity * (F.expr("n - k + 1") + F.col("v")) / (1 + similarity) - 1e-9).cast("int"))
              .filter("size(ps) >= need"))
    # starts whose first place is ps[i]: after ps[i - 1], and not so early that ps[i + need - 1] lies beyond the window
    runs = ("filter(transform(sequence(0, size(ps) - need), i -> struct("
            "greatest(0, if(i = 0, 0, ps[i - 1] + 1), ps[i + need - 1] - v + 1) as a, least(ps[i], len - v) as b)), x -> x.a <= x.b)")
    return (places.withColumn("starts", F.expr(f"flatten(transform({runs}, x -> sequence(x.a, x.b)))"))
            .filter("size(starts) > 0").select("doc_id", "len", "k", "n", "v", "starts"))


def contaminated(docs: DataFrame, benchmark: DataFrame, radius: int = RADIUS,
                 similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, item_id, start_word, n_words, hamming, similarity: for each
    document and each benchmark item it contains, the best window."""
    items = cut(_items(benchmark))  # used five times below
    sizes = [r["k"] for r in items.select("k").distinct().collect()]  # at most SHINGLE values
    anchors = cut(items.select("n", "k", F.explode("s").alias("shingle")).distinct())
    named = _with_words(docs.filter("doc_id IS NOT NULL"), "doc_id")
    hits = None
    for k in sizes or [SHINGLE]:
        # the exploded rows carry no array, and explode_outer keeps its input from being computed again in a filter
        places = (named.select("doc_id", windows("w", k).alias("h"))
                  .select("doc_id", F.size("h").alias("len"), F.posexplode_outer("h").alias("p", "shingle"))
                  .join(small(anchors.filter(F.col("k") == k)), "shingle")
                  .select("doc_id", "len", "n", "k", "p"))
        hits = places if hits is None else hits.unionByName(places)
    starts = cut(_starts(hits, similarity))
    wanted = starts.groupBy("doc_id", "len", "k").agg(F.collect_list(F.struct("n", "v", "starts")).alias("hits"))
    found = named.join(small(starts.select("doc_id").distinct()), "doc_id", "left_semi")
    wins = None
    for k in sizes or [SHINGLE]:
        hashed = (found.select("doc_id", windows("w", k).alias("h")).withColumn("len", F.size("h"))
                  .join(wanted.filter(F.col("k") == k), ["doc_id", "len"]))
        some = (hashed.select("doc_id", "h", F.explode_outer("hits").alias("x"))
                .select("doc_id", "h", "x.n", "x.v", F.explode_outer("x.starts").alias("start"))
                .select("doc_id", "n", "start", F.expr("slice(h, start + 1, v)").alias("ws")))
        wins = some if wins is None else wins.unionByName(some)
    wins = cut(wins.distinct().withColumn("wf", simhash("ws")))

    allowed = radius // BLOCKS
    width = BITS // BLOCKS
    masks = sorted(sum(1 << b for b in bits) for m in range(allowed + 1) for bits in combinations(range(width), m))
    index = (items.select("text_id", "n", "f", F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1))).alias("j"))
             .select("text_id", "n", "f", "j", F.explode(F.array(*[F.lit(m) for m in masks])).alias("mask"))
             .select("text_id", "n", "f", "j", F.expr(f"{_block('f', 'j')} ^ mask").alias("v")))
    probes = (wins.withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1))))
              .withColumn("v", F.expr(_block("wf", "j"))))
    pairs = (probes.join(small(index, BROADCAST_ROWS), ["n", "j", "v"])
             .withColumn("hamming", F.bit_count(F.expr("f ^ wf")))
             .filter(F.col("hamming") <= radius)
             .select("doc_id", "text_id", "start", "n", "hamming", "ws").distinct())
    sets = pairs.join(small(items.select("text_id", "s")), "text_id").select(
        "doc_id", "text_id", "start", "n", "hamming", _numbered("ws").alias("a"), _numbered("s").alias("b"))
    both = F.size(F.array_intersect("a", "b"))
    alike = both / (F.size("a") + F.size("b") - both)
    best = (sets.withColumn("similarity", alike).filter(F.col("similarity") >= similarity)
            .groupBy("doc_id", "text_id")
            .agg(F.max(F.struct("similarity", (-F.col("start")).alias("back"), "n", "hamming")).alias("b")))
    names = (_with_words(benchmark, "item_id").filter("size(w) > 0")
             .select("item_id", F.xxhash64("w").alias("text_id")).distinct())
    return (best.join(small(names), "text_id")
            .select("doc_id", "item_id", (-F.col("b.back")).alias("start_word"), F.col("b.n").alias("n_words"),
                    F.col("b.hamming").alias("hamming"), F.col("b.similarity").alias("similarity")))


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Pipeline stage: the documents that contain no benchmark item."""
    return docs.join(contaminated(docs, benchmark).select("doc_id").distinct(), "doc_id", "left_anti").select(docs.columns)
