"""Quality rules: base counts, then a hashed n-gram likelihood ratio.

Two multinomials of unigrams and bigrams of lower-cased words are counted over
the whole corpus, hashed to buckets: one of the trusted target (documents
labelled good), one of all documents. The number of buckets is the power of two
at or above 2^12 times the fourth root of the corpus's bytes, one rule for all
sizes (2^18 for 2 MB, 2^20 for 1 GB, 2^24 for 100 TB), so the model grows with
the corpus and stays small enough to be sent to every task. The score of a
document is the sum of log(target / raw) over its n-grams divided by their
number; every document at or above the threshold passes. The threshold is the
score that all but ``MISSED`` of the trusted documents reach when their own
n-grams are taken off the target counts (a document does not vouch for itself).

Only DataFrame functions are used. Each task sums its n-grams by bucket before
anything is shuffled, so a task sends a bucket once at most, and the counting
tasks take enough text for that to be a small share of it. Weights are whole
numbers (2^-``FRACTION`` nats), so that sums do not depend on their order, and
the threshold is an exact order statistic: the verdicts are the same however
the rows are dealt.

Defined results: null, empty or blank texts have no words, fail the base rule
and score 0; repeated rows are judged one by one; texts of any length are taken
whole; equal scores are on the same side of the threshold; without trusted
documents all scores are 0 and only the base rule decides; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANK_CLASS, cut, small

#: Bits of the weights' fraction.
FRACTION = 24
#: Buckets up to which the model is broadcast (about 1.2 GB); 4 PB of text.
BROADCAST_BUCKETS = 1 << 24
#: Bytes of text for each bucket that a counting task may send (about 10 bytes).
TASK_BYTES = 64
SYMBOLS = "[#*$%&|<>]"
WINDOW = 5
SMOOTHING = 1.0
#: Share of the trusted documents that may lie below the threshold.
MISSED = 0.01


def split_words(text: Column) -> Column:
    """Words of a text as an array; null or blank text: empty array. The text
    is not trimmed first, which would read it twice more."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANK_CLASS), "")


def windows(w: str, k: int) -> Column:
    """Hash of each run of ``k`` words of the array column ``w``."""
    items = ", ".join(["x", *(f"{w}[i + {j}]" for j in range(1, k))])
    return F.expr(f"transform(slice({w}, 1, greatest(size({w}) - {k - 1}, 0)), (x, i) -> xxhash64({items}))")


def bucket(items: str, size: int) -> str:
    """Bucket of the hash of ``items``; ``size`` is a power of two. Never null,
    so that arrays of buckets are sorted as plain numbers."""
    return f"(xxhash64({items}) & {size - 1}L)"


def base_counts(docs: DataFrame) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and
    base_failed (columns of ``docs`` with these names are replaced). ``w``,
    the words, stays for later steps."""
    t = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    first = docs.withColumn("w", split_words(F.col("text"))).withColumn("_lines", lines)
    hashed = first.withColumns({
        "n_words": F.size("w").cast("long"),
        "word_chars": F.length(F.array_join("w", "")).cast("long"),
        "n_symbols": F.regexp_count(t, F.lit(SYMBOLS)).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_x": F.expr("transform(w, x -> xxhash64(x))"),
    }).withColumn("_h", windows("_x", WINDOW))
    # windows found twice or more: neighbours in the sorted list of (hash, place)
    sorted_ = hashed.withColumn("_s", F.expr(
        "if(size(array_distinct(_h)) = size(_h), null, sort_array(transform(_h, (x, i) -> struct(x as h, i as p))))"))
    places = sorted_.withColumn("_p", F.expr(
        "sort_array(filter(transform(_s, (x, i) -> if(x.h = get(_s, i - 1).h or x.h = get(_s, i + 1).h, x.p, null)),"
        " p -> p is not null))"))
    covered = f"aggregate(_p, 0L, (n, p) -> n, n -> n) + {WINDOW} + aggregate(sequence(1, size(_p) - 1), 0L, " \
              f"(n, i) -> n + least({WINDOW}, _p[i] - _p[i - 1]))"
    repeated = F.expr(f"if(_p is null, 0L, {covered})").cast("long")
    return (places.withColumn("n_repeat_words", repeated).drop("_lines", "_x", "_h", "_s", "_p")
            .withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))))


def buckets_for(n_bytes: int) -> int:
    """Buckets for a corpus: the power of two from 2^12 * n_bytes^(1/4) on."""
    need, out = 4096 * max(n_bytes, 1) ** 0.25, 4096
    while out < need:
        out *= 2
    return out


def _tokens(docs: DataFrame, *keep: str) -> DataFrame:
    """The columns ``keep`` and _l, the words in lower case."""
    # lower-casing the text gives the words that lower-casing each would: blanks end a word's context
    return docs.select(*keep, split_words(F.lower("text")).alias("_l"))


def _grams(tokens: DataFrame, size: int, *keep: str) -> DataFrame:
    """The columns ``keep``, b, the bucket of one unigram or bigram a row, and
    n, 1; and b and n of the items of ``_r``, if there is such a column.

    Each word comes with the next one before it is hashed, so that hashing is
    compiled; a lambda over the array would be interpreted."""
    following = F.expr("slice(_l, 2, greatest(size(_l) - 1, 0))").alias("_n")
    more = [c for c in ("_r",) if c in tokens.columns]
    # explode_outer: explode would put size(_l) > 0, with all of _l in it, below the projections
    pairs = tokens.select(*keep, F.explode_outer(F.arrays_zip(F.col("_l").alias("_a"), following, *more)).alias("_p"))
    both = f"if(_a IS NULL, NULL, {bucket('_a', size)}), 1L, if(_n IS NULL, NULL, {bucket('_a, _n', size)}), 1L"
    return pairs.select(*keep, "_p.*").select(*keep, F.expr(
        f"stack({2 + len(more)}, {', '.join([both, *(f'{c}.b, {c}.n' for c in more)])}) AS (b, n)")).filter("b IS NOT NULL")


def _whole(weight: Column) -> Column:
    return F.rint(weight * F.lit(float(1 << FRACTION))).cast("long")  # round() would go through a decimal


def dealt(docs: DataFrame, n_bytes: int, size: int) -> DataFrame:
    """``docs`` in as many tasks as there are cores, or so many times as many
    that a task has ``TASK_BYTES`` bytes of text for each bucket that it may send."""
    cores = max(2, docs.sparkSession.sparkContext.defaultParallelism)
    return docs.coalesce(cores * max(1, -(-n_bytes // (cores * TASK_BYTES * size))))


def weights(docs: DataFrame, size: int) -> DataFrame:
    """b, target (count), rest (weight less the log of the target count) and
    weight, log(target / raw) as a whole number, of each bucket in use; none
    without a target. ``_t`` marks the documents of the target."""
    # the bucket's bytes stand right before the counts: a row of the shuffle is then one run of bytes and one of zeros
    shift = 64 - 8 * (((size - 1).bit_length() + 7) // 8)
    counts = cut(_grams(_tokens(docs, "_t"), size, "_t").groupBy(F.shiftleft("b", shift).alias("_b"))
                 .agg(F.count("*").alias("raw"), F.count("_t").alias("target"))
                 .select(F.shiftrightunsigned("_b", shift).alias("b"), "raw", "target"))
    raw, target = counts.agg(F.sum("raw"), F.sum("target")).first()
    if not target:
        counts = counts.limit(0)
    rest = F.log(F.lit((raw or 0) + SMOOTHING * size)) - F.log(F.lit((target or 0) + SMOOTHING * size)) - F.log(F.col("raw") + SMOOTHING)
    return (counts.withColumn("rest", rest).withColumn("weight", _whole(F.log(F.col("target") + SMOOTHING) + F.col("rest")))
            .select("b", "target", "rest", "weight"))


def _mean(total: Column, n: Column) -> Column:
    return F.coalesce(total / n / float(1 << FRACTION), F.lit(0.0))


def _repeats(tokens: DataFrame, size: int) -> DataFrame:
    """Adds _r, the buckets b that a row has n times, n from 2 on, to the rows
    with _own (none to others), in the row: the sorted buckets without the last
    of each are taken run by run."""
    buckets = (f"concat(transform(_l, x -> {bucket('x', size)}), "
               f"transform(slice(_l, 1, size(_l) - 1), (x, i) -> {bucket('x, _l[i + 1]', size)}))")
    out = tokens.withColumn("_s", F.expr(f"if(_own, sort_array({buckets}), cast(array() as array<bigint>))"))
    out = out.withColumn("_d", F.expr("filter(_s, (x, i) -> x = get(_s, i + 1))"))
    out = out.withColumn("_f", F.expr("if(size(_d) = 0, cast(array() as array<int>), "
                                      "filter(sequence(0, size(_d) - 1), i -> i = 0 or _d[i] <> _d[i - 1]))"))
    return out.withColumn("_r", F.expr("transform(_f, (p, j) -> struct(_d[p] as b, "
                                       "cast(coalesce(get(_f, j + 1), size(_d)) - p + 1 as bigint) as n))")).drop("_s", "_d", "_f")


def _scored(docs: DataFrame, table: DataFrame, size: int) -> DataFrame:
    """_k (hash of id and text), score and, of the target's documents of ten
    words and more, left_out, the score as if the document were none of the
    target, of every distinct row with a word; one pass. ``_t`` marks the target.

    Only left_out needs to know how often a document has a bucket. Each gram
    counts there as its bucket's only one; what the buckets found again differ
    from that by comes in rows of their own."""
    tokens = _tokens(docs, "_k", "_t").withColumn("_own", F.col("_t").isNotNull() & (F.size("_l") >= 10))
    met = _grams(_repeats(tokens, size), size, "_k", "_own").join(small(table, BROADCAST_BUCKETS), "b", "left")
    n, own, single = F.col("n"), F.col("_own"), F.col("n") == 1

    def without(k: Column) -> Column:
        return k * _whole(F.log(F.greatest(F.col("target") - k, F.lit(0)) + SMOOTHING) + F.col("rest"))

    one = without(F.lit(1))
    return (met.groupBy("_k").agg(
        _mean(F.sum(F.when(single, F.col("weight"))), F.sum(F.when(single & F.col("weight").isNotNull(), n))).alias("score"),
        (F.sum(F.when(own, F.when(single, one).otherwise(without(n) - n * one)))
         / F.sum(F.when(own & single & F.col("target").isNotNull(), n)) / float(1 << FRACTION)).alias("left_out")))


def order_statistic(scores: DataFrame, part: float) -> float | None:
    """The score that ``part`` of the rows lie below, exactly: the row at place
    floor(part * n) of the sorted scores. An approximate percentile on either
    side leaves a few of 10,000 rows to be sorted."""
    n = scores.count()
    if not n:
        return None
    place = int(part * n)
    low, high = scores.agg(F.percentile_approx("score", F.array(*[F.lit(min(max(part + d, 0.0), 1.0)) for d in (-5e-4, 5e-4)]),
                                               F.lit(10_000))).first()[0]
    while True:
        below, inside = scores.agg(F.count_if(F.col("score") < low), F.count_if(F.col("score").between(low, high))).first()
        if below <= place < below + inside:
            break
        low, high = scores.agg(F.min("score"), F.max("score")).first()  # the percentile missed: sort them all
    near = scores.filter(F.col("score").between(low, high)).orderBy("score").limit(place - below + 1)
    return near.agg(F.max("score")).first()[0]


def judge_quality(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """doc_id, the base counts, base_failed, score and kept for every row of
    ``docs`` (doc_id, text). ``trusted``: doc_id of the trusted documents."""
    docs = docs.select("doc_id", "text").withColumn("_k", F.xxhash64("doc_id", "text"))
    n_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    size = buckets_for(n_bytes)
    ids = small(trusted.select("doc_id").filter("doc_id IS NOT NULL").distinct().withColumn("_t", F.lit(1)))
    docs = docs.join(ids, "doc_id", "left")
    model = weights(dealt(docs, n_bytes, size), size)  # a projection of counts that are written already
    scores = cut(_scored(docs, model, size))
    least = order_statistic(scores.filter("left_out IS NOT NULL").select(F.col("left_out").alias("score")), MISSED) or 0.0
    out = base_counts(docs).drop("w", "text", "_t").join(small(scores.select("_k", "score")), "_k", "left").drop("_k")
    out = out.withColumn("score", F.coalesce("score", F.lit(0.0)))  # no word: no row of scores
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= F.lit(least)))
