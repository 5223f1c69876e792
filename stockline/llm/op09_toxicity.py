"""Toxicity by maximum-scoring segments.

Tokens are lower-cased runs of letters. From labelled documents come token
counts of the toxic and of the clean class, hashed to ``WORDS`` word buckets
and ``STEMS`` buckets of the first four letters. The log-odds of a token have
hierarchical Dirichlet priors: the corpus rate is the prior of a stem, the
stem's posterior that of a word, so a rare or unseen word of a toxic stem
counts and a rare word of a common stem does not. A constant drift is taken
off, which makes the expected score of clean text negative.

A linear scan finds all maximal-scoring segments of a document (each positive
token is pushed and merged once). For clean text the best segment of n tokens
follows an extreme-value law, P(S > x) = 1 - exp(-K n exp(-lambda x)); lambda
solves sum p(s) exp(lambda s) = 1 over the token scores of clean training
documents and K is its maximum-likelihood value on their best segments. The
evidence of a document is the least Poisson probability of its best segments
under that law, and a logistic curve, fitted on binned evidence, turns it into
the score. All of this is fitted on one half of the training documents with
token counts of the other half; the final counts are those of both.

What reaches the driver is bounded by the buckets and bins, not by the corpus.

Defined results: null, empty and letterless texts have no segment and the
score of no evidence; null labels are left out and repeated labels of a
document count once (toxic if any is); with no labels, or one class only, the
score is the rate of the labels (0 without); extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import code_points, crc_mod, cut, letters, small, text_slices, texts_of

WORDS = 1 << 20
STEMS = 1 << 18
STEM_LETTERS = 4
#: Buckets whose counts travel to the driver as one dense row.
PACK = 1 << 13
WORD_PRIOR = 8.0
STEM_PRIOR = 20.0
DRIFT = 2.0
HIGHEST, LOWEST = 8.0, -3.0
BIN = 0.25
BINS = 400


@dataclass
class ToxicityModel:
    toxic: np.ndarray  # toxic count of each word bucket
    total: np.ndarray  # count of each word bucket
    stem_rate: np.ndarray  # posterior toxic rate of each stem bucket
    rate: float  # toxic share of all tokens
    lam: float = 1.0
    k: float = 1.0
    slope: float = 1.0
    offset: float = 0.0


def _tokens(texts: list[str]):
    """word bucket, stem bucket, text, start and end of every token."""
    cps, starts = code_points([t.lower() for t in texts])
    is_letter = letters()[cps]
    at = np.flatnonzero(is_letter)
    if not len(at):
        z = np.zeros(0, np.int64)
        return z, z, z, z, z
    new = is_letter.copy()
    new[1:] &= ~is_letter[:-1]
    first = np.flatnonzero(new[at])
    begin = at[first]
    length = np.diff(np.append(first, len(at)))
    place = np.arange(len(at)) - np.repeat(first, length)
    powers = np.cumprod(np.full(int(length.max()) + 1, 0x9E3779B97F4A7C15, np.uint64))
    terms = (cps[at].astype(np.uint64) + np.uint64(1)) * powers[place]
    word = np.add.reduceat(terms, first)
    terms[place >= STEM_LETTERS] = 0
    stem = np.add.reduceat(terms, first)

    def bucket(h, n):
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return ((h ^ (h >> np.uint64(29))) & np.uint64(n - 1)).astype(np.int64)

    text = np.searchsorted(starts, begin, side="right") - 1
    return bucket(word, WORDS), bucket(stem, STEMS), text, begin - starts[text], begin - starts[text] + length


def _count_batches(batches):
    """Counts of each half of the documents, by class; the buckets of the
    second half follow those of the first."""
    counts = np.zeros((2, 2, WORDS + STEMS), np.int64)
    for batch in text_slices(batches):
        word, stem, text, _, _ = _tokens(texts_of(batch))
        toxic, half = (batch.column(c).to_numpy(zero_copy_only=False)[text] == 1 for c in ("toxic", "half"))
        for h, y in product((0, 1), (0, 1)):
            mine = (half == bool(h)) & (toxic == bool(y))
            if mine.any():
                counts[h, y, :WORDS] += np.bincount(word[mine], minlength=WORDS)
                counts[h, y, WORDS:] += np.bincount(stem[mine], minlength=STEMS)
    clean, toxic = counts[:, 0].ravel(), counts[:, 1].ravel()
    at = np.flatnonzero((clean > 0) | (toxic > 0))
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(clean[at]), pa.array(toxic[at])],
                                     ["bucket", "clean", "toxic"])


def _pack_counts(group: pa.Table) -> pa.Table:
    """The counts of one block of buckets as two dense arrays."""
    at = group.column("bucket").to_numpy() % PACK
    cells = []
    for name in ("clean", "toxic"):
        dense = np.zeros(PACK, np.float32)
        dense[at] = group.column(name).to_numpy()
        cells.append(pa.array([dense.tobytes()], pa.binary()))
    return pa.table([group.column("block").slice(0, 1).combine_chunks(), *cells], names=["block", "clean", "toxic"])


def _token_scores(word, stem, m: ToxicityModel) -> np.ndarray:
    q = (m.toxic[word] + WORD_PRIOR * m.stem_rate[stem]) / (m.total[word] + WORD_PRIOR)
    weight = m.total[word] + WORD_PRIOR
    doubt = np.sqrt(1 / (weight * q * (1 - q)))  # standard deviation of the log-odds
    odds = np.log(q) - np.log1p(-q) - np.log(m.rate / (1 - m.rate))
    return np.clip(odds - doubt - DRIFT, LOWEST, HIGHEST)


def _maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring runs (first, end, score) in linear time."""
    total = np.concatenate([[0.0], np.cumsum(scores)])
    found: list[tuple[int, int, float, float]] = []  # first, end, sum before, sum after
    for t in np.flatnonzero(scores > 0).tolist():
        first, end, left, right = t, t + 1, total[t], total[t + 1]
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= left:
                j -= 1
            if j < 0 or found[j][3] >= right:
                break
            first, left = found[j][0], found[j][2]
            del found[j:]
        found.append((first, end, left, right))
    return [(a, b, float(r - l)) for a, b, l, r in found]


def _score_batches(batches, model: ToxicityModel, histogram: bool = False):
    """n tokens and segment scores of each row; with histogram instead the
    counts of token scores of clean rows."""
    tally = np.zeros(BINS, np.int64)
    for batch in text_slices(batches):
        word, stem, text, _, _ = _tokens(texts_of(batch))
        scores = _token_scores(word, stem, model)
        if histogram:
            clean = batch.column("toxic").to_numpy(zero_copy_only=False)[text] == 0
            tally += np.bincount(((scores[clean] - LOWEST) * (BINS - 1) / (HIGHEST - LOWEST)).astype(int), minlength=BINS)
            continue
        n = np.bincount(text, minlength=batch.num_rows)
        begin = np.concatenate([[0], np.cumsum(n)])
        positive = np.bincount(text[scores > 0], minlength=batch.num_rows)
        segments = [[s for _, _, s in _maximal_segments(scores[begin[i]:begin[i + 1]])] if positive[i] else []
                    for i in range(batch.num_rows)]
        yield pa.RecordBatch.from_arrays(
            [*batch.drop_columns(["text"]).columns, pa.array(n.astype(np.int64)), pa.array(segments, pa.list_(pa.float64()))],
            [*batch.drop_columns(["text"]).schema.names, "n", "segments"])
    if histogram:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BINS, dtype=np.int32)), pa.array(tally)], ["bin", "n"])


def _evidence(m: ToxicityModel) -> Column:
    """-ln of the Poisson probability of the best r segments (every r, the
    best of them): r segments of S or more are expected K n exp(-lambda S) times."""
    cost = f"ln(greatest(1D, {m.k!r}D * n))"  # at least one segment of no score is expected
    # f is ln(r!) as a running sum
    return F.expr(f"aggregate(sort_array(segments, false), named_struct('r', 0D, 'f', 0D, 'best', 0D), (a, s) -> named_struct("
                  f"'r', a.r + 1D, 'f', a.f + ln(a.r + 1D), 'best', "
                  f"greatest(a.best, (a.r + 1D) * ({m.lam!r}D * s - {cost}) + a.f + ln(a.r + 1D))), a -> a.best)")


def _solve_lambda(tally: np.ndarray) -> float:
    p = tally / max(tally.sum(), 1)
    s = LOWEST + (np.arange(BINS) + 0.5) * (HIGHEST - LOWEST) / (BINS - 1)
    low, high = 0.05, 3.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if (p * np.exp(mid * s)).sum() < 1 else (low, mid)
    return low


def _logistic(x: np.ndarray, ones: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve on binned counts (Newton steps,
    with one pseudo-count of each class at the centre against separation)."""
    middle, spread = np.average(x, weights=n), max(np.sqrt(np.cov(x, fweights=n.astype(int))) if n.sum() > 1 else 1, 1e-3)
    z, y, w = (x - middle) / spread, ones, n
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        g = np.array([((y - w * p) * z).sum() - 0.02 * a, (y - w * p).sum() - 0.02 * b])
        v = w * p * (1 - p)
        h = np.array([[(v * z * z).sum() + 0.02, (v * z).sum()], [(v * z).sum(), v.sum() + 0.02]])
        step = np.linalg.solve(h, g)
        a, b = a + float(np.clip(step[0], -2, 2)), b + float(np.clip(step[1], -2, 2))
    return a / spread, b - a * middle / spread


def _from_counts(counts: np.ndarray) -> ToxicityModel:
    total = counts.sum(0)
    rate = (counts[1, :WORDS].sum(dtype=float) + 0.5) / (total[:WORDS].sum(dtype=float) + 1.0)
    stem_rate = (counts[1, WORDS:] + STEM_PRIOR * rate) / (total[WORDS:] + STEM_PRIOR)
    return ToxicityModel(counts[1, :WORDS].copy(), total[:WORDS].copy(), stem_rate.astype(np.float32), float(rate))


def learn(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """Model from the documents that have a label (labels: doc_id, toxic)."""
    known = (labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter("doc_id IS NOT NULL AND toxic IS NOT NULL")
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    train = (docs.select("doc_id", "text").join(small(known), "doc_id")
             .select("text", "toxic", F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int").alias("half")))
    counts = (train.mapInArrow(_count_batches, "bucket int, clean long, toxic long").groupBy("bucket")
              .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
              .withColumn("block", (F.col("bucket") / PACK).cast("int")))
    both = np.zeros((2, 2 * (WORDS + STEMS)), np.float32)
    for r in counts.groupBy("block").applyInArrow(_pack_counts, "block int, clean binary, toxic binary").toLocalIterator():
        at = slice(r["block"] * PACK, (r["block"] + 1) * PACK)
        both[0, at], both[1, at] = np.frombuffer(r["clean"], np.float32), np.frombuffer(r["toxic"], np.float32)
    both = both.reshape(2, 2, WORDS + STEMS)
    first, model = _from_counts(both[:, 0]), _from_counts(both.sum(1))
    n = both[:, :, :WORDS].sum(dtype=float)
    if not 0 < both[1, :, :WORDS].sum(dtype=float) < n:
        model.slope, model.offset = 0.0, float(np.log(model.rate / (1 - model.rate))) if n else -30.0
        return model
    # scores are calibrated on documents that the counts have not seen: weights of one half, documents of the other
    unseen = train.filter("half = 1").select("text", "toxic")
    tally = np.zeros(BINS)
    hist = unseen.mapInArrow(lambda it: _score_batches(it, first, True), "bin int, n long").groupBy("bin").agg(F.sum("n").alias("n"))
    for r in hist.collect():
        tally[r["bin"]] = r["n"]
    model.lam = _solve_lambda(tally)
    scored = cut(unseen.mapInArrow(lambda it: _score_batches(it, first), "toxic int, n long, segments array<double>"))
    best = F.coalesce(F.array_max("segments"), F.lit(0.0))
    mean = scored.filter("toxic = 0").agg(F.avg(F.greatest("n", F.lit(1)) * F.exp(-F.lit(model.lam) * best))).first()[0]
    model.k = 1.0 / float(mean or 1.0)
    side = F.least(F.greatest(F.floor(_evidence(model) / BIN), F.lit(-BINS)), F.lit(BINS))
    bins = scored.groupBy(side.alias("x")).agg(F.count("*").alias("n"), F.sum("toxic").alias("ones")).toPandas()
    if len(bins):
        model.slope, model.offset = _logistic((bins["x"].to_numpy(float) + 0.5) * BIN, bins["ones"].to_numpy(float),
                                              bins["n"].to_numpy(float))
    return model


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, score (0 to 1) for every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = docs.select("doc_id", "text").mapInArrow(lambda it: _score_batches(it, model),
                                                     f"doc_id {kind}, n long, segments array<double>")
    bent = F.lit(model.slope) * _evidence(model) + F.lit(model.offset)
    return found.select("doc_id", (1 / (1 + F.exp(-F.least(F.greatest(bent, F.lit(-30.0)), F.lit(30.0))))).alias("score"))


def _passages_in(batches, m: ToxicityModel, significance: float):
    for batch in text_slices(batches):
        word, stem, text, start, end = _tokens(texts_of(batch))
        scores = _token_scores(word, stem, m)
        begin = np.searchsorted(text, np.arange(batch.num_rows + 1))
        rows = []
        for i in range(batch.num_rows):
            a, b = begin[i], begin[i + 1]
            for first, last, s in _maximal_segments(scores[a:b]):
                p = -np.expm1(-m.k * max(b - a, 1) * np.exp(-m.lam * s))
                if p <= significance:
                    rows.append((i, int(start[a + first]), int(end[a + last - 1]), s, float(p)))
        if rows:
            i, s, e, x, p = zip(*rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(i)), pa.array(s), pa.array(e), pa.array(x),
                                              pa.array(p)], ["doc_id", "start", "end", "score", "p_value"])


def toxic_passages(docs: DataFrame, model: ToxicityModel, significance: float = 0.01) -> DataFrame:
    """Every significant segment: doc_id, start, end (code points of the
    lower-cased text), score, p_value."""
    return docs.select("doc_id", "text").mapInArrow(lambda it: _passages_in(it, model, significance),
                                                    "doc_id long, start long, end long, score double, p_value double")


def held_out_scores(docs: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    """doc_id, held_out, score, predicted; learned on the other folds only."""
    out_fold = F.coalesce(crc_mod("doc_id", folds) == 0, F.lit(False))
    model = learn(docs, labels.filter(~out_fold))
    return score(docs, model).select("doc_id", out_fold.alias("held_out"), "score",
                                     (F.col("score") >= 0.5).cast("int").alias("predicted"))
