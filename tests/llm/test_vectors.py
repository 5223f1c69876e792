import math
import random

import numpy as np
import pytest
from helpers import frame
from pyspark.sql import functions as F

from stockline.llm import op12_negatives as op12
from stockline.llm import op13_whitening as op13

COLUMNS = "vec_id long, embedding array<double>, label int"


def vectors(seed, n, width, spread=0.2):
    rnd = random.Random(seed)
    centres = [[rnd.gauss(0, spread) for _ in range(width)] for _ in range(4)]
    out = []
    for i in range(n):
        label = rnd.randrange(4)
        out.append((i, [c + rnd.gauss(0, spread) for c in centres[label]], label))
    return out


def odd_rows(width):
    """Rows that take no part, repeated vectors, a shorter one."""
    same = [0.3] * width
    return [(1001, None, 1), (1002, [0.1] * (width - 1) + [None], 1), (1003, [0.1] * (width - 1) + [math.nan], 2),
            (1004, [math.inf] + [0.0] * (width - 1), 1), (1007, [0.5], 3), (1008, [], 1),
            *[(1100 + i, same, i % 3) for i in range(60)]]


# ---- hard negatives --------------------------------------------------------

def mined(rows, anchor, positives=5, negatives=3, low=50, high=95):
    """The definition, pair by pair, on whole vectors of integers."""
    taken = {}
    for i, v, label in rows:
        if i is not None and v is not None and label is not None and all(c is not None and math.isfinite(c) for c in v):
            x = [math.floor(256 * c) for c in v]
            taken[i] = min(taken.get(i, (label, x)), (label, x))
    out = []
    for a in filter(anchor, taken):
        score = {i: sum(p * q for p, q in zip(taken[a][1], x)) for i, (_, x) in taken.items() if i != a}
        ranked = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in ranked if taken[i][0] == taken[a][0]][:positives]:
            fit = [i for i in ranked if taken[i][0] != taken[a][0] and low * score[p] <= 100 * score[i] <= high * score[p]]
            out += [(a, p, r, i, score[p], score[i]) for r, i in enumerate(fit[:negatives], 1)]
    return sorted(out)


def negatives(spark, rows, **more):
    df = op12.hard_negatives(op12.scaled(frame(spark, rows, COLUMNS)), F.col("vec_id") % 5 == 0, **more)
    assert df.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("seed,width,spread", [(1, 20, 0.2), (2, 3, 1.5), (3, 64, 0.05)])
def test_negatives_against_brute_force(spark, monkeypatch, seed, width, spread):
    monkeypatch.setattr(op12, "BLOCK", 40)
    monkeypatch.setattr(op12, "STREAM", 60)
    monkeypatch.setattr(op12, "SLICE", 16)
    rows = vectors(seed, 220, width, spread) + odd_rows(width) + [(None, [0.1] * width, 1), (1010, [0.1] * width, None)]
    rows += rows[:3] + [(5, rows[9][1], 0)]  # repeated rows, and an id with two vectors
    want = mined(rows, lambda i: i % 5 == 0)
    assert want
    assert negatives(spark, rows) == want


def test_negatives_other_windows(spark):
    rows = vectors(4, 90, 8)
    for p, n, low, high in ((1, 1, 0, 100), (3, 200, -100, 300)):
        assert negatives(spark, rows, positives=p, negatives=n, low=low, high=high) == mined(rows, lambda i: i % 5 == 0, p, n, low, high)


def test_negatives_without_rows(spark):
    assert negatives(spark, []) == []
    assert negatives(spark, [(1, [0.5], 1), (2, [0.5], 2)]) == []  # no anchor
    assert negatives(spark, [(5, [0.5], 1), (2, [0.4], 2)]) == []  # no positive
    huge = [(5, [1e30], 1), (10, [0.5], 1), (1, [0.5], 1), (2, [0.4], 2)]
    assert negatives(spark, huge) == mined(huge[1:], lambda i: i % 5 == 0)


def test_pairs_at_least_is_exact():
    rnd = np.random.default_rng(7)
    for spread in (3, 40, 1 << 20):
        a, y = (rnd.integers(-spread, spread, (n, 24)) for n in (30, 50))
        y[:10, 8:] = 0  # short vectors, whose index is cut early
        score = a @ y.T
        for least in (np.quantile(score, .99, axis=1).astype(np.int64), np.full(30, op12.NEVER), np.zeros(30, np.int64)):
            i, j, s = op12.pairs_at_least(op12.prepared(a), op12.prepared(y), least)
            assert sorted(zip(i, j)) == sorted(zip(*np.nonzero(score >= least[:, None]))) and (s == score[i, j]).all()


# ---- whitening -------------------------------------------------------------

def scatter(x):
    c = x - x.mean(0)
    return c.T @ c


@pytest.mark.parametrize("case", ["spread", "equal columns", "copies", "few", "tiny"])
def test_rank_one_updates_give_the_spectrum(case):
    rnd = np.random.default_rng(5)
    x = (rnd.normal(size=(200, 24)) * 30).astype(np.int64) + 1_000_000
    if case == "equal columns":
        x[:, 3], x[:, 9] = x[:, 4], 7
    elif case == "copies":
        x = np.vstack([np.repeat(x[:3], 70, axis=0), x[:30]])
    elif case == "few":
        x = x[:5]
    elif case == "tiny":
        x[:, :8] = rnd.integers(0, 2, (200, 8))
        x[:, 8:] *= 1000
    whole, parts = op13.Spectrum.empty(24), []
    for s in range(0, len(x), 37):
        part = op13.Spectrum.empty(24)
        for row, times in zip(*np.unique(x[s:s + 37], axis=0, return_counts=True)):
            part.add(row, int(times))
        parts.append(op13.Spectrum.of(part.row(0)))
    for part in parts:
        whole.merge(part)
    want = scatter(x)
    assert whole.n == len(x) and (whole.sums == x.sum(0)).all()
    size = np.linalg.norm(want)
    assert np.abs(whole.q.T @ whole.q - np.eye(24)).max() < 1e-12
    assert np.abs(whole.q * whole.d @ whole.q.T - want).max() < 1e-12 * size
    assert np.abs(np.sort(whole.d) - np.linalg.eigvalsh(want)).max() < 1e-12 * size


def test_secular_roots():
    d, w = np.array([-1.0, 0.0, 1e-9, 5.0]), np.array([0.3, 1e-12, 2.0, 4.0])
    apart, roots = op13.secular_roots(d, w)
    assert np.abs(np.sort(np.linalg.eigvalsh(np.diag(d) + np.sqrt(np.outer(w, w)))) - roots).max() < 1e-14
    assert (np.sign(apart) == np.where(np.arange(4)[:, None] <= np.arange(4), -1, 1)).all()


def expected(rows, width):
    taken = [(i, v) for i, v, *_ in rows if v is not None and all(c is not None and math.isfinite(c) and abs(c) < 1e6 for c in v)]
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] + [1_000_000] * (width - len(v)) for _, v in taken])
    return taken, x


def check_whitening(rows, got, width, components):
    taken, x = expected(rows, width)
    n, values, vectors = len(x), *np.linalg.eigh(scatter(x) / len(x))
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    trace = np.trace(scatter(x) / n)
    white = (x - x.mean(0)) @ vectors / np.sqrt(values)
    assert len(got) == n * components
    table = sorted((r.component, str(r.vec_id), r.deviation, r.whitened) for r in got)
    mine = np.array([r[3] for r in table]).reshape(components, n).T
    order = sorted(range(n), key=lambda k: (str(taken[k][0]), int(((n * x[k] - x.sum(0)) ** 2).sum())))
    assert [r[2] for r in table[:n]] == [int(((n * x[k] - x.sum(0)) ** 2).sum()) for k in order]
    signs = np.sign((mine * white[order]).sum(0))
    assert np.abs(mine * signs - white[order]).max() < 1e-8
    assert {r.n for r in got} == {n} and {r.component for r in got} == set(range(1, components + 1))
    assert all(abs(r.explained - values[r.component - 1] / trace) < 1e-10 for r in got)
    assert len({r.identity_error for r in got}) == 1 and 0 <= got[0].identity_error < 1e-10


def test_whitening_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(op13, "FAN_IN", 2)
    monkeypatch.setattr(op13, "AT_ONCE", 50)
    rows = vectors(8, 400, 12) + odd_rows(12) + [(None, [0.2] * 12, 1), (5, [0.7] * 12, None), (2000, [1e30] * 12, 1)]
    rows += rows[:4]
    df = frame(spark, rows, COLUMNS, 7).withColumn("n", F.lit("x")).withColumn("x", F.lit(1)).withColumn("part", F.lit(1))
    check_whitening(rows, op13.whiten(op13.usable(df), 5).collect(), 12, 5)


def test_whitening_without_spread(spark):
    def rows_of(rows, columns=COLUMNS):
        return op13.whiten(op13.usable(frame(spark, rows, columns, 2))).collect()

    assert rows_of([]) == [] and rows_of([(1, None, 1)]) == [] and rows_of([(1, [], 1)]) == []
    assert rows_of([(1, [0.5, 0.25], 1)]) == [] and rows_of([(i, [0.5, 0.25], 1) for i in range(9)]) == []
    # a constant and a dependent dimension: one component is left
    line = [(str(i), [0.5, i / 4, i / 2], 1) for i in range(9)]
    got = rows_of(line, "vec_id string, embedding array<float>, label int")
    assert {r.component for r in got} == {1} and len(got) == 9
    assert all(abs(r.explained - 1) < 1e-12 for r in got) and got[0].identity_error < 1e-12


def test_deviation_beyond_a_long():
    got = op13.deviations(np.array([[1 << 40, 1], [3, 4]]))
    assert got.to_pylist() == [None, 25]


def test_whitening_does_not_depend_on_partitions(spark):
    rows = vectors(9, 300, 6)
    one, many = ({(r.vec_id, r.component): r.whitened for r in op13.whiten(op13.usable(frame(spark, rows, COLUMNS, p)), 4).collect()}
                 for p in (1, 16))
    assert one.keys() == many.keys() and max(abs(one[k] - many[k]) for k in one) < 1e-9
