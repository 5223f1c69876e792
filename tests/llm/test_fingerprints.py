import hashlib
import random

import numpy as np
from helpers import frame
from pyspark.sql import functions as F

from stockline.llm import op11_fingerprints as op11

COLUMNS = "doc_id long, text string"


def corpus(seed=4, n=60):
    rnd = random.Random(seed)
    lines = [" ".join(rnd.choices(["ab", "Ωcd", "日本語", "ef gh", "x"], k=rnd.randint(0, 30))) for _ in range(40)]
    return [(i * 7 % 211, "\n".join(rnd.choices(lines, k=rnd.randint(1, 8)))) for i in range(n)]


def slow_lanes(text):
    """The definition, paragraph by paragraph and run by run."""
    exact, alike = np.zeros(op11.EXACT, int), np.zeros(op11.ALIKE, int)
    for p in text.split("\n"):
        exact += np.frombuffer(hashlib.blake2b(p.encode()).digest(), "<u2")
        for k in range(len(p)):
            run = [ord(c) for c in p[k:k + op11.GRAM]]
            h = 0
            m, s, top = int(op11._MIX), op11._STEP, (1 << 64)
            # the powers of the step that doubling gives each place of the run
            for j, c in enumerate(run):
                h += (c + 1) * m * pow(s, sum(bit for bit in (1, 2, 4) if not j & bit), top)
            h %= top
            h = (h ^ (h >> 29)) * m % top
            h ^= h >> 32
            alike[(h >> 8) % op11.ALIKE] += 1 - 2 * (h & 1)
    return exact, alike


def test_vectors_follow_the_definition(monkeypatch):
    texts = ["", "\n", "a", "abc\n\nabcdefghijk", "日本語 " * 9, "x" * 300 + "\nxy", *[t for _, t in corpus(n=10)]]
    want = [np.hstack([e % 65536, a % 65536]) for e, a in map(slow_lanes, texts)]
    assert (op11.vectors(texts) == want).all()
    monkeypatch.setattr(op11, "CHARS_AT_ONCE", 11)  # pieces of long texts
    assert (op11.vectors(texts) == want).all()


def test_order_does_not_count_and_edits_add_up():
    a, b, c = "one line", "another\tline", ""
    v = op11.vectors(["\n".join(p) for p in ((a, b, c), (c, b, a), (a, b), (a, b, b))])
    assert (v[0] == v[1]).all() and (v[0] != v[2]).any() and (v[2] != v[3]).any()
    assert (v[2] + op11.paragraph_vectors([b])[0] == v[3]).all()
    assert (v[0] - op11.paragraph_vectors([c])[0] == v[2]).all()
    assert (op11.lanes_of(op11.written(v)) == v).all()


def test_likeness():
    rnd = random.Random(1)
    words = [f"word{i}" for i in range(3000)]
    whole = rnd.sample(words, 600)
    half, other = whole[:300] + rnd.sample(words, 300), rnd.sample(words, 600)
    v = op11.vectors([" ".join(t) for t in (whole, half, other, whole)] + ["", "a" * 200_000, "a" * 100_000])
    near = op11.likeness(v[[0, 0, 0, 0, 4, 5]], v[[3, 1, 2, 4, 4, 6]])
    assert near[0] == 1 and .4 < near[1] < .8 and near[2] < near[1] and near[3] == 0 and near[4] == 1
    assert 0 <= near[5] < 1


def neighbours(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    out = []
    for (i, t), (_, following) in zip(rows, rows[1:] + rows[:1]):
        half = len(t) // 2
        edited = t[:len(t) - half] + following[:half]
        v = op11.vectors([t, edited, following])
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), *op11.written(v[:2]),
                    *map(float, op11.likeness(v[[0, 0]], v[[1, 2]]))))
    return sorted(out, key=str)


def test_neighbours_against_brute_force(spark):
    rows = corpus() + [(500, None), (501, ""), (-3, "long " * 300_000), (502, "a"), (None, "no id")]
    rows.append((503, rows[0][1]))
    docs = frame(spark, rows, COLUMNS, 5).withColumn("range", F.lit(1)).withColumn("k", F.lit("x")).withColumn("h", F.lit(2))
    got = op11.edited_neighbours(docs)
    assert got.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    assert sorted(map(tuple, got.collect()), key=str) == neighbours(rows)


def test_neighbours_of_few_rows_and_string_ids(spark):
    assert op11.edited_neighbours(frame(spark, [], COLUMNS)).collect() == []
    [alone] = op11.edited_neighbours(frame(spark, [(4, "abcd")], COLUMNS)).collect()
    assert alone.edited_sha256 == hashlib.sha256(b"abab").hexdigest()
    texts = [(f"id{i}", f"text {i}") for i in range(40)]
    got = op11.edited_neighbours(frame(spark, texts, "doc_id string, text string")).collect()
    assert sorted(map(tuple, got), key=str) == neighbours_of_strings(texts)


def neighbours_of_strings(rows):
    rank = {i: k for k, i in enumerate(sorted(i for i, _ in rows))}
    name = {k: i for i, k in rank.items()}
    return sorted(((name[r[0]], *r[1:]) for r in neighbours([(rank[i], t) for i, t in rows])), key=str)


def test_equal_ids_stay_rows_of_their_own(spark):
    rows = [(1, "a\nb")] * 40 + [(1, "c")] * 5 + [(None, None)] * 30 + [(2, "d")]
    got = op11.edited_neighbours(frame(spark, rows, COLUMNS)).collect()
    assert sorted((r.doc_id, r.n_chars) for r in got if r.doc_id is not None) == sorted((i, len(t)) for i, t in rows if i is not None)
    assert sum(r.doc_id is None for r in got) == 30
    assert len({r.fingerprint for r in got}) == 4


def test_fingerprints_and_edits(spark):
    rows = corpus(n=20) + [(900, None), (901, "only")]
    prints = op11.fingerprints(frame(spark, rows, COLUMNS))
    want = dict(zip([i for i, _ in rows], op11.written(op11.vectors([t or "" for _, t in rows]))))
    assert {r.doc_id: r.fingerprint for r in prints.collect()} == want
    edits = [(901, "more", 1), (901, "only", -1), (900, "", -1), (900, "x", 3), (7, None, 1), (12345, "unknown", 1), (None, "x", 1)]
    edits += [(901, "many", 1)] * 500
    got = {r.doc_id: r.fingerprint for r in op11.with_edits(prints, frame(
        spark, edits, "doc_id long, paragraph string, change int")).collect()}
    want[901] = op11.written(op11.vectors(["\n".join(["more"] + ["many"] * 500)]))[0]
    want[900] = op11.written(op11.vectors(["x\nx\nx"]))[0]
    assert got == want
    other = prints.filter("doc_id = 901").first().fingerprint
    near = prints.select("doc_id", op11.likeness_of(F.col("fingerprint"), F.lit(other)).alias("near")).collect()
    assert {r.doc_id for r in near if r.near == 1} == {901}
