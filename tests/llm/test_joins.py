import numpy as np
from helpers import WORD, frame, near_corpus
from pyspark.sql import functions as F

from stockline.llm.graph import components
from stockline.llm.op02_ngram_join import near_duplicates, one_of_each
from stockline.llm.op08_substrings import remove_repeats, without_repeats


def ascii_lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def join_rows(rows):
    sets = []
    for _, t in rows:
        w = WORD.findall(ascii_lower(t or ""))
        sets.append({tuple(w[k:k + 3]) for k in range(len(w) - 2)} if len(w) > 2 else ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = [set() for _ in rows]
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
                if rows[a][1] != rows[b][1]:
                    links[a].add(rows[b][1])
                    links[b].add(rows[a][1])
    least = {}
    for a, (i, _) in enumerate(rows):
        if i is not None:
            least[find(a)] = min(least.get(find(a), i), i)
    return [(i, len(sets[a]), least.get(find(a)) if sets[a] else i, len(links[a])) for a, (i, _) in enumerate(rows)]


def join_components(rows):
    return [c for _, _, c, _ in join_rows(rows)]


def join_brute_force(rows):
    return sorted(join_rows(rows), key=str)


def test_join_against_brute_force(spark):
    rows = near_corpus()
    got = near_duplicates(frame(spark, rows)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in got), key=str) == join_brute_force(rows)


def test_join_group_larger_than_a_chunk(spark, monkeypatch):
    from stockline.llm import op02_ngram_join as op2
    monkeypatch.setattr(op2, "CHUNK", 4)
    w = [f"v{i}" for i in range(300)]
    rows = [(i, " ".join(w[:i] + [f"x{i}"] + w[i + 1:])) for i in range(30)] + [(99, " ".join(w))]
    got = near_duplicates(frame(spark, rows)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in got), key=str) == join_brute_force(rows)
    assert {r.component_id for r in got} == {0}


def test_join_stage_keeps_one_row_of_each_group(spark):
    rows = near_corpus(n=60)
    docs = frame(spark, rows).withColumn("k", F.lit(1)).withColumn("n", F.lit("x"))
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    component = dict(zip(rows, join_components(rows)))
    expected = {row for row, c in component.items() if row[0] is None or c == row[0]}
    got = [(r.doc_id, r.text) for r in kept.collect()]
    assert set(got) == expected and len(got) == len(set(got))


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(empty).count() == 0
    assert remove_repeats(empty).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 100), (7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}


def repeats_brute_force(rows):
    first, out = {}, []
    for i, t in rows:
        w = WORD.findall(t or "") if i is not None else []
        for k in range(len(w) - 49):
            c = tuple(w[k:k + 50])
            first[c] = min(first.get(c, i), i)
    for i, t in rows:
        w, gone = WORD.findall(t or ""), set()
        for k in range(len(w) - 49 if i is not None else 0):
            if first[tuple(w[k:k + 50])] < i:
                gone.update(range(k, k + 50))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=str)


def test_repeats_against_brute_force(spark):
    rows = near_corpus(seed=5)
    docs = frame(spark, rows).withColumn("h", F.lit(1)).withColumn("part", F.lit("x"))
    got = remove_repeats(docs)
    assert got.columns == ["doc_id", "text", "h", "part", "n_words", "n_removed", "kept"]
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got.collect()), key=str) == repeats_brute_force(rows)


def test_repeats_at_every_alignment(spark):
    w = [f"p{i}" for i in range(51)]
    rows = [(i, " ".join([f"a{i}_{j}" for j in range(i)] + w + [f"z{i}"])) for i in range(30)]
    got = {r.doc_id: r.n_removed for r in remove_repeats(frame(spark, rows)).collect()}
    assert got == {i: 51 if i else 0 for i in range(30)}


def test_repeats_stage(spark):
    w = " ".join(f"p{i}" for i in range(60))
    docs = spark.createDataFrame([(1, w, 5), (2, w, 5), (3, f"a {w}  b", 5), (4, None, 0), (5, "c  d", 4)],
                                 "doc_id long, text string, n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in without_repeats(docs).collect()}
    assert got == {1: (w, 5), 3: ("a b", 3), 4: (None, 0), 5: ("c  d", 4)}


def test_union_of_stars():
    from stockline.llm.op02_ngram_join import _stars
    rnd = np.random.default_rng(1)
    a, b = rnd.integers(0, 300, 200), rnd.integers(0, 300, 200)
    nodes, root = _stars(a, b)
    of = dict(zip(nodes.tolist(), root.tolist()))
    assert all(of[x] == of[y] for x, y in zip(a.tolist(), b.tolist())) and all(of[r] == r <= n for n, r in of.items())
