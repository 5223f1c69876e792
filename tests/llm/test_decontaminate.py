import random
import re
from collections import Counter

from helpers import frame
from pyspark.sql import functions as F

from stockline.llm import op01_decontaminate as op1


def shingles(w, k):
    return Counter(tuple(w[i:i + k]) for i in range(len(w) - k + 1))


def brute_force(docs, items):
    """Best weighted Jaccard of each document and item over all item-sized windows."""
    out = {}
    for d, t in docs:
        w = re.findall(r"[^\W_]+", (t or "").lower())
        for i, b in items:
            x = re.findall(r"[^\W_]+", (b or "").lower())
            if not x or d is None:
                continue
            k = min(5, len(x))
            want = shingles(x, k)
            for s in range(max(1, len(w) - len(x) + 1)):
                have = shingles(w[s:s + len(x)], k)
                both, any_ = sum((want & have).values()), sum((want | have).values())
                if any_ and both / any_ >= 0.8:
                    out[d, i] = max(out.get((d, i), 0), round(both / any_, 9))
    return out


def corpus():
    rnd = random.Random(11)
    vocabulary = [f"w{i}" for i in range(500)]
    items = [(i, " ".join(rnd.choices(vocabulary, k=rnd.choice([20, 33, 34, 60])))) for i in range(12)]
    items += [(50, None), (51, ""), (52, "only three words"), (53, items[0][1]), (54, "ha ha ha ha ha ha ha ha")]
    docs = []
    for d in range(40):
        w = rnd.choices(vocabulary, k=rnd.randint(0, 90))
        if d % 2:
            x = rnd.choice(items[:12])[1].split()
            for _ in range(d % 3):  # near copies: a word changed, put in or left out at the edge
                x[rnd.choice([0, 1, len(x) - 1])] = "changed"
            w[len(w) // 2:len(w) // 2] = x
        docs.append((d, " ".join(w) if d % 4 else ", ".join(w).upper()))
    docs += [(100, None), (101, ""), (102, items[3][1]), (102, items[3][1]), (None, items[3][1]), (103, "Only three -- words"),
             (104, "ha " * 30), (105, " ".join(items[5][1].split()[:-2])), (106, items[7][1] + " tail" * 30_000)]
    return docs, items


def test_against_brute_force(spark):
    docs, items = corpus()
    got = op1.contaminated(frame(spark, docs).selectExpr("*", "1 as n", "2 as item_id"),
                           frame(spark, items, "item_id long, text string").selectExpr("*", "'x' as doc_id")).collect()
    found = {(r.doc_id, r.item_id): round(r.similarity, 9) for r in got}
    assert len(found) == len(got) and found == brute_force(docs, items)


def test_moved_sentences(spark):
    """Items whose sentences change places lie on no diagonal of one shingle."""
    rnd = random.Random(21)
    items = [(i, [f"i{i}x{j}" for j in range(60)]) for i in range(6)]
    noise = [f"n{i}" for i in range(300)]
    docs = []
    for i, x in items:
        for d, (a, b, c) in enumerate([(x[30:], x[:30], []), (x[40:], x[:40], []), (x[:30], ["one"], x[30:]), (x[35:], x[:35], x[:20])]):
            docs.append((10 * i + d, " ".join(rnd.choices(noise, k=90) + a + b + c + rnd.choices(noise, k=40 * (d % 2)))))
    docs += [(900, " ".join(items[0][1][30:] + items[0][1][:30])), (901, " ".join(items[1][1][:55])), (902, " ".join(items[2][1][:20]))]
    items = [(i, " ".join(x)) for i, x in items]
    want = brute_force(docs, items)
    got = op1.contaminated(frame(spark, docs), frame(spark, items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id): round(r.similarity, 9) for r in got} == want and (0, 0) in want and (900, 0) in want


def test_stage_and_empty_tables(spark):
    docs, items = corpus()
    frame_ = frame(spark, docs).withColumn("similarity", F.lit("x"))
    bench = frame(spark, items, "item_id long, text string")
    hit = {d for d, _ in brute_force(docs, items)}
    kept = op1.decontaminated(frame_, bench)
    assert kept.columns == frame_.columns
    assert sorted([r.doc_id for r in kept.collect()], key=str) == sorted([d for d, _ in docs if d not in hit], key=str)
    assert op1.decontaminated(frame_, bench.limit(0)).count() == len(docs)
    assert op1.contaminated(frame_.limit(0), bench).count() == 0


def test_index_finds_all_fingerprints_within_the_radius(spark):
    """Any two fingerprints within the radius share a block variant."""
    rnd = random.Random(3)
    width, allowed = op1.BITS // op1.BLOCKS, op1.RADIUS // op1.BLOCKS
    for _ in range(500):
        f = rnd.getrandbits(op1.BITS)
        g = f
        for b in rnd.sample(range(op1.BITS), op1.RADIUS):
            g ^= 1 << b
        assert any(((f ^ g) >> (j * width) & (1 << width) - 1).bit_count() <= allowed for j in range(op1.BLOCKS))


def test_simhash_counts_occurrences(spark):
    rows = [([3, 3, -1],), ([],), ([-(1 << 63)],), ([5],)]
    got = [r[0] for r in spark.createDataFrame(rows, "s array<long>").select(op1.simhash("s")).collect()]
    assert got == [3, 0, -(1 << 63), 5]


def test_no_python_in_the_plan(spark):
    docs, items = corpus()
    plan = op1.contaminated(frame(spark, docs), frame(spark, items, "item_id long, text string"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|CartesianProduct|NestedLoop", text)
