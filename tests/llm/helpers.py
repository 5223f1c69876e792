import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, rows, columns="doc_id long, text string", parts=3):
    return spark.createDataFrame(rows, columns).repartition(parts)


def near_corpus(seed=3, n=120):
    """Copies, near copies and shared passages, with the odd rows."""
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["É", "A", "b", "Zz", "日本"]

    def text(k):
        return " ".join(rnd.choices(vocabulary, k=k))

    base = [text(rnd.randint(1, 220)) for _ in range(30)]
    rows = []
    for i in range(n):
        kind, t = rnd.random(), rnd.choice(base)
        if .25 <= kind < .6:
            w = t.split()
            for _ in range(rnd.randint(0, max(1, len(w) // 30))):
                w[rnd.randrange(len(w))] = rnd.choice(vocabulary)
            t = " ".join(w)
        elif .6 <= kind < .8:
            w = t.split()
            a = rnd.randrange(len(w))
            t = f"{text(rnd.randint(0, 60))}  \n{' '.join(w[a:a + rnd.randint(40, 120)])} {text(rnd.randint(0, 50))}"
        elif kind >= .8:
            t = text(rnd.randint(0, 90))
        rows.append((i * 3 % (n + 1), t.upper() if kind < .03 else t))
    first = rows[0]
    return rows + [(500, None), (501, ""), (502, "  \n"), (503, "one"), (504, "ONE"), (505, "one two"), (506, "one two"),
                   (7, first[1]), (None, first[1]), first, (507, "x " * 30_000)]
