import os

import duckdb
import pytest
from helpers import WORD
from pyspark.sql import functions as F
from test_decontaminate import brute_force as leaks
from test_joins import join_brute_force, repeats_brute_force

import __spark_entry__ as entry
import corpus_pipeline
from stockline.llm.queries import SQL, vocabulary

SF = "/root/testdata/sf0.001"


def write(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")


def lettered(text):
    n = sum(c.isalpha() for c in text)
    return n > 0 and n >= 0.1 * sum(c not in " \t\n\x0b\x0c\r" for c in text)


def test_pipeline_against_brute_force(spark, tmp_path):
    import sentencepiece
    library = sentencepiece.SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))
    base = spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").limit(10).collect()]
    passage = " ".join(f"shared{i}" for i in range(70))
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in base]
    rows += [(900, base[3].text, "en", "s", 1), (901, f"one {passage} two", "en", "s", 1), (902, f"three  {passage}", None, None, None),
             (903, passage, "en", "s", 1), (904, None, "en", "s", 1), (905, "12 34", "en", "s", 1), (906, bench[0][1], "en", "s", 1),
             (907, f"before {bench[1][1]} after", "en", "s", 1), (908, "", "en", "s", 1), (None, "no id here", "en", "s", 1)]
    write(spark, tmp_path, "documents", rows, "doc_id long, text string, lang string, source string, n_chars long")
    write(spark, tmp_path, "benchmark", bench, "item_id long, text string")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()

    docs = [(r[0], r[1]) for r in rows if lettered(r[1] or "")]
    least = {i: c for i, _, c, _ in join_brute_force(docs)}
    docs = [(i, t) for i, t in docs if i is None or least[i] == i]
    cut = {i: (n, gone, kept) for i, n, gone, kept in repeats_brute_force(docs)}
    docs = [(i, cut[i][2] if cut[i][1] else t) for i, t in docs if not cut[i][1] or cut[i][1] < cut[i][0]]
    dirty = {d for d, _ in leaks(docs, bench)}
    expected = {i: t for i, t in docs if i not in dirty}
    assert {r.doc_id: r.text for r in out} == expected and len(out) == len(expected)
    assert {906, 907} <= dirty and 903 not in expected and 900 not in expected
    for r in out:
        assert r.ids == library.encode(r.text) and r.n_tokens == len(r.ids) and r.round_trip


def test_near_duplicates_by_five_words(spark):
    """The stage against brute force: five-word shingles, Jaccard 0.8 or more."""
    import random

    from helpers import near_corpus
    rnd = random.Random(9)
    w = [f"v{i}" for i in range(400)]
    rows = near_corpus(n=60) + [(600, " ".join(w))]
    for i, n in ((601, 8), (602, 9), (603, 10)):  # five-word 0.817, 0.796 and 0.777 with the first
        rows.append((i, " ".join(f"x{i}y{j}" if j in range(20, 20 + 40 * n, 40) else v for j, v in enumerate(w))))
    rows += [(604, "four words are one"), (605, "Four words ARE one"), (606, " ".join(rnd.choices(w, k=30)))]
    sets = []
    for _, t in rows:
        x = WORD.findall((t or "").lower())
        sets.append({tuple(x[k:k + 5]) for k in range(len(x) - 4)} if len(x) > 4 else ({tuple(x)} if x else set()))
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    least = {}
    for g, (i, _), s in zip(group, rows, sets):
        if i is not None and s:
            least[g] = min(i, least.get(g, i))
    want = {row for row, g, s in zip(rows, group, sets) if row[0] is None or not s or least[g] == row[0]}
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [(r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()]
    assert set(got) == want and len(got) == len(want)
    assert {i for i, _ in want} & {600, 601, 602, 603, 604, 605} == {600, 602, 603, 604}


LANGUAGE_ROWS = [(1, "some words of a text", "en"), (2, "des mots d'un texte", "fr"), (3, "#" * 10_000 + " a", None), (4, None, "en"),
                 (5, "", "en"), (6, "12 34 !?", "en"), (7, "日本語のテキスト", None), (8, "1234567 abc", None), (9, "x " * 60_000, None)]


@pytest.mark.parametrize("labelled", [True, False])
def test_language_stage(spark, labelled):
    rows = [(i, t, lang if labelled else None) for i, t, lang in LANGUAGE_ROWS]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3).withColumn("lang_pred", F.lit("x"))
    kept = corpus_pipeline.language(spark, docs, "")
    assert kept.schema == docs.schema
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 7, 8, 9]


CLASHING = ["n_words", "n_removed", "kept", "_bucket", "_id", "_k", "k", "n", "ids", "decoded", "n_tokens", "round_trip", "part",
            "low", "h", "least", "root", "at", "c0", "c1", "_kept", "length", "start"]


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_carry_columns_of_any_name(spark, stage):
    passage = " ".join(f"shared{i}" for i in range(60))
    rows = [(1, f"one {passage}", "en"), (2, f"two {passage} three", "en"), (3, "a third text", None), (4, "A third text", "en"),
            (5, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(2)
    extra = {c: F.concat(F.lit(f"{c} "), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) for c in CLASHING}
    function = dict(corpus_pipeline.STAGES)[stage]
    plain = function(spark, docs, SF)
    wide = function(spark, docs.withColumns(extra), SF)
    carried = [c for c in CLASHING if stage != "encode" or c not in corpus_pipeline.ENCODED]
    assert wide.columns == [*docs.columns, *carried, *plain.columns[3:]]
    assert sorted(wide.select(plain.columns).collect(), key=str) == sorted(plain.collect(), key=str)
    for r in wide.collect():
        assert all(r[c] == f"{c} {r.doc_id}" for c in carried)


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_without_rows(spark, stage):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, n_chars int")
    assert dict(corpus_pipeline.STAGES)[stage](spark, docs, SF).collect() == []


def test_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "repeated_passages", "decontaminate", "encode"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_registered():
    names = set(entry.queries())
    assert "pipeline" in names and {int(n[2:].split("_")[0]) for n in names if n.startswith("op")} == set(range(1, 14))
    assert set(SQL) <= names and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    r = con.sql(SQL[name])
    names, rows = r.columns, r.fetchall()
    got = entry.queries()[name](spark, SF)
    assert sorted(got.columns) == sorted(names)
    assert sorted((tuple(x[c] for c in names) for x in got.collect()), key=repr) == sorted(rows, key=repr)


def test_words_rule_is_the_same_everywhere(spark):
    from stockline.llm.common import words
    from stockline.llm.wordhash import Words
    texts = ["a b", " a\x0b\x0cb\r\n", "", "\x1c x\x85y z", "　全角", "\x00 a"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [r[0] for r in frame.select(words(F.col("text"))).collect()]
    assert got == [WORD.findall(t) for t in texts]
    w = Words(texts)
    assert w.n.tolist() == [len(WORD.findall(t)) for t in texts]


def test_entry_without_the_subpackage(tmp_path):
    """A copy of the library without the subpackage still imports."""
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = ("import sys; sys.modules['stockline.llm'] = None\n"
            f"sys.path.insert(0, {root!r})\n"
            "import importlib.abc\n"
            "del sys.modules['stockline.llm']\n"
            "class Absent(importlib.abc.MetaPathFinder):\n"
            "    def find_spec(self, name, path, target=None):\n"
            "        if name == 'stockline.llm':\n"
            "            raise ModuleNotFoundError('absent', name=name)\n"
            "sys.meta_path.insert(0, Absent())\n"
            "import __spark_entry__ as e\n"
            "assert not any(n.startswith('op') and n[2].isdigit() for n in e.queries()) and 'pipeline' not in e.queries()\n")
    subprocess.run([sys.executable, "-c", code], check=True, cwd=tmp_path)
