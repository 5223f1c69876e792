"""The corpus pipeline: documents in, encoded training documents out.

Each stage is a function (spark, docs, sf_dir) that returns a DataFrame; it is
written as Parquet in the shared folder of ``spark.checkpoint.dir`` and read
again as the next stage's ``docs``, so a lost executor repeats tasks of one
stage only. All stages but the last return the columns of ``docs``.

Each stage states its own rules for odd rows; through the whole pipeline, null
and blank texts and texts without letters go (language), of repeated rows and
copies one stays, texts of any length are taken whole, rows without an id are
never removed as copies of others, an empty table gives an empty result, and
extra columns of any name are carried along; those named ids, n_tokens or
round_trip are replaced by the last stage's.

1. language: documents whose letters show no language go, and those with no
   language for half of their letters (see ``op10.accepted``).
2. near_duplicates: one document of each group of linked texts stays (Jaccard
   of 0.8 or more on five-word shingles).
3. repeated_passages: words of repeated passages of 50 words and more go, but
   for their first document.
4. decontaminate: documents that contain a benchmark item go.
5. encode: SentencePiece ids of the text, decoded again as a check.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockline.llm import op01_decontaminate as op1
from stockline.llm import op02_ngram_join as op2
from stockline.llm import op03_sentencepiece as op3
from stockline.llm import op08_substrings as op8
from stockline.llm import op10_language as op10
from stockline.llm.common import table
from stockline.llm.queries import vocabulary
from stockline.session import ensure_checkpoint_dir


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op10.accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op2.one_of_each(docs, op2.NEAR_DUPLICATE)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op8.without_repeats(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op1.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with ids, n_tokens and whether decoding gives the text
    back (a text with the mark of the vocabulary, U+2581, does not)."""
    path = vocabulary("piece_bpe_32k.model")
    ids, decoded = ("_" * max(map(len, docs.columns)) + c for c in ("ids", "decoded"))  # longer than any name
    out = op3.encode_and_decode(docs, path, ids=ids, decoded=decoded)
    return out.select(*[f"`{c}`" for c in docs.columns if c not in ENCODED], F.col(ids).alias("ids"),
                      F.size(ids).cast("long").alias("n_tokens"),
                      F.col(decoded).eqNullSafe(F.coalesce("text", F.lit(""))).alias("round_trip"))


#: Columns that the last stage adds.
ENCODED = ["ids", "n_tokens", "round_trip"]

STAGES = [("language", language), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages),
          ("decontaminate", decontaminate), ("encode", encode)]

#: SQL cannot express the language model, SimHash or the encoding; tests/llm
#: hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
