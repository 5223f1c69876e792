"""Queries opN_<name> over the given tables, and their SQL where it exists."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from . import op01_decontaminate as op1
from . import op02_ngram_join as op2
from . import op03_sentencepiece as op3
from . import op04_warc as op4
from . import op05_urls as op5
from . import op06_quality as op6
from . import op07_token_counts as op7
from . import op08_substrings as op8
from . import op09_toxicity as op9
from . import op10_language as op10
from . import op11_fingerprints as op11
from . import op12_negatives as op12
from . import op13_whitening as op13
from .common import table
from .sql import SQL  # noqa: F401  re-exported


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file; its folder is a setting."""
    folder = os.environ.get("LLM_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op1.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2.near_duplicates(table(spark, sf_dir, "documents"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary("piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = op3.encode_and_decode(docs, path)
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/warc-{uuid.uuid4().hex}"
    op4.write_archives(table(spark, sf_dir, "pages"), folder)
    return op4.read_archives(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type",
                                                   "refers_to", "digest_ok")


def op5_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcomes = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"), F.greatest(1 - F.col("quality"), F.col("toxic")).alias("bad"))
    return op5.judge_urls(table(spark, sf_dir, "pages"), outcomes, op5.RULES).select(
        "page_id", "host", "path", "rule", "verdict")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    return op6.judge_quality(table(spark, sf_dir, "documents"), trusted)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7.count_tokens(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return op8.remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op9.held_out_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10.held_out_languages(table(spark, sf_dir, "documents"))


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11.edited_neighbours(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = op12.scaled(table(spark, sf_dir, "embeddings"), 256, changed)
    return op12.hard_negatives(rows, F.col("vec_id") % 50 == 0)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13.whiten(op13.usable(table(spark, sf_dir, "embeddings")))


QUERIES = {f.__name__: f for f in (op1_decontaminate, op2_ngram_join, op3_sentencepiece, op4_warc, op5_urls, op6_quality,
                                   op7_token_counts, op8_substrings, op9_toxicity, op10_language, op11_fingerprints,
                                   op12_negatives, op13_whitening)}
