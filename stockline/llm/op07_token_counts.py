"""Token counts without token ids.

The pre-tokens of every text are counted per document; the pieces of each
distinct pre-token are counted once; the two are joined and summed.

A task finds pre-token borders for many texts at once (character classes in
numpy) and hands the tokens to Arrow as offsets into the text, so no Python
string is made for a token. The join is split by frequency: pre-tokens of a
frequency class that holds at most ``HEAD`` distinct ones together with all
higher classes go to the tasks as a table of that bounded size and are summed
there; all others are joined in a shuffle. Both sides cover every token, so
the split changes only the way. A frequent pre-token is never a shuffle key
of the join, however many rows hold it.

The distinct pre-tokens and their piece counts are written once as a table in
the shared folder of ``spark.checkpoint.dir``.

Defined results: null and empty texts have 0 bytes and 0 tokens; repeated
rows are counted one by one; strings of special tokens in a text are single
tokens, as the library reads them by default; extra columns are ignored.
"""

from __future__ import annotations

import functools
import json
import os
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .common import text_slices, texts_of

#: Distinct pre-tokens that may be sent to every task (about 4 MB).
HEAD = 1 << 18
#: Distinct pre-tokens a task holds before it passes counts on.
HELD = 300_000

LETTER, NUMBER, SPACE, OTHER = 1, 2, 0, 3
#: Endings that follow an apostrophe in the pattern of the tokenizer.
ENDINGS = ["s", "t", "re", "ve", "m", "ll", "d"]


@functools.cache
def _class_ranges(path: str) -> tuple[np.ndarray, np.ndarray]:
    """First code point and class of each range of equal class, asked of the
    library itself (its tables may be of another Unicode version): a character
    that joins a letter, a number or a sign before it is of that class. Only
    characters that could be a letter, number or space by the newest table
    are asked."""
    pre, out = _tokenizer(path).pre_tokenizer, np.full(0x110000, OTHER, np.uint8)
    every = "".join(chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000)
    chars = np.array([ord(c) for c in regex.findall(r"[\p{L}\p{N}\s\p{Z}\p{Cc}\p{M}]", every)])
    for part in np.array_split(chars, 64):
        text = "".join(f"a{c}1{c}!{c} " for c in map(chr, part))
        starts = np.zeros(len(text) + 1, bool)
        starts[[a for _, (a, _) in pre.pre_tokenize_str(text)]] = True
        joins = ~starts[:-1].reshape(-1, 7)[:, [1, 3, 5]]
        out[part] = np.where(joins[:, 0], LETTER, np.where(joins[:, 1], NUMBER, np.where(joins[:, 2], OTHER, SPACE)))
    first = np.flatnonzero(np.concatenate([[True], out[1:] != out[:-1]]))
    return first, out[first]


@dataclass(frozen=True, eq=False)
class Rules:
    """What splits texts into pre-tokens: special tokens and character
    classes (as ranges, a few kilobytes for every task)."""
    special: tuple[str, ...]
    first: np.ndarray
    kind: np.ndarray

    @functools.cached_property
    def classes(self) -> np.ndarray:
        return np.repeat(self.kind, np.diff(np.append(self.first, 0x110000)))


def rules(path: str) -> Rules:
    return Rules(_special_tokens(path), *_class_ranges(path))


@functools.cache
def _special_tokens(path: str) -> tuple[str, ...]:
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec["pre_tokenizer"]
    if pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"] or spec["normalizer"]:
        raise ValueError(f"{path}: only byte-level vocabularies without normalisation are supported")
    return tuple(t["content"] for t in spec["added_tokens"])


@functools.cache
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


def _borders(cps: np.ndarray, starts: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Where tokens start, for texts laid end to end (``starts``: of each
    text, without the end; no text is empty)."""
    kind = classes[cps]
    n = len(cps)
    text_start = np.zeros(n + 1, bool)
    text_start[starts] = text_start[n] = True
    run = text_start.copy()
    run[1:n] |= kind[1:] != kind[:-1]
    out = run.copy()
    # white space before a word: its last character stands alone, and joins the word if it is a blank
    word_runs = np.flatnonzero(run[:n] & ~text_start[:n] & (kind != SPACE))
    after_space = word_runs[kind[word_runs - 1] == SPACE]
    out[after_space - 1] = True
    out[after_space[cps[after_space - 1] == 32]] = False
    # an apostrophe that starts a token, and the ending after it
    quote = np.flatnonzero((cps == 39) & out[:n])
    quote = quote[~text_start[quote + 1]]
    padded = np.concatenate([cps, np.zeros(3, cps.dtype)])
    for ending in ENDINGS:
        hit = quote
        for j, c in enumerate(ending):
            hit = hit[(padded[hit + 1 + j] == ord(c)) & ((j == 0) | ~text_start[np.minimum(hit + 1 + j, n)])]
        out[hit + 1] = text_start[hit + 1]
        out[hit + 1 + len(ending)] = True
    return out[:n]


def pre_tokens(texts: list[str], rule: Rules) -> tuple[pa.StringArray, np.ndarray]:
    """All pre-tokens of the texts and the text each belongs to."""
    owner, segments, special = [], [], rule.special
    pattern = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
    whole = []
    for i, t in enumerate(texts):
        parts = pattern.split(t) if pattern and any(s in t for s in special) else [t]
        for k, p in enumerate(parts):
            if p:
                owner.append(i)
                segments.append(p)
                whole.append(k % 2 == 1)
    if not segments:
        return pa.array([], pa.string()), np.zeros(0, np.int64)
    joined = "".join(segments)
    cps = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.array([len(s) for s in segments])
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    at = _borders(cps, starts, rule.classes)
    for k in np.flatnonzero(whole):  # a special token is one token
        at[starts[k] + 1:starts[k] + lengths[k]] = False
    first = np.flatnonzero(at)
    width = 1 + (cps >= 0x80).astype(np.int64) + (cps >= 0x800) + (cps >= 0x10000)
    offset = np.concatenate([[0], np.cumsum(width)])
    offsets = np.append(offset[first], offset[-1]).astype(np.int32)
    tokens = pa.StringArray.from_buffers(len(first), pa.py_buffer(offsets), pa.py_buffer(joined.encode("utf-8")))
    return tokens, np.array(owner)[np.searchsorted(starts, first, side="right") - 1]


def _count_batches(batches, rule):
    held: dict[str, int] = {}

    def packed():
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                                          ["token", "n"])

    for batch in text_slices(batches):
        tokens, _ = pre_tokens(texts_of(batch), rule)
        counts = tokens.value_counts()
        for token, n in zip(counts.field(0).to_pylist(), counts.field(1).to_pylist()):
            held[token] = held.get(token, 0) + n
        if len(held) >= HELD:
            yield packed()
            held.clear()
    if held:
        yield packed()


def _piece_batches(batches, path):
    tokenizer = _tokenizer(path)
    for batch in batches:
        tokens, pieces = batch.column("token").to_pylist(), []
        for at in range(0, len(tokens), 2000):
            pieces += [len(e.ids) for e in tokenizer.encode_batch(tokens[at:at + 2000], add_special_tokens=False)]
        yield pa.RecordBatch.from_arrays([batch.column("token"), batch.column("n"), pa.array(pieces, pa.int32())],
                                         ["token", "n", "pieces"])


def distinct_pre_tokens(docs: DataFrame, path: str) -> DataFrame:
    """token, n (times in all texts), pieces: one row per distinct pre-token."""
    rule = rules(path)
    counted = (docs.select("text").mapInArrow(lambda it: _count_batches(it, rule), "token string, n long")
               .groupBy("token").agg(F.sum("n").alias("n")))
    return counted.mapInArrow(lambda it: _piece_batches(it, path), "token string, n long, pieces int")


def _frequency_batches(batches, rule, head: pa.Table):
    """For each row the tokens of the head summed, and its other tokens with
    their number. The first row of a text carries the sum; a text without
    other tokens has one row under a key of its own."""
    frequent = head.column("token").combine_chunks()
    head_pieces = head.column("pieces").to_numpy()
    for batch in text_slices(batches):
        tokens, owner = pre_tokens(texts_of(batch), rule)
        rows = batch.num_rows
        coded = tokens.dictionary_encode()
        codes, values = coded.indices.to_numpy(), coded.dictionary
        place = pc.fill_null(pc.index_in(values, value_set=frequent), -1).to_numpy()
        known = place >= 0
        pieces = np.where(known, head_pieces[place] if len(head_pieces) else 0, 0)
        base = np.bincount(owner, weights=pieces[codes], minlength=rows).astype(np.int64)
        rare = ~known[codes]
        pairs, n = np.unique(owner[rare] * max(len(values), 1) + codes[rare], return_counts=True)
        doc, code = pairs // max(len(values), 1), pairs % max(len(values), 1)
        new = np.concatenate([[True], doc[1:] != doc[:-1]])[:len(doc)]
        without = np.setdiff1d(np.arange(rows), doc)
        ids = batch.column("doc_id").to_pylist()
        all_docs = np.concatenate([doc, without])
        all_tokens = pa.concat_arrays([values.take(pa.array(code)),
                                       pa.array([f"\0{ids[i]}" for i in without], pa.string())])
        carries = np.concatenate([new, np.ones(len(without), bool)])
        take = pa.array(all_docs)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(take), batch.column("text_hash").take(take), batch.column("n_bytes").take(take),
             all_tokens, pa.array(np.concatenate([n, np.zeros(len(without), np.int64)]).astype(np.int32)),
             pa.array(np.where(carries, base[all_docs], 0)), pa.array(carries.astype(np.int32))],
            ["doc_id", "text_hash", "n_bytes", "token", "n", "base", "copies"])


def count_tokens(docs: DataFrame, path: str, limit: int = 512, head: int = HEAD) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of ``docs``."""
    spark, rule = docs.sparkSession, rules(path)
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{uuid.uuid4().hex}"
    distinct_pre_tokens(docs, path).write.parquet(folder)
    pieces = spark.read.schema("token string, n long, pieces int").parquet(folder)
    # the frequency classes from the top that hold at most ``head`` pre-tokens
    classes = (pieces.groupBy(F.floor(F.log2("n")).alias("c")).agg(F.count("*").alias("rows")).collect())
    least, held = 64, 0
    for r in sorted(classes, key=lambda r: -r["c"]):
        if held + r["rows"] > head:
            break
        least, held = int(r["c"]), held + r["rows"]
    in_head = F.floor(F.log2("n")) >= least
    top = pieces.filter(in_head).select("token", "pieces").toArrow().cast(
        pa.schema([("token", pa.string()), ("pieces", pa.int32())]))
    rest = pieces.filter(~in_head).select("token", "pieces")
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"),
                       F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    frequencies = rows.mapInArrow(
        lambda it: _frequency_batches(it, rule, top),
        f"doc_id {kind}, text_hash long, n_bytes long, token string, n int, base long, copies int")
    summed = (frequencies.join(rest, "token", "left").groupBy("doc_id", "text_hash", "n_bytes")
              .agg(F.sum(F.col("base") + F.col("n") * F.coalesce("pieces", F.lit(0))).alias("total"),
                   F.sum("copies").alias("copies")))
    per_copy = (F.col("total") / F.col("copies")).cast("long")
    one_row_each = summed.select("doc_id", "n_bytes", per_copy.alias("n_tokens"),
                                 F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_c"))
    return one_row_each.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
