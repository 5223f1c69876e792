"""Language identification by word scores and a switching penalty.

A word is a run of letters of one script. Script ranges narrow the candidate
languages of a word; hashed letter trigrams (word edges included) score it for
each candidate; Viterbi with a penalty for each change of language labels the
words, so mixed texts fall into spans.

Model: trigram counts of every labelled text, gathered by Spark as one row per
(language, bucket): at most ``BUCKETS`` rows for each language, however large
the corpus. The model is sent to the tasks with the function that uses it.

Defined results: null or letterless text has no spans and the language
``und`` with score 0; with no labelled text every text is ``und``; ties go to
the alphabetically first language; repeated rows are judged one by one; extra
columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, code_points, crc_mod, letters, text_slices, texts_of

BUCKETS = 1 << 16
SMOOTHING = 0.5
#: Cost of a change of language between two words, in nats.
SWITCH = 12.0
#: A script belongs to a language that writes at least this share of its letters in it.
SCRIPT_SHARE = 0.01
UNDETERMINED = "und"
#: Share of a text's characters that must be letters for its language to be told.
LEAST_LETTERS = 0.1
#: Share of a text's letters that must be in spans of its main language.
LEAST_SHARE = 0.5
NOT_A_CANDIDATE = -60.0

#: Blocks of the Unicode standard by script.
SCRIPT_RANGES = [
    ("latin", 0x0041, 0x024F), ("latin", 0x1E00, 0x1EFF), ("greek", 0x0370, 0x03FF), ("greek", 0x1F00, 0x1FFF),
    ("cyrillic", 0x0400, 0x052F), ("armenian", 0x0530, 0x058F), ("hebrew", 0x0590, 0x05FF),
    ("arabic", 0x0600, 0x06FF), ("arabic", 0x0750, 0x077F), ("devanagari", 0x0900, 0x097F),
    ("bengali", 0x0980, 0x09FF), ("tamil", 0x0B80, 0x0BFF), ("thai", 0x0E00, 0x0E7F), ("georgian", 0x10A0, 0x10FF),
    ("hangul", 0x1100, 0x11FF), ("hangul", 0xAC00, 0xD7AF), ("kana", 0x3040, 0x30FF), ("han", 0x3400, 0x4DBF),
    ("han", 0x4E00, 0x9FFF), ("han", 0x20000, 0x2FA1F),
]
SCRIPTS = ["other", *dict.fromkeys(name for name, _, _ in SCRIPT_RANGES)]

_SCRIPT: np.ndarray | None = None


def _script_of() -> np.ndarray:
    global _SCRIPT
    if _SCRIPT is None:
        _SCRIPT = np.zeros(0x110000, np.uint8)
        for name, first, last in SCRIPT_RANGES:
            _SCRIPT[first:last + 1] = SCRIPTS.index(name)
    return _SCRIPT


@dataclass
class LanguageModel:
    languages: list[str]
    weights: np.ndarray  # (BUCKETS, languages) log probability against an even spread
    allowed: np.ndarray  # (scripts, languages) candidates of a script
    switch: float = SWITCH


@dataclass
class _Words:
    trigrams: np.ndarray  # bucket of each letter
    first: np.ndarray  # index of each word's first letter among the letters
    length: np.ndarray  # letters of each word
    script: np.ndarray  # of each word
    start: np.ndarray  # code point offset of each word in its text
    text: np.ndarray  # text of each word


def _scan(texts: list[str]) -> _Words:
    """Words of the lower-cased texts and the trigram bucket of each letter."""
    cps, starts = code_points([t.lower() for t in texts])
    is_letter = letters()[cps]
    at = np.flatnonzero(is_letter)
    if not len(at):
        empty = np.zeros(0, np.int64)
        return _Words(empty, empty, empty, empty, empty, empty)
    script = _script_of()[cps]
    new = np.ones(len(cps), bool)
    new[1:] = ~is_letter[:-1] | (script[1:] != script[:-1])
    masked = np.where(is_letter, cps, 0).astype(np.uint32)
    before = np.zeros_like(masked)
    before[1:] = masked[:-1]
    after = np.zeros_like(masked)
    after[:-1] = masked[1:]
    hashed = masked * np.uint32(0x9E3779B1) + before * np.uint32(0x85EBCA77) + after * np.uint32(0xC2B2AE3D)
    hashed ^= hashed >> np.uint32(15)
    hashed *= np.uint32(0x2C1B3C6D)
    trigrams = (hashed[at] >> np.uint32(16)).astype(np.int64)
    first = np.flatnonzero(new[at])
    where = at[first]
    text = np.searchsorted(starts, where, side="right") - 1
    length = np.diff(np.append(first, len(at)))
    return _Words(trigrams, first, length, script[where].astype(np.int64), where - starts[text], text)


def _count_batches(batches):
    grams: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(BUCKETS + len(SCRIPTS), np.int64))
    for batch in text_slices(batches):
        by_language = defaultdict(list)
        for lang, text in zip(batch.column("lang").to_pylist(), texts_of(batch)):
            by_language[lang].append(text)
        for lang, texts in by_language.items():
            found = _scan(texts)
            grams[lang][:BUCKETS] += np.bincount(found.trigrams, minlength=BUCKETS)
            grams[lang][BUCKETS:] += np.bincount(found.script, weights=found.length,
                                                 minlength=len(SCRIPTS)).astype(np.int64)
    for lang, counts in grams.items():
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)),
                                          pa.array(counts[at])], ["lang", "bucket", "n"])


def learn(docs: DataFrame, switch: float = SWITCH) -> LanguageModel:
    """Model of the labelled texts in ``docs`` (columns text, lang; rows
    without either are left out). Only sums per language and bucket reach the
    driver."""
    labelled = docs.select("text", "lang").filter("text IS NOT NULL AND lang IS NOT NULL")
    counts = (labelled.mapInArrow(_count_batches, "lang string, bucket int, n long")
              .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())
    languages = sorted(counts["lang"].unique())
    size = BUCKETS + len(SCRIPTS)
    grams = np.zeros((size, len(languages)))
    column = {lang: k for k, lang in enumerate(languages)}
    grams[counts["bucket"].to_numpy(int), counts["lang"].map(column).to_numpy(int)] = counts["n"].to_numpy(float)
    trigrams, scripts = grams[:BUCKETS], grams[BUCKETS:]
    weights = np.log((trigrams + SMOOTHING) * BUCKETS / (trigrams.sum(0) + SMOOTHING * BUCKETS))
    allowed = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(0), 1)
    allowed[~allowed.any(1)] = True
    return LanguageModel(languages, weights.astype(np.float32), allowed, switch)


def _label(scores: np.ndarray, text: np.ndarray, switch: float, block: int = 32) -> np.ndarray:
    """Best language of each word: Viterbi over the words of each text, where
    staying is free and a change costs ``switch``.

    All texts advance together: the words are laid out in blocks, the best
    score from each entry to each exit language is found for every block at
    once, blocks are chained text by text, and forward plus backward best
    scores give each word its language on the best path."""
    k = scores.shape[1]
    _, first, n = np.unique(text, return_index=True, return_counts=True)
    blocks = -(-n // block)
    begin = np.concatenate([[0], np.cumsum(blocks)])
    place = np.arange(len(text)) + np.repeat(begin[:-1] * block - first, n)
    laid = np.zeros((begin[-1] * block, k), np.float32)
    laid[place] = scores
    laid = laid.reshape(-1, block, k)

    def best(x: np.ndarray, chain: list[np.ndarray]) -> np.ndarray:
        across = np.full((len(x), k, k), -1e9, np.float32)
        across[:, range(k), range(k)] = 0
        for t in range(block):
            across = np.maximum(across, across.max(2, keepdims=True) - switch) + x[:, t, None, :]
        entry = np.zeros((len(x), k), np.float32)
        for at, previous in chain:
            v = (entry[previous][:, :, None] + across[previous]).max(1)
            entry[at] = v - v.max(1, keepdims=True)
        out = np.empty_like(x)
        for t in range(block):
            entry = np.maximum(entry, entry.max(1, keepdims=True) - switch) + x[:, t]
            out[:, t] = entry
        return out

    chain = []
    for step in range(1, int(blocks.max(initial=0))):
        at = begin[:-1][blocks > step] + step
        chain.append((at, at - 1))
    forward = best(laid, chain)
    # the same from the end: blocks and words reversed
    last = len(laid) - 1
    chain = []
    for step in range(1, int(blocks.max(initial=0))):
        at = last - (begin[1:][blocks > step] - 1 - step)
        chain.append((at, at - 1))
    backward = best(laid[::-1, ::-1], chain)[::-1, ::-1]
    total = (forward + backward - laid).reshape(-1, k)[place]
    return total.argmax(1)


def _score_words(found: _Words, model: LanguageModel) -> np.ndarray:
    out = np.empty((len(found.first), len(model.languages)), np.float32)
    for k in range(len(model.languages)):
        out[:, k] = np.add.reduceat(model.weights[:, k][found.trigrams], found.first)
    out += np.where(model.allowed[found.script], 0, NOT_A_CANDIDATE).astype(np.float32)
    return out


def _pieces(text: str, limit: int) -> list[tuple[int, str]]:
    """A long text cut at blanks into pieces of about ``limit`` characters."""
    out, at = [], 0
    while len(text) - at > limit:
        end = max(text.rfind(" ", at, at + limit), text.rfind("\n", at, at + limit)) + 1
        if end <= at:
            end = at + limit
        out.append((at, text[at:end]))
        at = end
    return [*out, (at, text[at:])]


def _labelled_words(texts: list[str], model: LanguageModel, limit: int = 1 << 20):
    """(text, offset, letters, language) of every word of the texts. Long
    texts are scored piece by piece and labelled as a whole."""
    parts = [(k, at, piece) for k, t in enumerate(texts) for at, piece in _pieces(t, limit)]
    scored, at = [], 0
    while at < len(parts):
        end, size = at, 0
        while end < len(parts) and (end == at or size + len(parts[end][2]) <= limit):
            size += len(parts[end][2])
            end += 1
        found = _scan([p for _, _, p in parts[at:end]])
        owner = np.array([k for k, _, _ in parts[at:end]])[found.text] if len(found.first) else found.text
        base = np.array([o for _, o, _ in parts[at:end]])[found.text] if len(found.first) else found.text
        if len(found.first):
            scored.append((owner, found.start + base, found.length, _score_words(found, model)))
        at = end
    if not scored or not model.languages:
        return None
    text, start, length, scores = (np.concatenate(x) for x in zip(*scored))
    return text, start, length, _label(scores, text, model.switch)


def _spans_in(batches, model: LanguageModel):
    for batch in text_slices(batches):
        found = _labelled_words(texts_of(batch), model)
        if found is None:
            continue
        text, start, length, label = found
        cut = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (label[1:] != label[:-1])]))
        end = np.append(cut[1:], len(text)) - 1
        ids = batch.column("doc_id").take(pa.array(text[cut]))
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(start[cut]), pa.array(start[end] + length[end]),
             pa.array(np.add.reduceat(length, cut)), pa.array([model.languages[k] for k in label[cut]], pa.string())],
            ["doc_id", "start", "end", "n_letters", "lang"])


def language_spans(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """Spans of one language: doc_id, start, end (code points of the
    lower-cased text), n_letters, lang. Texts without letters have none."""
    return docs.select("doc_id", "text").mapInArrow(
        lambda it: _spans_in(it, model), "doc_id long, start long, end long, n_letters long, lang string")


def _letters_by_language(texts: list[str], model: LanguageModel) -> np.ndarray | None:
    """Letters of each text (row) in the spans of each language (column); None
    if no text has a letter or the model no language."""
    if (found := _labelled_words(texts, model)) is None:
        return None
    text, _, length, label = found
    n, k = len(texts), len(model.languages)
    return np.bincount(text * k + label, weights=length, minlength=n * k).reshape(n, k)


def _identify_in(batches, model: LanguageModel):
    for batch in text_slices(batches):
        best, share = np.full(batch.num_rows, -1), np.zeros(batch.num_rows)
        if (tally := _letters_by_language(texts_of(batch), model)) is not None:
            total = tally.sum(1)
            best = np.where(total > 0, tally.argmax(1), -1)
            share = tally.max(1) / np.maximum(total, 1)
        names = [model.languages[b] if b >= 0 else UNDETERMINED for b in best]
        yield pa.RecordBatch.from_arrays(
            [*batch.drop_columns(["text"]).columns, pa.array(names, pa.string()), pa.array(share)],
            [*batch.drop_columns(["text"]).schema.names, "lang_pred", "score"])


def identify(docs: DataFrame, model: LanguageModel, keep: str = "doc_id") -> DataFrame:
    """doc_id, lang_pred, score: the language with most letters in its spans
    and its share of all letters (first name on a tie)."""
    kind = docs.schema[keep].dataType.simpleString()
    return docs.select(keep, "text").mapInArrow(lambda it: _identify_in(it, model),
                                                f"{keep} {kind}, lang_pred string, score double")


def held_out_languages(docs: DataFrame, folds: int = 4, fold: int = 2) -> DataFrame:
    """Learn on all folds but one, predict every document."""
    train = docs.filter(F.coalesce(crc_mod("doc_id", folds) != fold, F.lit(True)))
    out = identify(docs, learn(train))
    held = F.coalesce(crc_mod("doc_id", folds) == fold, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def accepted(docs: DataFrame, model: LanguageModel | None = None, least: float = LEAST_LETTERS,
             share: float = LEAST_SHARE) -> DataFrame:
    """Pipeline stage: the documents whose language can be told. A document goes
    if its text has no letter, if its letters are less than ``least`` of its
    characters other than blanks (signs, numbers and markup with a stray word),
    or if the spans of no language hold ``share`` of its letters (a medley of
    languages). Without a model (no row is labelled) every text with enough
    letters stays. The columns of ``docs`` are kept; the mask is computed beside
    the text, so nothing is shuffled."""
    model = model or learn(docs)
    schema = docs.schema

    def keep(batches):
        for part in text_slices(batches):
            texts = texts_of(part)
            tally = _letters_by_language(texts, model)
            if tally is None:
                tally = np.array([[_letters_of(t)] for t in texts], float).reshape(-1, 1)
            n, main = tally.sum(1), tally.max(1)
            signs = np.array([len(t) - sum(map(t.count, BLANKS)) for t in texts], float)
            yield part.filter(pa.array((n > 0) & (n >= least * signs) & (main >= share * n)))

    return docs.mapInArrow(keep, schema)


def _letters_of(text: str) -> int:
    cps, _ = code_points([text])
    return int(letters()[cps].sum())
