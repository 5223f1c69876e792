"""SentencePiece BPE encoding and decoding in vectorised merge rounds.

A task splits its texts into words (a run of blanks and what follows it; no
piece crosses such a border), finds the distinct words of the batch with
Arrow, and merges all of them together: the symbols of all words lie in one
numpy array; each round takes the best pair rank of every word (a segmented
minimum), merges the pairs of that rank from left to right, drops the used
symbols, and looks up the ranks of the new neighbours, until no pair remains.

Merging equal pairs together is exact unless the new symbol can join a
neighbour under a better rank than its own; the vocabulary tells for which
symbols that is so, and then only the leftmost pair is merged in the round.
Words of more than ``LONG`` characters go through a queue of pairs instead,
which gives the same merges in n log n steps.

Documents are independent: no shuffle, no state beyond a batch.

Defined results: null and empty texts have no ids and decode to the empty
string; repeated rows are handled one by one; extra columns are kept.
"""

from __future__ import annotations

import codecs
import functools
import heapq
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import release, text_slices

LONG = 48
#: Distinct words whose ids a Python worker remembers (about 8 MB).
KNOWN = 200_000
NO_PAIR = np.iinfo(np.int32).max
MARK = "▁"
UNITS = re.compile(" +[^ ]*")
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6


def _one_mark_per_byte(error):
    return "�" * (error.end - error.start), error.end


codecs.register_error("one_mark_per_byte", _one_mark_per_byte)


class PieceModel:
    """Vocabulary tables of one model file."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2
        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        norm, trainer = proto.normalizer_spec, proto.trainer_spec
        kinds = {p.type for p in proto.pieces}
        if (trainer.model_type != 2 or norm.precompiled_charsmap or not norm.add_dummy_prefix
                or norm.remove_extra_whitespaces or not norm.escape_whitespaces or not trainer.byte_fallback
                or trainer.treat_whitespace_as_suffix or kinds - {NORMAL, UNKNOWN, CONTROL, BYTE}):
            raise ValueError(f"{path}: only plain BPE models with byte fallback are supported")
        self.size = len(proto.pieces)
        vocabulary = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        if any(MARK in p.lstrip(MARK) for p in vocabulary):
            raise ValueError(f"{path}: a piece crosses a word border")
        scores = np.array([p.score for p in proto.pieces])
        rank = np.unique(-scores, return_inverse=True)[1].astype(np.int32)
        self.char_id = np.full(0x110000, -1, np.int32)
        self.byte_id = np.zeros(256, np.int32)
        surface = []
        for i, p in enumerate(proto.pieces):
            if p.type == NORMAL:
                surface.append(p.piece.replace(MARK, " ").encode())
                if len(p.piece) == 1:
                    self.char_id[ord(p.piece)] = i
            elif p.type == BYTE:
                value = int(p.piece[3:-1], 16)
                self.byte_id[value] = i
                surface.append(bytes([value]))
            else:
                surface.append(trainer.unk_surface.encode() if p.type == UNKNOWN else b"")
        self.marked = np.array([p.piece.startswith(MARK) and p.type == NORMAL for p in proto.pieces])
        pairs = []  # left, right, merged
        hot = np.zeros(self.size, bool)
        by_rank = np.bincount(rank[list(vocabulary.values())], minlength=self.size)
        for piece, i in vocabulary.items():
            if len(piece) > 1 and by_rank[rank[i]] > 1:
                hot[i] = True  # equal ranks: the place decides between different pairs
            for k in range(1, len(piece)):
                left, right = vocabulary.get(piece[:k]), vocabulary.get(piece[k:])
                if left is None or right is None:
                    continue
                pairs.append((left, right, i))
                for part, text in ((left, piece[:k]), (right, piece[k:])):
                    if len(text) > 1 and rank[i] <= rank[part]:
                        hot[part] = True
        pairs = np.array(pairs, np.int64).reshape(-1, 3)
        keys = pairs[:, 0] * self.size + pairs[:, 1]
        self._fill_slots(keys, pairs[:, 2])
        self.rank, self.hot = rank, hot
        self.pair = dict(zip(keys.tolist(), pairs[:, 2].tolist()))
        self.surface = np.frombuffer(b"".join(surface), np.uint8)
        self.width = np.array([len(s) for s in surface])
        self.surface_at = np.concatenate([[0], np.cumsum(self.width)[:-1]])
        # words met before, up to KNOWN of them, and their ids
        self.known = pa.array([], pa.string())
        self.known_ids, self.known_sizes = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def _fill_slots(self, keys: np.ndarray, merged: np.ndarray) -> None:
        """Pair table with open addressing: next free slot after the hash."""
        self.slot_bits = max(4, int(4 * len(keys)).bit_length())
        self.slot_key = np.full(1 << self.slot_bits, -1, np.int64)
        self.slot_piece = np.full(1 << self.slot_bits, -1, np.int32)
        slot = self._slot(keys)
        left = np.arange(len(keys))
        while len(left):
            free = left[self.slot_key[slot[left]] == -1]
            _, one = np.unique(slot[free], return_index=True)
            put = free[one]
            self.slot_key[slot[put]], self.slot_piece[slot[put]] = keys[put], merged[put]
            left = np.setdiff1d(left, put)
            slot[left] = (slot[left] + 1) & ((1 << self.slot_bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.slot_bits)).astype(np.int64)

    # ---- encoding ---------------------------------------------------------
    def _pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged piece of each pair of symbols, -1 where there is none."""
        key = left.astype(np.int64) * self.size + right
        key[(left < 0) | (right < 0)] = -2
        slot = self._slot(key)
        found = self.slot_key[slot]
        piece = np.where(found == key, self.slot_piece[slot], -1)
        open_ = np.flatnonzero((found != key) & (found != -1))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & ((1 << self.slot_bits) - 1)
            found = self.slot_key[slot[open_]]
            hit = found == key[open_]
            piece[open_[hit]] = self.slot_piece[slot[open_[hit]]]
            open_ = open_[~hit & (found != -1)]
        return piece

    def _merge(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge rounds over words laid end to end. Returns the symbols left
        (negative: a character without a piece) and their number per word."""
        n_words = len(lengths)
        word = np.repeat(np.arange(n_words), lengths)
        done: list[tuple[np.ndarray, np.ndarray]] = []

        def looked_up(left):  # merged piece and rank of the pairs that start at ``left``
            right = left + 1
            piece = np.full(len(left), -1, np.int32)
            inside = right < len(symbols)
            inside[inside] = word[left[inside]] == word[right[inside]]
            piece[inside] = self._pair(symbols[left[inside]], symbols[right[inside]])
            return piece, np.where(piece >= 0, self.rank[piece], NO_PAIR)

        piece, rank = looked_up(np.arange(len(symbols)))
        while len(symbols):
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            best = np.minimum.reduceat(rank, first)
            sizes = np.diff(np.append(first, len(symbols)))
            open_ = np.repeat(best < NO_PAIR, sizes)
            if not open_.all():
                done.append((word[~open_], symbols[~open_]))
                symbols, word, piece, rank = symbols[open_], word[open_], piece[open_], rank[open_]
                if not len(symbols):
                    break
                first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
                best, sizes = best[best < NO_PAIR], np.diff(np.append(first, len(symbols)))
            at = np.flatnonzero(rank == np.repeat(best, sizes))
            # of pairs that overlap, every other one from the left
            run = np.concatenate([[True], at[1:] != at[:-1] + 1])
            begin = np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
            leftmost = np.concatenate([[True], word[at[1:]] != word[at[:-1]]])
            at = at[np.where(self.hot[piece[at]], leftmost, (np.arange(len(at)) - begin) % 2 == 0)]
            # a hot pair is merged alone: a word whose leftmost is hot takes no other in this round
            leftmost = np.concatenate([[True], word[at[1:]] != word[at[:-1]]])
            alone = np.maximum.accumulate(np.where(leftmost, np.arange(len(at)), 0))
            at = at[leftmost | ~self.hot[piece[at[alone]]]]
            symbols[at] = piece[at]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            changed = np.zeros(len(symbols), bool)
            changed[at] = True
            changed[np.maximum(at - 1, 0)] = True
            # the neighbour to the left may itself end in a dropped symbol
            changed[np.maximum(at - 2, 0)] = True
            symbols, word, piece, rank, changed = symbols[keep], word[keep], piece[keep], rank[keep], changed[keep]
            again = np.flatnonzero(changed)
            piece[again], rank[again] = looked_up(again)
        if not done:
            return np.zeros(0, np.int32), np.zeros(n_words, np.int64)
        words_, symbols_ = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(words_, kind="stable")
        return symbols_[order], np.bincount(words_, minlength=n_words)

    def _merge_queue(self, symbols: list[int]) -> list[int]:
        """The same merges for one word with a queue of pairs."""
        n = len(symbols)
        before, after, alive = list(range(-1, n - 1)), list(range(1, n + 1)), [True] * n
        queue: list[tuple[int, int, int, int, int]] = []

        def offer(i):
            j = after[i] if i >= 0 else n
            if i >= 0 and j < n and symbols[i] >= 0 and symbols[j] >= 0:
                m = self.pair.get(symbols[i] * self.size + symbols[j])
                if m is not None:
                    heapq.heappush(queue, (int(self.rank[m]), i, symbols[i], symbols[j], m))

        for i in range(n - 1):
            offer(i)
        while queue:
            _, i, left, right, m = heapq.heappop(queue)
            j = after[i]
            if not alive[i] or j >= n or symbols[i] != left or symbols[j] != right:
                continue
            symbols[i], alive[j], after[i] = m, False, after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(before[i])
            offer(i)
        return [s for s, a in zip(symbols, alive) if a]

    def _encode_words(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """ids of distinct words (each without its first mark) and their number."""
        marked = [MARK + u.replace(" ", MARK) for u in units]
        sizes = np.array([len(m) for m in marked], np.int64)
        cps = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32)
        symbols = self.char_id[cps]
        symbols[symbols < 0] = -1 - cps[symbols < 0].astype(np.int32)
        long_ = sizes > LONG
        if long_.any():
            at = np.concatenate([[0], np.cumsum(sizes)])
            queued = {i: np.array(self._merge_queue(symbols[at[i]:at[i + 1]].tolist()), np.int32)
                      for i in np.flatnonzero(long_).tolist()}
            short, counts_short = self._merge(symbols[~np.repeat(long_, sizes)], sizes[~long_])
            counts = np.zeros(len(sizes), np.int64)
            counts[~long_], counts[long_] = counts_short, [len(q) for q in queued.values()]
            symbols, is_long = np.empty(int(counts.sum()), np.int32), np.repeat(long_, counts)
            symbols[~is_long], symbols[is_long] = short, np.concatenate(list(queued.values()))
        else:
            symbols, counts = self._merge(symbols, sizes)
        if (symbols < 0).any():  # characters without a piece become their bytes
            missing = np.flatnonzero(symbols < 0)
            spelled = [chr(-1 - s).encode("utf-8", "surrogatepass") for s in symbols[missing].tolist()]
            times = np.ones(len(symbols), np.int64)
            times[missing] = [len(b) for b in spelled]
            owner = np.repeat(np.repeat(np.arange(len(counts)), counts), times)
            wide = np.repeat(symbols, times)
            wide[wide < 0] = self.byte_id[np.frombuffer(b"".join(spelled), np.uint8)]
            symbols, counts = wide, np.bincount(owner, minlength=len(counts))
        return symbols, counts

    def _distinct(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Flat ids, and start and number of the ids of each distinct word."""
        place = pc.fill_null(pc.index_in(units, value_set=self.known), -1).to_numpy().astype(np.int64)
        new = np.flatnonzero(place < 0)
        fresh = units.take(pa.array(new))
        ids, sizes = np.zeros(0, np.int32), np.zeros(0, np.int64)
        if len(new):
            ids, sizes = self._encode_words(fresh.to_pylist())
        place[new] = len(self.known) + np.arange(len(new))
        all_ids, all_sizes = np.concatenate([self.known_ids, ids]), np.concatenate([self.known_sizes, sizes])
        start = np.cumsum(all_sizes) - all_sizes
        room = min(len(new), KNOWN - len(self.known))
        if room > 0:
            self.known = pa.concat_arrays([self.known, fresh.slice(0, room)])
            self.known_sizes = all_sizes[:len(self.known)]
            self.known_ids = all_ids[:int(self.known_sizes.sum())]
        return all_ids, start[place], all_sizes[place]

    def encode(self, texts: pa.Array) -> pa.ListArray:
        """ids of each text."""
        texts = pc.replace_substring(pc.fill_null(texts, ""), MARK, " ")
        odd = pc.or_(pc.or_(pc.match_substring(texts, "  "), pc.starts_with(texts, " ")), pc.equal(texts, ""))
        odd = odd.to_numpy(zero_copy_only=False)
        plain_at, odd_at = np.flatnonzero(~odd), np.flatnonzero(odd)
        plain = pc.split_pattern(texts.take(pa.array(plain_at)), " ")
        rest = [[u[1:] for u in UNITS.findall(" " + t)] if t else [] for t in texts.take(pa.array(odd_at)).to_pylist()]
        counts = np.concatenate([pc.list_value_length(plain).to_numpy(zero_copy_only=False).astype(np.int64),
                                 np.array([len(u) for u in rest], np.int64)])
        units = pa.concat_arrays([plain.flatten(), pa.array([u for r in rest for u in r], pa.string())])
        coded = units.dictionary_encode()
        ids, start, sizes = self._distinct(coded.dictionary)
        codes = coded.indices.to_numpy()
        per_unit = sizes[codes]
        flat = ids[_ragged(start[codes], per_unit)]
        unit_end = np.concatenate([[0], np.cumsum(per_unit)])
        offsets = unit_end[np.concatenate([[0], np.cumsum(counts)])]
        found = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat, pa.int32()))
        if not len(odd_at):
            return found
        back = np.empty(len(odd), np.int64)
        back[np.concatenate([plain_at, odd_at])] = np.arange(len(odd))
        return found.take(pa.array(back))

    # ---- decoding ---------------------------------------------------------
    def decode(self, ids: pa.ListArray) -> pa.Array:
        """Text of each list of ids (null: empty)."""
        sizes = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = ids.flatten().to_numpy(zero_copy_only=False)
        width = self.width[flat]
        data = self.surface[_ragged(self.surface_at[flat], width)]
        token_end = np.concatenate([[0], np.cumsum(width)])
        end = np.concatenate([[0], np.cumsum(sizes)])
        begin, stop = token_end[end[:-1]].copy(), token_end[end[1:]]
        first = np.flatnonzero(sizes > 0)
        begin[first] += self.marked[flat[end[first]]]  # the mark put before the text
        # texts lie end to end but for the dropped blanks, so drop those bytes
        keep = np.ones(len(data), bool)
        keep[(token_end[end[:-1]])[first[self.marked[flat[end[first]]]]]] = False
        data = data[keep].tobytes()
        offsets = np.concatenate([[0], np.cumsum(stop - begin)])
        try:
            data.decode("utf-8")
        except UnicodeDecodeError:
            return pa.array([data[a:b].decode("utf-8", "one_mark_per_byte")
                             for a, b in zip(offsets[:-1], offsets[1:])], pa.string())
        return pa.StringArray.from_buffers(len(sizes), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data))


def _ragged(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Indices start[i], start[i] + 1, ... (length[i] of them) for all i."""
    end = np.cumsum(length)
    total = int(end[-1]) if len(end) else 0
    return np.arange(total) + np.repeat(start - (end - length), length)


@functools.lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    return PieceModel(path)


def encode(docs: DataFrame, path: str, column: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the ids of a text column."""
    schema = T.StructType([*[f for f in docs.schema.fields if f.name != ids], T.StructField(ids, T.ArrayType(T.IntegerType()))])

    def run(batches):
        model = piece_model(path)
        for batch in text_slices(batches, column, 2_000_000):
            kept = [n for n in batch.schema.names if n != ids]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), model.encode(batch.column(column))],
                                             [*kept, ids])

    return docs.mapInArrow(run, schema)


def encode_and_decode(docs: DataFrame, path: str, column: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``docs`` with the ids of a text column and the text that they stand for,
    by one pass of one Python worker a task."""
    new = [T.StructField(ids, T.ArrayType(T.IntegerType())), T.StructField(decoded, T.StringType())]
    schema = T.StructType([*[f for f in docs.schema.fields if f.name not in (ids, decoded)], *new])

    def run(batches):
        model = piece_model(path)
        for batch in text_slices(batches, column, 2_000_000):
            kept = [n for n in batch.schema.names if n not in (ids, decoded)]
            found = model.encode(batch.column(column))
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), found, model.decode(found)], [*kept, ids, decoded])

    return docs.mapInArrow(run, schema)


def decode(docs: DataFrame, path: str, ids: str = "ids", column: str = "decoded") -> DataFrame:
    """``docs`` with the text that a column of ids stands for."""
    schema = T.StructType([*[f for f in docs.schema.fields if f.name != column], T.StructField(column, T.StringType())])

    def run(batches):
        model = piece_model(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                kept = [n for n in part.schema.names if n != column]
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in kept), model.decode(part.column(ids))],
                                                 [*kept, column])
            release()

    return docs.mapInArrow(run, schema)
