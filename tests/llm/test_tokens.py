import os
import random

import public_tokenizers
import pyarrow as pa
import pytest
from helpers import frame

from stockline.llm import op03_sentencepiece as op3
from stockline.llm import op07_token_counts as op7

MODEL, BYTES = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "  ", "a", " a", "a ", "  a  b   ", "\n\n\t x", "▁▁ a▁b", "日本語のテキスト、長い文。" * 30, "😀😁 ok", "a" * 60,
       "ababababab", "http://www.example.com/" + "abc" * 40, "    " * 9 + "x", " " * 100, "\0a", "it's we'll I'd 'tis don't'x",
       "a'llb 're's", "<|endoftext|>a <|endoftext|><|endoftext|> b's", "'", "a'l", "  x \x1c y \x85z", "١٢٣ ½ Ⅷ 三", "<s>x</s>"]


def odd_texts(pieces, n=800):
    rnd = random.Random(1)
    letters = list("abcdeinortsxyzvmABCé▁'  \n\t.,1٢½🙂日　")
    return (ODD + ["".join(rnd.choices(letters, k=rnd.randint(1, 60))) for _ in range(n)]
            + ["".join(rnd.choices(pieces, k=rnd.randint(1, 12))).replace("▁", rnd.choice([" ", "", "▁"])) for _ in range(n)])


@pytest.fixture(scope="module")
def library():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.mark.parametrize("long", [op3.LONG, 4, 10_000])
def test_pieces_as_the_library(library, long, monkeypatch):
    monkeypatch.setattr(op3, "LONG", long)  # queue only, rounds only, and both
    texts = odd_texts([library.id_to_piece(i) for i in range(259, 32_000)])
    model = op3.PieceModel(MODEL)
    ids = model.encode(pa.array(texts))
    assert ids.to_pylist() == library.encode(texts, num_threads=1)
    assert model.decode(ids).to_pylist() == library.decode(ids.to_pylist())
    rnd = random.Random(2)
    any_ids = [[rnd.randrange(32_000) for _ in range(rnd.randrange(20))] for _ in range(500)]
    assert model.decode(pa.array(any_ids, pa.list_(pa.int32()))).to_pylist() == [library.decode(i) for i in any_ids]


def test_encode_decode_frames(spark, library):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "x"), (5, None), (5, None), (6, "word " * 40_000)]
    docs = frame(spark, rows).selectExpr("doc_id", "text", "'clash' as decoded", "1 as ids")
    out = op3.decode(op3.encode(docs, MODEL), MODEL)
    assert sorted(out.columns) == ["decoded", "doc_id", "ids", "text"]
    for r in out.collect():
        assert r.ids == library.encode(r.text or "") and r.decoded == library.decode(r.ids)
    assert op3.encode(spark.createDataFrame([], "doc_id long, text string"), MODEL).count() == 0


def test_counts_as_the_library(spark):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(BYTES)
    texts = odd_texts(["ab", "1", " x"], 300)
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "x y"), (3, None), (3, None), (4, "a"), (4, "a"), (9_999, "word " * 40_000)]
    docs = frame(spark, rows).selectExpr("doc_id", "text", "1 as n_tokens", "'z' as token")
    for head in (op7.HEAD, 8):
        got = op7.count_tokens(docs, BYTES, head=head).collect()
        expected = [(i, len((t or "").encode()), len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for i, t in rows]
        assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in got), key=str) == sorted(expected, key=str)
        assert all(r.over_limit == (r.n_tokens > 512) for r in got)
    assert op7.count_tokens(spark.createDataFrame([], "doc_id long, text string"), BYTES).count() == 0


def test_character_classes_as_the_library():
    from tokenizers import Tokenizer
    pre = Tokenizer.from_file(BYTES).pre_tokenizer
    kinds = op7.rules(BYTES).classes
    for c in [chr(i) for i in [*range(0x3000), 0x558, 0x88f, 0xa66e, 0xac00, 0x1f600, 0x20000, 0x31350, 0xe0001]]:
        starts = {a for _, (a, _) in pre.pre_tokenize_str(f"a{c}1{c}")}
        assert (kinds[ord(c)] == op7.LETTER) == (1 not in starts) and (kinds[ord(c)] == op7.NUMBER) == (3 not in starts), hex(ord(c))
        assert (kinds[ord(c)] == op7.SPACE) == (len(pre.pre_tokenize_str(f"!{c}!")) > 1 and starts >= {1, 3}), hex(ord(c))
