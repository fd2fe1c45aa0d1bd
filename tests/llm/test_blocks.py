"""Encoders on sliced blocks of a batch give the same results as on single texts."""

from __future__ import annotations

import pyarrow as pa
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from candleframe.llm.chunks import blocks
from candleframe.llm.jaccard_join import shingle_sets
from candleframe.llm.sentencepiece_codec import PieceModel
from candleframe.llm.word_bpe import WordEncoder

TEXTS = [
    "", " ", "a", None, "Hello, World! don't  stop", "é à ü ñ ß Ä — ½ 日本語\nline two\t tab", "x" * 5000,
    "<|endoftext|> in <|startoftext|>the middle", "\n\n leading", "trailing  \n", "▁ literal ▁▁ marks", "a\x01b \x00 c",
    "é combining < ̸ not", "İstanbul ΣΑΣ ς", "1 22 333,4.5%", "naïve café's it's 'S 'll", " nbsp em",
    "emoji 👩‍👩‍👧 done", "mixed 日本 語!?abc", "tab\x0bvt\x0cff\rcr",
] * 3


def slices(limit=200):
    batch = pa.RecordBatch.from_arrays([pa.array(TEXTS, pa.string())], ["text"])
    return blocks(batch, "text", limit)


def test_blocks_keep_every_row_in_order():
    got = [t for b in slices() for t in b.column("text").to_pylist()]
    assert got == TEXTS and len(list(slices())) > 3


def test_word_encoder_equals_the_library():
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    enc = WordEncoder.load(public_tokenizers.path("word_bpe_49k.json"))
    got = []
    for b in slices():
        ids, n = enc.encode(b.column("text"))
        at = 0
        for k in n.tolist():
            got.append(ids[at : at + k].tolist())
            at += k
    assert got == [lib.encode(t or "", add_special_tokens=False).ids for t in TEXTS]


def test_piece_model_equals_the_library():
    path = public_tokenizers.path("piece_bpe_32k.model")
    lib = sentencepiece.SentencePieceProcessor(model_file=path)
    model = PieceModel.load(path)
    got = []
    for b in slices():
        ids, begins, ends, n = model.encode(b.column("text"))
        assert model.decode(ids, n).to_pylist() == [lib.decode(lib.encode(t or "")) for t in b.column("text").to_pylist()]
        at = 0
        for k, t in zip(n.tolist(), b.column("text").to_pylist(), strict=True):
            part = slice(at, at + k)
            got.append(ids[part].tolist())
            raw = (t or "").encode()
            spans = list(zip(begins[part].tolist(), ends[part].tolist(), strict=True))
            # Spans follow each other and cover the text.
            assert b"".join(raw[x:y] for x, y in spans) == raw
            at += k
    assert got == [lib.encode(t or "") for t in TEXTS]


def test_piece_spans_equal_the_librarys():
    path = public_tokenizers.path("piece_bpe_32k.model")
    lib, model = sentencepiece.SentencePieceProcessor(model_file=path), PieceModel.load(path)
    for t in TEXTS:
        t = t or ""
        _, begins, ends, _ = model.encode(pa.array([t]))
        pieces = lib.encode(t, return_type="proto").pieces
        assert list(zip(begins.tolist(), ends.tolist(), strict=True)) == [(p.begin, p.end) for p in pieces]


def test_shingles_of_slices():
    for b in slices():
        sets, n = shingle_sets(b.column("text"), 4)
        one = [shingle_sets(pa.array([t], pa.string()), 4)[0].tolist() for t in b.column("text").to_pylist()]
        assert sets.tolist() == [h for s in one for h in s] and n.tolist() == [len(s) for s in one]
