"""The alignment record of a block equals the walk of each text, for maps, marks and empty texts."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from test_character_map import RULES, TEXTS, model

from candleframe.llm.sentencepiece_codec import PieceModel


def plain_model():
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        return f.read()


@pytest.mark.parametrize("proto", [plain_model(), model(False, True), model(False, False)], ids=["model", "map", "map-no-prefix"])
def test_block_record_equals_the_walk(proto):
    own = PieceModel(proto)
    rng = random.Random(5)
    letters = [*RULES, "a", "b", " ", "  ", "\n", "é", "日", "▁", "x", "y", "😀"]
    texts = [*TEXTS, *("".join(rng.choices(letters, k=rng.randrange(40))) for _ in range(300)), "", "A", ""]
    whole = pa.array(["skipped", *texts], pa.large_string()).slice(1)
    normal, align, size = own.record(whole)
    at = 0
    for text, got, n in zip(texts, normal.to_pylist(), size.tolist(), strict=True):
        want, places = own.normalise(text)
        assert got == want
        assert align[at : at + n].tolist() == places.tolist()
        at += n
    assert at == len(align)


def test_only_leading_bytes_are_walked():
    own = PieceModel(model(False, True))
    starts = {k.encode()[0] for k in RULES}
    assert set(np.flatnonzero(own.leads).tolist()) == starts
    assert not PieceModel(plain_model()).leads.any()
