"""Block encoding with a ``tokenizers`` file whose pre-tokens never cross white space."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from candleframe.llm.chunks import ChunkTable, ragged

# Where a Latin letter meets one of these ASCII marks, in either order, the tokenizer's own
# pattern always cuts, so a space between them changes nothing. Other neighbours
# (apostrophes, digits, combining marks, other scripts) are left as they are.
_LETTER = r"[a-zA-Z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{ff}]"
_MARK = r"[!-&(-/:-@\[-`{-~]"
#: Chunks of text go to the library in groups of this many.
_GROUP = 1024

_loaded: dict[str, WordEncoder] = {}


class WordEncoder:
    """ids of texts, equal to ``Tokenizer.encode(text, add_special_tokens=False).ids``."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        names = self.tokenizer.get_vocab()
        self.word_end = np.zeros(max(names.values()) + 1, dtype=bool)
        self.word_end[[i for name, i in names.items() if name.endswith("</w>")]] = True
        self.chunks = ChunkTable(self._new_chunks)

    @classmethod
    def load(cls, path: str) -> WordEncoder:
        """One encoder per worker and file; its tables outlive tasks."""
        if path not in _loaded:
            _loaded[path] = cls(path)
        return _loaded[path]

    def _library(self, texts: list[str]) -> list[list[int]]:
        out = []
        for i in range(0, len(texts), _GROUP):
            out += [e.ids for e in self.tokenizer.encode_batch_fast(texts[i : i + _GROUP], add_special_tokens=False)]
        return out

    def _new_chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all chunks, number of ids of each).

        Chunks of letters alone, or of marks alone, are one word to the tokenizer, and every
        word ends with a word-end token: many of them are encoded as one text, and cut there.
        """
        texts = pa.array(chunks, pa.large_string())
        plain = pc.match_substring_regex(texts, f"^(?:{_LETTER}+|{_MARK}+)$").to_numpy(zero_copy_only=False)
        n = np.zeros(len(chunks), dtype=np.int64)
        parts, places = [], []
        at = np.flatnonzero(plain)
        for lo in range(0, len(at), _GROUP):
            group = at[lo : lo + _GROUP]
            ids = np.array(self.tokenizer.encode(" ".join([chunks[i] for i in group.tolist()]), add_special_tokens=False).ids, dtype=np.int32)
            ends = np.flatnonzero(self.word_end[ids]) + 1
            if len(ends) != len(group):
                raise ValueError("a chunk is not one word to this tokenizer")
            n[group] = np.diff(ends, prepend=0)
            parts.append(ids)
            places.append(group)
        rest = np.flatnonzero(~plain)
        found = self._library([chunks[i] for i in rest.tolist()])
        n[rest] = [len(f) for f in found]
        parts.append(np.array([i for f in found for i in f], dtype=np.int32))
        places.append(rest)
        # Back to the order of the chunks.
        order = np.concatenate(places)
        size = n[order]
        starts = np.empty(len(n), dtype=np.int64)
        starts[order] = np.cumsum(size) - size
        return np.concatenate(parts)[ragged(starts, n)], n

    @staticmethod
    def _pieces(texts: pa.Array) -> pa.ListArray:
        """Texts cut at white space and between letters and marks; A-Z are lower-cased, as in any case."""
        t = pc.ascii_lower(texts)
        t = pc.replace_substring_regex(t, f"({_LETTER})({_MARK})", r"\1 \2")
        t = pc.replace_substring_regex(t, f"({_MARK})({_LETTER})", r"\1 \2")
        return pc.ascii_split_whitespace(t)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each); NULL counts as empty.

        Texts that hold an added token's string go to the library whole: that string is
        matched before white space is looked at.
        """
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        odd = np.zeros(len(texts), dtype=bool)
        for token in self.special:
            odd |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        if not odd.any():
            return self.chunks.gather(self._pieces(texts))
        ids, n = self.chunks.gather(self._pieces(pc.if_else(pa.array(odd), "", texts)))
        pieces = np.split(ids, np.cumsum(n)[:-1])
        at = np.flatnonzero(odd)
        for i, got in zip(at, self._library(texts.take(pa.array(at)).to_pylist()), strict=True):
            pieces[i] = np.array(got, dtype=np.int32)
        return np.concatenate(pieces).astype(np.int32), np.array([len(p) for p in pieces], dtype=np.int64)
