"""SentencePiece encoding with the original byte span of every piece, and decoding.

Normalisation is done here, by longest prefix through the model's compiled character map,
and records for every normalised byte the original byte it comes from, for a block of texts
at once. The library then only segments already normalised chunks; each piece is projected
back through that record.
"""

from __future__ import annotations

import re
import struct
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candleframe.llm.chunks import ChunkTable, blocks, ragged
from candleframe.llm.common import ddl, free_name, ship_package, trimmed

SPACE = "▁"
#: Text of a block: its alignment record takes some ten times as much for a moment.
RECORD_BYTES = 1 << 20
#: Marks the cuts between chunks; a text that holds it is segmented whole.
_CUT = "\x01"
# Piece types and field numbers of the public model format.
_UNKNOWN, _CONTROL, _BYTE = 2, 3, 6
_PIECES, _NORMALIZER = 1, 3


def _fields(buf: bytes):
    """(field number, value, raw bytes) of a protocol buffer message's fields."""
    at = 0

    def varint():
        nonlocal at
        out = shift = 0
        while True:
            b = buf[at]
            at += 1
            out |= (b & 127) << shift
            shift += 7
            if b < 128:
                return out

    while at < len(buf):
        start = at
        tag = varint()
        kind = tag & 7
        if kind == 0:
            value = varint()
        else:
            n = {1: 8, 5: 4}.get(kind)
            n = varint() if n is None else n
            value = buf[at : at + n]
            at += n
        yield tag >> 3, value, buf[start:at]


def _length_field(number: int, body: bytes) -> bytes:
    out, n = bytearray([number << 3 | 2]), len(body)
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out) + body


class CharacterMap:
    """The compiled character map: a double-array trie from byte prefixes to replacements."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if blob else []
        self.texts = blob[4 + size :]

    def leads(self) -> np.ndarray:
        """Which first bytes begin a prefix of the map."""
        out = np.zeros(256, dtype=bool)
        if self.units:
            node = (self.units[0] >> 10) << ((self.units[0] & 512) >> 6)
            for b in range(256):
                unit = self.units[node ^ b] if node ^ b < len(self.units) else 0
                out[b] = unit != 0 and unit & 0x800000FF == b
        return out

    def longest(self, text: bytes, at: int, end: int | None = None) -> tuple[bytes, int] | None:
        """Replacement and length of the longest prefix of ``text[at:end]`` in the map."""
        if not self.units:
            return None
        units, found = self.units, None
        unit = units[0]
        node = (unit >> 10) << ((unit & 512) >> 6)
        for i in range(at, len(text) if end is None else end):
            node ^= text[i]
            unit = units[node] if node < len(units) else 0x80000000
            if unit & 0x800000FF != text[i]:
                break
            node ^= (unit >> 10) << ((unit & 512) >> 6)
            if unit >> 8 & 1:
                found = units[node] & 0x7FFFFFFF, i + 1 - at
        if found is None:
            return None
        start, n = found
        return self.texts[start : self.texts.index(0, start)], n


class PieceModel:
    """A model file: pieces, normalisation rules, and a segmenter for normalised text."""

    def __init__(self, proto: bytes):
        self.pieces: list[str] = []
        kinds, rest, norm = [], [], {}
        for number, value, raw in _fields(proto):
            if number == _PIECES:
                piece = {n: v for n, v, _ in _fields(value)}
                self.pieces.append(piece.get(1, b"").decode())
                kinds.append(piece.get(3, 1))
            if number == _NORMALIZER:
                norm = {n: v for n, v, _ in _fields(value)}
            else:
                rest.append(raw)
        self.map = CharacterMap(norm.get(2, b""))
        self.dummy_prefix = bool(norm.get(3, 1))
        self.trim_spaces = bool(norm.get(4, 1))
        escapes = bool(norm.get(5, 1))
        if not escapes:
            raise ValueError("models that do not escape white space are not supported")
        # The same model without any normalisation of its own: no dummy prefix, no trimming.
        plain = _length_field(_NORMALIZER, _length_field(1, b"identity") + b"\x18\x00\x20\x00")
        self.segmenter = sentencepiece.SentencePieceProcessor(model_proto=b"".join(rest) + plain)
        self.whole = sentencepiece.SentencePieceProcessor(model_proto=proto)
        kinds = np.array(kinds)
        self.is_byte = kinds == _BYTE
        self.special = (kinds == _UNKNOWN) | (kinds == _CONTROL)
        surface = [bytes([int(p[3:5], 16)]) if b else p.encode() for p, b in zip(self.pieces, self.is_byte, strict=True)]
        self.norm_length = np.array([len(s) for s in surface])
        self.spaces = np.array([0 if b else p.count(SPACE) for p, b in zip(self.pieces, self.is_byte, strict=True)])
        self.follows = np.array([bool(b) and 0x80 <= s[0] < 0xC0 for b, s in zip(self.is_byte, surface, strict=True)])
        out = [s.replace(SPACE.encode(), b" ") for s in surface]
        self.out_length = np.array([len(s) for s in out])
        self.out_start = np.cumsum(self.out_length) - self.out_length
        self.out_bytes = np.frombuffer(b"".join(out), np.uint8)
        # A cut before a space mark or a line end is safe if no piece has one inside.
        inside = re.compile(f"[^{SPACE}]{SPACE}|.\n|\n.", re.S)
        self.cuttable = not any(inside.search(p) for p, s in zip(self.pieces, self.special, strict=True) if not s)
        self.leads = self.map.leads()
        self.chunks = ChunkTable(self._new_chunks)

    _loaded: dict[str, PieceModel] = {}

    @classmethod
    def load(cls, path: str) -> PieceModel:
        """One model per worker and file."""
        if path not in cls._loaded:
            with open(path, "rb") as f:
                cls._loaded[path] = cls(f.read())
        return cls._loaded[path]

    def _new_chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self.segmenter.encode(chunks, num_threads=1)
        n = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.int32, int(n.sum())), n

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """Normalised text and, for each of its bytes and its end, the original byte's place."""
        raw, mark = text.encode(), SPACE.encode()
        at, n, out, align = 0, len(raw), bytearray(), []

        def step(at):
            hit = self.map.longest(raw, at)
            if hit:
                return hit
            b = raw[at]
            width = 1 if b < 0x80 else 2 if b < 0xE0 else 3 if b < 0xF0 else 4
            return raw[at : at + width], width

        if self.trim_spaces:
            while at < n:
                piece, width = step(at)
                if piece != b" ":
                    break
                at += width
        if at == n:
            return "", np.zeros(1, dtype=np.int64)
        if self.dummy_prefix:
            out += mark
            align += [at] * 3
        after_space = self.trim_spaces
        while at < n:
            piece, width = step(at)
            while after_space and piece[:1] == b" ":
                piece = piece[1:]
            if piece:
                escaped = piece.replace(b" ", mark)
                out += escaped
                align += [at] * len(escaped)
                after_space = self.trim_spaces and piece.endswith(b" ")
            at += width
        align.append(at)
        if self.trim_spaces:
            while out.endswith(mark):
                end = len(out) - 3
                del out[end:]
                del align[end + 1 :]
        return out.decode(errors="replace"), np.array(align, dtype=np.int64)

    def _segment(self, normal: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """ids of all normalised texts, and the number of each."""
        odd = pc.or_(pc.match_substring(normal, SPACE + SPACE), pc.match_substring(normal, _CUT))
        odd = odd.to_numpy(zero_copy_only=False) | (not self.cuttable)
        cut = pc.if_else(pa.array(odd), "", normal)
        cut = pc.replace_substring(cut, SPACE, _CUT + SPACE)
        cut = pc.replace_substring(cut, "\n", _CUT + "\n")
        ids, n = self.chunks.gather(pc.split_pattern(cut, _CUT))
        if odd.any():
            pieces = np.split(ids, np.cumsum(n)[:-1])
            at = np.flatnonzero(odd)
            for i, text in zip(at.tolist(), normal.take(pa.array(at)).to_pylist(), strict=True):
                pieces[i] = np.array(self.segmenter.encode(text), dtype=np.int32)
            ids, n = np.concatenate(pieces).astype(np.int32), np.array([len(p) for p in pieces], dtype=np.int64)
        return ids, n

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids, begins, ends, number of ids of each text); NULL counts as empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        normal, align, size = self._records(texts) if self.trim_spaces else self.record(texts)
        ids, n = self._segment(normal)
        width = self.norm_length[ids]
        at = np.cumsum(width)
        some = n > 0
        shift = np.repeat((at - width)[(np.cumsum(n) - n)[some]], n[some])
        offset = np.repeat((np.cumsum(size) - size)[some], n[some])
        begin, end = align[at - width - shift + offset], align[at - shift + offset]
        return ids, *self._whole_characters(ids, begin, end), n

    def _records(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """``record``, text by text: models that trim white space look at what was written before."""
        found = [self.normalise(t) for t in texts.to_pylist()]
        align = np.concatenate([a for _, a in found]) if found else np.zeros(0, np.int64)
        return pa.array([t for t, _ in found], pa.large_string()), align, np.array([len(a) for _, a in found], dtype=np.int64)

    def record(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """(normalised texts, alignment record, its size by text) of all texts at once.

        The record has, for each normalised byte and for a text's end, the place of the
        original byte it comes from. Only places where a prefix of the map can begin are walked;
        all other bytes stand for themselves.
        """
        _, offsets, data = texts.buffers()
        offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
        ends = offsets - offsets[0]
        begins_character = (data & 0xC0) != 0x80
        source = np.maximum.accumulate(np.where(begins_character, np.arange(len(data)), 0)) if len(data) else np.zeros(0, np.int64)
        out = data
        places = np.flatnonzero(self.leads[data] & begins_character)
        if len(places):
            raw, parts, from_, done = data.tobytes(), [], [], 0
            text_end = ends[np.searchsorted(ends, places, side="right")]
            for at, end in zip(places.tolist(), text_end.tolist(), strict=True):
                hit = self.map.longest(raw, at, end) if at >= done else None
                if hit:
                    parts += [data[done:at], np.frombuffer(hit[0], np.uint8)]
                    from_ += [source[done:at], np.full(len(hit[0]), at)]
                    done = at + hit[1]
            out, source = np.concatenate([*parts, data[done:]]), np.concatenate([*from_, source[done:]])
        # Spaces become marks of three bytes, and a text that has any byte gets one in front.
        text = np.searchsorted(ends, source, side="right") - 1
        filled = np.flatnonzero(np.diff(ends) > 0) if self.dummy_prefix else np.zeros(0, np.int64)
        first = np.searchsorted(text, filled)
        out, source, text = np.insert(out, first, 0x20), np.insert(source, first, ends[filled]), np.insert(text, first, filled)
        space = out == 0x20
        times = np.where(space, 3, 1)
        marks = np.flatnonzero(np.repeat(space, times)).reshape(-1, 3)
        out = np.repeat(out, times)
        out[marks] = np.frombuffer(SPACE.encode(), np.uint8)
        source, text = np.repeat(source, times), np.repeat(text, times)
        size = np.bincount(text, minlength=len(texts))
        stops = np.concatenate([[0], np.cumsum(size)])
        normal = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(stops.astype(np.int64).tobytes()), pa.py_buffer(out.tobytes()))
        align = np.insert(source - ends[text], stops[1:], np.diff(ends))
        return normal, align, size + 1

    def _whole_characters(self, ids, begin, end):
        """Byte pieces of one character: the last holds its span, the others are empty at its start."""
        follows = self.follows[ids]
        if follows.any():
            lead = np.maximum.accumulate(np.where(follows, 0, np.arange(len(ids))))
            begin = begin[lead]
            goes_on = np.append(follows[1:], False)
            end = np.where(goes_on, begin, end)
        return begin, end

    def decode(self, ids: np.ndarray, n: np.ndarray) -> pa.Array:
        """The library's ``decode`` of each document's ids."""
        width = self.out_length[ids]
        data = self.out_bytes[ragged(self.out_start[ids], width)].tobytes()
        ends = np.concatenate([[0], np.cumsum(width)])[np.cumsum(n)]
        odd = np.zeros(len(n), dtype=bool)
        doc = np.repeat(np.arange(len(n)), n)
        odd[doc[self.special[ids]]] = True
        out, lo, done = [], 0, 0
        for i, hi in enumerate(ends.tolist()):
            k = int(n[i])
            try:
                if odd[i]:
                    raise ValueError
                text = data[lo:hi].decode()
                if self.trim_spaces and text[:1] == " ":
                    raise ValueError
                text = text[1:] if self.dummy_prefix and text.startswith(" ") else text
            except ValueError:  # unknown or control ids, bytes that are no character, or spaces to trim
                text = self.whole.decode(ids[done : done + k].tolist())
            out.append(text)
            lo, done = hi, done + k
        return pa.array(out, pa.string())


def _lists(values: np.ndarray, n: np.ndarray) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))


def encode(docs: DataFrame, model: str, text: str = "text") -> DataFrame:
    """``docs`` without ``text`` but with its ids, and the byte span [begins, ends) of each.

    The spans count UTF-8 bytes of the text as given. NULL and empty texts get empty lists.
    Texts are encoded whole, block by block; other columns pass through, and those named
    ids, begins or ends are replaced. ``model``: a BPE model file readable by the workers.
    """
    ship_package(docs.sparkSession)
    rest = docs.drop(text, "ids", "begins", "ends")
    names = rest.columns
    own = free_name(names, "_text")

    def run(batches):
        pieces = PieceModel.load(model)
        for batch in batches:
            for block in blocks(batch, own, RECORD_BYTES):
                ids, begins, ends, n = pieces.encode(block.column(own))
                cols = [block.column(c) for c in names] + [_lists(v, n) for v in (ids, begins, ends)]
                yield pa.RecordBatch.from_arrays(cols, [*names, "ids", "begins", "ends"])

    ready = docs.select(*names, F.col(text).alias(own))
    return ready.mapInArrow(trimmed(run), ddl(rest, "ids array<int>", "begins array<int>", "ends array<int>"))


def decode(df: DataFrame, model: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with ``out``: the text of each row's ids; NULL ids give ''."""
    ship_package(df.sparkSession)
    rest = df.drop(out)
    names = rest.columns

    def run(batches):
        pieces = PieceModel.load(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                lists = part.column(ids)
                n = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                text = pieces.decode(lists.flatten().to_numpy(zero_copy_only=False), n)
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in names], text], [*names, out])

    return rest.mapInArrow(trimmed(run), ddl(rest, f"`{out}` string"))
