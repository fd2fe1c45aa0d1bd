"""Encoding by chunks: a text is cut where no token can cross, each distinct chunk is encoded
once per worker, and a block of texts becomes one gather over the chunk table (numpy)."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are taken in blocks of about this many bytes, however long a batch is.
BLOCK_BYTES = 3 << 20
#: A table that has grown beyond this many chunks starts anew: memory stays bounded.
MAX_CHUNKS = 300_000


def blocks(batch: pa.RecordBatch, column: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``limit`` bytes of text each, at least one row."""
    if not batch.num_rows:
        return
    place = batch.schema.get_field_index(column)
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = (np.cumsum(size) - size) // limit
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        # Copied before it is widened: a cast of a sliced string array gives kernels wrong offsets.
        text = batch.column(column).take(pa.array(np.arange(lo, hi))).cast(pa.large_string())
        yield batch.slice(lo, hi - lo).set_column(place, column, text)
        del text
        pa.default_memory_pool().release_unused()


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... for every run, one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


class Growing:
    """A numpy array that grows at its end."""

    def __init__(self, dtype):
        self.data, self.n = np.zeros(1 << 16, dtype=dtype), 0

    def extend(self, values: np.ndarray) -> None:
        need = self.n + len(values)
        if need > len(self.data):
            bigger = np.zeros(max(need, 2 * len(self.data)), dtype=self.data.dtype)
            bigger[: self.n] = self.data[: self.n]
            self.data = bigger
        self.data[self.n : need] = values
        self.n = need


class ChunkTable:
    """Token ids of every chunk seen so far; ``encode`` gives the ids of new chunks and how many each has."""

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]):
        self.encode = encode
        self.reset()

    def reset(self) -> None:
        self.rows: dict[str, int] = {}
        self.ids, self.starts, self.lengths = Growing(np.int32), Growing(np.int64), Growing(np.int64)

    def rows_of(self, chunks: list[str]) -> np.ndarray:
        """The table row of each (distinct) chunk, encoding those that are new."""
        if len(self.rows) > MAX_CHUNKS:
            self.reset()
        new = [c for c in chunks if c not in self.rows]
        if new:
            ids, n = self.encode(new)
            at = len(self.rows)
            self.starts.extend(self.ids.n + np.cumsum(n) - n)
            self.lengths.extend(n)
            self.ids.extend(ids)
            self.rows.update(zip(new, range(at, at + len(new)), strict=True))
        return np.fromiter(map(self.rows.__getitem__, chunks), np.int64, len(chunks))

    def gather(self, lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        """Lists of chunks -> (ids of all, number of ids of each list)."""
        flat = lists.flatten().dictionary_encode()
        row = self.rows_of(flat.dictionary.to_pylist())
        row = row[flat.indices.to_numpy(zero_copy_only=False)] if len(flat) else row
        n = self.lengths.data[row]
        ids = self.ids.data[ragged(self.starts.data[row], n)]
        ends = np.concatenate([[0], np.cumsum(n)])
        offsets = lists.offsets.to_numpy()
        offsets = offsets - offsets[0]
        return ids, np.diff(ends[offsets])
