r"""Words (runs of ``[^\x20\x09-\x0D]``) of many texts at once, in numpy and Arrow."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def joined(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in one buffer, and where each text begins
    and ends; a NULL is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.string())
    data = texts.cast(pa.large_string())
    if not len(data):
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint8), none, none
    offsets = np.frombuffer(data.buffers()[1], np.int64, len(data) + 1, data.offset * 8)
    raw = data.buffers()[2]
    buffer = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return buffer[offsets[0]:offsets[-1]], offsets[:-1] - offsets[0], offsets[1:] - offsets[0]


def lots(texts: pa.Array, most: int):
    """Index ranges of neighbouring texts of about ``most`` bytes."""
    size = np.diff(np.concatenate(([0], joined(texts)[2])))
    lot = np.cumsum(size) // most
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(lot)) + 1, [len(lot)])).tolist()
    return [(a, b) for a, b in zip(cuts[:-1], cuts[1:]) if a < b]


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All of ``start .. start + count - 1``."""
    total = int(counts.sum())
    ahead = np.cumsum(counts) - counts
    return np.arange(total) - np.repeat(ahead - starts, counts)


class WordSpans:
    """Where the words stand: ``starts`` and ``sizes`` in bytes, and for every
    text its ``first`` word and the one after its ``last``."""

    def __init__(self, data: np.ndarray, text_starts: np.ndarray, text_ends: np.ndarray):
        self.data = data
        inside = ~((data == 0x20) | ((data >= 0x09) & (data <= 0x0D)))
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        edges = text_starts[text_starts < text_ends]
        begins[edges] = inside[edges]
        self.inside = inside
        self.starts = np.flatnonzero(begins)
        # a word ends at white space or where the text ends
        n = len(self.starts)
        stops = np.concatenate((self.starts[1:], [len(data)])).astype(np.int64) if n else np.zeros(0, np.int64)
        ahead = np.concatenate(([0], np.cumsum(inside)))
        self.sizes = ahead[stops] - ahead[self.starts] if n else stops
        self.first = np.searchsorted(self.starts, text_starts)
        self.last = np.searchsorted(self.starts, text_ends)

    def coded(self) -> tuple[np.ndarray, pa.Array]:
        """A number per word, equal words alike, and the words numbered."""
        offsets = np.concatenate(([0], np.cumsum(self.sizes))).astype(np.int64)
        letters = np.ascontiguousarray(self.data[self.inside])
        words = pa.Array.from_buffers(pa.large_binary(), len(self.sizes), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
        coded = words.dictionary_encode()
        return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary

    def text_of(self, words: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The chosen words, each with a space behind, and the bytes before
        each of them (and in all)."""
        starts, sizes = self.starts[words], self.sizes[words]
        ends = np.cumsum(sizes + 1)
        out = np.full(int(ends[-1]) if len(ends) else 0, 0x20, np.uint8)
        out[spread(ends - sizes - 1, sizes)] = self.data[spread(starts, sizes)]
        return out.tobytes(), np.concatenate(([0], ends)).astype(np.int64)
