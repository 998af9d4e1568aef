"""Words and lines of a batch of texts as index arrays over their UTF-8 bytes."""

from __future__ import annotations

from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_BYTE = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class ByteView:
    """The bytes of all texts of a batch, one after the other; null texts are empty."""

    def __init__(self, texts: pa.Array):
        texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
        bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        raw = texts.buffers()[2]
        self.data = np.frombuffer(raw, np.uint8)[bounds[0] : bounds[-1]] if raw is not None and bounds[-1] > bounds[0] else np.zeros(0, np.uint8)
        self.bounds = bounds - bounds[0]
        self.docs = len(texts)

    @cached_property
    def solid(self) -> np.ndarray:
        return ~SPACE[self.data]

    @cached_property
    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and document of each word; a document's end ends a word."""
        solid = self.solid
        first = np.zeros(len(solid) + 1, bool)
        first[self.bounds] = True
        start = solid.copy()
        start[1:] &= ~solid[:-1] | first[1:-1]
        end = solid.copy()
        end[:-1] &= ~solid[1:] | first[1:-1]
        starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
        return starts, ends, np.searchsorted(self.bounds, starts, "right") - 1

    @cached_property
    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and document of each line; an empty text is one empty line."""
        breaks = np.flatnonzero(self.data == 0x0A)
        owner = np.searchsorted(self.bounds, breaks, "right") - 1
        starts = np.concatenate([self.bounds[:-1], breaks + 1])
        docs = np.concatenate([np.arange(self.docs), owner])
        order = np.lexsort((docs, starts))
        ends = np.sort(np.concatenate([self.bounds[1:], breaks]), kind="stable")
        return starts[order], ends, docs[order]

    def counts(self, mask: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """How often the mask holds within each segment."""
        running = np.zeros(len(mask) + 1, np.int64)
        np.cumsum(mask, out=running[1:])
        return running[ends] - running[starts]

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A 64-bit hash of the bytes of each of some disjoint ascending segments."""
        size = ends - starts
        out = np.zeros(len(starts), np.uint64)
        full = np.flatnonzero(size)
        if not len(full):
            return out
        size, begin = size[full], starts[full]
        first = np.concatenate([[0], np.cumsum(size)[:-1]])
        within = np.arange(int(size.sum())) - np.repeat(first, size)
        index = within + np.repeat(begin, size)
        powers = np.multiply.accumulate(np.full(int(size.max()), _MULTIPLIER))
        out[full] = np.add.reduceat(_BYTE[self.data[index]] * powers[within], first)
        return out ^ (out >> np.uint64(29))


def signs(characters: bytes) -> np.ndarray:
    """Byte -> is one of the characters."""
    table = np.zeros(256, bool)
    table[np.frombuffer(characters, np.uint8)] = True
    return table


def repeats(keys: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """True where an earlier item of the same document has the same key."""
    order = np.lexsort((keys, docs))
    same = np.zeros(len(keys), bool)
    same[order[1:]] = (keys[order[1:]] == keys[order[:-1]]) & (docs[order[1:]] == docs[order[:-1]])
    return same
