"""The space-separated pieces of many texts at once, so that each distinct piece is handled once for a whole slice of a batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are taken together up to so many bytes; a longer one is a slice of its own.
SLICE_BYTES = 4_000_000


def slices(texts: pa.Array) -> Iterator[pa.Array]:
    """``texts`` in order, nulls as empty texts."""
    texts = pc.fill_null(texts, "")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    at, base = 0, 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(ends, base + SLICE_BYTES, side="right")))
        yield texts.slice(at, end - at)
        at, base = end, int(ends[end - 1])


class Pieces:
    """``codes`` of the pieces of all texts in a row (one piece at least for each text), ``starts`` where each text's begin, and the ``distinct`` pieces by code."""

    def __init__(self, texts: pa.Array):
        parts = pc.split_pattern(texts, " ")
        found = pc.dictionary_encode(parts.flatten())
        self.codes = found.indices.to_numpy()
        self.distinct: list[str] = found.dictionary.to_pylist()
        self.sizes = pc.list_value_length(parts).to_numpy().astype(np.int64)
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes

    def texts_with(self, marked: np.ndarray, but_first: bool = False) -> np.ndarray:
        """The numbers of the texts that have a piece whose code is ``marked``, the first piece aside if so wanted."""
        if not marked.any():
            return np.zeros(0, np.int64)
        hit = marked[self.codes]
        if but_first:
            hit[self.starts] = False
        return np.flatnonzero(np.logical_or.reduceat(hit, self.starts))


def gathered(values: np.ndarray, ends: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``values`` (run k ends before ``ends[k]``) that ``codes`` name, one after another, and their lengths."""
    sizes = np.diff(ends, prepend=0)
    n = sizes[codes]
    out_ends = np.cumsum(n)
    at = np.repeat((ends - sizes)[codes] - (out_ends - n), n)
    at += np.arange(len(at))
    return values[at], n
