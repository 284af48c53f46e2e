"""Numbers for words and for runs of words, computed by whole arrays inside Arrow tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

SHINGLE_WORDS = 5
CACHE_WORDS = 400_000
EMPTY = np.zeros(0, np.uint64)

_PLACE = np.random.default_rng(11).integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_names: dict[bytes, int] = {}


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def numbers(words: list[bytes]) -> np.ndarray:
    """A 64-bit number for each word."""
    get = _names.get
    ids = [get(w) for w in words]
    if None in ids:
        if len(_names) > CACHE_WORDS:
            _names.clear()
        for k, w in enumerate(words):
            if ids[k] is None:
                ids[k] = xxhash.xxh64_intdigest(w, 3)
                if len(w) < 64:
                    _names[w] = ids[k]
    return np.array(ids, np.uint64)


def runs(words: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit number for each run of ``size`` word numbers, in order."""
    n = len(words) - size + 1
    return mix(sum((words[k : k + n] * _PLACE[k] for k in range(1, size)), words[:n] * _PLACE[0]) + np.uint64(size)) if n > 0 else EMPTY


def shingles(text: bytes | None) -> np.ndarray:
    """The distinct numbers of a text's runs of five words, in order; a shorter text is one run, and one without words has none."""
    words = numbers((text or b"").lower().split())
    return np.unique(runs(words, min(SHINGLE_WORDS, len(words)))) if len(words) else EMPTY


def lists(arrays: list[np.ndarray]) -> pa.ListArray:
    """An Arrow column of lists of 64-bit numbers."""
    ends = np.cumsum([0, *map(len, arrays)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([EMPTY, *arrays]).view(np.int64)))
