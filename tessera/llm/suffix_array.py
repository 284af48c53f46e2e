"""Suffix arrays of many strings at once, by induced sorting, and what neighbours in them share.

The text is the strings' bytes plus two, a 1 after each string and a 0 at the
end. All 1s count as different letters, so nothing is compared beyond the end
of a string. The scans of induced sorting run bucket by bucket: all that a
bucket's present entries induce is put in place at once.
"""

from __future__ import annotations

import numpy as np

END, STOP, SHIFT = 0, 1, 2


def joined(data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The text of strings that stand one after another in ``data`` (bytes), and where each begins in it."""
    starts = np.cumsum(sizes + 1) - (sizes + 1)
    text = np.zeros(int(sizes.sum()) + len(sizes) + 1, np.uint8)
    text[starts + sizes] = STOP
    at = np.ones(len(text), bool)
    at[starts + sizes] = False
    at[-1] = False
    text[at] = data + np.uint8(SHIFT)
    return text, starts


def _smaller_than_next(text: np.ndarray) -> np.ndarray:
    """True for a suffix that is smaller than the one after it; equal letters follow their right neighbour."""
    n = len(text)
    differs = np.where(text[:-1] != text[1:], np.arange(n - 1, dtype=np.int32), np.int32(n))
    at = np.minimum.accumulate(differs[::-1])[::-1]
    out = np.ones(n, bool)
    out[:-1] = (text[:-1] < text[1:])[at]
    return out


def _words(text: np.ndarray) -> np.ndarray:
    """The eight letters from each place on as one number, zeros after the end."""
    n = len(text)
    padded = np.zeros((n + 23) // 8 * 8, np.uint8)
    padded[:n] = text
    out = np.empty(len(padded) - 8, np.uint64)
    for k in range(8):
        out[k::8] = padded[k : k + len(out)].view("<u8")
    return out


class _Buckets:
    def __init__(self, text: np.ndarray, smaller: np.ndarray):
        self.text, self.smaller = text, smaller
        count = np.bincount(text, minlength=256).astype(np.int32)
        self.letters = np.flatnonzero(count).tolist()
        self.end = np.cumsum(count, dtype=np.int32)
        self.start = self.end - count

    def _dealt(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``places`` by their letters, each letter's in the given order; how many each letter has, and 0, 1, 2, ..."""
        letters = self.text[places]
        return places[np.argsort(letters, kind="stable")], np.bincount(letters, minlength=256).astype(np.int32), np.arange(len(places), dtype=np.int32)

    def induced(self, seeds: np.ndarray) -> np.ndarray:
        """The suffix array that follows from ``seeds``, the leftmost-smaller places in order (by their first letters at least)."""
        smaller, start, end = self.smaller, self.start, self.end
        out = np.zeros(len(self.text), np.int32)
        seeds, n_seeds, rank = self._dealt(seeds.astype(np.int32))
        before_seeds = end - n_seeds
        out[rank + np.repeat(before_seeds - (np.cumsum(n_seeds) - n_seeds), n_seeds)] = seeds
        fill = start.copy()

        def larger(at: np.ndarray) -> None:
            before = at[at > 0] - 1
            before = before[~smaller[before]]
            if len(before):
                before, count, rank = self._dealt(before)
                out[rank + np.repeat(fill - (np.cumsum(count, dtype=np.int32) - count), count)] = before
                np.add(fill, count, out=fill)

        for c in self.letters:
            lo = start[c]
            while lo < fill[c]:
                hi = fill[c]
                larger(out[lo:hi])
                lo = hi
            larger(out[before_seeds[c] : end[c]])
        tail = end.copy()
        tail[END] -= 1  # the end of the text, which nothing induces

        def less(at: np.ndarray) -> None:
            before = at[at > 0] - 1
            before = before[smaller[before]]
            if len(before):
                before, count, rank = self._dealt(before)
                out[np.repeat(tail - 1 + (np.cumsum(count, dtype=np.int32) - count), count) - rank] = before
                np.subtract(tail, count, out=tail)

        for c in reversed(self.letters):
            hi = end[c]
            while hi > tail[c]:
                lo = tail[c]
                less(out[lo:hi][::-1])
                hi = lo
            less(out[start[c] : fill[c]][::-1])
        return out


def _names(text: np.ndarray, places: np.ndarray, sizes: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Numbers of the substrings (place, size), given in their order: equal ones share a number, but one that begins with a stop is always new."""
    same = (sizes[1:] == sizes[:-1]) & (text[places[1:]] > STOP)
    at = np.flatnonzero(same)
    done = 0
    while len(at):
        left = sizes[at] - done
        differ = words[places[at] + done] ^ words[places[at + 1] + done]
        keep = np.where(left >= 8, np.uint64(0xFFFFFFFFFFFFFFFF), (np.uint64(1) << (np.uint64(8) * np.minimum(left, 7).astype(np.uint64))) - np.uint64(1))
        wrong = (differ & keep) != 0
        same[at[wrong]] = False
        at = at[~wrong & (left > 8)]
        done += 8
    return np.cumsum(np.append(True, ~same)) - 1


def suffix_array(text: np.ndarray) -> np.ndarray:
    """The places of ``text`` (see ``joined``) in the order of their suffixes.

    Suffixes are classified; leftmost-smaller substrings are sorted by inducing
    from any order and named; suffixes of the string of names are sorted; and
    the whole array is induced from them. The string of names is sorted by
    ranks of doubled length, each found from two of the length before: its
    letters are too many for buckets, and no string has more than a few names.
    """
    smaller = _smaller_than_next(text)
    seeds = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    if not len(seeds):
        return np.arange(len(text))[::-1].copy()
    buckets = _Buckets(text, smaller)
    first = buckets.induced(seeds)
    number = np.full(len(text), -1, np.int32)
    number[seeds] = np.arange(len(seeds), dtype=np.int32)
    order = number[first]
    order = order[order >= 0]
    sizes = np.append(np.diff(seeds), 0) + 1
    names = np.empty(len(seeds), np.int64)
    names[order] = _names(text, seeds[order], sizes[order], _words(text))
    return buckets.induced(seeds[_sorted_suffixes(names)])


def _sorted_suffixes(names: np.ndarray) -> np.ndarray:
    """The places of ``names`` in the order of their suffixes. A suffix's rank is the place of its group's first in that order; each round sorts what still shares a rank."""
    n = len(names)
    first = np.cumsum(np.bincount(names)) - np.bincount(names)
    rank = first[names]
    live = np.flatnonzero(np.bincount(names)[names] > 1)
    step = 1
    while len(live):  # all that are equal so far go on: stops have names of their own
        key = rank[live] * n + rank[live + step]
        order = np.argsort(key)
        live, key = live[order], key[order]
        old = rank[live]
        place = np.arange(len(live))
        group = np.maximum.accumulate(np.where(np.append(True, old[1:] != old[:-1]), place, 0))
        new = np.append(True, key[1:] != key[:-1])
        lead = np.maximum.accumulate(np.where(new, place, 0))
        rank[live] = old + lead - group
        live = live[~(new & np.append(new[1:], True))]
        step *= 2
    out = np.empty(n, np.int64)
    out[rank] = np.arange(n)
    return out


def common_prefixes(text: np.ndarray, array: np.ndarray) -> np.ndarray:
    """For each place of ``text``, how many letters its suffix shares with the one before it in the array; never beyond a stop.

    A place whose left neighbours agree shares one letter less than the place to
    its left; only the others are compared, eight letters at a time.
    """
    n, place = len(text), np.arange(len(text), dtype=np.int32)
    before = np.empty(n, np.int32)
    before[array[1:]] = array[:-1]
    before[array[0]] = n - 1
    stops = np.flatnonzero(text <= STOP).astype(np.int32)
    left = np.repeat(stops, np.diff(stops, prepend=-1)) - place
    own = np.ones(n, bool)
    other = before[1:]
    own[1:] = (other == 0) | (text[:-1] != text[np.maximum(other, 1) - 1]) | (text[:-1] <= STOP)
    words = _words(text)
    at = np.flatnonzero(own)
    other = before[at]
    most = np.minimum(left[at], left[other])
    shared = np.zeros(len(at), np.int64)
    live = np.flatnonzero(most > 0)
    while len(live):
        done = shared[live]
        differ = words[at[live] + done] ^ words[other[live] + done]
        low = differ & (~differ + np.uint64(1))  # the lowest bit that differs
        step = np.where(differ == 0, 8, np.log2(np.maximum(low, np.uint64(1)).astype(np.float64)).astype(np.int64) // 8)
        shared[live] = np.minimum(done + step, most[live])
        live = live[(differ == 0) & (shared[live] < most[live])]
    out = np.zeros(n, np.int32)
    out[at] = shared
    source = np.maximum.accumulate(np.where(own, place, 0))
    return np.maximum(out[source] + source - place, 0)


def least_holders(data: np.ndarray, sizes: np.ndarray, holders: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For each place of the joined text, the least holder of a string that has the ``width`` bytes from there on, and where each string begins.

    Places with fewer bytes left in their string have that string's holder.
    """
    text, starts = joined(data, sizes)
    array = suffix_array(text)
    own = np.append(np.repeat(holders, sizes + 1), np.iinfo(np.int64).max)
    groups = np.flatnonzero(common_prefixes(text, array)[array] < width)
    if not len(groups) or groups[0]:
        groups = np.append(0, groups)
    least = np.minimum.reduceat(own[array], groups)
    out = np.empty(len(text), np.int64)
    out[array] = np.repeat(least, np.diff(np.append(groups, len(text))))
    return out, starts
