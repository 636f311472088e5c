"""Induced suffix sorting of a byte string, with its queues on disk.

Suffixes are induced from sorted ones: the suffix before a sorted one goes to the queue
of its first byte, and each queue receives its entries in their final order. An entry
is (place, common prefix with the entry before it); the common prefix of two induced
suffixes is one more than the least on the way between their sources. Queues keep
whole batches; what exceeds ``memory`` entries is written to files below a temporary
folder of the task and read again when its byte's turn comes, and the string itself
may be a memory-mapped file, so a shard need not fit in memory.

First the left-most smaller substrings are sorted by one induction and named; equal
names are sorted again, by pairs of names, until the order is clear as far as the
common prefixes are asked for; a second induction then sorts all suffixes.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np


class Queues:
    """One first-in first-out queue a byte; its batches move to disk beyond a bound."""

    def __init__(self, folder: str, memory: int):
        self._folder, self._memory, self._held = folder, memory, 0
        self._batches: list[list] = [[] for _ in range(256)]
        self._files = 0

    def push(self, byte: int, places: np.ndarray, common: np.ndarray) -> None:
        batch = np.stack((places, common))
        self._batches[byte].append(batch)
        self._held += len(places)
        if self._held > self._memory:
            self._spill()

    def _spill(self) -> None:
        for own in self._batches:
            for i, b in enumerate(own):
                if not isinstance(b, str):
                    name = os.path.join(self._folder, f"{self._files}.npy")
                    self._files += 1
                    np.save(name, b)
                    own[i] = name
        self._held = 0

    def pop(self, byte: int) -> np.ndarray | None:
        """All batches that have come for ``byte`` so far."""
        own, self._batches[byte] = self._batches[byte], []
        if not own:
            return None
        got = []
        for b in own:
            if isinstance(b, str):
                got.append(np.load(b))
                os.unlink(b)
            else:
                self._held -= b.shape[1]
                got.append(b)
        return got[0] if len(got) == 1 else np.concatenate(got, axis=1)


def smaller_types(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one (the last byte is a unique least one)."""
    n = len(text)
    change = np.flatnonzero(text[1:] != text[:-1])
    ends = np.append(change, n - 1)
    rising = np.append(text[change + 1] > text[change], True)
    return np.repeat(rising, np.diff(ends, prepend=-1))


def eight_bytes(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one little-endian number (0 beyond the end)."""
    padded = np.concatenate((text, np.zeros(8, dtype=np.uint8)))
    return np.ndarray(len(text), dtype="<u8", buffer=padded.data, strides=(1,)).copy()


def _runs_least(common: np.ndarray, group: np.ndarray) -> np.ndarray:
    """For entries at ``group`` (ascending) the least common value since the one before; the first: since 0."""
    begins = np.append(0, group[:-1] + 1)
    return np.minimum.reduceat(common, np.stack((begins, np.minimum(group + 1, len(common) - 1))).T.ravel()[:-1] if group[-1] + 1 >= len(common) else np.stack((begins, group + 1)).T.ravel())[::2]


def _induce(text: np.ndarray, words: np.ndarray, smaller: np.ndarray, seeds: np.ndarray, seed_common: np.ndarray | None, cap: int, folder: str, memory: int):
    """Sort by induction from ``seeds`` (sorted). Returns places and common prefixes by byte.

    Without ``seed_common`` only the order is worked out; all common values are 0.

    The common value of an entry is with the one before it in its queue; where two
    queues meet (larger and smaller suffixes of a byte) it is set by the caller.
    """
    first = text[seeds]
    cuts = np.searchsorted(first, np.arange(257))
    counted = seed_common is not None
    if not counted:
        seed_common = np.zeros(len(seeds), dtype=np.int32)

    def spread(queues: Queues, batch: np.ndarray, keep: np.ndarray, low: np.ndarray, seen: np.ndarray) -> None:
        """Push the predecessors (``keep``) of a batch; ``low``: least common value since a byte's last push."""
        at = np.flatnonzero(keep)
        if not counted:
            if len(at):
                before = batch[0][at] - 1
                byte = text[before]
                before = before[np.argsort(byte, kind="stable")]
                found, sizes = np.unique(byte, return_counts=True)
                for b, own in zip(found.tolist(), np.split(before, np.cumsum(sizes)[:-1]), strict=True):
                    queues.push(b, own, np.zeros(len(own), dtype=np.int32))
            return
        common = batch[1]
        if len(at):
            before = batch[0][at] - 1
            byte = text[before]
            order = np.argsort(byte, kind="stable")
            at, before, byte = at[order], before[order], byte[order]
            edges = np.append(np.flatnonzero(np.diff(byte, prepend=-1)), len(byte))
        np_low = int(common.min())
        touched = []
        if len(at):
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                b = int(byte[lo])
                own = at[lo:hi]
                least = _runs_least(common, own)
                least[0] = min(least[0], low[b]) if seen[b] else 0
                queues.push(b, before[lo:hi], np.minimum(least + 1, cap) if seen[b] else np.append(0, np.minimum(least[1:] + 1, cap)))
                seen[b] = True
                tail = common[own[-1] + 1 :]
                touched.append((b, int(tail.min()) if len(tail) else cap))
        np.minimum(low, np_low, out=low)
        for b, value in touched:
            low[b] = value

    # larger suffixes, in ascending order
    queues = Queues(folder, memory)
    larger: list[np.ndarray] = []
    seen = np.zeros(256, dtype=bool)
    low = np.zeros(256, dtype=np.int32)
    for c in range(256):
        rows = []
        low[:] = 0
        while (batch := queues.pop(c)) is not None:
            rows.append(batch)
            i = batch[0]
            spread(queues, batch, (i > 0) & (text[i - 1] >= c) & ~smaller[i - 1], low, seen)
        own = slice(cuts[c], cuts[c + 1])
        if own.start < own.stop:
            batch = np.stack((seeds[own], seed_common[own]))
            batch[1, 0] = 0
            i = batch[0]
            if rows:  # where larger and smaller suffixes meet
                batch[1, 0] = _common(text, words, rows[-1][0][-1:], i[:1], cap)[0] if counted else 0
            spread(queues, batch, (i > 0) & ~smaller[i - 1], low, seen)
        larger.append(np.concatenate(rows, axis=1) if rows else np.zeros((2, 0), np.int32))
    # smaller suffixes, in descending order; here a common value is with the entry after
    queues = Queues(folder, memory)
    less: list[np.ndarray] = [np.zeros((2, 0), np.int32)] * 256
    seen[:] = False
    for c in range(255, -1, -1):
        rows = []
        low[:] = 0
        while (batch := queues.pop(c)) is not None:
            rows.append(batch)
            i = batch[0]
            spread(queues, batch, (i > 0) & smaller[i - 1] & (text[i - 1] <= c), low, seen)
        if rows:
            less[c] = np.concatenate(rows, axis=1)
        own = larger[c]
        if own.shape[1]:
            down = own[:, ::-1].copy()
            i = down[0]
            down[1] = np.append(_common(text, words, rows[-1][0][-1:], i[:1], cap)[0] if counted and rows else 0, own[1][:0:-1])
            spread(queues, down, (i > 0) & smaller[i - 1], low, seen)
    return larger, less


def _common(text: np.ndarray, words: np.ndarray, a: np.ndarray, b: np.ndarray, cap: int) -> np.ndarray:
    """Common prefix of the suffixes at ``a`` and ``b``, at most ``cap``, eight bytes at a time."""
    n = len(text)
    room = np.minimum(cap, n - np.maximum(a, b)).astype(np.int32)
    out = np.zeros(len(a), dtype=np.int32)
    open_ = np.arange(len(a))
    for k in range(0, cap, 8):
        differ = words[np.minimum(a[open_] + k, n - 1)] ^ words[np.minimum(b[open_] + k, n - 1)]
        low = differ & (~differ + np.uint64(1))  # the lowest bit in which they differ
        size = np.where(differ == 0, 8, np.log2(np.maximum(low, np.uint64(1)).astype(np.float64)).astype(np.int32) // 8)
        out[open_] = np.minimum(k + size, room[open_])
        open_ = open_[(differ == 0) & (k + 8 < room[open_])]
        if not len(open_):
            break
    return out


def suffix_order(text: np.ndarray, cap: int, memory: int = 4_000_000) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of ``text`` sorted by their first ``cap`` bytes at least, and the common
    prefix of each with the one before it (at most ``cap``).

    ``text`` ends with a byte 0, the only one in it. Suffixes that agree for ``cap`` bytes
    may be in any order.
    """
    n = len(text)
    if n <= 1:
        return np.arange(n), np.zeros(n, np.int32)
    words = eight_bytes(text)
    smaller = smaller_types(text)
    lms = (np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1).astype(np.int32)
    with tempfile.TemporaryDirectory(prefix="induced-") as folder:
        if len(lms) > 1:
            seeds = lms[np.argsort(text[lms], kind="stable")]
            larger, less = _induce(text, words, smaller, seeds, None, cap, folder, memory)
            is_lms = np.zeros(n, dtype=bool)
            is_lms[lms] = True
            found = np.concatenate([np.append(a[0], b[0][::-1]) for a, b in zip(larger, less, strict=True)])
            found = found[is_lms[found]]
            if len(found) < len(lms):  # not induced: the last one
                found = np.concatenate((np.setdiff1d(lms, found, assume_unique=True), found))
            lms_sorted = _sort_named(text, words, lms, found, cap)
        else:
            lms_sorted = lms if len(lms) else np.array([n - 1], dtype=np.int32)
        common = np.zeros(len(lms_sorted), dtype=np.int32)
        common[1:] = _common(text, words, lms_sorted[:-1], lms_sorted[1:], cap)
        larger, less = _induce(text, words, smaller, lms_sorted, common, cap, folder, memory)
    places, values = [], []
    have = np.zeros(n, dtype=bool)
    for c in range(256):
        up, down = larger[c], less[c][:, ::-1]
        if down.shape[1]:
            # values of the smaller ones are with the entry after: move them by one
            down = np.stack((down[0], np.append(0, down[1][:-1])))
        row = [up, down]
        if up.shape[1] and down.shape[1]:
            down[1, 0] = _common(text, words, up[0][-1:], down[0][:1], cap)[0]
        for part in row:
            places.append(part[0])
            values.append(part[1])
    order, value = np.concatenate(places), np.concatenate(values)
    have[order] = True
    if not have.all():  # only the final byte is never induced
        rest = np.flatnonzero(~have)
        order, value = np.append(rest, order), np.append(np.zeros(len(rest), np.int32), value)
    return order, value


def _sort_named(text: np.ndarray, words: np.ndarray, lms: np.ndarray, found: np.ndarray, cap: int) -> np.ndarray:
    """Suffixes at the left-most smaller places, sorted: ``found`` has their substrings in order."""
    n = len(lms)
    size = np.minimum(np.append(lms[1:], len(text) - 1) - lms + 1, cap + 1)
    rank_of = np.zeros(len(text), dtype=np.int32)
    rank_of[lms] = np.arange(n, dtype=np.int32)
    mine = rank_of[found]
    # equal neighbours have equal lengths and bytes
    differs = np.ones(n, dtype=bool)
    sizes = size[mine]
    candidates = np.flatnonzero(sizes[1:] == sizes[:-1])
    agree = _common(text, words, found[candidates], found[candidates + 1], cap + 1) >= sizes[candidates]
    differs[candidates[agree] + 1] = False
    # a name is the place of its first bearer in the order
    order = mine
    name = np.zeros(n, dtype=np.int64)
    name[order] = np.maximum.accumulate(np.where(differs, np.arange(n), 0))
    step = 1
    # each substring moves on by two bytes at least
    while not differs.all() and 2 * step <= cap + 1:
        first = np.flatnonzero(differs)
        tied = np.repeat(np.diff(np.append(first, n)) > 1, np.diff(np.append(first, n)))
        at = np.flatnonzero(tied)
        own = order[at]
        after = np.where(own + step < n, name[np.minimum(own + step, n - 1)] + 1, 0)
        key = name[own] * (n + 1) + after
        turn = np.argsort(key)
        order[at] = own[turn]
        key = key[turn]
        differs[at] = np.append(True, key[1:] != key[:-1])
        new = np.maximum.accumulate(np.where(differs, np.arange(n), 0))
        name[order[at]] = new[at]
        step *= 2
    return lms[order]
