"""Words, word hashes and word windows of whole batches of texts as numpy arrays."""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Masks of a little-endian 64-bit lane of which the first 0 to 8 bytes count.
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)
_ODD, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads each bit over all (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def as_texts(texts) -> pa.Array:
    return texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())


class Words:
    """The words of each text of an Arrow array: runs of anything but space, tab, line feed, vertical tab, form feed and
    carriage return, as places in the texts' bytes. A null text has no words.

    first, last: where each word starts and ends; at: for each text, its first word's index (one more at the end).
    """

    def __init__(self, texts):
        texts = as_texts(texts)
        texts = texts.fill_null("") if texts.null_count else texts
        kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
        ends = np.frombuffer(texts.buffers()[1], dtype=kind, count=texts.offset + len(texts) + 1)[texts.offset :].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
        body = texts.buffers()[2] if len(texts) else None
        size = int(ends[-1] - ends[0])
        self.raw = np.zeros(size + 8, dtype=np.uint8)
        if size:
            self.raw[:size] = np.frombuffer(body, dtype=np.uint8, count=int(ends[-1]))[ends[0] :]
        self.ends = ends - ends[0]
        inside = ~_SPACE[self.raw[:size]]
        starts, stops = inside.copy(), inside.copy()
        starts[1:] &= ~inside[:-1]
        stops[:-1] &= ~inside[1:]
        full = self.ends[:-1] < self.ends[1:]
        a, z = self.ends[:-1][full], self.ends[1:][full] - 1
        starts[a], stops[z] = inside[a], inside[z]
        self.first, self.last = np.flatnonzero(starts), np.flatnonzero(stops) + 1
        self.at = np.searchsorted(self.first, self.ends)

    def hashes(self) -> np.ndarray:
        """64 bits for each word, from its bytes eight at a time."""
        lanes = np.ndarray((len(self.raw) - 7,), dtype="<u8", buffer=self.raw, strides=(1,))
        length = self.last - self.first
        h = mix(length.astype(np.uint64) * _STEP)
        h = mix(h ^ (lanes[self.first] & _FIRST[np.minimum(length, 8)]) * _ODD)
        more, k = np.flatnonzero(length > 8), 8
        while len(more):
            left = length[more] - k
            h[more] = mix((h[more] + _STEP) ^ (lanes[self.first[more] + k] & _FIRST[np.minimum(left, 8)]) * _ODD)
            more, k = more[left > 8], k + 8
        return h


def window_hashes(h: np.ndarray, n: int, seed: int = int(_ODD)) -> np.ndarray:
    """A hash of each n consecutive word hashes, by doubling: windows of 2k from two of k."""
    if len(h) < n:
        return h[:0]
    out, have = mix(h ^ np.uint64(seed)), 1
    parts: list[tuple[np.ndarray, int]] = []
    k = n
    while True:
        if k & 1:
            parts.append((out, have))
        k >>= 1
        if not k:
            break
        out = mix(out[:-have] * np.uint64(seed | 1) + out[have:])
        have *= 2
    size = len(h) - n + 1
    if len(parts) == 1:
        return parts[0][0][:size]
    total, at = np.zeros(size, dtype=np.uint64), 0
    for a, length in parts:
        total = mix(total * np.uint64(seed | 1) + a[at : at + size])
        at += length
    return total


def within(at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of windows of n words over all texts' words together: the places of those inside one text, and how many each text has."""
    count = np.maximum(np.diff(at) - n + 1, 0)
    total = int(count.sum())
    before = np.cumsum(count) - count
    return np.repeat(at[:-1] - before, count) + np.arange(total), count


def ranges(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.diff(np.concatenate([[0], flags.view(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def give_back() -> None:
    """Returns memory that a Python worker has freed to the system, so that an idle worker is a small one."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass
