"""Words of Arrow string batches, cut and numbered with numpy.

A word of up to 15 bytes is its own key (its bytes and its length in two 64-bit numbers), so two
words never share a number; longer ones are kept in a dict. Work per word is a few array steps,
and only words not seen before reach Python code.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SHORT = 15
_MASK = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1] * 9, np.uint64)
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93))


def text_bytes(texts: pa.Array, fold: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts (null: empty), 16 zero bytes after them, and where each text starts."""
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None and len(data) else np.empty(0, np.uint8)
    buf = np.zeros(len(raw) + 16, np.uint8)
    buf[:len(raw)] = raw if fold is None else fold[raw]
    return buf, offsets - offsets[0]


def spaced_chunks(buf: np.ndarray, offsets: np.ndarray, runs: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chunks that start at a text's start or a space (with ``runs``: the first of some spaces).

    Returns starts, lengths and the number of the first chunk of each text (one more at the end).
    """
    space = buf[:offsets[-1]] == 32
    if runs:
        space[1:] &= ~(buf[:max(0, offsets[-1] - 1)] == 32)
    space[offsets[:-1][np.diff(offsets) > 0]] = True
    starts = np.flatnonzero(space)
    return starts, np.diff(starts, append=offsets[-1]), np.searchsorted(starts, offsets)


def blank_words(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    r"""Words ``[^\x20\x09-\x0D]+``: starts, lengths, number of the first word of each text (and the end)."""
    body = buf[:offsets[-1]]
    word = ~((body == 32) | ((body >= 9) & (body <= 13)))
    first = word.copy()
    first[1:] &= ~word[:-1]
    cuts = offsets[:-1][np.diff(offsets) > 0]
    first[cuts] = word[cuts]
    last = word.copy()
    last[:-1] &= ~word[1:]
    ends = cuts[cuts > 0] - 1
    last[ends] = word[ends]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1 - starts, np.searchsorted(starts, offsets)


LOWER_ASCII = np.arange(256, dtype=np.uint8)
LOWER_ASCII[65:91] += 32


class WordTable:
    """Numbers words from 0 in the order they are first seen."""

    def __init__(self, bits: int = 16):
        self.n = 0
        self.long: dict[bytes, int] = {}
        self.low, self.high = np.empty(1 << bits, np.uint64), np.empty(1 << bits, np.uint64)
        self._slots(bits + 1)

    def _slots(self, bits: int) -> None:
        self.bits, self.slots = bits, np.full(1 << bits, -1, np.int32)

    def _slot(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        mixed = (low * _MIX[0]) ^ (high * _MIX[1])
        mixed ^= mixed >> np.uint64(29)
        return ((mixed * _MIX[2]) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _insert(self, numbers: np.ndarray) -> None:
        slot, mask = self._slot(self.low[numbers], self.high[numbers]), (1 << self.bits) - 1
        while len(numbers):
            taker = np.zeros(len(numbers), bool)
            taker[np.unique(slot, return_index=True)[1]] = True
            taker &= self.slots[slot] < 0
            self.slots[slot[taker]] = numbers[taker]
            numbers, slot = numbers[~taker], (slot[~taker] + 1) & mask

    def _room(self, more: int) -> None:
        if self.n + more > len(self.low):
            size = 1 << int(self.n + more).bit_length()
            for name in ("low", "high"):
                wider = np.zeros(size, np.uint64)
                wider[:self.n] = getattr(self, name)[:self.n]
                setattr(self, name, wider)
            self._slots(size.bit_length())
            self._insert(np.flatnonzero(self.high[:self.n] != 0) if self.n else np.empty(0, np.int64))

    def lookup(self, buf: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words, and for each new number in order where in ``starts`` its word is."""
        view = np.ndarray((len(buf) - 7,), "<u8", buffer=buf, strides=(1,))
        out = np.full(len(starts), -1, np.int64)
        short = np.flatnonzero(lengths <= SHORT)
        size = lengths[short]
        low = view[starts[short]] & _MASK[size]
        high = (view[starts[short] + 8] & _MASK[np.maximum(size - 8, 0)]) | ((size + 1).astype(np.uint64) << np.uint64(56))
        slot, mask = self._slot(low, high), (1 << self.bits) - 1
        open_, missing = np.arange(len(short)), []
        while len(open_):
            have = self.slots[slot[open_]]
            empty = have < 0
            missing.append(open_[empty])
            hit = ~empty & (self.low[have] == low[open_]) & (self.high[have] == high[open_])
            out[short[open_[hit]]] = have[hit]
            open_ = open_[~empty & ~hit]
            slot[open_] = (slot[open_] + 1) & mask
        new: list[np.ndarray] = []
        miss = np.concatenate(missing) if missing else np.empty(0, np.int64)
        if len(miss):
            order = miss[np.lexsort((miss, high[miss], low[miss]))]
            fresh = np.ones(len(order), bool)
            fresh[1:] = (low[order[1:]] != low[order[:-1]]) | (high[order[1:]] != high[order[:-1]])
            first = order[fresh]
            self._room(len(first))
            numbers = self.n + np.arange(len(first))
            self.low[numbers], self.high[numbers] = low[first], high[first]
            self.n += len(first)
            self._insert(numbers)
            out[short[order]] = numbers[np.cumsum(fresh) - 1]
            new.append(short[first])
        for k in np.flatnonzero(lengths > SHORT).tolist():
            word = buf[starts[k]:starts[k] + lengths[k]].tobytes()
            number = self.long.get(word)
            if number is None:
                self._room(1)
                number = self.long[word] = self.n
                self.low[number] = self.high[number] = 0
                self.n += 1
                new.append(np.array([k]))
            out[k] = number
        return out, np.concatenate(new) if new else np.empty(0, np.int64)


class Lists:
    """A list of 32-bit integers for each number, in one flat array."""

    def __init__(self):
        self.at, self.size, self.flat, self.used = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64), np.zeros(1 << 18, np.int32), 0

    def put(self, numbers: np.ndarray, sizes: np.ndarray, values: np.ndarray) -> None:
        if len(numbers) and (top := int(numbers.max()) + 1) > len(self.at):
            self.at, self.size = (np.concatenate([a, np.zeros(max(top, 2 * len(a)) - len(a), np.int64)]) for a in (self.at, self.size))
        if self.used + len(values) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(len(values), len(self.flat)), np.int32)])
        self.flat[self.used:self.used + len(values)] = values
        self.at[numbers], self.size[numbers] = self.used + np.cumsum(sizes) - sizes, sizes
        self.used += len(values)

    def get(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lists of some numbers one after the other, and the size of each."""
        sizes = self.size[numbers]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.repeat(self.at[numbers] - ends + sizes, sizes) + np.arange(total)], sizes
