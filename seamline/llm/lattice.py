"""Segmentation lattices of words over a fixed set of pieces, for many words at once.

A word's lattice has a state for each byte position and an arc for each piece that occurs there.
``walk`` visits the arcs in the order of their first state, for all words at once; what is
carried along them (a shortest path, a sum over all paths) is up to the caller.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from .word_table import SHORT, WordTable


def read_pieces(path: str) -> tuple[list[str], list[float], list[int], list[int]]:
    """Pieces of a sentencepiece model with their scores, the ids of bytes 0 to 255, and the ids of control pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    control = [i for i in ids if model.is_control(i) or model.is_unknown(i) or model.is_unused(i)]
    at_byte = [i for i in ids if model.is_byte(i)]
    return [model.id_to_piece(i) for i in ids], [model.get_score(i) for i in ids], at_byte, control


class Lattices:
    """Arcs of words: pieces are byte strings, the space of a piece being byte 32."""

    def __init__(self, pieces: dict[bytes, int]):
        self.table, self.values = WordTable(18), np.empty(len(pieces), np.int64)
        self.most = max(map(len, pieces))
        buf = np.frombuffer(b"".join(pieces) + bytes(16), np.uint8).copy()
        lengths = np.fromiter(map(len, pieces), np.int64)
        numbers, _ = self.table.lookup(buf, np.cumsum(lengths) - lengths, lengths)
        self.values[numbers] = np.fromiter(pieces.values(), np.int64)
        self.heads = np.unique(np.frombuffer(b"".join(p[:8] for p in pieces if len(p) > SHORT), "<u8"))  # of the long pieces

    def pieces_at(self, buf: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Numbers of the pieces of every length (first axis, from 1) at every start, -1 where there is none."""
        out = np.full((self.most, len(starts)), -1, np.int64)
        known = self.table
        view = np.ndarray((len(buf) - 7,), "<u8", buffer=buf, strides=(1,))
        low, high = view[starts], view[starts + 8]
        for n in range(1, min(self.most, SHORT) + 1):
            at = np.flatnonzero(lengths >= n)
            out[n - 1, at] = self._find(low[at], high[at], n)
        may = np.flatnonzero((lengths > SHORT) & np.isin(low, self.heads))
        for n in range(SHORT + 1, self.most + 1):
            for k in may[lengths[may] >= n].tolist():
                out[n - 1, k] = known.long.get(buf[starts[k]:starts[k] + n].tobytes(), -1)
        out[out >= 0] = self.values[out[out >= 0]]
        return out

    def _find(self, low: np.ndarray, high: np.ndarray, n: int) -> np.ndarray:
        """Numbers of words of ``n`` bytes, -1 for those that the table lacks."""
        known = self.table
        low = low & np.uint64((1 << (8 * min(n, 8))) - 1)
        high = (high & np.uint64((1 << (8 * max(n - 8, 0))) - 1)) | np.uint64((n + 1) << 56)
        slot, mask = known._slot(low, high), (1 << known.bits) - 1
        out, open_ = np.full(len(low), -1, np.int64), np.arange(len(low))
        while len(open_):
            have = known.slots[slot[open_]]
            hit = (have >= 0) & (known.low[have] == low[open_]) & (known.high[have] == high[open_])
            out[open_[hit]] = have[hit]
            open_ = open_[(have >= 0) & ~hit]
            slot[open_] = (slot[open_] + 1) & mask
        return out

    def walk(self, buf: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(position, length, words, pieces) of all arcs; words must be sorted by length, longest first."""
        yield from self.walk_window(buf, starts, lengths, int(lengths[0]) if len(lengths) else 0)

    def walk_window(self, buf: np.ndarray, starts: np.ndarray, lengths: np.ndarray, window: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """The arcs of ``walk`` that start at the first ``window`` positions; they may end beyond."""
        inner = np.minimum(lengths, window)
        total = int(inner.sum())
        begin = np.cumsum(inner) - inner
        spot = np.repeat(starts - begin, inner) + np.arange(total)
        left = np.repeat(begin + lengths, inner) - np.arange(total)
        pieces = self.pieces_at(buf, spot, left)
        for i in range(int(inner[0]) if len(inner) else 0):
            have = np.searchsorted(-inner, -i)  # words longer than i
            here = pieces[:, begin[:have] + i]
            for n in range(1, self.most + 1):
                words = np.flatnonzero(here[n - 1] >= 0)
                if len(words):
                    yield i, n, words, here[n - 1, words]
