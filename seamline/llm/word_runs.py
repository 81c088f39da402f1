r"""Runs of repeated word sequences by difference-cover longest common extensions.

A run of period ``p`` and at least ``max(least, power * p)`` words holds a multiple of
``step(p) = max(least, power * p) - p`` as a position whose word equals the word ``p`` further on. So all runs of a
text of ``n`` words are found from the harmonic grid of those positions, in ``O(n log n)`` looks for all periods together:
each matching grid point is extended to the right and to the left. An extension compares words one by one until the
two positions reach a synchronised pair of the difference cover, at most ``COVER - 1`` words; beyond that it is a
range minimum over the common prefixes of neighbouring cover-sampled suffixes. Only those suffixes are sorted, and only
in texts where some extension gets that far. A run found by a multiple of its period has the same ends, and the
smallest period of each pair of ends is kept.

Every text is worked on whole, in the task that holds its row; no rows are exchanged. Null and empty texts and texts
without words have no run; words are compared as they are. Rows with the same ``doc_id`` are described one by one; a
null ``doc_id`` counts as a row whose words stay in place; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, ship, text_of
from .word_table import WordTable, blank_words, text_bytes

LEAST, POWER = 24, 3
# A difference cover modulo COVER; every difference is one of two of its members
COVER, MEMBERS = 31, (1, 5, 11, 24, 25, 27)
GRID_POINTS = 1 << 20  # looked at together
MOST_WORDS = 1_000_000  # a worker forgets its words beyond this number


def _meeting() -> np.ndarray:
    """For two residues, the least shift that brings both into the cover."""
    member = np.isin(np.arange(2 * COVER) % COVER, MEMBERS)
    both = np.array([[member[a:a + COVER] & member[b:b + COVER] for b in range(COVER)] for a in range(COVER)])
    return both.argmax(axis=2)


MEETING = _meeting()


class CommonExtension:
    """Longest common extensions to the right of positions of ``words`` (int64; equal numbers are equal words).

    The sequence must end in at least ``COVER`` numbers that occur nowhere else, and so must each text in it.
    """

    def __init__(self, words: np.ndarray):
        self.words = words
        n = len(words) - COVER + 1  # a class's last sample reaches into the end
        sampled = [np.arange(d, n, COVER) for d in MEMBERS]
        self.at = np.concatenate(sampled)
        self.slot = np.full(n + 1, -1, np.int64)  # place of a sampled position in ``at``
        self.slot[self.at] = np.arange(len(self.at))
        ends = np.cumsum([len(s) for s in sampled])
        self.class_end = np.repeat(ends, [len(s) for s in sampled])
        levels = [self._ranked([words[self.at + k] for k in range(COVER)])]
        while levels[-1].max(initial=-1) + 1 < len(self.at):
            levels.append(self._ranked([levels[-1], self._further(levels[-1], 1 << (len(levels) - 1))]))
        self.rank = levels[-1]
        order = np.argsort(self.rank)
        self._prefixes(levels, order[:-1], order[1:])

    @staticmethod
    def _ranked(columns: list[np.ndarray]) -> np.ndarray:
        """Rank of each row, equal rows having the same."""
        order = np.lexsort(columns[::-1])
        change = np.zeros(len(order), bool)
        for c in columns:
            change[1:] |= c[order[1:]] != c[order[:-1]]
        rank = np.empty(len(order), np.int64)
        rank[order] = np.cumsum(change)
        return rank

    def _further(self, level: np.ndarray, blocks: int) -> np.ndarray:
        """The value ``blocks`` samples further in the same class, -1 past its end."""
        to = np.arange(len(level)) + blocks
        return np.where(to < self.class_end, level[np.minimum(to, len(level) - 1)], -1)

    def _prefixes(self, levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> None:
        """Common prefixes of neighbouring sampled suffixes, and their minima over spans of 2**k."""
        a, b, common = a.copy(), b.copy(), np.zeros(len(a), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            # samples of equal rank are never the last of their class: that one is unique
            same = np.flatnonzero(levels[k][a] == levels[k][b])
            common[same] += COVER << k
            a[same] += 1 << k
            b[same] += 1 << k
        self.spans = [common + self._direct(self.at[a], self.at[b], COVER)]
        while 2 << (len(self.spans) - 1) <= len(common):
            half, last = 1 << (len(self.spans) - 1), self.spans[-1]
            self.spans.append(np.minimum(last[:-half], last[half:]))

    def _direct(self, i: np.ndarray, j: np.ndarray, most: np.ndarray | int) -> np.ndarray:
        """Number of equal words from i and j, at most ``most``."""
        out, open_ = np.zeros(len(i), np.int64), np.arange(len(i))
        limit = np.broadcast_to(most, len(i))
        step = 0
        while len(open_):
            open_ = open_[limit[open_] > step]
            open_ = open_[self.words[i[open_] + step] == self.words[j[open_] + step]]
            step += 1
            out[open_] = step
        return out

    def between(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        meet = MEETING[i % COVER, j % COVER]
        out = self._direct(i, j, meet)
        go = np.flatnonzero((out == meet) & (i != j))
        x, y = self.rank[self.slot[i[go] + meet[go]]], self.rank[self.slot[j[go] + meet[go]]]
        low, high = np.minimum(x, y), np.maximum(x, y)
        k = np.frexp((high - low).astype(np.float64))[1] - 1
        for level in np.unique(k).tolist():
            own = np.flatnonzero(k == level)
            span = self.spans[level]
            out[go[own]] += np.minimum(span[low[own]], span[high[own] - (1 << level)])
        return out


def _short(words: np.ndarray, i: np.ndarray, j: np.ndarray, room: np.ndarray, way: int) -> np.ndarray:
    """Number of equal words from i and j in one direction, as far as the cover's meeting point at most."""
    out, open_, step = np.zeros(len(i), np.int64), np.arange(len(i)), 0
    while len(open_) and step < COVER:
        open_ = open_[room[open_] > step]
        open_ = open_[words[i[open_] + way * step] == words[j[open_] + way * step]]
        step += 1
        out[open_] = step
    return out


def _grid(sizes: np.ndarray, least: int, power: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, position in it, period) of the harmonic grid, in blocks."""
    periods = np.where(sizes >= least, sizes // power, 0)
    for a in _blocks(periods):
        text = np.repeat(np.arange(a[0], a[1]), periods[a[0]:a[1]])
        p = np.arange(len(text)) - np.repeat(np.cumsum(periods[a[0]:a[1]]) - periods[a[0]:a[1]], periods[a[0]:a[1]]) + 1
        step = np.maximum(least, power * p) - p
        points = (sizes[text] - p - 1) // step + 1
        for b in _blocks(points):
            some = slice(b[0], b[1])
            of = np.repeat(np.arange(b[0], b[1]), points[some])
            nth = np.arange(len(of)) - np.repeat(np.cumsum(points[some]) - points[some], points[some])
            yield text[of], nth * step[of], p[of]


def _blocks(counts: np.ndarray) -> Iterator[tuple[int, int]]:
    """Consecutive ranges that hold about GRID_POINTS each."""
    total = np.cumsum(counts)
    at = 0
    while at < len(counts):
        base = total[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(total, base + GRID_POINTS, side="right")))
        yield at, end
        at = end


def find_runs(words: np.ndarray, first: np.ndarray, least: int = LEAST, power: int = POWER) -> np.ndarray:
    """Rows (text, start, length, period) of all runs, by text, start and period.

    ``words`` are the numbers of all texts' words, ``first`` where each text's begin (one more at the end).
    """
    sizes, found, open_ = np.diff(first), [], []
    for text, i, p in _grid(sizes, least, power):
        a = first[text] + i
        hit = np.flatnonzero(words[a] == words[a + p])
        text, i, p, a = text[hit], i[hit], p[hit], a[hit]
        right = _short(words, a, a + p, sizes[text] - i - p, 1)
        left = _short(words, a - 1, a + p - 1, i, -1)
        known = (right < COVER) & (left < COVER)
        long = known & (right + left + p >= np.maximum(least, power * p))
        found.append(np.stack([text, i - left, left + p + right, p], axis=1)[long])
        open_.append(np.stack([text, i, p], axis=1)[~known])
    rest = np.concatenate(open_) if open_ else np.empty((0, 3), np.int64)
    if len(rest):
        found.append(_extended(words, first, rest))
    runs = np.concatenate(found) if found else np.empty((0, 4), np.int64)
    runs = runs[runs[:, 2] >= np.maximum(least, power * runs[:, 3])]
    runs = runs[np.lexsort((runs[:, 3], runs[:, 2], runs[:, 1], runs[:, 0]))]
    new = np.ones(len(runs), bool)
    new[1:] = (runs[1:, :3] != runs[:-1, :3]).any(axis=1)
    runs = runs[new]
    return runs[np.lexsort((runs[:, 3], runs[:, 1], runs[:, 0]))]


def _extended(words: np.ndarray, first: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Runs through grid points that match beyond a cover's length, from the suffixes of their texts."""
    texts, number = np.unique(points[:, 0], return_inverse=True)
    sizes = np.diff(first)[texts]
    begin = np.cumsum(sizes + COVER) - sizes - COVER
    line = -1 - np.arange(int((sizes + COVER).sum()), dtype=np.int64)  # ends that occur once
    inside = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    line[np.repeat(begin, sizes) + inside] = words[np.repeat(first[texts], sizes) + inside]
    back = np.concatenate([line[::-1][COVER:], -1 - len(line) - np.arange(COVER)])
    i, p = points[:, 1], points[:, 2]
    a = begin[number] + i
    right = CommonExtension(line).between(a, a + p)
    turned = CommonExtension(back)
    left, more = np.zeros(len(a), np.int64), np.flatnonzero(i > 0)
    # position x of the line is position len(line) - COVER - 1 - x of the turned one
    left[more] = turned.between(len(line) - COVER - a[more], len(line) - COVER - a[more] - p[more])
    return np.stack([points[:, 0], i - left, left + p + right, p], axis=1)


def _joined(buf: np.ndarray, starts: np.ndarray, lengths: np.ndarray, doc: np.ndarray, texts: int) -> tuple[bytes, np.ndarray]:
    """The words of each text joined by one space, and where each text's bytes begin (one more at the end)."""
    size = lengths + 1
    to = np.cumsum(size) - size
    out = np.full(int(size.sum()), 32, np.uint8)
    inside = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[np.repeat(to, lengths) + inside] = buf[np.repeat(starts, lengths) + inside]
    return out.tobytes(), np.concatenate([[0], np.cumsum(np.bincount(doc, size, texts).astype(np.int64))])


def _describe(least: int, power: int, rearrange: bool):
    names = ["doc_id", "n_words", "n_runs", "start", "length", "period", "exponent_milli", "runs", "collapsed_sha256"]

    def one(batch: pa.RecordBatch, table: WordTable) -> pa.RecordBatch:
        buf, offsets = text_bytes(batch.column(1))
        starts, lengths, first = blank_words(buf, offsets)
        if rearrange:
            source = np.arange(len(starts))
            for k, (doc_id, n) in enumerate(zip(batch.column(0).to_pylist(), np.diff(first).tolist())):
                if n and doc_id is not None:
                    source[first[k]:first[k + 1]] += _moved(doc_id, n)
            starts, lengths = starts[source], lengths[source]
        words, _ = table.lookup(buf, starts, lengths)
        runs = find_runs(words, first, least, power)
        dropped = np.zeros(len(words) + 1, np.int64)
        at = first[runs[:, 0]] + runs[:, 1]
        np.add.at(dropped, at + runs[:, 3], 1)
        np.add.at(dropped, at + runs[:, 2], -1)
        kept = np.flatnonzero(np.cumsum(dropped)[:-1] == 0)
        doc = np.repeat(np.arange(batch.num_rows), np.diff(first))[kept]
        joined, ends = _joined(buf, starts[kept], lengths[kept], doc, batch.num_rows)
        digests = [hashlib.sha256(joined[a:max(a, b - 1)]).hexdigest() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
        own = np.searchsorted(runs[:, 0], np.arange(batch.num_rows + 1)).tolist()
        best, listed = [], []
        for a, b in zip(own[:-1], own[1:]):
            rows = runs[a:b, 1:].tolist()
            best.append(min(rows, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if rows else (None, None, None))
            listed.append([dict(zip(("start", "length", "period"), r)) for r in rows])
        columns = [[r[k] for r in best] for k in range(3)]
        milli = [None if s is None else 1000 * n // p for s, n, p in best]
        spans = pa.array(listed, pa.list_(pa.struct([(f, pa.int64()) for f in ("start", "length", "period")])))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.diff(first)), pa.array(np.diff(own).astype(np.int64)), *[pa.array(c, pa.int64()) for c in (*columns, milli)],
             spans, pa.array(digests, pa.string())], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordTable()
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                if table.n > MOST_WORDS:
                    table = WordTable()
                yield one(whole.slice(at, 256), table)

    return run


def _moved(doc_id: int, n: int) -> np.ndarray:
    """What each word's number changes by where a text's words are made to repeat, by its id."""
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return np.zeros(n, np.int64)
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i >= a, a + (i - a) % p, i) - i


def word_runs(docs: DataFrame, least: int = LEAST, power: int = POWER, rearrange: bool = False) -> DataFrame:
    """``doc_id, n_words, n_runs``, the run of the greatest exponent, ``runs`` (all of them) and ``collapsed_sha256``,
    the digest of the words that no run repeats.

    ``rearrange`` first makes the words of one text in ten repeat, by a rule on its id (for tests of the operator on
    any table).
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(
        _describe(least, power, rearrange),
        "doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
        "runs array<struct<start:long,length:long,period:long>>, collapsed_sha256 string")


def op13_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = word_runs(documents(spark, sf_dir), rearrange=True)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli",
                        F.sha2(F.concat_ws("", lines).cast("binary"), 256).alias("runs_sha256"), "collapsed_sha256")
