r"""Alignment of two tokenizers by lockstep merging.

The texts of a batch are encoded by both tokenizers. One NumPy state vector holds, for every text, a pointer into its
A tokens and one into its B tokens. Each step links the two tokens that the pointers name, cuts where both end at the
same byte, and moves on whichever pointer's token ends first (both at a cut); texts that are done leave the vector. A long
text enters as several lanes, each beginning after a common end near every ``LANE`` tokens. The tokens between two cuts are a group.

All A and B tokens of a group are linked. Where a group has one token on a side, those are the links of the steps; the
products of the other groups are added, in a group of many tokens by distinct ids and how often they occur. A document is
reduced to its distinct id pairs and their numbers of links, a block of documents to its distinct pairs; the counts
over the corpus are aggregated from blocks and return to them, so no row per link is ever exchanged, and a pair that
all documents hold has a row per block.

Null and empty texts, and texts that one tokenizer changes (its tokens' bytes are not those of a space and the text),
have no tokens. Rows with the same ``doc_id`` are documents of their own; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .chunk_encode import ChunkEncoder
from .common import Scratch, documents, ship, text_of
from .lattice import read_pieces
from .word_table import Lists, WordTable, spaced_chunks, text_bytes

LANE = 2048
BLOCK_BYTES, BLOCK_DOCS = 2 << 20, 4096
MOST_CHUNKS = 300_000  # a worker forgets its chunks beyond this number
WIDE = 1024  # links of a group that are listed one by one


class TokenBytes:
    """The bytes of every token of a vocabulary."""

    def __init__(self, tokens: list[bytes]):
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.at = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        size = self.size[ids]
        begin = np.cumsum(size) - size
        return self.flat[np.repeat(self.at[ids] - begin, size) + np.arange(int(size.sum()))]


def byte_level_bytes(path: str) -> TokenBytes:
    """Entries of a byte-level vocabulary: printable bytes stand for themselves, the others for 256, 257, ... in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    entries = dict(spec["model"]["vocab"])
    out = [b""] * (max(entries.values()) + 1)
    for token, k in entries.items():
        out[k] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
    return TokenBytes(out)


def piece_bytes(path: str) -> TokenBytes:
    pieces, _, at_byte, _ = read_pieces(path)
    out = [p.replace("▁", " ").encode() for p in pieces]
    for k in at_byte:
        out[k] = bytes([int(pieces[k][1:-1], 16)])
    return TokenBytes(out)


class PieceChunks:
    """Ids of a sentencepiece vocabulary that keeps white space, each distinct chunk encoded once.

    A chunk begins at the first of some spaces. No piece goes on from another character to a space, so no merge
    crosses the start of a chunk; a vocabulary that has such pieces encodes whole texts.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.local = not any("▁" in self.model.id_to_piece(k).lstrip("▁") for k in range(self.model.get_piece_size()))
        self.space = self.model.piece_to_id("▁")
        self.reset()

    def reset(self) -> None:
        self.chunks, self.ids = WordTable(), Lists()

    def _ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts that a space precedes, and how many each has."""
        lists = self.model.encode(texts, num_threads=1)
        lists = [x if t else [self.space] for x, t in zip(lists, texts)]
        return np.fromiter(chain.from_iterable(lists), np.int64), np.fromiter(map(len, lists), np.int64, len(lists))

    def encode(self, spaced: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of texts that begin with a space, and where each text's begin (one more at the end)."""
        buf, offsets = text_bytes(spaced)
        if not self.local:
            flat, sizes = self._ids([t[1:] for t in spaced.to_pylist()])
            return flat, np.concatenate([[0], np.cumsum(sizes)])
        if self.chunks.n > MOST_CHUNKS:
            self.reset()
        starts, lengths, first = spaced_chunks(buf, offsets, runs=True)
        before = self.chunks.n
        numbers, new = self.chunks.lookup(buf, starts, lengths)
        raw = buf.tobytes()
        for at in range(0, len(new), 20_000):
            some = new[at:at + 20_000]
            flat, sizes = self._ids([raw[a + 1:a + n].decode() for a, n in zip(starts[some].tolist(), lengths[some].tolist())])
            self.ids.put(before + np.arange(at, at + len(some)), sizes, flat)
        flat, sizes = self.ids.get(numbers)
        return flat.astype(np.int64), np.concatenate([[0], np.cumsum(sizes)])[first]


class Aligner:
    """Encodes and aligns batches of texts."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.a_bytes = ChunkEncoder.get(a_path, True), byte_level_bytes(a_path)
        self.b, self.b_bytes = PieceChunks(b_path), piece_bytes(b_path)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of A, where each text's begin (one more at the end), and the same of B, without the texts that have no tokens."""
        if self.a.words.n > MOST_CHUNKS:
            self.a.reset()
        spaced = pc.binary_join_element_wise(pa.scalar("", texts.type), texts.fill_null(""), pa.scalar(" ", texts.type))
        flat, ends = self.a.encode(spaced, 0)
        inner = np.ones(len(flat), bool)
        inner[ends[1:] - 1] = False  # the encoder's end ids
        a, a_first = flat[inner].astype(np.int64), ends - np.arange(len(ends))
        b, b_first = self.b.encode(spaced)
        raw, offsets = text_bytes(spaced)
        good = np.diff(offsets) > 1
        for ids, first, known in ((a, a_first, self.a_bytes), (b, b_first, self.b_bytes)):
            good &= self._same(known, ids, first, raw, offsets)
        (a, a_first), (b, b_first) = self._only(good, a, a_first), self._only(good, b, b_first)
        return a, a_first, b, b_first

    @staticmethod
    def _same(known: TokenBytes, ids: np.ndarray, first: np.ndarray, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Which texts' tokens have exactly the text's bytes."""
        size = np.concatenate([[0], np.cumsum(known.size[ids])])[first]
        joined = known.joined(ids)
        if np.array_equal(size, offsets) and np.array_equal(joined, raw[:offsets[-1]]):
            return np.ones(len(first) - 1, bool)
        return np.array([np.array_equal(joined[a:b], raw[c:d]) for a, b, c, d in zip(size[:-1], size[1:], offsets[:-1], offsets[1:])], bool)

    @staticmethod
    def _only(good: np.ndarray, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        count = np.diff(first)
        return ids[np.repeat(good, count)], np.concatenate([[0], np.cumsum(np.where(good, count, 0))])


def _lanes(a_end: np.ndarray, b_end: np.ndarray, a_first: np.ndarray, b_first: np.ndarray, lane: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the lanes begin in A and B, and where each ends in A."""
    have = np.diff(a_first) > 0
    count = np.diff(a_first) // lane
    inside = np.repeat(a_first[:-1], count) + lane * (1 + np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count))
    last = np.repeat(a_first[1:], count)
    inside, last = inside[inside < last], last[inside < last]
    begin = []
    for _ in range(lane):  # the first common end from there on; the lane before takes all where there is none near
        to = np.searchsorted(b_end, a_end[inside])
        meets = (b_end[to] == a_end[inside]) & (inside + 1 < last)
        begin.append((inside[meets] + 1, to[meets] + 1))
        inside, last = inside[~meets] + 1, last[~meets]
        inside, last = inside[inside < last], last[inside < last]
        if not len(inside):
            break
    a = np.concatenate([a_first[:-1][have], *[x for x, _ in begin]])
    b = np.concatenate([b_first[:-1][have], *[y for _, y in begin]])
    order = np.argsort(a, kind="stable")
    a, b = a[order], b[order]
    return a, b, np.append(a[1:], a_first[-1])


def lockstep(a_end: np.ndarray, b_end: np.ndarray, a_first: np.ndarray, b_first: np.ndarray, lane: int = LANE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links (A token, B token) of all texts and which of them end in a cut, by A token and B token.

    ``a_end`` and ``b_end`` are the tokens' ends in the bytes of all texts one after the other.
    """
    a, b, stop = _lanes(a_end, b_end, a_first, b_first, lane)
    links_a, links_b, cuts = [], [], []
    while len(a):
        x, y = a_end[a], b_end[b]
        cut = x == y
        links_a.append(a)
        links_b.append(b)
        cuts.append(cut)
        a, b = a + (x <= y), b + (y <= x)
        going = a < stop
        if not going.all():
            a, b, stop = a[going], b[going], stop[going]
    if not cuts:
        return (np.empty(0, np.int64),) * 2 + (np.empty(0, bool),)
    link_a, link_b, cut = np.concatenate(links_a), np.concatenate(links_b), np.concatenate(cuts)
    order = np.argsort(link_a + link_b, kind="stable")  # a step moves one pointer or both, so the sums are distinct
    return link_a[order], link_b[order], cut[order]


def group_links(a: np.ndarray, b: np.ndarray, link_a: np.ndarray, link_b: np.ndarray, a_from: np.ndarray, b_from: np.ndarray,
                a_to: np.ndarray, b_to: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, id pair, number of links) of all links within groups; a pair may come several times."""
    na, nb = a_to - a_from, b_to - b_from
    of = np.searchsorted(a_to, link_a, side="right")
    single = (np.minimum(na, nb) == 1)[of]
    groups, pairs, times = [of[single]], [a[link_a[single]] << 16 | b[link_b[single]]], [np.ones(int(single.sum()), np.int64)]
    wide = np.minimum(na, nb) > 1
    some = np.flatnonzero(wide & (na * nb <= WIDE))
    size = (na * nb)[some]
    of = np.repeat(some, size)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size)
    groups.append(of)
    pairs.append(a[a_from[of] + nth // nb[of]] << 16 | b[b_from[of] + nth % nb[of]])
    times.append(np.ones(len(of), np.int64))
    for g in np.flatnonzero(wide & (na * nb > WIDE)).tolist():
        x, nx = np.unique(a[a_from[g]:a_to[g]], return_counts=True)
        y, ny = np.unique(b[b_from[g]:b_to[g]], return_counts=True)
        pairs.append((x[:, None] << 16 | y).reshape(-1))
        times.append((nx[:, None] * ny).reshape(-1))
        groups.append(np.full(len(pairs[-1]), g))
    return np.concatenate(groups), np.concatenate(pairs), np.concatenate(times)


def _digits(most: int) -> np.ndarray:
    """Decimal digits of 0 to ``most``, a row each, zero bytes after them."""
    wide = len(str(most))
    return np.frombuffer(b"".join(str(k).encode().ljust(wide, b"\0") for k in range(most + 1)), np.uint8).reshape(-1, wide)


_DIGITS = _digits((1 << 16) - 1)


def written(a: np.ndarray, b: np.ndarray, a_from, b_from, a_to, b_to, first: np.ndarray) -> list[bytes]:
    """The groups of each text as ``a1,a2|b1;a3|b2``; ``first``: where each text begins in A and B together."""
    out = np.zeros((len(a) + len(b), _DIGITS.shape[1] + 1), np.uint8)
    at_a = np.arange(len(a)) + np.repeat(b_from, a_to - a_from)
    at_b = np.arange(len(b)) + np.repeat(a_to, b_to - b_from)
    out[at_a, :-1], out[at_b, :-1] = _DIGITS[a], _DIGITS[b]
    out[:, -1] = ord(",")
    out[at_a[a_to - 1], -1] = ord("|")
    out[at_b[b_to - 1], -1] = ord(";")
    ends = np.concatenate([[0], np.cumsum((out != 0).sum(axis=1))])[first].tolist()
    flat = out.reshape(-1)
    joined = flat[flat != 0].tobytes()
    return [joined[x:max(x, y - 1)] for x, y in zip(ends[:-1], ends[1:])]


def _lists(values: np.ndarray, first: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values.astype(np.int64)))


def _blocks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of at most BLOCK_DOCS rows and about BLOCK_BYTES of text."""
    _, offsets = text_bytes(batch.column(1))
    at = 0
    while at < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[at] + BLOCK_BYTES, side="right")) - 1
        end = min(max(end, at + 1), at + BLOCK_DOCS, batch.num_rows)
        yield batch.slice(at, end - at)
        at = end


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def _aligned(a_path: str, b_path: str, whole: bool):
    """Rows of documents; with ``whole`` their tokens and groups, else their id pairs, and a row for each block."""

    def one(batch: pa.RecordBatch, aligner: Aligner, block: int) -> Iterator[pa.RecordBatch]:
        a, a_first, b, b_first = aligner.encode(batch.column(1))
        a_end, b_end = np.cumsum(aligner.a_bytes.size[a]), np.cumsum(aligner.b_bytes.size[b])
        link_a, link_b, cut = lockstep(a_end, b_end, a_first, b_first)
        a_to, b_to = link_a[cut] + 1, link_b[cut] + 1
        a_from, b_from = np.concatenate([[0], a_to[:-1]])[:len(a_to)], np.concatenate([[0], b_to[:-1]])[:len(b_to)]
        group_first = np.searchsorted(a_from, a_first)
        group_first[-1] = len(a_from)
        docs = batch.num_rows
        if whole:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), _lists(a, a_first), _lists(b, b_first),
                 *[_lists(x - np.repeat(f[:-1], np.diff(group_first)), group_first) for x, f in ((a_to, a_first), (b_to, b_first))],
                 *[_lists(x - np.repeat(f[:-1], np.diff(at)), at) for at in [np.searchsorted(link_a, a_first)]
                   for x, f in ((link_a, a_first), (link_b, b_first))]],
                ["doc_id", "a_ids", "b_ids", "a_ends", "b_ends", "link_a", "link_b"])
            return
        of, pair, times = group_links(a, b, link_a, link_b, a_from, b_from, a_to, b_to)
        doc_of = np.repeat(np.arange(docs), np.diff(group_first))
        key = doc_of[of] << 32 | pair
        order = np.argsort(key, kind="stable")
        key, times = key[order], times[order]
        new = np.flatnonzero(np.diff(key, prepend=-1))
        key, times = key[new], np.add.reduceat(times, new) if len(new) else times
        first = np.searchsorted(key, np.arange(docs + 1) << 32)
        pairs, held = np.unique(key & 0xFFFFFFFF, return_counts=True)
        n_links = np.concatenate([[0], np.cumsum((a_to - a_from) * (b_to - b_from))])
        texts = written(a, b, a_from, b_from, a_to, b_to, a_first + b_first)
        digests = [hashlib.sha256(t).hexdigest() if t else "" for t in texts]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(docs, block)), pa.array(np.ones(docs, bool)), batch.column(0),
             *[pa.array(np.diff(f)) for f in (a_first, b_first, group_first)], pa.array(np.diff(n_links[group_first])), pa.array(digests, pa.string()),
             _lists(key & 0xFFFFFFFF, first), _lists(times, first)], _NAMES)
        yield pa.RecordBatch.from_arrays(
            [pa.array([block]), pa.array([False]), pa.nulls(1, pa.int64()), *[pa.nulls(1, pa.int64())] * 4, pa.array([""]),
             _lists(pairs, np.array([0, len(pairs)])), _lists(held, np.array([0, len(pairs)]))], _NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (a_path, b_path) not in _ALIGNERS:
            _ALIGNERS[a_path, b_path] = Aligner(a_path, b_path)
        block = TaskContext.get().partitionId() << 32
        for rows in batches:
            for batch in _blocks(rows):
                yield from one(batch, _ALIGNERS[a_path, b_path], block)
                block += 1

    return run


_NAMES = ["block", "is_doc", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]
_SCHEMA = ("block long, is_doc boolean, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
           "pairs array<long>, times array<long>")


def _with_counts(key: tuple, docs: pa.Table, known: pa.Table) -> pa.Table:
    """The documents of a block with the sums over their links."""
    order = np.argsort(known.column("pair").to_numpy())
    pair, count, best = (known.column(c).to_numpy()[order] for c in ("pair", "count", "best"))
    sums = {"n_best": [], "count_sum": []}
    for batch in docs.to_batches():
        pairs, times = batch.column("pairs"), batch.column("times")
        first = pairs.offsets.to_numpy().astype(np.int64)
        at = np.searchsorted(pair, pairs.values.to_numpy()[first[0]:first[-1]])
        often = times.values.to_numpy()[times.offsets[0].as_py():times.offsets[len(batch)].as_py()]
        for name, value in (("n_best", often * (count[at] == best[at])), ("count_sum", often * count[at])):
            sums[name].append(np.diff(np.concatenate([[0], np.cumsum(value)])[first - first[0]]))
    out = docs.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
    for name, parts in sums.items():
        out = out.append_column(name, pa.array(np.concatenate(parts) if parts else np.empty(0, np.int64)))
    return out.append_column("groups_sha256", docs.column("groups_sha256"))


def _rows(docs: DataFrame) -> DataFrame:
    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))


def align_tokens(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """``doc_id, a_ids, b_ids``, the ends of the groups as token numbers, and the links of overlapping tokens."""
    return _rows(docs).mapInArrow(
        _aligned(a_path, b_path, True),
        "doc_id long, a_ids array<long>, b_ids array<long>, a_ends array<long>, b_ends array<long>, link_a array<long>, link_b array<long>")


def _a_of(pair: str) -> Column:
    return F.shiftright(pair, 16)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """``pair, count, best``: how many documents hold an id pair linked, and the most of any pair with the same A id."""
    counts = blocks.groupBy("pair").agg(F.sum("held").alias("count"))
    best = counts.groupBy(_a_of("pair").alias("a")).agg(F.max("count").alias("best"))
    return counts.withColumn("a", _a_of("pair")).join(best, "a").drop("a")


def alignment_counts(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every document."""
    scratch = Scratch(docs.sparkSession, "align")
    made = scratch.keep(_rows(docs).mapInArrow(_aligned(a_path, b_path, False), _SCHEMA), "aligned")
    again = docs.sparkSession.read.schema(made.schema).parquet(scratch.path("aligned"))
    blocks = again.filter(~F.col("is_doc")).select("block", F.explode(F.arrays_zip("pairs", "times")).alias("e")).select(
        "block", F.col("e.pairs").alias("pair"), F.col("e.times").alias("held"))
    counts = scratch.keep(pair_counts(blocks), "counts")
    known = blocks.select("block", "pair").join(counts, "pair")
    return made.filter("is_doc").groupBy("block").cogroup(known.groupBy("block")).applyInArrow(
        _with_counts, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def op11_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return alignment_counts(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
