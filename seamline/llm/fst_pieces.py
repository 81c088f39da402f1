"""SentencePiece encoding and decoding by a weighted finite-state transducer.

Three transducers are compiled from a public model: the normaliser (the mark of a word's start before
the text and for each space; the mark itself stays), the pieces (weight: minus the score) and the byte fallback (for a
character that is no piece by itself: its bytes, weighted more than any piece). Composed with an input,
they give a lattice whose states are the input's positions; the encoding is its shortest path in the
tropical semiring (weights are added along a path, the least path is taken), of equal paths the one
whose last differing piece is longer. No piece crosses the start of a run of spaces, so an input is
composed run by run, each distinct run once per worker. Long runs are composed one by one, so
memory stays in proportion to the text.

Null and empty texts have no ids. The piece scores of a model that was trained by merges serve as
weights all the same: the result is the least-weight path, not the result of merging. Rows with the same
``doc_id`` are encoded one by one, a null ``doc_id`` too; an empty table gives no rows; other
columns are ignored. Decoding gives the text back exactly, but that the mark of a word's start itself
(U+2581) in a text becomes a space.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, held_by_worker, ship, text_of
from .lattice import Lattices, read_pieces
from .word_table import Lists, WordTable, spaced_chunks, text_bytes

MARK = "▁"
BLOCK_BYTES = 64
MOST_RUNS = 500_000


class PieceTransducer:
    def __init__(self, path: str):
        pieces, scores, self.byte_ids, control = read_pieces(path)
        skip = {*self.byte_ids, *control}
        self.output = [b"" if i in control else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]
        for b, i in enumerate(self.byte_ids):
            self.output[i] = bytes([b])
        self.pieces = {self.output[i]: i for i in range(len(pieces)) if i not in skip}
        self.weight = -np.array(scores)
        self.fallback = float(max(self.weight[list(self.pieces.values())])) + 10
        self.lattices = Lattices(self.pieces)
        self.reset()

    @classmethod
    def get(cls, path: str) -> "PieceTransducer":
        return held_by_worker((cls, path), lambda: cls(path))

    def reset(self) -> None:
        self.runs, self.ids = WordTable(), Lists()

    def normalise(self, texts: pa.Array) -> pa.Array:
        """A word's start before every text that is not empty; spaces stand for the mark."""
        texts = pc.replace_substring(texts.fill_null(""), MARK, " ")
        return pc.if_else(pc.equal(texts, ""), texts, pc.binary_join_element_wise(" ", texts, "")).cast(pa.string()) if len(texts) else texts

    def _character_bytes(self, buf: np.ndarray, at: np.ndarray) -> np.ndarray:
        lead = buf[at]
        return np.where(lead < 0x80, 1, np.where(lead < 0xC0, 0, np.where(lead < 0xE0, 2, np.where(lead < 0xF0, 3, 4))))

    def shortest_paths(self, buf: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids along the shortest path of every run (longest run first) and their numbers."""
        longest, count = int(lengths[0]), len(lengths)
        best = np.full((longest + 1, count), np.inf)
        best[0] = 0
        step = np.zeros((longest + 1, count), np.int32)  # bytes of the last arc, of its piece:
        piece = np.full((longest + 1, count), -1, np.int64)
        fallback = np.zeros((longest, count), np.int32)
        for i in range(longest):
            have = np.searchsorted(-lengths, -i)
            fallback[i, :have] = np.minimum(self._character_bytes(buf, starts[:have] + i), lengths[:have] - i)

        def relax(i: int, n: int, words: np.ndarray, cost, ids) -> None:
            through = best[i, words] + cost
            better = through < best[i + n, words]
            to = words[better]
            best[i + n, to], step[i + n, to] = through[better], n
            piece[i + n, to] = ids[better] if ids is not None else -1

        def fall_back(i: int) -> None:
            for n in range(1, 5):
                words = np.flatnonzero(fallback[i] == n)
                if len(words):
                    relax(i, n, words, self.fallback, None)

        done = 0
        for i, n, words, ids in self.lattices.walk(buf, starts, lengths):
            while done < i:
                fall_back(done)
                done += 1
            fallback[i, words[fallback[i, words] == n]] = 0  # this character is a piece
            relax(i, n, words, self.weight[ids], ids)
        for i in range(done, longest):
            fall_back(i)
        rows, at = np.arange(count), lengths.copy()
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # (run, place from the end, id)
        place = np.zeros(count, np.int64)
        while len(rows):
            n, p = step[at, rows], piece[at, rows]
            known = p >= 0
            found.append((rows[known], place[rows[known]], p[known]))
            place[rows[known]] += 1
            for back in range(1, 5):
                some = np.flatnonzero(~known & (n >= back))
                if len(some):
                    byte = buf[starts[rows[some]] + at[some] - back]
                    found.append((rows[some], place[rows[some]], np.asarray(self.byte_ids)[byte]))
                    place[rows[some]] += 1
            at = at - n
            rows, at = rows[at > 0], at[at > 0]
        run, spot, ids = (np.concatenate(c) for c in zip(*found))
        ends = np.cumsum(place)
        out = np.empty(len(ids), np.int32)
        out[ends[run] - 1 - spot] = ids
        return out, place

    def _learn(self, buf: np.ndarray, starts: np.ndarray, lengths: np.ndarray, numbers: np.ndarray) -> None:
        order = np.argsort(-lengths, kind="stable")
        at = 0
        while at < len(order):
            many = max(1, min(4096, BLOCK_BYTES * 4096 // max(1, int(lengths[order[at]]))))
            some = order[at:at + many]
            ids, sizes = self.shortest_paths(buf, starts[some], lengths[some])
            self.ids.put(numbers[some], sizes, ids)
            at += many

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and where each text's begin (one more at the end)."""
        if self.runs.n > MOST_RUNS:
            self.reset()
        buf, offsets = text_bytes(self.normalise(texts))
        starts, lengths, first = spaced_chunks(buf, offsets, runs=True)
        before = self.runs.n
        numbers, new = self.runs.lookup(buf, starts, lengths)
        if len(new):
            self._learn(buf, starts[new], lengths[new], before + np.arange(len(new)))
        flat, sizes = self.ids.get(numbers)
        return flat, np.concatenate([[0], np.cumsum(sizes)])[first]


class _Decoder:
    """Bytes of every id in one array."""

    def __init__(self, output: list[bytes]):
        self.lists = Lists()
        self.lists.put(np.arange(len(output)), np.array([len(x) for x in output]), np.frombuffer(b"".join(output), np.uint8).astype(np.int32))


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = PieceTransducer.get(path)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                ids, ends = fst.encode(batch.column(1))
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([batch.column(0), lists, batch.column(1)], ["doc_id", "ids", "text"])

    return run


def _decode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = PieceTransducer.get(path)
        decoder = _Decoder(fst.output)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                lists = batch.column(batch.schema.get_field_index("ids"))
                spans = np.asarray(lists.offsets).astype(np.int64)
                ids = np.asarray(lists.values)[spans[0]:spans[-1]]
                flat, sizes = decoder.lists.get(ids)
                raw = flat.astype(np.uint8).tobytes()
                ends = np.concatenate([[0], np.cumsum(sizes)])[spans - spans[0]].tolist()
                texts = [raw[a + 1:b].decode("utf-8", "replace") for a, b in zip(ends[:-1], ends[1:])]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "decoded"])

    return run


def encode_pieces(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids, text`` of every row."""
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(_encode(path), "doc_id long, ids array<int>, text string")


def decode_pieces(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` with ``decoded``, the texts that the ids stand for."""
    ship(encoded.sparkSession)
    schema = ", ".join(f"`{c}` {t}" for c, t in encoded.dtypes)
    return encoded.mapInArrow(_decode(path), schema + ", decoded string")


def op4_fst_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text, and whether they decode to it."""
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    rows = decode_pieces(encode_pieces(documents(spark, sf_dir), path), path)
    return rows.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"),
                       (F.col("decoded") == F.regexp_replace("text", MARK, " ")).alias("round_trip"))
