r"""Hierarchical Pitman-Yor language model over the words of a corpus.

Restaurants form a tree: a context is the whole word before (or the text's start), its parent is the restaurant without
context, and the base is uniform over the words seen in training and one unknown word. A dish is a word. A
customer of a restaurant is a token seen in its context, or a table of a child restaurant. With ``ending`` contexts are
only so many last bytes of the word before: a smaller model, whose contexts stop growing with the corpus.

The seating is sampled by Gibbs: all customers of one dish in one restaurant are taken out and seated again
given everything else. Predictions depend on a seating only through its number of tables t, whose
conditional for c customers is proportional to S(c, t) * prod_{j<t}(theta + d (T + j)) * p^t, with S
the generalised Stirling number, T the restaurant's other tables and p the parent's predictive
probability of the dish; up to ``EXACT`` customers it is drawn from exactly that. The customers
beyond are seated in blocks of a sixteenth of those present, the number of new tables of a block
being binomial (by the normal law where more than ``BY_NORMAL`` are expected). The random numbers of a dish are a hash of its word,
context and sweep, so scores do not depend on the number of tasks. Within a sweep every dish uses the other dishes' tables as they were before it, so dishes
are independent rows and no restaurant has to sit in one task. The first sweep is dropped; tables and customers are averaged over
the ``KEPT`` ones after it, and the predictive probabilities are those of these averages.

Words are 64-bit hashes, taken to differ. Texts are cut to tokens once and stored in blocks, as numbers of a block's own words.
The distinct pairs of a context and a word of a block go to buckets by context, where they are counted over all blocks; restaurants without
context are in buckets by word. Those with one customer have one table and only enter sums, so a sweep moves the other
pairs alone: a context's bucket tells each word's bucket how many tables its words have, and is told the customers and tables that they have without
context. Numbers pass between two parties in the order in which the one first named its words to the other, so hashes are exchanged once and not with every count.
There are buckets and blocks in proportion to the tokens, and a task holds one at a time; the driver gets the sums of the restaurant without context.

A text's score is the sum over its tokens of log p(word) + log q(context), q the share that a restaurant leaves to its parent, and
of a gain for each token whose pair was seen in training. Buckets tell the blocks the customers and tables of their words, contexts and pairs, and
every text is summed up in its block.

Null text counts as empty: its one token is the end. Rows with the same ``doc_id`` are scored one by one;
a null ``doc_id`` counts as remainder 0. With no training document every word is unknown. An empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bbit_minhash import Shingler, _mix
from .common import Scratch, arrow_rows, crc_mod, documents, releasing, ship, text_of
from .word_table import LOWER_ASCII, blank_words, text_bytes

DISCOUNT = (0.6, 0.85)  # without context, in a context
STRENGTH = (1.0, 1.0)
EXACT = 64
KEPT = 2
BY_NORMAL = 24
END, START = np.uint64(1), np.uint64(0)  # the word that ends a text and the context that starts one
NONE = -1  # in place of a context: the restaurant without one
BLOCK_TOKENS = 1_500_000
BUCKET_TOKENS = 1_500_000  # tokens of the corpus for each bucket of contexts and of words
SEATED_ROWS = 10_000  # dishes seated together: up to EXACT weights each
# Rows of all stages: who reads them (a stage of one of the buckets or a block), which bucket or block, who wrote them, and packed arrays;
# n, c and t are sums for the driver.
ROW = "reader int, key long, src long, data binary, n long, c long, t long"
CONTEXTS, WORDS, PLACES, CONTEXTS_LAST, WORDS_LAST, BLOCK = range(6)
OWN = -1  # as src: a bucket's own numbers


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays as bytes: first bytes of all numbers, then second bytes and so on, compressed."""
    parts, codec = [], pa.Codec("zstd", compression_level=1)
    for a in arrays:
        planes = np.ascontiguousarray(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T)
        small = codec.compress(planes, asbytes=True) if len(a) else b""
        parts += [struct.pack("<cqq", a.dtype.char.encode(), len(a), len(small)), small]
    return b"".join(parts)


def _unpack(data: bytes) -> list[np.ndarray]:
    out, at, codec = [], 0, pa.Codec("zstd")
    while at < len(data):
        char, n, size = struct.unpack_from("<cqq", data, at)
        at += struct.calcsize("<cqq")
        kind = np.dtype(char.decode())
        if n:
            planes = np.frombuffer(codec.decompress(data[at:at + size], decompressed_size=n * kind.itemsize), np.uint8)
            out.append(np.ascontiguousarray(planes.reshape(kind.itemsize, n).T).view(kind).reshape(n))
        else:
            out.append(np.empty(0, kind))
        at += size
    return out


def _steps(ascending: np.ndarray) -> np.ndarray:
    """Differences of ascending unsigned numbers, the first from 0; ``np.cumsum`` undoes it."""
    return np.diff(ascending, prepend=ascending.dtype.type(0))


def _sums(at: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Whole numbers summed up by place."""
    return np.bincount(at, values, n).astype(np.int64)


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return (_mix(hashes + np.uint64(0x9E3779B97F4A7C15)) % np.uint64(buckets)).astype(np.int64)


def _split(hashes: np.ndarray, buckets: int) -> list[tuple[int, np.ndarray]]:
    """Buckets of ascending hashes, and where each one's are: the order in which two parties exchange numbers of them."""
    bucket = _bucket(hashes, buckets)
    order = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    return [(k, order[cuts[k]:cuts[k + 1]]) for k in range(buckets) if cuts[k] < cuts[k + 1]]


def _rows(rows: list[tuple]) -> pa.Table:
    """Rows of ``ROW``; sums not given are 0."""
    names = ["reader", "key", "src", "data", "n", "c", "t"]
    types = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    full = [(*r, *[0] * (7 - len(r))) for r in rows]
    return pa.Table.from_arrays([pa.array([r[k] for r in full], t) for k, t in enumerate(types)], names)


def _read(table: pa.Table) -> tuple[int, dict[int, list[tuple[int, list[np.ndarray]]]]]:
    """The bucket or block of a group of rows, and by reader the writers and arrays in order of the writers."""
    out: dict[int, list] = {k: [] for k in range(6)}
    readers, srcs, datas = (table.column(c) for c in ("reader", "src", "data"))
    for r, src, data in sorted(zip(readers.to_pylist(), srcs.to_pylist(), datas), key=lambda row: row[:2]):
        out[r].append((src, _unpack(data.as_buffer().to_pybytes())))
    return table.column("key")[0].as_py(), out


def _texts(ending: int | None, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks of texts (doc_id, held_out, text): ids, which are null, which held out, tokens of each; words, their training tokens, the
        contexts they make (none: themselves), their places by frequency; all tokens, as numbers by frequency."""
        hasher = Shingler(1)
        number, parts, tokens = TaskContext.get().partitionId() << 32, [], 0

        def done() -> pa.RecordBatch:
            ids, null, held, lens, word, after = (np.concatenate(c) for c in zip(*parts))
            words, first, tok, count = np.unique(word, return_index=True, return_inverse=True, return_counts=True)
            order = np.argsort(-count, kind="stable").astype(np.uint32)
            rank = np.empty(len(order), np.uint32)
            rank[order] = np.arange(len(order), dtype=np.uint32)
            trained = np.bincount(tok[np.repeat(held == 0, lens)], minlength=len(words))
            data = _pack(ids, null, held, lens, _steps(words), trained, after[first] if ending is not None else np.empty(0, np.uint64), rank, rank[tok])
            return _rows([(BLOCK, number, OWN, data, len(word))]).to_batches()[0]

        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                ids, held = batch.column(0), batch.column(1)
                buf, offsets = text_bytes(batch.column(2), LOWER_ASCII)
                starts, lengths, first = blank_words(buf, offsets)
                word = hasher.word_hashes(buf, starts, lengths)
                after = np.insert(_endings(buf, starts, lengths, ending), first[1:], START) if ending is not None else np.empty(0, np.uint64)
                parts.append((np.asarray(ids.fill_null(0)), np.asarray(ids.is_null()).astype(np.uint8), np.asarray(held).astype(np.uint8),
                              (np.diff(first) + 1).astype(np.uint32), np.insert(word, first[1:], END), after))
                tokens += len(word) + len(ids)
                if tokens > most:
                    yield done()
                    number, parts, tokens = number + 1, [], 0
        if parts:
            yield done()

    return run


def _endings(buf: np.ndarray, starts: np.ndarray, lengths: np.ndarray, ending: int) -> np.ndarray:
    out = np.zeros(len(starts), np.uint64)
    for k in range(1, ending + 1):
        out = out * np.uint64(257) + np.where(lengths >= k, buf[np.maximum(starts + lengths - k, 0)].astype(np.uint64) + np.uint64(1), np.uint64(0))
    return out


class _Block:
    """The tokens of a stored block and its distinct pairs, sorted by the context's bucket, the context and the word."""

    def __init__(self, arrays: list[np.ndarray], buckets: int):
        self.ids, self.null, held, self.lens, words, self.trained, after, rank, tok = arrays
        self.held, self.words = held.astype(bool), np.cumsum(words, dtype=np.uint64)
        sorted_ = np.empty(len(rank), np.uint32)
        sorted_[rank] = np.arange(len(rank), dtype=np.uint32)
        self.tok = sorted_[tok]
        contexts, at = np.unique(np.append(after if len(after) else self.words, START), return_inverse=True)
        order = np.lexsort((contexts, _bucket(contexts, buckets)))
        place = np.empty(len(order), np.uint64)
        place[order] = np.arange(len(order), dtype=np.uint64)
        self.contexts = contexts[order]
        before = place[at]  # of each word as a context; the last one is the start
        self.starts = np.cumsum(self.lens, dtype=np.int64) - self.lens
        key = np.empty(len(tok), np.uint64)
        key[1:] = before[self.tok[:-1]]
        key[self.starts] = before[-1]
        self.context = key.astype(np.uint32)
        pairs, self.pair = np.unique(key << np.uint64(32) | self.tok, return_inverse=True)
        self.x, self.w = (pairs >> np.uint64(32)).astype(np.int64), (pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)
        cuts = np.searchsorted(_bucket(self.contexts, buckets)[self.x], np.arange(buckets + 1))
        self.cells = [(k, slice(cuts[k], cuts[k + 1])) for k in range(buckets) if cuts[k] < cuts[k + 1]]


def _starts(keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys start."""
    return np.flatnonzero(np.diff(keys, prepend=keys[:1] - 1))


def _pair_cells(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each bucket of contexts a block's contexts, words in each, and their training tokens."""
        for batch in batches:
            for number, data in zip(batch.column("key").to_pylist(), batch.column("data")):
                block = _Block(_unpack(data.as_py()), buckets)
                train = np.repeat(~block.held, block.lens)
                c = np.bincount(block.pair[train], minlength=len(block.x)).astype(np.uint32)
                for k, some in block.cells:
                    x, (w, at) = block.x[some], np.unique(block.w[some], return_inverse=True)
                    first = _starts(x)
                    yield _rows([(CONTEXTS, k, number, _pack(_steps(block.contexts[x[first]]), np.diff(first, append=len(x)).astype(np.uint32),
                                                             _steps(block.words[w]), at.astype(np.uint32), c[some]))]).to_batches()[0]

    return run


def _word_cells(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each bucket of words a block's words and their training tokens."""
        for batch in batches:
            for number, data in zip(batch.column("key").to_pylist(), batch.column("data")):
                arrays = _unpack(data.as_py())
                words, trained = np.cumsum(arrays[4], dtype=np.uint64), arrays[5]
                for k, at in _split(words, buckets):
                    yield _rows([(WORDS_LAST, k, number, _pack(_steps(words[at]), trained[at]))]).to_batches()[0]

    return run


def _count_pairs(buckets: int):
    def run(table: pa.Table) -> pa.Table:
        """Pairs of all blocks counted in a bucket of contexts. It keeps those with several customers, names their words to
        the buckets of words, and keeps for the end where each block's pairs and contexts are."""
        key, rows = _read(table)
        cells = rows[CONTEXTS]
        x, at_x = np.unique(np.concatenate([np.cumsum(a[0], dtype=np.uint64) for _, a in cells]), return_inverse=True)
        w, at_w = np.unique(np.concatenate([np.cumsum(a[2], dtype=np.uint64) for _, a in cells]), return_inverse=True)
        shift = np.cumsum([0] + [len(a[2]) for _, a in cells])
        pair = np.repeat(at_x.astype(np.uint64), np.concatenate([a[1] for _, a in cells])) << np.uint64(32)
        pair |= at_w.astype(np.uint64)[np.concatenate([a[3] + s for s, (_, a) in zip(shift, cells)])]
        pairs, at = np.unique(pair, return_inverse=True)
        c = _sums(at, np.concatenate([a[4] for _, a in cells]), len(pairs))
        of_x, of_w = (pairs >> np.uint64(32)).astype(np.int64), (pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)
        n, single = _sums(of_x, c, len(x)), np.bincount(of_x[c == 1], minlength=len(x))
        many = np.flatnonzero(c > 1)
        (in_x, runs), (in_w, word) = np.unique(of_x[many], return_counts=True), np.unique(of_w[many], return_inverse=True)
        words, c_many = w[in_w], c[many]
        out = [(CONTEXTS, key, OWN, _pack(_steps(x[in_x]), runs, single[in_x], _steps(words), word.astype(np.uint32), c_many,
                                          np.ones(len(many), np.int64), np.zeros(len(many), np.int64))),
               (CONTEXTS_LAST, key, OWN, _pack(n, single, in_x.astype(np.uint32)))]
        dishes, seen = np.bincount(word, minlength=len(words)), _sums(word, c_many, len(words))
        out += [(WORDS, k, key, _pack(_steps(words[some]), dishes[some], seen[some])) for k, some in _split(words, buckets)]
        kind, place = np.minimum(c, 2).astype(np.uint8), np.cumsum(c > 1) - 1
        done_x = done = 0
        for block, a in cells:
            here, there = at_x[done_x:done_x + len(a[0])], at[done:done + len(a[3])]
            done_x, done = done_x + len(here), done + len(there)
            kinds = kind[there]
            out.append((CONTEXTS_LAST, key, block, _pack(kinds, _steps(place[there[kinds == 2]].astype(np.uint32)), _steps(here.astype(np.uint32)))))
        return _rows(out)

    return run


def _count_words() -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        """Words of all blocks counted in a bucket of words; each is a dish with a customer for every context and one table. The buckets
        of contexts are told those; kept are the places of the words of each of them, and for the end those of each block."""
        key, rows = _read(table)
        named, cells = rows[WORDS], rows[WORDS_LAST]
        w, at = np.unique(np.concatenate([np.cumsum(a[0], dtype=np.uint64) for _, a in cells + named]), return_inverse=True)
        at_cells, at_named = np.split(at, [sum(len(a[0]) for _, a in cells)])
        n = _sums(at_cells, np.concatenate([a[1] for _, a in cells]), len(w))
        seen = n > 0
        place = np.cumsum(seen) - 1
        single = n.copy()
        c = np.zeros(len(w), np.int64)
        if named:
            single -= _sums(at_named, np.concatenate([a[2] for _, a in named]), len(w))
            c = _sums(at_named, np.concatenate([a[1] for _, a in named]), len(w))
        c, t = (c + single)[seen], np.ones(int(seen.sum()), np.int64)
        out = [(WORDS, key, OWN, _pack(_steps(w[seen]), n[seen], single[seen], c, t, np.zeros_like(t), np.zeros_like(t)), int(n.sum()), int(c.sum()), len(t))]
        for rest, reader, some in ((at_named, PLACES, named), (at_cells, WORDS_LAST, cells)):
            done = 0
            for src, a in some:
                mine = rest[done:done + len(a[0])]
                done += len(mine)
                places = place[mine[seen[mine]]].astype(np.uint32)
                out.append((reader, key, src, _pack(seen[mine].astype(np.uint8), _steps(places))))
                if reader == PLACES:
                    out.append((CONTEXTS, src, key, _pack(c[places], t[places])))
        return _rows(out)

    return run


def _stirling(d: float) -> np.ndarray:
    """log S(c, t) for c, t up to EXACT."""
    out = np.full((EXACT + 1, EXACT + 1), -np.inf)
    out[1, 1] = 0
    for c in range(1, EXACT):
        t = np.arange(1, c + 2)
        stay = np.where(t <= c, out[c, t] + np.log(np.maximum(c - d * t, 1e-300)), -np.inf)
        out[c + 1, t] = np.logaddexp(out[c, t - 1], stay)
    return out


def _uniform(seed: np.ndarray, draw: int) -> np.ndarray:
    """A number between 0 and 1 for each seed and draw (both ends excluded)."""
    x = seed + np.uint64((draw + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(12)).astype(np.float64) / (1 << 52) + 2.0 ** -54


def _binomial(n: np.ndarray, q: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Binomial draws from two uniform numbers each."""
    rare = np.minimum(q, 1 - q)
    wide = n * rare > BY_NORMAL
    normal = np.sqrt(-2 * np.log(u)) * np.cos(2 * np.pi * v)
    out = np.where(wide, np.clip(np.rint(n * rare + normal * np.sqrt(n * rare * (1 - rare))), 0, n), 0).astype(np.int64)
    open_ = np.flatnonzero(~wide)
    size, odds, mass = n[open_], (rare / (1 - rare))[open_], np.power(1 - rare[open_], n[open_])
    reached, k = mass.copy(), 0
    while True:  # by the inverse of the distribution function
        on = (u[open_] > reached) & (k < size)
        if not on.any():
            break
        open_, size, odds, mass, reached = open_[on], size[on], odds[on], mass[on], reached[on]
        mass = mass * (size - k) / (k + 1) * odds
        reached = reached + mass
        k += 1
        out[open_] = k
    return np.where(q > 0.5, n - out, out)


def seat(c: np.ndarray, others: np.ndarray, p: np.ndarray, d: float, theta: float, seed: np.ndarray) -> np.ndarray:
    """Tables of dishes with ``c`` customers, drawn given the restaurants' other tables and the parents' ``p``."""
    t = np.minimum(c, 1).astype(np.int64)
    stirling = _stirling(d)
    small = np.minimum(c, EXACT)
    order = np.argsort(small, kind="stable")
    cuts = np.searchsorted(small[order], np.arange(2, EXACT + 2))
    drawn = _uniform(seed, 0)
    for k in range(2, EXACT + 1):
        some = order[cuts[k - 2]:cuts[k - 1]]
        for at in range(0, len(some), 50_000):
            rows = some[at:at + 50_000]
            new = np.log(theta + d * (others[rows, None] + np.arange(k))) + np.log(p[rows, None])
            weight = stirling[k, 1:k + 1] + np.cumsum(new, axis=1)
            share = np.cumsum(np.exp(weight - weight.max(axis=1, keepdims=True)), axis=1)
            t[rows] = 1 + (share < (drawn[rows] * share[:, -1])[:, None]).sum(axis=1)
    big = np.flatnonzero(c > EXACT)
    seated, draw = np.full(len(big), EXACT), 1
    while len(big):
        more = np.minimum(np.maximum(seated // 16, 1), c[big] - seated)
        new = (theta + d * (others[big] + t[big])) * p[big]
        chance = new / (new + np.maximum(seated - d * t[big], 1e-9))
        t[big] += _binomial(more, chance, _uniform(seed[big], draw), _uniform(seed[big], draw + 1))
        seated, draw = seated + more, draw + 2
        left = seated < c[big]
        big, seated = big[left], seated[left]
    return t


def _seated(w: np.ndarray, x: np.ndarray, c: np.ndarray, others: np.ndarray, p: np.ndarray, level: int, sweep: int) -> np.ndarray:
    """The new numbers of tables of dishes."""
    step = np.uint64((sweep << 2 | level) * 0x9E3779B97F4A7C15 % (1 << 64))
    seed = _mix(w ^ _mix(x + step))
    others = np.maximum(others, 0).astype(np.float64)
    t = np.empty(len(c), np.int64)
    for at in range(0, len(c), SEATED_ROWS):
        some = slice(at, at + SEATED_ROWS)
        t[some] = seat(c[some], others[some], p[some], DISCOUNT[level], STRENGTH[level], seed[some])
    return t


def _probability(c: np.ndarray, t: np.ndarray, all_c: float, all_t: float, n_types: int) -> np.ndarray:
    """Of a word without context, of whose ``c`` customers ``t`` sit down first."""
    return (c - DISCOUNT[0] * t + (STRENGTH[0] + DISCOUNT[0] * all_t) / (n_types + 1)) / (STRENGTH[0] + all_c)


def _seat_contexts(sweep: int, all_c: int, all_t: int, n_types: int, buckets: int):
    def run(table: pa.Table) -> pa.Table:
        """A sweep over a bucket of contexts: new tables of its pairs, and their sums by word for the buckets of words."""
        key, rows = _read(table)
        (_, own), *told = rows[CONTEXTS]
        x, runs, single, w, word, c, t, kept = own
        hashes, contexts = np.cumsum(w, dtype=np.uint64), np.cumsum(x, dtype=np.uint64)
        split, p = _split(hashes, buckets), np.empty(len(hashes))
        for (_, at), (_, (parent_c, parent_t)) in zip(split, told, strict=True):
            p[at] = _probability(parent_c, parent_t, all_c, all_t, n_types)
        of = np.repeat(np.arange(len(runs)), runs)
        others = (single + _sums(of, t, len(runs)))[of] - t
        t = _seated(hashes[word], contexts[of], c, others, p[word], 1, sweep)
        sat = _sums(word, t, len(hashes))
        out = [(CONTEXTS, key, OWN, _pack(x, runs, single, w, word, c, t, kept + t if sweep > 1 else kept))]
        return _rows(out + [(WORDS, k, key, _pack(sat[at])) for k, at in split])

    return run


def _seat_words(sweep: int, all_t: int, n_types: int):
    def run(table: pa.Table) -> pa.Table:
        """A sweep over a bucket of words: their customers without context, new tables, and both for the buckets of contexts."""
        key, rows = _read(table)
        (_, own), *told = rows[WORDS]
        w, n, single, _, t, kept, kept_c = own
        places = [np.cumsum(a[1]) for _, a in rows[PLACES]]
        c = single.copy()
        for at, (_, (sat,)) in zip(places, told, strict=True):
            c[at] += sat
        hashes = np.cumsum(w, dtype=np.uint64)
        t = _seated(hashes, np.full(len(c), NONE, np.int64).view(np.uint64), c, all_t - t, np.full(len(c), 1.0 / (n_types + 1)), 0, sweep)
        if sweep > 1:
            kept, kept_c = kept + t, kept_c + c
        out = [(WORDS, key, OWN, _pack(w, n, single, c, t, kept, kept_c), 0, int(c.sum()), int(t.sum()))]
        return _rows(out + [(CONTEXTS, src, key, _pack(c[at], t[at])) for at, (src, _) in zip(places, rows[PLACES])])

    return run


def _tell_pairs(table: pa.Table) -> pa.Table:
    """What a block gets from a bucket of contexts: customers and kept tables of its pairs, customers and kept tables of its contexts."""
    key, rows = _read(table)
    (_, (_, runs, _, _, _, c, _, kept)), = rows[CONTEXTS]
    (_, (n, single, in_x)), *cells = rows[CONTEXTS_LAST]
    tables = single * KEPT
    tables[in_x] += _sums(np.repeat(np.arange(len(runs)), runs), kept, len(runs))
    out = []
    for block, (kinds, places, contexts) in cells:
        at, of = np.cumsum(places), np.cumsum(contexts)
        out.append((CONTEXTS, block, key, _pack(kinds, c[at], kept[at], n[of], tables[of])))
    return _rows(out)


def _tell_words(table: pa.Table) -> pa.Table:
    """What a block gets from a bucket of words: training tokens, kept customers and kept tables of its words."""
    key, rows = _read(table)
    (_, (_, n, _, _, _, kept, kept_c)), = rows[WORDS]
    out = []
    for block, (seen, places) in rows[WORDS_LAST]:
        at = np.cumsum(places)
        out.append((WORDS, block, key, _pack(seen, n[at], kept_c[at], kept[at])))
    return _rows(out)


def _score(n_tokens: int, n_types: int, mean_c: float, mean_t: float, buckets: int):
    def run(table: pa.Table) -> pa.Table:
        """Scores of the texts of a block."""
        _, rows = _read(table)
        block = _Block(rows[BLOCK][0][1], buckets)
        n, p = np.zeros(len(block.words), np.int64), np.ones(len(block.words))
        log_p = np.full(len(p), np.log10((STRENGTH[0] + DISCOUNT[0] * mean_t) / (n_types + 1) / (STRENGTH[0] + mean_c)))
        for (_, at), (_, (seen, count, kept_c, kept)) in zip(_split(block.words, buckets), rows[WORDS], strict=True):
            at = at[seen > 0]
            n[at], p[at] = count, _probability(kept_c / KEPT, kept / KEPT, mean_c, mean_t, n_types)
            log_p[at] = np.log10(p[at])
        # a pair or a context not seen in training adds nothing
        q, gain = np.ones(len(block.contexts)), np.zeros(len(block.x))
        for (_, some), (_, (kinds, c_many, kept_many, count, tables)) in zip(block.cells, rows[CONTEXTS], strict=True):
            x, w = block.x[some], block.w[some]
            c, t = kinds.astype(np.float64), kinds.astype(np.float64)
            c[kinds == 2], t[kinds == 2] = c_many, kept_many / KEPT
            at = x[_starts(x)]
            share = np.where(count > 0, (STRENGTH[1] + DISCOUNT[1] * (tables / KEPT)) / (STRENGTH[1] + count), 1.0)
            q[at] = share
            strength = np.repeat(STRENGTH[1] + count, np.diff(_starts(x), append=len(x)))
            gain[some] = np.where(kinds > 0, np.log10(1 + (c - DISCOUNT[1] * t) / strength / q[x] / p[w]), 0.0)
        score = log_p[block.tok] + np.log10(q)[block.context] + gain[block.pair]
        base = np.log10((n + 1) / (n_tokens + n_types + 1))[block.tok]
        known = (n > 0).astype(np.int64)[block.tok]
        return pa.Table.from_arrays(
            [pa.array(block.ids, mask=block.null.astype(bool)), pa.array(block.held), pa.array(block.lens.astype(np.int64)),
             pa.array(np.add.reduceat(known, block.starts)), pa.array(np.full(len(block.ids), n_tokens)),
             pa.array(np.add.reduceat(base, block.starts)), pa.array(np.add.reduceat(score, block.starts))],
            ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return run


def score_texts(docs: DataFrame, mod: int = 7, held: int = 2, ending: int | None = 2) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row of ``docs``.

    ``ending``: contexts are that many last bytes of the word before; None: the whole word.
    """
    spark = docs.sparkSession
    ship(spark)
    scratch = Scratch(spark, "hpylm")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (crc_mod("doc_id", mod) == held).alias("held_out"), text_of().alias("text"))
    with arrow_rows(spark, 1_024):
        texts = scratch.keep(rows.mapInArrow(releasing(_texts(ending, BLOCK_TOKENS)), ROW), "texts")
    size = texts.agg(F.count(F.lit(1)).alias("blocks"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    blocks, buckets = max(1, int(size["blocks"])), -(-int(size["n"]) // BUCKET_TOKENS) or 1

    def of(*readers: int, **tables: DataFrame) -> DataFrame:
        return reduce(DataFrame.unionByName, [t.filter(F.col("reader").isin(*readers)) for t in tables.values()])

    def at_keys(df: DataFrame, run: Callable[[pa.Table], pa.Table], schema: str = ROW, tasks: int = buckets) -> DataFrame:
        return df.repartition(tasks, "key").groupBy("key").applyInArrow(run, schema)

    with arrow_rows(spark, 4):  # rows are whole blocks
        contexts = scratch.keep(at_keys(texts.mapInArrow(releasing(_pair_cells(buckets)), ROW), _count_pairs(buckets)), "contexts0")
        words = scratch.keep(at_keys(texts.mapInArrow(_word_cells(buckets), ROW).unionByName(of(WORDS, c=contexts)), _count_words()), "words0")
    total = words.agg(*[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in "nct"]).first()
    n_tokens, all_c, all_t = int(total["n"]), int(total["c"]), int(total["t"])
    n_types, mean_c, mean_t = all_t, 0.0, 0.0
    pairs, dishes = contexts, words
    for k in range(1, KEPT + 2):
        pairs_before, dishes_before = pairs, dishes
        pairs = scratch.keep(at_keys(of(CONTEXTS, p=pairs_before, d=dishes_before), _seat_contexts(k, all_c, all_t, n_types, buckets)), f"contexts{k}")
        dishes = scratch.keep(at_keys(of(WORDS, d=dishes_before, p=pairs).unionByName(of(PLACES, w=words)), _seat_words(k, all_t, n_types)), f"words{k}")
        if k > 1:
            scratch.drop(f"contexts{k - 1}")
            scratch.drop(f"words{k - 1}")
        seen = dishes.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("c"), F.coalesce(F.sum("t"), F.lit(0)).alias("t")).first()
        all_c, all_t = int(seen["c"]), int(seen["t"])
        if k > 1:
            mean_c, mean_t = mean_c + all_c / KEPT, mean_t + all_t / KEPT

    from_pairs = at_keys(of(CONTEXTS, p=pairs).unionByName(of(CONTEXTS_LAST, c=contexts)), _tell_pairs)
    from_words = at_keys(of(WORDS, d=dishes).unionByName(of(WORDS_LAST, w=words)), _tell_words)
    return at_keys(
        texts.unionByName(from_pairs).unionByName(from_words), _score(n_tokens, n_types, mean_c, mean_t, buckets),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double", blocks)


def op2_hpy_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(documents(spark, sf_dir), ending=None)
