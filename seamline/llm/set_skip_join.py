r"""Exact Jaccard joins of word n-gram sets by skipping over set relations.

A document's set is its distinct shingles of ``words`` words, as 64-bit hashes; documents with the same set are one
node. Shingles are ordered by how often they occur in the corpus (counted in ``SLOTS`` slots, frequent ones last, then by hash), and
a set is entered into the index lists of its prefix, the first ``n - ceil(t * n) + 1`` shingles, with its size and position.

*Index lists.* Two linked sets meet in the list of their first common shingle, where the lesser of what follows on both
sides must reach the overlap that the threshold asks for. Entries of a list are sorted by size and position, and all
pairs of two blocks of equal size and position are skipped by one test. What is left is tested with parity
bitmaps: their bits differ at most where the sets do, so no link is lost.

*Answers.* Each set is first compared with one similar set, the member that leads most of its lists, and keeps
what it lacks of that pivot and adds to it. Sets of one component need no further answer. Where a list still holds several
components, its members outside the largest one are tested with all its members, in blocks, and the pairs that a spanning forest
of the remaining ones needs are checked: sets with a common pivot from their differences to it, without the sets
themselves, other pairs on their full sets. If a check fails, a last round checks every remaining pair
of different components.

Hashes of different shingles are taken to differ (64 bits; for sets as wholes 128). Null text and text without words have an
empty set and link with nothing; a text with fewer words than a shingle is one shingle. Rows with the same ``doc_id``
are separate documents; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .bbit_minhash import NODE_FILTER, Shingler, _minors, _mix, _Union, _units, components
from .bit_filter import bits_of, held_rows, may_hold
from .common import Scratch, arrow_rows, documents, releasing, row_id, ship, text_of
from .pair_check import overlaps, overlaps_by_deltas

SLOT_BITS = 22  # slots of the corpus counts: 4 MiB, whatever the corpus
PART_BITS = 16
LEAST_BITS = 512  # of a bitmap
TOKEN_FILTER = 27  # bits of the filter of shared shingles, as a power of two
PAIRS = 1 << 20  # tested together
MEMBERS = 256  # of a list that is tested as one block
FEW = 8  # members of a list whose pairs are tested before they get their bitmaps
BATCH_ROWS = 1024  # texts, sets or bitmaps that go to Python together


def prefix_size(n, percent: int):
    return n - -(-percent * n // 100) + 1


def needed(total, percent: int):
    """The overlap that two sets of ``total`` elements together must have."""
    return -(-percent * total // (100 + percent))


def _count_slots(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, counts = Shingler(words), np.zeros(1 << SLOT_BITS, np.int64)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                flat, _ = shingler.sets(whole.slice(at, 256).column(0))
                np.add.at(counts, (flat >> np.uint64(64 - SLOT_BITS)).astype(np.int64), 1)  # in place: no second table of all slots
        parts = counts.reshape(-1, 1 << PART_BITS)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(parts), dtype=np.int32)), pa.array([zlib.compress(p.tobytes(), 1) for p in parts], pa.binary())], ["part", "counts"])

    return run


def _sum_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts in, their sums out, on a scale of eighths of a power of two."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts = np.frombuffer(zlib.decompress(counts), np.int64)
            sums[part] = sums[part] + counts if part in sums else counts
    scaled = [np.minimum(8 * np.log2(np.maximum(s, 1)), 255).astype(np.uint8).tobytes() for s in sums.values()]
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(scaled, pa.binary())], ["part", "counts"])


def corpus_order(texts: DataFrame, words: int) -> np.ndarray:
    """For each slot of shingle hashes, about how often its shingles occur in all documents (``1 << SLOT_BITS`` bytes)."""
    parts = texts.mapInArrow(releasing(_count_slots(words)), "part int, counts binary")
    summed = parts.repartition("part").mapInArrow(releasing(_sum_slots), "part int, counts binary")
    out = np.zeros((1 << (SLOT_BITS - PART_BITS), 1 << PART_BITS), np.uint8)
    for r in summed.collect():  # as many rows as parts
        out[r["part"]] = np.frombuffer(r["counts"], np.uint8)
    return out.reshape(-1)


def bitmap_bits(n: np.ndarray) -> np.ndarray:
    """Bits of the bitmap of a set of ``n`` elements."""
    return np.maximum(LEAST_BITS, 1 << np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64))


def bitmaps(flat: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """Parity bitmaps: each element turns one bit."""
    size = np.diff(ends)
    bits = bitmap_bits(size)
    at = np.concatenate([[0], np.cumsum(bits)])
    spot = np.repeat(at[:-1], size) + (_mix(flat).astype(np.int64) & np.repeat(bits - 1, size))
    odd = np.packbits((np.bincount(spot, minlength=int(at[-1])) & 1).astype(bool), bitorder="little").tobytes()
    return [odd[a // 8:b // 8] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]


def _describe(words: int, percent: int, order):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, often = Shingler(words), np.frombuffer(order.value, np.uint8)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                flat, ends = shingler.sets(batch.column(2))
                size = np.diff(ends)
                have = np.flatnonzero(size)
                doc = np.repeat(np.arange(len(size)), size)
                by = np.lexsort((flat, often[(flat >> np.uint64(64 - SLOT_BITS)).astype(np.int64)], doc))
                place = np.arange(len(flat)) - ends[:-1][doc]
                first = place < prefix_size(size, percent)[doc]
                tokens = flat[by][first]
                spans = np.concatenate([[0], np.cumsum(np.where(size > 0, prefix_size(size, percent), 0))]).astype(np.int32)
                mixed = [np.add.reduceat(_mix(flat + np.uint64(s)), ends[:-1][have]) if len(have) else flat for s in (1, 2)]
                keys = np.zeros((len(size), 2), np.uint64)
                keys[have] = np.stack(mixed, axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(size.astype(np.int32)), *[pa.array(np.ascontiguousarray(keys[:, k]).view(np.int64)) for k in (0, 1)],
                     pa.ListArray.from_arrays(pa.array(spans), pa.array(tokens.view(np.int64))), pa.array(bitmaps(flat, ends), pa.binary())],
                    ["uid", "doc_id", "n", "key1", "key2", "prefix", "bits"])

    return run


def _entries(shared):
    """Index entries of the prefixes' shingles that other prefixes may hold too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prefix = batch.column(2)
            ends = prefix.offsets.to_numpy().astype(np.int64)
            tokens = prefix.values.to_numpy()[ends[0]:ends[-1]]
            row = np.repeat(np.arange(batch.num_rows), np.diff(ends))
            pos = np.arange(len(tokens)) - (ends[:-1] - ends[0])[row]
            at = np.flatnonzero(may_hold(shared.value, tokens))
            of = pa.array(row[at])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(of), batch.column(1).take(of), pa.array(pos[at].astype(np.int32)), pa.array(tokens[at])],
                                             ["node", "n", "pos", "unit"])

    return run


def _expanded(x_from: np.ndarray, x_to: np.ndarray, y_from: np.ndarray, y_to: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of the ranges [x_from, x_to) and [y_from, y_to), some at a time."""
    count = (x_to - x_from) * (y_to - y_from)
    total = np.cumsum(count)
    at = 0
    while at < len(count):
        base = total[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(total, base + PAIRS, side="right")))
        some = slice(at, end)
        of = np.repeat(np.arange(at, end), count[some])
        nth = np.arange(len(of)) - np.repeat(np.cumsum(count[some]) - count[some], count[some])
        wide = (y_to - y_from)[of]
        yield x_from[of] + nth // wide, y_from[of] + nth % wide
        at = end


class _Bitmaps:
    """Bitmaps of rows. Sets of similar size have as many bits or half of them: the longer one is folded."""

    def __init__(self, column: pa.Array):
        raw = column.to_pylist()
        self.bits = np.array([8 * len(r) for r in raw], np.int64)
        self.row, self.of = np.zeros(len(raw), np.int64), {}
        for b in np.unique(self.bits).tolist():
            own = np.flatnonzero(self.bits == b)
            words = np.frombuffer(b"".join([raw[k] for k in own.tolist()]), np.uint64).reshape(len(own), -1)
            self.row[own] = np.arange(len(own))
            self.of[b, 0], self.of[b, 1] = words, words[:, :b // 128] ^ words[:, b // 128:]

    def differ(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many bits differ."""
        out = np.zeros(len(i), np.int64)
        turn = self.bits[i] > self.bits[j]
        i, j = np.where(turn, j, i), np.where(turn, i, j)
        for b, folds in np.unique(np.stack([self.bits[i], self.bits[j] // self.bits[i] - 1], axis=1), axis=0).tolist():
            own = np.flatnonzero((self.bits[i] == b) & (self.bits[j] == b << folds))
            out[own] = np.bitwise_count(self.of[b, 0][self.row[i[own]]] ^ self.of[b << folds, folds][self.row[j[own]]]).sum(axis=1)
        return out


def surviving(n: np.ndarray, pos: np.ndarray, comp: np.ndarray, side: np.ndarray, key: np.ndarray, alone: np.ndarray,
              bits: _Bitmaps, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Row numbers of pairs that no test excludes, with how many bits differ.

    Rows are sorted by ``key`` (a list's block pair), side, size and position. Side 0 meets side 1; where a key is
    ``alone`` (all rows of a list, once each) it meets side 0 too.
    """
    new = np.ones(len(n), bool)
    new[1:] = (key[1:] != key[:-1]) | (side[1:] != side[:-1]) | (n[1:] != n[:-1]) | (pos[1:] != pos[:-1])
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(n))
    keys = key[begin]
    left = np.flatnonzero(side[begin] == 0)
    right = np.flatnonzero((side[begin] == 1) | alone[begin])
    low, high = np.searchsorted(keys[right], keys[left], side="left"), np.searchsorted(keys[right], keys[left], side="right")
    for x, y in _expanded(left, left + 1, low, high):
        y = right[y]
        a, b = begin[x], begin[y]
        small, large = np.minimum(n[a], n[b]), np.maximum(n[a], n[b])
        fit = 100 * small >= percent * large
        fit &= np.minimum(n[a] - pos[a], n[b] - pos[b]) >= needed(n[a] + n[b], percent)
        x, y = x[fit], y[fit]  # the other blocks are skipped whole
        for i, j in _expanded(begin[x], end[x], begin[y], end[y]):
            other = comp[i] != comp[j]
            i, j = i[other], j[other]
            off = bits.differ(i, j)
            total = n[i] + n[j]
            near = off <= total - 2 * needed(total, percent)
            yield i[near], j[near], off[near]


def _candidates(percent: int, forest: bool):
    """Pairs of nodes from rows sorted by unit, xb, yb, side, n, pos: all that survive, or those of a spanning forest."""

    def pairs(table: pa.Table, joined: _Union) -> pa.RecordBatch:
        col = {c: table.column(c).combine_chunks().to_numpy() for c in ("unit", "xb", "yb", "side", "node", "comp", "n", "pos")}
        change = np.zeros(table.num_rows, bool)
        for c in ("unit", "xb", "yb"):
            change[1:] |= col[c][1:] != col[c][:-1]
        bits = _Bitmaps(table.column("bits").combine_chunks())
        out = []
        for i, j, off in surviving(col["n"].astype(np.int64), col["pos"].astype(np.int64), col["comp"], col["side"], np.cumsum(change),
                                     col["xb"] < 0, bits, percent):
            if forest:
                order = np.argsort(off, kind="stable")
                i, j = i[order], j[order]
                take = [joined.join(p, q) for p, q in zip(col["comp"][i].tolist(), col["comp"][j].tolist())]
                i, j = i[take], j[take]
            out.append(np.stack([np.minimum(col["node"][i], col["node"][j]), np.maximum(col["node"][i], col["node"][j])], axis=1))
        both = np.unique(np.concatenate(out), axis=0) if out else np.empty((0, 2), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, joined = None, _Union()
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            key = [held.column(c).combine_chunks().to_numpy() for c in ("unit", "xb", "yb")]
            change = np.flatnonzero(np.any([k[1:] != k[:-1] for k in key], axis=0)) + 1
            if len(change):  # the last block pair may go on in the next batch
                yield pairs(held.slice(0, int(change[-1])), joined)
                held = held.slice(int(change[-1]))
        if held is not None:
            yield pairs(held, joined)

    return run


def _short_lists(percent: int):
    """Pairs of short lists, rows sorted by unit, size and position, that size and position don't exclude."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if last is None else pa.concat_tables([last, table])
            unit = table.column("unit").to_numpy()
            cut = int(np.searchsorted(unit, unit[-1])) if len(unit) else 0
            last = table.slice(cut)
            yield pairs(table.slice(0, cut))
        if last is not None:
            yield pairs(last)

    def pairs(table: pa.Table) -> pa.RecordBatch:
        unit, node, n, pos, comp = (table.column(c).to_numpy().astype(np.int64) for c in ("unit", "node", "n", "pos", "comp"))
        out = []
        for step in range(1, FEW):
            i = np.flatnonzero(unit[step:] == unit[:-step]) if step < len(unit) else np.empty(0, np.int64)
            j = i + step
            fit = (comp[i] != comp[j]) & (100 * n[i] >= percent * n[j]) & (np.minimum(n[i] - pos[i], n[j] - pos[j]) >= needed(n[i] + n[j], percent))
            i, j = i[fit], j[fit]
            out.append(np.stack([np.minimum(node[i], node[j]), np.maximum(node[i], node[j])], axis=1))
        both = np.unique(np.concatenate(out), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])

    return run


def _near(percent: int):
    """Pairs whose bitmaps differ in few enough bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = _Bitmaps(pa.chunked_array([batch.column("a_bits"), batch.column("b_bits")]).combine_chunks())
            i = np.arange(batch.num_rows)
            total = np.asarray(batch.column("total")).astype(np.int64)
            near = bits.differ(i, i + batch.num_rows) <= total - 2 * needed(total, percent)
            yield batch.select(["a", "b"]).filter(pa.array(near))

    return run


def _linked(percent: int) -> Column:
    return 100 * F.col("both") >= percent * (F.col("na") + F.col("nb") - F.col("both"))


def similar_groups(docs: DataFrame, words: int = 3, percent: int = 90) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row: links are pairs with a Jaccard similarity of ``percent`` or more."""
    spark = docs.sparkSession
    ship(spark)
    with arrow_rows(spark, BATCH_ROWS):  # all jobs with Python in them end here, none is left to the returned frame
        return _groups(docs, words, percent)


def _groups(docs: DataFrame, words: int, percent: int) -> DataFrame:
    spark = docs.sparkSession
    scratch = Scratch(spark, "skip")
    rows = docs.select(row_id(docs).alias("uid"), F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    order = spark.sparkContext.broadcast(corpus_order(rows.select("text"), words).tobytes())
    described = scratch.keep(rows.mapInArrow(
        releasing(_describe(words, percent, order)), "uid long, doc_id long, n int, key1 long, key2 long, prefix array<long>, bits binary"), "described")
    node_of = scratch.keep(
        described.filter("n > 0").groupBy("key1", "key2", "n").agg(F.min("uid").alias("node")), "node_of")
    # a copy that the filter lets through is a node of its own, linked with the others
    nodes = scratch.keep(held_rows(described.select("uid", "n", "prefix"), "uid", bits_of(node_of.select("node"), NODE_FILTER)), "nodes")
    shared = scratch.keep(nodes.select(F.explode("prefix").alias("unit")).groupBy("unit").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("unit"), "shared")
    entries = nodes.mapInArrow(releasing(_entries(bits_of(shared, TOKEN_FILTER))), "node long, n int, pos int, unit long")
    members = scratch.keep(entries.join(shared, "unit"), "members")
    scratch.drop("nodes")
    lead = members.groupBy("unit").agg(F.min("node").alias("root"))
    root = members.select("unit", F.col("node").alias("root"), F.col("n").alias("root_n"), F.col("pos").alias("root_pos"))
    led = members.join(lead.join(root, ["unit", "root"]), "unit")

    # 1. each set against the leading member of most of its lists
    total = F.col("n") + F.col("root_n")
    fit = ((100 * F.least("n", "root_n") >= percent * F.greatest("n", "root_n"))
           & (F.least(F.col("n") - F.col("pos"), F.col("root_n") - F.col("root_pos")) >= F.floor((percent * total + (99 + percent)) / (100 + percent))))
    pivots = (led.filter((F.col("node") != F.col("root")) & fit).groupBy("node", "root").agg(F.count(F.lit(1)).alias("lists"))
              .groupBy("node").agg(F.max(F.struct("lists", -F.col("root"))).alias("best")).select(F.col("node").alias("a"), (-F.col("best.col2")).alias("b")))
    pivots = scratch.keep(pivots, "pivots")

    def texts_of(pairs: DataFrame) -> DataFrame:
        wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))
        return held_rows(rows.select(F.col("uid").alias("node"), "text"), "node", bits_of(wanted, NODE_FILTER))

    relation = scratch.keep(overlaps(pivots, texts_of(pivots), words), "relation")
    scratch.drop("pivots")
    links = relation.filter(_linked(percent)).select("a", "b")
    found = components(links, scratch, "cc1")

    def remaining(tag: str, forest: bool, open_comps: DataFrame | None) -> DataFrame:
        """Candidate pairs of lists with several components (of ``open_comps``)."""
        entries = members.select("unit", "node", "n", "pos")
        if open_comps is not None:  # a node without links is its own component
            nodes = open_comps.join(found, F.col("comp") == F.col("label"), "left").select(F.coalesce("node", "comp").alias("node"))
            entries = held_rows(entries, "node", bits_of(nodes, NODE_FILTER))
        labelled = entries.join(found, "node", "left").withColumn("comp", F.coalesce("label", "node")).drop("label")
        if open_comps is not None:
            labelled = labelled.join(open_comps, "comp", "left_semi")
        several = _minors(labelled, scratch, tag)
        known = described.select("uid", "n", "bits")
        few = several.filter(F.col("n_members") <= FEW).select("unit", "node", "n", "pos", "comp").repartition("unit").sortWithinPartitions("unit", "n", "pos")
        pairs = few.mapInArrow(releasing(_short_lists(percent)), "a long, b long").distinct()
        for s in ("a", "b"):
            pairs = pairs.join(known.select(F.col("uid").alias(s), F.col("n").alias(f"{s}_n"), F.col("bits").alias(f"{s}_bits")), s)
        short = pairs.select("a", "b", (F.col("a_n") + F.col("b_n")).alias("total"), "a_bits", "b_bits").mapInArrow(releasing(_near(percent)), "a long, b long")
        one = several.filter((F.col("n_members") > FEW) & (F.col("n_members") <= MEMBERS)).withColumn("side", F.when(F.col("minor"), 0).otherwise(1)).select(
            *[c for c in several.columns if c not in ("minor", "n_members", "n_minor")], "side", F.lit(-1).alias("xb"), F.lit(-1).alias("yb"))
        dealt = one.unionByName(_units(several.filter(F.col("n_members") > max(MEMBERS, FEW))))
        dealt = dealt.join(known.select(F.col("uid").alias("node"), "bits"), "node")
        dealt = dealt.repartition("unit", "xb", "yb").sortWithinPartitions("unit", "xb", "yb", "side", "n", "pos")
        return scratch.keep(dealt.mapInArrow(releasing(_candidates(percent, forest)), "a long, b long").unionByName(short).distinct(), f"{tag}-pairs")

    near = relation.filter((F.length("lacks") + F.length("adds")) < 8 * F.least("na", "nb"))

    def checked(pairs: DataFrame, tag: str) -> DataFrame:
        """``a, b, na, nb, both`` of candidate pairs, from what is known of their pivots where it is the same."""
        of = {s: near.select(F.col("a").alias(s), F.col("b").alias(f"{s}_pivot"), F.col("nb").alias("size"), F.col("lacks").alias(f"{s}_lacks"),
                             F.col("adds").alias(f"{s}_adds")) for s in ("a", "b")}
        same = pairs.join(of["a"], "a").join(of["b"].drop("size"), "b").filter("a_pivot = b_pivot")
        derived = scratch.keep(overlaps_by_deltas(same), f"{tag}-derived")
        rest = scratch.keep(pairs.join(derived.select("a", "b"), ["a", "b"], "left_anti"), f"{tag}-rest")
        full = scratch.keep(overlaps(rest, texts_of(rest), words).select("a", "b", "na", "nb", "both"), f"{tag}-full")
        return derived.unionByName(full)

    # 2. a spanning forest of what lists hold beyond components
    asked = relation.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    open_comps = None
    for tag, forest in (("forest", True), ("all", False)):
        pairs = remaining(tag, forest, open_comps)
        answers = scratch.keep(checked(scratch.keep(pairs.join(asked, ["a", "b"], "left_anti"), f"{tag}-new"), tag), f"{tag}-answers")
        more = answers.filter(_linked(percent)).select("a", "b")
        links = links.unionByName(more)
        found = components(links, scratch, f"cc-{tag}")
        failed = scratch.keep(pairs.join(more, ["a", "b"], "left_anti"), f"{tag}-failed")
        if failed.isEmpty():
            break
        # 3. a pair that the forest left out may hang on a failed one, and then both its components do: all their pairs are checked
        asked = asked.unionByName(answers.select("a", "b"))
        ends = failed.select(F.col("a").alias("node")).unionByName(failed.select(F.col("b").alias("node")))
        open_comps = ends.join(found, "node", "left").select(F.coalesce("label", "node").alias("comp")).distinct()
    return _described(described, node_of, found, scratch)


def _described(described: DataFrame, node_of: DataFrame, found: DataFrame, scratch: Scratch) -> DataFrame:
    """Each row with the smallest ``doc_id`` of its component."""
    keyed = described.select("uid", "doc_id", F.col("n").cast("long").alias("n_shingles"), "n", "key1", "key2")
    placed = keyed.join(node_of, ["key1", "key2", "n"], "left").join(found, "node", "left")
    grouped = scratch.keep(placed.select("doc_id", "n_shingles", F.coalesce("label", "node", "uid").alias("comp")), "grouped")
    least = grouped.groupBy("comp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("k")).filter("k > 1").select("comp", "least")
    return grouped.join(least, "comp", "left").select("doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"))


def op12_set_skip_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_groups(documents(spark, sf_dir))
