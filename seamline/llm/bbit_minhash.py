r"""Near duplicates by b-bit MinHash.

Each document's set is its distinct shingles of ``words`` words, as 64-bit hashes. ``ROWS * BANDS`` minima
are taken per set; ``ROWS`` whole minima form a band key, and of every minimum only the low ``BITS`` bits
are kept, packed into a signature. Documents with the same set are one node. Two nodes that share a
band are candidates; the share of equal minima, corrected for the chance collisions of ``BITS`` bits,
estimates their similarity, and those within ``MARGIN`` of the threshold are confirmed on
their full sets. A pair at 0.8 misses every band with a probability of 4.8e-8 and is estimated below the
margin with 0.8e-8, so it is missed with at most 5.6e-8.

No bucket is capped and none is expanded into all its pairs. A bucket's members are first
compared with its smallest node. Where that leaves several components in a bucket, the members
outside its largest one are compared with all its members, in blocks: first by signatures, which joins
them to clusters, then within the clusters by full sets. Pairs within one component need no check.

Null text and text without words have an empty set and link with nothing; a text with fewer words than a
shingle is one shingle. Rows with the same ``doc_id`` are separate documents; of equal rows the first
read is the smallest. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .bit_filter import bits_of, may_hold
from .common import Scratch, documents, numbered, row_id, ship, text_of
from .word_table import LOWER_ASCII, SHORT, WordTable, blank_words, text_bytes

ROWS, BANDS, BITS = 4, 32, 4
HASHES = ROWS * BANDS
WORDS_IN_SIGNATURE = HASHES * BITS // 64
MARGIN = 0.23
BLOCK = 256
MOST_WORDS = 1_000_000
NODE_FILTER = 25  # bits of the filter of nodes whose sets are wanted, as a power of two
_ODD = np.random.default_rng(7).integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_XOR = np.random.default_rng(8).integers(1, 1 << 63, HASHES, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Distinct shingle hashes of texts; the same in every worker."""

    def __init__(self, words: int):
        self.words, self.table, self.hashes = words, WordTable(), np.empty(1 << 16, np.uint64)

    def word_hashes(self, buf: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        if self.table.n > MOST_WORDS:
            self.table = WordTable()
        before = self.table.n
        numbers, new = self.table.lookup(buf, starts, lengths)
        if self.table.n > len(self.hashes):
            self.hashes = np.concatenate([self.hashes, np.empty(self.table.n, np.uint64)])
        fresh = _mix(self.table.low[before:self.table.n] ^ _mix(self.table.high[before:self.table.n] + np.uint64(0x9E3779B97F4A7C15)))
        for k in np.flatnonzero(lengths[new] > SHORT).tolist():
            word = buf[starts[new[k]]:starts[new[k]] + lengths[new[k]]].tobytes()
            fresh[k] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        self.hashes[before:self.table.n] = fresh
        return self.hashes[numbers]

    def sets(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct shingle hashes of all texts, and where each text's begin (one more at the end)."""
        buf, offsets = text_bytes(texts, LOWER_ASCII)
        starts, lengths, first = blank_words(buf, offsets)
        word = self.word_hashes(buf, starts, lengths)
        n, count = self.words, np.diff(first)
        shingle = np.zeros(len(word), np.uint64)
        for k in range(n):  # a shingle begins at every word; those that leave their text go
            shingle[:len(word) - k] = _mix(shingle[:len(word) - k] * np.uint64(31) + word[k:] + np.uint64(k))
        doc = np.repeat(np.arange(len(texts)), count)
        whole = np.arange(len(word)) + n <= first[1:][doc]
        for d in np.flatnonzero((count > 0) & (count < n)).tolist():
            a, b = first[d], first[d + 1]
            value = np.zeros(1, np.uint64)  # arrays wrap around without a warning
            for k in range(a, b):
                value = _mix(value * np.uint64(31) + word[k] + np.uint64(k - a))
            shingle[a], whole[a] = _mix(value + np.uint64(b - a))[0], True
        doc, shingle = doc[whole], shingle[whole]
        order = np.lexsort((shingle, doc))
        doc, shingle = doc[order], shingle[order]
        keep = np.ones(len(doc), bool)
        keep[1:] = (doc[1:] != doc[:-1]) | (shingle[1:] != shingle[:-1])
        return shingle[keep], np.concatenate([[0], np.cumsum(np.bincount(doc[keep], minlength=len(texts)))])


def signatures(flat: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Band keys (sets x BANDS) and packed signatures (sets x words) of sets that are not empty."""
    count = len(ends) - 1
    minima = np.empty((HASHES, count), np.uint64)
    for k in range(HASHES):
        minima[k] = np.minimum.reduceat((flat ^ _XOR[k]) * _ODD[k], ends[:-1]) if count else 0
    keys = np.zeros((BANDS, count), np.uint64)
    for r in range(ROWS):
        keys = _mix(keys * np.uint64(31) + minima[r::ROWS] + np.uint64(1))
    keys = _mix(keys + np.arange(1, BANDS + 1, dtype=np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15))
    # the low bits of a product by an odd number depend on the low bits alone: take them after mixing
    low = _mix(minima) & np.uint64((1 << BITS) - 1)
    packed, per = np.zeros((WORDS_IN_SIGNATURE, count), np.uint64), 64 // BITS
    for k in range(HASHES):
        packed[k // per] |= low[k] << np.uint64(BITS * (k % per))
    return keys.T, packed.T


def unequal(xor: np.ndarray) -> np.ndarray:
    """Number of unequal BITS-bit fields in 64-bit words, summed over the last axis."""
    x, step = xor, 1
    while step < BITS:
        x, step = x | (x >> np.uint64(step)), step * 2
    field = sum(1 << k for k in range(0, 64, BITS))
    return np.bitwise_count(x & np.uint64(field)).sum(axis=-1)


def corrected(equal_share):
    """Similarity from the share of equal fields: chance makes 2**-BITS of the unequal minima agree."""
    chance = 2.0 ** -BITS
    return (equal_share - chance) / (1 - chance)


def _estimate(a: str, b: str) -> Column:
    def unlike(x: Column, y: Column) -> Column:
        v, step = x.bitwiseXOR(y), 1
        while step < BITS:
            v, step = v.bitwiseOR(F.shiftrightunsigned(v, step)), step * 2
        return F.bit_count(v.bitwiseAND(F.lit(sum(1 << k for k in range(0, 63, BITS)))))

    total = F.aggregate(F.zip_with(a, b, unlike), F.lit(0), lambda s, x: s + x)
    return corrected(1 - total / F.lit(float(HASHES)))


def _describe(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                flat, ends = shingler.sets(batch.column(2))
                size = np.diff(ends)
                have = np.flatnonzero(size)
                keys, packed = signatures(flat, np.append(ends[:-1][have], len(flat)))
                mixed = [np.add.reduceat(_mix(flat + np.uint64(s)), ends[:-1][have]) if len(have) else flat for s in (1, 2)]
                cols = []
                for rows in (keys, packed, np.stack(mixed, axis=1) if len(have) else np.zeros((0, 2), np.uint64)):
                    spans = np.zeros(len(size) + 1, np.int32)
                    np.cumsum((size > 0) * rows.shape[1], out=spans[1:])
                    cols.append(pa.ListArray.from_arrays(pa.array(spans), pa.array(np.ascontiguousarray(rows).reshape(-1).view(np.int64))))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(size.astype(np.int64)), *cols],
                                                 ["uid", "doc_id", "n_shingles", "bands", "signature", "set_key"])

    return run


def _sets(words: int, wanted):
    """Whole sets of the rows that the filter ``wanted`` holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for whole in batches:
            rows = whole.filter(pa.array(may_hold(wanted.value, np.asarray(whole.column(0)))))
            for at in range(0, rows.num_rows, 256):
                batch = rows.slice(at, 256)
                flat, ends = shingler.sets(batch.column(1))
                raw = flat.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([raw[8 * a:8 * b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())], pa.binary())],
                    ["node", "shingles"])

    return run


class _Union:
    def __init__(self):
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        while self.up.get(x, x) != x:
            self.up[x] = self.up.get(self.up[x], self.up[x])
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def _unit_links(unit: dict[str, np.ndarray], sets: list[bytes] | None, threshold: float) -> list[tuple[int, int]]:
    """Links of one unit that join components: its x rows (side 0) against its y rows (side 1)."""
    x, y = np.flatnonzero(unit["side"] == 0), np.flatnonzero(unit["side"] == 1)
    sign, comp, size, node = unit["signature"], unit["comp"], unit["n"], unit["node"]
    a = np.repeat(np.arange(len(x)), len(y))
    b = np.tile(np.arange(len(y)), len(x))
    a, b = x[a], y[b]
    fit = (comp[a] != comp[b]) & (np.minimum(size[a], size[b]) >= threshold * np.maximum(size[a], size[b]) - 1e-9)
    a, b = a[fit], b[fit]
    guess = corrected(1 - unequal(sign[a] ^ sign[b]) / HASHES)
    order = np.flatnonzero(guess >= threshold - MARGIN)
    order = order[np.argsort(-guess[order], kind="stable")]
    joined, out, full = _Union(), [], {}
    for i, j in zip(a[order].tolist(), b[order].tolist()):
        p, q = joined.find(int(comp[i])), joined.find(int(comp[j]))
        if p == q:
            continue
        if sets is not None:
            for k in (i, j):
                if k not in full:
                    full[k] = np.frombuffer(sets[k], np.uint64)
            both = len(np.intersect1d(full[i], full[j], assume_unique=True))
            if 100 * both < round(100 * threshold) * (len(full[i]) + len(full[j]) - both):
                continue
        joined.join(p, q)
        out.append((int(node[i]), int(node[j])))
    return out


def _over_units(threshold: float, with_sets: bool):
    """Rows sorted by unit: links of every unit, read block by block."""

    def links(table: pa.Table) -> list[tuple[int, int]]:
        cols = {c: table.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in ("side", "node", "comp", "n")}
        cols["signature"] = np.asarray(table.column("signature").combine_chunks().flatten()).view(np.uint64).reshape(-1, WORDS_IN_SIGNATURE)
        key = [table.column(c).combine_chunks().to_numpy() for c in ("unit", "xb", "yb")]
        change = np.flatnonzero(np.any([k[1:] != k[:-1] for k in key], axis=0)) + 1
        sets = table.column("shingles").to_pylist() if with_sets else None
        out = []
        for a, b in zip([0, *change.tolist()], [*change.tolist(), table.num_rows]):
            out += _unit_links({c: v[a:b] for c, v in cols.items()}, sets[a:b] if sets else None, threshold)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            key = [held.column(c).combine_chunks().to_numpy() for c in ("unit", "xb", "yb")]
            change = np.flatnonzero(np.any([k[1:] != k[:-1] for k in key], axis=0)) + 1
            if len(change):  # the last unit may go on in the next batch
                cut = int(change[-1])
                yield _pairs(links(held.slice(0, cut)))
                held = held.slice(cut)
        if held is not None:
            yield _pairs(links(held))

    def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)], ["a", "b"])

    return run


def _units(members: DataFrame) -> DataFrame:
    """Rows (unit, xb, yb, side, ...) from members (unit, node, minor, n_members, n_minor, ...): blocks of
    the minor members as x against blocks of all members as y."""
    blocks = lambda n: F.ceil(F.col(n) / F.lit(BLOCK)).cast("int")
    own = lambda n: F.pmod(F.xxhash64("node"), blocks(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), blocks(n) - 1))
    rest = [c for c in members.columns if c not in ("minor", "n_members", "n_minor")]
    x = members.filter("minor").select(*rest, F.lit(0).alias("side"), own("n_minor").alias("xb"), each("n_members").alias("yb"))
    y = members.select(*rest, F.lit(1).alias("side"), own("n_members").alias("yb"), each("n_minor").alias("xb"))
    return x.unionByName(y)


def _minors(members: DataFrame, scratch: Scratch, tag: str) -> DataFrame:
    """Members (unit, node, comp) of units with several components, marked where outside the largest one."""
    sizes = members.groupBy("unit", "comp").agg(F.count(F.lit(1)).alias("k"))
    units = scratch.keep(
        sizes.groupBy("unit").agg(F.sum("k").alias("n_members"), F.max(F.struct("k", "comp")).alias("top"), F.count(F.lit(1)).alias("comps"))
        .filter("comps > 1").select("unit", "n_members", (F.col("n_members") - F.col("top.k")).alias("n_minor"), F.col("top.comp").alias("most")),
        f"{tag}-units")
    return members.join(units, "unit").withColumn("minor", F.col("comp") != F.col("most")).drop("most")


def components(edges: DataFrame, scratch: Scratch, tag: str) -> DataFrame:
    """``node, label`` of every node of the edges (a, b): the smallest node reachable."""
    pairs = scratch.keep(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{tag}-pairs")
    labels = scratch.keep(pairs.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")), f"{tag}-0")
    step = 0
    while True:
        step += 1
        near = pairs.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        less = scratch.keep(labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label")), f"{tag}-{step}a")
        jump = less.select(F.col("node").alias("label"), F.col("label").alias("up"))
        new = scratch.keep(less.join(jump, "label").select("node", "old", F.least("label", "up").alias("label")), f"{tag}-{step}")
        labels = new.select("node", "label")
        if new.filter("label <> old").isEmpty():
            return labels


def near_groups(docs: DataFrame, words: int = 5, threshold: float = 0.8) -> DataFrame:
    """``uid, doc_id, n_shingles, component_id, first``: ``first`` marks the one row of each group that stays."""
    spark = docs.sparkSession
    ship(spark)
    scratch = Scratch(spark, "near")
    rows = docs.select(row_id(docs).alias("uid"), F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    described = scratch.keep(rows.mapInArrow(
        _describe(words), "uid long, doc_id long, n_shingles long, bands array<long>, signature array<long>, set_key array<long>"), "described")
    nodes = scratch.keep(  # one node for each set
        described.filter("n_shingles > 0").groupBy("set_key", "n_shingles")
        .agg(F.min("uid").alias("node"), F.first("bands").alias("bands"), F.first("signature").alias("signature")), "nodes")
    bands = scratch.keep(nodes.select("node", F.explode("bands").alias("unit")), "bands")
    shared = scratch.keep(bands.groupBy("unit").agg(F.min("node").alias("root"), F.count(F.lit(1)).alias("k")).filter("k > 1").select("unit", "root"), "shared")
    members = scratch.keep(bands.join(shared, "unit"), "members")
    scratch.drop("bands")
    known = nodes.select("node", F.col("n_shingles").alias("n"), "signature")
    root = known.select(F.col("node").alias("root"), F.col("n").alias("root_n"), F.col("signature").alias("root_signature"))
    stars = members.filter("node <> root").select("node", "root").distinct().join(root, "root").join(known, "node")
    best = (stars.withColumn("guess", _estimate("signature", "root_signature"))
            .filter((F.col("guess") >= threshold - MARGIN) & (F.least("n", "root_n") >= F.lit(threshold) * F.greatest("n", "root_n") - 1e-9))
            .groupBy("node").agg(F.max(F.struct("guess", -F.col("root"))).alias("best")).select("node", (-F.col("best.col2")).alias("root")))
    best = scratch.keep(best, "best")
    involved = best.select("node").unionByName(best.select(F.col("root").alias("node")))

    def shingle_sets(needed: DataFrame, tag: str) -> DataFrame:
        texts = rows.select(F.col("uid").alias("node"), "text")  # filtered in place: the texts are not exchanged
        return scratch.keep(texts.mapInArrow(_sets(words, bits_of(needed, NODE_FILTER)), "node long, shingles binary"), tag)

    def confirmed(units: DataFrame, sets: DataFrame | None) -> DataFrame:
        dealt = units.join(known, "node")
        if sets is not None:
            dealt = dealt.join(sets, "node")
        dealt = dealt.repartition("unit", "xb", "yb").sortWithinPartitions("unit", "xb", "yb", "side", "node")
        return dealt.mapInArrow(_over_units(threshold, sets is not None), "a long, b long")

    # 1. every node against the most similar root of its buckets, the nodes of a root in blocks
    sets = shingle_sets(involved, "sets1")
    block = F.pmod(F.xxhash64("node"), F.ceil(F.col("k") / F.lit(BLOCK))).cast("int")
    stars = best.join(scratch.keep(best.groupBy("root").agg(F.count(F.lit(1)).alias("k")), "fans"), "root")
    under = stars.select(F.col("root").alias("unit"), "node", F.lit(0).alias("xb"), block.alias("yb"), F.lit(1).alias("side"), F.col("node").alias("comp"))
    over = under.select("unit", "xb", "yb").distinct().select("unit", F.col("unit").alias("node"), "xb", "yb", F.lit(0).alias("side"), F.col("unit").alias("comp"))
    links = scratch.keep(confirmed(under.unionByName(over), sets), "links1")
    found = components(links, scratch, "cc1")

    def labelled(df: DataFrame, labels: DataFrame) -> DataFrame:
        return df.join(labels, "node", "left").withColumn("comp", F.coalesce("label", "node")).drop("label")

    # 2. buckets with several components: signatures join their members to clusters
    several = _minors(labelled(members.select("unit", "node"), found), scratch, "buckets")
    likely = scratch.keep(confirmed(_units(several), None), "likely")
    if not likely.isEmpty():
        with_comps = likely.unionByName(found.filter("node <> label").select(F.col("node").alias("a"), F.col("label").alias("b")))
        clusters = components(with_comps, scratch, "clusters")
        # 3. clusters with several components: full sets
        parts = _minors(labelled(clusters.select(F.col("label").alias("unit"), "node"), found), scratch, "parts")
        parts = scratch.keep(parts, "parts")
        more = confirmed(_units(parts), shingle_sets(parts.select("node"), "sets3"))
        links = links.unionByName(scratch.keep(more, "links3"))
        found = components(links, scratch, "cc3")
    node_of = described.join(nodes.select("set_key", "n_shingles", "node"), ["set_key", "n_shingles"], "left")
    grouped = scratch.keep(
        node_of.join(found, "node", "left").select(
            "uid", "doc_id", "n_shingles", F.coalesce("label", "node", "uid").alias("comp")), "grouped")
    smallest = scratch.keep(
        grouped.groupBy("comp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "uid")).alias("least"), F.count(F.lit(1)).alias("k"))
        .filter("k > 1").select("comp", F.col("least.doc_id").alias("least_id"), F.col("least.uid").alias("least_uid")), "smallest")
    alone = F.col("least_uid").isNull()
    return grouped.join(smallest, "comp", "left").select(
        "uid", "doc_id", "n_shingles", F.when(alone, F.col("doc_id")).otherwise(F.col("least_id")).alias("component_id"),
        (alone | (F.col("least_uid") == F.col("uid"))).alias("first"))


def drop_near_copies(docs: DataFrame, words: int = 5, threshold: float = 0.8) -> DataFrame:
    """One row of every group of near duplicates, the one with the smallest ``doc_id``, with all its columns, whatever their names.

    Rows without words stay, repeated rows are copies, a null ``doc_id`` comes last, and an empty table gives no rows.
    """
    kept = near_groups(docs, words, threshold).filter("first").select("uid")
    named, names = numbered(docs)
    return named.withColumn("uid", row_id(docs)).join(kept, "uid", "left_semi").select(*[F.col(c).alias(n) for n, c in zip(docs.columns, names)])


def op7_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_groups(documents(spark, sf_dir), words=2)
    return groups.select("doc_id", "n_shingles", "component_id",
                         F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("first")).alias("kept"))
