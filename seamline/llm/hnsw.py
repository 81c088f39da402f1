"""Approximate nearest neighbours by a hierarchical navigable small-world graph per shard.

Distinct vectors are dealt by hash to shards of about ``SHARD`` vectors. A task builds the graph of one
shard, layer by layer from the top: a new node is linked to near nodes that are found by a beam search
and lie in different directions. A graph is stored as flat arrays: nodes of every layer and their neighbours,
a fixed number each. Blocks of queries meet the graph of every shard, and the best of all shards are merged.
Largest inner product becomes least distance by one added coordinate that gives all vectors of a shard
the same length. Vectors that many rows share are one node, which keeps the ``k + 1`` smallest ids: no
query can return more of them.

Rows whose vector is null, zero, or holds null or non-finite components take no part, nor do those whose
vector is not of the most common length (the smaller of equally common ones); a null id takes no part.
The same id and vector twice count once. Ties go to the smaller id. An empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, ship

SHARD = 8192
LINKS = 16  # of a node in the upper layers, twice as many in the lowest
BUILD_BEAM, SEARCH_BEAM = 96, 240
EXPAND = 4
QUERY_BLOCK = 1024
GRAPH = "shard int, dim int, vectors array<float>, member_ends array<int>, members array<bigint>, layer_ends array<int>, layer_nodes array<int>, links array<int>"


def beam_search(vectors: np.ndarray, links: np.ndarray, rank: np.ndarray, queries: np.ndarray, entry: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``beam`` nodes found nearest to each query (node, squared distance; node -1: fewer found).

    ``links[rank[node]]`` are a node's neighbours in this layer; ``entry`` has the first nodes of each query.
    """
    count, width = len(queries), links.shape[1]
    found = np.full((count, beam), -1, np.int64)
    dist = np.full((count, beam), np.inf)
    done = np.zeros((count, beam), bool)
    seen = np.zeros((count, len(vectors) + 1), bool)
    entry = entry[:, :beam]
    found[:, :entry.shape[1]] = entry
    dist[:, :entry.shape[1]] = ((vectors[entry] - queries[:, None]) ** 2).sum(axis=2)
    seen[np.arange(count)[:, None], entry] = True
    live = np.arange(count)
    expand = min(EXPAND, beam)
    while len(live):
        open_ = np.where(done[live] | (found[live] < 0), np.inf, dist[live])
        pick = np.argpartition(open_, expand - 1, axis=1)[:, :expand]
        some = np.take_along_axis(open_, pick, axis=1) < np.inf
        go = some.any(axis=1)
        live, pick, some = live[go], pick[go], some[go]
        if not len(live):
            break
        rows = live[:, None]
        done[rows, pick] |= some
        nodes = np.where(some, found[rows, pick], -1)
        near = np.where(nodes[:, :, None] >= 0, links[rank[nodes]], -1).reshape(len(live), -1)
        near.sort(axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
        near[seen[rows, near]] = -1
        seen[rows, np.where(near < 0, len(vectors), near)] = True
        away = np.full(near.shape, np.inf)
        r, c = np.nonzero(near >= 0)
        diff = vectors[near[r, c]] - queries[live[r]]
        away[r, c] = np.einsum("ij,ij->i", diff, diff)
        all_dist = np.concatenate([dist[live], away], axis=1)
        keep = np.argpartition(all_dist, beam - 1, axis=1)[:, :beam]
        dist[live] = np.take_along_axis(all_dist, keep, axis=1)
        found[live] = np.where(np.isinf(dist[live]), -1, np.take_along_axis(np.concatenate([found[live], near], axis=1), keep, axis=1))
        done[live] = np.take_along_axis(np.concatenate([done[live], np.zeros(near.shape, bool)], axis=1), keep, axis=1)
    order = np.argsort(dist, axis=1, kind="stable")
    return np.take_along_axis(found, order, axis=1), np.take_along_axis(dist, order, axis=1)


def choose(vectors: np.ndarray, near: np.ndarray, dist: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` of each row's nodes (nearest first): one goes in if no chosen one is nearer to it than the
    row's own node; places left over go to the nearest others."""
    count, width = near.shape
    picked, passed = np.zeros((count, width), bool), np.zeros((count, width), bool)
    point = vectors[near]  # -1 is masked by its infinite distance
    for j in range(width):
        can = np.isfinite(dist[:, j]) & (picked.sum(axis=1) < most)
        if j:
            diff = point[:, :j] - point[:, j:j + 1]
            between = np.where(picked[:, :j], np.einsum("ijk,ijk->ij", diff, diff), np.inf).min(axis=1)
            near_other = between < dist[:, j]
        else:
            near_other = np.zeros(count, bool)
        picked[:, j] = can & ~near_other
        passed[:, j] = can & near_other
    room = most - picked.sum(axis=1)
    picked |= passed & (np.cumsum(passed, axis=1) <= room[:, None])
    order = np.argsort(~picked, axis=1, kind="stable")[:, :most]
    return np.where(np.take_along_axis(picked, order, axis=1), np.take_along_axis(near, order, axis=1), -1)


def build_layer(vectors: np.ndarray, nodes: np.ndarray, most: int, descend) -> np.ndarray:
    """Neighbours (len(nodes) x most, -1: none) of a layer's nodes, which come in in growing batches."""
    rank = np.full(len(vectors) + 1, -1, np.int64)
    rank[nodes] = np.arange(len(nodes))
    links = np.full((len(nodes), most), -1, np.int64)
    at = 0
    while at < len(nodes):
        batch = nodes[at:at + max(32, min(256, at // 2))]
        queries = vectors[batch]
        if at:
            entry = descend(queries, nodes[0])
            entry = np.where(rank[entry] < at, entry, nodes[0])  # the layer above may lead to a node to come
            near, dist = beam_search(vectors, links, rank, queries, entry, BUILD_BEAM)
        else:
            near, dist = np.full((len(batch), 1), -1), np.full((len(batch), 1), np.inf)
        own = ((queries[:, None] - queries[None]) ** 2).sum(axis=2)
        own[np.arange(len(batch)), np.arange(len(batch))] = np.inf
        near = np.concatenate([near, np.broadcast_to(batch, own.shape)], axis=1)
        dist = np.concatenate([dist, own], axis=1)
        order = np.argsort(dist, axis=1, kind="stable")[:, :BUILD_BEAM]
        near, dist = np.take_along_axis(near, order, axis=1), np.take_along_axis(dist, order, axis=1)
        chosen = choose(vectors, near, dist, most // 2 if at else most)
        links[at:at + len(batch), :chosen.shape[1]] = chosen
        # the other way round: who is chosen takes the chooser in, and chooses anew if that is too many
        who, col = np.nonzero(chosen >= 0)
        to, back = chosen[who, col], batch[who]
        order = np.argsort(to, kind="stable")
        to, back = to[order], back[order]
        targets, first, sizes = np.unique(to, return_index=True, return_counts=True)
        offered = np.full((len(targets), most + int(sizes.max(initial=0))), -1, np.int64)
        offered[:, :most] = links[rank[targets]]
        offered[np.repeat(np.arange(len(targets)), sizes), most + np.arange(len(to)) - np.repeat(first, sizes)] = back
        offered.sort(axis=1)
        offered[:, 1:][offered[:, 1:] == offered[:, :-1]] = -1
        diff = vectors[offered] - vectors[targets][:, None]
        away = np.where(offered < 0, np.inf, np.einsum("ijk,ijk->ij", diff, diff))
        order = np.argsort(away, axis=1, kind="stable")
        offered, away = np.take_along_axis(offered, order, axis=1), np.take_along_axis(away, order, axis=1)
        new = choose(vectors, offered, away, most)
        links[rank[targets], :new.shape[1]] = new
        at += len(batch)
    return links


def same_length(vectors: np.ndarray) -> np.ndarray:
    """Vectors with one more coordinate, so that all have the length of the longest."""
    square = (vectors.astype(np.float64) ** 2).sum(axis=1)
    return np.concatenate([vectors, np.sqrt(np.maximum(square.max() - square, 0))[:, None]], axis=1).astype(np.float32)


class Graph:
    """Layers from the top: nodes and flat neighbours."""

    def __init__(self, vectors: np.ndarray, layers: list[tuple[np.ndarray, np.ndarray]]):
        self.vectors = same_length(vectors)
        self.layers = layers
        self.ranks = []
        for nodes, _ in layers:
            rank = np.full(len(vectors) + 1, -1, np.int64)
            rank[nodes] = np.arange(len(nodes))
            self.ranks.append(rank)

    @classmethod
    def build(cls, vectors: np.ndarray, seed: int) -> "Graph":
        level = np.floor(np.random.default_rng(seed).exponential(1 / np.log(LINKS), len(vectors))).astype(int)
        graph = cls(vectors, [])
        for layer in range(int(level.max()), -1, -1):
            nodes = np.flatnonzero(level >= layer)
            links = build_layer(graph.vectors, nodes, LINKS * (1 if layer else 2), graph.descend)
            graph = cls(vectors, [*graph.layers, (nodes, links)])
        return graph

    def descend(self, queries: np.ndarray, start: int) -> np.ndarray:
        """For each query, nodes found in the layers built so far."""
        entry = np.full((len(queries), 1), self.layers[0][0][0] if self.layers else start)
        for (_, links), rank in zip(self.layers, self.ranks):
            found, _ = beam_search(self.vectors, links, rank, queries, entry, 8)
            entry = np.where(found < 0, found[:, :1], found)
            entry = entry[:, :1]
        return entry

    def search(self, queries: np.ndarray, beam: int) -> np.ndarray:
        """Nodes near each query (-1: fewer found)."""
        queries = np.concatenate([queries, np.zeros((len(queries), 1), queries.dtype)], axis=1)
        *upper, (_, links) = self.layers
        top = Graph.__new__(Graph)
        top.vectors, top.layers, top.ranks = self.vectors, upper, self.ranks[:-1]
        entry = top.descend(queries, self.layers[-1][0][0])
        return beam_search(self.vectors, links, self.ranks[-1], queries, entry, min(beam, len(self.vectors)))[0]


def _build(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("rep").reset_index(drop=True)
    vectors = np.stack(rows["embedding"].to_numpy()).astype(np.float32)
    graph = Graph.build(vectors, int(rows["shard"][0]))
    sizes = [len(m) for m in rows["members"]]
    return pd.DataFrame([{
        "shard": int(rows["shard"][0]), "dim": vectors.shape[1], "vectors": vectors.reshape(-1),
        "member_ends": np.cumsum(sizes).astype(np.int32), "members": np.concatenate(rows["members"].to_numpy()).astype(np.int64),
        "layer_ends": np.cumsum([len(n) for n, _ in graph.layers]).astype(np.int32),
        "layer_nodes": np.concatenate([n for n, _ in graph.layers]).astype(np.int32),
        "links": np.concatenate([k.reshape(-1) for _, k in graph.layers]).astype(np.int32)}])


def _load(row) -> Graph:
    vectors = np.asarray(row["vectors"], np.float32).reshape(-1, row["dim"])
    layers, links, at = [], np.asarray(row["links"], np.int64), 0
    ends = np.asarray(row["layer_ends"])
    for k, nodes in enumerate(np.split(np.asarray(row["layer_nodes"], np.int64), ends[:-1])):
        most = LINKS * (2 if k == len(ends) - 1 else 1)
        layers.append((nodes, links[at:at + len(nodes) * most].reshape(len(nodes), most)))
        at += len(nodes) * most
    return Graph(vectors, layers)


def _search(k: int, queries: pd.DataFrame, graphs: pd.DataFrame) -> pd.DataFrame:
    """The ``k`` best members of one shard for a block of queries, exact scores."""
    out = {"query_id": [], "vec_id": [], "score": []}
    if len(queries) and len(graphs):
        row = graphs.iloc[0]
        graph, dim = _load(row), row["dim"]
        vectors = np.asarray(row["vectors"], np.float32).reshape(-1, dim)
        ends = np.asarray(row["member_ends"], np.int64)
        starts, members = np.concatenate([[0], ends[:-1]]), np.asarray(row["members"], np.int64)
        for at in range(0, len(queries), 256):
            some = queries.iloc[at:at + 256]
            asked = np.stack(some["embedding"].to_numpy()).astype(np.float32)
            for own, query, found in zip(some["query_id"].to_numpy(), asked, graph.search(asked, SEARCH_BEAM)):
                found = found[found >= 0][:4 * (k + 1)]
                score = (vectors[found].astype(np.float64) * query.astype(np.float64)).sum(axis=1)
                sizes = ends[found] - starts[found]
                ids = members[np.repeat(starts[found], sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)]
                scores = np.repeat(score, sizes)
                other = ids != own
                ids, scores = ids[other], scores[other]
                best = np.lexsort((ids, -scores))[:k]
                out["query_id"].append(np.full(len(best), own))
                out["vec_id"].append(ids[best])
                out["score"].append(scores[best])
    return pd.DataFrame({c: np.concatenate(v) if v else np.empty(0, np.float64 if c == "score" else np.int64) for c, v in out.items()})


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``queries``, its ``k`` nearest rows of ``vectors`` found.

    Both have ``vec_id`` and ``embedding``.
    """
    spark = vectors.sparkSession
    ship(spark)
    scratch = Scratch(spark, "hnsw")

    def usable(df: DataFrame) -> DataFrame:
        e = F.col("embedding")
        good = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
        return df.select(F.col("vec_id").cast("long").alias("vec_id"), e.cast("array<float>").alias("embedding")).filter(
            F.col("vec_id").isNotNull() & e.isNotNull() & F.forall(e, good) & F.exists(e, lambda x: x != 0))

    rows = usable(vectors)
    sizes = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if sizes is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.filter(F.size("embedding") == sizes["d"])
    asked = usable(queries).filter(F.size("embedding") == sizes["d"]).select(F.col("vec_id").alias("query_id"), "embedding").distinct()
    # the smallest ids of each distinct vector: first in parts, so that a vector that many rows share is spread
    part = F.pmod(F.xxhash64("vec_id"), F.lit(64))
    first = Window.partitionBy("embedding", "part").orderBy("vec_id")
    then = Window.partitionBy("embedding").orderBy("vec_id")
    few = rows.distinct().withColumn("part", part).withColumn("r", F.row_number().over(first)).filter(F.col("r") <= k + 1)
    few = few.select("embedding", "vec_id").withColumn("r", F.row_number().over(then)).filter(F.col("r") <= k + 1)
    nodes = scratch.keep(few.groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("members"))
                         .select(F.col("members")[0].alias("rep"), "members", "embedding"), "nodes")
    shards = max(1, -(-nodes.count() // SHARD))
    dealt = nodes.withColumn("shard", F.pmod(F.xxhash64("embedding"), F.lit(shards)).cast("int"))
    graphs = scratch.keep(dealt.groupBy("shard").applyInPandas(_build, GRAPH), "graphs")
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    met = asked.withColumn("block", F.pmod(F.xxhash64("query_id", "embedding"), F.lit(blocks)).cast("int"))
    met = met.select("*", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    ready = graphs.select("*", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    hits = met.groupBy("shard", "block").cogroup(ready.groupBy("shard", "block")).applyInPandas(
        partial(_search, k), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op6_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet")
    return nearest(rows, rows.filter(F.col("vec_id") % 20 == 0))
