"""Exact duplicates by deterministic block naming.

Every text is cut into blocks of ``BLOCK_CHARS`` characters. The distinct blocks are sorted and
named by their rank; then adjacent names are paired, the distinct pairs sorted and named by their
rank, level by level, until a document has one name. ``(level, name)`` is equal for two texts only
if they are equal: no step relies on a hash being free of collisions. Blocks are sorted by length,
hash and, where two contents share both, by content, so full contents move through one shuffle.

Null text counts as empty, and empty texts equal each other. Of equal rows (also those with the same
``doc_id``) exactly one stays: the largest ``doc_id``, a null one last, and of the same ids the
last row read. An empty table gives no rows. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, documents, numbered, row_id, text_of

BLOCK_CHARS = 16384


def _blocks(text: str, block_chars: int) -> Column:
    cut = F.regexp_extract_all(F.col(text), F.lit("(?s).{1,%d}" % block_chars), F.lit(0))
    return F.when(F.length(text) <= block_chars, F.array(F.col(text))).otherwise(cut)


def sorted_names(keys: DataFrame, cols: list[str], scratch: Scratch, tag: str) -> DataFrame:
    """Distinct rows of ``keys`` with ``name``: their rank in the order of ``cols``, from 0."""
    placed = keys.repartitionByRange(*cols).sortWithinPartitions(*cols)
    ranked = scratch.keep(
        placed.withColumn("__id", F.monotonically_increasing_id())
        .select(*cols, F.shiftright("__id", 33).alias("__part"), F.col("__id").bitwiseAND((1 << 33) - 1).alias("__at")), tag)
    # one row per partition of the sort, whatever the number of names
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    bases = ranked.groupBy("__part").agg(F.count(F.lit(1)).alias("__n")).select(
        "__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    return ranked.join(F.broadcast(bases), "__part").select(*cols, (F.col("__base") + F.col("__at")).alias("name"))


def _block_names(rows: DataFrame, cut: DataFrame, scratch: Scratch, digest) -> DataFrame:
    """Level 0: ``cut`` (uid, pos, len, hash) with the name of each block; ``rows`` has the contents."""
    contents = rows.select(F.explode("blocks").alias("block")).select(
        F.length("block").alias("len"), digest("block").alias("hash"), "block")
    keys = scratch.keep(
        contents.groupBy("len", "hash").agg(F.min("block").alias("lo"), F.max("block").alias("hi"))
        .select("len", "hash", (F.col("lo") != F.col("hi")).alias("clash")), "blocks")
    clashes = keys.filter("clash").select("len", "hash")
    if clashes.isEmpty():
        names = sorted_names(keys.select("len", "hash"), ["len", "hash"], scratch, "names0")
        return cut.join(names, ["len", "hash"]).select("uid", "pos", "name")
    several = contents.join(clashes, ["len", "hash"], "left_semi").distinct()
    order = ["len", "hash", "block"]
    names = scratch.keep(sorted_names(
        keys.filter("not clash").select("len", "hash", F.lit("").alias("block")).unionByName(several),
        order, scratch, "names0"), "named0")
    # only blocks whose length and hash are shared by other contents are looked up by content
    plain = cut.join(clashes, ["len", "hash"], "left_anti").join(names.drop("block"), ["len", "hash"])
    full = (rows.select("uid", F.posexplode("blocks").alias("pos", "block"))
            .withColumns({"len": F.length("block"), "hash": digest("block")})
            .join(clashes, ["len", "hash"], "left_semi").join(names, order))
    return plain.select("uid", "pos", "name").unionByName(full.select("uid", "pos", "name"))


def text_identities(docs: DataFrame, scratch: Scratch, block_chars: int = BLOCK_CHARS, digest=F.xxhash64) -> DataFrame:
    """``uid, doc_id, text_sha256, level, name``: equal (level, name) means equal texts.

    ``uid`` is ``monotonically_increasing_id()`` of the rows of ``docs``.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"),
                       row_id(docs).alias("uid"))
    rows = rows.withColumn("blocks", _blocks("text", block_chars))
    cut = scratch.keep(
        rows.select("uid", "doc_id", F.sha2("text", 256).alias("text_sha256"), F.size("blocks").alias("n_blocks"),
                    F.transform("blocks", lambda b: F.struct(F.length(b).alias("len"), digest(b).alias("hash"))).alias("keys")),
        "cut")
    exploded = cut.select("uid", F.posexplode("keys").alias("pos", "key")).select("uid", "pos", "key.len", "key.hash")
    named = scratch.keep(_block_names(rows, exploded, scratch, digest), "level0")
    state = named.join(cut.select("uid", "n_blocks"), "uid")
    whole = [scratch.keep(state.filter("n_blocks = 1").select("uid", F.lit(0).alias("level"), "name"), "whole0")]
    most = cut.agg(F.max("n_blocks")).first()[0] or 1
    state, level = scratch.keep(state.filter("n_blocks > 1"), "open0"), 0
    while most > 1:
        level, most = level + 1, -(-most // 2)
        pairs = scratch.keep(
            state.groupBy("uid", "n_blocks", F.shiftright("pos", 1).alias("pos")).agg(
                F.max(F.when(F.col("pos").bitwiseAND(1) == 0, F.col("name"))).alias("left"),
                F.coalesce(F.max(F.when(F.col("pos").bitwiseAND(1) == 1, F.col("name"))), F.lit(-1)).alias("right")),
            f"pairs{level}")
        names = sorted_names(pairs.select("left", "right").distinct(), ["left", "right"], scratch, f"names{level}")
        state = scratch.keep(
            pairs.join(names, ["left", "right"])
            .select("uid", "pos", "name", F.ceil(F.col("n_blocks") / 2).cast("int").alias("n_blocks")), f"level{level}")
        whole.append(state.filter("n_blocks = 1").select("uid", F.lit(level).alias("level"), "name"))
        state = state.filter("n_blocks > 1")
    names = whole[0]
    for more in whole[1:]:
        names = names.unionByName(more)
    return cut.select("uid", "doc_id", "text_sha256").join(names, "uid")


def exact_groups(docs: DataFrame, block_chars: int = BLOCK_CHARS, digest=F.xxhash64) -> DataFrame:
    """``uid, doc_id, keep_id, group_size, kept, text_sha256``, one row per row of ``docs``."""
    scratch = Scratch(docs.sparkSession, "names")
    ids = scratch.keep(text_identities(docs, scratch, block_chars, digest), "identities")
    groups = scratch.keep(
        ids.groupBy("level", "name").agg(F.max(F.struct("doc_id", "uid")).alias("keep"), F.count(F.lit(1)).alias("group_size"))
        .filter("group_size > 1").select("level", "name", F.col("keep.doc_id").alias("keep_id"),
                                         F.col("keep.uid").alias("keep_uid"), "group_size"), "groups")
    alone = F.col("group_size").isNull()
    return ids.join(groups, ["level", "name"], "left").select(
        "uid", "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"),
        (alone | (F.col("uid") == F.col("keep_uid"))).alias("kept"), "text_sha256")


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, whatever their names.

    Null texts are copies of empty ones, a null ``doc_id`` stays only where no other row does, and an empty table gives no rows.
    """
    kept = exact_groups(docs).filter("kept").select("uid")
    named, names = numbered(docs)
    return named.withColumn("uid", row_id(docs)).join(kept, "uid", "left_semi").select(*[F.col(c).alias(n) for n, c in zip(docs.columns, names)])


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(documents(spark, sf_dir)).drop("uid")
