"""What Python workers hold: one operator's tables at a time, small batches of texts, each text once."""

import tracemalloc
import weakref

import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F

from seamline.llm import chunk_encode, common, segment_langid, set_skip_join, swap_pack

NAME = "spark.sql.execution.arrow.maxRecordsPerBatch"


def test_a_worker_keeps_one_operators_tables():
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder = chunk_encode.ChunkEncoder.get(path, False)
    assert chunk_encode.ChunkEncoder.get(path, False) is encoder
    left = weakref.ref(encoder)
    del encoder
    common.held_by_worker("another operator", list)
    assert left() is None


def test_texts_are_packed_in_small_batches(spark, monkeypatch):
    seen, keep, was = [], common.Scratch.keep, spark.conf.get(NAME)
    monkeypatch.setattr(common.Scratch, "keep", lambda self, df, tag: (seen.append((tag, int(spark.conf.get(NAME)))), keep(self, df, tag))[1])
    docs = spark.createDataFrame([(k, f"some words {k}") for k in range(20)], "doc_id long, text string")
    rows = swap_pack.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), 0)
    assert dict(seen)["pieces"] <= 1024 and spark.conf.get(NAME) == was
    assert rows.agg(F.countDistinct("doc_id")).first()[0] == 20
    spark.conf.set(NAME, 7)
    try:
        with common.arrow_rows(spark, 1024):
            assert spark.conf.get(NAME) == "7"
    finally:
        spark.conf.set(NAME, was)


def test_language_stage_sends_each_text_once(spark):
    docs = common.Scratch(spark, "t").keep(spark.createDataFrame(
        [(k, ["the house", "das Haus", None, "..."][k % 4], ["en", "de"][k % 2]) for k in range(40)], "doc_id long, text string, lang string"), "docs")
    kept = segment_langid.drop_unidentified(docs, public_tokenizers.path("piece_bpe_32k.model"))
    node = kept._jdf.queryExecution().optimizedPlan()
    while not node.nodeName().startswith("MapInArrow"):
        node = node.children().head()
    sent = [node.children().head().output().apply(k).dataType().simpleString() for k in range(node.children().head().output().size())]
    assert sent.count("string") == 2  # the text and its language
    assert sorted(r.doc_id for r in kept.collect()) == [k for k in range(40) if k % 4 < 2]


def test_slot_counts_need_one_table():
    texts = pa.RecordBatch.from_arrays([pa.array([f"some words of text {k}" for k in range(300)])], ["text"])
    tracemalloc.start()
    try:
        for _ in set_skip_join._count_slots(3)(iter([texts])):
            pass
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 1.5 * (8 << set_skip_join.SLOT_BITS)


def test_set_join_sends_small_batches(spark, monkeypatch):
    seen, keep, was = [], common.Scratch.keep, spark.conf.get(NAME)
    monkeypatch.setattr(common.Scratch, "keep", lambda self, df, tag: (seen.append(int(spark.conf.get(NAME))), keep(self, df, tag))[1])
    docs = common.Scratch(spark, "t").keep(spark.createDataFrame(
        [(k, "a b c d e" if k % 2 else f"some words of text {k}") for k in range(20)], "doc_id long, text string"), "docs")
    seen.clear()
    rows = set_skip_join.similar_groups(docs)
    assert seen and max(seen) <= 1024 and spark.conf.get(NAME) == was
    assert "MapInArrow" not in rows._jdf.queryExecution().optimizedPlan().toString()  # nothing is left to be sent in larger ones
    assert rows.filter("component_id = 1").count() == 10


def test_a_stage_returns_all_batches_before_it_releases_memory():
    batches = [pa.RecordBatch.from_arrays([pa.array([k])], ["k"]) for k in range(3)]
    assert list(common.releasing(lambda some: (b for b in some))(iter(batches))) == batches
    assert list(common.releasing(lambda some: iter(some))(iter([]))) == []
