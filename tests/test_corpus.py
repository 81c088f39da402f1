import pytest
from conftest import make_lines


def py_lines(text):
    """Text-mode readlines(): universal newlines, newline kept, no empty last line."""
    text = text.replace("\r\n", "\n").replace("\r", "\n")
    return text.splitlines(keepends=True) if text else []


def test_line_split_matches_readlines(spark):
    texts = {1: "a\nb\n", 2: "a\r\nb", 3: "", 4: "\n", 5: "x\ry\n\n", 6: "one line", 7: "\n\nz"}
    rows = make_lines(spark, texts).orderBy("doc_id", "line_no").collect()
    got = {}
    for r in rows:
        got.setdefault(r.doc_id, []).append(r.line + ("\n" if r.eol else ""))
        assert r.n_lines == len(py_lines(texts[r.doc_id]))
    for k, t in texts.items():
        assert got.get(k, []) == py_lines(t), k


def test_sql_corpus_shape(spark):
    from seamline.sources.corpus import sql_lines

    lines = sql_lines(spark, "/root/testdata/sf0.001")
    counts = {r["n"] for r in lines.groupBy("doc_id").count().withColumnRenamed("count", "n").collect()}
    assert counts == {35}


def test_text_files_source(spark):
    import os
    import tempfile

    from seamline.operators.lint import run_rules
    from seamline.sources.corpus import lines_from_text, read_text_files

    root = tempfile.mkdtemp(prefix="seamline-files-")
    texts = {"a.sql": "select\n    a\n  , b\nfrom t\n", "b.sql": "with\r\n\r\nx as (\r\n"}
    for name, text in texts.items():
        with open(os.path.join(root, name), "w", newline="") as f:
            f.write(text)
    docs = read_text_files(spark, root)
    lines = lines_from_text(docs.select("doc_id", "text"))
    per_doc = {r.doc_id: r.n for r in lines.groupBy("doc_id").count().withColumnRenamed("count", "n").collect()}
    assert sorted(per_doc.values()) == [3, 4]
    assert [r.line_no for r in run_rules(lines, ["L02"]).collect()] == [3]


def test_split_and_strip_match_python_on_random_text(spark):
    import io
    import random

    from pyspark.sql import functions as F

    from seamline.functions import text as tx

    rnd = random.Random(3)
    alphabet = ["a", "B", " ", "\t", "\n", "\r", "\r\n", " ", "\x0b", "\x1c", "\xa0", "　", "é", "("]
    texts = {i: "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 30))) for i in range(300)}
    lines = make_lines(spark, texts).select("doc_id", "line_no", "line", "eol").collect()
    got = {}
    for r in sorted(lines, key=lambda r: (r.doc_id, r.line_no)):
        got.setdefault(r.doc_id, []).append(r.line + ("\n" if r.eol else ""))
    for i, t in texts.items():
        assert got.get(i, []) == io.StringIO(t, newline=None).readlines(), repr(t)

    pieces = [t.replace("\n", "").replace("\r", "") for t in texts.values()]
    df = spark.createDataFrame([(p,) for p in pieces], "s string")
    rows = df.select("s", tx.strip("s").alias("st"), tx.lstrip("s").alias("ls"), tx.is_blank("s").alias("b")).collect()
    for r in rows:
        assert r.st == r.s.strip() and r.ls == r.s.lstrip() and r.b == (r.s.strip() == ""), repr(r.s)


def test_findings_do_not_depend_on_the_n_chars_column(spark, tmp_path):
    from seamline.operators.lint import run_rules
    from seamline.sources.corpus import document_lines

    text = "\n".join(["from a", " join b", "x"] * 8)
    rows = [(1, text, None), (2, text, 1), (3, None, None)]
    path = tmp_path / "documents.parquet"
    spark.createDataFrame(rows, "doc_id long, text string, n_chars long").write.parquet(str(path))
    lines = document_lines(spark, str(tmp_path))
    whole = sorted(map(tuple, run_rules(lines, ["L04", "L22"]).collect()), key=str)
    spark.conf.set("seamline.scan.chunkLines", "5")
    try:
        cut = sorted(map(tuple, run_rules(document_lines(spark, str(tmp_path)), ["L04", "L22"]).collect()), key=str)
    finally:
        spark.conf.unset("seamline.scan.chunkLines")
    assert whole == cut
    assert len(whole) == 2 * 8  # every join is one column right of its from


def test_neighbours_from_text_match_the_scan(spark, chunk):
    from seamline.operators.lint import neighbours_of, run_rules
    from seamline.sources.corpus import lines_from_text

    ids = ["L01", "L04", "L08", "L09", "L12", "L13", "L26", "L27"]
    text = "\n".join(["with", "", "", "a as (", "x", "select", "b", "join t", "  using (x)", "case", "when", "union", "select"] * 3)
    rows = [(1, text), (2, text + "\n"), (3, "case"), (4, ""), (5, None), (6, "\ncase\n\nselect\n"), (7, text)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    chunk(3)
    scanned = sorted(map(tuple, run_rules(lines_from_text(docs), ids).collect()), key=str)
    near = sorted(map(tuple, run_rules(lines_from_text(docs, neighbours=neighbours_of(ids)), ids).collect()), key=str)
    assert near == scanned and {r[1] for r in near} > {"L04", "L08", "L12", "L13", "L26"}


@pytest.mark.parametrize("split", ["8", "64", "128m"])
def test_text_lines_equal_whole_text_lines(spark, tmp_path, split):
    from seamline.operators.lint import lint, lint_texts
    from seamline.sources.corpus import lines_from_text, read_text_files, read_text_lines

    texts = ["one\r\ntwo\n\nthree\rfour\nfive", "x\ny\n", "", "\n", "\r", "a\r\r\nb\r", "no end", "é\n日本\r\n" * 30, "w" * 300 + "\nend\n\n",
             "with\n\nfoo as (\n\n    select\n        a,\n        sum(b) as s,\n        c\n    from t\n      join u\n\n)\n" * 3]
    for k, t in enumerate(texts):
        (tmp_path / f"f{k}.sql").write_bytes(t.encode())
    had = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    whole = sorted(tuple(r) for r in lines_from_text(read_text_files(spark, str(tmp_path))).collect())
    findings = sorted(map(str, lint_texts(read_text_files(spark, str(tmp_path))).collect()))
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        lines = read_text_lines(spark, str(tmp_path))
        assert sorted(tuple(r) for r in lines.select("doc_id", "line_no", "line", "eol", "n_lines").collect()) == whole
        if split == "64":
            assert lines.rdd.getNumPartitions() > 10
            assert findings and sorted(map(str, lint(lines).collect())) == findings
    finally:
        for c, v in had.items():
            spark.conf.set(c, v)


def test_text_lines_drop_a_byte_order_mark(spark, tmp_path):
    from seamline.sources.corpus import read_text_lines

    (tmp_path / "a").write_bytes(b"\xef\xbb\xbfx\ny")
    (tmp_path / "b").write_bytes(b"\xef\xbb\xbfx\ny\n")
    got = sorted((r.doc_id[-1], r.line_no, r.line, r.eol) for r in read_text_lines(spark, str(tmp_path)).collect())
    assert got == [("a", 1, "x", True), ("a", 2, "y", False), ("b", 1, "x", True), ("b", 2, "y", True)]


@pytest.mark.parametrize("piece", [1, 2, 3, 7, 1000])
def test_long_texts_in_pieces_match_the_whole_text_way(spark, piece):
    import random

    from seamline.sources.corpus import lines_from_text, long_text_lines

    rnd = random.Random(piece)
    parts = ["a", "bc", "é", "😀", " ", "\n", "\n", "\r", "\r\n", "\u2028", "'"]
    texts = {i: "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25))) for i in range(150)}
    texts |= {900: "", 901: None, 902: "\r\n", 903: "\n", 904: "x\r\n", 905: "x\r\n\r\n", 906: "y" * 50}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = lambda df: sorted(map(tuple, df.select("doc_id", "line_no", "line", "eol", "n_lines").collect()))
    assert rows(long_text_lines(docs, piece_bytes=piece)) == rows(lines_from_text(docs))


def test_pieces_of_one_long_text_lie_in_many_tasks(spark):
    from pyspark.sql import functions as F

    from seamline.sources.corpus import long_text_lines

    docs = spark.range(1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("some words of a line\n"), 200_000).alias("text"))
    lines = long_text_lines(docs, piece_bytes=1 << 14)
    inner = lines.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert sum(r["count"] for r in inner) == 200_000 and len(inner) > 2


def test_many_texts_are_made_in_many_tasks_also_for_neighbour_rules(spark, monkeypatch):
    import __spark_entry__ as e
    from seamline.sources import corpus

    want = sorted(e.queries()["l08_with_contains"](spark, "/root/testdata/sf0.001").collect())
    monkeypatch.setattr(corpus, "MOST_KEYS", 100)
    found = e.queries()["l08_with_contains"](spark, "/root/testdata/sf0.001")
    assert found.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sorted(found.collect()) == want


def test_lines_share_the_values_of_their_neighbours(spark):
    from seamline.operators.features import NEIGHBOURS, with_neighbours
    from seamline.sources.corpus import lines_from_text

    texts = ["", "\n", "a\n \x1c\n\nselect\n when\n", "select", "\u2003\njoin\nunion\r\n as (\rx when", "  x", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    names = sorted(NEIGHBOURS)
    near = lines_from_text(docs, neighbours=names)
    assert near._jdf.queryExecution().optimizedPlan().toString().count("trim") == 1  # one test of each line for four values
    columns = ["doc_id", "line_no", *names]
    assert sorted(map(str, near.select(columns).collect())) == sorted(map(str, with_neighbours(lines_from_text(docs), names).select(columns).collect()))
