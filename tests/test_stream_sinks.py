import os
import tempfile

from conftest import make_lines
from seamline.operators.lint import lint
from seamline.sources.sinks import materialize, write_findings
from seamline.streaming.lint_stream import start_lint_stream

SQL_A = "with\n\nfoo as (\n\n    select\n        a,\n        sum(b) as s,\n        c\n    from t\n      join u\n\n)\n"
SQL_B = "select * from final\n"


def test_stream_matches_batch(spark):
    root = tempfile.mkdtemp(prefix="seamline-stream-")
    src = os.path.join(root, "in")
    os.makedirs(src)
    for name, text in (("a.sql", SQL_A), ("b.sql", SQL_B)):
        with open(os.path.join(src, name), "w") as f:
            f.write(text)
    q = start_lint_stream(spark, src, os.path.join(root, "out"), os.path.join(root, "ckpt"))
    q.awaitTermination(120)
    got = spark.read.parquet(os.path.join(root, "out"))
    got_rows = sorted((os.path.basename(r.path), r.rule_id, r.line_no, r.detail) for r in got.collect())
    batch = lint(make_lines(spark, {1: SQL_A, 2: SQL_B})).collect()
    names = {1: "a.sql", 2: "b.sql"}
    want = sorted((names[r.doc_id], r.rule_id, r.line_no, r.detail) for r in batch)
    assert got_rows == want
    assert any(r[1] == "L16" for r in got_rows)


def test_sinks(spark):
    root = tempfile.mkdtemp(prefix="seamline-sink-")
    f = lint(make_lines(spark, {1: SQL_A}))
    write_findings(f, os.path.join(root, "findings"))
    back = spark.read.parquet(os.path.join(root, "findings"))
    assert back.count() == f.count()
    assert "rule_id" in back.columns
    t = materialize(spark.range(5), os.path.join(root, "tbl"), table="seamline_test_tbl", tags=["dim", "test"])
    assert t.count() == 5
    props = {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES seamline_test_tbl").collect()}
    assert props.get("tags") == "dim,test"


def test_materialize_keeps_its_input(spark, tmp_path):
    import pytest

    path = str(tmp_path / "t")
    spark.range(5).write.parquet(path)
    with pytest.raises(ValueError):
        materialize(spark.read.parquet(path).filter("id > 2"), path)
    assert spark.read.parquet(path).count() == 5
    t = materialize(spark.range(3), str(tmp_path / "u"), table="seamline_quoted_tbl", tags=["a'b"])
    props = {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES seamline_quoted_tbl").collect()}
    assert t.count() == 3 and props.get("tags") == "a'b"


def test_cut_lineage_uses_checkpoint_dir(spark):
    from pyspark.sql import functions as F

    from seamline.session import cut_lineage, ensure_checkpoint_dir

    folder = ensure_checkpoint_dir(spark)
    assert folder
    df = spark.range(100).withColumn("x", F.col("id") * 2).filter("id % 3 = 0")
    cut = cut_lineage(df)
    assert sorted(cut.collect()) == sorted(df.collect())
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" not in plan  # the checkpointed data replaced the lineage


def test_failed_write_leaves_the_old_version(spark, tmp_path):
    import pytest
    from pyspark.sql import functions as F

    from seamline.sources.sinks import read_materialized, versions

    path, name = str(tmp_path / "v"), "seamline_versioned_tbl"
    with pytest.raises(FileNotFoundError):
        read_materialized(spark, path)
    first = materialize(spark.range(5), path, table=name)
    broken = spark.range(1000).repartition(4).withColumn("id", F.when(F.col("id") == 700, F.raise_error(F.lit("lost"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="lost"):
        materialize(broken.select(F.col("id").cast("long").alias("id")), path, table=name)
    assert versions(spark, path) == [1] and spark.table(name).count() == read_materialized(spark, path).count() == 5
    begun = read_materialized(spark, path)
    materialize(spark.table(name).filter("id > 2"), path, table=name)  # a model that reads the table it replaces
    assert sorted(r.id for r in spark.table(name).collect()) == [3, 4] == sorted(r.id for r in read_materialized(spark, path).collect())
    assert begun.count() == 5 and first is not None
    other = materialize(spark.range(2).selectExpr("id", "cast(id as string) AS label"), path, table=name, tags=["a"])
    assert other.columns == ["id", "label"] and spark.table(name).count() == 2
    assert versions(spark, path) == [3, 4]  # the second was never complete, and the first has gone
