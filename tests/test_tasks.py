import re

from seamline import session
from seamline.plans import lint_queries

SF = "/root/testdata/sf0.001"


def test_windows_get_more_tasks_with_more_rows(spark, monkeypatch):
    want = sorted(lint_queries.l32_findings_summary(spark, SF).collect())
    monkeypatch.setattr(session, "ROWS_PER_TASK", 100)
    found = lint_queries.l32_findings_summary(spark, SF)
    assert sorted(found.collect()) == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    least = spark.read.parquet(f"{SF}/customer.parquet").count() * 35 // 100
    assert any(int(n) >= least for n in re.findall(r"hashpartitioning\(doc_id#\d+L?, n_lines#\d+, _chunk#\d+, (\d+)\)", plan))
