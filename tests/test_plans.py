"""The physical plans keep the properties the design relies on at scale."""
import re

SF = "/root/testdata/sf0.001"


def executed(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_rule_windows_are_chunked(spark):
    from seamline.operators.lint import run_rules
    from seamline.sources.corpus import sql_lines

    plan = executed(run_rules(sql_lines(spark, SF)))
    specs = re.findall(r"windowspecdefinition\(([^,]+), ([^,]+), ([^,]+),", plan)
    assert specs, plan[:2000]
    # a document is never one group; only the carry, one row a chunk, is ordered by chunk
    for spec in specs:
        assert spec[0].startswith("doc_id") and "_chunk" in spec[2], spec


def test_anchor_rules_read_stored_events_without_text(spark):
    from seamline.operators.lint import run_rules
    from seamline.sources.corpus import document_lines

    plan = executed(run_rules(document_lines(spark, SF), ["L14", "L16", "L22", "L31"]))
    assert "Exchange" in plan and "FileScan" not in plan and not re.search(r"\bline#", plan)


def test_lint_reads_the_texts_once_besides_the_events(spark):
    from seamline.operators.lint import lint_texts
    from seamline.sources.corpus import read_documents

    plan = executed(lint_texts(read_documents(spark, SF)))
    assert plan.split("Initial Plan")[0].count("FileScan parquet") == 1


def test_neighbour_rules_do_not_shuffle(spark):
    import __spark_entry__ as e

    for name in ("l04_using", "l08_cte_padding", "l09_select_padding", "l12_select_col", "l13_first_col",
                 "l26_when_next", "l27_when_col"):
        plan = executed(e.queries()[name](spark, SF))
        assert "Exchange" not in plan and "Window" not in plan, name


def test_latest_ties_have_no_window_group(spark):
    import __spark_entry__ as e

    plan = executed(e.queries()["m23_latest_ties"](spark, SF))
    assert "Window" not in plan and "partial_max" in plan


def test_buyers_read_customers_once_and_orders_twice(spark):
    import __spark_entry__ as e

    plan = executed(e.queries()["q1_customer_dim"](spark, SF)).split("Initial Plan")[0]
    assert plan.count("FileScan parquet [c_custkey") == 1
    assert plan.count("FileScan parquet [o_orderkey") == 2 and "Window" not in plan


def test_revenue_scan_pushes_date_bounds(spark):
    import __spark_entry__ as e

    plan = executed(e.queries()["q2_monthly_revenue"](spark, SF))
    orders_scan = [line for line in plan.split("\n") if "FileScan parquet [o_orderkey" in line]
    assert orders_scan and "o_orderdate" in orders_scan[0].split("PushedFilters:")[1]
