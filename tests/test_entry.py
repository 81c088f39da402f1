import re

import duckdb
import pytest

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents labels pages".split()


def test_entry_runs(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["rule_id", "n_findings", "n_docs"]


def test_every_query_has_oracle():
    import __spark_entry__ as e

    own = {n for n in e.queries() if not re.match(r"op\d+_|pipeline$", n)}
    assert own == {n for n in e.oracle_sql() if not re.match(r"op\d+_", n)}
    assert set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.parametrize("name", ["l01_long_line", "l14_all_cols", "l31_case_end", "l10_bracket_pairs",
                                  "q1_customer_dim", "q2_monthly_revenue", "q3_activity", "m23_latest_ties"])
def test_against_oracle(spark, name):
    import __spark_entry__ as e

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = e.queries()[name](spark, SF)
    got = sorted(tuple(str(v) for v in r) for r in df.select(*sorted(df.columns)).collect())
    res = con.execute(e.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    want = sorted(tuple(str(r[i]) for i in order) for r in res.fetchall())
    assert sorted(cols) == sorted(df.columns)
    assert got == want
