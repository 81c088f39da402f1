import random

import pytest
from pyspark.sql import functions as F

from conftest import make_lines
from seamline.operators.scan import Prefix, Shift, Suffix, Total, last_where, next_where, scan


def random_docs(seed, n_docs=12, max_lines=30):
    rnd = random.Random(seed)
    words = ["x", "from", "join", "", "  case", "end ", "sum(", "a from b"]
    return {d: "\n".join(rnd.choice(words) for _ in range(rnd.randint(1, max_lines))) for d in range(n_docs)}


@pytest.mark.parametrize("chunk_lines", [2, 3, 7, 1000])
def test_scan_matches_brute_force(spark, chunk, chunk_lines):
    chunk(chunk_lines)
    docs = random_docs(chunk_lines)
    lines = make_lines(spark, docs)
    L = F.col("line")
    out = scan(lines, {
        "prev2": Shift(L, -2), "next1": Shift(L, 1),
        "last_from": last_where(L.contains("from")),
        "last_join_excl": last_where(L.contains("join"), inclusive=False),
        "next_case": next_where(L.contains("case"), inclusive=False),
        "n_sum": Prefix(L.contains("sum(").cast("int"), "sum", True),
        "n_end_after": Suffix(L.contains("end").cast("int"), "sum", True),
        "total_x": Total((L == "x").cast("int")),
    }).collect()
    by_doc = {}
    for r in out:
        by_doc.setdefault(r.doc_id, {})[r.line_no] = r
    for d, text in docs.items():
        ls = text.split("\n")
        if text.endswith("\n"):  # a final newline does not start another line
            ls = ls[:-1]
        n = len(ls)
        for i in range(1, n + 1):
            r = by_doc[d][i]
            line = ls[i - 1]
            assert r.prev2 == (ls[i - 3] if i > 2 else None)
            assert r.next1 == (ls[i] if i < n else None)
            lf = [j for j in range(1, i + 1) if "from" in ls[j - 1]]
            assert (r.last_from.no if r.last_from else None) == (lf[-1] if lf else None)
            lj = [j for j in range(1, i) if "join" in ls[j - 1]]
            assert (r.last_join_excl.no if r.last_join_excl else None) == (lj[-1] if lj else None)
            nc = [j for j in range(i + 1, n + 1) if "case" in ls[j - 1]]
            assert (r.next_case.no if r.next_case else None) == (nc[0] if nc else None)
            assert r.n_sum == sum("sum(" in ls[j - 1] for j in range(1, i + 1))
            assert r.n_end_after == sum("end" in ls[j - 1] for j in range(i, n + 1))
            assert r.total_x == sum(x == "x" for x in ls), (d, i, line)
