"""Literals and comments blanked: whole texts, and lines at several chunk sizes, against a plain walk."""
import random

import pytest
from conftest import make_lines
from pyspark.sql import functions as F

from seamline.operators.lint import lint_texts, run_rules
from seamline.operators.literals import code_lines, code_text


def walk(text):
    """Character by character: the state is code, literal or comment."""
    text = text.replace("\r\n", "\n").replace("\r", "\n")
    out, state, i = [], "code", 0
    while i < len(text):
        c = text[i]
        if state == "comment" and c == "\n":
            state = "code"
        if state == "code" and (c == "'" or text.startswith("--", i)):
            state = "literal" if c == "'" else "comment"
            out.append(" ")
        elif state == "code":
            out.append(c)
        else:
            out.append("\n" if c == "\n" else " ")
            if state == "literal" and c == "'":
                state = "code"
        i += 1
    return "".join(out)


def random_texts(n=200):
    rnd = random.Random(7)
    parts = ["'", "'", "--", "-", "\n", "\n", "\r\n", "\r", "join", " ", "é", " ", "''", "😀", "\\"]
    return {i: "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40))) for i in range(n)}


@pytest.mark.parametrize("size", [1, 2, 5, 1000])
def test_code_lines_match_a_walk(spark, chunk, size):
    chunk(size)
    texts = random_texts()
    got = {}
    for r in sorted(code_lines(make_lines(spark, texts)).collect(), key=lambda r: (r.doc_id, r.line_no)):
        got.setdefault(r.doc_id, []).append(r.line + ("\n" if r.eol else ""))
    for i, t in texts.items():
        assert "".join(got.get(i, [])) == walk(t), repr(t)


def test_code_text_matches_a_walk(spark):
    texts = random_texts() | {1000: None, 1001: ""}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").select("doc_id", code_text(F.col("text")).alias("c"))
    assert {r.doc_id: r.c for r in df.collect()} == {i: None if t is None else walk(t) for i, t in texts.items()}


def test_rules_ignore_quoted_text(spark):
    text = "select 'a\n join b\n' as note -- join\nfrom t\njoin u -- 'inner\n  using (id)\nleft join 'x' using (id)\n"
    plain = run_rules(make_lines(spark, {1: text}), ["L03", "L04"])
    code = run_rules(make_lines(spark, {1: text}), ["L03", "L04"], {"ignore_quoted": True})
    rows = lambda df: sorted((r.rule_id, r.line_no) for r in df.collect())
    assert rows(plain) == [("L03", 2), ("L03", 3), ("L04", 6)]
    assert rows(code) == [("L03", 5), ("L04", 6)]
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    whole = lint_texts(docs, ["L03", "L04"], nesting=(), documents=False, options={"ignore_quoted": True})
    assert rows(whole) == rows(code)
