import random

import pytest

from conftest import make_lines
from seamline.operators.rules_nesting import bracket_events, bracket_offsets, bracket_pairs, bracket_pairs_events, nesting_findings


def stack_pairs(text):
    """Pairs by a plain stack; a surplus ')' is skipped. Positions as (line_no, k)."""
    pos, stack, pairs, surplus = [], [], [], []
    for ln, line in enumerate(text.split("\n"), start=1):
        k = 0
        for ch in line:
            if ch in "()":
                if ch == "(":
                    stack.append((ln, k))
                elif stack:
                    o = stack.pop()
                    pairs.append((o, (ln, k), len(stack) + 1))
                else:
                    surplus.append(ln)
                k += 1
    return pairs, surplus, [o[0] for o in stack]


@pytest.mark.parametrize("chunk_lines", [1, 2, 5, 1000])
def test_pairs_match_stack(spark, chunk, chunk_lines):
    chunk(chunk_lines)
    rnd = random.Random(chunk_lines)
    docs = {d: "\n".join("".join(rnd.choice("(()) x") for _ in range(rnd.randint(0, 8)))
                         for _ in range(rnd.randint(1, 12))) for d in range(25)}
    lines = make_lines(spark, docs)
    got = {}
    for r in bracket_pairs(lines).collect():
        got.setdefault(r.doc_id, set()).add(((r.open_line, r.open_k), (r.close_line, r.close_k), r.level))
    bad = {}
    for r in nesting_findings(lines).filter("rule_id = 'L10b'").collect():
        bad.setdefault(r.doc_id, []).append((r.line_no, r.detail))
    for d, text in docs.items():
        pairs, surplus, unclosed = stack_pairs(text)
        assert got.get(d, set()) == set(pairs), d
        want = sorted([(ln, ")") for ln in surplus] + [(ln, "(") for ln in unclosed])
        assert sorted(bad.get(d, [])) == want, d


def test_cte_alignment(spark):
    text = "with\n\nfoo as (\n  select 1\n  ),\n bar as (\n  select (2)\n)\n"
    f = nesting_findings(make_lines(spark, {1: text})).filter("rule_id = 'L11'").collect()
    assert sorted((r.line_no, r.detail) for r in f) == [(5, "close"), (6, "open")]


@pytest.mark.parametrize("chunk_lines", [1, 3, 1000])
def test_offsets(spark, chunk, chunk_lines):
    chunk(chunk_lines)
    rnd = random.Random(chunk_lines)
    docs = {d: "\n".join("".join(rnd.choice("(()) xé") for _ in range(rnd.randint(0, 9))) for _ in range(rnd.randint(1, 9))) + "\n" * (d % 2)
            for d in range(20)}
    got = sorted(tuple(r) for r in bracket_offsets(make_lines(spark, docs)).collect())
    want = []
    for d, text in docs.items():
        start = 0
        for ln, line in enumerate(text.split("\n"), start=1):
            at = [c for c, ch in enumerate(line) if ch in "()"]
            want += [(d, ln, k, line[c], c, start + c) for k, c in enumerate(at)]
            start += len(line) + 1
    assert got == sorted(want)


def test_one_line_with_many_brackets_is_many_groups(spark, chunk):
    chunk(1000)
    half = 20_000
    lines = make_lines(spark, {1: "x\n" + "(" * half + ")" * (half + 1) + "\ny ()"})
    ev = bracket_pairs_events(bracket_events(lines))
    assert ev.groupBy("doc_id", "_chunk").count().agg({"count": "max"}).first()[0] <= 1000
    pairs = {(r.open_line, r.open_k): (r.close_line, r.close_k, r.level) for r in bracket_pairs(lines).collect()}
    assert pairs.pop((3, 0)) == (3, 1, 1)
    assert pairs == {(2, k): (2, 2 * half - 1 - k, k + 1) for k in range(half)}
    assert [(r.line_no, r.detail) for r in nesting_findings(lines).collect()] == [(2, ")")]
