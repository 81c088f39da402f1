from conftest import make_lines
from seamline.operators.lint import run_rules


def hits(spark, text, rule):
    return sorted((r.line_no, r.anchor_no, r.detail) for r in run_rules(make_lines(spark, {1: text}), [rule]).collect())


def test_long_line_counts_newline(spark):
    t = "a" * 100 + "\n" + "b" * 99 + "\n" + "c" * 101
    # 100 letters + newline > 100; 99 + newline = 100 is not; last line has no newline
    assert [h[0] for h in hits(spark, t, "L01")] == [1, 3]
    assert [h[0] for h in hits(spark, "  " + " x" * 60, "L01")] == []


def test_leading_comma_and_join_kind(spark):
    t = "select\n    ,a\n\t, b\n    join x\n    left join y\n    using (id)\n"
    assert [h[0] for h in hits(spark, t, "L02")] == [2, 3]
    assert [h[0] for h in hits(spark, t, "L03")] == [4]
    assert hits(spark, t, "L05") == [(4, None, "    inner join x")]


def test_upper_case_pieces(spark):
    t = "select 'ABC' as X, 'y' || Zz\nall lower 'UP'\n'x' Q"
    # pieces 2 and 4 of line 1 hold upper case outside quotes; line 2 only inside quotes;
    # line 3's piece " Q" has no letter followed by another character, which the rule requires
    assert hits(spark, t, "L07") == [(1, None, "2"), (1, None, "4")]


def test_case_alone_uses_newline(spark):
    assert hits(spark, "    case\n    when", "L25") == []
    assert hits(spark, "x\n    case", "L25") == [(2, None, None)]


def test_padding_ends_have_no_neighbour(spark):
    t = "with\n\nfoo as (\nselect 1\n)"
    got = hits(spark, t, "L08")
    assert (1, None, "b") not in got  # no line above the first
    assert (3, None, "a") in got


def test_select_blocks_overlap(spark):
    t = "select\n  a,\n  select\n      b,\n  sum(c),\n  d\n  x from y\n"
    l14 = hits(spark, t, "L14")
    # line 4 (b) lies in both blocks (of lines 1 and 3)
    assert (4, 3, "2") in l14
    l16 = hits(spark, t, "L16")
    assert l16 == [(6, 5, "2")]


def case_end_partner(lines, e):
    """Walk up from end line e (0-based) counting end/case lines until a case line with a
    non-zero count; line 0 when none."""
    j, cnt = e, 0
    while "case" not in lines[j].strip() or cnt == 0:
        if j == 0:
            break
        j -= 1
        if (lines[j].strip() + " ").find("end ") >= 0:
            cnt += 1
        if "case" in lines[j].strip():
            cnt -= 1
    return j


def test_case_end_partner(spark, chunk):
    t = ("select\n    case\n        when a then\n            case\n                when b then 1\n"
         "            end\n      end as x,\n    case when c then 2 end as y\n  end\n")
    ls = t.split("\n")[:-1]
    import re

    def ind(s):
        m = re.search("[A-Za-z]", s)
        return m.start() if m else None

    want = []
    for i, line in enumerate(ls):
        kw = any(k in line for k in ("select", "case", " when ", " end"))
        if kw and "end " in line.strip() + " ":
            j = case_end_partner(ls, i)
            if ind(ls[j]) != ind(line):
                want.append((i + 1, j + 1, None))
    for c in (2, 1000):
        chunk(c)
        assert hits(spark, t, "L31") == sorted(want)


def test_rule_options(spark):
    t = "select\n  a,\n  avg(b) as m,\n  c\n  x from y\n\n    join z\n"
    lines = make_lines(spark, {1: t})
    assert run_rules(lines, ["L16"]).count() == 0
    got = run_rules(lines, ["L16"], {"agg_tokens": ("sum(", "min(", "max(", "avg(")}).collect()
    assert [(r.line_no, r.anchor_no) for r in got] == [(4, 3)]
    sug = run_rules(lines, ["L05"], {"join_rewrite": "left join"}).collect()
    assert [r.detail for r in sug] == ["    left join z"]


def test_report_messages(spark):
    from seamline.operators.lint import lint, report, rule_catalog

    cat = {r.rule_id for r in rule_catalog(spark).collect()}
    f = lint(make_lines(spark, {1: "select a\n    join b\n(x"}))
    assert {r.rule_id for r in f.collect()} <= cat
    msgs = [r.message for r in report(f).collect()]
    assert any(m.startswith("L03: join without its kind at line 2") for m in msgs)
    assert any(m.startswith("L10b:") for m in msgs)


def test_case_end_partner_random(spark, chunk):
    import random
    import re

    rnd = random.Random(7)
    words = ["    case", "  case when x", "        when a then b", "    end as y", "  end", "select", "  x, end z",
             "", "    else 1", "end case", "  from t"]
    docs = {d: "\n".join(rnd.choice(words) for _ in range(rnd.randint(1, 25))) for d in range(40)}

    def ind(s):
        m = re.search("[A-Za-z]", s)
        return m.start() if m else None

    want = []
    for d, text in docs.items():
        ls = text.split("\n")
        if text.endswith("\n"):
            ls = ls[:-1]
        for i, line in enumerate(ls):
            kw = any(k in line for k in ("select", "case", " when ", " end"))
            if kw and "end " in line.strip() + " ":
                j = case_end_partner(ls, i)
                if ind(ls[j]) is not None and ind(ls[j]) != ind(line):
                    want.append((d, i + 1, j + 1))
    lines = make_lines(spark, docs)
    for c in (2, 3, 1000):
        chunk(c)
        got = sorted((r.doc_id, r.line_no, r.anchor_no) for r in run_rules(lines, ["L31"]).collect())
        assert got == sorted(want), c


def test_select_blocks_random(spark, chunk):
    import random
    import re

    rnd = random.Random(11)
    words = ["    select", "select", "        a,", "  sum(b),", "    max(c) as m", "      x from t", "from y",
             "  'q'", "", "        {{ c }}"]
    docs = {d: "\n".join(rnd.choice(words) for _ in range(rnd.randint(1, 30))) for d in range(40)}

    def nind(s):
        m = re.search(r"\"|'|\{|[a-zA-Z]", s)
        return m.start() if m else None

    want14, want16 = [], []
    for d, text in docs.items():
        ls = text.split("\n")
        final_nl = text.endswith("\n")
        if final_nl:  # readlines(): a final newline does not start another line
            ls = ls[:-1]
        n = len(ls)
        blocks = []
        for s_i, line in enumerate(ls):
            if line.endswith("select") and (s_i < n - 1 or final_nl):   # "select\n"
                e_i = next((k for k in range(s_i + 1, n) if " from " in ls[k]), n)
                blocks.append((s_i, e_i))
        for l_i in range(n):
            inside = [(s, e) for s, e in blocks if s < l_i < e]
            if not inside:
                continue
            if nind(ls[l_i]) is not None and nind(ls[l_i]) != 8:
                want14.append((d, l_i + 1, max(s for s, _ in inside) + 1, str(len(inside))))
            is_agg = any(t in ls[l_i] for t in ("sum(", "min(", "max("))
            aggs = [a for a in range(l_i) if any(t in ls[a] for t in ("sum(", "min(", "max("))]
            if not is_agg and aggs:
                g = max(aggs)
                errs = [s for s, _ in inside if s < g]
                if errs:
                    want16.append((d, l_i + 1, g + 1, str(len(errs))))
    lines = make_lines(spark, docs)
    for c in (2, 5, 1000):
        chunk(c)
        for rule, want in (("L14", want14), ("L16", want16)):
            got = sorted((r.doc_id, r.line_no, r.anchor_no, r.detail) for r in run_rules(lines, [rule]).collect())
            assert got == sorted(want), (rule, c)


def test_padding_with_variant(spark):
    t = "x\nwith t as (\n\ny"
    lines = make_lines(spark, {1: t})
    # line 2 is a CTE header either way; "with" alone never matches here, "contains" adds nothing new
    base = sorted((r.line_no, r.detail) for r in run_rules(lines, ["L08"]).collect())
    t2 = "x\n  with_totals\n\ny"
    lines2 = make_lines(spark, {1: t2})
    assert run_rules(lines2, ["L08"]).count() == 0
    got = sorted((r.line_no, r.detail) for r in run_rules(lines2, ["L08"], {"with_match": "contains"}).collect())
    assert got == [(2, "b")]
    assert base == [(2, "b")]
