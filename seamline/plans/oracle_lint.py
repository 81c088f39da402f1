"""DuckDB SQL for the style rules: the independent side of the correctness check.

Each ``r_*`` function returns a SELECT over a lines relation ``src(doc_id, line_no, line, eol,
n_lines)`` producing ``findings`` columns. Where the Spark plan uses prefix-count identities
(select blocks, aggregates-last, case/end partners, bracket depth), the SQL here is written
the direct way instead -- self joins, correlated subqueries and a recursive stack -- so the
two sides do not share a derivation.
"""

from __future__ import annotations

from ..functions.text import PY_WHITESPACE
from ..sources.corpus import sql_template_values_sql

WS = f"[{PY_WHITESPACE}]"
NWS = f"[^{PY_WHITESPACE}]"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def has(x: str, tok: str) -> str:
    return f"contains({x}, {q(tok)})"


def has_any(x: str, *toks: str) -> str:
    return "(" + " OR ".join(has(x, t) for t in toks) + ")"


def strip(x: str) -> str:
    return f"regexp_replace({x}, {q(rf'\A{WS}+|{WS}+\z')}, '', 'g')"


def lstrip(x: str) -> str:
    return f"regexp_replace({x}, {q(rf'\A{WS}+')}, '')"


def blank(x: str) -> str:
    return f"(NOT regexp_matches({x}, {q(NWS)}))"


def ind(x: str) -> str:
    return f"(CASE WHEN regexp_matches({x}, '[A-Za-z]') THEN CAST(length(regexp_extract({x}, '^[^A-Za-z]*')) AS INTEGER) END)"


def nind(x: str) -> str:
    return (f"(CASE WHEN regexp_matches({x}, {q('[\"' + chr(39) + '{A-Za-z]')}) "
            f"THEN CAST(length(regexp_extract({x}, {q('^[^\"' + chr(39) + '{A-Za-z]*')})) AS INTEGER) END)")


def sel_eol(x: str = "line") -> str:
    return f"(ends_with({x}, 'select') AND eol)"


def F(rule: str, line_no: str = "line_no", anchor: str = "NULL", detail: str = "NULL", doc: str = "doc_id") -> str:
    return (f"{doc} AS doc_id, {q(rule)} AS rule_id, CAST({line_no} AS INTEGER) AS line_no, "
            f"CAST({anchor} AS INTEGER) AS anchor_no, CAST({detail} AS VARCHAR) AS detail")


W = "OVER (PARTITION BY doc_id ORDER BY line_no)"
UPTO = "OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
BEFORE = "OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"

# ---------------------------------------------------------------- line sources


def sql_lines_cte(name: str = "src") -> str:
    return (
        f"{name} AS MATERIALIZED (SELECT c.c_custkey AS doc_id, CAST(tpl.line_no AS INTEGER) AS line_no, "
        f"CASE WHEN tpl.r >= 0 AND c.c_custkey % tpl.k = tpl.r THEN tpl.variant ELSE tpl.base END AS line, "
        f"tpl.line_no < 35 AS eol, 35 AS n_lines FROM customer c, {sql_template_values_sql()})"
    )


def doc_lines_cte(name: str = "src", table: str = "documents", id_col: str = "doc_id", text_col: str = "text") -> str:
    nl = "chr(10)"
    return (
        f"{name}_t AS (SELECT {id_col} AS doc_id, regexp_replace({text_col}, '\\r\\n?', {nl}, 'g') AS t FROM {table}), "
        f"{name}_p AS (SELECT doc_id, t, CASE WHEN t = '' THEN []::VARCHAR[] ELSE string_split("
        f"CASE WHEN ends_with(t, {nl}) THEN substr(t, 1, length(t) - 1) ELSE t END, {nl}) END AS parts FROM {name}_t), "
        f"{name} AS MATERIALIZED (SELECT doc_id, CAST(u.i AS INTEGER) AS line_no, u.line AS line, "
        f"(u.i < len(parts)) OR ends_with(t, {nl}) AS eol, CAST(len(parts) AS INTEGER) AS n_lines "
        f"FROM {name}_p, unnest(parts) WITH ORDINALITY AS u(line, i))"
    )


def code_cte(table: str, name: str) -> str:
    """``table`` with the literals and comments of whole texts blanked."""
    pieces = q(r"'[^']*'?|--[^\n]*|-|[^'-]+")
    hidden = r"CASE WHEN starts_with(x, '''') OR starts_with(x, '--') THEN regexp_replace(x, '[^\n]', ' ', 'g') ELSE x END"
    return (f"{name} AS (SELECT doc_id, array_to_string(list_transform(regexp_extract_all(text, {pieces}), "
            f"lambda x: {hidden}), '') AS text FROM {table})")


# ---------------------------------------------------------------- per-line rules


def r_L01(src="src"):
    return f"SELECT {F('L01')} FROM {src} WHERE length(replace(line, ' ', '')) + CAST(eol AS INTEGER) > 100"


def r_L01b(src="src"):
    return f"SELECT {F('L01b')} FROM {src} WHERE length({strip('line')}) > 100"


def r_L02(src="src"):
    return f"SELECT {F('L02')} FROM {src} WHERE regexp_matches(line, {q(rf'\A{WS}*,')})"


def _join_no_kind():
    return f"({has('line', 'join')} AND NOT {has_any('line', 'inner', 'left', 'outer', 'right')})"


def r_L03(src="src"):
    return f"SELECT {F('L03')} FROM {src} WHERE {_join_no_kind()}"


def r_L05(src="src", rewrite="inner join"):
    detail = f"replace(line, 'join', {q(rewrite)})"
    return f"SELECT {F('L05', detail=detail)} FROM {src} WHERE {_join_no_kind()}"


def r_L06(src="src"):
    return f"SELECT {F('L06')} FROM {src} WHERE {has('line', '<>')}"


def r_L06b(src="src"):
    return f"SELECT {F('L06b')} FROM {src} WHERE {has_any('line', 'with', 'select')}"


def r_L07(src="src"):
    return (f"SELECT {F('L07', detail='u.i - 1', doc='s.doc_id', line_no='s.line_no')} FROM {src} s, "
            f"unnest(string_split(s.line, '''')) WITH ORDINALITY AS u(p, i) "
            f"WHERE (u.i - 1) % 2 = 0 AND regexp_matches(u.p, '[A-Za-z][^\\n]') AND u.p <> lower(u.p)")


def r_L11b(src="src"):
    return f"SELECT {F('L11b')} FROM {src} WHERE {has('line', 'as (')} AND {nind('line')} <> 0"


def r_L17(src="src"):
    s = strip("line")
    return (f"SELECT {F('L17', detail=q('a'))} FROM {src} WHERE contains({s}, '( ') UNION ALL "
            f"SELECT {F('L17', detail=q('b'))} FROM {src} WHERE contains({s}, ' )')")


def r_L18(src="src"):
    parts = []
    for m in (" in (", " in("):
        sp = f"split_part(line, {q(m)}, 2)"
        parts.append(
            f"SELECT {F('L18', detail=q(m.strip()))} FROM {src} WHERE {has('line', m)} "
            f"AND length({sp}) - length(replace({sp}, ',', '')) + 1 >= 3 "
            f"AND length(line) + CAST(eol AS INTEGER) >= 80")
    return " UNION ALL ".join(parts)


def r_L21(src="src"):
    return (f"SELECT {F('L21', detail=q('join'))} FROM {src} WHERE {has('line', 'join')} AND {ind('line')} <> 4 "
            f"UNION ALL SELECT {F('L21', detail=q('on'))} FROM {src} WHERE {has('line', ' on ')} AND {ind('line')} <> 8")


def r_L25(src="src"):
    return f"SELECT {F('L25')} FROM {src} WHERE {has('line', 'case')} AND NOT ({lstrip('line')} = 'case' AND eol)"


# ---------------------------------------------------------------- neighbour rules


def _nb(src):
    b = blank("line")
    return (f"(SELECT *, lag({has('line', 'join')}) {W} AS prev_join, "
            f"lag({b}, 1) {W} AS pb, lag({b}, 2) {W} AS pb2, lead({b}, 1) {W} AS nb, lead({b}, 2) {W} AS nb2, "
            f"lag({has('line', ' as (')}, 2) {W} AS prev2_as, "
            f"lag({has_any('line', 'union', 'except')}, 1) {W} AS prev_union, "
            f"lag({sel_eol()}, 1) {W} AS prev_sel, "
            f"lead({has('line', 'when')}, 1) {W} AS next_when, "
            f"lead(CASE WHEN {has('line', 'when')} THEN instr(line, 'when') - 1 END, 1) {W} AS next_when_pos "
            f"FROM {src}) n")


def r_L04(src="src"):
    return f"SELECT {F('L04')} FROM {_nb(src)} WHERE prev_join AND {has('line', ' using')}"


def r_L08(src="src", with_line=None):
    with_line = with_line or f"{strip('line')} = 'with'"
    cand = f"({with_line} OR {has('line', 'as (')})"
    conds = {"a": "NOT nb", "b": "NOT pb", "c": "nb AND nb2", "d": "pb AND pb2"}
    return " UNION ALL ".join(f"SELECT {F('L08', detail=q(k))} FROM {_nb(src)} WHERE {cand} AND ({v})"
                              for k, v in conds.items())


def r_L09(src="src"):
    cand = f"({has('line', 'select')} AND NOT {has('line', 'select * from')})"
    return (f"SELECT {F('L09', detail=q('a'))} FROM {_nb(src)} WHERE {cand} AND nb UNION ALL "
            f"SELECT {F('L09', detail=q('b'))} FROM {_nb(src)} WHERE {cand} AND pb AND pb2")


def r_L12(src="src"):
    return (f"SELECT {F('L12')} FROM {_nb(src)} WHERE {has('line', 'select')} AND NOT {has('line', 'select * from final')} "
            f"AND (prev2_as OR prev_union) AND {ind('line')} <> 4")


def r_L13(src="src"):
    return f"SELECT {F('L13', anchor='line_no - 1')} FROM {_nb(src)} WHERE prev_sel AND {nind('line')} <> 8"


def r_L26(src="src"):
    return (f"SELECT {F('L26', line_no='line_no + 1', anchor='line_no')} FROM {_nb(src)} "
            f"WHERE {has('line', 'case')} AND NOT next_when")


def r_L27(src="src"):
    return (f"SELECT {F('L27', line_no='line_no + 1', anchor='line_no')} FROM {_nb(src)} "
            f"WHERE {has('line', 'case')} AND instr(line, 'case') - 1 + 4 <> next_when_pos")


# ---------------------------------------------------------------- anchor rules (last value on an anchor line)


def _anchored(src, cond_anchor, inclusive=True):
    frame = UPTO if inclusive else BEFORE
    return (f"(SELECT *, max(CASE WHEN {cond_anchor} THEN line_no END) {frame} AS anc, "
            f"last_value(CASE WHEN {cond_anchor} THEN line END IGNORE NULLS) {frame} AS aline FROM {src}) x")


def r_L22(src="src"):
    return (f"SELECT {F('L22', anchor='anc')} FROM {_anchored(src, has('line', 'from'))} "
            f"WHERE {has('line', 'join')} AND {ind('aline')} <> {ind('line')}")


def r_L23(src="src"):
    return (f"SELECT {F('L23', anchor='anc')} FROM {_anchored(src, has('line', 'join'))} "
            f"WHERE {has('line', ' on ')} AND {ind('aline')} + 4 <> {ind('line')}")


def r_L24(src="src"):
    clause = has_any("line", " on ", " using", "where", " from ")
    return (f"SELECT {F('L24', anchor='j.anc', doc='j.doc_id', line_no='j.line_no')} FROM {_anchored(src, has('line', 'join'))} j "
            f"JOIN {_anchored(src, clause)} c ON c.doc_id = j.doc_id AND c.line_no = j.line_no "
            f"WHERE {has('j.line', ' and ')} AND {has('c.aline', ' on ')} AND {ind('j.aline')} + 8 <> {ind('j.line')}"
            ).replace(") x j", ") j").replace(") x c", ") c")


def r_L28(src="src"):
    out = []
    for tok, d in ((" when ", "when"), (" end as ", "end as")):
        out.append(f"SELECT {F('L28', anchor='anc', detail=q(d))} FROM {_anchored(src, has('line', 'case'))} "
                   f"WHERE {has('line', tok)} AND {ind('aline')} + 4 <> {ind('line')}")
    return " UNION ALL ".join(out)


def r_L29(src="src"):
    return (f"SELECT {F('L29', anchor='anc')} FROM {_anchored(src, has_any('line', 'select', 'when', 'case'), False)} "
            f"WHERE {has('line', 'case')} AND {ind('aline')} + 4 <> {ind('line')}")


def r_L30(src="src"):
    kw = has_any("line", "select", "case", " when ", " end")
    x = _anchored(src, kw, False)
    out = []
    for d, tok, off in (("select", "select", 4), ("when", "when", 4), ("end", "end", 0)):
        out.append(f"SELECT {F('L30', anchor='anc', detail=q(d))} FROM {x} WHERE {has('line', 'case')} "
                   f"AND {has('aline', tok)} AND {ind('aline')} + {off} <> {ind('line')}")
    return " UNION ALL ".join(out)


# ---------------------------------------------------------------- select blocks (brute force)


def _block_pairs(src):
    """(doc_id, ln, line, sn): line ln lies in the block of the select line sn."""
    return (f"(SELECT l.doc_id, l.line_no AS ln, l.line AS line, s.line_no AS sn FROM {src} l JOIN {src} s "
            f"ON s.doc_id = l.doc_id AND s.line_no < l.line_no AND ends_with(s.line, 'select') AND s.eol "
            f"WHERE NOT EXISTS (SELECT 1 FROM {src} f WHERE f.doc_id = l.doc_id AND f.line_no > s.line_no "
            f"AND f.line_no <= l.line_no AND contains(f.line, ' from ')))")


def r_L14(src="src"):
    return (f"SELECT {F('L14', line_no='ln', anchor='max(sn)', detail='count(*)')} FROM {_block_pairs(src)} p "
            f"WHERE {nind('line')} <> 8 GROUP BY doc_id, ln")


def r_L16(src="src", tokens=("sum(", "min(", "max(")):
    agg = has_any("line", *tokens)
    agg_a = has_any("a.line", *tokens)
    return (f"SELECT {F('L16', line_no='ln', anchor='g', detail='count(*)')} FROM ("
            f"SELECT p.*, (SELECT max(a.line_no) FROM {src} a WHERE a.doc_id = p.doc_id AND a.line_no < p.ln AND {agg_a}) AS g "
            f"FROM {_block_pairs(src)} p WHERE NOT {agg}) e WHERE g > sn GROUP BY doc_id, ln, g")


def blocks_sql(src="src"):
    return (f"SELECT s.doc_id, s.line_no AS select_line, s.line_no + 1 AS first_line, "
            f"coalesce((SELECT min(f.line_no) FROM {src} f WHERE f.doc_id = s.doc_id AND f.line_no > s.line_no "
            f"AND contains(f.line, ' from ')) - 1, s.n_lines) AS last_line FROM {src} s "
            f"WHERE ends_with(s.line, 'select') AND s.eol")


def r_L11c(src="src"):
    def close_of(cond):
        return (f"(SELECT min(c.line_no) FROM {src} c WHERE c.doc_id = h.doc_id AND c.line_no > h.line_no AND {cond} AND c.eol)")

    paren = close_of("ends_with(c.line, ')')")
    comma = close_of("ends_with(c.line, '),')")
    headers = (f"(SELECT h.*, CASE WHEN n.cnt = 1 OR {has('h.line', 'final as (')} THEN {paren} ELSE {comma} END AS close_no "
               f"FROM {src} h JOIN (SELECT doc_id, count(*) FILTER (WHERE {has('line', 'as (')}) AS cnt FROM {src} GROUP BY doc_id) n "
               f"ON n.doc_id = h.doc_id WHERE {has('h.line', 'as (')} AND (n.cnt = 1 OR {has('h.line', 'final as (')} "
               f"OR NOT {has('h.line', 'final as')}))")
    return (f"SELECT {F('L11c', detail=q('header'))} FROM {headers} hh WHERE starts_with(line, ' ') UNION ALL "
            f"SELECT {F('L11c', line_no='hh.close_no', anchor='hh.line_no', detail=q('close'), doc='hh.doc_id')} "
            f"FROM {headers} hh JOIN {src} c ON c.doc_id = hh.doc_id AND c.line_no = hh.close_no WHERE starts_with(c.line, ' ')")


def r_L31(src="src"):
    e = f"contains({strip('line')} || ' ', 'end ')"
    c = has("line", "case")
    p = (f"(SELECT *, coalesce(sum(CAST({e} AS INTEGER) - CAST({c} AS INTEGER)) {BEFORE}, 0) AS P, {c} AS is_case "
         f"FROM {src})")
    kw = has_any("line", "select", "case", " when ", " end")
    asked = f"(SELECT * FROM {p} WHERE {kw} AND {e})"
    cases = f"(SELECT * FROM {p} WHERE is_case)"
    return (f"SELECT {F('L31', anchor='jn', doc='x.doc_id', line_no='x.line_no')} FROM ("
            f"SELECT k.doc_id, k.line_no, k.line, coalesce(max(j.line_no), 1) AS jn FROM {asked} k LEFT JOIN {cases} j "
            f"ON j.doc_id = k.doc_id AND j.line_no < k.line_no AND j.P <> k.P GROUP BY k.doc_id, k.line_no, k.line) x "
            f"JOIN {src} a ON a.doc_id = x.doc_id AND a.line_no = x.jn WHERE {ind('a.line')} <> {ind('x.line')}")


# ---------------------------------------------------------------- brackets: a recursive stack


def bracket_ctes(src="src") -> str:
    """``ev`` (every bracket with its order), ``st`` (a stack run over the events of each
    document: a surplus ``)`` is ignored), ``pairs``, ``surplus``, ``unclosed``."""
    return (
        f"ev AS (SELECT s.doc_id, s.line_no, CAST(u.k - 1 AS INTEGER) AS k, u.b, starts_with(s.line, ' ') AS line_sp, "
        f"row_number() OVER (PARTITION BY s.doc_id ORDER BY s.line_no, u.k) AS idx "
        f"FROM {src} s, unnest(regexp_extract_all(s.line, '[()]')) WITH ORDINALITY AS u(b, k)), "
        f"st AS (SELECT doc_id, CAST(0 AS BIGINT) AS idx, []::BIGINT[] AS stack, CAST(NULL AS BIGINT) AS o, "
        f"CAST(NULL AS BIGINT) AS c, false AS surplus, 0 AS lvl FROM (SELECT DISTINCT doc_id FROM ev) "
        f"UNION ALL SELECT s.doc_id, e.idx, "
        f"CASE WHEN e.b = '(' THEN list_append(s.stack, e.idx) WHEN len(s.stack) > 0 THEN s.stack[1:len(s.stack) - 1] "
        f"ELSE s.stack END, "
        f"CASE WHEN e.b = ')' AND len(s.stack) > 0 THEN s.stack[len(s.stack)] END, "
        f"CASE WHEN e.b = ')' AND len(s.stack) > 0 THEN e.idx END, "
        f"e.b = ')' AND len(s.stack) = 0, CAST(len(s.stack) AS INTEGER) "
        f"FROM st s JOIN ev e ON e.doc_id = s.doc_id AND e.idx = s.idx + 1), "
        f"pairs AS (SELECT st.doc_id, st.lvl AS level, eo.line_no AS open_line, eo.k AS open_k, ec.line_no AS close_line, "
        f"ec.k AS close_k, eo.line_sp AS open_sp FROM st JOIN ev eo ON eo.doc_id = st.doc_id AND eo.idx = st.o "
        f"JOIN ev ec ON ec.doc_id = st.doc_id AND ec.idx = st.c WHERE st.o IS NOT NULL)"
    )


def bracket_pairs_sql(src="src") -> str:
    return f"SELECT doc_id, level, open_line, open_k, close_line, close_k FROM pairs"


def r_L10b_sql() -> str:
    return (f"SELECT {F('L10b', line_no='e.line_no', detail=q(')'), doc='e.doc_id')} FROM st JOIN ev e "
            f"ON e.doc_id = st.doc_id AND e.idx = st.idx WHERE st.surplus UNION ALL "
            f"SELECT {F('L10b', line_no='e.line_no', detail=q('('), doc='e.doc_id')} FROM ev e WHERE e.b = '(' "
            f"AND NOT EXISTS (SELECT 1 FROM st WHERE st.doc_id = e.doc_id AND st.o = e.idx)")


def bracket_text_ctes(src="src") -> str:
    """Brackets located in the rebuilt document text: offset, line and column by counting characters."""
    nl = "chr(10)"
    return (
        f"txt AS (SELECT doc_id, string_agg(line, {nl} ORDER BY line_no) || "
        f"CASE WHEN bool_or(eol AND line_no = n_lines) THEN {nl} ELSE '' END AS t FROM {src} GROUP BY doc_id), "
        f"chars AS (SELECT doc_id, t, CAST(r.i - 1 AS BIGINT) AS pos, r.ch FROM txt, unnest(string_split(t, '')) WITH ORDINALITY AS r(ch, i)), "
        f"bt AS (SELECT doc_id, pos, ch, "
        f"1 + length(substr(t, 1, CAST(pos AS INTEGER))) - length(replace(substr(t, 1, CAST(pos AS INTEGER)), {nl}, '')) AS line_no, "
        f"length(regexp_extract(substr(t, 1, CAST(pos AS INTEGER)), '[^\\n]*$')) AS col, "
        f"substr(t, CAST(greatest(pos - 3, 1) AS INTEGER), CAST(least(pos, 4) AS INTEGER)) AS before4 "
        f"FROM chars WHERE ch IN ('(', ')'))"
    )


def r_L11_sql() -> str:
    """Uses ``pairs`` plus the text positions of the brackets (``bt``)."""
    return (
        f"SELECT {F('L11', line_no='p.open_line', detail=q('open'), doc='p.doc_id')} FROM pairs p "
        f"JOIN btk o ON o.doc_id = p.doc_id AND o.line_no = p.open_line AND o.k = p.open_k "
        f"WHERE o.before4 = ' as ' AND p.open_sp UNION ALL "
        f"SELECT {F('L11', line_no='p.close_line', anchor='p.open_line', detail=q('close'), doc='p.doc_id')} FROM pairs p "
        f"JOIN btk o ON o.doc_id = p.doc_id AND o.line_no = p.open_line AND o.k = p.open_k "
        f"JOIN btk c ON c.doc_id = p.doc_id AND c.line_no = p.close_line AND c.k = p.close_k "
        f"WHERE o.before4 = ' as ' AND c.col <> 0"
    )


def btk_cte() -> str:
    return ("btk AS (SELECT doc_id, pos, ch, CAST(line_no AS INTEGER) AS line_no, CAST(col AS INTEGER) AS col, before4, "
            "CAST(row_number() OVER (PARTITION BY doc_id, line_no ORDER BY pos) - 1 AS INTEGER) AS k FROM bt)")


# ---------------------------------------------------------------- document rules


def r_doc_sql(src="src") -> str:
    counts = (f"(SELECT doc_id, count(*) FILTER (WHERE {has('line', 'ref(')}) AS n_ref, "
              f"count(*) FILTER (WHERE {has('line', 'with')}) AS n_with, "
              f"count(*) FILTER (WHERE {has('line', 'final as (')}) AS n_final FROM {src} GROUP BY doc_id) d")
    return (f"SELECT {F('L19', line_no='NULL')} FROM {counts} WHERE n_ref = 1 AND n_with = 1 UNION ALL "
            f"SELECT {F('L20', line_no='NULL')} FROM {counts} WHERE n_ref > 1 AND n_final = 0")


LINE_SQL = {
    "L01": r_L01, "L01b": r_L01b, "L02": r_L02, "L03": r_L03, "L05": r_L05, "L06": r_L06, "L06b": r_L06b,
    "L07": r_L07, "L11b": r_L11b, "L17": r_L17, "L18": r_L18, "L21": r_L21, "L25": r_L25,
    "L04": r_L04, "L08": r_L08, "L09": r_L09, "L12": r_L12, "L13": r_L13, "L26": r_L26, "L27": r_L27,
    "L22": r_L22, "L23": r_L23, "L24": r_L24, "L28": r_L28, "L29": r_L29, "L30": r_L30,
    "L14": r_L14, "L16": r_L16, "L11c": r_L11c, "L31": r_L31,
}


def all_findings_sql(src_cte: str, rule_ids) -> str:
    """WITH-prefix plus SELECT of all findings (line rules ``rule_ids``, brackets, documents)."""
    body = " UNION ALL ".join(f"({LINE_SQL[r]('src')})" for r in rule_ids)
    ctes = f"{src_cte}, {bracket_ctes()}, {bracket_text_ctes()}, {btk_cte()}"
    allf = f"{body} UNION ALL ({r_L10b_sql()}) UNION ALL ({r_L11_sql()}) UNION ALL ({r_doc_sql()})"
    return ctes, allf
