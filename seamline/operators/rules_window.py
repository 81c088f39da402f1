"""Rules that look at neighbouring lines (narrow) or at an anchor line above/below (scan features).

Neighbour rules test ``line`` and the neighbour values beside it; anchor rules see line tests and
scan features only, never the text of the line.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from .findings import Rule, concat_hits, hit


def L():
    return F.col("line")
def NO():
    return F.col("line_no")

def IND():
    return tx.indent(F.col("line"))


col = F.col


def _l04(opts=None):
    return hit("L04", col("prev_join") & tx.has(L(), " using"))


def _cte_candidate(opts=None):
    """A ``with`` line (the whole stripped line; option ``with_match="contains"``: any line that
    contains ``with``) or a CTE header (contains ``as (``)."""
    with_line = tx.has(L(), "with") if (opts or {}).get("with_match") == "contains" else (tx.strip(L()) == "with")
    return with_line | tx.has(L(), "as (")


def _l08(opts=None):
    cand = _cte_candidate(opts)
    return concat_hits(
        hit("L08", cand & ~col("next_blank"), detail="a"),
        hit("L08", cand & ~col("prev_blank"), detail="b"),
        hit("L08", cand & col("next_blank") & col("next2_blank"), detail="c"),
        hit("L08", cand & col("prev_blank") & col("prev2_blank"), detail="d"),
    )


def _l09(opts=None):
    cand = tx.has(L(), "select") & ~tx.has(L(), "select * from")
    return concat_hits(
        hit("L09", cand & col("next_blank"), detail="a"),
        hit("L09", cand & col("prev_blank") & col("prev2_blank"), detail="b"),
    )


def _l12(opts=None):
    cand = (tx.has(L(), "select") & ~tx.has(L(), "select * from final")
            & (col("prev2_as") | col("prev_union")))
    return hit("L12", cand & (IND() != 4))


def _l13(opts=None):
    return hit("L13", col("prev_select_eol") & (tx.name_indent(L()) != 8), anchor_no=NO() - 1)


def _l26(opts=None):
    return hit("L26", tx.has(L(), "case") & ~col("next_when"), line_no=NO() + 1, anchor_no=NO())


def _l27(opts=None):
    pos = F.instr(L(), "case") - 1
    return hit("L27", tx.has(L(), "case") & (pos + 4 != col("next_when_pos")), line_no=NO() + 1, anchor_no=NO())


def _l22(opts=None):
    return hit("L22", col("t_join") & (col("from_at.ind") != col("ind")), anchor_no=col("from_at.no"))


def _l23(opts=None):
    return hit("L23", col("t_on") & (col("join_at.ind") + 4 != col("ind")), anchor_no=col("join_at.no"))


def _l24(opts=None):
    cond = col("t_and") & col("clause_at.t_on") & (col("join_at.ind") + 8 != col("ind"))
    return hit("L24", cond, anchor_no=col("join_at.no"))


def _l28(opts=None):
    off = col("case_at.ind") + 4 != col("ind")
    return concat_hits(
        hit("L28", col("t_when_sp") & off, anchor_no=col("case_at.no"), detail="when"),
        hit("L28", col("t_end_as") & off, anchor_no=col("case_at.no"), detail="end as"),
    )


def _l29(opts=None):
    return hit("L29", col("t_case") & (col("swc_above.ind") + 4 != col("ind")), anchor_no=col("swc_above.no"))


def _l30(opts=None):
    case = col("t_case")
    kw = col("kw_above")
    return concat_hits(
        hit("L30", case & kw["t_select"] & (kw["ind"] + 4 != col("ind")), anchor_no=kw["no"], detail="select"),
        hit("L30", case & kw["t_when"] & (kw["ind"] + 4 != col("ind")), anchor_no=kw["no"], detail="when"),
        hit("L30", case & kw["t_end"] & (kw["ind"] != col("ind")), anchor_no=kw["no"], detail="end"),
    )


def in_block():
    """The line lies in at least one select block (see ``select_blocks``)."""
    return col("sel_above").isNotNull() & (col("sel_above.no") > F.coalesce(col("fromsp_at.no"), F.lit(0)))


def blocks_containing():
    """How many (possibly overlapping) select blocks contain the line."""
    return col("cs") - col("t_select_eol").cast("int") - F.coalesce(col("fromsp_at.cs"), F.lit(0))


def _l14(opts=None):
    return hit("L14", in_block() & col("t_off_name"), anchor_no=col("sel_above.no"),
               detail=blocks_containing().cast("string"))


def _l16(opts=None):
    errs = col("agg_before.cs") - F.coalesce(col("fromsp_at.cs"), F.lit(0))
    cond = ~col("t_agg") & col("agg_before").isNotNull() & (errs > 0)
    return hit("L16", cond, anchor_no=col("agg_before.no"), detail=errs.cast("string"))


def _l11c(opts=None):
    single = col("as_total") == 1
    # one CTE: close on the next line ending in ')'; several: '),' (the final CTE: ')')
    to_paren = col("t_as") & (single | col("t_final_as_p"))
    to_comma = col("t_as") & ~single & ~col("t_final_as")
    close = F.when(to_paren, col("close_paren_after")).when(to_comma, col("close_comma_after"))
    header = to_paren | to_comma
    return concat_hits(
        hit("L11c", header & col("sp"), detail="header"),
        hit("L11c", header & close["sp"], line_no=close["no"], anchor_no=NO(), detail="close"),
    )


def _l31(opts=None):
    """``end`` aligned with its ``case``: the partner is found by counting end/case lines upwards."""
    cand = col("t_keyword") & col("t_end_word")
    j1 = col("lc31")
    partner_no = (F.when(j1.isNull(), F.lit(1))
                  .when(j1["p"] != col("p31"), j1["no"])
                  .otherwise(F.coalesce(col("rs31.b_no"), F.lit(1))))
    partner_ind = (F.when(j1.isNull(), col("line1.ind"))
                   .when(j1["p"] != col("p31"), j1["ind"])
                   .when(col("rs31.b_no").isNotNull(), col("rs31.b_ind"))
                   .otherwise(col("line1.ind")))
    return hit("L31", cand & (col("ind") != partner_ind), anchor_no=partner_no)


WINDOW_RULES = [
    Rule("L04", "using right after a join", ("prev_join",), _l04),
    Rule("L08", "padding round with / CTE header", ("next_blank", "prev_blank", "next2_blank", "prev2_blank"), _l08),
    Rule("L09", "padding round select", ("next_blank", "prev_blank", "prev2_blank"), _l09),
    Rule("L12", "select not at column 4", ("prev2_as", "prev_union"), _l12),
    Rule("L13", "first column not at column 8", ("prev_select_eol",), _l13),
    Rule("L14", "column in a select block not at column 8", ("sel_above", "fromsp_at", "cs", "t_off_name"), _l14),
    Rule("L16", "aggregate not last in a select block", ("fromsp_at", "agg_before", "t_agg"), _l16, every_line=True),
    Rule("L11c", "CTE header/close indented",
         ("as_total", "close_paren_after", "close_comma_after", "t_as", "t_final_as", "t_final_as_p"), _l11c),
    Rule("L22", "join not aligned with its from", ("from_at", "t_join"), _l22),
    Rule("L23", "on not four right of its join", ("join_at", "t_on"), _l23),
    Rule("L24", "and of a join condition not eight right of its join", ("join_at", "clause_at", "t_and"), _l24),
    Rule("L26", "no when on the line after case", ("next_when",), _l26),
    Rule("L27", "when not four right of case", ("next_when_pos",), _l27),
    Rule("L28", "when/end as not four right of the case above", ("case_at", "t_when_sp", "t_end_as"), _l28, default=False),
    Rule("L29", "case not four right of the select/when/case above", ("swc_above", "t_case"), _l29, default=False),
    Rule("L30", "case against the previous keyword line", ("kw_above", "t_case"), _l30),
    Rule("L31", "end not aligned with its case", ("lc31", "rs31", "p31", "line1", "t_keyword", "t_end_word"), _l31),
]
