"""Per-line rules: each looks at one line only (narrow, no shuffle)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from .findings import Many, Rule, concat_hits, hit


def L():
    return F.col("line")
def NO():
    return F.col("line_no")

# Thresholds and tokens of the per-line rules.
MAX_CHARS = 100
IN_LIST_MIN_LENGTH = 80
IN_LIST_MIN_VALUES = 3
JOIN_KINDS = ("inner", "left", "outer", "right")
IN_MARKERS = (" in (", " in(")
JOIN_REWRITE = "inner join"


def _l01(opts=None):
    # characters other than ' ', the newline counted
    n = F.length(F.replace(L(), F.lit(" "), F.lit(""))) + F.col("eol").cast("int")
    return hit("L01", n > MAX_CHARS)


def _l01b(opts=None):
    return hit("L01b", F.length(tx.strip(L())) > MAX_CHARS)


def _l02(opts=None):
    return hit("L02", tx.lstrip(L()).startswith(","))


def join_without_kind():
    return tx.has(L(), "join") & ~tx.has_any(L(), *JOIN_KINDS)


def _l03(opts=None):
    return hit("L03", join_without_kind())


def suggestion(rewrite: str = JOIN_REWRITE):
    """The line with every ``join`` replaced (the file itself is never changed)."""
    return F.replace(L(), F.lit("join"), F.lit(rewrite))


def _l05(opts=None):
    rewrite = (opts or {}).get("join_rewrite", JOIN_REWRITE)
    return hit("L05", join_without_kind(), detail=suggestion(rewrite))


def _l06(opts=None):
    return hit("L06", tx.has(L(), "<>"))


def _l06b(opts=None):
    return hit("L06b", tx.has_any(L(), "with", "select"))


def _l07(opts=None):
    """One finding per even piece between single quotes that holds upper-case letters."""
    pieces = F.split(L(), "'", -1)
    tagged = F.transform(pieces, lambda p, i: F.struct(i.alias("i"), p.alias("p")))
    bad = F.filter(
        tagged,
        lambda x: (x["i"] % 2 == 0) & x["p"].rlike(r"[A-Za-z][^\n]") & (x["p"] != F.lower(x["p"])),
    )
    return Many(F.transform(
        bad,
        lambda x: F.struct(
            F.lit("L07").alias("rule_id"),
            NO().cast("int").alias("line_no"),
            F.lit(None).cast("int").alias("anchor_no"),
            x["i"].cast("string").alias("detail"),
        ),
    ))


def _l17(opts=None):
    s = tx.strip(L())
    return concat_hits(hit("L17", s.contains("( "), detail="a"), hit("L17", s.contains(" )"), detail="b"))


def _l18(opts=None):
    total = F.length(L()) + F.col("eol").cast("int")
    out = []
    for m in IN_MARKERS:
        after = F.split_part(L(), F.lit(m), F.lit(2))
        values = tx.count_of(after, ",") + 1
        out.append(hit("L18", tx.has(L(), m) & (values >= IN_LIST_MIN_VALUES) & (total >= IN_LIST_MIN_LENGTH),
                       detail=m.strip()))
    return concat_hits(*out)


def _l21(opts=None):
    ind = tx.indent(L())
    return concat_hits(
        hit("L21", tx.has(L(), "join") & (ind != 4), detail="join"),
        hit("L21", tx.has(L(), " on ") & (ind != 8), detail="on"),
    )


def _l25(opts=None):
    return hit("L25", tx.has(L(), "case") & ~((tx.lstrip(L()) == "case") & F.col("eol")))


def _l11b(opts=None):
    return hit("L11b", tx.has(L(), "as (") & (tx.name_indent(L()) != 0))


LINE_RULES = [
    Rule("L01", "line longer than 100 characters (spaces not counted)", (), _l01),
    Rule("L01b", "stripped line longer than 100 characters", (), _l01b, default=False),
    Rule("L02", "comma at the start of a line", (), _l02),
    Rule("L03", "join without its kind", (), _l03),
    Rule("L05", "suggested rewrite for a join without kind", (), _l05, default=False),
    Rule("L06", "<> instead of !=", (), _l06),
    Rule("L06b", "line with with/select (keyword collection)", (), _l06b, default=False),
    Rule("L07", "upper case outside quotes", (), _l07),
    Rule("L11b", "CTE name not at column 0", (), _l11b),
    Rule("L17", "space after ( or before )", (), _l17),
    Rule("L18", "long in-list on one line", (), _l18),
    Rule("L21", "join not at column 4 / on not at column 8", (), _l21),
    Rule("L25", "text on the case line", (), _l25),
]
