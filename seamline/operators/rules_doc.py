"""Document rules: decided on counts over a whole document (one partial + final aggregate)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from .findings import FINDINGS_COLUMNS, Rule, hit


def L():
    return F.col("line")


def doc_counts(lines: DataFrame) -> DataFrame:
    """Per document: lines with ``ref(``, with ``with``, with ``final as (``.

    ``groupBy`` aggregates map-side first, so a huge document is one partial row per task before
    the shuffle.
    """
    return lines.groupBy("doc_id").agg(
        F.count_if(tx.has(L(), "ref(")).alias("n_ref"),
        F.count_if(tx.has(L(), "with")).alias("n_with"),
        F.count_if(tx.has(L(), "final as (")).alias("n_final"),
    )


def _doc_finding(df: DataFrame, rule_id: str) -> DataFrame:
    return df.select(
        "doc_id", F.lit(rule_id).alias("rule_id"), F.lit(None).cast("int").alias("line_no"),
        F.lit(None).cast("int").alias("anchor_no"), F.lit(None).cast("string").alias("detail"),
    ).select(*FINDINGS_COLUMNS)


def needless_cte(lines: DataFrame) -> DataFrame:
    """One model referenced (exactly one ``ref(`` line) and exactly one ``with`` line."""
    c = doc_counts(lines)
    return _doc_finding(c.filter((F.col("n_ref") == 1) & (F.col("n_with") == 1)), "L19")


def missing_final(lines: DataFrame) -> DataFrame:
    """More than one ``ref(`` line and no ``final as (`` line."""
    c = doc_counts(lines)
    return _doc_finding(c.filter((F.col("n_ref") > 1) & (F.col("n_final") == 0)), "L20")


def _first_line():
    return F.col("t_first")


def _l19(opts=None):
    return hit("L19", _first_line() & (F.col("n_ref") == 1) & (F.col("n_with") == 1), line_no=F.lit(None))


def _l20(opts=None):
    return hit("L20", _first_line() & (F.col("n_ref") > 1) & (F.col("n_final") == 0), line_no=F.lit(None))


# The same rules inside the wide scan: the counts are whole-document sums (scan ``Total``) and the
# finding is emitted once, on line 1 of the document.
DOC_RULES = [
    Rule("L19", "one model referenced and a CTE used", ("n_ref", "n_with", "t_first"), _l19),
    Rule("L20", "several models referenced and no final CTE", ("n_ref", "n_final", "t_first"), _l20),
]
