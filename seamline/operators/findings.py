"""Findings: the one output table of every rule, plus the run-all pass and its summaries.

``findings(doc_id bigint, rule_id string, line_no int, anchor_no int, detail string)`` -- one row
per violation; ``anchor_no`` is the line the rule compared against (null when none) and ``detail``
says which sub-check fired when a rule has several.

A line rule is declared as a :class:`Rule`: the values it needs (neighbours, line tests, scan
features; see ``features.py``) and a column that gives the array of findings on a line. Rules of
one line and its neighbours share a narrow pass; anchor and document rules share one scan.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FINDING_TYPE = T.StructType(
    [
        T.StructField("rule_id", T.StringType()),
        T.StructField("line_no", T.IntegerType()),
        T.StructField("anchor_no", T.IntegerType()),
        T.StructField("detail", T.StringType()),
    ]
)
FINDINGS_COLUMNS = ["doc_id", "rule_id", "line_no", "anchor_no", "detail"]


def hit(rule_id: str, cond: Column, line_no: Column | None = None, anchor_no: Column | None = None,
        detail: Column | str | None = None) -> Column:
    """The finding (a struct) when ``cond`` is true on the line, else null."""
    if isinstance(detail, str):
        detail = F.lit(detail)
    rec = F.struct(
        F.lit(rule_id).alias("rule_id"),
        (line_no if line_no is not None else F.col("line_no")).cast("int").alias("line_no"),
        (anchor_no if anchor_no is not None else F.lit(None)).cast("int").alias("anchor_no"),
        (detail if detail is not None else F.lit(None)).cast("string").alias("detail"),
    )
    return F.when(F.coalesce(cond, F.lit(False)), rec)


class Many:
    """A rule output with any number of findings per line (an array of finding structs)."""

    def __init__(self, arr: Column):
        self.arr = arr


def concat_hits(*hits) -> list:
    """Collect the outputs of a rule: single hits (struct or null) and ``Many`` arrays."""
    out: list = []
    for h in hits:
        out.extend(h if isinstance(h, list) else [h])
    return out


def findings_array(outputs) -> Column:
    """One array per line: the single hits side by side (nulls included) plus the ``Many`` arrays.
    Building one array per line (instead of concatenating a small array per rule) keeps the
    per-line work to one allocation; the nulls are dropped after the explode."""
    singles = [o for o in outputs if not isinstance(o, Many)]
    many = [o.arr for o in outputs if isinstance(o, Many)]
    parts = ([F.array(*singles)] if singles else []) + many
    return parts[0] if len(parts) == 1 else F.concat(*parts)


@dataclass(frozen=True)
class Rule:
    rule_id: str
    title: str
    needs: tuple[str, ...]
    findings: Callable[[], Column]
    default: bool = True
    every_line: bool = False  # may fire on a line on which none of the tests in ``needs`` holds


def explode_findings(df: DataFrame, arr: Column) -> DataFrame:
    """One row per finding. ``explode_outer`` + a null filter keeps Spark from inferring a
    ``size(arr) > 0`` filter, which would evaluate every rule twice."""
    # the array is projected first, so it is computed inside whole-stage codegen; the generator
    # then only walks an existing array
    staged = df.select("doc_id", arr.alias("_f"))
    return staged.select("doc_id", F.explode_outer("_f").alias("f")).filter(F.col("f").isNotNull()).select(
        "doc_id", "f.rule_id", "f.line_no", "f.anchor_no", "f.detail"
    )


def union_findings(frames: Iterable[DataFrame]) -> DataFrame:
    frames = list(frames)
    out = frames[0].select(*FINDINGS_COLUMNS)
    for f in frames[1:]:
        out = out.unionByName(f.select(*FINDINGS_COLUMNS))
    return out


def summary(findings: DataFrame) -> DataFrame:
    """Findings per document and rule (partial aggregation before the shuffle)."""
    return findings.groupBy("doc_id", "rule_id").agg(
        F.count(F.lit(1)).alias("n_findings"),
        F.min("line_no").alias("first_line"),
    )


def clean_documents(docs: DataFrame, findings: DataFrame) -> DataFrame:
    """Documents without any finding. The findings side is reduced to distinct ids first, so a
    document with millions of findings is one row before the anti join."""
    bad = findings.select("doc_id").distinct()
    return docs.join(bad, on="doc_id", how="left_anti")
