"""Run style rules over a corpus of line-structured texts.

``run_rules`` evaluates any set of rules; ``lint`` adds the bracket rules and the document rules and
returns the whole ``findings`` table; ``lint_texts`` starts from whole texts.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage, tasks_for
from ..sources.corpus import lines_from_text
from .features import NEIGHBOURS, line_events, with_features, with_neighbours
from .findings import Rule, concat_hits, explode_findings, findings_array, union_findings
from .literals import code_lines, code_text
from .rules_doc import DOC_RULES
from .rules_line import LINE_RULES
from .rules_nesting import BRACKET_COLUMNS, bracket_columns, bracket_events_of, bracket_tasks, nesting_findings_of
from .rules_window import WINDOW_RULES

RULES: dict[str, Rule] = {r.rule_id: r for r in LINE_RULES + WINDOW_RULES + DOC_RULES}
DEFAULT_RULES = tuple(r.rule_id for r in LINE_RULES + WINDOW_RULES if r.default)
DOCUMENT_RULES = tuple(r.rule_id for r in DOC_RULES)
# rules that make sense on prose as well as on SQL
TEXT_RULES = ("L01", "L01b", "L17", "L18")


def rules_features(rule_ids: Iterable[str]) -> set[str]:
    needs: set[str] = set()
    for rid in rule_ids:
        needs.update(RULES[rid].needs)
    return needs


def neighbours_of(rule_ids: Iterable[str] | None = None) -> list[str]:
    """The neighbour values that the rules (default set when None) read; give them to
    ``lines_from_text`` so that they cost no shuffle."""
    ids = DEFAULT_RULES if rule_ids is None else rule_ids
    return sorted(n for n in rules_features(ids) if n in NEIGHBOURS)


def is_local(rule_id: str) -> bool:
    return all(n in NEIGHBOURS for n in RULES[rule_id].needs)


def _evaluate(df: DataFrame, ids: list[str], options: dict | None) -> DataFrame:
    return explode_findings(df, findings_array(concat_hits(*[RULES[i].findings(options) for i in ids])))


def _local_rules(lines: DataFrame, ids: list[str], options: dict | None) -> DataFrame:
    """Rules of one line and its neighbours: narrow when ``lines`` holds the neighbour values."""
    plain = [i for i in ids if not RULES[i].needs]
    near = [i for i in ids if RULES[i].needs]
    needs = neighbours_of(near)
    if all(n in lines.columns for n in needs):
        return _evaluate(lines, ids, options)
    frames = [_evaluate(lines, plain, options)] if plain else []
    return union_findings([*frames, _evaluate(with_neighbours(lines, needs), near, options)])


def run_rules(lines: DataFrame, rule_ids: Iterable[str] | None = None, options: dict | None = None,
              nesting: Iterable[str] = ()) -> DataFrame:
    """Findings of the given line and document rules (default set when None).

    Rules of one line and its neighbours run in a narrow pass over ``lines``. The others, and the
    bracket rules named in ``nesting``, read one narrow frame of line events, which is stored
    in the shared checkpoint folder before any scan. ``lines`` is therefore read at most twice.

    ``options``: ``agg_tokens`` (L16, default sum(/min(/max(), ``join_rewrite`` (L05, default
    'inner join'), ``with_match`` (L08: "line" = the stripped line is ``with``, the default;
    "contains" = the line contains ``with``), ``ignore_quoted`` (all rules: literals and comments are blanked
    first, see ``literals.py``; default false).
    """
    if (options or {}).get("ignore_quoted"):
        lines = code_lines(lines)
    ids = list(rule_ids) if rule_ids is not None else list(DEFAULT_RULES)
    nesting = tuple(nesting)
    local = [i for i in ids if is_local(i)]
    anchored = [i for i in ids if not is_local(i)]
    frames = [_local_rules(lines, local, options)] if local else []
    if anchored or nesting:
        needs = rules_features(anchored)
        events = cut_lineage(line_events(lines, needs, options, any(RULES[i].every_line for i in anchored),
                                         bracket_columns() if nesting else None))
        tasks = tasks_for(events.sparkSession, events.count())
        if anchored:
            frames.append(_evaluate(with_features(events.drop(*BRACKET_COLUMNS), needs, tasks), anchored, options))
        if nesting:
            found = nesting_findings_of(bracket_events_of(events), bracket_tasks(events))
            frames.append(found.filter(found.rule_id.isin(*nesting)))
    return union_findings(frames)


def lint(lines: DataFrame, rule_ids: Iterable[str] | None = None, nesting: Iterable[str] = ("L10b", "L11"),
         documents: bool = True, options: dict | None = None) -> DataFrame:
    """All findings: line rules, document rules (L19, L20) and bracket rules (``nesting``: L10b, L11)."""
    ids = list(rule_ids) if rule_ids is not None else list(DEFAULT_RULES)
    if documents:
        ids += [r for r in DOCUMENT_RULES if r not in ids]
    return run_rules(lines, ids, options, nesting)


def lint_texts(docs: DataFrame, rule_ids: Iterable[str] | None = None, nesting: Iterable[str] = ("L10b", "L11"),
               documents: bool = True, options: dict | None = None) -> DataFrame:
    """``lint`` over ``(doc_id, text)``; neighbour rules read the split text and need no shuffle, and with
    ``ignore_quoted`` the texts are blanked before the split."""
    if (options or {}).get("ignore_quoted"):
        docs = docs.withColumn("text", code_text(F.col("text")))
        options = {**options, "ignore_quoted": False}
    return lint(lines_from_text(docs, neighbours=neighbours_of(rule_ids)), rule_ids, nesting, documents, options)


# Titles of the rules computed outside the line-rule registry.
EXTRA_TITLES = {
    "L10b": "bracket without a partner",
    "L11": "CTE header or close not aligned (bracket form)",
}


def rule_catalog(spark: SparkSession) -> DataFrame:
    """``rule_id, title, is_default``: one row per rule (a fixed, small table)."""
    rows = [(r.rule_id, r.title, r.default or r.rule_id in DOCUMENT_RULES) for r in RULES.values()]
    rows += [(k, v, True) for k, v in EXTRA_TITLES.items()]
    return spark.createDataFrame(rows, "rule_id string, title string, is_default boolean")


def report(findings: DataFrame) -> DataFrame:
    """Findings with a readable message (S5). The catalog has one row per rule, so it is broadcast."""
    cat = F.broadcast(rule_catalog(findings.sparkSession).select("rule_id", "title"))
    line = F.when(F.col("line_no").isNotNull(), F.concat(F.lit(" at line "), F.col("line_no").cast("string"))) \
        .otherwise(F.lit(""))
    anchor = F.when(F.col("anchor_no").isNotNull(),
                    F.concat(F.lit(" (against line "), F.col("anchor_no").cast("string"), F.lit(")"))).otherwise(F.lit(""))
    detail = F.when(F.col("detail").isNotNull(), F.concat(F.lit(" ["), F.col("detail"), F.lit("]"))).otherwise(F.lit(""))
    return findings.join(cat, "rule_id", "left").select(
        *findings.columns,
        F.concat(F.col("rule_id"), F.lit(": "), F.coalesce(F.col("title"), F.lit("")), line, anchor, detail)
        .alias("message"),
    )
