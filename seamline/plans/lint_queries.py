"""Registered style-rule queries: Spark plans and their DuckDB oracles.

Two corpora: ``documents`` (prose; the whole texts) and the SQL corpus derived from ``customer``
(one 35-line model per customer, see FIXTURES.md). Each rule query returns ``findings`` columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import rules_doc, rules_nesting
from ..operators.findings import clean_documents
from ..operators.lint import DEFAULT_RULES, EXTRA_TITLES, RULES, TEXT_RULES, is_local, lint, lint_texts, neighbours_of, report, run_rules
from ..sources.corpus import (document_lines, given_texts, lines_from_text, long_text_lines, quoted_documents, quoted_models_sql, read_documents,
                              read_table, sql_lines)
from . import oracle_lint as o

# query name -> (rule id, corpus)
RULE_QUERIES = {
    "l01_long_line": ("L01", "documents"),
    "l01b_long_stripped": ("L01b", "documents"),
    "l02_leading_comma": ("L02", "sql"),
    "l03_join_kind": ("L03", "sql"),
    "l04_using": ("L04", "sql"),
    "l05_suggestion": ("L05", "sql"),
    "l06_not_equals": ("L06", "sql"),
    "l06b_keywords": ("L06b", "sql"),
    "l07_upper_case": ("L07", "documents"),
    "l08_cte_padding": ("L08", "sql"),
    "l09_select_padding": ("L09", "sql"),
    "l11b_cte_name_col": ("L11b", "sql"),
    "l11c_cte_align_lines": ("L11c", "sql"),
    "l12_select_col": ("L12", "sql"),
    "l13_first_col": ("L13", "sql"),
    "l14_all_cols": ("L14", "sql"),
    "l16_agg_last": ("L16", "sql"),
    "l17_bracket_spaces": ("L17", "sql"),
    "l18_long_in_list": ("L18", "sql"),
    "l21_join_cols": ("L21", "sql"),
    "l22_join_from": ("L22", "sql"),
    "l23_on_join": ("L23", "sql"),
    "l24_and_join": ("L24", "sql"),
    "l25_case_alone": ("L25", "sql"),
    "l26_when_next": ("L26", "sql"),
    "l27_when_col": ("L27", "sql"),
    "l28_when_case": ("L28", "sql"),
    "l29_case_anchor": ("L29", "sql"),
    "l30_case_prev": ("L30", "sql"),
    "l31_case_end": ("L31", "sql"),
}


# query name -> (rule id, options): variants of a rule over the SQL corpus
VARIANT_QUERIES = {
    "l05_left_join": ("L05", {"join_rewrite": "left join"}),
    "l08_with_contains": ("L08", {"with_match": "contains"}),
    "l16_more_aggregates": ("L16", {"agg_tokens": ("sum(", "min(", "max(", "avg(", "rank(", "dense_rank(", "select *")}),
}


def corpus_lines(spark: SparkSession, sf_dir: str, corpus: str, rule_ids=()) -> DataFrame:
    near = neighbours_of(rule_ids)
    if corpus == "documents":
        return document_lines(spark, sf_dir, near)
    # rules of a line and its neighbours stay without any exchange while there are few texts
    return sql_lines(spark, sf_dir, near, spread=rule_ids is None or not all(map(is_local, rule_ids)))


def corpus_cte(corpus: str) -> str:
    return o.doc_lines_cte() if corpus == "documents" else o.sql_lines_cte()


def _rule_query(rule_id: str, corpus: str, options: dict | None = None):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run_rules(corpus_lines(spark, sf_dir, corpus, [rule_id]), [rule_id], options)

    run.__name__ = f"rule_{rule_id}"
    return run


def l10_bracket_pairs(spark, sf_dir):
    return rules_nesting.bracket_pairs(sql_lines(spark, sf_dir))


def l10b_unbalanced(spark, sf_dir):
    return rules_nesting.nesting_findings(sql_lines(spark, sf_dir)).filter(F.col("rule_id") == "L10b")


def l11_cte_align(spark, sf_dir):
    return rules_nesting.nesting_findings(sql_lines(spark, sf_dir)).filter(F.col("rule_id") == "L11")


def l15_select_blocks(spark, sf_dir):
    from ..operators.blocks import select_blocks

    return select_blocks(sql_lines(spark, sf_dir))


def l19_needless_cte(spark, sf_dir):
    return rules_doc.needless_cte(sql_lines(spark, sf_dir))


def l20_final_cte(spark, sf_dir):
    return rules_doc.missing_final(sql_lines(spark, sf_dir))


def l33_offset_line(spark, sf_dir):
    return rules_nesting.bracket_offsets(sql_lines(spark, sf_dir))


def l32_findings_summary(spark, sf_dir):
    """All default rules over the SQL corpus, summarised per rule."""
    f = lint(corpus_lines(spark, sf_dir, "sql", None))
    per_doc = f.groupBy("rule_id", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    return per_doc.groupBy("rule_id").agg(F.sum("n").alias("n_findings"), F.count("doc_id").alias("n_docs"))


def text_findings(spark, sf_dir):
    """The rules that apply to prose (line length, bracket spacing, long lists, unbalanced
    brackets) over the whole ``documents`` texts."""
    return lint(document_lines(spark, sf_dir), TEXT_RULES, nesting=("L10b",), documents=False)


def l32_clean_documents(spark, sf_dir):
    """Documents of ``documents`` without any finding of the text rules."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return clean_documents(docs, text_findings(spark, sf_dir))


def l32_quality_by_rule(spark, sf_dir):
    """Per rule: documents with the finding, and how many of them are labelled good / toxic."""
    f = text_findings(spark, sf_dir).select("doc_id", "rule_id").distinct()
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    j = f.join(labels, on="doc_id", how="left")
    return j.groupBy("rule_id").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.count("quality").alias("n_labeled"),
        F.sum("quality").cast("long").alias("n_quality"),
        F.sum("toxic").cast("long").alias("n_toxic"),
    )


def l32_doc_flags(spark, sf_dir):
    """Every document of ``documents`` with its number of findings of the text rules and an error flag."""
    found = text_findings(spark, sf_dir).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    docs = read_table(spark, sf_dir, "documents").select("doc_id")
    n = F.coalesce(F.col("n"), F.lit(0)).cast("long")
    return docs.join(found, "doc_id", "left").select("doc_id", n.alias("n_findings"), (n > 0).alias("has_error"))


def s02_long_lines(spark, sf_dir):
    """The lines of all documents, their texts cut into pieces of 4 KiB."""
    return long_text_lines(read_documents(spark, sf_dir), piece_bytes=4096)


def _quoted(rule_id: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        lines = lines_from_text(quoted_documents(read_documents(spark, sf_dir)))
        return run_rules(lines, [rule_id], {"ignore_quoted": True})

    run.__name__ = f"quoted_{rule_id}"
    return run


def l32_given_texts(spark, sf_dir):
    """All default rules, bracket and document rules over every text of the warehouse: the findings themselves."""
    return lint_texts(given_texts(spark, sf_dir))


def s05_report(spark, sf_dir):
    """The findings of the text rules over ``documents`` with their messages."""
    return report(text_findings(spark, sf_dir))


def queries() -> dict:
    out = {name: _rule_query(rid, corpus) for name, (rid, corpus) in RULE_QUERIES.items()}
    out.update({name: _rule_query(rid, "sql", opts) for name, (rid, opts) in VARIANT_QUERIES.items()})
    out.update({
        "s02_long_lines": s02_long_lines,
        "l03_quoted": _quoted("L03"),
        "l04_quoted": _quoted("L04"),
        "l32_given_texts": l32_given_texts,
        "l32_doc_flags": l32_doc_flags,
        "s05_report": s05_report,
        "l10_bracket_pairs": l10_bracket_pairs,
        "l10b_unbalanced": l10b_unbalanced,
        "l11_cte_align": l11_cte_align,
        "l15_select_blocks": l15_select_blocks,
        "l19_needless_cte": l19_needless_cte,
        "l20_final_cte": l20_final_cte,
        "l32_findings_summary": l32_findings_summary,
        "l32_clean_documents": l32_clean_documents,
        "l32_quality_by_rule": l32_quality_by_rule,
        "l33_offset_line": l33_offset_line,
    })
    return out


def _with(cte: str, body: str) -> str:
    return f"WITH {cte} {body}"


def oracle_sql() -> dict:
    out = {}
    for name, (rid, corpus) in RULE_QUERIES.items():
        out[name] = _with(corpus_cte(corpus), o.LINE_SQL[rid]("src"))
    sql = o.sql_lines_cte()
    out["l05_left_join"] = _with(sql, o.r_L05("src", "left join"))
    out["l08_with_contains"] = _with(sql, o.r_L08("src", o.has("line", "with")))
    out["l16_more_aggregates"] = _with(sql, o.r_L16("src", VARIANT_QUERIES["l16_more_aggregates"][1]["agg_tokens"]))
    br = f"{sql}, {o.bracket_ctes()}"
    out["l10_bracket_pairs"] = _with("RECURSIVE " + br, o.bracket_pairs_sql())
    out["l10b_unbalanced"] = _with("RECURSIVE " + br, o.r_L10b_sql())
    out["l11_cte_align"] = _with(f"RECURSIVE {br}, {o.bracket_text_ctes()}, {o.btk_cte()}", o.r_L11_sql())
    out["l15_select_blocks"] = _with(sql, o.blocks_sql())
    out["l19_needless_cte"] = _with(sql, f"SELECT * FROM ({o.r_doc_sql()}) WHERE rule_id = 'L19'")
    out["l20_final_cte"] = _with(sql, f"SELECT * FROM ({o.r_doc_sql()}) WHERE rule_id = 'L20'")
    out["l33_offset_line"] = _with(
        f"{sql}, {o.bracket_text_ctes()}, {o.btk_cte()}",
        "SELECT doc_id, line_no, k, ch AS bracket, col, CAST(pos AS BIGINT) AS \"offset\" FROM btk")

    code = f"models AS ({quoted_models_sql()}), {o.code_cte('models', 'code')}, {o.doc_lines_cte(table='code')}"
    out["s02_long_lines"] = _with(o.doc_lines_cte(), "SELECT doc_id, line_no, line, eol, n_lines FROM src")
    out["l03_quoted"] = _with(code, o.r_L03())
    out["l04_quoted"] = _with(code, o.r_L04())
    given = (f"models AS ({quoted_models_sql()}), given AS (SELECT 'documents/' || doc_id AS doc_id, text FROM documents "
             f"UNION ALL SELECT 'models/' || doc_id, text FROM models "
             f"UNION ALL SELECT 'conversations/' || conv_id || '/' || turn, text FROM conversations "
             f"UNION ALL SELECT 'pages/' || page_id, html FROM pages), {o.doc_lines_cte(table='given')}")
    gctes, gall = o.all_findings_sql(given, DEFAULT_RULES)
    out["l32_given_texts"] = f"WITH RECURSIVE {gctes}, allf AS ({gall}) SELECT * FROM allf"

    ctes, allf = o.all_findings_sql(sql, DEFAULT_RULES)
    out["l32_findings_summary"] = (f"WITH RECURSIVE {ctes}, allf AS ({allf}) SELECT rule_id, count(*) AS n_findings, "
                                   f"count(DISTINCT doc_id) AS n_docs FROM allf GROUP BY rule_id")
    dctes = f"{o.doc_lines_cte()}, {o.bracket_ctes()}"
    dallf = " UNION ALL ".join(f"({o.LINE_SQL[r]('src')})" for r in TEXT_RULES)
    dallf += f" UNION ALL (SELECT * FROM ({o.r_L10b_sql()}))"
    out["l32_clean_documents"] = (f"WITH RECURSIVE {dctes}, allf AS ({dallf}) SELECT d.doc_id, d.lang, d.source "
                                  f"FROM documents d WHERE d.doc_id NOT IN (SELECT doc_id FROM allf)")
    out["l32_quality_by_rule"] = (
        f"WITH RECURSIVE {dctes}, allf AS ({dallf}), fd AS (SELECT DISTINCT doc_id, rule_id FROM allf) "
        f"SELECT fd.rule_id, count(*) AS n_docs, count(l.quality) AS n_labeled, "
        f"CAST(sum(l.quality) AS BIGINT) AS n_quality, CAST(sum(l.toxic) AS BIGINT) AS n_toxic "
        f"FROM fd LEFT JOIN labels l ON l.doc_id = fd.doc_id GROUP BY fd.rule_id")
    out["l32_doc_flags"] = (
        f"WITH RECURSIVE {dctes}, allf AS ({dallf}), n AS (SELECT doc_id, count(*) AS n FROM allf GROUP BY doc_id) "
        f"SELECT d.doc_id, coalesce(n.n, 0) AS n_findings, coalesce(n.n, 0) > 0 AS has_error "
        f"FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id")
    titles = {**{r: RULES[r].title for r in TEXT_RULES}, "L10b": EXTRA_TITLES["L10b"]}
    title = "CASE rule_id " + " ".join(f"WHEN {o.q(r)} THEN {o.q(t)}" for r, t in titles.items()) + " END"
    out["s05_report"] = (
        f"WITH RECURSIVE {dctes}, allf AS ({dallf}) SELECT *, rule_id || ': ' || {title} "
        f"|| coalesce(' at line ' || line_no, '') || coalesce(' (against line ' || anchor_no || ')', '') "
        f"|| coalesce(' [' || detail || ']', '') AS message FROM allf")
    return out
