"""Named per-line values shared by the rules.

* ``NEIGHBOURS``: tests of a line one or two away. ``lines_from_text`` reads them from the split text
  (narrow); for a lines table they come from a ``Shift`` scan.
* ``TESTS``: what the anchor rules ask of one line (short tokens, indentation). ``line_events``
  evaluates the requested ones, drops the text of the line and the lines that no test holds on.
* ``FEATURES``: scan specs over those events, in numbered stages of one scan; a later stage may read
  the columns of an earlier one (payloads that need a running count, for example). The scan reads
  its input twice (values and carry), so the events are stored in the shared checkpoint folder: the texts
  are read once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from .scan import Change, Prefix, Shift, Total, last_where, next_where, scan


def L():
    return F.col("line")

# Tokens the rules look for.
AGGREGATE_TOKENS = ("sum(", "min(", "max(")
CLAUSE_TOKENS = (" on ", " using", "where", " from ")
KEYWORD_TOKENS = ("select", "case", " when ", " end")


def select_eol() -> Column:
    """The line is ``...select`` followed by its newline (the rules' ``"select\\n"`` test)."""
    return L().endswith("select") & F.col("eol")


def is_agg(tokens: Iterable[str] = AGGREGATE_TOKENS) -> Column:
    return tx.has_any(L(), *tokens)


def agg_tokens(opts: dict | None) -> tuple[str, ...]:
    """The aggregate tokens of L16 (option ``agg_tokens``; the default is sum/min/max)."""
    return tuple((opts or {}).get("agg_tokens", AGGREGATE_TOKENS))


def end_word() -> Column:
    """``(line.strip() + ' ')`` contains ``'end '``."""
    return F.concat(tx.strip(L()), F.lit(" ")).contains("end ")


def keyword_line() -> Column:
    return tx.has_any(L(), *KEYWORD_TOKENS)


def _blank(line: Column, eol: Column) -> Column:
    return tx.is_blank(line)


# name -> (offset, value of that line given its text and whether a newline ends it). Names that share the function
# share its value on each line.
NEIGHBOURS: dict[str, tuple[int, Callable[[Column, Column], Column]]] = {
    "prev_join": (-1, lambda line, eol: tx.has(line, "join")),
    "prev_blank": (-1, _blank),
    "prev2_blank": (-2, _blank),
    "next_blank": (1, _blank),
    "next2_blank": (2, _blank),
    "prev2_as": (-2, lambda line, eol: tx.has(line, " as (")),
    "prev_union": (-1, lambda line, eol: tx.has_any(line, "union", "except")),
    "prev_select_eol": (-1, lambda line, eol: line.endswith("select") & eol),
    "next_when": (1, lambda line, eol: tx.has(line, "when")),
    "next_when_pos": (1, lambda line, eol: F.when(tx.has(line, "when"), F.instr(line, "when") - 1)),
}


def with_neighbours(lines: DataFrame, names: Iterable[str]) -> DataFrame:
    """``lines`` plus the named neighbour values that it does not hold already."""
    missing = sorted(n for n in set(names) if n not in lines.columns)
    return scan(lines, {n: Shift(NEIGHBOURS[n][1](L(), F.col("eol")), NEIGHBOURS[n][0]) for n in missing})


# Values of one line. The boolean ones also say which lines matter: see line_events.
TESTS: dict[str, Callable[[dict | None], Column]] = {
    "t_first": lambda o: F.col("line_no") == 1,
    "t_from": lambda o: tx.has(L(), "from"),
    "t_from_sp": lambda o: tx.has(L(), " from "),
    "t_join": lambda o: tx.has(L(), "join"),
    "t_on": lambda o: tx.has(L(), " on "),
    "t_and": lambda o: tx.has(L(), " and "),
    "t_clause": lambda o: tx.has_any(L(), *CLAUSE_TOKENS),
    "t_case": lambda o: tx.has(L(), "case"),
    "t_when": lambda o: tx.has(L(), "when"),
    "t_when_sp": lambda o: tx.has(L(), " when "),
    "t_end": lambda o: tx.has(L(), "end"),
    "t_end_as": lambda o: tx.has(L(), " end as "),
    "t_end_word": lambda o: end_word(),
    "t_select": lambda o: tx.has(L(), "select"),
    "t_select_eol": lambda o: select_eol(),
    "t_swc": lambda o: tx.has_any(L(), "select", "when", "case"),
    "t_keyword": lambda o: keyword_line(),
    "t_agg": lambda o: is_agg(agg_tokens(o)),
    "t_as": lambda o: tx.has(L(), "as ("),
    "t_final_as": lambda o: tx.has(L(), "final as"),
    "t_final_as_p": lambda o: tx.has(L(), "final as ("),
    "t_ref": lambda o: tx.has(L(), "ref("),
    "t_with": lambda o: tx.has(L(), "with"),
    "t_close_comma": lambda o: L().endswith("),") & F.col("eol"),
    "t_close_paren": lambda o: L().endswith(")") & F.col("eol"),
    "t_off_name": lambda o: F.coalesce(tx.name_indent(L()) != 8, F.lit(False)),
    "sp": lambda o: L().startswith(" "),
    "ind": lambda o: tx.indent(L()),
}


def _c(name: str) -> Column:
    return F.col(name)


def _n(name: str) -> Column:
    return F.col(name).cast("int")


def _at(test: str, *payload: str, inclusive: bool = True):
    return last_where(_c(test), *[_c(p).alias(p) for p in payload], inclusive=inclusive)


def _below(test: str, *payload: str):
    return next_where(_c(test), *[_c(p).alias(p) for p in payload], inclusive=False)


# name -> (stage, what it reads, spec factory)
FEATURES: dict[str, tuple[int, tuple[str, ...], Callable[[], object]]] = {
    # nearest anchor lines above (inclusive unless noted)
    "from_at": (1, ("t_from", "ind"), lambda: _at("t_from", "ind")),
    "join_at": (1, ("t_join", "ind"), lambda: _at("t_join", "ind")),
    "clause_at": (1, ("t_clause", "t_on"), lambda: _at("t_clause", "t_on")),
    "case_at": (1, ("t_case", "ind"), lambda: _at("t_case", "ind")),
    "swc_above": (1, ("t_swc", "ind"), lambda: _at("t_swc", "ind", inclusive=False)),
    "kw_above": (1, ("t_keyword", "ind", "t_select", "t_when", "t_end"),
                 lambda: _at("t_keyword", "ind", "t_select", "t_when", "t_end", inclusive=False)),
    "sel_above": (1, ("t_select_eol",), lambda: _at("t_select_eol", inclusive=False)),
    "line1": (1, ("t_first", "ind"), lambda: _at("t_first", "ind")),
    # running counts
    "cs": (1, ("t_select_eol",), lambda: Prefix(_n("t_select_eol"), "sum", True)),
    "p31": (1, ("t_end_word", "t_case"), lambda: Prefix(_n("t_end_word") - _n("t_case"), "sum", False)),
    "as_total": (1, ("t_as",), lambda: Total(_n("t_as"))),
    "n_ref": (1, ("t_ref",), lambda: Total(_n("t_ref"))),
    "n_with": (1, ("t_with",), lambda: Total(_n("t_with"))),
    "n_final": (1, ("t_final_as_p",), lambda: Total(_n("t_final_as_p"))),
    # stage 2: anchors whose payload is a running count of stage 1
    "fromsp_at": (2, ("t_from_sp", "cs"), lambda: last_where(_c("t_from_sp"), _c("cs").alias("cs"), counts=(("cs", "cs"),))),
    "agg_before": (2, ("t_agg", "cs", "t_select_eol"),
                   lambda: last_where(_c("t_agg"), (_c("cs") - _n("t_select_eol")).alias("cs"), inclusive=False,
                                      counts=(("cs", "cs"),))),
    "lc31": (2, ("t_case", "p31", "ind"),
             lambda: last_where(_c("t_case"), _c("p31").alias("p"), _c("ind").alias("ind"), inclusive=False,
                                counts=(("p", "p31"),))),
    # stage 3: the last case line that starts a new count
    "rs31": (3, ("t_case", "lc31", "p31"), lambda: Change(_c("t_case"), "p31", "lc31", ("no", "ind"))),
    # nearest lines below (strictly)
    "fromsp_after": (1, ("t_from_sp",), lambda: _below("t_from_sp")),
    "close_comma_after": (1, ("t_close_comma", "sp"), lambda: _below("t_close_comma", "sp")),
    "close_paren_after": (1, ("t_close_paren", "sp"), lambda: _below("t_close_paren", "sp")),
}


def closure(names: Iterable[str]) -> set[str]:
    """The names with everything they read."""
    out: set[str] = set()
    todo = list(names)
    while todo:
        n = todo.pop()
        if n in out:
            continue
        if n not in FEATURES and n not in TESTS:
            raise KeyError(f"unknown feature {n}")
        out.add(n)
        if n in FEATURES:
            todo.extend(FEATURES[n][1])
    return out


def line_events(lines: DataFrame, names: Iterable[str], opts: dict | None = None, every_line: bool = False,
                extra: dict[str, Column] | None = None) -> DataFrame:
    """``doc_id, n_lines, line_no`` and the tests that ``names`` read, without the text of the line.

    Only lines on which one of the boolean tests holds are kept (all of them with ``every_line``):
    elsewhere no anchor, count or finding can come from. ``extra`` adds columns; a line on which one
    of them is not null is kept too.
    """
    tests = sorted(n for n in closure(names) if n in TESTS)
    extra = extra or {}
    ev = lines.select("doc_id", "n_lines", "line_no", *[TESTS[t](opts).alias(t) for t in tests],
                      *[e.alias(n) for n, e in extra.items()])
    if every_line:
        return ev
    keep = [_c(t) for t in tests if t.startswith("t_")] + [_c(n).isNotNull() for n in extra]
    return ev.filter(reduce(or_, keep))


def with_features(events: DataFrame, names: Iterable[str], tasks: int | None = None) -> DataFrame:
    """Stored ``line_events`` plus the requested features (and the ones they depend on), in one scan."""
    wanted = [n for n in sorted(closure(names)) if n in FEATURES]
    stages = [{n: FEATURES[n][2]() for n in wanted if FEATURES[n][0] == k} for k in sorted({FEATURES[n][0] for n in wanted})]
    return scan(events, stages[0], keep_chunk=True, later=stages[1:], tasks=tasks) if stages else events
