"""Bracket pairing and the rules built on it, without a per-document stack.

Each ``(`` / ``)`` becomes an event numbered by its place among all brackets of its document: a running count
over the lines that hold brackets, and its place in its line. From there on an event is to the scans what a line is elsewhere (scan.py):
chunks are cut by event number, so neither a document nor a line with very many brackets is ever one group.

With ``S`` the running sum of +1/-1 over the events, the depth of a stack that ignores a surplus ``)`` is
``S - min(0, min S so far)`` (a reflected walk). Within a chunk both are running aggregates from 0; a chunk is
summarised by (its sum, its least ``S``), and summaries of consecutive chunks merge into the sum and least ``S`` before a chunk.

* an open bracket's level is the depth after it; a matched close's level is the depth before it;
* a close is surplus when ``S`` falls below every earlier prefix (and 0);
* among the events of one level the opens and closes alternate, so an open's partner is the next
  event of its level: ``lead`` over ``(doc_id, chunk, level)``, and for the last event of a level
  in a chunk, the first event of that level in a later chunk (a small carry table).

Each step with a carry reads its input twice, so the lines' brackets and the events with their walk inside the
chunk are stored in the shared checkpoint folder; the texts are read once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, tasks_for
from .features import line_events
from .scan import KEY, Prefix, Total, chunk_lines_of, scan


BRACKET_COLUMNS = ("brackets", "line_sp")


def bracket_columns() -> dict[str, Column]:
    """``brackets``: per bracket of the line ``is_open``, ``as_before`` (the four characters before it are
    ``' as '``) and ``col0`` (it is the first character); ``line_sp``: the line starts with a space. Both
    are null on a line without brackets."""
    line = F.col("line")
    found = line.rlike("[()]")
    # zipped, so that the split is evaluated once a line and not once a bracket
    pairs = F.arrays_zip(F.regexp_extract_all(line, F.lit("([()])"), 1).alias("b"),
                         F.split(line, "[()]", -1).alias("pre"))
    tagged = F.transform(F.filter(pairs, lambda z: z["b"].isNotNull()), lambda z, i: F.struct(
        (z["b"] == "(").alias("is_open"), z["pre"].endswith(" as ").alias("as_before"),
        ((i == 0) & (z["pre"] == "")).alias("col0")))
    return {"brackets": F.when(found, tagged), "line_sp": F.when(found, line.startswith(" "))}


def numbered_events(per_line: DataFrame, array: str, carried: dict[str, Column] | None = None) -> DataFrame:
    """One row per element of ``array`` of stored lines: ``doc_id, at_line, k, e``, its number among its document's as
    ``line_no`` and how many those are as ``n_lines``, so that scans cut chunks by event. ``carried``: sums over the earlier lines."""
    size = F.coalesce(F.size(array), F.lit(0)).cast("long")
    sums = {"before": Prefix(size, "sum", False), "events": Total(size)}
    sums |= {n: Prefix(c, "sum", False) for n, c in (carried or {}).items()}
    placed = scan(per_line, sums, tasks=tasks_for(per_line.sparkSession, per_line.count()))
    keep = [c for c in per_line.columns if c not in ("doc_id", "n_lines", "line_no", array)]
    ev = placed.select("doc_id", F.col("line_no").alias("at_line"), *keep, F.coalesce("before", F.lit(0)).alias("before"),
                       F.col("events").alias("n_lines"), *[F.coalesce(n, F.lit(0)).alias(n) for n in carried or {}],
                       F.posexplode_outer(array).alias("k", "e")).filter(F.col("k").isNotNull())
    return ev.withColumn("line_no", F.col("before") + F.col("k") + 1).withColumn("k", F.col("k").cast("int")).drop("before")


def bracket_events_of(events: DataFrame) -> DataFrame:
    """One row per bracket of stored line events that hold ``bracket_columns``."""
    lines = events.filter(F.col("brackets").isNotNull()).select("doc_id", "n_lines", "line_no", *BRACKET_COLUMNS)
    return numbered_events(lines, "brackets").select(
        "doc_id", "n_lines", "line_no", "at_line", "k", "e.is_open", "e.as_before", "e.col0", "line_sp")


def bracket_events(lines: DataFrame) -> DataFrame:
    """One row per bracket, ``doc_id, n_lines, line_no`` (both of events), ``at_line, k, is_open, as_before, col0, line_sp``,
    from a stored frame of the lines that hold brackets (without their text)."""
    return bracket_events_of(bracket_lines(lines))


def bracket_lines(lines: DataFrame) -> DataFrame:
    """The lines that hold brackets, stored without their text."""
    return cut_lineage(line_events(lines, (), extra=bracket_columns()))


def bracket_tasks(stored: DataFrame) -> int | None:
    """``session.tasks_for`` the brackets of stored lines."""
    n = stored.agg(F.sum(F.when(F.col("brackets").isNotNull(), F.size("brackets")))).first()[0]
    return tasks_for(stored.sparkSession, n or 0)


def bracket_depths(ev: DataFrame, tasks: int | None = None) -> DataFrame:
    """Events with ``level`` (null for a surplus close) and ``surplus``. ``tasks``: see ``scan``."""
    c = chunk_lines_of(ev)
    delta = F.when(F.col("is_open"), F.lit(1)).otherwise(F.lit(-1))
    in_order = Window.partitionBy(*KEY).orderBy("line_no")
    walk = ev.withColumn("_chunk", F.floor((F.col("line_no") - 1) / F.lit(c)).cast("int"))
    if tasks:
        walk = walk.repartition(tasks, *KEY)
    walk = walk.withColumn("_s", F.sum(delta).over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    walk = cut_lineage(walk.withColumn("_least", F.min("_s").over(in_order.rowsBetween(Window.unboundedPreceding, -1))))
    # (sum, least) of a chunk; those before it merge to where it starts and the least so far
    parts = walk.filter(F.col("n_lines") > F.lit(c)).groupBy(*KEY).agg(F.sum(delta).alias("sum"), F.min("_s").alias("least"))
    chunks = Window.partitionBy("doc_id", "n_lines").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    placed = parts.withColumn("_from", F.coalesce(F.sum("sum").over(chunks), F.lit(0)))
    carry = placed.select(*KEY, "_from", F.min(F.col("_from") + F.col("least")).over(chunks).alias("_low"))
    ev = walk.join(carry, KEY, "left").withColumn("_from", F.coalesce("_from", F.lit(0)))
    low_prev = F.least(F.lit(0), "_low", F.col("_from") + F.col("_least"))
    s = F.col("_from") + F.col("_s")
    surplus = ~F.col("is_open") & (s < low_prev)
    depth_after = s - F.least(low_prev, s)
    level = F.when(F.col("is_open"), depth_after).when(~surplus, depth_after + 1)
    return ev.select(*[x for x in walk.columns if x not in ("_s", "_least")], level.cast("long").alias("level"), surplus.alias("surplus"))


def bracket_pairs_events(ev: DataFrame, tasks: int | None = None) -> DataFrame:
    """Events with ``partner`` = struct of the matching close for every open (null if unmatched)."""
    ev = bracket_depths(ev, tasks)
    c = chunk_lines_of(ev)
    info = F.struct("line_no", "at_line", "k", "is_open", "col0")
    w_lvl = Window.partitionBy(*KEY, "level").orderBy("line_no")
    # carry: the first event of the same level in a later chunk (documents over one chunk only)
    firsts = (
        ev.filter((F.col("n_lines") > F.lit(c)) & F.col("level").isNotNull())
        .groupBy(*KEY, "level").agg(F.min(info).alias("_first"))
    )
    w_chunks = Window.partitionBy("doc_id", "n_lines", "level").orderBy("_chunk")
    nxt = firsts.select(*KEY, "level", F.lead("_first", 1).over(w_chunks).alias("_later"))
    ev = ev.withColumn("_next", F.lead(info, 1).over(w_lvl)).join(nxt, on=[*KEY, "level"], how="left")
    partner = F.when(F.col("is_open"), F.coalesce(F.col("_next"), F.col("_later")))
    return ev.select("*", partner.alias("partner")).drop("_next", "_later")


def bracket_pairs(lines: DataFrame) -> DataFrame:
    """``doc_id, level, open_line, open_k, close_line, close_k`` for every matched pair."""
    stored = bracket_lines(lines)
    ev = bracket_pairs_events(bracket_events_of(stored), bracket_tasks(stored))
    return ev.filter(F.col("partner").isNotNull()).select(
        "doc_id", F.col("level").cast("int").alias("level"),
        F.col("at_line").alias("open_line"), F.col("k").alias("open_k"),
        F.col("partner.at_line").alias("close_line"), F.col("partner.k").alias("close_k"),
    )


def nesting_findings(lines: DataFrame) -> DataFrame:
    """L10b and L11 from one bracket pass."""
    stored = bracket_lines(lines)
    return nesting_findings_of(bracket_events_of(stored), bracket_tasks(stored))


def nesting_findings_of(ev: DataFrame, tasks: int | None = None) -> DataFrame:
    """L10b and L11 of bracket events."""
    ev = bracket_pairs_events(ev, tasks)
    bad = F.col("surplus") | (F.col("is_open") & F.col("partner").isNull())
    cte = F.col("is_open") & F.col("as_before") & F.col("partner").isNotNull()
    none = F.lit(None).cast("int")
    arr = F.array(
        F.when(bad, F.struct(F.lit("L10b").alias("r"), F.col("at_line").alias("ln"), none.alias("an"),
                             F.when(F.col("is_open"), "(").otherwise(")").alias("d"))),
        F.when(cte & F.col("line_sp"), F.struct(F.lit("L11").alias("r"), F.col("at_line").alias("ln"),
                                                none.alias("an"), F.lit("open").alias("d"))),
        F.when(cte & ~F.col("partner.col0"), F.struct(F.lit("L11").alias("r"), F.col("partner.at_line").alias("ln"),
                                                      F.col("at_line").alias("an"), F.lit("close").alias("d"))),
    )
    out = ev.filter(bad | cte).select("doc_id", F.explode_outer(arr).alias("f")).filter(F.col("f").isNotNull())
    return out.select(
        "doc_id", F.col("f.r").alias("rule_id"), F.col("f.ln").cast("int").alias("line_no"),
        F.col("f.an").cast("int").alias("anchor_no"), F.col("f.d").alias("detail"))


def bracket_offsets(lines: DataFrame) -> DataFrame:
    """Every bracket with its character offset in the document text, its line and column.

    A line is split at its brackets; what the scans see of it is the length of the piece before each. A bracket's column is the
    running sum of those over its line (and of the brackets themselves), taken over all events of the document less that of the earlier lines, and
    a line starts at the running sum of ``length(line) + 1`` over the earlier lines.
    """
    line = F.col("line")
    before = F.slice(F.split(line, "[()]", -1), 1, F.greatest(F.size(F.split(line, "[()]", -1)) - 1, F.lit(0)))
    pieces = F.transform(F.arrays_zip(before.alias("pre"), F.regexp_extract_all(line, F.lit("([()])"), 1).alias("b")),
                         lambda z: F.struct(z["b"].alias("b"), (F.length(z["pre"]) + 1).alias("step")))
    sizes = cut_lineage(lines.select(
        "doc_id", "n_lines", "line_no", (F.length(line) + F.col("eol").cast("int")).alias("size"),
        (F.length(line) - F.length(F.substring_index(F.translate(line, "(", ")"), ")", -1))).alias("reach"),  # to the last bracket
        F.when(line.rlike("[()]"), pieces).alias("brackets")))
    reach = F.when(F.col("brackets").isNotNull(), F.col("reach")).otherwise(F.lit(0))
    ev = numbered_events(sizes, "brackets", {"line_start": F.col("size").cast("long"), "earlier": reach.cast("long")})
    ev = cut_lineage(ev.select("doc_id", "n_lines", "line_no", "at_line", "k", "line_start", "earlier", "e.b", F.col("e.step").cast("long").alias("step")))
    run = scan(ev, {"upto": Prefix(F.col("step"), "sum", True)})
    col = F.col("upto") - F.col("earlier") - 1
    return run.select("doc_id", F.col("at_line").alias("line_no"), "k", F.col("b").alias("bracket"), col.cast("int").alias("col"),
                      (F.col("line_start") + col).alias("offset"))
