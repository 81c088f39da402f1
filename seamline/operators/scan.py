"""Ordered scans over the lines of documents, without ever putting one document into one task.

Every rule that looks at neighbouring lines or searches up/down for an anchor line is a *scan* over
``lines(doc_id, line_no, line, eol, n_lines)`` in ``line_no`` order. A plain
``Window.partitionBy('doc_id')`` would make a single huge document (say a third of the corpus)
one task. Instead:

* lines are cut into chunks of ``chunk_lines`` consecutive lines; every window is partitioned by
  ``(doc_id, n_lines, chunk)``: one shuffle, and a group never holds more than one chunk;
* lag/lead read across a chunk border through a *halo*: the first/last ``h`` lines of a chunk are
  copied into the neighbouring chunk (``h`` = largest offset asked for), then dropped again;
* running aggregates (``Prefix``/``Suffix``) are computed inside the chunk and then combined with
  a *carry*: one ``groupBy(doc_id, chunk)`` summary of the documents that span several chunks,
  a prefix (or suffix) over those summaries, and a left join back on ``(doc_id, chunk)``. The carry
  table has one row per chunk (total lines / chunk_lines rows), so AQE broadcasts it when its
  measured size allows and shuffles it otherwise. Documents with fewer lines than a chunk never
  enter the carry branch.

* values that read other running values (an anchor whose payload is a running count) are *later* stages of the same
  scan: they are evaluated inside the chunk with counts from its start, on the same sort order, and a
  chunk's summary is made global when the summaries are merged. So there is one exchange and one carry, however many
  values build on each other.

The carry reads the scan's input a second time, so callers hand in a narrow stored frame (see
``features.py``) and never the texts. A frame may leave out lines on which every input is null or 0:
chunks are cut by ``line_no``, not by row.

Anchors ("the nearest line above that contains ``from``") are running maxima of
``struct(line_no, payload...)`` restricted to the anchor lines; "the next line below" is a running
minimum. ``n_lines`` sits in the window key only so that filters on it move below the window.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_CHUNK_LINES = 1 << 20
CHUNK_CONF = "seamline.scan.chunkLines"

KEY = ["doc_id", "n_lines", "_chunk"]


@dataclass(frozen=True)
class Shift:
    """Value of ``expr`` on the line ``offset`` away (-1 = previous line); null past either end."""

    expr: Column
    offset: int


@dataclass(frozen=True)
class Prefix:
    """``agg`` (max, min, sum) of ``expr`` over the lines at or before (``inclusive``) or strictly before."""

    expr: Column
    agg: str = "max"
    inclusive: bool = True
    counts: tuple[tuple[str, str], ...] = ()  # (payload field, the running sum it holds): made global with the carry


@dataclass(frozen=True)
class Change:
    """Nearest line strictly above on which ``cond`` holds with another ``count`` (a running sum, by name) than on the
    ``cond`` line before it: ``struct(no, b_<field>...)``, the fields those of that earlier line. ``before`` names the
    spec of the nearest ``cond`` line strictly above, whose field ``p`` is the count there."""

    cond: Column
    count: str
    before: str
    fields: tuple[str, ...] = ("no",)


@dataclass(frozen=True)
class Suffix:
    """``agg`` of ``expr`` over the lines at or after (``inclusive``) or strictly after."""

    expr: Column
    agg: str = "min"
    inclusive: bool = True


@dataclass(frozen=True)
class Total:
    """Sum of ``expr`` over the whole document, on every line."""

    expr: Column


def anchor(cond: Column, *payload: Column) -> Column:
    """``struct(no = line_no, payload...)`` on lines where ``cond`` holds, else null."""
    return F.when(cond, F.struct(F.col("line_no").alias("no"), *payload))


def last_where(cond: Column, *payload: Column, inclusive: bool = True, counts: tuple = ()) -> Prefix:
    """Nearest line at or above (or strictly above) where ``cond`` holds, as a struct."""
    return Prefix(anchor(cond, *payload), "max", inclusive, counts)


def next_where(cond: Column, *payload: Column, inclusive: bool = True) -> Suffix:
    """Nearest line at or below (or strictly below) where ``cond`` holds, as a struct."""
    return Suffix(anchor(cond, *payload), "min", inclusive)


def chunk_lines_of(df: DataFrame) -> int:
    value = df.sparkSession.conf.get(CHUNK_CONF, None)
    return int(value) if value else DEFAULT_CHUNK_LINES


_AGG = {"max": F.max, "min": F.min, "sum": F.sum}


def _combine(agg: str, a: Column, b: Column) -> Column:
    if agg == "max":
        return F.greatest(a, b)
    if agg == "min":
        return F.least(a, b)
    return F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))


def _moved(value: Column, spec: Prefix, by) -> Column:
    """An anchor with its counts moved by where the chunk starts."""
    for name, count in spec.counts:
        value = value.withField(name, value[name] + F.coalesce(by(count), F.lit(0)))
    return value


def _started(before: Column, no: Column, spec: Change) -> Column:
    return F.struct(no.alias("no"), *[before[f].alias(f"b_{f}") for f in spec.fields])


def _input(name: str, spec) -> Column:
    if isinstance(spec, Change):
        before = F.col(spec.before)
        return F.when(spec.cond & (before["p"] != F.col(spec.count)), _started(before, F.col("line_no"), spec))
    return spec.expr


def _of(specs: dict, kind) -> dict:
    return {n: s for n, s in specs.items() if isinstance(s, kind)}


def scan(lines: DataFrame, specs: dict, chunk_lines: int | None = None, order: tuple[str, ...] = ("line_no",),
         keep_chunk: bool = False, later: Sequence[dict] = (), tasks: int | None = None) -> DataFrame:
    """Add one column per entry of ``specs`` (name -> Shift/Prefix/Suffix/Total/Change) to ``lines``.

    ``order`` may add columns after ``line_no`` for frames with several rows per line (bracket
    events); chunks are always cut by ``line_no``, and ``Shift`` then counts rows, so it is only
    offered on one-row-per-line frames. ``keep_chunk`` keeps the ``_chunk`` column so that a later
    window partitioned by ``(doc_id, n_lines, _chunk, ...)`` reuses this partitioning. ``tasks``: partitions of the
    exchange (``session.tasks_for``), the session's number when None.

    ``later``: further stages of specs, whose inputs may read the columns of the stages before. A running sum
    counts from the start of the chunk there, so it may enter as a payload named in ``counts``, or in a ``Change``,
    and nowhere else.
    """
    if not specs:
        return lines
    c = chunk_lines or chunk_lines_of(lines)
    stages = [specs, *later]
    every = {n: s for stage in stages for n, s in stage.items()}
    for name, spec in every.items():
        if not isinstance(spec, (Shift, Prefix, Suffix, Total, Change)):
            raise TypeError(f"unknown scan spec for {name}: {spec!r}")
    shifts = _of(every, Shift)
    if shifts and tuple(order) != ("line_no",):
        raise ValueError("Shift needs one row per line")
    if shifts and later:
        raise ValueError("Shift and later stages need scans of their own")

    out_cols = list(lines.columns)
    chunk = F.floor((F.col("line_no") - 1) / F.lit(c)).cast("int")
    # an existing _chunk column (from an earlier pass) is reused, so the partitioning carries over
    base = lines.select("*", *([] if "_chunk" in out_cols else [chunk.alias("_chunk")]),
                        *[_input(n, s).alias(f"_in_{n}") for n, s in specs.items()])

    df, core = base, None
    if shifts:
        h = max(abs(s.offset) for s in shifts.values())
        pos = (F.col("line_no") - 1) % F.lit(c)
        copies = F.array(
            F.lit(0),
            F.when((pos < h) & (F.col("_chunk") > 0), F.lit(-1)),
            F.when((pos >= c - h) & (F.col("line_no") < F.col("n_lines")), F.lit(1)),
        )
        df = (
            df.select("*", F.explode_outer(copies).alias("_copy"))
            .filter(F.col("_copy").isNotNull())
            .withColumn("_chunk", F.col("_chunk") + F.col("_copy"))
        )
        core = F.col("_copy") == 0

    if tasks:
        df = df.repartition(tasks, *KEY)

    def own(n: str, agg: str) -> Column:
        x = F.col(f"_in_{n}")
        return F.when(core, x) if core is not None and agg == "sum" else x

    def running(n: str, agg: str, inclusive: bool, window) -> Column:
        value = _AGG[agg](own(n, agg)).over(window.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1))
        return F.coalesce(value, F.lit(0)) if agg == "sum" else value

    w = Window.partitionBy(*KEY).orderBy(*order)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    for k, stage in enumerate(stages):
        if k:
            df = df.select("*", *[_input(n, s).alias(f"_in_{n}") for n, s in stage.items()])
        columns = [(F.lag if s.offset < 0 else F.lead)(F.col(f"_in_{n}"), abs(s.offset)).over(w).alias(n)
                   for n, s in _of(stage, Shift).items()]
        columns += [running(n, s.agg, s.inclusive, w).alias(n) for n, s in _of(stage, Prefix).items()]
        columns += [running(n, "max", False, w).alias(n) for n in _of(stage, Change)]
        # a whole-chunk sum is one aggregate per group, in the same window as the prefixes
        columns += [F.sum(own(n, "sum")).over(whole).alias(n) for n in _of(stage, Total)]
        df = df.select("*", *columns)
    local = df
    # A frame "current row to unbounded following" is re-aggregated for every row (quadratic in
    # the chunk); the same values come from a running frame over the reversed order.
    w_rev = Window.partitionBy(*KEY).orderBy(*[F.col(o).desc() for o in order])
    df = df.select("*", *[running(n, s.agg, s.inclusive, w_rev).alias(n) for n, s in _of(every, Suffix).items()])
    if core is not None:
        df = df.filter(core)
    if len(every) > len(shifts):
        df = _apply_carry(df, local if later else base, stages, c)

    if keep_chunk and "_chunk" not in out_cols:
        out_cols = out_cols + ["_chunk"]
    finals = [F.coalesce(F.col(n), F.lit(0)).alias(n) if isinstance(s, Total) else F.col(n) for n, s in every.items()]
    return df.select(*[F.col(x) for x in out_cols if x not in every], *finals)


def _apply_carry(df: DataFrame, seen: DataFrame, stages: Sequence[dict], c: int) -> DataFrame:
    """Combine chunk-local values with those of the earlier/later chunks. ``seen`` holds the inputs of all specs."""
    every = {n: s for stage in stages for n, s in stage.items() if not isinstance(s, Shift)}
    changes = _of(every, Change)
    agg_of = {n: "sum" if isinstance(s, Total) else getattr(s, "agg", "max") for n, s in every.items()}
    aggs = [_AGG[a](F.col(f"_in_{n}")).alias(f"_s_{n}") for n, a in agg_of.items()]
    aggs += [F.min(F.when(s.cond, F.struct(F.col("line_no").alias("no"), F.col(s.count).alias("p")))).alias(f"_f_{n}")
             for n, s in changes.items()]
    carry = seen.filter(F.col("n_lines") > F.lit(c)).groupBy(*KEY).agg(*aggs)

    wd = Window.partitionBy("doc_id", "n_lines").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    wd_rev = Window.partitionBy("doc_id", "n_lines").orderBy(F.col("_chunk").desc()).rowsBetween(Window.unboundedPreceding, -1)
    wd_all = Window.partitionBy("doc_id", "n_lines").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def start(count: str) -> Column:
        return F.col(f"_c_{count}")

    for stage in stages:  # a later stage reads the carry of the stages before
        whole = [_moved(F.col(f"_s_{n}"), s, start).alias(f"_g_{n}") for n, s in _of(stage, Prefix).items()]
        for n, s in _of(stage, Change).items():
            before, first = F.col(f"_c_{s.before}"), F.col(f"_f_{n}")
            differs = before["p"] != first["p"] + F.coalesce(start(s.count), F.lit(0))
            whole.append(F.when(differs, _started(before, first["no"], s)).alias(f"_b_{n}"))
        carry = carry.select("*", *whole)
        found = [_AGG[s.agg](F.col(f"_g_{n}")).over(wd).alias(f"_c_{n}") for n, s in _of(stage, Prefix).items()]
        found += [F.max(F.coalesce(f"_s_{n}", f"_b_{n}")).over(wd).alias(f"_c_{n}") for n in _of(stage, Change)]
        found += [_AGG[s.agg](F.col(f"_s_{n}")).over(wd_rev).alias(f"_c_{n}") for n, s in _of(stage, Suffix).items()]
        found += [(F.sum(F.col(f"_s_{n}")).over(wd_all) - F.coalesce(F.col(f"_s_{n}"), F.lit(0))).alias(f"_c_{n}")
                  for n in _of(stage, Total)]
        carry = carry.select("*", *found)
    carry = carry.select(*KEY, *[f"_c_{n}" for n in every], *[f"_b_{n}" for n in changes])

    joined = df.join(carry, on=KEY, how="left")
    combined = []
    for n, s in every.items():
        here, there = F.col(n), F.col(f"_c_{n}")
        if isinstance(s, Change):
            at_start = F.col(f"_b_{n}")
            here = F.coalesce(here, F.when(at_start["no"] < F.col("line_no"), at_start), there)
        elif isinstance(s, Prefix) and s.counts:
            here = F.coalesce(_moved(here, s, start), there)
        else:
            here = _combine(agg_of[n], here, there)
        combined.append(here.alias(n))
    return joined.select(*[F.col(x) for x in df.columns if x not in every], *combined)
