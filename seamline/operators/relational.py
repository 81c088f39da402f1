"""Relational operators of the customer models, written so that a hot key cannot sink one task.

* latest row per key is an aggregate (``max`` of a struct that leads with the sort keys), so it
  combines map-side before the shuffle;
* all tied latest rows is that aggregate joined back on key and place, so a hot key's ties can be split;
* branches over one input are routed row by row in one pass; branches of different inputs are a union;
* joins stay equi-joins; sides are broadcast only by Spark's own size check (statistics/AQE),
  except the theta join, which is meant for a right side that the schema bounds;
* anti-joins are ``left_anti`` (never left join + ``is null``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def latest_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the greatest by ``order`` (descending, nulls last). ``order`` must make the
    choice unique for a repeatable result (add a unique column as the last key)."""
    payload = [x for x in df.columns if x not in keys]
    best = F.max(F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)],
                          *[F.col(x) for x in payload])).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_best.{x}").alias(x) for x in payload])


def latest_ties(df: DataFrame, keys: Sequence[Column], order: Sequence[Column]) -> DataFrame:
    """All rows tied for the first place of their key by ``order`` (greatest first, nulls last; a null key
    is a key). The first place is an aggregate that combines map-side, joined back on key and place, so
    the tied rows of a hot key are never one window group: AQE splits them as a skewed join side."""
    names = [f"_k{i}" for i in range(len(keys))]
    places = [f"_o{i}" for i in range(len(order))]
    marked = df.withColumns({**dict(zip(names, keys)), **dict(zip(places, order))})
    best = marked.groupBy(*names).agg(F.max(F.struct(*places)).alias("_best")).select(
        *[F.col(n).alias(f"_best{n}") for n in names], *[F.col(f"_best.{o}").alias(f"_best{o}") for o in places])
    same = [F.col(n).eqNullSafe(F.col(f"_best{n}")) for n in names + places]
    return marked.join(best, on=same, how="inner").select(*df.columns)


def anti_join(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """Rows of ``left`` without a partner in ``right``."""
    return left.join(right, on=on, how="left_anti")


def conditional_left_join(left: DataFrame, right: DataFrame, cond: Column) -> DataFrame:
    """Left join whose condition includes one-sided predicates; they stay in the join condition
    (moving them to a ``where`` would turn it into an inner join)."""
    return left.join(right, on=cond, how="left")


def theta_left_join(left: DataFrame, right: DataFrame, cond: Column) -> DataFrame:
    """Left join on a non-equality condition. Its output is the feature's own product, so it is meant for
    a right side that the schema bounds, such as ``region``; Spark plans it, whatever the size."""
    return left.join(right, on=cond, how="left")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` on ``schema``: cast the columns present, typed nulls for the missing ones."""
    have = set(df.columns)
    cols = [(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
    return df.select(*cols)


def union_branches(frames: Sequence[DataFrame], schema: T.StructType) -> DataFrame:
    """``union all`` of branches after conforming each to one schema (by name, not position)."""
    out = conform(frames[0], schema)
    for f in frames[1:]:
        out = out.unionByName(conform(f, schema))
    return out


def route_branches(df: DataFrame, route: Column, branches: dict[str, dict[str, Column]], schema: T.StructType) -> DataFrame:
    """``union all`` of branches over one input, in one pass: each row takes the columns of the branch that
    ``route`` names, typed nulls where the branch has none, and is dropped where it names no branch."""
    routed = df.withColumn("_route", route).filter(F.col("_route").isin(*branches))
    cols = []
    for f in schema.fields:
        out = F
        for name, values in branches.items():
            if f.name in values:
                out = out.when(F.col("_route") == name, values[f.name].cast(f.dataType))
        cols.append((F.lit(None).cast(f.dataType) if out is F else out).alias(f.name))
    return routed.select(*cols)


def group_sum_first(df: DataFrame, n: int, measures: dict[str, Column]) -> DataFrame:
    """``group by 1..n`` over the first ``n`` columns, with the given sums (partial + final aggregate)."""
    keys = df.columns[:n]
    return df.groupBy(*keys).agg(*[F.sum(m).alias(a) for a, m in measures.items()])
