"""Column functions of the customer models: conditionals, casts, keys and value maps (all built in,
JVM side; no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def iff(cond: Column, a, b) -> Column:
    """``iff(cond, a, b)``."""
    return F.when(cond, a).otherwise(b)


def to_varchar(x) -> Column:
    """``to_varchar(x)`` / ``x::varchar``."""
    return c(x).cast("string")


def is_numeric(x) -> Column:
    """``try_to_numeric(x) is not null``: the text parses as a whole number."""
    return c(x).try_cast("decimal(38,0)").isNotNull()


def month_start(x) -> Column:
    """``date_trunc('month', x)`` as a date."""
    return F.trunc(c(x).cast("date"), "MM")


def surrogate_key(*cols) -> Column:
    """md5 of the values as text, nulls as '', joined by '-'.

    Every value is coalesced first: a plain ``concat_ws`` skips nulls, which would give
    ``(a, null, b)`` and ``(a, b, null)`` the same key.
    """
    return F.md5(F.concat_ws("-", *[F.coalesce(c(x).cast("string"), F.lit("")) for x in cols]))


# The value maps of the customer model as rules (test, argument, result) in the test data's
# domain; the first rule that holds decides, and a value without one stays as it is.
# "is": equal; "prefix"/"part": starts with/contains, in either case; "null": no value.
SEGMENT_LABEL = (("is", "HOUSEHOLD", "Home"), ("null", None, "Unknown"))
SEGMENT_GROUP = (("is", "HOUSEHOLD", "Consumer"), ("is", "FURNITURE", "Consumer"), ("is", "BUILDING", "Construction"),
                 ("null", None, "Unsorted"))
MARKET = (("prefix", "america", "Americas"), ("part", "east", "Middle East"), ("null", None, "Unknown"))
MARKET_GROUP = (("is", "ASIA", "APAC"), ("part", "america", "Americas"), ("is", "EUROPE", "EMEA"), ("is", "AFRICA", "EMEA"),
                ("prefix", "middle", "EMEA"), ("null", None, "Unknown"))


def value_map(x, rules) -> Column:
    """``x`` mapped by the first rule that holds, else ``x`` itself."""
    v = c(x)
    tests = {"is": lambda a: v == a, "prefix": lambda a: v.ilike(f"{a}%"), "part": lambda a: v.ilike(f"%{a}%"),
             "null": lambda a: v.isNull()}
    out = F
    for test, argument, result in rules:
        out = out.when(tests[test](argument), F.lit(result))
    return out.otherwise(v)
