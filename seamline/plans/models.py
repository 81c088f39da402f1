"""The customer models as DataFrame plans, on the test warehouse.

* customer base    customer with its nation and region; channel by the parity of the key
* nation desks     one row per nation: its smallest/largest supplier key, first supplier name and
                   smallest supplier key with a positive balance
* orders           "recent": status F since ``RECENT_SINCE``; one profile row per customer holds the
                   date of the last recent order, the last order's priority and the last open order
* buyers (Q1)      active customers of the main nations with every order tied for their last recent
                   one, and dormant customers (no recent order) of each channel
* revenue (Q2)     lineitem, part and orders of the trade segments' customers, by month
* activity (Q3)    events with the page of their user (user_id = page_id), plus a small lookup

``AS_OF`` replaces ``current_date()`` so results are repeatable.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import model as fm
from ..operators import relational as rel
from ..session import ensure_checkpoint_dir
from ..sources.corpus import read_table
from ..sources.sinks import materialize, read_materialized

# Model parameters.
RECENT_SINCE = "1997-01-01"
REVENUE_SINCE = "1995-04-01"
AS_OF = dt.date(2000, 6, 15)
MAIN_NATIONS = ("NATION_1", "NATION_3", "NATION_5", "NATION_8", "NATION_13")
TRADE_SEGMENTS = ("BUILDING", "MACHINERY", "AUTOMOBILE")
LARGE_ORDER = 100000
EXCLUDED_USERS = (-111, 0, 1, -99, -9999)
# Path language -> category of a page.
PAGE_LOOKUP = (("fr", "French Pages"), ("de", "German Pages"), ("es", "Spanish Pages"))
# Rules over a page's url as (result, test, arguments); the first that holds decides.
# "all"/"any": the url contains all/any; "lang": path language; "plain": path language of a url without https.
GENERATION_RULES = (("v6", "all", ("https", "/en/")), ("v6", "any", ("blog.",)),
                    ("v5", "any", (".html", "#top", "page=")), ("v5", "plain", ("fr", "de")))
GENERATION_DEFAULT = "v6"
CATEGORY_RULES = (("folder", "any", ("blog.",)), ("file", "any", (".html",)), ("section", "lang", ("en",)),
                  ("lookup", "lang", ("fr", "de")))
CATEGORY_DEFAULT = "others"

col = F.col


def _ts(s: str):
    return F.expr(f"TIMESTAMP_NTZ '{s} 00:00:00'")


# ---------------------------------------------------------------- sources


def nations(spark: SparkSession, sf: str) -> DataFrame:
    """One row per nation of the code table, with its region."""
    n = read_table(spark, sf, "nation").select(
        col("n_nationkey").alias("nation_id"), col("n_name").alias("nation"), col("n_regionkey").alias("region_id"))
    r = read_table(spark, sf, "region").select(col("r_regionkey").alias("region_id"), col("r_name").alias("region"))
    return n.join(r, "region_id")


def nation_desks(spark: SparkSession, sf: str) -> DataFrame:
    """The nations with their suppliers' summary; ``first_supplier`` is null where a nation has none."""
    s = read_table(spark, sf, "supplier").groupBy(col("s_nationkey").alias("nation_id")).agg(
        F.min("s_suppkey").alias("first_supplier"),
        F.max("s_suppkey").alias("last_supplier"),
        F.min("s_name").alias("supplier_ref"),
        F.min(F.when(col("s_acctbal") > 0, col("s_suppkey"))).alias("solvent_supplier"))
    return nations(spark, sf).join(s, "nation_id", "left")


def customer_base(spark: SparkSession, sf: str, by_nation: DataFrame | None = None) -> DataFrame:
    """Customers with the columns of their nation. The nation side is broadcast: the code table bounds it
    to one row per nation, and a shuffle on so few keys would put a nation in one task."""
    web = col("c_custkey") % 2 == 0
    c = read_table(spark, sf, "customer").select(
        col("c_custkey").alias("cust_id"), col("c_name").alias("cust_name"), col("c_mktsegment").alias("segment"),
        col("c_nationkey").alias("nation_id"), customer_group().alias("customer_group"),
        F.when(web, "Web").otherwise("Trade").alias("channel"),
        F.when(web, col("c_custkey")).alias("web_number"), F.when(~web, col("c_custkey")).alias("trade_number"))
    return c.join(F.broadcast(nations(spark, sf) if by_nation is None else by_nation), "nation_id")


def customer_group() -> Column:
    """An outer case on the segment whose branches are cases of their own; no inner match gives null."""
    owing, near = col("c_acctbal") < 0, col("c_nationkey") < 5
    inner = F.when(owing, "building owing").when(near, "building near").otherwise("building")
    large = F.when(col("c_acctbal") >= 5000, "industry large")
    return (F.when(col("c_mktsegment") == "BUILDING", inner)
            .when(col("c_mktsegment").isin("AUTOMOBILE", "MACHINERY"), large).otherwise("other"))


def order_facts(spark: SparkSession, sf: str) -> DataFrame:
    recent = (col("o_orderstatus") == "F") & (col("o_orderdate") >= _ts(RECENT_SINCE))
    return read_table(spark, sf, "orders").select(
        col("o_orderkey").alias("order_id"), col("o_custkey").alias("cust_id"), col("o_orderpriority").alias("priority"),
        col("o_orderstatus").alias("status"), col("o_orderdate").cast("date").alias("order_date"),
        fm.month_start("o_orderdate").alias("order_month"), (col("o_totalprice") >= LARGE_ORDER).alias("is_large"),
        recent.alias("is_recent"))


def recent_orders(spark, sf) -> DataFrame:
    return order_facts(spark, sf).filter(col("is_recent"))


def last_recent_orders(spark, sf) -> DataFrame:
    """Recent orders, all rows tied for the latest per customer."""
    return rel.latest_ties(recent_orders(spark, sf), [col("cust_id")], [col("order_date"), col("order_month")])


def last_priority(spark, sf) -> DataFrame:
    """The latest order (by date, then key) per customer."""
    o = order_facts(spark, sf).select("cust_id", col("priority").alias("last_priority"), "order_date", "order_id")
    return rel.latest_row(o, ["cust_id"], [col("order_date"), col("order_id")])


def order_profile(spark, sf) -> DataFrame:
    """One row per customer from one aggregate over orders (combined map-side, so a hot customer is small)."""
    opened = F.when(col("status") == "O", F.struct("order_date", "order_id", "priority"))
    return order_facts(spark, sf).groupBy("cust_id").agg(
        F.max(F.when(col("is_recent"), col("order_date"))).alias("last_recent"),
        F.max(F.struct("order_date", "order_id", "priority")).getField("priority").alias("last_priority"),
        F.max(opened).alias("last_open"))


def dormant(spark, sf) -> DataFrame:
    """Customers without any recent order."""
    # distinct keys: a customer with millions of recent orders is one row per map task before the shuffle
    return rel.anti_join(customer_base(spark, sf), recent_orders(spark, sf).select("cust_id").distinct(), "cust_id")


def web_history(spark, sf) -> DataFrame:
    return read_table(spark, sf, "events").groupBy(col("user_id").alias("h_cust_id")).agg(
        F.max(col("ts").cast("date")).alias("last_seen"))


# ---------------------------------------------------------------- Q1 buyers

_TYPES = {"string": T.StringType(), "bigint": T.LongType(), "int": T.IntegerType(), "date": T.DateType()}
BUYER_COLUMNS = (
    "buyer_key string, state string, cust_id bigint, cust_name string, channel string, customer_group string, "
    "segment string, segment_label string, segment_group string, nation_id int, nation string, region string, "
    "market string, market_group string, first_supplier bigint, last_supplier bigint, solvent_supplier bigint, "
    "reference string, order_id bigint, order_priority string, order_month date, start_date date, "
    "last_priority string, last_open_date date, last_open_priority string, last_seen date, web_number bigint, "
    "trade_number bigint, dormant_market string")
BUYER_SCHEMA = T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in map(str.split, BUYER_COLUMNS.split(", "))])


def buyers(spark, sf) -> DataFrame:
    """The customer star in one pass over customers and two over orders (profile, tied rows), with
    ``state``: active rows, one per tied order, dormant rows, and null for the other customers."""
    base = customer_base(spark, sf, nation_desks(spark, sf)).join(order_profile(spark, sf), "cust_id", "left")
    main = col("nation").isin(*MAIN_NATIONS)
    base = base.withColumn("state", F.when(col("last_recent").isNull(), "dormant").when(main, "active"))
    tied = recent_orders(spark, sf).select(
        col("cust_id").alias("o_cust_id"), col("order_date").alias("o_date"), "order_id",
        col("priority").alias("order_priority"), "order_month", "is_large")
    out = rel.conditional_left_join(base, tied, (col("cust_id") == col("o_cust_id")) & (col("last_recent") == col("o_date"))
                                    & (col("state") == "active"))
    return rel.conditional_left_join(out, web_history(spark, sf), (col("cust_id") == col("h_cust_id"))
                                     & (col("channel") == "Web"))


def buyer_branches() -> dict[str, dict[str, Column]]:
    """The columns that each branch of the buyer table fills; typed nulls elsewhere (M3, M4)."""
    shared = {x: col(x) for x in ("cust_id", "cust_name", "channel", "customer_group", "segment", "nation_id", "nation",
                                  "region", "state")}
    shared |= {"segment_label": fm.value_map("segment", fm.SEGMENT_LABEL),
               "segment_group": fm.value_map("segment", fm.SEGMENT_GROUP),
               "last_open_date": col("last_open.order_date"), "last_open_priority": col("last_open.priority")}
    desk = {x: col(x) for x in ("first_supplier", "last_supplier")}
    open_start = F.when((col("channel") == "Trade") & (col("last_open.priority") == col("order_priority")),
                        col("last_open.order_date"))
    start = F.coalesce(F.when(col("is_large"), col("order_month")), col("last_seen"), open_start)
    active = {x: col(x) for x in ("solvent_supplier", "order_id", "order_priority", "order_month", "last_priority", "last_seen",
                                  "web_number", "trade_number")}
    active |= {"market": fm.value_map("region", fm.MARKET), "market_group": fm.value_map("region", fm.MARKET_GROUP),
               "start_date": start,
               "reference": fm.iff(col("channel") == "Web", F.coalesce(fm.to_varchar("solvent_supplier"), col("supplier_ref")),
                                   F.lit(None)),
               "buyer_key": fm.surrogate_key("channel", F.coalesce(fm.to_varchar("first_supplier"), fm.to_varchar("order_id")),
                                             "cust_id", "order_id")}
    gone = fm.value_map("region", fm.MARKET_GROUP)
    web = {"dormant_market": gone, "web_number": col("web_number"), "last_seen": col("last_seen"), "reference": col("supplier_ref"),
           "buyer_key": fm.surrogate_key("channel", "cust_id", "last_supplier")}
    trade = {"dormant_market": gone, "trade_number": col("trade_number"), "buyer_key": fm.surrogate_key("channel", "cust_id")}
    return {"active": shared | desk | active, "dormant web": shared | desk | web, "dormant trade": shared | trade}


def buyer_route() -> Column:
    """Dormant web customers need a supplier in their nation, dormant trade customers do not."""
    return (F.when(col("state") == "active", "active")
            .when((col("state") == "dormant") & (col("channel") == "Trade"), "dormant trade")
            .when((col("state") == "dormant") & col("first_supplier").isNotNull(), "dormant web"))


def q1_customer_dim(spark, sf) -> DataFrame:
    """Q1: active buyers and the dormant customers of both channels, one schema (typed nulls)."""
    return rel.route_branches(buyers(spark, sf), buyer_route(), buyer_branches(), BUYER_SCHEMA)


# ---------------------------------------------------------------- Q2 monthly revenue


def billed_orders(spark, sf, as_of: dt.date = AS_OF) -> DataFrame:
    """Orders of the reported months; the range is stated on the raw date, so parquet can skip row groups."""
    end = as_of.replace(day=1).isoformat()
    return (read_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
            .filter((col("o_orderdate") >= _ts(REVENUE_SINCE)) & (col("o_orderdate") < _ts(end)))
            .select(col("o_orderkey").alias("order_id"), col("o_custkey").alias("cust_id"),
                    fm.month_start("o_orderdate").alias("month")))


def billed_lines(spark, sf, orders: DataFrame) -> DataFrame:
    """The line items of ``orders`` that pass the model's filters.

    Money stays in decimals end to end (price and discount are exact at two places), so sums do
    not depend on the order of addition.
    """
    li = read_table(spark, sf, "lineitem").filter((col("l_linestatus") == "O") | (col("l_returnflag") == "R")).select(
        col("l_orderkey").alias("order_id"), col("l_linenumber").alias("line_no"), "l_partkey",
        (col("l_extendedprice").cast("decimal(18,2)") * (F.lit(1) - col("l_discount").cast("decimal(4,2)"))).alias("amount"))
    base = col("p_type").isin("ECONOMY", "STANDARD")
    extra = (col("p_type") == "PROMO") & (col("p_size") > 25)
    brand_no = F.split_part(col("p_brand"), F.lit("#"), F.lit(2))
    parts = read_table(spark, sf, "part").filter((base | extra) & fm.is_numeric(brand_no)).select("p_partkey")
    return li.join(parts, col("l_partkey") == col("p_partkey")).join(orders, "order_id").drop("l_partkey", "p_partkey")


def trade_revenue(spark, sf, as_of: dt.date = AS_OF) -> DataFrame:
    """Revenue by the first five columns. Orders are reduced to the trade segments' customers before
    the line items are joined; the nation's columns join one row per customer and month."""
    buyer = read_table(spark, sf, "customer").filter(col("c_mktsegment").isin(*TRADE_SEGMENTS)).select(
        col("c_custkey").alias("cust_id"), col("c_nationkey").alias("nation_id"))
    lines = billed_lines(spark, sf, billed_orders(spark, sf, as_of).join(buyer, "cust_id"))
    per_month = lines.groupBy("cust_id", "month", "nation_id").agg(F.sum("amount").alias("amount"))
    shaped = per_month.join(F.broadcast(nations(spark, sf)), "nation_id").select(
        "cust_id", "month", "nation", "nation_id", "region", "amount")
    return rel.group_sum_first(shaped, 5, {"revenue": col("amount")})


def q2_monthly_revenue(spark, sf) -> DataFrame:
    """Q2: monthly revenue per trade customer and month, where it is positive (M20: filter after aggregation)."""
    return trade_revenue(spark, sf).filter(col("revenue") > 0)


# ---------------------------------------------------------------- Q3 activity


def _holds(test: str, arguments: tuple) -> Column:
    url, lang = col("url"), F.split_part(col("url"), F.lit("/"), F.lit(4))
    found = [url.contains(a) for a in arguments]
    if test in ("all", "any"):
        out = found[0]
        for f in found[1:]:
            out = out & f if test == "all" else out | f
        return out
    spoken = lang.isin(*arguments)
    return spoken if test == "lang" else spoken & ~url.contains("https")


def _decide(rules, results: dict[str, Column], default: str) -> Column:
    out = F
    for result, test, arguments in rules:
        out = out.when(_holds(test, arguments), results[result])
    return out.otherwise(F.lit(default))


def q3_activity(spark, sf) -> DataFrame:
    """Q3: events with their page's category and generation, both decided by rule tables."""
    e = read_table(spark, sf, "events").filter(~col("user_id").isin(*EXCLUDED_USERS)).select(
        "event_id", "ts", "user_id", "event_type")
    p = read_table(spark, sf, "pages").select("page_id", "url")
    lookup = F.broadcast(spark.createDataFrame(list(PAGE_LOOKUP), "language string, label string"))  # fixed three rows
    piece = lambda sep, at: F.split_part(col("url"), F.lit(sep), F.lit(at))
    categories = {"folder": F.lower(piece("/", -2)), "file": F.lower(F.replace(piece(".", -2), F.lit("example"), F.lit(""))),
                  "section": piece("/", -3), "lookup": F.lower("label")}
    generations = {g: F.lit(g) for g, _, _ in GENERATION_RULES}
    visits = e.join(p, col("user_id") == col("page_id"), "left").join(lookup, piece("/", 4) == col("language"), "left")
    return visits.select(
        "event_id", "user_id", "event_type", "url", col("ts").cast("date").alias("activity_date"),
        fm.month_start("ts").alias("activity_month"), F.year("ts").alias("year_no"), F.month("ts").alias("month_no"),
        F.coalesce(_decide(CATEGORY_RULES, categories, CATEGORY_DEFAULT), F.lit(CATEGORY_DEFAULT)).alias("page_category"),
        _decide(GENERATION_RULES, generations, GENERATION_DEFAULT).alias("page_generation"))


# ---------------------------------------------------------------- single-operator queries


def m05_filters(spark, sf):
    return billed_lines(spark, sf, billed_orders(spark, sf)).select("order_id", "line_no", "cust_id", "month")


def m08_in_lists(spark, sf):
    return customer_base(spark, sf).filter(
        col("segment").isin("BUILDING", "MACHINERY") & ~col("nation").isin("NATION_0", "NATION_1")).select(
        "cust_id", "segment", "nation")


def m11_inner(spark, sf):
    orders = recent_orders(spark, sf).select("cust_id", "order_id", "order_date")
    return customer_base(spark, sf).select("cust_id", "channel").join(orders, "cust_id", "inner")


def m12_left_lookup(spark, sf):
    return customer_base(spark, sf, nation_desks(spark, sf)).select("cust_id", "first_supplier", "last_supplier")


def m13_conditional_left(spark, sf):
    seen = rel.conditional_left_join(customer_base(spark, sf), web_history(spark, sf), (col("cust_id") == col("h_cust_id"))
                                     & (col("region") == "ASIA"))
    return seen.select("cust_id", "region", "last_seen")


def m14_anti(spark, sf):
    return dormant(spark, sf).select("cust_id", "channel")


def m28_nested_case(spark, sf):
    return read_table(spark, sf, "customer").select("c_custkey", customer_group().alias("customer_group"))


def m16_theta(spark, sf):
    r = read_table(spark, sf, "region").select(col("r_regionkey"), col("r_name").alias("other_region"))
    j = rel.theta_left_join(customer_base(spark, sf).select("cust_id", "region_id"), r, col("region_id") != col("r_regionkey"))
    return j.select("cust_id", "other_region")


def m17_star(spark, sf):
    return buyers(spark, sf).filter(col("state") == "active").select(
        "cust_id", "order_id", "first_supplier", "last_priority", "last_seen", "nation")


def m19_group_sum(spark, sf):
    return trade_revenue(spark, sf)


def m22_latest_row(spark, sf):
    return last_priority(spark, sf)


def m23_latest_ties(spark, sf):
    return last_recent_orders(spark, sf).select("cust_id", "order_id", "order_date", "order_month")


def m24_union_branches(spark, sf):
    """The branches of Q1 as frames of their own, each with its own columns, conformed and appended."""
    gone = dormant(spark, sf)
    frames = [customer_base(spark, sf).filter(col("nation").isin(*MAIN_NATIONS)).join(last_recent_orders(spark, sf), "cust_id")
              .select("cust_id", "channel", "order_id", "order_month", F.lit("active").alias("state")),
              gone.filter(col("channel") == "Web").select("cust_id", "channel", "web_number", F.lit("dormant").alias("state")),
              gone.filter(col("channel") == "Trade").select("cust_id", "channel", "trade_number",
                                                            F.lit("dormant").alias("state"))]
    return rel.union_branches(frames, BUYER_SCHEMA).select(
        "cust_id", "channel", "state", "order_id", "order_month", "web_number", "trade_number", "start_date")


def _pages(spark, sf):
    return read_table(spark, sf, "pages").select("page_id", "url")


def m29_patterns(spark, sf):
    url = col("url")
    return _pages(spark, sf).select(
        "page_id",
        url.like("https://%/en/%").alias("is_https_en"),
        url.ilike("%BLOG.%").alias("is_blog"),
        url.like("%?%=%").alias("has_query"),
        url.contains(".html").alias("is_html"),
    )


def m32_split_part(spark, sf):
    url = col("url")
    host = F.split_part(url, F.lit("/"), F.lit(3))
    return _pages(spark, sf).select(
        "page_id",
        host.alias("host"),
        F.split_part(url, F.lit("/"), F.lit(4)).alias("lang"),
        F.split_part(url, F.lit("/"), F.lit(-1)).alias("last_piece"),
        F.initcap(F.split_part(host, F.lit("."), F.lit(-2))).alias("label"),
        F.replace(host, F.lit("example"), F.lit("ex")).alias("short_host"),
    )


def m35_numeric_filter(spark, sf):
    p = read_table(spark, sf, "part").select("p_partkey", "p_brand", "p_type")
    brand_no = F.split_part(col("p_brand"), F.lit("#"), F.lit(2))
    return p.filter(fm.is_numeric(brand_no) & ~fm.is_numeric(col("p_type"))).select("p_partkey", brand_no.alias("brand_no"))


def m36_months(spark, sf):
    e = read_table(spark, sf, "events").select("ts", "user_id", "event_type")
    return e.groupBy(fm.month_start("ts").alias("activity_year_month"), F.year("ts").alias("activity_year"),
                     F.month("ts").alias("activity_month"), "event_type").agg(
        F.count(F.lit(1)).alias("n_events"), F.countDistinct("user_id").alias("n_users"))


def m37_surrogate_key(spark, sf):
    return customer_base(spark, sf).select(
        "cust_id", fm.surrogate_key("channel", "cust_id", "nation_id", "web_number").alias("buyer_key"))


def m38_value_maps(spark, sf):
    maps = {"segment_label": ("segment", fm.SEGMENT_LABEL), "segment_group": ("segment", fm.SEGMENT_GROUP),
            "market": ("region", fm.MARKET), "market_group": ("region", fm.MARKET_GROUP)}
    return customer_base(spark, sf).select(
        "cust_id", *[fm.value_map(x, rules).alias(name) for name, (x, rules) in maps.items()])


def s04_materialized(spark, sf):
    """M22 as a table: stored twice in the shared folder and read back from its current version."""
    path = f"{ensure_checkpoint_dir(spark)}/materialized-{uuid.uuid4().hex}"
    materialize(m22_latest_row(spark, sf).limit(0), path)
    materialize(m22_latest_row(spark, sf), path)
    return read_materialized(spark, path)


def queries() -> dict:
    return {
        "s04_materialized": s04_materialized,
        "m05_filters": m05_filters, "m08_in_lists": m08_in_lists, "m11_inner": m11_inner,
        "m12_left_lookup": m12_left_lookup, "m13_conditional_left": m13_conditional_left, "m14_anti": m14_anti,
        "m16_theta": m16_theta, "m28_nested_case": m28_nested_case, "m17_star": m17_star, "m19_group_sum": m19_group_sum,
        "m22_latest_row": m22_latest_row, "m23_latest_ties": m23_latest_ties, "m24_union_branches": m24_union_branches,
        "m29_patterns": m29_patterns, "m32_split_part": m32_split_part, "m35_numeric_filter": m35_numeric_filter,
        "m36_months": m36_months, "m37_surrogate_key": m37_surrogate_key, "m38_value_maps": m38_value_maps,
        "q1_customer_dim": q1_customer_dim, "q2_monthly_revenue": q2_monthly_revenue, "q3_activity": q3_activity,
    }
