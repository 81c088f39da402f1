"""Secret scan with corpus-wide ownership frequency.

Candidates are found in every whole text: ``assign``, ``access`` and ``hex`` (the base kinds) and
``generic``, runs of ``GENERIC_CHARS`` or more credential characters. The hash of each candidate's
value is counted over the corpus by distinct owner and by distinct repository. A value that
``EXAMPLE_OWNERS`` or more owners hold, or ``EXAMPLE_REPOS`` or more repositories of any number of owners,
is a widely copied example; another one that a single owner holds and that looks random (``LIVE_CHARS``
or more different characters, a digit among them) is a live credential; the rest are unclear, such as a
value of two owners or of letters only. Base spans always stay; a generic span is reported only where its
value is live and no base span covers it.

``redact_live`` replaces live values wherever they stand in a row's text, and unclear values of base spans in
their spans: a password that two owners hold or that has letters only goes, a widely copied example stays,
also one that is a leaked credential mirrored by ``EXAMPLE_OWNERS`` owners.

Null text counts as empty; each row with a null owner has an owner of its own; where no repository column is
given, every row is a repository of its owner. Rows with the same ``doc_id`` are scanned one by one. An empty
table gives no rows; other columns are ignored. DataFrame functions only: positions come
from the lengths of the pieces between matches, which split() gives in one pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, documents, numbered, row_id, text_of

# The patterns of the base kinds, in their order, and the least lengths.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"(AKIA[A-Z0-9]+)"
HEX = r"((?<![0-9a-f])[0-9a-f]{16,})"
KINDS = ("assign", "access", "hex", "generic")
LEAST = (12, 18, 16, 20)

GENERIC_CHARS = 20
GENERIC = r"((?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,})" % GENERIC_CHARS
EXAMPLE_OWNERS = 3
EXAMPLE_REPOS = 10
LIVE_CHARS = 8
REDACTED = "<secret>"

# a text without these holds no match of that kind
HINTS = (r"(?i)passw|secret|token|api_?key", "AKIA", r"[0-9a-f]{16}", r"[A-Za-z0-9+/_-]{%d}" % GENERIC_CHARS)


def _found(kind: int, pattern: str) -> Column:
    """Every match of a kind, failing ones too: (kind, i, gap before it, length, value)."""
    text, rx = F.col("text"), F.lit(pattern)
    zipped = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, rx, F.lit(0)).alias("m"),
                          F.regexp_extract_all(text, rx, F.lit(1)).alias("v"))
    rows = F.transform(zipped, lambda x, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("i"), F.length(x["gap"]).alias("gap"),
        F.length(x["m"]).alias("length"), x["v"].alias("value")))
    rows = F.filter(rows, lambda x: x["value"].isNotNull())  # the piece after the last match has none
    return F.when(text.rlike(HINTS[kind]), rows).otherwise(F.array().cast(
        "array<struct<kind:int,i:int,gap:int,length:int,value:string>>"))


def _looks_live(value: str) -> Column:
    return (F.size(F.array_distinct(F.split(F.col(value), ""))) >= LIVE_CHARS) & F.col(value).rlike("[0-9]")


def candidate_spans(docs: DataFrame, scratch: Scratch, owner: str, repo: str | None) -> tuple[DataFrame, DataFrame]:
    """Rows of ``docs`` (uid, doc_id) and the spans found in them (uid, owner, repo, kind, start, end, value)."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"),
        F.col(owner).cast("string").alias("owner"), row_id(docs).alias("uid"),
        (F.col(repo).cast("string") if repo else F.lit(None).cast("string")).alias("repo"))
    frame = scratch.keep(
        rows.select("uid", "doc_id", F.coalesce("owner", F.concat(F.lit("\0"), F.col("uid").cast("string"))).alias("owner"),
                    F.coalesce("repo", F.col("uid").cast("string")).alias("repo"),
                    F.concat(*[_found(k, p) for k, p in enumerate((ASSIGN, ACCESS, HEX, GENERIC))]).alias("found")), "found")
    each = frame.filter(F.size("found") > 0).select("uid", "owner", "repo", F.explode("found").alias("f")).select(
        "uid", "owner", "repo", "f.*").repartition("uid")
    so_far = Window.partitionBy("uid", "kind").orderBy("i")
    placed = each.withColumn("end", F.sum(F.col("gap") + F.col("length")).over(so_far)).select(
        "uid", "owner", "repo", "kind", (F.col("end") - F.col("length")).alias("start"), "end", "value")
    least = F.element_at(F.array(*map(F.lit, LEAST)), F.col("kind") + 1)
    covered = F.max(F.when(F.col("kind") < 3, F.col("end"))).over(
        Window.partitionBy("uid").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    spans = (placed.filter(F.length("value") >= least).withColumn("covered", F.coalesce(covered, F.lit(0)))
             .filter((F.col("kind") < 3) | ((F.col("covered") < F.col("end")) & _looks_live("value")))
             .withColumn("hash", F.sha2("value", 256)).drop("covered"))
    return frame.select("uid", "doc_id"), scratch.keep(spans, "spans")


def ownership(spans: DataFrame) -> DataFrame:
    """Per candidate hash: distinct owners, distinct repositories and occurrences over the corpus."""
    by_repo = spans.groupBy("hash", "owner", "repo").agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("value"))
    by_owner = by_repo.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("repos"), F.sum("n").alias("n"), F.max("value").alias("value"))
    total = by_owner.groupBy("hash").agg(F.count(F.lit(1)).alias("n_owners"), F.sum("repos").alias("n_repos"),
                                         F.sum("n").alias("n_found"), F.max("value").alias("value"))
    use = (F.when((F.col("n_owners") >= EXAMPLE_OWNERS) | (F.col("n_repos") >= EXAMPLE_REPOS), "example")
           .when((F.col("n_owners") == 1) & _looks_live("value"), "live").otherwise("unclear"))
    return total.select("hash", "n_owners", "n_repos", "n_found", use.alias("use"))


def classed_spans(docs: DataFrame, scratch: Scratch, owner: str = "source", repo: str | None = None) -> tuple[DataFrame, DataFrame]:
    rows, spans = candidate_spans(docs, scratch, owner, repo)
    uses = scratch.keep(ownership(spans), "uses")
    joined = spans.join(uses, "hash").filter((F.col("kind") < 3) | (F.col("use") == "live"))
    return rows, joined


def scan_secrets(docs: DataFrame, owner: str = "source", repo: str | None = None) -> DataFrame:
    """One row per row of ``docs``: base counts and digest, all spans, how many are live or examples, and the repositories of each."""
    rows, spans = classed_spans(docs, Scratch(docs.sparkSession, "secrets"), owner, repo)
    per_doc = spans.groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end", "use", "n_repos"))).alias("found"))
    name = lambda x: F.element_at(F.array(*map(F.lit, KINDS)), x["kind"] + 1)
    joined = lambda xs: F.concat_ws(",", F.transform(xs, lambda x: F.concat_ws(":", name(x), x["start"].cast("string"), x["end"].cast("string"))))
    count = lambda test: F.size(F.filter("found", test)).cast("long")
    of_kind = lambda k: count(lambda x: x["kind"] == k)
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint,use:string,n_repos:bigint>>")
    return rows.join(per_doc, "uid", "left").withColumn("found", F.coalesce("found", none)).select(
        "doc_id",
        *[of_kind(k).alias(f"n_{KINDS[k]}") for k in range(3)],
        F.sha2(joined(F.filter("found", lambda x: x["kind"] < 3)), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"),
        count(lambda x: x["use"] == "live").alias("n_live"), count(lambda x: x["use"] == "example").alias("n_example"),
        F.concat_ws(",", F.transform("found", lambda x: x["n_repos"].cast("string"))).alias("n_repos"))


def _without(text: Column, cuts: Column) -> Column:
    """``text`` with ``REDACTED`` in place of each (start, end) of the sorted ``cuts``, overlapping ones as one."""
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("out"))
    piece = lambda at, to: text.substr((at + 1).cast("int"), (to - at).cast("int"))
    step = lambda done, x: F.when(x["end"] <= done["at"], done).otherwise(F.struct(
        x["end"].alias("at"),
        F.when(x["start"] < done["at"], done["out"]).otherwise(
            F.concat(done["out"], F.array(piece(done["at"], x["start"]), F.lit(REDACTED)))).alias("out")))
    return F.aggregate(cuts, start, step, lambda done: F.concat(F.array_join(done["out"], ""), piece(done["at"], F.length(text))))


def redact_live(docs: DataFrame, owner: str = "source", repo: str | None = None) -> DataFrame:
    """``docs`` without live values and base findings, but for widely copied examples; other texts and all columns stay.

    Null and empty texts stay as they are, repeated rows are redacted alike, and an empty table gives no rows.
    """
    _, spans = classed_spans(docs, Scratch(docs.sparkSession, "redact"), owner, repo)
    hidden = spans.filter("use <> 'example'").groupBy("uid").agg(
        F.sort_array(F.collect_list(F.struct((F.col("end") - F.length("value")).alias("start"), "end"))).alias("cuts"),
        F.concat_ws("|", F.reverse(F.sort_array(F.collect_set(F.when(F.col("use") == "live", F.concat(
            F.format_string("%09d", F.length("value")), F.lit("\\Q"), "value", F.lit("\\E"))))))).alias("live"))
    longest_first = F.regexp_replace("live", r"(^|\|)[0-9]{9}\\Q", r"$1\\Q")
    named, names = numbered(docs)
    marked = named.withColumn("uid", row_id(docs)).join(hidden, "uid", "left")
    was = F.col(names[docs.columns.index("text")])
    cut = _without(was, F.col("cuts"))
    text = F.when(F.col("cuts").isNull(), was).when(F.col("live") == "", cut).otherwise(
        F.regexp_replace(cut, longest_first, F.lit(REDACTED)))
    return marked.select(*[(text if n == "text" else F.col(c)).alias(n) for n, c in zip(docs.columns, names)])


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(documents(spark, sf_dir))
