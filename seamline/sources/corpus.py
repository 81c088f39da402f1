"""Corpus sources: documents as rows of text, and their lines.

``lines`` schema: ``doc_id (any type), line_no int (1-based), line string (no newline), eol boolean
(the line ended with a newline), n_lines int (lines in the document)``.

Line splitting follows text-mode ``readlines()``: ``\\r\\n`` and lone ``\\r`` become ``\\n``; each line
keeps its newline (here: ``eol``); a final newline does not start another line; an empty text has
no lines.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.features import NEIGHBOURS
from ..session import cut_lineage


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Model reference: a named table of the warehouse, read as parquet."""
    return spark.read.parquet(table_path(sf_dir, name))


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``documents`` table as ``(doc_id, text)``; only the two columns reach the scan."""
    return read_table(spark, sf_dir, "documents").select("doc_id", "text")


def read_text_files(spark: SparkSession, path: str) -> DataFrame:
    """Text files (one document per file) as ``(doc_id, path, text)``; ``doc_id`` is the path itself, which
    cannot collide."""
    file_path = F.col("_metadata.file_path")
    return spark.read.text(path, wholetext=True).select(file_path.alias("doc_id"), file_path.alias("path"),
                                                        F.col("value").alias("text"))


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """``lines`` of text files of any size: one document per file, each file read in the splits of the scan.

    A split counts its lines; the prefix of those counts over a file's splits numbers them. The counts, one row per split, are stored
    and joined back to the lines, which stay in their tasks while Spark finds that table small enough to broadcast. Lone carriage returns
    end a line too: only the splits that hold any are numbered by a window, whose groups are splits. The lines equal those of
    ``lines_from_text(read_text_files(...))``, but for a byte order mark, which is dropped here.
    """
    at = F.monotonically_increasing_id()  # rows of a split are consecutive
    value = F.regexp_replace("value", r"\r\z", "")  # the one before the newline
    raw = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("doc_id"), F.col("_metadata.file_block_start").alias("split"), F.col("_metadata.file_size").alias("bytes"),
        at.alias("at"), F.col("value").endswith("\r").alias("returned"), F.octet_length("value").alias("size"), F.split(value, "\r", -1).alias("parts"))
    counts = raw.groupBy("doc_id", "split", "bytes").agg(
        F.sum(F.size("parts")).alias("count"), F.max(F.size("parts")).alias("most"), F.min("at").alias("first"), F.max("at").alias("last"),
        F.sum(F.col("size") + F.lit(1)).alias("read"))
    file = Window.partitionBy("doc_id")
    so_far = file.orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    whole = F.col("bytes") - F.sum("read").over(file)  # 0 where the file ends with a newline, else -1; 3 more with a byte order mark
    splits = cut_lineage(counts.select(
        "doc_id", "split", "first", (F.col("most") > 1).alias("returns"), F.coalesce(F.sum("count").over(so_far), F.lit(0)).alias("before"),
        F.sum("count").over(file).alias("n_lines"),
        F.when((F.col("split") == F.max("split").over(file)) & ~whole.isin(0, 3), F.col("last")).alias("open")))
    placed = raw.join(splits, ["doc_id", "split"])
    row = F.col("at") - F.col("first")
    found = placed.filter(~F.col("returns")).withColumn("above", F.col("before") + row)
    if not splits.filter("returns").isEmpty():
        in_split = Window.partitionBy("doc_id", "split").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
        above = F.col("before") + F.coalesce(F.sum(F.size("parts")).over(in_split), F.lit(0))
        found = found.unionByName(placed.filter("returns").withColumn("above", above))
    ends = ~(F.col("at").eqNullSafe(F.col("open"))) | F.col("returned")
    each = found.select("doc_id", "above", "n_lines", ends.alias("ends"), F.size("parts").alias("count"), F.posexplode("parts").alias("pos", "line"))
    return each.select("doc_id", (F.col("above") + F.col("pos") + 1).cast("int").alias("line_no"), "line",
                       ((F.col("pos") + 1 < F.col("count")) | F.col("ends")).alias("eol"), F.col("n_lines").cast("int").alias("n_lines"))


def lines_from_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    neighbours: Sequence[str] = ()) -> DataFrame:
    """Split document texts into ``lines`` (narrow: no shuffle). ``doc_id`` keeps its type.

    ``neighbours`` names values of nearby lines (``features.NEIGHBOURS``) to put beside each line; they
    are read from the split text, where the neighbours still are at hand.
    """
    t = F.regexp_replace(F.col(text_col), "\r\n?", "\n")
    staged = docs.select(F.col(id_col).alias("doc_id"), t.alias("_t"))
    body = F.when(F.col("_t").endswith("\n"), F.expr("substr(_t, 1, length(_t) - 1)")).otherwise(F.col("_t"))
    parts = F.when(F.col("_t") == "", F.array().cast("array<string>")).otherwise(F.split(body, "\n", -1))
    staged = staged.select(
        "doc_id",
        F.col("_t").endswith("\n").alias("_final_nl"),
        parts.alias("_parts"),
    ).select("doc_id", "_final_nl", "_parts", F.size("_parts").alias("n_lines"))

    # every line's values first, once each, and then those of the lines near it
    values = {f"_near{k}": v for k, v in enumerate(dict.fromkeys(NEIGHBOURS[n][1] for n in neighbours))}
    column = {v: name for name, v in values.items()}

    def at_line(value) -> Column:
        return F.transform("_parts", lambda line, i: value(line, (i + 1 < F.col("n_lines")) | F.col("_final_nl")))

    def with_near(line: Column, i: Column) -> Column:
        return F.struct(line.alias("line"), *[F.get(column[NEIGHBOURS[n][1]], i + NEIGHBOURS[n][0]).alias(n) for n in neighbours])

    if neighbours:
        staged = staged.select("*", *[at_line(v).alias(name) for name, v in values.items()])
    items = F.transform("_parts", with_near) if neighbours else F.col("_parts")
    # posexplode_outer + a null filter: a plain posexplode makes Spark infer a "size > 0" filter that
    # repeats the whole split below the scan
    exploded = (staged.select("doc_id", "_final_nl", "n_lines", F.posexplode_outer(items).alias("_pos", "_item"))
                .filter(F.col("_pos").isNotNull()))
    return exploded.select(
        "doc_id",
        (F.col("_pos") + 1).cast("int").alias("line_no"),
        F.col("_item.line" if neighbours else "_item").alias("line"),
        ((F.col("_pos") + 1 < F.col("n_lines")) | F.col("_final_nl")).alias("eol"),
        F.col("n_lines").cast("int").alias("n_lines"),
        *[F.col(f"_item.{n}").alias(n) for n in neighbours],
    )


def long_text_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", piece_bytes: int = 1 << 20) -> DataFrame:
    """``lines`` of texts of any length, each cut into pieces of ``piece_bytes`` that are split in tasks of their own.

    No row holds more than a piece, or a line. Pieces are byte ranges, read as one character a byte (so a cut character is whole
    again when its line is put together); ``\\r\\n`` across a cut is one newline. A piece owns the newlines in it: their prefix
    over the pieces of a text, one row a piece, numbers the lines. Only the first and last parts of the pieces meet other
    parts, by line. The lines equal those of ``lines_from_text``; ``doc_id`` has to name one text and must not be null.
    """
    raw = docs.select(F.col(id_col).alias("doc_id"), F.encode(F.col(text_col), "UTF-8").alias("bytes"))
    count = F.ceil(F.octet_length("bytes") / F.lit(piece_bytes)).cast("int")
    cuts = raw.filter(count > 0).select("doc_id", "bytes", F.explode(F.sequence(F.lit(0), count - 1)).alias("piece"))
    start = F.col("piece") * F.lit(piece_bytes) + 1
    cuts = cuts.select("doc_id", "piece", F.substring("bytes", start, F.lit(piece_bytes)).alias("bytes"),
                       (F.substring("bytes", F.greatest(start - 1, F.lit(1)), F.lit(1)) == F.lit(b"\r")).alias("_returned"))
    # a long text is many tasks from here on; with a number of partitions, which AQE does not merge
    cuts = cuts.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "doc_id", "piece")
    body = F.decode("bytes", "ISO-8859-1")
    body = F.when((F.col("piece") > 0) & F.col("_returned"), F.regexp_replace(body, r"\A\n", "")).otherwise(body)
    parts = cuts.select("doc_id", "piece", F.split(F.regexp_replace(body, "\r\n?", "\n"), "\n", -1).alias("parts"))

    text = Window.partitionBy("doc_id").orderBy("piece")
    newlines, whole = F.size("parts") - 1, text.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    counts = parts.select("doc_id", "piece", newlines.cast("long").alias("newlines"), (F.element_at("parts", -1) == "").alias("ended"))
    # the last piece may hold nothing but the second half of a newline
    blank = F.max(F.when((F.col("newlines") > 0) | ~F.col("ended"), F.struct("piece", "ended"))).over(whole)
    placed = cut_lineage(counts.select(
        "doc_id", "piece", F.coalesce(F.sum("newlines").over(text.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("above"),
        F.sum("newlines").over(whole).alias("newlines"), blank["ended"].alias("ended")))
    n_lines = F.col("newlines") + F.when(F.col("ended"), 0).otherwise(1)
    each = parts.join(placed, ["doc_id", "piece"]).select(
        "doc_id", "piece", "above", "newlines", n_lines.alias("n_lines"), F.size("parts").alias("size"), F.posexplode_outer("parts").alias("pos", "part"))
    each = each.withColumn("line_no", F.col("above") + F.col("pos") + 1).filter(F.col("line_no") <= F.col("n_lines"))
    inner = (F.col("pos") > 0) & (F.col("pos") + 1 < F.col("size"))
    edges = each.filter(~inner).groupBy("doc_id", "n_lines", "newlines", "line_no").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("piece", "pos", "part"))), lambda p: p["part"]), "").alias("part"))
    columns = ["doc_id", "line_no", "part", "newlines", "n_lines"]
    return each.filter(inner).select(*columns).unionByName(edges.select(*columns)).select(
        "doc_id", F.col("line_no").cast("int").alias("line_no"), F.decode(F.encode("part", "ISO-8859-1"), "UTF-8").alias("line"),
        (F.col("line_no") <= F.col("newlines")).alias("eol"), F.col("n_lines").cast("int").alias("n_lines"))


def document_lines(spark: SparkSession, sf_dir: str, neighbours: Sequence[str] = ()) -> DataFrame:
    """Lines of ``documents``."""
    return lines_from_text(read_documents(spark, sf_dir), neighbours=neighbours)


# The derived SQL corpus template (one document per customer, 35 lines).
# Each row: line number, base text, modulus k, remainder r, variant text. A customer's line is the
# variant when c_custkey % k = r, else the base. k = 1, r = -1 means "never".
SQL_TEMPLATE = [
    (1, "with", 19, 5, ""),
    (2, "", 5, 0, "-- no buffer"),
    (3, "account as (", 7, 1, " account as ("),
    (4, "", 1, -1, ""),
    (5, "    select * from {{ ref('accounts') }}", 6, 2, "     select * from {{ ref( 'accounts') }}"),
    (6, "", 1, -1, ""),
    (7, "),", 9, 3, "   ),"),
    (8, "", 17, 3, "-- note"),
    (9, "orders_latest as (", 16, 2, ""),
    (10, "", 1, -1, ""),
    (11, "    select", 18, 4, ""),
    (12, "        account_id,", 8, 4, "        ,account_id"),
    (13, "        region,", 10, 5, "        sum(amount) as total,"),
    (14, "        order_month,", 11, 10, "        " + "x" * 110 + ","),
    (15, "        case", 12, 6, "        case when x = 1"),
    (16, "            when status = 'open' then 'o'", 5, 1, "          when status = 'open' then 'o'"),
    (17, "            else 'x'", 1, -1, ""),
    (18, "        end as state_code", 7, 2, "          end as state_code"),
    (19, "    from {{ ref('account') }}", 3, 0, "    from account"),
    (20, "    inner join payments", 4, 3, "      join payments"),
    (21, "        on account.id = payments.id", 6, 1, "       using (id )"),
    (22, "            and payments.kind = 1", 8, 6, "        and payments.kind = 1"),
    (23, "    where region in ('NA','EU')", 9, 1,
     "    where region in ('NORTH AMERICA','LATIN AMERICA','EUROPE','MIDDLE EAST','ASIA PACIFIC')"),
    (24, "        and state_code != 'x'", 5, 4, "        and state_code <> 'x'"),
    (25, "", 1, -1, ""),
    (26, "),", 13, 5, ")),"),
    (27, "", 1, -1, ""),
    (28, "final as (", 10, 9, "finAl as ("),
    (29, "", 1, -1, ""),
    (30, "    select *", 14, 0, "    select case"),
    (31, "    from orders_latest", 15, 1, ""),
    (32, "", 20, 6, "      on x.id = y.id"),
    (33, ")", 1, -1, ""),
    (34, "", 1, -1, ""),
    (35, "select * from final", 1, -1, ""),
]


def _template_line(key: Column, base: str, k: int, r: int, variant: str) -> Column:
    if r < 0:
        return F.lit(base)
    return F.when(key % F.lit(k) == F.lit(r), F.lit(variant)).otherwise(F.lit(base))


def sql_documents(customer: DataFrame) -> DataFrame:
    """The derived SQL corpus as ``(doc_id, text)``: one model text per customer (narrow)."""
    key = F.col("c_custkey")
    lines = [_template_line(key, base, k, r, var) for (_, base, k, r, var) in SQL_TEMPLATE]
    return customer.select(key.alias("doc_id"), F.concat_ws("\n", *lines).alias("text"))


# A model around the text of a document, which stands in it as a literal. Rows as in SQL_TEMPLATE.
QUOTED_HEAD = [
    (1, "with", 1, -1, ""),
    (2, "", 1, -1, ""),
    (3, "notes as (", 1, -1, ""),
    (4, "    select", 1, -1, ""),
    (5, "        account_id, -- the customer's join", 4, 1, "        account_id,"),
    (6, "        'a join of", 1, -1, ""),
]
QUOTED_TAIL = [
    (1, "        join using (' as note,", 1, -1, ""),
    (2, "        'it''s a join' as kind -- 'join", 3, 1, "        'join' as kind"),
    (3, "    from accounts", 1, -1, ""),
    (4, "    join payments", 3, 0, "    left join payments -- join"),
    (5, "        using (id)", 5, 2, "        on accounts.id = payments.id"),
    (6, "    where kind = 'join'", 5, 1, "    where kind = 'a join"),
    (7, ")", 1, -1, ""),
    (8, "", 1, -1, ""),
    (9, "select * from notes join 'inner' using (id)", 2, 1, "select * from notes -- join"),
]


def quoted_documents(documents: DataFrame) -> DataFrame:
    """One model per document, ``(doc_id, text)``: the whole text (null: empty) inside a literal of many lines (narrow)."""
    key = F.col("doc_id")
    head, tail = ([_template_line(key, base, k, r, var) for (_, base, k, r, var) in rows] for rows in (QUOTED_HEAD, QUOTED_TAIL))
    return documents.select(key, F.concat_ws("\n", *head, F.coalesce("text", F.lit("")), *tail).alias("text"))


def given_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All texts of the warehouse as ``(doc_id, text)``: documents, turns of conversations, pages, and the models around
    the documents. ``doc_id`` names the table and the row."""

    def named(df: DataFrame, table: str, text: str, *ids: str) -> DataFrame:
        return df.select(F.concat_ws("/", F.lit(table), *ids).alias("doc_id"), F.col(text).alias("text"))

    docs = read_documents(spark, sf_dir)
    return (named(docs, "documents", "text", "doc_id")
            .unionByName(named(quoted_documents(docs), "models", "text", "doc_id"))
            .unionByName(named(read_table(spark, sf_dir, "conversations"), "conversations", "text", "conv_id", "turn"))
            .unionByName(named(read_table(spark, sf_dir, "pages"), "pages", "html", "page_id")))


# Keys that one split may stand for before an exchange of them pays: each is a text of 35 lines.
MOST_KEYS = 10_000


def sql_lines(spark: SparkSession, sf_dir: str, neighbours: Sequence[str] = (), spread: bool = True) -> DataFrame:
    """Lines of the SQL corpus. The keys, not the texts made from them, are exchanged first: a table of
    keys is few splits for the work that they stand for. Without ``spread`` only where there are more than ``MOST_KEYS``."""
    keys = read_table(spark, sf_dir, "customer").select("c_custkey")
    if spread or keys.count() > MOST_KEYS:  # with a number of partitions, since AQE would merge partitions by the size of the keys
        keys = keys.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "c_custkey")
    return lines_from_text(sql_documents(keys), neighbours=neighbours)


def sql_template_values_sql() -> str:
    """The template as a SQL ``VALUES`` list (for oracle queries)."""

    def q(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    rows = ", ".join(f"({n}, {q(b)}, {k}, {r}, {q(v)})" for (n, b, k, r, v) in SQL_TEMPLATE)
    return f"(VALUES {rows}) AS tpl(line_no, base, k, r, variant)"


def quoted_models_sql() -> str:
    """``quoted_documents`` as a SQL select (for oracle queries)."""

    def q(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    def line(row) -> str:
        _, base, k, r, variant = row
        return q(base) if r < 0 else f"CASE WHEN doc_id % {k} = {r} THEN {q(variant)} ELSE {q(base)} END"

    parts = [line(row) for row in QUOTED_HEAD] + ["coalesce(text, '')"] + [line(row) for row in QUOTED_TAIL]
    return f"SELECT doc_id, concat_ws(chr(10), {', '.join(parts)}) AS text FROM documents"
