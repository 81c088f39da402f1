"""Code without its literals and comments: rules then ignore what stands between quotes or after ``--``.

A literal opens at a quote outside a comment and runs to the next quote, over any number of lines; a comment runs to the end of its
line. Both are blanked character by character, so every other column of a line stays where it is.

* ``code_text`` blanks whole texts (narrow: no shuffle).
* ``code_lines`` blanks a lines table of documents of any length. What a line does to the state "inside a literal" is one of four
  functions: keep it, swap it, or set it to either value. The state before a line is the value of the nearest setting line above, swapped
  once for every swapping line since. Both are running values of one scan, so they cross lines and chunks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scan import Prefix, last_where, scan

# A literal (closed or not), a comment, and what lies between them.
PIECES = r"'[^']*'?|--[^\n]*|-|[^'-]+"
CLOSED = r"'[^']*'|--[^\n]*"


def _blanked(text: Column) -> Column:
    hidden = lambda p: p.startswith("'") | p.startswith("--")
    pieces = F.regexp_extract_all(text, F.lit(PIECES), 0)
    return F.array_join(F.transform(pieces, lambda p: F.when(hidden(p), F.regexp_replace(p, r"[^\n]", " ")).otherwise(p)), "")


def code_text(text: Column) -> Column:
    """The text with literals and comments blanked and every line ending as one newline; null stays null."""
    return _blanked(F.regexp_replace(text, "\r\n?", "\n"))


def _ends_inside(line: Column) -> Column:
    return F.regexp_replace(line, CLOSED, "").contains("'")


def code_lines(lines: DataFrame) -> DataFrame:
    """``lines`` with literals and comments blanked in ``line``; the other columns of a lines table as they are.

    One exchange of the lines. The carry reads the source a second time, without the texts, and only for documents
    longer than a chunk.
    """
    # outside before the line; inside before it
    flags = lines.select("doc_id", "line_no", "line", "eol", "n_lines", _ends_inside(F.col("line")).alias("_out"),
                         _ends_inside(F.concat(F.lit("'"), F.col("line"))).alias("_in"))
    swaps, sets = F.col("_out") & ~F.col("_in"), F.col("_out") == F.col("_in")
    placed = scan(flags, {"_swaps": Prefix(swaps.cast("int"), "sum", False)}, later=[
        {"_set": last_where(sets, F.col("_out").alias("inside"), F.col("_swaps").alias("n"), inclusive=False,
                            counts=(("n", "_swaps"),))}])
    odd = (F.col("_swaps") - F.coalesce("_set.n", F.lit(0))) % 2 == 1
    inside = F.coalesce("_set.inside", F.lit(False)) != odd
    blanked = F.when(inside, F.substring(_blanked(F.concat(F.lit("'"), F.col("line"))), 2, 2**31 - 1)).otherwise(_blanked(F.col("line")))
    return placed.select("doc_id", "line_no", blanked.alias("line"), "eol", "n_lines")
