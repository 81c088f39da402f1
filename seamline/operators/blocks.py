"""Select blocks (L15): the lines after a ``select`` line up to the first later ``' from '`` line."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .features import line_events, with_features


def select_blocks(lines: DataFrame) -> DataFrame:
    """``doc_id, select_line, first_line, last_line`` per ``select`` line. A block without a later
    ``' from '`` runs to the last line of the document. Blocks may overlap."""
    needs = ["fromsp_after", "t_select_eol"]
    feat = with_features(cut_lineage(line_events(lines, needs)), needs)
    return feat.filter(F.col("t_select_eol")).select(
        "doc_id",
        F.col("line_no").alias("select_line"),
        (F.col("line_no") + 1).alias("first_line"),
        F.coalesce(F.col("fromsp_after.no") - 1, F.col("n_lines")).alias("last_line"),
    )
