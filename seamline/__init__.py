"""seamline: style rules for corpora of SQL-like text and customer-model transforms, on Spark DataFrames.

Typical use::

    from seamline import lines_from_text, read_text_files, lint, report, write_findings
    lines = lines_from_text(read_text_files(spark, "/data/models/*.sql"))
    write_findings(report(lint(lines)), "/data/lint/findings")
"""

from .operators.lint import lint, report, rule_catalog, run_rules
from .sources.corpus import lines_from_text, read_documents, read_table, read_text_files
from .sources.sinks import materialize, write_findings

__version__ = "0.1.0"

__all__ = [
    "lint", "run_rules", "report", "rule_catalog",
    "lines_from_text", "read_documents", "read_table", "read_text_files",
    "materialize", "write_findings",
]
