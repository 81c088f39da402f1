"""Column functions for line text, matching the string semantics the style rules are written in.

A line here is one line of a document without its newline; ``eol`` says whether the newline was
there. Tests that looked for a newline inside the line (``"select\\n"``) become ``endswith`` plus
``eol``. Every regular expression uses only constructs that Java regex and RE2 agree on.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that Python's str.strip()/lstrip() remove (str.isspace() is true),
# written as a character-class body valid for both Java regex and RE2.
PY_WHITESPACE = (
    r"\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
WS = f"[{PY_WHITESPACE}]"
# The same characters listed one by one, for trim(): no regex per character.
PY_WHITESPACE_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B))
                       + "\u2028\u2029\u202f\u205f\u3000")

# Classes that mark the start of the text of a line.
LETTER = "[A-Za-z]"
NAME_START = "[\"'{A-Za-z]"


def c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip(x) -> Column:
    """Python ``str.strip()``."""
    return F.trim(c(x), F.lit(PY_WHITESPACE_CHARS))


def lstrip(x) -> Column:
    """Python ``str.lstrip()``."""
    return F.ltrim(c(x), F.lit(PY_WHITESPACE_CHARS))


def is_blank(x) -> Column:
    """``line.strip() == ''`` (what is left after the leading whitespace says so too)."""
    return lstrip(x) == ""


def first_pos(x, cls: str = LETTER) -> Column:
    """0-based column of the first character of class ``cls``; null when there is none."""
    p = F.regexp_instr(c(x), F.lit(cls))
    return F.when(p > 0, p - 1)


def indent(x) -> Column:
    """Column of the first ASCII letter (the rules' notion of indentation)."""
    return first_pos(x, LETTER)


def name_indent(x) -> Column:
    """Column of the first quote, brace or ASCII letter."""
    return first_pos(x, NAME_START)


def has(x, token: str) -> Column:
    """Case-sensitive substring test (Python ``in``)."""
    return c(x).contains(token)


def has_any(x, *tokens: str) -> Column:
    out = None
    for t in tokens:
        t_col = has(x, t)
        out = t_col if out is None else (out | t_col)
    return out


def count_of(x, ch: str) -> Column:
    """Occurrences of a single character."""
    return F.length(c(x)) - F.length(F.replace(c(x), F.lit(ch), F.lit("")))
