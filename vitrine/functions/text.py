"""Text expressions. All are built-in expressions, so they stay inside code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that count as white space, as a trim set and as a pattern of runs of them.
SPACES = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004"
    "\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
SPACE_RUN = r"(?U)[\s\x1c-\x1f]+"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES))


def extract(text: Column, pattern: str, group: int = 1) -> Column:
    """Group of the first match; null (not '') when nothing matches."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def collapse_spaces(text: Column) -> Column:
    return strip(F.regexp_replace(text, SPACE_RUN, " "))


def drop_prefix(text: Column, prefix: Column) -> Column:
    """Text without the (case-blind) prefix, stripped; unchanged when it does not start so."""
    rest = strip(F.substr(text, F.length(prefix) + 1))
    return F.when(F.startswith(F.lower(text), F.lower(prefix)), rest).otherwise(text)


def before_last(text: Column, mark: str) -> Column:
    """Everything before the last mark (a single character)."""
    return F.regexp_extract(text, f"(?s)^(.*){mark}", 1)


def after_last(text: Column, mark: str) -> Column:
    return F.substring_index(text, mark, -1)


def tokens(text: Column) -> Column:
    """Lower-case words, split on white space."""
    return F.filter(F.split(F.lower(text), SPACE_RUN), lambda word: word != "")
