"""Text helpers that agree with the ML tokenizer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


WHITESPACE = " \t\n\x0b\f\r"  # what the pattern \s matches


def tokens(text: str | Column) -> Column:
    """Lower-cased words split at each whitespace character, without empty words at the end."""
    column = F.col(text) if isinstance(text, str) else text
    return F.split(F.rtrim(F.lower(column), F.lit(WHITESPACE)), r"\s")
