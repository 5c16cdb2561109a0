"""Text clean-up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tarmac.schemas import NULL_TOKENS

_WHITESPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"


def normal_code(code: Column) -> Column:
    return F.upper(F.trim(code))


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def missing_to_null(text: Column) -> Column:
    """NULL for the texts a delimited file uses for a missing value."""
    return F.when(~text.isin(NULL_TOKENS), text)


def strip_all(text: Column) -> Column:
    """Strip every kind of white space, where ``trim`` strips blanks only."""
    return F.btrim(text, F.lit(_WHITESPACE))
