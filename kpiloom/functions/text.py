"""String cleaning: all Unicode white space counts, not only the space character."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The tokens a delimited scan reads as NULL.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


# Every character that counts as white space when a value is stripped.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(value: Column) -> Column:
    return F.btrim(value, F.lit(WHITE_SPACE))


def clean_string(value: Column) -> Column:
    """Strip, and turn what is empty after stripping into NULL."""
    return F.nullif(strip(value), F.lit(""))


def na_to_null(value: Column, tokens: Sequence[str] = NA_TOKENS) -> Column:
    return F.when(~value.isin(*tokens), value)


def first_token(text: Column, tokens: Sequence[str], default: str) -> Column:
    """The first token, in list order, that occurs in ``text``."""
    found = F.lit(default)
    for token in reversed(tokens):
        found = F.when(F.contains(text, F.lit(token)), F.lit(token)).otherwise(found)
    return found
