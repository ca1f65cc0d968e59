"""Text expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from lotwise.functions.vocabulary import NA_TOKENS, PLACEHOLDERS


# every character that counts as white space in Unicode text
WHITE_SPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


def strip(c: Column) -> Column:
    """Drop white space of any kind on both ends (plain SQL trim takes spaces only)."""
    return F.trim(c, F.lit(WHITE_SPACE))


def strip_lower(c: Column) -> Column:
    return F.lower(strip(c.cast("string")))


def na_to_null(c: Column) -> Column:
    return F.when(~c.isin(NA_TOKENS), c)


def placeholder_to_null(c: Column) -> Column:
    return F.when(~c.isin(PLACEHOLDERS), c)


def clean_category(c: Column, fill: str | None = "unknown") -> Column:
    """Strip, lower, placeholders to NULL; NULL to ``fill`` unless it is None."""
    out = placeholder_to_null(strip_lower(c))
    return out if fill is None else F.coalesce(out, F.lit(fill))


def clean_name(name: str) -> str:
    """Column-name form: stripped, lower case, space and '-' as '_', no round brackets."""
    return re.sub(r"[()]", "", re.sub(r"[ -]", "_", name.strip().lower()))


def money(c: Column) -> Column:
    """``KES 1,234``; ``N/A`` for NULL. Half-even, as the usual ``,.0f`` format."""
    return F.coalesce(F.concat(F.lit("KES "), F.format_number(F.bround(c, 0), 0)), F.lit("N/A"))


def parse_money(c: Column) -> Column:
    return F.regexp_replace(c, r"KES |,", "").try_cast("double")
