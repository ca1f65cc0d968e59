"""Currency standardisation and the target."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from lotwise.functions.text import strip_lower
from lotwise.functions.vocabulary import RATES


def currency(code: Column, missing: str = "ksh") -> Column:
    """Stripped lower-case code; a missing one is read as ``missing``."""
    return F.coalesce(strip_lower(code), F.lit(missing))


def to_base_currency(price: Column, code: Column, rates: dict[str, tuple[float, float, float]] | None = None) -> Column:
    """``(intercept + slope * price) * rate`` for the codes of the table; other prices pass unchanged."""
    out = None
    for name, (intercept, slope, rate) in (RATES if rates is None else rates).items():
        value = (F.lit(intercept) + F.lit(slope) * price) * F.lit(rate)
        out = F.when(code == name, value) if out is None else out.when(code == name, value)
    return price if out is None else out.otherwise(price)


def segment(value: Column, bounds: list[float], labels: list[str]) -> Column:
    """Quantile segment: right-closed bins between ascending inner bounds."""
    out = None
    for bound, label in zip(bounds, labels):
        out = F.when(value <= bound, label) if out is None else out.when(value <= bound, label)
    return F.when(value.isNotNull(), out.otherwise(labels[-1]))
