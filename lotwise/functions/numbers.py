"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# the cast reads '12d', '0x1p3', 'inf' and 'NaN' as numbers; a number has no letter but the exponent's
NOT_A_NUMBER = r"[a-df-zA-DF-Z]"
EPS = 1e-6
HASH_SEED = 42


def finite(c: Column) -> Column:
    """NaN and the infinities become NULL."""
    return F.when(~F.isnan(c) & (F.abs(c) < float("inf")), c)


def to_number(c: Column, dtype: str = "string") -> Column:
    """Number or NULL. ``dtype`` is the column's type as ``df.dtypes`` names it."""
    if dtype in ("double", "float"):
        return finite(c.cast("double"))
    if dtype != "string":
        return c.cast("double")
    return finite(F.when(~c.rlike(NOT_A_NUMBER), c).try_cast("double"))


def zero_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(0.0))


def ratio(num: Column, den: Column, eps: float = EPS) -> Column:
    """Quotient with a guard against division by zero. A denominator of exactly -eps gives NULL."""
    return F.try_divide(num, den + F.lit(eps))


def exact_ratio(num: Column, den: Column) -> Column:
    """Quotient without guard; 0.0 where the denominator is 0; NULL where either side is NULL."""
    return F.when(num.isNotNull() & den.isNotNull(),
                  F.when(den != 0, F.try_divide(num, den)).otherwise(F.lit(0.0)))


def per_year(total: Column, age: Column) -> Column:
    return F.when(age == 0, total).otherwise(ratio(total, age))


def hash_unit(key: Column, seed: int = HASH_SEED) -> Column:
    """First 32 bits of md5 over ``seed:key`` as a whole number; the same in any SQL engine."""
    text = F.concat(F.lit(f"{seed}:"), key.cast("string"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint")


def hash_bucket(key: Column, buckets: int = 100, seed: int = HASH_SEED) -> Column:
    return (hash_unit(key, seed) % buckets).cast("int")


def invert_log(c: Column, inverse: str = "expm1") -> Column:
    """Back from log1p. ``exp`` is the compatible variant that ends one unit higher."""
    return {"expm1": F.expm1, "exp": F.exp}[inverse](c)
