"""Rows as one struct column, so that an operator's own columns never meet names of the caller's."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

ROW = "row"
#: Texts are long: so many rows at most go to a Python worker at a time.
BATCH_ROWS = 1000
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Bounds the session's Arrow batches, which both the executor and its Python workers hold whole."""
    if not 0 < int(spark.conf.get(_BATCH_SETTING)) <= BATCH_ROWS:
        spark.conf.set(_BATCH_SETTING, BATCH_ROWS)


def packed(docs: DataFrame) -> DataFrame:
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(ROW))


def of(name: str) -> Column:
    return F.col(ROW).getField(name)


def unpacked(rows: DataFrame, docs: DataFrame, new: dict[str, Column]) -> DataFrame:
    """The columns of ``docs``, those in ``new`` replaced; further ones in ``new`` follow.

    A new text sets ``n_chars``, where there is such a column.
    """
    if "text" in new and "n_chars" in docs.columns:
        new = {"n_chars": F.length(new["text"]).cast(docs.schema["n_chars"].dataType)} | new
    kept = [new.get(c, of(c)).alias(c) for c in docs.columns]
    return rows.select(*kept, *[v.alias(k) for k, v in new.items() if k not in docs.columns])


def content_key(docs: DataFrame) -> Column:
    """Hash of a packed row's values, whatever their types."""
    rest = [c for c in docs.columns if c not in ("doc_id", "source", "text")]
    more = [F.to_json(F.struct(*[of(c).alias(f"c{k}") for k, c in enumerate(rest)]))] if rest else []
    return F.xxhash64(of("doc_id"), of("source"), of("text"), *more)


def hash_sample(rows: DataFrame, n: int, *by: str) -> DataFrame:
    """The ``n`` rows of the smallest hash of some columns, or all if there are fewer.

    Rows are counted first, so that each task passes on only about its share of ``2 n`` rows.
    """
    total, top = rows.count(), 1 << 31
    place = F.pmod(F.xxhash64(*by), F.lit(top))
    few = rows.where(place < min(top, -(-2 * max(n, 1000) * top // max(total, 1))))
    return few.orderBy(place, *by).limit(n)
