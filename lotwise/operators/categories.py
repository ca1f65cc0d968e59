"""Category cleaning, vocabularies, recodes, rare grouping, flags."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lotwise.functions import vocabulary as V
from lotwise.functions.text import clean_category
from lotwise.operators.lookups import written_lookup

CATEGORY_COLUMNS = ["make_name", "model_name", "fuel_type", "transmission", "drive_type", "condition",
                    "body_type", "usage_type", "source"]
KEEP_NULL = ["condition", "usage_type"]


def clean_categories(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Strip, lower, placeholders to NULL, NULL to ``unknown`` except where a recode reads the NULL."""
    names = [c for c in (columns or CATEGORY_COLUMNS) if c in df.columns]
    return df.withColumns({c: clean_category(F.col(c), None if c in KEEP_NULL else "unknown") for c in names})


def map_synonyms(value: Column, mapping: dict[str, str]) -> Column:
    """Exact-match replacement; other values pass through."""
    if not mapping:
        return value
    # a constant map stays one small lookup, where a chain of conditions would swell the generated code
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.coalesce(table[value], value)


def vocabulary_table(spark: SparkSession, vocabulary: dict[str, dict[str, str]] | None = None) -> DataFrame:
    """The vocabulary as data: (column_name, raw, canonical)."""
    rows = [(c, r, v) for c, m in (vocabulary or V.VOCABULARY).items() for r, v in m.items()]
    cols = list(zip(*rows))
    return spark.createDataFrame(pa.table({"column_name": cols[0], "raw": cols[1], "canonical": cols[2]}))


def map_by_table(df: DataFrame, table: DataFrame, columns: list[str]) -> DataFrame:
    """Synonym mapping from an editable table; of entries for the same word the smallest one holds."""
    _, once = written_lookup(table.where(F.col("column_name").isin(columns)).groupBy("column_name", "raw").agg(
        F.min("canonical").alias("canonical")), "vocabulary")
    for c in columns:
        part = once.where(F.col("column_name") == c).select(F.col("raw").alias("_raw"), F.col("canonical").alias("_canonical"))
        joined = df.join(part, F.col(c) == F.col("_raw"), "left")
        df = joined.withColumn(f"{c}_cleaned", F.coalesce("_canonical", c)).drop("_raw", "_canonical")
    return df


def recode(value: Column, lists: dict[str, list[str]], null_to: str, default: str) -> Column:
    """Label by allow-list; NULL and unlisted values have a label of their own."""
    out = F.when(value.isNull(), null_to)
    for label, values in lists.items():
        out = out.when(value.isin(values), label)
    return out.otherwise(default)


def condition_clean(value: Column) -> Column:
    return recode(value, {"Accident free": V.ACCIDENT_FREE}, "Accident free", "Accident involved")


def usage_clean(value: Column) -> Column:
    return recode(value, {"Foreign Used": V.FOREIGN_USED, "Kenyan Used": V.KENYAN_USED}, "Kenyan Used", "Kenyan Used")


def condition_rank(value: Column) -> Column:
    """Ordinal scale for grades and adjectives; NULL where the word says nothing about condition."""
    return F.create_map(*[F.lit(x) for pair in V.CONDITION_RANK.items() for x in pair])[value]


def origin_type(source: Column, usage: Column, by_source: dict[str, str]) -> Column:
    """One origin label from the source tag where it decides, else from the usage recode."""
    mapped = None
    for tag, label in by_source.items():
        mapped = F.when(source == tag, label) if mapped is None else mapped.when(source == tag, label)
    return F.coalesce(mapped, usage_clean(usage)) if by_source else usage_clean(usage)


def rare_threshold(rows: int, floor: int, share: float) -> int:
    return max(floor, int(rows * share))


def kept_values(df: DataFrame, column: str, threshold: int, inclusive: bool = False) -> DataFrame:
    """(_kept): the values frequent enough to keep, as a written table. There may be rows / threshold of them."""
    enough = F.col("n") > threshold if inclusive else F.col("n") >= threshold
    counts = df.groupBy(F.col(column).alias("_kept")).agg(F.count(F.lit(1)).alias("n")).where(enough & F.col("_kept").isNotNull())
    return written_lookup(counts.select("_kept"), "kept")[1]


def group_rare(df: DataFrame, column: str, kept: list[str] | DataFrame, label: str, out: str) -> DataFrame:
    """Values outside the kept ones become one label.

    A list comes from a threshold that is a share of the rows, which bounds it; ``kept_values`` gives a table.
    """
    if isinstance(kept, list):
        kept = F.broadcast(df.sparkSession.createDataFrame(pa.table({"_kept": pa.array(kept, pa.string())})))
    joined = df.join(kept, F.col(column) == F.col("_kept"), "left")
    return joined.withColumn(out, F.when(F.col(column).isNull(), None).otherwise(F.coalesce("_kept", F.lit(label)))).drop("_kept")


def is_member(value: Column, members: list[str]) -> Column:
    return F.when(F.coalesce(value.isin(members), F.lit(False)), 1).otherwise(0)


def pair(left: Column, right: Column) -> Column:
    return F.concat(left, F.lit("_"), right)
