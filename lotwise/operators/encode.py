"""Preprocessing for the learners: fill, scale, one-hot, assemble. Fitted on the training part only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler, VectorSlicer
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, functions as F

from lotwise.functions.vocabulary import RUNTIME_MISSING
from lotwise.operators.features import NUMERIC_FEATURES, TEXT_FEATURES
from lotwise.operators.lookups import written_lookup
from lotwise.sources.scratch import materialize

NUMERIC_TYPES = ("double", "float", "bigint", "int", "smallint", "tinyint")
INSURANCE = "annual_insurance"
PREFIXES = ["num_insurance__", "num_main__", "cat__", "remainder__"]


def column_kinds(df: DataFrame, exclude: list[str]) -> tuple[list[str], list[str]]:
    """Numeric and text columns by type."""
    kinds = [(c, t) for c, t in df.dtypes if c not in exclude]
    numeric = [c for c, t in kinds if t in NUMERIC_TYPES or t.startswith("decimal")]
    return numeric, [c for c, t in kinds if t == "string"]


def scale_stats(train: DataFrame, numeric: list[str], mean_filled: list[str] = (INSURANCE,)) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation per column, in one aggregate; a zero deviation counts as 1.

    For a mean-filled column the deviation is that of the filled column: the filled rows add nothing
    to the squares but count in the divisor.
    """
    if not numeric:
        return {}
    n = F.count(F.lit(1))
    row = train.agg(*[a for c in numeric for a in (
        F.avg(c).alias(f"{c}__m"),
        (F.sqrt(F.var_pop(c) * F.count(c) / n) if c in mean_filled else F.stddev_pop(c)).alias(f"{c}__s"),
    )]).first()
    return {c: (row[f"{c}__m"] or 0.0, row[f"{c}__s"] or 1.0) for c in numeric}


def scaled(name: str, mean: float, std: float, fill: bool) -> Column:
    value = F.coalesce(F.col(name), F.lit(mean)) if fill else F.col(name)
    return (value - mean) / std


@dataclass
class Preprocessor:
    """Fitted encoder: a saveable pipeline and the ordered names of its output slots."""

    pipeline: PipelineModel
    names: list[str]
    scale: dict[str, tuple[float, float]]
    labels: dict[str, list[str]]

    def transform(self, df: DataFrame, keep: list[str]) -> DataFrame:
        return self.pipeline.transform(df).select(*[c for c in keep if c in df.columns], "features")


def fit_preprocessor(train: DataFrame, numeric: list[str] | None = None, text: list[str] | None = None) -> Preprocessor:
    numeric = [c for c in (NUMERIC_FEATURES if numeric is None else numeric) if c in train.columns]
    text = [c for c in (TEXT_FEATURES if text is None else text) if c in train.columns]
    numeric = [c for c in numeric if c == INSURANCE] + [c for c in numeric if c != INSURANCE]
    scale = scale_stats(train, numeric)

    def number(c: str) -> str:
        mean, std = scale[c]
        value = f"coalesce({c}, {mean!r}D)" if c == INSURANCE else c
        return f"({value} - {mean!r}D) / {std!r}D AS num_{c}"

    selected = ["*", *[number(c) for c in numeric], *[f"coalesce({c}, '{RUNTIME_MISSING}') AS cat_{c}" for c in text]]
    stages = [
        SQLTransformer(statement=f"SELECT {', '.join(selected)} FROM __THIS__"),
        # an unseen value becomes the extra last slot, which dropLast removes: all zeros
        StringIndexer(inputCols=[f"cat_{c}" for c in text], outputCols=[f"idx_{c}" for c in text],
                      stringOrderType="alphabetAsc", handleInvalid="keep"),
        OneHotEncoder(inputCols=[f"idx_{c}" for c in text], outputCols=[f"hot_{c}" for c in text], dropLast=True),
        VectorAssembler(inputCols=[f"num_{c}" for c in numeric] + [f"hot_{c}" for c in text],
                        outputCol="features", handleInvalid="keep"),
    ]
    model = Pipeline(stages=stages).fit(train)
    labels = dict(zip(text, [list(v) for v in model.stages[1].labelsArray]))
    names = [("num_insurance__" if c == INSURANCE else "num_main__") + c for c in numeric]
    names += [f"cat__{c}_{v}" for c in text for v in labels[c]]
    return Preprocessor(model, names, scale, labels)


def strip_prefix(name: str) -> str:
    """Slot name without the group prefix, to align models from different encoders."""
    return next((name[len(p):] for p in PREFIXES if name.startswith(p)), name)


def select_slots(df: DataFrame, all_names: list[str], wanted: list[str], out: str = "selected") -> DataFrame:
    """Vector cut to the wanted slots in the wanted order; raises with the names that are missing."""
    at = {n: i for i, n in enumerate(all_names)}
    missing = [n for n in wanted if n not in at]
    if missing:
        raise ValueError(f"slots not produced by the encoder: {missing[:20]}")
    return VectorSlicer(inputCol="features", outputCol=out, indices=[at[n] for n in wanted]).transform(df)


def one_hot_long(df: DataFrame, labels: dict[str, list[str]], key: str = "listing_id") -> DataFrame:
    """(key, slot) for every slot that is 1; values unseen in training give no row."""
    entries = [F.struct(F.lit(c).alias("c"), F.coalesce(F.col(c), F.lit(RUNTIME_MISSING)).alias("v")) for c in labels]
    long = df.select(key, F.inline(F.array(*entries)))
    seen = F.lit(False)
    for c, values in labels.items():
        seen = seen | ((F.col("c") == c) & F.col("v").isin(values))
    return long.where(seen).select(key, F.concat(F.lit("cat__"), "c", F.lit("_"), "v").alias("slot"))


def one_hot_wide(df: DataFrame, labels: dict[str, list[str]], keep: list[str]) -> DataFrame:
    """0/1 columns for a known value list, without a shuffle."""
    hot = [F.when(F.col(c) == v, 1).otherwise(0).alias(f"{c}_{v}") for c, vs in labels.items() for v in vs]
    return df.select(*keep, *hot)


def regression_fill(df: DataFrame, column: str, inputs: list[str], train: DataFrame | None = None, floor: bool = False) -> DataFrame:
    """Fill NULLs of a column by a linear model of other columns, fitted on the rows that have it.

    With ``floor`` the result is never below the smallest value seen, so a positive amount stays positive.
    """
    train = df if train is None else train
    known = VectorAssembler(inputCols=inputs, outputCol="_x").transform(train.where(F.col(column).isNotNull()))
    model = LinearRegression(featuresCol="_x", labelCol=column, predictionCol="_p", solver="normal").fit(known)
    predicted = sum((F.col(c) * float(b) for c, b in zip(inputs, model.coefficients)), F.lit(float(model.intercept)))
    if floor:
        predicted = F.greatest(predicted, F.lit(train.agg(F.min(column)).first()[0]))
    return df.withColumn(column, F.coalesce(F.col(column), predicted))


def target_encoding(df: DataFrame, column: str, target: str, fold: Column, smooth: float = 20.0) -> DataFrame:
    """Mean target per category over the *other* folds, pulled to the mean of those folds.

    With ``smooth=0`` it is the out-of-fold group mean, and the overall mean for a group that no other
    fold has. One aggregation per (category, fold); no loop over folds.
    """
    parts = materialize(df.groupBy(F.col(column).alias("_c"), fold.alias("_f")).agg(
        F.sum(target).alias("s"), F.count(target).alias("n")), "fold-sums")
    category = parts.groupBy(F.col("_c").alias("_cc")).agg(F.sum("s").alias("cs"), F.sum("n").alias("cn"))
    # at most one row per fold
    per_fold = {r["_f"]: (r["s"], r["n"]) for r in parts.groupBy("_f").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect()}
    total, size = sum(v[0] or 0.0 for v in per_fold.values()), sum(v[1] for v in per_fold.values())
    prior = None
    for f, (s, n) in per_fold.items():
        value = (total - (s or 0.0)) / (size - n) if size > n else total / size
        prior = F.when(F.col("_f") == f, value) if prior is None else prior.when(F.col("_f") == f, value)
    others_s, others_n = F.col("cs") - F.coalesce("s", F.lit(0.0)), F.col("cn") - F.col("n")
    table = parts.join(category, F.col("_c").eqNullSafe(F.col("_cc"))).select(
        "_c", "_f", F.coalesce(F.try_divide(others_s + smooth * prior, others_n + smooth), prior).alias(f"{column}_encoded"))
    _, side = written_lookup(table, "fold-means")
    joined = df.withColumn("_fold", fold).join(side, F.col(column).eqNullSafe(F.col("_c")) & (F.col("_fold") == F.col("_f")), "left")
    return joined.drop("_c", "_f", "_fold")
