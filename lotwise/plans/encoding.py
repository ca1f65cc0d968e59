"""Encoding queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotwise.operators import encode as E
from lotwise.operators.features import NUMERIC_FEATURES, TEXT_FEATURES
from lotwise.operators.split import fold, train_test
from lotwise.plans import sqltext as S
from lotwise.plans.common import feature_table
from lotwise.plans.registry import plan, rounded
from lotwise.sources.scratch import materialize

_NUMERIC = ["annual_insurance", "car_age", "mileage_num", "mileage_log", "horse_power_num", "power_per_cc", "is_luxury_make"]
_TRAIN = f"WHERE {S.bucket('listing_id')} < 80"


def _scaled(c: str) -> str:
    if c == "annual_insurance":
        return (f"round((coalesce({c}, m_{c}) - m_{c}) / s_{c}, 6) AS {c}")
    return f"round(({c} - m_{c}) / s_{c}, 6) AS {c}"


def _stats(c: str) -> str:
    if c == "annual_insurance":
        return f"avg({c}) AS m_{c}, sqrt(var_pop({c}) * count({c}) / count(*)) AS s_{c}"
    return f"avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END AS s_{c}"


@plan("scaled_numeric", f"""WITH {S.FEATURES}, s AS (SELECT {", ".join(_stats(c) for c in _NUMERIC)} FROM features {_TRAIN})
SELECT listing_id, {", ".join(_scaled(c) for c in _NUMERIC)} FROM features CROSS JOIN s""")
def scaled_numeric(spark, sf_dir):
    df = feature_table(spark, sf_dir)
    stats = E.scale_stats(train_test(df)[0], _NUMERIC)
    return rounded(df.select("listing_id", *[E.scaled(c, *stats[c], c == E.INSURANCE).alias(c) for c in _NUMERIC]))


@plan("one_hot_long", f"""WITH {S.FEATURES}, long AS (
  {" UNION ALL ".join(f"SELECT listing_id, '{c}' AS c, {c} AS v FROM features" for c in TEXT_FEATURES)}),
seen AS (SELECT DISTINCT c, v FROM long {_TRAIN})
SELECT listing_id, 'cat__' || c || '_' || v AS slot FROM long JOIN seen USING (c, v) WHERE {S.bucket('listing_id')} >= 80""")
def one_hot_long(spark, sf_dir):
    train, test = train_test(feature_table(spark, sf_dir, numbers=False).select("listing_id", *TEXT_FEATURES))
    return E.one_hot_long(test, E.fit_preprocessor(train, [], TEXT_FEATURES).labels)


_FUELS = ["diesel", "electric", "hybrid_diesel", "hybrid_petrol", "petrol", "plugin_hybrid_petrol", "unknown"]


@plan("one_hot_wide", f"""WITH {S.LISTINGS}, {S.TEXT} SELECT listing_id,
  {", ".join(f"CASE WHEN fuel_type_cleaned = '{v}' THEN 1 ELSE 0 END AS fuel_type_cleaned_{v}" for v in _FUELS)} FROM text_features""")
def one_hot_wide(spark, sf_dir):
    return E.one_hot_wide(feature_table(spark, sf_dir, numbers=False, names=False), {"fuel_type_cleaned": _FUELS}, ["listing_id"])


_SLOT_NUMBERS = ["annual_insurance", *[c for c in NUMERIC_FEATURES if c != "annual_insurance"]]


def _value(c: str) -> str:
    return f"(coalesce({c}, m_{c}) - m_{c}) / s_{c}" if c == "annual_insurance" else f"({c} - m_{c}) / s_{c}"


def _slots_sql(rows: str, number: str, word: str) -> str:
    """Every slot of the encoder fitted on the training part, in order, with a number for it from some rows.

    ``number`` is an aggregate over {v}, the scaled value; ``word`` one over k rows of n with the slot's word.
    """
    numbers = " UNION ALL ".join(
        f"SELECT {i} AS idx, '{'num_insurance__' if c == 'annual_insurance' else 'num_main__'}{c}' AS slot, {number.format(v=_value(c))} FROM part CROSS JOIN s"
        for i, c in enumerate(_SLOT_NUMBERS))
    long = " UNION ALL ".join(f"SELECT {i} AS g, '{c}' AS c, {c} AS v, seen FROM rows" for i, c in enumerate(TEXT_FEATURES))
    return f"""WITH {S.FEATURES}, s AS (SELECT {", ".join(_stats(c) for c in _SLOT_NUMBERS)} FROM features {_TRAIN}),
rows AS (SELECT *, {S.bucket('listing_id')} < 80 AS seen FROM features), part AS (SELECT * FROM rows WHERE {rows}),
whole AS (SELECT count(*) AS n FROM part), long AS ({long}),
slots AS (SELECT g, c, v, CAST({len(_SLOT_NUMBERS)} - 1 + row_number() OVER (ORDER BY g, v) AS INTEGER) AS idx FROM long WHERE seen GROUP BY 1, 2, 3),
held AS (SELECT g, v, count(*) AS k FROM long WHERE {rows} GROUP BY 1, 2)
{numbers} UNION ALL SELECT idx, 'cat__' || c || '_' || v, {word} FROM slots LEFT JOIN held USING (g, v) CROSS JOIN whole"""


# share of ones and mean per slot of the full encoder output, fitted on the training part
@plan("encoded_slots", _slots_sql("NOT seen", "round(avg({v}), 6) AS mean, CAST(count(*) FILTER (WHERE {v} <> 0) AS DOUBLE) AS nonzero",
                                  "round(coalesce(k, 0) / n, 6), CAST(coalesce(k, 0) AS DOUBLE)"))
def encoded_slots(spark, sf_dir):
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.stat import Summarizer

    df = feature_table(spark, sf_dir)
    train, test = train_test(df)
    enc = E.fit_preprocessor(train)
    one = enc.transform(test, ["listing_id"]).agg(
        Summarizer.mean(F.col("features")).alias("mean"), Summarizer.numNonZeros(F.col("features")).alias("nonzero"))
    names = F.array(*[F.lit(n) for n in enc.names])
    zipped = F.arrays_zip(names.alias("slot"), vector_to_array("mean").alias("mean"), vector_to_array("nonzero").alias("nonzero"))
    return one.select(F.posexplode(zipped).alias("idx", "z")).select("idx", "z.slot", F.round("z.mean", 6).alias("mean"), "z.nonzero")


# slots that hardly vary in the training part
@plan("low_variance_slots", f"""SELECT slot, variance, variance <= 0.001 AS low FROM ({_slots_sql(
    "seen", "round(var_samp({v}), 4) AS variance", "round(coalesce(k, 0) * (n - coalesce(k, 0)) / (n * (n - 1.0)), 4)")})""")
def low_variance_slots(spark, sf_dir):
    from lotwise.operators.training import slot_variances

    train = materialize(train_test(feature_table(spark, sf_dir))[0], "train-features")
    enc = E.fit_preprocessor(train)
    out = slot_variances(enc.transform(train, ["listing_id"]), enc.names).select(F.col("name").alias("slot"), F.round("variance", 4).alias("variance"))
    return out.withColumn("low", F.col("variance") <= 0.001)


_PREDICTORS = ["price_log", "car_age", "mileage_log", "engine_size_cc_log"]


def _normal_equations(inputs: list[str], target: str, where: str) -> str:
    """Least squares by Gauss-Jordan steps on the centred cross products, one query per eliminated input."""
    n, cols = len(inputs), [*inputs, target]
    sums = ", ".join(f"covar_pop({a}, {b}) AS m_{i}_{j}" for i, a in enumerate(inputs) for j, b in enumerate(cols))
    out = f"e0 AS (SELECT {', '.join(f'avg({c}) AS avg_{i}' for i, c in enumerate(cols))}, {sums} FROM features {where} AND {target} IS NOT NULL)"
    for k in range(n):
        cells = ", ".join(f"{f'm_{i}_{j} / m_{k}_{k}' if i == k else f'm_{i}_{j} - m_{i}_{k} * m_{k}_{j} / m_{k}_{k}'} AS m_{i}_{j}"
                          for i in range(n) for j in range(n + 1))
        out += f", e{k + 1} AS (SELECT {', '.join(f'avg_{i}' for i in range(n + 1))}, {cells} FROM e{k})"
    slopes = ", ".join(f"m_{i}_{n} AS b{i}" for i in range(n))
    start = " - ".join([f"avg_{n}", *[f"m_{i}_{n} * avg_{i}" for i in range(n)]])
    return f"{out}, fit AS (SELECT {slopes}, {start} AS a FROM e{n})"


@plan("insurance_regression_fill", f"""WITH {S.FEATURES}, {_normal_equations(_PREDICTORS, "annual_insurance", _TRAIN)}
SELECT listing_id, round(coalesce(annual_insurance, a + {" + ".join(f"b{i} * {c}" for i, c in enumerate(_PREDICTORS))}), 2) AS annual_insurance
FROM features CROSS JOIN fit""")
def insurance_regression_fill(spark, sf_dir):
    df = feature_table(spark, sf_dir)
    filled = E.regression_fill(df, "annual_insurance", _PREDICTORS, train_test(df)[0])
    return rounded(filled.select("listing_id", "annual_insurance"), 2)


# one input column: the fit has a closed form in SQL
@plan("insurance_one_column_fill", f"""WITH {S.FEATURES},
fit AS (SELECT regr_slope(annual_insurance, price_log) AS b, regr_intercept(annual_insurance, price_log) AS a,
  min(annual_insurance) AS low FROM features {_TRAIN})
SELECT listing_id, round(coalesce(annual_insurance, a + b * price_log), 2) AS annual_insurance,
  round(coalesce(annual_insurance, greatest(a + b * price_log, low)), 2) AS with_floor FROM features CROSS JOIN fit""")
def insurance_one_column_fill(spark, sf_dir):
    df = feature_table(spark, sf_dir, numbers=["price"], names=False).select("listing_id", "annual_insurance", "price_log", F.col("annual_insurance").alias("with_floor"))
    train, _ = train_test(df)
    filled = E.regression_fill(df, "annual_insurance", ["price_log"], train)
    filled = E.regression_fill(filled, "with_floor", ["price_log"], train, floor=True)
    return rounded(filled.select("listing_id", "annual_insurance", "with_floor"), 2)


@plan("oof_target_encoding", f"""WITH {S.FEATURES},
t AS (SELECT listing_id, make_name_cleaned, price_log, {S.bucket('listing_id', 43, 5)} AS fold FROM features {_TRAIN}),
p AS (SELECT make_name_cleaned AS c, fold AS f, sum(price_log) AS s, count(*) AS n FROM t GROUP BY 1, 2),
folds AS (SELECT f AS pf, sum(s) AS fs, sum(n) AS fn FROM p GROUP BY 1),
prior AS (SELECT pf, ((SELECT sum(s) FROM p) - fs) / ((SELECT sum(n) FROM p) - fn) AS prior FROM folds),
cats AS (SELECT c AS cc, sum(s) AS cs, sum(n) AS cn FROM p GROUP BY 1)
SELECT listing_id, make_name_cleaned, fold, round((cs - s + 20.0 * prior) / (cn - n + 20.0), 6) AS make_name_cleaned_encoded
FROM t JOIN p ON c = make_name_cleaned AND f = fold JOIN cats ON cc = c JOIN prior ON pf = f""")
def oof_target_encoding(spark, sf_dir):
    train, _ = train_test(feature_table(spark, sf_dir).select("listing_id", "make_name_cleaned", "price_log"))
    train = train.withColumn("fold", fold(F.col("listing_id")))
    out = E.target_encoding(train, "make_name_cleaned", "price_log", F.col("fold"))
    return rounded(out.select("listing_id", "make_name_cleaned", "fold", "make_name_cleaned_encoded"))


_NAMED = ["fuel_type_cleaned", "transmission_cleaned", "model_name_cleaned"]


def _names_sql(where: str) -> str:
    parts = [f"SELECT {i} AS g, '{c}_' || {c} AS name FROM features {where} GROUP BY ALL" for i, c in enumerate(_NAMED)]
    return f"SELECT name, CAST(row_number() OVER (ORDER BY g, name) - 1 AS INTEGER) AS idx FROM ({' UNION ALL '.join(parts)})"


# slots of two encoders aligned by name, fitted on the train and on the test part
@plan("name_alignment", f"""WITH {S.FEATURES}, a AS ({_names_sql(_TRAIN)}), b AS ({_names_sql("WHERE " + S.bucket('listing_id') + " >= 80")})
SELECT coalesce(a.name, b.name) AS name, a.idx AS idx_a, b.idx AS idx_b,
  CASE WHEN b.name IS NULL THEN 'only_a' WHEN a.name IS NULL THEN 'only_b' WHEN a.idx = b.idx THEN 'same' ELSE 'moved' END AS status
FROM a FULL JOIN b ON a.name = b.name""")
def name_alignment(spark, sf_dir):
    from lotwise.operators.names import align, name_table

    train, test = train_test(feature_table(spark, sf_dir, numbers=False).select("listing_id", *_NAMED))
    a, b = (E.fit_preprocessor(part, [], _NAMED).names for part in (train, test))
    return align(name_table(spark, [E.strip_prefix(n) for n in a]), name_table(spark, [E.strip_prefix(n) for n in b]))
