"""Rank correlation of the numeric features."""

from __future__ import annotations

from lotwise.operators.features import NUMERIC_FEATURES
from lotwise.operators.ranks import rank_correlations
from lotwise.plans import sqltext as S
from lotwise.plans.common import feature_table
from lotwise.plans.registry import plan, rounded

_COLUMNS = [c for c in NUMERIC_FEATURES if c != "annual_insurance"]
_RANKS = ", ".join(f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS {c}" for c in _COLUMNS)
_PAIRS = ", ".join(f"{{'column_a': '{a}', 'column_b': '{b}', 'rows': count(*), 'spearman': round(corr({a}::DOUBLE, {b}::DOUBLE), 6)}}"
                   for i, a in enumerate(_COLUMNS) for b in _COLUMNS[i + 1:])


@plan("rank_correlations", f"WITH {S.FEATURES}, ranks AS MATERIALIZED (SELECT {_RANKS} FROM features) SELECT unnest([{_PAIRS}], recursive := true) FROM ranks")
def rank_correlation_table(spark, sf_dir):
    df = feature_table(spark, sf_dir).select("listing_id", *_COLUMNS)
    return rounded(rank_correlations(df, _COLUMNS), 6)
