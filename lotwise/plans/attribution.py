"""Exact attribution of tree ensembles and kernel attribution."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from lotwise.operators import models as M, training as T
from lotwise.operators.features import FEATURES
from lotwise.operators.kernel_shapley import kernel_shapley
from lotwise.operators.split import train_test
from lotwise.operators.tree_shapley import slot_columns, tree_shapley
from lotwise.plans.common import feature_table
from lotwise.plans.registry import PLANS, plan, rounded
from lotwise.plans.training import _WEIGHTS, data
from lotwise.sources.scratch import materialize


def _tree_shares(spark, sf_dir):
    d = data(spark, sf_dir)
    model = T.learner("forest").fit(d.train)
    return d, model, tree_shapley(d.test, model, slot_columns(d.encoder))


@plan("shapley_trees")
def shapley_trees(spark, sf_dir):
    """Every row of the test part and all 26 features; a text column's slots are one player."""
    return rounded(_tree_shares(spark, sf_dir)[2], 6)



@plan("shapley_trees_total")
def shapley_trees_total(spark, sf_dir):
    """(listing_id, predicted, explained) of the test part: the prediction, and base plus contributions."""
    d, model, shares = _tree_shares(spark, sf_dir)
    sums = shares.groupBy("listing_id").agg((F.sum("contribution") + F.first("base")).alias("explained"))
    scored = model.transform(d.test).select("listing_id", F.col("prediction").alias("predicted"))
    return rounded(scored.join(sums, "listing_id"), 6)


@plan("shapley_trees_importance")
def shapley_trees_importance(spark, sf_dir):
    return rounded(M.global_importance(_tree_shares(spark, sf_dir)[2], len(FEATURES)), 6)


@plan("shapley_kernel")
def shapley_kernel(spark, sf_dir):
    """50 explained and 20 background rows, 512 of the 2^26 coalitions, over all features of a forest."""
    d = data(spark, sf_dir)
    model = T.learner("forest", numTrees=10, maxDepth=6).fit(d.train)
    scorer = PipelineModel([*d.encoder.pipeline.stages, model])
    shares = kernel_shapley(d.test, FEATURES, scorer.transform, 50, 20, 512, background_df=d.train)
    return rounded(materialize(shares, "kernel-shares"), 6)


# all 30 coalitions of a linear scorer: exact, so the same SQL as for the sampled walk holds
@plan("shapley_kernel_linear", PLANS["shapley_linear"].sql)
def shapley_kernel_linear(spark, sf_dir):
    train, test = train_test(feature_table(spark, sf_dir, names=False).select("listing_id", *_WEIGHTS))
    line = sum((F.col(c) * w for c, w in _WEIGHTS.items()), F.lit(5.0))
    return rounded(kernel_shapley(test, list(_WEIGHTS), lambda df: df.withColumn("prediction", line), background_df=train))


