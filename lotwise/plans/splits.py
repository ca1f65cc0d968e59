"""Split, fold and sample queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotwise.functions.numbers import hash_bucket
from lotwise.operators import split
from lotwise.plans import sqltext as S
from lotwise.plans.registry import plan
from lotwise.sources.listings import listings
from lotwise.sources.tables import table


@plan("split_folds", f"""SELECT l_orderkey % 5 AS slice, CASE WHEN {S.bucket('l_orderkey')} < 80 THEN 'train' ELSE 'test' END AS part,
  {S.bucket('l_orderkey', 43, 5)} AS fold, count(*) AS rows FROM lineitem GROUP BY 1, 2, 3""")
def split_folds(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select("l_orderkey")
    part = F.when(hash_bucket(F.col("l_orderkey")) < 80, "train").otherwise("test")
    return items.groupBy((F.col("l_orderkey") % 5).alias("slice"), part.alias("part"),
                         split.fold(F.col("l_orderkey")).alias("fold")).agg(F.count(F.lit(1)).alias("rows"))


@plan("split_rows", f"""WITH {S.LISTINGS} SELECT listing_id, CASE WHEN {S.bucket('listing_id')} < 80 THEN 'train' ELSE 'test' END AS part FROM listings""")
def split_rows(spark, sf_dir):
    train, test = split.train_test(listings(spark, sf_dir).select("listing_id"))
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@plan("sample_n", f"WITH {S.LISTINGS} SELECT listing_id, make_name FROM listings ORDER BY {S.unit('listing_id')}, listing_id LIMIT 200")
def sample_n(spark, sf_dir):
    return split.sample_rows(listings(spark, sf_dir).select("listing_id", "make_name"), 200)
