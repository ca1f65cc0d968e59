"""The listings that several passes read are dealt evenly, whatever file they came in."""

from datetime import datetime

import numpy as np
from pyspark.sql import functions as F

from lotwise.operators.components import _added
from lotwise.plans.training import data
from lotwise.sources import listings as L


def tables(spark, folder, orders):
    at = F.lit(datetime(2020, 5, 1)).cast("timestamp_ntz")
    rows = spark.range(orders).select(
        F.col("id").alias("o_orderkey"), (F.col("id") % 7).alias("o_custkey"), F.lit("F").alias("o_orderstatus"),
        (F.col("id") * 1.5 + 10).alias("o_totalprice"), at.alias("o_orderdate"))
    odd = rows.where("o_orderkey < 3").unionByName(rows.limit(1).withColumn("o_orderkey", F.lit(None).cast("long")))
    rows.unionByName(odd).coalesce(1).write.parquet(f"{folder}/orders.parquet")
    spark.range(9).select(F.col("id").alias("p_partkey"), F.concat(F.lit("name "), "id").alias("p_name"), F.lit("Brand#1").alias("p_brand"),
                          F.col("id").cast("int").alias("p_size")).coalesce(1).write.parquet(f"{folder}/part.parquet")
    return str(folder)


def test_one_file_is_dealt_to_many_parts(spark, tmp_path, monkeypatch):
    folder = tables(spark, tmp_path, 1000)
    monkeypatch.setattr(L, "PART_ROWS", 100)
    written = L.written_listings(spark, folder)
    files = [r["n"] for r in written.groupBy(F.input_file_name().alias("f")).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(files) > 5 and max(files) < 300
    rows = lambda df: sorted(map(repr, df.collect()))
    assert rows(written) == rows(L.listings(spark, folder)) and written.count() == 1004


def test_training_reads_the_parts(spark, tmp_path, monkeypatch):
    folder = tables(spark, tmp_path, 1000)
    monkeypatch.setattr(L, "PART_ROWS", 100)
    assert len(data(spark, folder).train.inputFiles()) > 1


def test_a_large_part_table_is_not_sent_whole(spark, tmp_path, monkeypatch):
    folder = tables(spark, tmp_path, 1000)
    rows = lambda df: sorted(map(repr, df.collect()))
    parts = lambda df: df.select("listing_id", F.input_file_name().alias("f")).groupBy("f").agg(F.collect_list("listing_id").alias("ids")).select("ids").collect()
    monkeypatch.setattr(L, "PART_ROWS", 100)
    sent = L.written_listings(spark, folder)
    monkeypatch.setattr(L, "MOST_SENT", 5)
    orders, part = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("orders", "part"))
    plan = L.from_orders(orders.select(*L.ORDER_COLUMNS), part)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    shuffled = L.written_listings(spark, folder)
    assert rows(shuffled) == rows(sent) and sorted(map(repr, parts(shuffled))) == sorted(map(repr, parts(sent)))


def test_sums_by_place():
    place, weights, values = np.array([2, 0, 2]), np.array([1.0, 2.0, 3.0]), np.array([[1.0, 2.0], [3.0, 4.0], [5.0, 6.0]])
    assert _added(place, weights, values, 4).tolist() == [[6.0, 8.0], [0.0, 0.0], [16.0, 20.0], [0.0, 0.0]]
    none = _added(place[:0], weights[:0], values[:0], 2)
    assert none.tolist() == [[0.0, 0.0]] * 2 and none.dtype == float
