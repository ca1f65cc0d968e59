"""Prices at the rate of the day."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotwise.operators.asof import asof_join
from lotwise.plans.registry import plan
from lotwise.sources.tables import table


# rates change by the month a code's items were shipped in; a code without rates, and days before its first, have none.
# Rates are whole basis points, so both engines multiply the same numbers and nothing is rounded.
@plan("price_at_rate_of_day", """WITH rates AS (SELECT l_linestatus AS code, CAST(date_trunc('month', l_shipdate) AS DATE) AS effective,
  CAST(10000 + (CAST(sum(CAST(round(l_discount * 100) AS BIGINT)) AS BIGINT) * 100) // count(*) AS DOUBLE) / 10000 AS rate FROM lineitem GROUP BY 1, 2)
SELECT o_orderkey AS listing_id, rate, o_totalprice * rate AS price_at_rate
FROM orders ASOF LEFT JOIN rates ON o_orderstatus = code AND CAST(o_orderdate AS DATE) >= effective""")
def price_at_rate_of_day(spark, sf_dir):
    items, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    month = F.trunc(F.col("l_shipdate").cast("date"), "month")
    points = (F.lit(10000) + F.expr("sum(cast(round(l_discount * 100) as bigint)) * 100 div count(*)")).cast("double") / 10000
    rates = items.groupBy(F.col("l_linestatus").alias("code"), month.alias("effective")).agg(points.alias("rate"))
    left = orders.select(F.col("o_orderkey").alias("listing_id"), "o_orderstatus", F.col("o_orderdate").cast("date").alias("day"), "o_totalprice")
    out = asof_join(left, rates, "day", "effective", "o_orderstatus", "code", ["rate"])
    return out.select("listing_id", "rate", (F.col("o_totalprice") * F.col("rate")).alias("price_at_rate"))
