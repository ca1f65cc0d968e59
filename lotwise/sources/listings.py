"""Listings derived from the given star schema: one listing per order.

Dirt (missing, zero, malformed and rare values) follows from arithmetic on the order key, so the same
rows come out in any engine and at any size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lotwise.session import compile_methods
from lotwise.sources.scratch import materialize
from lotwise.sources.tables import stream, table

#: Rows of one part of the written listings.
PART_ROWS = 32_768
#: Rows of the part table that a plan may send whole to the driver and from there to every executor.
MOST_SENT = 100_000
ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]
PART_COLUMNS = ["p_partkey", "p_name", "p_brand", "p_size"]

# ---- fixed values: raw words of the categorical columns, picked by key modulo (length + 1) --------
RAW_WORDS = {
    "fuel_type": ["Petrol", "Petroleum", "Hybrid(Petrol)", "Petrol Hybrid", " hybrid ",
                  "Hybrid(Diesel)", "Diesel Hybrid", "Plug-in Hybrid(Petrol)", "Electric", "DIESEL"],
    "transmission": ["At", "Automatic", "Mt", "5MT", "6MT", "7MT", "4MT", "Duonic", "Smoother",
                     "Proshift", "Manual", "N/A"],
    "drive_type": ["2WD", "4WD", "AWD", "FR", "FF", "MR", "FWD", "RWD", "RR", "04-FEB", "unknown"],
    "condition": ["Foreign Used", "Excellent", "Very Good", "4.5", "Locally Used", "Average", "5",
                  "Ready For Import", "6", "Below Average", "New", "4", "5, 4.5"],
    "usage_type": ["Foreign Used", "Kenyan Used", "Used", "Locally Used", "Brand New",
                   "Ready For Import", "New", "Auction"],
    "body_type": ["SUV", "Hatchback", "Sedan", "Saloon", "Mini Van", "Van", "Minivan", "Coupe",
                  "Coupes", "Truck", "Station Wagon", "Wagon", "Estate", "Convertible", "Bus",
                  "Buses and Vans", "Pickup", "Pick up", "Pickups", "Pickup Truck", "Double Cab",
                  "Mini SUV", "Truck Wing", "Other", "-"],
}


def _every(k: Column, step: int, at: int) -> Column:
    return k % step == at


def _word(k: Column, words: list[str]) -> Column:
    return F.get(F.array(*[F.lit(w) for w in words]), (k % (len(words) + 1)).cast("int"))


def _joined(orders: DataFrame, part: DataFrame, customer: DataFrame | None = None) -> DataFrame:
    """Orders with their part and, with ``customer``, their source tag."""
    parts = part.select(*PART_COLUMNS)
    count = part.count()
    # a part table of unbounded size is shuffled; a stream's batches would shuffle it once each
    side = parts.hint("merge") if count > MOST_SENT and not orders.isStreaming else parts
    rows = orders.join(side, F.col("p_partkey") == F.col("o_orderkey") % max(count, 1), "left")
    if customer is not None:
        tags = customer.select("c_custkey", F.col("c_mktsegment").alias("source"))
        rows = rows.join(tags, F.col("c_custkey") == F.col("o_custkey"), "left")
    return rows


def from_orders(orders: DataFrame, part: DataFrame, customer: DataFrame | None = None) -> DataFrame:
    """Listing columns over an orders table (batch or stream).

    An order's part is the one whose key is the order key modulo the number of parts. ``customer`` gives
    the source tag; leave it out where no caller needs the tag, the rows stay the same.
    """
    return _columns(_joined(orders, part, customer))


def _columns(rows: DataFrame) -> DataFrame:
    k, total, size = F.col("o_orderkey"), F.col("o_totalprice"), F.col("p_size")
    text = lambda c: c.cast("string")
    year = F.year("o_orderdate") + k % 25
    columns = {
        "listing_id": k,
        "price": F.when(~_every(k, 22, 5), total),
        "currency_code": F.when(_every(k, 21, 3), None).when(_every(k, 997, 1), "EUR")
        .when(F.col("o_orderstatus") == "F", " KSh").when(F.col("o_orderstatus") == "O", "USD ").otherwise("usd"),
        "year_of_manufacture": F.when(_every(k, 42, 1), "0").when(_every(k, 100, 9), "n/a")
        .when(_every(k, 3001, 7), "1900").when(_every(k, 1500, 11), "2031").otherwise(text(year)),
        "mileage": F.when(_every(k, 24, 2), None).when(_every(k, 50, 4), "0")
        .when(_every(k, 333, 6), "12,000 km").otherwise(text((k * 7919) % 250000)),
        "mileage_unit": F.when(~_every(k, 127, 5), "km"),
        "engine_size_cc": F.when(_every(k, 40, 8), "0").when(_every(k, 4001, 10), "46008")
        .otherwise(text(660 + size * 60)),
        "horse_power": F.when(~_every(k, 30, 9), text(60 + (size * 7) % 300)),
        "torque": F.when(~_every(k, 31, 9), text(90 + (size * 11) % 400)),
        "acceleration": F.when(~_every(k, 32, 9), (50 + size).cast("double") / 10),
        "seats": F.when(~_every(k, 35, 9), (2 + k % 7).cast("int")),
        "annual_insurance": F.when(_every(k, 5, 0), total * 0.04),
        "make_name": F.when(_every(k, 500, 7), "Unknown_Placeholder").when(_every(k, 77, 1), " N/A ")
        .when(_every(k, 1300, 17), F.concat(F.lit("Rare"), text(k)))
        .when(_every(k, 2, 0), F.upper("p_brand")).otherwise(F.concat(F.lit(" "), "p_brand")),
        "model_name": F.when(_every(k, 500, 7), "Unknown_Placeholder").when(_every(k, 83, 1), "unspecified")
        .when(_every(k, 700, 19), F.concat(F.lit("proto "), text(k))).otherwise(F.col("p_name")),
        **{name: _word(k, words) for name, words in RAW_WORDS.items()},
    }
    if "source" in rows.columns:
        columns["source"] = F.col("source")
    return rows.select(*[c.alias(n) for n, c in columns.items()])


_plans: dict[tuple, DataFrame] = {}


def listings(spark: SparkSession, sf_dir: str, with_source: bool = False) -> DataFrame:
    """The listings of a folder. The plan is built once per session; nothing is cached but the plan."""
    key = (spark.sparkContext.applicationId, id(spark), sf_dir, with_source)
    if key not in _plans:
        customer = table(spark, sf_dir, "customer") if with_source else None
        orders = table(spark, sf_dir, "orders").select(*ORDER_COLUMNS)
        _plans[key] = from_orders(orders, table(spark, sf_dir, "part"), customer)
    return _plans[key]


def written_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listings, joined and written once, for queries that pass over them several times.

    Orders are dealt evenly first, so the work is spread however few files or row groups they came in. Parts are
    ordered, which keeps what depends on the order of rows (the draws of a forest) the same in every run. Up to
    ``PART_ROWS`` rows stay as they were read.
    """
    compile_methods(spark)
    orders = table(spark, sf_dir, "orders").select(*ORDER_COLUMNS)
    rows = _joined(orders, table(spark, sf_dir, "part"))
    parts = -(-orders.count() // PART_ROWS)
    if parts > 1:
        # after the join, which may shuffle; rows of one order lie side by side
        rows = rows.repartition(parts, F.xxhash64(*ORDER_COLUMNS)).sortWithinPartitions(*ORDER_COLUMNS, *PART_COLUMNS)
    return materialize(_columns(rows), "listings")


def listing_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings as a stream of order files joined with the static part table."""
    return from_orders(stream(spark, sf_dir, "orders"), table(spark, sf_dir, "part"))
