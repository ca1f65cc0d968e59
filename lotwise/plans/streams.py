"""Streaming queries, run over all files and read back from their sinks."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from lotwise.functions.numbers import invert_log, to_number
from lotwise.operators import models as M, registry as R, requests as Q
from lotwise.operators.split import train_test
from lotwise.plans import sqltext as S
from lotwise.plans.common import feature_table
from lotwise.plans.registry import AS_OF_YEAR, plan, rounded
from lotwise.plans.scoring import _DERIVED, _RAW, _RULES, registered_line
from lotwise.sources.listings import listing_stream
from lotwise.sources.scratch import new_path
from lotwise.sources.tables import stream, table
from lotwise.streaming import monitor as W, scoring as C
from lotwise.streaming.replays import keyed_state, replays_dropped_for
from lotwise.streaming.runner import run_to_files, run_updates, utc_day, with_event_time


def request_stream(spark, sf_dir):
    """Order files as a stream of scoring requests."""
    df = listing_stream(spark, sf_dir)
    df = df.select(
        "listing_id", *[to_number(F.col(c)).alias(c) for c in _RAW], F.col("acceleration").alias("acceleration_num"),
        F.col("seats").cast("double").alias("seats_num"), "annual_insurance",
        F.col("make_name").alias("make_name_cleaned"), F.col("model_name").alias("model_name_cleaned"),
        F.col("fuel_type").alias("fuel_type_cleaned"), F.col("transmission").alias("transmission_cleaned"))
    return Q.derive(df, AS_OF_YEAR)


def _line(spark, sf_dir):
    train, _ = train_test(feature_table(spark, sf_dir, names=False).select("listing_id", "car_age", "price_log"))
    return M.line_fit(train, "car_age", "price_log")


def _run_scores(spark, sf_dir):
    fit = _line(spark, sf_dir)

    def score(df):
        return df.select("listing_id", "car_age", F.array_join("filled", ",").alias("filled"),
                         F.log1p(invert_log(M.line(fit, "car_age"))).alias("predicted_log"))

    return C.score_stream(request_stream(spark, sf_dir), score, new_path(spark, "scores"))


_SCORED = f"""WITH {S.FEATURES}, {_DERIVED}, line AS (SELECT regr_slope(price_log, car_age) AS b, regr_intercept(price_log, car_age) AS a
  FROM features WHERE {S.bucket('listing_id')} < 80),
checked AS (SELECT *, concat_ws('; ', {", ".join(_RULES)}) AS violations FROM derived)"""


@plan("stream_scores", f"""{_SCORED} SELECT listing_id, round(car_age, 2) AS car_age, concat_ws(',',
  CASE WHEN horse_power IS NULL THEN 'horse_power_num' END, CASE WHEN torque IS NULL THEN 'torque_num' END,
  CASE WHEN acceleration_num IS NULL THEN 'acceleration_num' END, CASE WHEN seats_num IS NULL THEN 'seats_num' END) AS filled,
  round(a + b * car_age, 6) AS predicted_log FROM checked CROSS JOIN line WHERE violations = ''""")
def stream_scores(spark, sf_dir):
    return rounded(C.read_scores(spark, _run_scores(spark, sf_dir)), 2, predicted_log=6)


# valid requests scored by the newest registered version of a model
@plan("stream_registry_scores", f"""{_SCORED} SELECT listing_id, round(a + b * car_age, 6) AS predicted_log,
  'line:20250101_000000' AS model_version FROM checked CROSS JOIN line WHERE violations = ''""")
def stream_registry_scores(spark, sf_dir):
    path = new_path(spark, "registry")
    registered_line(spark, sf_dir, path)
    entry = R.find(spark, path, "line")
    out = C.score_stream(request_stream(spark, sf_dir), lambda df: R.score(df, entry, ["listing_id"], "now"), new_path(spark, "scores"))
    return rounded(C.read_scores(spark, out).select("listing_id", F.log1p("predicted_price").alias("predicted_log"), "model_version"))


@plan("stream_quarantine", f"{_SCORED} SELECT listing_id, violations FROM checked WHERE violations <> ''")
def stream_quarantine(spark, sf_dir):
    bad = C.read_scores(spark, _run_scores(spark, sf_dir), "quarantine")
    return bad.select("listing_id", F.array_join("violations", "; ").alias("violations"))


def timed_events(spark, sf_dir):
    return with_event_time(stream(spark, sf_dir, "events"), "ts")


# the request log of a stream, one folder per date
@plan("stream_log", """SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS log_date, count(*) AS rows, round(avg(value), 6) AS mean_prediction,
  count(*) FILTER (WHERE value > 400) AS errors FROM events GROUP BY 1""")
def stream_log(spark, sf_dir):
    events = stream(spark, sf_dir, "events").withColumn(
        "violations", F.when(F.col("value") > 400, F.array(F.lit("value: above 400"))).otherwise(F.array().cast("array<string>")))
    log = C.prediction_log(events.withColumnRenamed("value", "predicted_price"), "ts")
    path = run_to_files(log, "log", partition_by=["log_date"])
    out = spark.read.parquet(path).groupBy(F.col("log_date").cast("string").alias("log_date"))
    return rounded(out.agg(F.count(F.lit(1)).alias("rows"), F.avg("prediction").alias("mean_prediction"), F.count("error").alias("errors")))


@plan("stream_monitor", f"""WITH w AS (SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end, value FROM events)
SELECT strftime(window_start, '%Y-%m-%d') AS day, count(*) AS rows, round(avg(value), 6) AS mean, 0.0::DOUBLE AS null_share,
  round(count(*) FILTER (WHERE value < 1 OR value > 300)::DOUBLE / count(*), 6) AS outside_share FROM w GROUP BY 1""")
def stream_monitor(spark, sf_dir):
    out = run_updates(W.monitor(timed_events(spark, sf_dir), "ts", "value", 1.0, 300.0), "monitor")
    return rounded(out.select(utc_day(F.col("window_start")).alias("day"), "rows", "mean", "null_share", "outside_share"))


EDGES = [5.0, 10.0, 20.0, 40.0, 60.0, 80.0, 120.0, 200.0]


def _psi_sql() -> str:
    cuts = [None, *EDGES, None]
    conds = [" AND ".join([f"value >= {a}"] * (a is not None) + [f"value < {b}"] * (b is not None)) for a, b in zip(cuts, cuts[1:])]
    base = ", ".join(f"greatest(count(*) FILTER (WHERE {c})::DOUBLE / count(*), 0.0001) AS q{i}" for i, c in enumerate(conds))
    now = ", ".join(f"greatest(count(*) FILTER (WHERE {c})::DOUBLE / count(*), 0.0001) AS p{i}" for i, c in enumerate(conds))
    psi = " + ".join(f"(p{i} - q{i}) * (ln(p{i}) - ln(q{i}))" for i in range(len(conds)))
    return f"""WITH base AS (SELECT {base} FROM events WHERE user_id % 2 = 0),
w AS (SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end, value FROM events),
now AS (SELECT window_start, count(*) AS rows, {now} FROM w GROUP BY 1)
SELECT strftime(window_start, '%Y-%m-%d') AS day, rows, round({psi}, 6) AS psi FROM now CROSS JOIN base"""


@plan("stream_drift", _psi_sql())
def stream_drift(spark, sf_dir):
    training = table(spark, sf_dir, "events").where(F.col("user_id") % 2 == 0)
    baseline = W.profile(training, "value", EDGES)
    out = run_updates(W.drift(timed_events(spark, sf_dir), "ts", "value", EDGES, baseline), "drift")
    return rounded(out.select(utc_day(F.col("window_start")).alias("day"), "rows", "psi"))


# every second event comes twice
@plan("stream_replays", "SELECT event_type, count(*) AS rows, round(avg(value), 6) AS mean_value FROM events GROUP BY 1")
def stream_replays(spark, sf_dir):
    copies = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("event_id") % 2))
    events = timed_events(spark, sf_dir).select("event_id", "ts", "event_type", "value", copies.alias("copy"))
    path = run_to_files(W.replays_dropped(events, ["event_id"], "ts").drop("copy"), "replays")
    out = spark.read.parquet(path).groupBy("event_type").agg(F.count(F.lit(1)).alias("rows"), F.avg("value").alias("mean_value"))
    return rounded(out)


def _late_replays(spark, sf_dir):
    """Every second event comes again 20 days later, far beyond the watermark's delay of a day."""
    copy = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("event_id") % 2))
    events = timed_events(spark, sf_dir).select("event_id", "user_id", "ts", "event_type", "value", copy.alias("copy"))
    later = F.col("ts") + F.make_dt_interval(F.col("copy").cast("int") * 20)
    return replays_dropped_for(events.withColumn("ts", later), ["event_id"], "ts", timedelta(days=40))


@plan("stream_late_replays", "SELECT event_type, count(*) AS rows, 0 AS copies, round(avg(value), 6) AS mean_value FROM events GROUP BY 1")
def stream_late_replays(spark, sf_dir):
    with keyed_state(spark):
        path = run_to_files(_late_replays(spark, sf_dir), "late-replays")
    out = spark.read.parquet(path).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("copy").cast("int").alias("copies"), F.avg("value").alias("mean_value"))
    return rounded(out)


# sessions of the first requests; the last time seen, a copy's, closes all that ended a day and the gap before it
@plan("stream_sessions", """WITH steps AS (SELECT user_id, ts, value,
  CASE WHEN ts <= lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 6 HOUR THEN 0 ELSE 1 END AS opens, event_id FROM events WHERE user_id IS NOT NULL),
runs AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM steps),
seen AS (SELECT max(CASE WHEN event_id % 2 = 1 THEN ts + INTERVAL 20 DAY ELSE ts END) AS last_seen FROM events)
SELECT user_id, epoch_us(min(ts)) AS first_at, epoch_us(max(ts)) AS last_at, count(*) AS rows, round(avg(value), 6) AS mean
FROM runs CROSS JOIN seen GROUP BY user_id, run, last_seen HAVING max(ts) + INTERVAL 6 HOUR <= last_seen - INTERVAL 1 DAY""")
def stream_sessions(spark, sf_dir):
    with keyed_state(spark):
        path = run_to_files(W.sessions(_late_replays(spark, sf_dir), "user_id", "ts", "value", "6 hours", delay=None), "sessions")
    out = spark.read.parquet(path)
    micros = [F.unix_micros(c).alias(c) for c in ("first_at", "last_at")]
    return rounded(out.where(F.col("user_id").isNotNull()).select("user_id", *micros, "rows", "mean"))
