"""SQL fragments shared by the checking queries."""

from __future__ import annotations

from lotwise.functions import vocabulary as V
from lotwise.plans.registry import AS_OF_YEAR, LUXURY
from lotwise.sources.listings import RAW_WORDS

NUMBER = r"\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*"


def words(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def num(c: str) -> str:
    return f"CASE WHEN regexp_full_match({c}, '{NUMBER}') THEN TRY_CAST({c} AS DOUBLE) END"


def txt(c: str) -> str:
    return rf"lower(regexp_replace({c}, '^\s+|\s+$', '', 'g'))"


def cat(c: str) -> str:
    return f"CASE WHEN {txt(c)} NOT IN ({words(V.PLACEHOLDERS)}) THEN {txt(c)} END"


def mapped(c: str, mapping: dict[str, str]) -> str:
    whens = " ".join(f"WHEN '{r}' THEN '{v}'" for r, v in mapping.items())
    return f"CASE {c} {whens} ELSE {c} END"


def bucket(key: str, seed: int = 42, buckets: int = 100) -> str:
    return f"CAST({unit(key, seed)} % {buckets} AS INTEGER)"


def unit(key: str, seed: int = 42) -> str:
    return f"CAST(('0x' || substr(md5('{seed}:' || CAST({key} AS VARCHAR)), 1, 8)) AS BIGINT)"


def _word(column: str) -> str:
    values = RAW_WORDS[column]
    return f"([{words(values)}])[k % {len(values) + 1} + 1] AS {column}"


LISTINGS = f"""listings AS (
  SELECT k AS listing_id,
    CASE WHEN k % 22 = 5 THEN NULL ELSE o_totalprice END AS price,
    CASE WHEN k % 21 = 3 THEN NULL WHEN k % 997 = 1 THEN 'EUR' WHEN o_orderstatus = 'F' THEN ' KSh'
         WHEN o_orderstatus = 'O' THEN 'USD ' ELSE 'usd' END AS currency_code,
    CASE WHEN k % 42 = 1 THEN '0' WHEN k % 100 = 9 THEN 'n/a' WHEN k % 3001 = 7 THEN '1900'
         WHEN k % 1500 = 11 THEN '2031' ELSE CAST(year(o_orderdate) + k % 25 AS VARCHAR) END AS year_of_manufacture,
    CASE WHEN k % 24 = 2 THEN NULL WHEN k % 50 = 4 THEN '0' WHEN k % 333 = 6 THEN '12,000 km'
         ELSE CAST((k * 7919) % 250000 AS VARCHAR) END AS mileage,
    CASE WHEN k % 127 = 5 THEN NULL ELSE 'km' END AS mileage_unit,
    CASE WHEN k % 40 = 8 THEN '0' WHEN k % 4001 = 10 THEN '46008'
         ELSE CAST(660 + p_size * 60 AS VARCHAR) END AS engine_size_cc,
    CASE WHEN k % 30 = 9 THEN NULL ELSE CAST(60 + (p_size * 7) % 300 AS VARCHAR) END AS horse_power,
    CASE WHEN k % 31 = 9 THEN NULL ELSE CAST(90 + (p_size * 11) % 400 AS VARCHAR) END AS torque,
    CASE WHEN k % 32 = 9 THEN NULL ELSE CAST(50 + p_size AS DOUBLE) / 10 END AS acceleration,
    CASE WHEN k % 35 = 9 THEN NULL ELSE CAST(2 + k % 7 AS INTEGER) END AS seats,
    CASE WHEN k % 5 = 0 THEN o_totalprice * 0.04 ELSE NULL END AS annual_insurance,
    CASE WHEN k % 500 = 7 THEN 'Unknown_Placeholder' WHEN k % 77 = 1 THEN ' N/A '
         WHEN k % 1300 = 17 THEN 'Rare' || CAST(k AS VARCHAR) WHEN k % 2 = 0 THEN upper(p_brand)
         ELSE ' ' || p_brand END AS make_name,
    CASE WHEN k % 500 = 7 THEN 'Unknown_Placeholder' WHEN k % 83 = 1 THEN 'unspecified'
         WHEN k % 700 = 19 THEN 'proto ' || CAST(k AS VARCHAR) ELSE p_name END AS model_name,
    {", ".join(_word(c) for c in RAW_WORDS)},
    c_mktsegment AS source
  FROM (SELECT *, o_orderkey AS k FROM orders)
  LEFT JOIN part ON p_partkey = k % (SELECT count(*) FROM part)
  LEFT JOIN customer ON c_custkey = o_custkey)"""

_CODE = f"coalesce({txt('currency_code')}, 'ksh')"
PRICE = f"CASE WHEN {_CODE} = 'usd' THEN (1179.11::DOUBLE + 1.0445::DOUBLE * price) * 130 ELSE price END"

NUMERIC = f"""numeric_inputs AS (
  SELECT listing_id, {PRICE} AS price, nullif({num('year_of_manufacture')}, 0) AS year,
    {num('mileage')} AS mileage, nullif({num('engine_size_cc')}, 0) AS engine_size_cc,
    {num('horse_power')} AS horse_power, {num('torque')} AS torque, acceleration, CAST(seats AS DOUBLE) AS seats,
    annual_insurance
  FROM listings),
med AS (
  SELECT median(price) AS price, median(year) FILTER (WHERE year > 1950) AS year, median(mileage) AS mileage,
    median(engine_size_cc) AS engine_size_cc, median(horse_power) AS horse_power, median(torque) AS torque,
    median(acceleration) AS acceleration, median(seats) AS seats
  FROM numeric_inputs),
filled AS (
  SELECT n.listing_id, n.annual_insurance, coalesce(n.price, m.price) AS price,
    CAST(round_even(coalesce(n.year, m.year), 0) AS BIGINT) AS year, coalesce(n.mileage, m.mileage) AS mileage_num,
    coalesce(n.engine_size_cc, m.engine_size_cc) AS engine_size_cc_num,
    coalesce(n.horse_power, m.horse_power) AS horse_power_num, coalesce(n.torque, m.torque) AS torque_num,
    coalesce(n.acceleration, m.acceleration) AS acceleration_num,
    CAST(round_even(coalesce(n.seats, m.seats), 0) AS BIGINT) AS seats_num
  FROM numeric_inputs n CROSS JOIN med m),
aged AS (SELECT *, greatest({AS_OF_YEAR} - year, 0) AS car_age FROM filled),
numeric_features AS (
  SELECT listing_id, ln(1 + price) AS price_log, annual_insurance, car_age, car_age * car_age AS car_age_squared,
    mileage_num, ln(1 + mileage_num) AS mileage_log,
    CASE WHEN car_age = 0 THEN mileage_num ELSE mileage_num / (car_age + 1e-6) END AS mileage_per_year,
    engine_size_cc_num, ln(1 + engine_size_cc_num) AS engine_size_cc_log,
    horse_power_num, ln(1 + horse_power_num) AS horse_power_log, torque_num, ln(1 + torque_num) AS torque_log,
    acceleration_num, seats_num, horse_power_num / (engine_size_cc_num + 1e-6) AS power_per_cc,
    mileage_num / (engine_size_cc_num + 1e-6) AS mileage_per_cc
  FROM aged)"""

TEXT = f"""cleaned AS (
  SELECT listing_id,
    {", ".join(f"coalesce({cat(c)}, 'unknown') AS {c}" for c in
               ["make_name", "model_name", "fuel_type", "transmission", "drive_type", "body_type", "source"])},
    {cat('condition')} AS condition, {cat('usage_type')} AS usage_type
  FROM listings),
size AS (SELECT count(*) AS n FROM listings),
makes AS (SELECT make_name AS kept_make FROM cleaned GROUP BY 1
          HAVING count(*) >= (SELECT greatest(10, CAST(floor(n * 0.001) AS BIGINT)) FROM size)),
models AS (SELECT model_name AS kept_model FROM cleaned GROUP BY 1
           HAVING count(*) >= (SELECT greatest(5, CAST(floor(n * 0.0005) AS BIGINT)) FROM size)),
text_features AS (
  SELECT listing_id,
    {", ".join(f"{mapped(c, m)} AS {c}_cleaned" for c, m in V.VOCABULARY.items())},
    CASE WHEN condition IS NULL OR condition IN ({words(V.ACCIDENT_FREE)}) THEN 'Accident free'
         ELSE 'Accident involved' END AS condition_clean,
    CASE WHEN usage_type IN ({words(V.FOREIGN_USED)}) THEN 'Foreign Used' ELSE 'Kenyan Used' END AS usage_type_clean,
    coalesce(kept_make, 'other_make') AS make_name_cleaned,
    coalesce(kept_model, 'other_model') AS model_name_cleaned,
    CASE WHEN kept_make IN ({words(LUXURY)}) THEN 1 ELSE 0 END AS is_luxury_make,
    coalesce(kept_make, 'other_make') || '_' || coalesce(kept_model, 'other_model') AS make_model_cleaned
  FROM cleaned LEFT JOIN makes ON make_name = kept_make LEFT JOIN models ON model_name = kept_model)"""

FEATURES = f"""{LISTINGS}, {NUMERIC}, {TEXT},
features AS (SELECT * FROM numeric_features JOIN text_features USING (listing_id))"""

NUMERIC_COLUMNS = {  # name -> digits
    "annual_insurance": 4, "mileage_num": 4, "mileage_log": 6, "mileage_per_year": 4, "engine_size_cc_num": 4,
    "engine_size_cc_log": 6, "horse_power_num": 4, "horse_power_log": 6, "torque_num": 4, "torque_log": 6,
    "acceleration_num": 4, "power_per_cc": 6, "mileage_per_cc": 6,
}
NUMERIC_LIST = "round(price_log, 6) AS price_log, car_age, car_age_squared, seats_num, " + ", ".join(
    f"round({c}, {d}) AS {c}" for c, d in NUMERIC_COLUMNS.items())
TEXT_LIST = ("fuel_type_cleaned, transmission_cleaned, drive_type_cleaned, condition_clean, usage_type_clean, "
             "body_type_cleaned, make_name_cleaned, model_name_cleaned, is_luxury_make, make_model_cleaned")
