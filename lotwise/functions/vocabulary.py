"""Word lists, lookup tables and constants that results depend on."""

from __future__ import annotations

# ---- fixed values: missing-value tokens a CSV reader turns into NULL -----------------------------
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# ---- fixed values: placeholder words for "no value" after strip and lower ------------------------
PLACEHOLDERS = [
    "nan", "na", "n/a", "-", "", "unknown", "unspecified",
    "other", "others", "none", "null", "undefined",
]

# ---- fixed values: synonym vocabularies, raw -> canonical ----------------------------------------
FUEL = {
    "petroleum": "petrol",
    "hybrid(petrol)": "hybrid_petrol",
    "petrol hybrid": "hybrid_petrol",
    "hybrid": "hybrid_petrol",
    "hybrid(diesel)": "hybrid_diesel",
    "diesel hybrid": "hybrid_diesel",
    "plug-in hybrid(petrol)": "plugin_hybrid_petrol",
}
TRANSMISSION = {
    "at": "automatic",
    "mt": "manual", "4mt": "manual", "5mt": "manual", "6mt": "manual", "7mt": "manual",
    "duonic": "automated_manual", "smoother": "automated_manual", "proshift": "automated_manual",
}
DRIVE = {
    "ff": "2wd_front", "fwd": "2wd_front",
    "fr": "2wd_rear", "rwd": "2wd_rear",
    "mr": "2wd_mid_engine", "rr": "2wd_rear_engine",
    "04-feb": "unknown",
}
# optional extra rows that fold every two-wheel variant into one value
DRIVE_COLLAPSED = {
    "2wd_front": "2wd", "2wd_rear": "2wd", "2wd_mid_engine": "2wd", "2wd_rear_engine": "2wd",
}
BODY = {
    "saloon": "sedan",
    "van": "van_minivan", "minivan": "van_minivan", "mini van": "van_minivan",
    "station wagon": "wagon_estate", "estate": "wagon_estate",
    "mini suv": "suv",
    "double cab": "pickup_truck", "pick up": "pickup_truck", "pickups": "pickup_truck",
    "pickup truck": "pickup_truck", "truck": "pickup_truck",
    "buses and vans": "bus",
    "coupes": "coupe",
    "truck wing": "special_purpose_truck",
}
VOCABULARY = {
    "fuel_type": FUEL,
    "transmission": TRANSMISSION,
    "drive_type": DRIVE,
    "body_type": BODY,
}

# ---- fixed values: recode lists ------------------------------------------------------------------
ACCIDENT_FREE = [
    "foreign used", "excellent", "very good", "4.5", "locally used", "5", "ready for import",
    "6", "new", "4", "5.0", "6.0", "4.0",
]
FOREIGN_USED = ["foreign used", "new", "ready for import", "brand new"]
KENYAN_USED = ["kenyan used", "locally used", "used"]

# ordinal scale for physical condition: grade or adjective -> rank, higher is better
CONDITION_RANK = {
    "new": 6.0, "6": 6.0, "excellent": 5.0, "5": 5.0, "very good": 4.5, "4.5": 4.5,
    "4": 4.0, "average": 3.0, "below average": 2.0,
}

# ---- fixed values: luxury makes ------------------------------------------------------------------
LUXURY_MAKES = [
    "mercedes_benz", "bmw", "audi", "porsche", "lexus", "land_rover", "jaguar", "bentley",
    "ferrari", "lamborghini", "maserati", "rolls_royce", "aston_martin", "mclaren", "bugatti",
    "alfa_romeo",
]

# ---- fixed values: currency (code -> intercept, slope, rate): (intercept + slope * price) * rate --
RATES = {"usd": (1179.11, 1.0445, 130.0)}
# codes taken as already converted; NULL is read as the text "nan"
SILENT_CODES = ["usd", "ksh", "nan"]

# ---- fixed values: request-time defaults ---------------------------------------------------------
REQUEST_DEFAULTS = {
    "horse_power_num": 100.0, "torque_num": 150.0, "acceleration_num": 12.0, "seats_num": 5.0,
}

PLACEHOLDER_NAME = "Unknown_Placeholder"
RUNTIME_MISSING = "missing_value_runtime"
