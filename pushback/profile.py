"""Flight profile: column names and constants every operator defaults to.

Operators take these as keyword defaults so another table shape can pass its
own names. The lists below are fixed values that must equal the reference
behaviour for results to match; they are stated in the reference's order.
"""

from __future__ import annotations

# --- fixed values: labels -------------------------------------------------
TARGET = "DELAY_CATEGORY"
CLASS_ORDER = ["on_time", "minor_delay", "major_delay", "cancelled"]
# misclassification penalty by true class
MISCLASS_COST = {"on_time": 0.5, "minor_delay": 5.0, "major_delay": 8.0, "cancelled": 10.0}
# target bins, closed on the right: <=15 on_time, <=45 minor, >45 major
ON_TIME_MAX_DELAY = 15
MINOR_DELAY_MAX_DELAY = 45
RANDOM_STATE = 42

# --- fixed values: enriched flight schema (55 columns) ------------------------
BTS_COLUMNS = [
    "YEAR", "MONTH", "DAY", "DAY_OF_WEEK", "AIRLINE", "FLIGHT_NUMBER", "TAIL_NUMBER",
    "ORIGIN_AIRPORT", "DESTINATION_AIRPORT", "SCHEDULED_DEPARTURE", "DEPARTURE_TIME",
    "DEPARTURE_DELAY", "TAXI_OUT", "WHEELS_OFF", "SCHEDULED_TIME", "ELAPSED_TIME",
    "AIR_TIME", "DISTANCE", "WHEELS_ON", "TAXI_IN", "SCHEDULED_ARRIVAL", "ARRIVAL_TIME",
    "ARRIVAL_DELAY", "DIVERTED", "CANCELLED", "CANCELLATION_REASON", "AIR_SYSTEM_DELAY",
    "SECURITY_DELAY", "AIRLINE_DELAY", "LATE_AIRCRAFT_DELAY", "WEATHER_DELAY",
]
HOUR_COLUMNS = ["departure_hour", "scheduled_arrival_hour"]
WEATHER_FIELDS = [
    "temperature_c", "precipitation_mm", "rain_mm", "snowfall_cm", "wind_speed_kmh",
    "wind_direction_deg", "wind_gusts_kmh", "cloud_cover_pct", "weather_code",
    "relative_humidity_pct", "pressure_msl_hpa",
]
DEST_PREFIX = "dest_"
EXPECTED_COLUMNS = (BTS_COLUMNS + HOUR_COLUMNS + WEATHER_FIELDS
                    + [DEST_PREFIX + c for c in WEATHER_FIELDS])

# hourly API arrays -> weather field names
WEATHER_API_FIELDS = {
    "temperature_2m": "temperature_c",
    "precipitation": "precipitation_mm",
    "rain": "rain_mm",
    "snowfall": "snowfall_cm",
    "wind_speed_10m": "wind_speed_kmh",
    "wind_direction_10m": "wind_direction_deg",
    "wind_gusts_10m": "wind_gusts_kmh",
    "cloud_cover": "cloud_cover_pct",
    "weather_code": "weather_code",
    "relative_humidity_2m": "relative_humidity_pct",
    "pressure_msl": "pressure_msl_hpa",
}

# integer columns (pandas int64/int32) and string columns (object) of the schema check
INTEGER_COLUMNS = ["YEAR", "MONTH", "DAY", "DAY_OF_WEEK", "FLIGHT_NUMBER",
                   "SCHEDULED_DEPARTURE", "SCHEDULED_ARRIVAL", "DISTANCE", "DIVERTED",
                   "CANCELLED"]
STRING_COLUMNS = ["AIRLINE", "TAIL_NUMBER", "ORIGIN_AIRPORT", "DESTINATION_AIRPORT",
                  "CANCELLATION_REASON"]

# --- fixed values: validation --------------------------------------------------
COLUMN_RANGES = {
    "MONTH": (1, 12), "DAY": (1, 31), "DAY_OF_WEEK": (1, 7),
    "SCHEDULED_DEPARTURE": (0, 2359), "SCHEDULED_ARRIVAL": (0, 2359),
    "DISTANCE": (1, 10000), "DIVERTED": (0, 1), "CANCELLED": (0, 1),
    "departure_hour": (0, 23), "scheduled_arrival_hour": (0, 23),
    "temperature_c": (-60, 60), "precipitation_mm": (0, 500), "rain_mm": (0, 500),
    "snowfall_cm": (0, 200), "wind_speed_kmh": (0, 400), "wind_gusts_kmh": (0, 400),
    "cloud_cover_pct": (0, 100), "relative_humidity_pct": (0, 100),
    "pressure_msl_hpa": (850, 1100),
    "dest_temperature_c": (-60, 60), "dest_precipitation_mm": (0, 500),
    "dest_rain_mm": (0, 500), "dest_snowfall_cm": (0, 200),
    "dest_wind_speed_kmh": (0, 400), "dest_wind_gusts_kmh": (0, 400),
    "dest_cloud_cover_pct": (0, 100), "dest_relative_humidity_pct": (0, 100),
    "dest_pressure_msl_hpa": (850, 1100),
}
EXPECTED_NULLS = [
    "CANCELLATION_REASON", "AIR_SYSTEM_DELAY", "SECURITY_DELAY", "AIRLINE_DELAY",
    "LATE_AIRCRAFT_DELAY", "WEATHER_DELAY", "DEPARTURE_TIME", "DEPARTURE_DELAY",
    "TAXI_OUT", "WHEELS_OFF", "ELAPSED_TIME", "AIR_TIME", "WHEELS_ON", "TAXI_IN",
    "ARRIVAL_TIME", "ARRIVAL_DELAY",
]
FLIGHT_KEYS = ["AIRLINE", "FLIGHT_NUMBER", "MONTH", "DAY"]
OUTLIER_CHECK_COLUMNS = [
    "DISTANCE", "SCHEDULED_TIME", "ARRIVAL_DELAY", "DEPARTURE_DELAY", "TAXI_OUT",
    "TAXI_IN", "AIR_TIME", "temperature_c", "precipitation_mm", "wind_speed_kmh",
    "wind_gusts_kmh", "dest_temperature_c", "dest_precipitation_mm",
    "dest_wind_speed_kmh", "dest_wind_gusts_kmh",
]
IQR_FENCE = 1.5
IATA_PATTERN = "^[A-Z]{3}$"
VALID_CANCELLATION_REASONS = ["A", "B", "C", "D"]
EXPECTED_YEAR = 2015
ELAPSED_TOLERANCE_MIN = 5
CATEGORICAL_COLUMNS = ["AIRLINE", "ORIGIN_AIRPORT", "DESTINATION_AIRPORT",
                       "CANCELLATION_REASON", "DAY_OF_WEEK", "MONTH"]
SUMMARY_COLUMNS = [
    "DISTANCE", "SCHEDULED_TIME", "ARRIVAL_DELAY", "DEPARTURE_DELAY", "TAXI_OUT",
    "TAXI_IN", "AIR_TIME", "temperature_c", "precipitation_mm", "wind_speed_kmh",
    "wind_gusts_kmh", "cloud_cover_pct", "relative_humidity_pct", "pressure_msl_hpa",
    "dest_temperature_c", "dest_wind_speed_kmh",
]

# --- fixed values: cleaning ------------------------------------------------------
LEAKAGE_COLUMNS = [
    "FLIGHT_NUMBER", "TAIL_NUMBER", "DEPARTURE_TIME", "ARRIVAL_TIME", "WHEELS_OFF",
    "WHEELS_ON", "ELAPSED_TIME", "AIR_TIME", "TAXI_OUT", "TAXI_IN", "ARRIVAL_DELAY",
    "AIR_SYSTEM_DELAY", "SECURITY_DELAY", "AIRLINE_DELAY", "LATE_AIRCRAFT_DELAY",
    "WEATHER_DELAY",
]
CAPPED_COLUMNS = [
    "DISTANCE", "SCHEDULED_TIME", "TAXI_OUT", "TAXI_IN", "AIR_TIME", "temperature_c",
    "precipitation_mm", "wind_speed_kmh", "wind_gusts_kmh", "dest_temperature_c",
    "dest_precipitation_mm", "dest_wind_speed_kmh", "dest_wind_gusts_kmh",
]
CAP_LOWER_Q = 0.01
CAP_UPPER_Q = 0.99
NULLABLE_AFTER_CLEANING = ["CANCELLATION_REASON"]

# --- fixed values: features --------------------------------------------------------
NON_PREDICTIVE_COLUMNS = ["DIVERTED", "CANCELLATION_REASON"]
FREQUENCY_COLUMNS = ["ORIGIN_AIRPORT", "DESTINATION_AIRPORT", "AIRLINE"]
HISTORICAL_KEYS = {
    "AIRLINE": "airline",
    "ORIGIN_AIRPORT": "origin_airport",
    "DESTINATION_AIRPORT": "destination_airport",
    "ROUTE": "route",
}
INTERACTION_HISTORICAL_KEYS = {
    "AIRLINE_DEPARTURE_BANK": "airline_departure_bank",
    "ORIGIN_AIRPORT_DEPARTURE_BANK": "origin_departure_bank",
    "ORIGIN_AIRPORT_DAY_OF_WEEK": "origin_day_of_week",
    "AIRLINE_ROUTE": "airline_route",
    "ROUTE_DEPARTURE_BANK": "route_departure_bank",
    "ROUTE_DAY_OF_WEEK": "route_day_of_week",
}
HISTORICAL_SMOOTHING = 25.0
# rate name -> labels counted as 1 ("delay" is everything but on_time)
HISTORICAL_RATES = {
    "historical_delay_rate": ["minor_delay", "major_delay", "cancelled"],
    "historical_on_time_rate": ["on_time"],
    "historical_minor_delay_rate": ["minor_delay"],
    "historical_severe_rate": ["major_delay"],
    "historical_major_delay_rate": ["major_delay"],
    "historical_cancelled_rate": ["cancelled"],
}
PEAK_BANKS = {"is_morning_peak_bank": (6, 9), "is_evening_peak_bank": (16, 19)}
DEPARTURE_BANK_BOUNDS = [0, 6, 10, 14, 18, 22, 24]
DEPARTURE_BANK_LABELS = ["overnight", "morning", "midday", "afternoon", "evening",
                         "late_night"]
WEATHER_INTENSITY_THRESHOLDS = {
    "precipitation_mm": 2.0, "rain_mm": 2.0, "snowfall_cm": 0.0,
    "wind_speed_kmh": 25.0, "wind_gusts_kmh": 40.0,
}
FREEZING_C = 0.0
DEFAULT_MIN_MUTUAL_INFO = 0.001
HIST_GRADIENT_MODES = ["hist_gradient_boosting", "hierarchical_hist_gradient_boosting"]
TEST_SIZE = 0.2
SAMPLE_FRACTION = 0.02

# --- fixed values: time zones -------------------------------------------------------
EASTERN_TZ = "America/New_York"

# --- fixed values: model selection ----------------------------------------------------
SELECTION_METRICS = ["balanced_accuracy", "cost"]
TOP_TRIALS = 5
