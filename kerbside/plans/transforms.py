"""Raw to prod: one lazy DataFrame function per dataset. Writing is the caller's single action."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clean import (
    cast_columns,
    clock_hour,
    fill_unknown,
    first_number,
    parse_date,
    parse_timestamp,
    rounded,
)
from ..functions.derive import (
    age_in_years,
    bucketize,
    date_parts,
    decode,
    flag_in,
    is_positive,
    is_yes,
    minutes_between,
    period,
    presence_sum,
    present,
    score,
    slot,
    weekend_flag,
)
from ..operators.bands import Band, add_bands
from ..schemas import TAXI_RENAMES

# ---- Fixed values: labels, limits and codes the reports group and filter by. ----

DAY_PART_LIMITS = [(6, "Night"), (12, "Morning"), (18, "Afternoon")]
DAY_PART_DEFAULT = "Evening"

TIME_SLOTS = [(0, 5, "Late Night"), (6, 11, "Morning"), (12, 17, "Afternoon")]
TIME_SLOT_DEFAULT = "Evening"

AGE_LIMITS = [
    (18, "<18"),
    (25, "18-24"),
    (35, "25-34"),
    (45, "35-44"),
    (55, "45-54"),
    (65, "55-64"),
]
AGE_DEFAULT = "65+"

VEHICLE_AGE_LIMITS = [(5, "0-4 years"), (10, "5-9 years")]
VEHICLE_AGE_DEFAULT = "10+ years"

HIGH_IMPACT_FACTORS = ["Lost Consciousness", "Driver Inattention/Distraction"]

SEVERITY_RULES = [("Killed", 5), ("%Injured%", 3), ("Unspecified", 1)]

SPEED_BAND = Band("speed", "speed_band", "Low", "Average", "High", inclusive_top=True)
TRAVEL_TIME_BAND = Band("travel_time", "travel_time_category", "Quick", "Normal", "Slow")

WEATHER_BANDS = [
    Band("rain", "rainfall_category", "Low Rainfall", "Moderate Rainfall", "High Rainfall"),
    Band("snowfall", "snowfall_category", "Low Snowfall", "Moderate Snowfall", "High Snowfall"),
    Band("wind_gusts_10m", "wind_gusts_category", "Low Gusts", "Moderate Gusts", "High Gusts"),
]

FREEZING = 0
HUMID = 50
STANDARD_PRESSURE = 1013.25
WINDY = 20

VENDORS = {1: "Creative Mobile Technologies, LLC", 2: "VeriFone Inc."}
VENDOR_DEFAULT = "Other"
RATES = {
    1: "Standard rate",
    2: "JFK",
    3: "Newark",
    4: "Nassau or Westchester",
    5: "Negotiated fare",
    6: "Group ride",
}
RATE_DEFAULT = "Unknown rate code"
PAYMENTS = {
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}
PAYMENT_DEFAULT = "Other"

# ---- Column lists kept by each transform (fixed values). ----

CRASH_COLUMNS = [
    "crash_date",
    "borough",
    "zip_code",
    "latitude",
    "longitude",
    "number_of_persons_injured",
    "number_of_persons_killed",
    "number_of_pedestrians_injured",
    "number_of_cyclist_injured",
    "number_of_motorist_injured",
    "contributing_factor_vehicle_1",
    "vehicle_type_code1",
    "vehicle_type_code2",
    "collision_id",
]
PERSON_COLUMNS = [
    "collision_id",
    "crash_date",
    "crash_time",
    "person_type",
    "person_injury",
    "vehicle_id",
    "person_age",
    "ejection",
    "emotional_status",
    "bodily_injury",
    "position_in_vehicle",
    "safety_equipment",
    "contributing_factor_1",
    "contributing_factor_2",
    "person_sex",
]
VEHICLE_COLUMNS = [
    "collision_id",
    "crash_date",
    "crash_time",
    "state_registration",
    "vehicle_year",
    "vehicle_type",
    "pre_crash",
    "contributing_factor_1",
    "vehicle_damage",
]
WEATHER_COLUMNS = [
    "date",
    "elevation",
    "burrough",
    "lattitude",
    "longitude",
    "temperature_2m",
    "relative_humidity_2m",
    "dew_point_2m",
    "apparent_temperature",
    "rain",
    "snowfall",
    "snow_depth",
    "pressure_msl",
    "wind_speed_10m",
    "sunshine_duration",
    "cloud_cover",
    "wind_gusts_10m",
]


def transform_crashes(raw: DataFrame) -> DataFrame:
    """Date parts, fatality flag and vehicle presence counts. Undated crashes are kept."""
    codes = ["vehicle_type_code1", "vehicle_type_code2"]
    dated = raw.select(*CRASH_COLUMNS).withColumn("crash_date", parse_date(F.col("crash_date")))
    enriched = date_parts(
        dated, "crash_date", {"year": "year", "month": "month", "day": "day"}
    ).withColumns(
        {
            "was_fatal": is_positive(F.col("number_of_persons_killed")),
            **{f"{c}_involved": present(F.col(c)) for c in codes},
            "total_vehicles_involved": presence_sum([F.col(c) for c in codes]),
        }
    )
    return fill_unknown(enriched)


def transform_persons(raw: DataFrame, partition_unit: str = "month") -> DataFrame:
    """Day part, week part, age class and injury severity of dated rows."""
    dated = (
        raw.select(*PERSON_COLUMNS)
        .filter(F.col("crash_date").isNotNull())
        .withColumn("crash_date", parse_date(F.col("crash_date")))
    )
    parts = date_parts(_with_hour(dated), "crash_date", {"year": "year", "month": "month"})
    enriched = parts.withColumns(
        {
            "part_of_day": _day_part(),
            "weekday_weekend": weekend_flag(F.col("crash_date"), "Weekend", "Weekday"),
            "age_category": bucketize(
                F.col("person_age"), AGE_LIMITS, AGE_DEFAULT, null_label="Unknown"
            ),
            "injury_severity": score(F.col("person_injury"), SEVERITY_RULES, 0),
            "year_month_ts": period(F.col("crash_date"), partition_unit),
        }
    )
    return fill_unknown(enriched.drop("_hour"))


def transform_vehicles(
    raw: DataFrame, as_of: dt.date, partition_unit: str = "month"
) -> DataFrame:
    """Day part, weekend flag, vehicle age class as of a date, and the high-impact flag."""
    dated = (
        raw.select(*VEHICLE_COLUMNS)
        .filter(F.col("crash_date").isNotNull())
        .withColumn("crash_date", parse_date(F.col("crash_date")))
    )
    age = age_in_years(as_of, F.col("vehicle_year"))
    parts = {"year": "year", "month": "month", "day": "day"}
    enriched = (
        date_parts(_with_hour(dated), "crash_date", parts)
        .withColumns(
            {
                "part_of_day": _day_part(),
                "weekend": weekend_flag(F.col("crash_date"), "Yes", "No"),
                "vehicle_age_category": bucketize(
                    age, VEHICLE_AGE_LIMITS, VEHICLE_AGE_DEFAULT, null_label="Unknown"
                ),
                "high_impact_crash": flag_in(F.col("contributing_factor_1"), HIGH_IMPACT_FACTORS),
                "year_month_ts": period(F.col("crash_date"), partition_unit),
            }
        )
        .withColumnRenamed("contributing_factor_1", "contributing_factor")
    )
    return fill_unknown(enriched.drop("_hour"))


def transform_traffic(raw: DataFrame) -> DataFrame:
    """Speed and travel-time bands, time slot and week part of readings with a readable time.

    The hour comes from the reading's timestamp; `crash_timestamp` is its date, the join key.
    """
    typed, _ = cast_columns(raw, {"speed": "double", "travel_time": "int"})
    dated = (
        typed.withColumn("data_as_of", parse_timestamp(F.col("data_as_of")))
        .filter(F.col("data_as_of").isNotNull())
        .withColumn("crash_timestamp", F.col("data_as_of").cast("date"))
    )
    parts = date_parts(
        dated,
        "data_as_of",
        {"year": "year", "month": "month", "day_of_week": "dayofweek", "hour": "hour"},
    )
    banded = add_bands(parts, [SPEED_BAND, TRAVEL_TIME_BAND])
    enriched = banded.withColumns(
        {
            "time_slot": slot(F.col("hour"), TIME_SLOTS, TIME_SLOT_DEFAULT),
            "week_part": weekend_flag(F.col("crash_timestamp"), "Weekend", "Weekday"),
            "year_month_ts": period(F.col("crash_timestamp"), "month"),
        }
    )
    return fill_unknown(enriched)


def transform_weather(raw: DataFrame, partition_unit: str = "month") -> DataFrame:
    """Calendar parts, banded rain, snow and gusts, cleaned place columns, threshold classes.

    Carries both the timestamp and its date: joins use the date.
    """
    dated = (
        raw.select(*WEATHER_COLUMNS)
        .filter(F.col("date").isNotNull())
        .withColumnRenamed("date", "weather_timestamp")
        .withColumn("weather_timestamp", parse_timestamp(F.col("weather_timestamp")))
        .withColumn("date", F.col("weather_timestamp").cast("date"))
    )
    parts = date_parts(
        dated,
        "weather_timestamp",
        {"year": "year", "month": "month", "day": "day", "hour_of_day": "hour"},
    )
    parts = parts.withColumn("temperature_2m", rounded(F.col("temperature_2m"), 2))
    temperature = F.col("temperature_2m")
    enriched = add_bands(parts, WEATHER_BANDS).withColumns(
        {
            "lattitude": rounded(F.col("lattitude"), 4),
            "longitude": rounded(F.col("longitude"), 4),
            "elevation_m": first_number(F.col("elevation")),
            "temperature_category": F.when(temperature < FREEZING, "Below Freezing").otherwise(
                "Above Freezing"
            ),
            "humidity_range": F.when(
                F.col("relative_humidity_2m") < HUMID, "Low Humidity"
            ).otherwise("High Humidity"),
            "pressure_condition": F.when(
                F.col("pressure_msl") > STANDARD_PRESSURE, "High Pressure"
            ).otherwise("Low Pressure"),
            "wind_intensity": F.when(F.col("wind_speed_10m") > WINDY, "High Wind").otherwise(
                "Low Wind"
            ),
            "year_month_ts": period(F.col("date"), partition_unit),
        }
    )
    return fill_unknown(enriched)


def transform_taxi(raw: DataFrame) -> DataFrame:
    """Decoded vendor, rate and payment, boolean flag and trip minutes, in one projection."""
    df = raw.withColumnsRenamed(TAXI_RENAMES)
    file_month = {
        name: F.col(name) if name in df.columns else part(F.col("pickup_datetime"))
        for name, part in (("data_file_year", F.year), ("data_file_month", F.month))
    }
    return df.select(
        decode(F.col("vendor_id"), VENDORS, VENDOR_DEFAULT).alias("vendor_name"),
        "pickup_datetime",
        "dropoff_datetime",
        minutes_between(F.col("pickup_datetime"), F.col("dropoff_datetime")).alias(
            "trip_duration_minutes"
        ),
        "passenger_count",
        "trip_distance",
        decode(F.col("rate_code"), RATES, RATE_DEFAULT).alias("rate_description"),
        is_yes(F.col("store_and_fwd_flag")).alias("is_store_and_forward"),
        decode(F.col("payment_type"), PAYMENTS, PAYMENT_DEFAULT).alias("payment_method"),
        "fare_amount",
        "extra",
        "mta_tax",
        "tip_amount",
        "tolls_amount",
        "imp_surcharge",
        "airport_fee",
        "total_amount",
        "pickup_location_id",
        "dropoff_location_id",
        *[col.alias(name) for name, col in file_month.items()],
    )


def _with_hour(df: DataFrame) -> DataFrame:
    """The crash hour as a column of its own, so that the day part's limits share one parse."""
    return df.withColumn("_hour", clock_hour(F.col("crash_time")))


def _day_part() -> Column:
    return bucketize(F.col("_hour"), DAY_PART_LIMITS, DAY_PART_DEFAULT)
