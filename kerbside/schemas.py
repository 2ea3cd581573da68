"""Input schemas. Text columns stay text at the scan; one lenient cast follows (`CASTS`).

The column names are fixed values: they are the feeds' own, misspellings included.
"""

from __future__ import annotations

from pyspark.sql import types as T

CRASHES = {
    "crash_date": "timestamp_ntz",
    "crash_time": "string",
    "borough": "string",
    "zip_code": "int",
    "latitude": "double",
    "longitude": "double",
    "number_of_persons_injured": "int",
    "number_of_persons_killed": "int",
    "number_of_pedestrians_injured": "int",
    "number_of_pedestrians_killed": "int",
    "number_of_cyclist_injured": "int",
    "number_of_cyclist_killed": "int",
    "number_of_motorist_injured": "int",
    "number_of_motorist_killed": "int",
    "contributing_factor_vehicle_1": "string",
    "vehicle_type_code1": "string",
    "vehicle_type_code2": "string",
    "collision_id": "bigint",
}

VEHICLES = {
    "collision_id": "bigint",
    "crash_date": "string",
    "crash_time": "string",
    "state_registration": "string",
    "vehicle_year": "int",
    "vehicle_type": "string",
    "pre_crash": "string",
    "contributing_factor_1": "string",
    "vehicle_damage": "string",
}

PERSONS = {
    "collision_id": "bigint",
    "crash_date": "string",
    "crash_time": "string",
    "person_type": "string",
    "person_injury": "string",
    "vehicle_id": "bigint",
    "person_age": "int",
    "ejection": "string",
    "emotional_status": "string",
    "bodily_injury": "string",
    "position_in_vehicle": "string",
    "safety_equipment": "string",
    "contributing_factor_1": "string",
    "contributing_factor_2": "string",
    "person_sex": "string",
}

TRAFFIC = {
    "id": "int",
    "speed": "double",
    "travel_time": "int",
    "status": "int",
    "data_as_of": "string",
    "link_id": "string",
    "link_points": "string",
    "encoded_poly_line": "string",
    "encoded_poly_line_lvls": "string",
    "owner": "string",
    "transcom_id": "string",
    "borough": "string",
    "link_name": "string",
}

TAXI = {
    "VendorID": "int",
    "tpep_pickup_datetime": "timestamp_ntz",
    "tpep_dropoff_datetime": "timestamp_ntz",
    "passenger_count": "int",
    "trip_distance": "double",
    "RatecodeID": "int",
    "store_and_fwd_flag": "string",
    "PULocationID": "int",
    "DOLocationID": "int",
    "payment_type": "int",
    "fare_amount": "double",
    "extra": "double",
    "mta_tax": "double",
    "tip_amount": "double",
    "tolls_amount": "double",
    "improvement_surcharge": "double",
    "total_amount": "double",
    "congestion_surcharge": "double",
    "airport_fee": "double",
}

# The sixteen hourly measures, in feed order.
WEATHER_MEASURES = (
    "temperature_2m",
    "relative_humidity_2m",
    "dew_point_2m",
    "apparent_temperature",
    "precipitation",
    "rain",
    "snowfall",
    "snow_depth",
    "weather_code",
    "pressure_msl",
    "surface_pressure",
    "cloud_cover",
    "wind_speed_10m",
    "wind_gusts_10m",
    "is_day",
    "sunshine_duration",
)

WEATHER = {
    "date": "string",
    "elevation": "string",
    "burrough": "string",
    "lattitude": "double",
    "longitude": "double",
    **{m: "double" for m in WEATHER_MEASURES},
}

CASTS = {
    "crashes": CRASHES,
    "vehicles": VEHICLES,
    "persons": PERSONS,
    "traffic": TRAFFIC,
    "taxi": TAXI,
    "weather": WEATHER,
}

# Names the taxi report uses for the feed's columns.
TAXI_RENAMES = {
    "VendorID": "vendor_id",
    "tpep_pickup_datetime": "pickup_datetime",
    "tpep_dropoff_datetime": "dropoff_datetime",
    "RatecodeID": "rate_code",
    "improvement_surcharge": "imp_surcharge",
    "PULocationID": "pickup_location_id",
    "DOLocationID": "dropoff_location_id",
}

# Borough coordinates used to ask for, and to tag, weather rows.
LOCATIONS = (
    ("Manhattan", 40.71, -74.00),
    ("Brooklyn", 40.67, -73.97),
    ("Queens", 40.71, -73.80),
    ("Bronx", 40.85, -73.93),
    ("Staten Island", 40.57, -74.07),
)
LOCATION_SCHEMA = "burrough string, lattitude double, longitude double"

RUN_LOG = T.StructType(
    [
        T.StructField("process_name", T.StringType(), False),
        T.StructField("process_status", T.StringType(), False),
        T.StructField("process_start_time", T.TimestampNTZType()),
        T.StructField("process_end_time", T.TimestampNTZType()),
        T.StructField("time_taken", T.DecimalType(38, 9)),
        T.StructField("last_offset_fetched", T.LongType()),
        T.StructField("last_timestamp_loaded", T.TimestampNTZType()),
        T.StructField("processed_rows", T.LongType()),
        T.StructField("insert_ts", T.TimestampNTZType(), False),
    ]
)


def text_schema(dataset: str) -> str:
    """All columns as strings: what a CSV or JSON scan of landing files reads before casting."""
    return ", ".join(f"`{c}` string" for c in CASTS[dataset])


def typed_schema(dataset: str) -> str:
    return ", ".join(f"`{c}` {t}" for c, t in CASTS[dataset].items())
