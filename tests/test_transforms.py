"""Raw to prod, dataset by dataset, on rows the test tables cannot show."""

import datetime as dt

from pyspark.sql import functions as F

from kerbside.plans import transforms as t
from kerbside.schemas import CASTS, TAXI, WEATHER


def raw(spark, dataset, rows):
    """Rows given as dicts; columns left out are null."""
    schema = ", ".join(f"`{c}` {kind}" for c, kind in CASTS[dataset].items())
    return spark.createDataFrame([tuple(r.get(c) for c in CASTS[dataset]) for r in rows], schema)


def test_crashes(spark):
    rows = [
        {"collision_id": 1, "crash_date": dt.datetime(2024, 5, 1), "number_of_persons_killed": 2,
         "vehicle_type_code1": "Sedan", "vehicle_type_code2": "Taxi", "borough": "BRONX"},
        {"collision_id": 2, "number_of_persons_killed": 0, "vehicle_type_code1": "Sedan"},
        {"collision_id": 3},
    ]
    out = {r["collision_id"]: r for r in t.transform_crashes(raw(spark, "crashes", rows)).collect()}
    assert len(out) == 3  # undated crashes stay
    assert [out[i]["was_fatal"] for i in (1, 2, 3)] == [True, False, False]
    assert [out[i]["total_vehicles_involved"] for i in (1, 2, 3)] == [2, 1, 0]
    assert (out[1]["year"], out[1]["month"], out[1]["day"]) == (2024, 5, 1)
    # Presence is judged before the fill, which then touches only text.
    assert out[3]["vehicle_type_code1"] == "Unknown" and out[3]["vehicle_type_code1_involved"] == 0
    assert out[3]["zip_code"] is None and out[3]["crash_date"] is None


def test_persons(spark):
    rows = [
        {"collision_id": 1, "crash_date": "2024-01-06 00:00:00.000000 UTC", "crash_time": "5:59",
         "person_age": 17, "person_injury": "Killed"},
        {"collision_id": 2, "crash_date": None},
        {"collision_id": 3, "crash_date": "unreadable"},
    ]
    out = {r["collision_id"]: r for r in t.transform_persons(raw(spark, "persons", rows)).collect()}
    assert set(out) == {1, 3}  # only the missing date drops the row
    one = out[1]
    assert (one["part_of_day"], one["weekday_weekend"], one["age_category"], one["injury_severity"]) == (
        "Night", "Weekend", "<18", 5)
    assert one["year_month_ts"] == dt.date(2024, 1, 1)
    assert (out[3]["part_of_day"], out[3]["weekday_weekend"], out[3]["crash_date"]) == ("Evening", "Weekday", None)


def test_partition_date_by_year(spark):
    rows = [{"collision_id": 1, "crash_date": "2024-05-06"}]
    as_of = dt.date(2024, 5, 13)
    by_year = t.transform_vehicles(raw(spark, "vehicles", rows), as_of, partition_unit="year")
    assert by_year.first()["year_month_ts"] == dt.date(2024, 1, 1)
    by_month = t.transform_vehicles(raw(spark, "vehicles", rows), as_of)
    assert by_month.first()["year_month_ts"] == dt.date(2024, 5, 1)


def test_vehicles(spark):
    rows = [
        {"collision_id": 1, "crash_date": "2024-01-07T00:00:00.000", "crash_time": "18:00",
         "vehicle_year": 2015, "contributing_factor_1": "Lost Consciousness"},
        {"collision_id": 2, "crash_date": "2024-01-05"},
        {"collision_id": 3},
    ]
    out = {r["collision_id"]: r for r in
           t.transform_vehicles(raw(spark, "vehicles", rows), dt.date(2024, 5, 13)).collect()}
    assert set(out) == {1, 2}
    assert (out[1]["weekend"], out[1]["part_of_day"], out[1]["vehicle_age_category"], out[1]["high_impact_crash"]) == (
        "Yes", "Evening", "5-9 years", "Yes")
    # The flag looks at the missing factor before it is filled, and the factor is renamed.
    assert (out[2]["high_impact_crash"], out[2]["contributing_factor"]) == ("No", "Unknown")


def test_traffic(spark):
    rows = [
        {"id": i, "speed": float(s), "travel_time": 10 * i, "data_as_of": stamp}
        for i, (s, stamp) in enumerate([
            (10, "2024-01-06T05:59:59.000"), (20, "2024-01-05T12:00:00.000"), (30, "2024-01-05T18:00:00.000"),
            (500, "n/a"), (500, None)])
    ]
    out = {r["id"]: r for r in t.transform_traffic(raw(spark, "traffic", rows)).collect()}
    assert set(out) == {0, 1, 2}  # unreadable times drop the row
    # ... and before the statistics: 500 does not move the mean of 20. Exactly mean+sd is High.
    assert [out[i]["speed_band"] for i in range(3)] == ["Average", "Average", "High"]
    assert [out[i]["travel_time_category"] for i in range(3)] == ["Normal"] * 3
    assert [out[i]["time_slot"] for i in range(3)] == ["Late Night", "Afternoon", "Evening"]
    assert [out[i]["week_part"] for i in range(3)] == ["Weekend", "Weekday", "Weekday"]
    assert out[0]["hour"] == 5 and out[0]["crash_timestamp"] == dt.date(2024, 1, 6)
    assert out[0]["day_of_week"] == 7 and out[0]["year_month_ts"] == dt.date(2024, 1, 1)


def test_weather(spark):
    rows = [
        {"date": "2024-01-06 05:00:00+00:00", "burrough": "Bronx", "elevation": "10.0 m asl",
         "lattitude": 40.123456, "longitude": -73.98765, "temperature_2m": -0.004, "pressure_msl": 1013.25,
         "wind_speed_10m": 20.0, "relative_humidity_2m": 50.0, "rain": 0.0},
        {"date": "2024-01-06 06:00:00+00:00", "burrough": "Bronx", "elevation": "n/a", "temperature_2m": -0.006,
         "pressure_msl": 1013.26, "wind_speed_10m": 20.1, "relative_humidity_2m": 49.9, "rain": 9.0},
        {"date": "2024-01-06 07:00:00+00:00"},
        {"burrough": "Queens"},
    ]
    out = {r["hour_of_day"]: r for r in t.transform_weather(raw(spark, "weather", rows)).collect()}
    assert set(out) == {5, 6, 7}
    a, b, none = out[5], out[6], out[7]
    assert (a["lattitude"], a["longitude"], a["elevation_m"]) == (40.1235, -73.9877, 10.0)
    assert b["elevation_m"] is None and b["elevation"] == "n/a" and none["elevation"] == "Unknown"
    # The class looks at the rounded temperature.
    assert (a["temperature_2m"], a["temperature_category"]) == (0.0, "Above Freezing")
    assert (b["temperature_2m"], b["temperature_category"]) == (-0.01, "Below Freezing")
    assert [r["pressure_condition"] for r in (a, b, none)] == ["Low Pressure", "High Pressure", "Low Pressure"]
    assert [r["wind_intensity"] for r in (a, b, none)] == ["Low Wind", "High Wind", "Low Wind"]
    assert [r["humidity_range"] for r in (a, b, none)] == ["High Humidity", "Low Humidity", "High Humidity"]
    assert none["temperature_category"] == "Above Freezing"
    assert none["rainfall_category"] == "Moderate Rainfall"
    assert a["weather_timestamp"] == dt.datetime(2024, 1, 6, 5) and a["date"] == dt.date(2024, 1, 6)
    assert len(t.WEATHER_COLUMNS) == 17 and set(t.WEATHER_COLUMNS) < set(WEATHER)


def test_taxi(spark):
    start = dt.datetime(2019, 3, 1)
    rows = [
        {"VendorID": 1, "RatecodeID": 6, "payment_type": 2, "store_and_fwd_flag": "Y",
         "tpep_pickup_datetime": start, "tpep_dropoff_datetime": start + dt.timedelta(seconds=90)},
        {"VendorID": 9, "RatecodeID": None, "payment_type": 0,
         "tpep_pickup_datetime": start, "tpep_dropoff_datetime": start - dt.timedelta(seconds=90)},
    ]
    source = raw(spark, "taxi", rows)
    a, b = t.transform_taxi(source).orderBy("vendor_name").collect()
    assert (a["vendor_name"], a["rate_description"], a["payment_method"], a["is_store_and_forward"],
            a["trip_duration_minutes"]) == ("Creative Mobile Technologies, LLC", "Group ride", "Cash", True, 1)
    assert (b["vendor_name"], b["rate_description"], b["payment_method"], b["is_store_and_forward"],
            b["trip_duration_minutes"]) == ("Other", "Unknown rate code", "Other", None, -1)
    assert (a["data_file_year"], a["data_file_month"]) == (2019, 3)
    # A month the loader tagged wins over the pickup's.
    tagged = source.withColumns({"data_file_year": F.lit(2020), "data_file_month": F.lit(1)})
    assert t.transform_taxi(tagged).first()["data_file_year"] == 2020
    assert TAXI["congestion_surcharge"] == "double"
