"""The reports as plain row joins, in Spark: the yardstick `bench.py --naive` times.

Nothing else uses these plans. They build every N x M model row and every (borough, day) pair.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.plans import model

ROWS = model.ROWS


def unified(crashes: DataFrame, vehicles: DataFrame, persons: DataFrame) -> DataFrame:
    v = vehicles.select(
        "collision_id", *[F.col(c).alias(n) for n, c in model.VEHICLE_SIDE.items()]
    )
    p = persons.select(
        "collision_id", *[F.col(c).alias(n) for n, c in model.PERSON_SIDE.items()]
    )
    return (
        model.standardize_boroughs(crashes).join(v, "collision_id").join(p, "collision_id")
    )


class RowModel:
    """A model whose every question runs over the joined rows."""

    def __init__(self, table: DataFrame):
        self.table = table

    def counted(self, *columns: str) -> DataFrame:
        return self.table.select(*columns, F.lit(1).cast("bigint").alias(ROWS))


class RowView:
    """A day view whose every question runs over the joined rows."""

    def __init__(self, table: DataFrame, side: DataFrame, place: str, day: str, columns: list[str]):
        kept = side.select(F.col(place).alias("_place"), F.col(day).alias("_day"), *columns)
        on = (F.col("standardized_borough") == F.col("_place")) & (F.col("crash_date") == F.col("_day"))
        self.table = table.join(kept, on)

    def counted(self, *columns: str) -> DataFrame:
        return self.table.select(*columns, F.lit(1).cast("bigint").alias(ROWS))


def p1(view: RowView) -> DataFrame:
    return view.table.groupBy("borough", "crash_date").agg(
        F.count("collision_id").alias("total_crashes"),
        F.avg("temperature_2m").alias("average_temperature"),
        F.avg("wind_speed_10m").alias("average_wind_speed"),
    )


def p2(view: RowView) -> DataFrame:
    return view.table.groupBy("crash_date").agg(
        F.count("collision_id").alias("total_crashes"), F.avg("speed").alias("average_speed")
    )


def p4(view: RowView, vehicles: DataFrame) -> DataFrame:
    rows = view.table.select(
        "collision_id", "crash_date", "borough", "number_of_persons_injured",
        "number_of_persons_killed", "temperature_2m", "wind_speed_10m",
    )
    again = vehicles.select("collision_id", "crash_date", "vehicle_type", "vehicle_year")
    age = F.year("crash_date") - F.col("vehicle_year")
    return rows.join(again, ["collision_id", "crash_date"]).groupBy("borough", "vehicle_type").agg(
        F.avg(age).alias("average_vehicle_age"),
        F.avg(F.when(F.col("number_of_persons_injured") >= 3, age)).alias(
            "average_vehicle_age_high_impact"
        ),
        F.avg(F.when(F.col("number_of_persons_killed") > 0, age)).alias(
            "average_vehicle_age_with_fatalities"
        ),
        F.avg("temperature_2m").alias("average_temperature"),
        F.avg("wind_speed_10m").alias("average_wind_speed"),
    )
