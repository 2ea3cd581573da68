"""The analytical questions. Each takes prod tables, a model or a view and returns an ordered answer.

Model questions count N x M rows per collision, as the joined table would; they get there by
multiplying pre-aggregated counts (see `model.py`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import dated, in_list, known, not_in
from ..operators.eager import counted, pair_average, weighted_average
from ..operators.grouping import by_period, share_of, top_k_per_group
from .model import ROWS, Dates, DayView, Model, dated_rows

# ---- Fixed values: the categories and dates the questions name. ----

INJURED_STATES = [
    "Conscious",
    "Unconscious",
    "Semiconscious",
    "Apparent Death",
    "Shock",
    "Incoherent",
]
UNTOLD_INJURIES = ["Does Not Apply", "Unknown"]
UNTOLD_FACTORS = [
    "Pedestrian/Bicyclist/Other Pedestrian Error/Confusion",
    "Unknown",
    "Unspecified",
]
TURNING = [
    "Making Left Turn",
    "Making Right Turn on Red",
    "Making Right Turn",
    "Making Left Turn on Red",
    "Making U Turn",
]
UNTOLD_DAMAGE = ["Unknown", "Other", "No Damage"]

FATALITY_RANGE = ("2016-01-01", "2024-05-12")
HIGH_IMPACT_RANGE = ("2016-05-01", "2024-05-13")
INJURY_RANGE = ("2012-01-01", "2024-05-01")
DAMAGE_RANGE = ("2017-05-13", "2024-05-13")
STATE_RANGE = ("2023-01-01", "2024-05-13")

TOP_FACTORS = 5
MANY_INJURED = 3


def q01(weather: DataFrame) -> DataFrame:
    """Weather summary per borough and year."""
    return by_period(
        weather,
        "weather_timestamp",
        "year",
        ["burrough"],
        [
            F.sum("rain").alias("total_rainfall"),
            F.sum("snowfall").alias("total_snowfall"),
            F.max("snow_depth").alias("max_snow_depth"),
            F.avg("wind_gusts_10m").alias("avg_wind_gusts"),
            F.avg("wind_speed_10m").alias("avg_wind_speed"),
            F.avg("pressure_msl").alias("avg_pressure_msl"),
            F.avg("dew_point_2m").alias("avg_dew_point"),
            F.avg("relative_humidity_2m").alias("avg_rel_humidity"),
        ],
        output="weather_year",
    ).orderBy(F.desc("weather_year"), "burrough")


def q02(
    model: Model, dates: tuple[str, str] = FATALITY_RANGE, distinct: bool = False
) -> DataFrame:
    """High-impact crashes per month, borough and fatality.

    Here and below, `distinct` counts every collision once, not once per vehicle and person.
    """
    rows = model.counted(
        "crash_date", "borough", "was_fatal",
        vehicles_where=in_list(F.col("high_impact_crash"), ["Yes"]), distinct=distinct, dates=dates,
    )
    return by_period(
        rows, "crash_date", "month", ["borough", "was_fatal"], [_total("collisions")], "crash_month"
    ).orderBy(F.desc("collisions"))


def q03(view: DayView) -> DataFrame:
    """Vehicles involved per year and type."""
    return (
        view.counted("crash_date", "vehicle_type")
        .groupBy(F.year("crash_date").alias("year"), "vehicle_type")
        .agg(_total("total"))
    )


def q04(view: DayView) -> DataFrame:
    """Fatal crashes per snow class, rain class and borough."""
    columns = ["snowfall_category", "rainfall_category", "borough"]
    return (
        view.counted(*columns, "was_fatal")
        .filter(in_list(F.col("was_fatal"), [True]))
        .groupBy(*columns)
        .agg(_total("total_collisions"))
    )


def q05(persons: DataFrame) -> DataFrame:
    """Distinct collisions per injury, emotional status and age class."""
    told = in_list(F.col("emotional_status"), INJURED_STATES) & known(
        F.col("bodily_injury"), UNTOLD_INJURIES
    )
    return (
        persons.filter(told)
        .groupBy("bodily_injury", "emotional_status", "age_category")
        .agg(F.count_distinct("collision_id").alias("distinct_collisions"))
    )


def q06(view: DayView) -> DataFrame:
    """Contributing factors named for persons, most frequent first."""
    factor = "person_contributing_factor_1"
    return (
        view.counted(factor)
        .filter(F.col(factor).isNotNull() & not_in(F.col(factor), UNTOLD_FACTORS))
        .groupBy(factor)
        .agg(_total("collisions"))
        .orderBy(F.desc("collisions"), factor)
    )


def q07(model: Model, distinct: bool = False) -> DataFrame:
    """Persons killed per year and borough."""
    killed = "number_of_persons_killed"
    return by_period(
        model.counted("crash_date", "borough", killed, distinct=distinct),
        "crash_date",
        "year",
        ["borough"],
        [F.sum(F.col(killed) * F.col(ROWS)).alias("persons_killed")],
        "crash_year",
    ).orderBy(F.desc("persons_killed"))


def q08(
    model: Model, dates: tuple[str, str] = HIGH_IMPACT_RANGE, distinct: bool = False
) -> DataFrame:
    """High-impact crashes per month."""
    rows = model.counted(
        "crash_date", vehicles_where=in_list(F.col("high_impact_crash"), ["Yes"]), distinct=distinct, dates=dates
    )
    return by_period(rows, "crash_date", "month", [], [_total("collisions")], "crash_month")


def q09(
    model: Model, dates: tuple[str, str] = INJURY_RANGE, distinct: bool = False
) -> DataFrame:
    """Persons injured per month."""
    injured = "number_of_persons_injured"
    rows = model.counted("crash_date", injured, distinct=distinct, dates=dates)
    total = F.sum(F.col(injured) * F.col(ROWS)).alias("persons_injured")
    return by_period(rows, "crash_date", "month", [], [total], "crash_month")


def q10(model: Model) -> DataFrame:
    """Distinct high-impact collisions while turning: one row, zero when there are none."""
    turning = in_list(F.col("high_impact_crash"), ["Yes"]) & in_list(F.col("pre_crash"), TURNING)
    return model.counted("collision_id", vehicles_where=turning).agg(
        F.count_distinct("collision_id").alias("distinct_collisions")
    )


def q11(persons: DataFrame) -> DataFrame:
    """Cases per person type and known age class."""
    return (
        persons.filter(not_in(F.col("age_category"), ["Unknown"]))
        .groupBy("person_type", "age_category")
        .agg(F.count("collision_id").alias("total_cases"))
        .orderBy(F.desc("total_cases"))
    )


def q12(traffic: DataFrame) -> DataFrame:
    """Average speed per week (from Sunday), week part and speed band."""
    return by_period(
        traffic,
        "crash_timestamp",
        "week",
        ["week_part", "speed_band"],
        [F.avg("speed").alias("avg_speed")],
        "week_start",
    ).orderBy(F.desc("avg_speed"))


def q13(model: Model, only_yes: bool = False, distinct: bool = False) -> DataFrame:
    """Crash rows per year and borough that carry a high-impact flag, be it Yes or No.

    `only_yes` counts the high-impact ones alone.
    """
    flag = F.col("high_impact_crash")
    counts = (flag == "Yes") if only_yes else flag.isNotNull()
    return by_period(
        model.counted("crash_date", "borough", vehicles_when=counts, distinct=distinct),
        "crash_date",
        "year",
        ["borough"],
        [_total("flagged")],
        "crash_year",
    ).orderBy(F.desc("flagged"))


def q14(vehicles: DataFrame, dates: tuple[str, str] = DAMAGE_RANGE) -> DataFrame:
    """Pre-crash action against vehicle damage."""
    return (
        vehicles.filter(
            dated(vehicles, "crash_date", *dates)
            & not_in(F.col("vehicle_damage"), UNTOLD_DAMAGE)
        )
        .groupBy("pre_crash", "vehicle_damage")
        .agg(F.count("collision_id").alias("occurrences"))
    )


def q15(vehicles: DataFrame, dates: tuple[str, str] = STATE_RANGE) -> DataFrame:
    """High-impact crashes per state of registration."""
    return (
        vehicles.filter(
            not_in(F.col("state_registration"), ["Unknown"])
            & dated(vehicles, "crash_date", *dates)
            & in_list(F.col("high_impact_crash"), ["Yes"])
        )
        .groupBy("state_registration")
        .agg(F.count("collision_id").alias("collisions"))
    )


def p1(view: DayView, distinct: bool = False) -> DataFrame:
    """Crash rows, temperature and wind per borough (as written) and crash date."""
    days = view.paired(["borough", "crash_date"], ["temperature_2m", "wind_speed_10m"], distinct)
    return days.groupBy("borough", "crash_date").agg(
        _crashes("total_crashes", distinct),
        pair_average(F.col("_model"), "temperature_2m").alias("average_temperature"),
        pair_average(F.col("_model"), "wind_speed_10m").alias("average_wind_speed"),
    )


def p2(view: DayView, distinct: bool = False) -> DataFrame:
    """Crash rows and traffic speed per crash date."""
    return (
        view.paired(["crash_date"], ["speed"], distinct)
        .groupBy("crash_date")
        .agg(
            _crashes("total_crashes", distinct),
            pair_average(F.col("_model"), "speed").alias("average_speed"),
        )
    )


def p3(model: Model, k: int = TOP_FACTORS, distinct: bool = False) -> DataFrame:
    """The k most frequent vehicle factors per borough, with their percentage of the borough.

    With `distinct` a collision counts once for each factor its vehicles name.
    """
    factor = "vehicle_contributing_factor"
    rows = model.counted("borough", factor, distinct=distinct)
    counts = rows.groupBy("borough", factor).agg(_total("total_crashes"))
    top = top_k_per_group(counts, ["borough"], [F.desc("total_crashes"), F.asc(factor)], k)
    return (
        share_of(top, "total_crashes", ["borough"], of=counts)
        .select(
            "borough",
            factor,
            "total_crashes",
            F.round(F.col("share") * 100, 2).alias("percentage_of_total"),
            "rank",
        )
        .orderBy("borough", "rank")
    )


def p4(view: DayView, vehicles: DataFrame | None = None) -> DataFrame:
    """Vehicle age per borough and vehicle type, overall and in severe crashes, with the weather.

    The vehicles are joined to the model a second time (on collision and date), so the type and age
    are theirs, and every model row of the collision counts once per such vehicle. Without `vehicles` they
    are the model's own, which are then read once for both.
    """
    crash_columns = ["borough", "number_of_persons_injured", "number_of_persons_killed"]
    own = ["vehicle_type", "vehicle_year"]
    if vehicles is None:
        met = view.model.with_vehicles([view.place, *crash_columns], own)
    else:
        key = ["collision_id", "crash_date"]
        crashes = view.model.counted(*key, view.place, *crash_columns)
        repeated = counted(vehicles.select(*key, *own), [*key, *own], "_again")
        met = crashes.join(repeated, key).withColumn(ROWS, F.col(ROWS) * F.col("_again"))
    aged = met.select(
        view.place,
        "crash_date",
        "borough",
        "vehicle_type",
        (F.year("crash_date") - F.col("vehicle_year")).alias("vehicle_age"),
        (F.col("number_of_persons_injured") >= MANY_INJURED).alias("many_injured"),
        (F.col("number_of_persons_killed") > 0).alias("fatal"),
        ROWS,
    )
    collapsed = DayView(
        _Prepared(aged), view.side, view.side_place, view.side_day, view.side_columns,
        view.year, view.place,
    ).paired(
        ["borough", "vehicle_type", "vehicle_age", "many_injured", "fatal"],
        ["temperature_2m", "wind_speed_10m"],
    )
    weight = F.col("_model") * F.col("_side")
    age = F.col("vehicle_age")
    overall = weighted_average(weight, age)
    return (
        collapsed.groupBy("borough", "vehicle_type")
        .agg(
            overall.alias("average_vehicle_age"),
            weighted_average(weight, F.when(F.col("many_injured"), age)).alias(
                "average_vehicle_age_high_impact"
            ),
            overall.alias("average_vehicle_age_by_type"),
            weighted_average(weight, F.when(F.col("fatal"), age)).alias(
                "average_vehicle_age_with_fatalities"
            ),
            pair_average(F.col("_model"), "temperature_2m").alias("average_temperature"),
            pair_average(F.col("_model"), "wind_speed_10m").alias("average_wind_speed"),
        )
        .orderBy("borough", "vehicle_type")
    )


class _Prepared:
    """Already counted rows, in the shape `DayView` expects of a model."""

    def __init__(self, counts: DataFrame):
        self._counts = counts

    def counted(self, *columns: str, dates: Dates | None = None) -> DataFrame:
        return dated_rows(self._counts, dates).select(*columns, ROWS)


def _total(name: str):
    return F.sum(ROWS).alias(name)


def _crashes(name: str, distinct: bool):
    """Joined rows, or the collisions that have any."""
    return F.sum(F.col("_model") if distinct else F.col("_model") * F.col("_side")).alias(name)
