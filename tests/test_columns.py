"""Null and boundary branches of the column functions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from kerbside.functions import clean, derive, predicates
from kerbside.plans import transforms as t
from kerbside.plans.model import BOROUGH_ALIASES


def values(spark, kind, rows, expr):
    """`expr` of a single column `c` of type `kind`, in row order."""
    df = spark.createDataFrame(list(enumerate(rows)), f"i int, c {kind}")
    return [r[0] for r in df.select(expr(F.col("c")).alias("out"), "i").orderBy("i").collect()]


def test_positive_flag(spark):
    assert values(spark, "int", [None, 0, 1], derive.is_positive) == [False, False, True]


def test_presence_sum(spark):
    df = spark.createDataFrame([(0, None, None), (1, "a", None), (2, "a", "b")], "i int, x string, y string")
    out = df.select("i", derive.presence_sum([F.col("x"), F.col("y")]).alias("n")).orderBy("i")
    assert [r["n"] for r in out.collect()] == [0, 1, 2]


def test_age_classes(spark):
    got = values(
        spark, "int", [None, 17, 18, 24, 25, 34, 35, 44, 45, 54, 55, 64, 65],
        lambda c: derive.bucketize(c, t.AGE_LIMITS, t.AGE_DEFAULT, null_label="Unknown"),
    )
    assert got == [
        "Unknown", "<18", "18-24", "18-24", "25-34", "25-34", "35-44", "35-44", "45-54", "45-54",
        "55-64", "55-64", "65+",
    ]


def test_vehicle_age_classes(spark):
    got = values(
        spark, "int", [None, 2030, 2020, 2019, 2015, 2014],
        lambda c: derive.bucketize(
            derive.age_in_years(dt.date(2024, 5, 13), c),
            t.VEHICLE_AGE_LIMITS, t.VEHICLE_AGE_DEFAULT, null_label="Unknown",
        ),
    )
    assert got == ["Unknown", "0-4 years", "0-4 years", "5-9 years", "5-9 years", "10+ years"]


def test_day_parts(spark):
    got = values(
        spark, "string", ["5:59", "6:00", "11:59", "12:00", "18:00", None, "25:99", "noon"],
        lambda c: derive.bucketize(clean.clock_hour(c), t.DAY_PART_LIMITS, t.DAY_PART_DEFAULT),
    )
    assert got == [
        "Night", "Morning", "Morning", "Afternoon", "Evening", "Evening", "Evening", "Evening",
    ]


def test_time_slots(spark):
    got = values(
        spark, "int", [0, 5, 6, 11, 12, 17, 18, 23, None],
        lambda c: derive.slot(c, t.TIME_SLOTS, t.TIME_SLOT_DEFAULT),
    )
    assert got == [
        "Late Night", "Late Night", "Morning", "Morning", "Afternoon", "Afternoon", "Evening",
        "Evening", "Evening",
    ]


def test_weekend(spark):
    days = [dt.date(2024, 1, 5), dt.date(2024, 1, 6), dt.date(2024, 1, 7), None]
    got = values(spark, "date", days, lambda c: derive.weekend_flag(c, "Yes", "No"))
    assert got == ["No", "Yes", "Yes", "No"]


def test_high_impact(spark):
    got = values(
        spark, "string", [*t.HIGH_IMPACT_FACTORS, "Fatigue", None],
        lambda c: derive.flag_in(c, t.HIGH_IMPACT_FACTORS),
    )
    assert got == ["Yes", "Yes", "No", "No"]


def test_severity(spark):
    got = values(
        spark, "string", ["Killed", "Injured", "Not Injured", "Unspecified", "Fine", None],
        lambda c: derive.score(c, t.SEVERITY_RULES, 0),
    )
    assert got == [5, 3, 3, 1, 0, 0]


def test_canonical_names(spark):
    got = values(
        spark, "string", ["KINGS", "bx", "Richmond County", "NY", "Elsewhere", None],
        lambda c: derive.canonicalize(c, BOROUGH_ALIASES),
    )
    assert got == ["Brooklyn", "Bronx", "Staten Island", "Manhattan", "Elsewhere", None]


@pytest.mark.parametrize("kind,codes", [("int", [1, 6, 99, None]), ("string", ["1", "6", "99", None])])
def test_decode(spark, kind, codes):
    got = values(spark, kind, codes, lambda c: derive.decode(c, t.RATES, t.RATE_DEFAULT))
    assert got == ["Standard rate", "Group ride", "Unknown rate code", "Unknown rate code"]


def test_yes_flag(spark):
    assert values(spark, "string", ["Y", "N", None], derive.is_yes) == [True, False, None]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_minutes_between(spark, zone):
    start = dt.datetime(2024, 3, 10, 1, 30)  # the hour after is skipped in New York
    ends = [start + dt.timedelta(seconds=s) for s in (90, -90, 59, 7200)]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = values(
            spark, "timestamp_ntz", ends, lambda c: derive.minutes_between(predicates.ntz(start), c)
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [1, -1, 0, 120]


def test_periods(spark):
    days = [dt.date(2020, 1, 5), dt.date(2020, 1, 4), None]
    assert values(spark, "date", days, lambda c: derive.period(c, "week")) == [
        dt.date(2020, 1, 5), dt.date(2019, 12, 29), None,
    ]
    assert values(spark, "date", days, lambda c: derive.period(c, "month"))[0] == dt.date(2020, 1, 1)
    with pytest.raises(ValueError):
        derive.period(F.lit(None), "decade")


def test_first_number(spark):
    texts = ["10.0 m asl", "n/a", None, "about 7 m", "3."]
    assert values(spark, "string", texts, clean.first_number) == [10.0, None, None, 7.0, 3.0]


def test_parse_timestamp(spark):
    day = dt.datetime(2024, 1, 5, 10, 11, 12)
    texts = [
        "2024-01-05T10:11:12",
        "2024-01-05T10:11:12.123",
        "2024-01-05 10:11:12.000000 UTC",
        "2024-01-05 10:11:12+00:00",
        "2024-01-05",
        "05.01.2024 10:11",
        "junk",
        None,
    ]
    got = values(spark, "string", texts, lambda c: clean.parse_timestamp(c, ["dd.MM.yyyy HH:mm"]))
    assert got == [
        day, day.replace(microsecond=123000), day, day, dt.datetime(2024, 1, 5),
        dt.datetime(2024, 1, 5, 10, 11), None, None,
    ]


def test_every_fixed_pattern_is_parsed(spark):
    """The ISO cast alone reads what each of the feeds' patterns writes."""
    written = {
        clean.ISO_SECONDS: "2024-01-05T10:11:12",
        clean.ISO_MILLIS: "2024-01-05T10:11:12.000",
        clean.MICROS_WITH_ZONE: "2024-01-05 10:11:12.000000 UTC",
        clean.PLAIN_DATE: "2024-01-05",
    }
    assert set(written) == set(clean.DATE_PATTERNS)
    got = values(spark, "string", list(written.values()), clean.parse_date)
    assert got == [dt.date(2024, 1, 5)] * 4


def test_cast_columns(spark):
    df = spark.createDataFrame([("7", "a"), ("x", "b"), (None, "c"), ("", "d"), ("3.0", "e")], "n string, k string")
    types = {"n": "int", "absent": "double"}
    cast, missing = clean.cast_columns(df, types)
    assert missing == ["absent"]
    assert dict(cast.dtypes) == {"n": "int", "k": "string"}
    assert {r["k"]: r["n"] for r in cast.collect()} == {"a": 7, "b": None, "c": None, "d": None, "e": 3}
    assert df.agg(*clean.bad_value_counts(df, types)).first().asDict() == {"bad_n": 1}


def test_conform_adds_missing_as_null(spark):
    out, missing = clean.conform(spark.createDataFrame([("7",)], "n string"), {"n": "int", "x": "double"})
    assert missing == ["x"] and out.dtypes == [("n", "int"), ("x", "double")]
    assert out.first().asDict() == {"n": 7, "x": None}


def test_fill_unknown_leaves_other_types(spark):
    df = spark.createDataFrame([(None, None)], "s string, n int")
    assert clean.fill_unknown(df).first().asDict() == {"s": "Unknown", "n": None}


def test_predicates_drop_nulls(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "c string")

    def kept(cond):
        return [r["c"] for r in df.filter(cond).collect()]

    assert kept(predicates.not_in(F.col("c"), ["a"])) == ["b"]
    assert kept(predicates.known(F.col("c"), ["a"])) == ["b"]
    assert kept(predicates.in_list(F.col("c"), ["a"])) == ["a"]
    assert kept(predicates.like(F.col("c"), "%b%")) == ["b"]


def test_date_range_is_half_open(spark):
    days = [dt.date(2019, 12, 31), dt.date(2020, 1, 1), dt.date(2020, 12, 31), dt.date(2021, 1, 1)]
    df = spark.createDataFrame([(d, d.year) for d in days], "d date, year int")
    for cond in (
        predicates.in_year(F.col("d"), 2020),
        predicates.dated_in_year(df, "d", 2020),
        predicates.dated(df, "d", "2020-01-01", "2021-01-01"),
    ):
        assert sorted(r["d"] for r in df.filter(cond).collect()) == days[1:3]


def test_between_includes_both_ends_and_drops_nulls(spark):
    df = spark.createDataFrame([(1,), (5,), (9,), (None,)], "n int")
    assert df.filter(predicates.between(F.col("n"), 1, 5)).count() == 2
