"""Bands, slices, series, ranking and the hot-key join."""

import datetime as dt
import math
import statistics
from collections import Counter

import pytest
from pyspark.sql import functions as F

from kerbside.operators import bands, grouping, joins, slices
from kerbside.plans.transforms import SPEED_BAND, TRAVEL_TIME_BAND

DAY = dt.datetime(2024, 1, 1)


def test_band_edges(spark):
    speeds = [10.0, 20.0, 30.0, 40.0, 50.0, None]
    mean, sd = statistics.mean(speeds[:-1]), statistics.stdev(speeds[:-1])
    df = spark.createDataFrame([(i, s, s) for i, s in enumerate(speeds)], "i int, speed double, travel_time double")
    got = {r["i"]: (r["speed_band"], r["travel_time_category"])
           for r in bands.add_bands(df, [SPEED_BAND, TRAVEL_TIME_BAND]).collect()}
    for i, s in enumerate(speeds[:-1]):
        want = ("Low", "Quick") if s < mean - sd else ("High", "Slow") if s > mean + sd else ("Average", "Normal")
        assert got[i] == want
    assert got[5] == ("High", "Normal")


def test_band_exactly_on_the_upper_edge(spark):
    # Mean 1, sample deviation exactly 1: the value 2 sits on the edge.
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,)], "speed double").withColumn("travel_time", F.col("speed"))
    got = {r["speed"]: (r["speed_band"], r["travel_time_category"])
           for r in bands.add_bands(df, [SPEED_BAND, TRAVEL_TIME_BAND]).collect()}
    assert got == {0.0: ("Average", "Normal"), 1.0: ("Average", "Normal"), 2.0: ("High", "Normal")}


def test_band_of_one_row_has_no_deviation(spark):
    df = spark.createDataFrame([(5.0, 5.0)], "speed double, travel_time double")
    row = bands.add_bands(df, [SPEED_BAND, TRAVEL_TIME_BAND]).first()
    assert (row["speed_band"], row["travel_time_category"]) == ("High", "Normal")
    assert bands.band_stats(df, ["speed"]).first().asDict() == {"mean_speed": 5.0, "stddev_speed": None}


def test_bands_partition_the_table(feeds):
    from kerbside.plans.transforms import transform_traffic

    prod = transform_traffic(feeds.traffic())
    counts = prod.groupBy("speed_band").count().collect()
    assert {r["speed_band"] for r in counts} == {"Low", "Average", "High"}
    assert sum(r["count"] for r in counts) == prod.count()


def test_time_slice_bounds(spark):
    stamps = [DAY, DAY + dt.timedelta(days=3), DAY + dt.timedelta(days=7), DAY + dt.timedelta(days=7, seconds=1)]
    df = spark.createDataFrame([(s,) for s in stamps], "ts timestamp_ntz")

    def kept(**options):
        return sorted(r["ts"] for r in slices.time_slice(df, "ts", DAY, 7, **options).collect())

    assert kept() == stamps[:3]
    assert kept(closed="left") == stamps[:2]
    both = slices.time_slices(df, "ts", DAY, 7, "w").collect()
    assert sorted((r["w"], r["ts"]) for r in both) == [
        (0, stamps[0]), (0, stamps[1]), (0, stamps[2]), (1, stamps[2]), (1, stamps[3])]
    left = slices.time_slices(df, "ts", DAY, 7, "w", "left").collect()
    assert sorted((r["w"], r["ts"]) for r in left) == [
        (0, stamps[0]), (0, stamps[1]), (1, stamps[2]), (1, stamps[3])]
    with pytest.raises(ValueError):
        slices.time_slice(df, "ts", DAY, 7, closed="right")


def test_left_slices_tile(feeds):
    events = feeds.table("events").select("event_id", "ts")
    start = dt.datetime(2024, 1, 1)
    got = Counter()
    for w in range(5):
        window = slices.time_slice(events, "ts", start + dt.timedelta(days=7 * w), 7, closed="left")
        got.update(r["event_id"] for r in window.collect())
    assert set(got.values()) == {1} and len(got) == events.count()


def test_month_bounds():
    assert slices.month_bounds(dt.datetime(2024, 12, 31, 5)) == (dt.datetime(2024, 12, 1), dt.datetime(2025, 1, 1))
    assert slices.month_bounds(dt.datetime(2024, 1, 1)) == (dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1))


LOG = "process_name string, process_status string, insert_ts timestamp_ntz, last_timestamp_loaded timestamp_ntz"


@pytest.mark.parametrize(
    "runs,want",
    [
        ([], None),
        ([("p", "Failure", 1, 1), ("q", "Success", 2, 2)], None),
        ([("p", "success", 1, 1)], None),
        ([("p", "Success", 1, 1), ("p", "Success", 2, None)], None),
        ([("p", "Success", 1, 1), ("p", "Success", 3, 3), ("p", "Failure", 4, 4)], 3),
    ],
)
def test_resume_point(spark, runs, want):
    default = dt.datetime(2012, 7, 1)

    def at(days):
        return None if days is None else DAY + dt.timedelta(days=days)

    log = spark.createDataFrame([(p, s, at(i), at(last)) for p, s, i, last in runs], LOG)
    assert [r[0] for r in slices.resume_point(log, "p", default).collect()] == [at(want) or default]
    if any(p == "p" for p, *_ in runs):
        points = {r["process_name"]: r["resume_from"] for r in slices.resume_points(log, default).collect()}
        assert points["p"] == (at(want) or default)


SERIES = "site string, start timestamp_ntz, end timestamp_ntz, step int, a array<double>, b array<int>"


def test_expand_series(spark):
    df = spark.createDataFrame(
        [
            ("x", DAY, DAY + dt.timedelta(hours=3), 3600, [1.0, 2.0, 3.0], None),
            ("half", DAY, DAY + dt.timedelta(minutes=90), 3600, [1.0, 2.0], [1, 2]),
            ("empty", DAY, DAY, 3600, [], []),
            ("null", None, DAY, 3600, [], None),
        ],
        SERIES,
    )
    rows = slices.expand_series(df, "start", "end", "step", ["a", "b"], "ts").collect()
    got = {(r["site"], r["ts"]): (r["a"], r["b"]) for r in rows}
    assert got == {
        ("x", DAY): (1.0, None),
        ("x", DAY + dt.timedelta(hours=1)): (2.0, None),
        ("x", DAY + dt.timedelta(hours=2)): (3.0, None),
        ("half", DAY): (1.0, 1),
        ("half", DAY + dt.timedelta(hours=1)): (2.0, 2),
    }


@pytest.mark.parametrize("values", [[1.0], [1.0, 2.0, 3.0], []])
def test_series_of_another_length_is_an_error(spark, values):
    df = spark.createDataFrame([("x", DAY, DAY + dt.timedelta(hours=2), 3600, values, [1, 2])], SERIES)
    with pytest.raises(Exception, match="series with other than 2 values"):
        slices.expand_series(df, "start", "end", "step", ["a", "b"], "ts").collect()


def test_top_k_breaks_ties_by_name(spark):
    df = spark.createDataFrame([("a", f, 5) for f in "zyx"] + [("b", "w", 1)], "g string, f string, n int")
    top = grouping.top_k_per_group(df, ["g"], [F.desc("n"), F.asc("f")], 2)
    assert sorted((r["g"], r["rank"], r["f"]) for r in top.collect()) == [
        ("a", 1, "x"), ("a", 2, "y"), ("b", 1, "w"),
    ]


def test_share_adds_up_and_keeps_null_groups(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), (None, 5)], "g string, n int")
    shares = [(r["g"], r["n"], r["share"]) for r in grouping.share_of(df, "n", ["g"]).collect()]
    assert sorted(shares, key=str) == sorted([("a", 1, 0.25), ("a", 3, 0.75), (None, 5, 1.0)], key=str)


def test_by_period_refuses_the_source_name(spark):
    with pytest.raises(ValueError):
        grouping.by_period(spark.range(1), "ts", "year", [], [F.count("*")], "ts")


def skewed(spark, n, seed):
    """A third of the rows on one key, some null keys, many exact copies."""
    key = F.when(F.col("id") % 3 == 0, F.lit(1)).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.col("id") % 40)
    return spark.range(n).select(key.alias("k"), (F.col("id") * seed % 17).alias(f"v{seed}"))


@pytest.mark.parametrize("rows", [1, 7, 50, 150, 10_000])
def test_split_join_is_the_plain_join(spark, monkeypatch, rows):
    monkeypatch.setattr(joins, "PACK", 3)
    left, right = skewed(spark, 600, 5), skewed(spark, 300, 7)
    want = Counter(map(tuple, left.join(right, ["k"]).collect()))
    got = Counter(map(tuple, joins.split_join(left, right, ["k"], rows=rows).collect()))
    assert got == want and sum(want.values()) > 0


def test_hot_key_is_dealt_evenly(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"), "id")
    other = spark.range(3_010).select(F.when(F.col("id") < 10, F.col("id")).otherwise(1).alias("k"))
    grid = joins.hot_grid(joins.key_counts(df, ["k"]), joins.key_counts(other, ["k"]), ["k"], 1000)
    # Key 1 holds 10,001 and 3,001 rows: eleven rows and four columns of cells.
    assert grid.collect() == [(1, 11, 4)]
    cells = joins.deal(df, grid, ["k"], joins.ROWS, "copies").groupBy(joins.ROW).count().collect()
    assert len(cells) == 11 and max(r["count"] for r in cells) < 1300
    assert joins.cold(df, grid, ["k"]).count() == 30_000 - 10_001


def test_hotness_is_judged_on_pairs(spark):
    counts = {"a": (10, 10), "b": (11, 10), "c": (1000, 1), "d": (1, 101), "e": (30, 40), "f": (5, 0)}
    left = spark.createDataFrame([(k, n) for k, (n, _) in counts.items()], "k string, n bigint")
    right = spark.createDataFrame([(k, m) for k, (_, m) in counts.items() if m], "k string, n bigint")
    grid = {r["k"]: (r[joins.ROWS], r[joins.COLUMNS]) for r in joins.hot_grid(left, right, ["k"], 10).collect()}
    assert grid == {"b": (2, 1), "c": (10, 1), "d": (1, 2), "e": (3, 4)}


@pytest.mark.parametrize("rows", [2, 1000])
def test_both_paths_keep_every_bit(spark, rows):
    import math
    import struct

    values = [0.0, -0.0, -0.0, math.nan, math.inf, -math.inf, None, 1.5, 1.5]
    left = spark.createDataFrame([("k", v) for v in values] * 3, "k string, a double")
    right = spark.createDataFrame([("k", v) for v in values], "k string, b float")

    def bits(v):
        return v if v is None or v != v else struct.pack("d", v)

    got = Counter((bits(r["a"]) if r["a"] == r["a"] else "nan", bits(r["b"]) if r["b"] == r["b"] else "nan")
                  for r in joins.split_join(left, right, ["k"], rows=rows).collect())
    one = Counter("nan" if v is not None and v != v else bits(v) for v in values)
    assert got == Counter({(x, y): 3 * n * m for x, n in one.items() for y, m in one.items()})


def test_columns_that_cannot_be_dealt_are_refused_at_any_size(spark):
    odd = spark.createDataFrame([("k", {"x": 1})], "k string, m map<string,int>")
    for rows in (1, 1000):
        with pytest.raises(ValueError):
            joins.split_join(odd, odd.select("k"), ["k"], rows=rows)


def test_copies_of_one_row_are_dealt_evenly(spark, monkeypatch):
    monkeypatch.setattr(joins, "PACK", 10)
    df = spark.range(5000).select(F.lit(1).alias("k"), F.lit("same").alias("v"))
    grid = joins.hot_grid(joins.key_counts(df, ["k"]), joins.key_counts(df, ["k"]), ["k"], 1000)
    dealt = joins.deal(df, grid, ["k"], joins.ROWS, "copies")
    per_cell = dealt.groupBy(joins.ROW).agg(F.sum("copies").alias("n")).collect()
    assert len(per_cell) == 5 and sum(r["n"] for r in per_cell) == 5000
    assert max(r["n"] for r in per_cell) < 1500


def test_sample_deviation_is_used(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,)], "x double")
    assert math.isclose(bands.band_stats(df, ["x"]).first()["stddev_x"], statistics.stdev([1.0, 2.0, 4.0]))
