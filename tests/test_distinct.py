"""Distinct counts from kept bitmaps."""

import datetime as dt

from pyspark.sql import functions as F

from kerbside.operators.distinct import distinct_bits, distinct_counts, distinct_words, word_counts
from kerbside.plans import rollups

IDS = [None, 0, 1, 1, -1, -32768, -32769, 32767, 32768, 32769, 65536, 65537, 2**40, -(2**40), 7]


def test_bitmaps_count_as_distinct_does(spark):
    rows = [(g, h, i) for n, i in enumerate(IDS * 3) for g, h in [("ab"[n % 2], n % 3)]]
    rows += [("none", 0, None), (None, 1, 5), (None, None, 5)]
    df = spark.createDataFrame(rows, "g string, h int, id bigint")
    bits = distinct_bits(df, ["g", "h"], "id")
    for keys in (["g", "h"], ["g"], ["h"], []):
        got = distinct_counts(bits, keys, "n").collect()
        want = df.groupBy(*keys).agg(F.count_distinct("id").alias("n")).collect()
        assert sorted(map(str, got)) == sorted(map(str, want))
    assert distinct_counts(bits.limit(0), [], "n").first()["n"] == 0


def test_hot_groups_are_combined_before_they_move(spark):
    df = spark.range(0, 300_000, 1, 6).select(F.lit("hot").alias("g"), "id")
    plan = distinct_bits(df, ["g"], "id")._jdf.queryExecution().executedPlan().toString()
    assert "partial_bitmap_construct_agg" in plan and plan.count("Exchange hashpartitioning") == 1
    assert distinct_counts(distinct_bits(df, ["g"], "id"), ["g"], "n").first()["n"] == 300_000


def test_only_changed_months_are_read_and_replaced(lake, spark):
    day = dt.date
    first = [(1, "a", day(2024, 1, 5)), (1, "a", day(2024, 2, 5)), (2, "a", day(2024, 2, 6)),
             (3, "b", day(2023, 12, 31)), (4, "b", None)]
    schema = "collision_id bigint, k string, crash_date date"
    rollups.keep_distinct(lake, "t", spark.createDataFrame(first, schema), ["k"])

    def counts(keys=("k",)):
        return {tuple(r[k] for k in (*keys, "unit", "period")): r["distinct_collisions"]
                for r in rollups.count_distinct(lake, "t", keys).collect()}

    assert counts()["a", "year", day(2024, 1, 1)] == 2 and counts()["b", "all", None] == 2
    assert counts(())["all", None] == 4 and counts()["b", "month", None] == 1
    # February has more, December's rows are gone; January's wrong row isn't read.
    later = [(9, "a", day(2024, 1, 5)), (1, "a", day(2024, 2, 5)), (5, "b", day(2024, 2, 29))]
    rollups.keep_distinct(lake, "t", spark.createDataFrame(later, schema), ["k"],
                          months=[day(2024, 2, 1), day(2023, 12, 1)])
    got = counts()
    assert got["a", "year", day(2024, 1, 1)] == 1 and got["b", "month", day(2024, 2, 1)] == 1
    assert ("b", "year", day(2023, 1, 1)) not in got and got["b", "all", None] == 2
    rollups.keep_distinct(lake, "t", spark.createDataFrame(later, schema), ["k"], months=[])
    assert counts() == got


def test_words_count_as_distinct_does(spark):
    rows = [(g, h, i) for n, i in enumerate([*IDS, 63, 64, -64, -65] * 3) for g, h in [("ab"[n % 2], n % 3)]]
    rows += [("none", 0, None), (None, 1, 5), (None, None, 5)]
    df = spark.createDataFrame(rows, "g string, h int, id bigint")
    words = distinct_words(df, ["g", "h"], "id")
    for keys in (["g", "h"], ["g"], ["h"], []):
        got = word_counts(words, keys, "n").collect()
        want = df.groupBy(*keys).agg(F.count_distinct("id").alias("n")).collect()
        assert sorted(map(str, got)) == sorted(map(str, want))
    assert word_counts(words.limit(0), [], "n").first()["n"] == 0


def test_kept_ids_are_small_rows_united_by_hashing(lake, spark):
    """Ids of a run dealt over months and groups: a bitmap each would hold one id in 4 kB, and be sorted."""
    rows = spark.range(0, 20_000, 1, 4).select(
        F.col("id").alias("collision_id"), (F.col("id") % 7).alias("k"),
        F.add_months(F.lit(dt.date(2020, 1, 1)), (F.col("id") % 11).cast("int")).alias("crash_date"),
    )
    rollups.keep_distinct(lake, "t", rows, ["k"])
    kept = lake.read_table(rollups.LAYER, "t")
    assert "binary" not in dict(kept.dtypes).values()
    plan = rollups.count_distinct(lake, "t", ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "Sort [" not in plan
    assert rollups.count_distinct(lake, "t").where("unit = 'all'").first()["distinct_collisions"] == 20_000


def test_months_in_a_row_are_one_range():
    day = dt.date
    assert rollups._ranges([day(2019, 3, 1), *[day(2020, m, 1) for m in range(11, 13)], day(2021, 1, 1)]) == [
        (day(2019, 3, 1), day(2019, 4, 1)), (day(2020, 11, 1), day(2021, 2, 1))]
    assert rollups._ranges([]) == []
