"""What the plans must and must not contain."""

import datetime as dt
import re

import pytest

from kerbside.harness import registry
from kerbside.operators.grouping import top_k_per_group
from kerbside.plans import model, reports, transforms
from pyspark.sql import functions as F

# Queries whose callable only builds a plan; the load queries also write files.
LAZY = [n for n in registry.queries() if not re.search(r"load|run_metrics|runs|roundtrip|partitioned|prod_tables", n)]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_join(spark, sf_dir, name):
    text = plan(registry.queries()[name](spark, sf_dir))
    for node in ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas", "CartesianProduct",
                 "BroadcastNestedLoopJoin"):
        assert node not in text, node


def test_scan_reads_only_needed_columns(feeds):
    prod = transforms.transform_vehicles(feeds.vehicles(), dt.date(2024, 5, 13))
    text = plan(reports.q14(prod))
    scan = re.search(r"FileScan parquet \[l_orderkey[^\]]*\]", text).group(0)
    assert "l_extendedprice" not in scan and "l_tax" not in scan


def test_year_view_filters_both_sides_at_the_scan(lake, feeds):
    weather = registry._weather(feeds)
    lake.overwrite(weather, "prod", "weather", ["year", "month"])
    lake.overwrite(registry._crashes(feeds), "prod", "crashes")
    built = model.CrashModel(lake.read_table("prod", "crashes"), registry._vehicles(feeds), registry._persons(feeds))
    text = plan(reports.q03(model.crash_weather(built, lake.read_table("prod", "weather"), 2020)))
    assert re.search(r"PartitionFilters: \[[^\]]*year#\d+ >= 2020", text)
    assert "PushedFilters: [IsNotNull(crash_date), GreaterThanOrEqual(crash_date,2020-01-01)" in text


def test_report_dates_prune_partitions(lake, feeds):
    lake.overwrite(registry._vehicles(feeds), "prod", "vehicles", ["year", "month"])
    text = plan(reports.q15(lake.read_table("prod", "vehicles")))
    assert re.search(r"PartitionFilters: \[[^\]]*year#\d+ >= 2023", text)


def test_flag_filter_reaches_the_vehicle_table(feeds):
    """A filter on a counted model goes below the joins and the counting."""
    text = plan(reports.q08(registry._model(feeds)))
    below = text[text.index("Brand#1") - 400:text.index("Brand#1")]
    assert "Filter" in below or "Project" in below
    counting = text.index("partial_count(1)")
    assert "Lost Consciousness" in text[counting:]


@pytest.mark.parametrize("name, most", [("q02", 5), ("q08", 4), ("q10", 4), ("q13", 5)])
def test_fixed_vehicle_values_cost_one_shuffle_per_side(spark, lake, feeds, name, most):
    """Vehicles and persons are shuffled once each, by the collision, and joined where they lie."""
    tables = {}
    for table in ("crashes", "vehicles", "persons"):
        lake.overwrite(getattr(registry, f"_{table}")(feeds), "prod", table)
        tables[table] = lake.read_table("prod", table)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = plan(getattr(reports, name)(model.CrashModel(*tables.values())))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(re.findall(r"Exchange (?:hash|range|Single)", text)) <= most, text


def test_top_k_limits_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), "id")
    text = plan(top_k_per_group(df, ["g"], [F.desc("id")], 2))
    assert re.search(r"WindowGroupLimit .*Final", text) and re.search(r"WindowGroupLimit .*Partial", text)


def test_band_statistics_run_once(feeds):
    df = transforms.transform_traffic(feeds.traffic())
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    computed = re.findall(r"(?<!ReusedSubquery )Subquery subquery#(\d+)", final)
    assert len(set(computed)) == 1


def test_factor_counts_are_shuffled_once_for_share_and_rank(feeds):
    df = reports.p3(registry._model(feeds))
    df.collect()
    assert "ReusedExchange" in plan(df)


def test_model_reports_never_build_the_fan_out(feeds):
    """Each side is counted per collision before the join, so at most one row per key and value meets."""
    text = plan(reports.q07(registry._model(feeds)))
    assert text.count("partial_count(1)") == 2
