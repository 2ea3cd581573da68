"""Batch, incremental and streaming loads, the tables and the run log."""

import datetime as dt
import json
import re

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from kerbside.harness.adapters import Feeds
from kerbside.operators import bands
from kerbside.plans import loads, transforms
from kerbside.schemas import RUN_LOG, text_schema
from kerbside.session import local_scratch, scratch_dir
from kerbside.sources import ledger, readers
from kerbside.sources.runlog import logged_run, read_log
from kerbside.sources.tables import OPEN_PARTITIONS, OPEN_WRITERS
from kerbside.streaming.load import LAYER, load_stream

READINGS = [
    {"id": str(i), "speed": "x" if i == 3 else f"{i}.5", "travel_time": str(i), "data_as_of": "2024-01-05T00:00:00.000",
     "borough": "Bronx"}
    for i in range(6)
]


def land_json(folder, name, rows):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(json.dumps(rows))


def test_json_array_of_objects_gives_a_row_each(spark, tmp_path):
    land_json(tmp_path, "a.json", READINGS[:2])
    df = readers.read_json(spark, str(tmp_path / "a.json"), text_schema("traffic"), multiline=True)
    assert sorted(r["id"] for r in df.collect()) == ["0", "1"]


def test_csv_goes_by_the_header(spark, tmp_path):
    (tmp_path / "plain.csv").write_text("a,b\n1,x\n2,y\n")
    (tmp_path / "indexed.csv").write_text(",a,b\n0,1,x\n1,2,y\n")
    (tmp_path / "other.csv").write_text("b,more,a\nx,?,1\ny,?,2\n")
    for name in ("plain", "indexed", "other"):
        df = readers.read_csv(spark, str(tmp_path / f"{name}.csv")).select("a", "b")
        assert sorted(map(tuple, df.collect())) == [("1", "x"), ("2", "y")]
    (tmp_path / "bare.csv").write_text("1,x\n2,y\n")
    bare = readers.read_csv(spark, str(tmp_path / "bare.csv"), ["a", "b"])
    assert sorted((r["a"], r["b"]) for r in bare.collect()) == [("1", "x"), ("2", "y")]


def test_csv_files_must_agree_on_the_header(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.csv").write_text("a,b\n1,x\n")
    (tmp_path / "in" / "2.csv").write_text("b,a\ny,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_csv(spark, str(tmp_path / "in")).collect()


def test_unreadable_records_are_counted(lake, tmp_path):
    names = ",".join(text_schema("traffic").replace("`", "").replace(" string", "").split(", "))
    (tmp_path / "in").mkdir()
    good = ",".join(["1"] * len(names.split(",")))
    (tmp_path / "in" / "a.csv").write_text(f"{names}\n{good}\n{good},spare\n{good}\n1,2\n")
    found = loads.load_batch(lake, "traffic", "csv", str(tmp_path / "in"))
    assert (found["landed"], found["corrupt"], found["missing"]) == (4, 2, [])
    loaded = load_stream(lake, "traffic", "csv", str(tmp_path / "in"), str(tmp_path / "cp"))
    assert (loaded.rows, loaded.bad_values["corrupt"]) == (4, 2)
    (tmp_path / "json").mkdir()
    (tmp_path / "json" / "a.json").write_text('{"id": "1"}\n{"id": \n{"id": "3"}\n')
    found = loads.load_batch(lake, "traffic", "json", str(tmp_path / "json"))
    assert (found["landed"], found["corrupt"]) == (3, 1)


def test_landing_glob(spark, tmp_path):
    folder = tmp_path / "data" / "pre-processed" / "taxi" / "2024-05-13"
    for name in ("2019_a", "2019_b", "2020_a"):
        land_json(folder, f"{name}.json", [{"n": name}])

    def names(prefix):
        path = readers.landing_glob(str(tmp_path), "taxi", prefix, ".json")
        return sorted(r["n"] for r in readers.read_json(spark, path, "n string").collect())

    assert names("2019") == ["2019_a", "2019_b"]
    assert names("all") == names(None) == names("") == ["2019_a", "2019_b", "2020_a"]


def test_batch_load_logs_and_archives(lake, tmp_path):
    folder = tmp_path / "data" / "pre-processed" / "traffic" / "2024-01-05"
    land_json(folder, "a.json", READINGS)
    path = readers.landing_glob(str(tmp_path), "traffic", None, ".json")
    for n in (1, 2):  # a batch of other files appends
        land_json(folder, "a.json", READINGS)
        path = readers.landing_glob(str(tmp_path), "traffic", None, ".json")
        if n == 2:
            land_json(folder, "b.json", READINGS)
            path = readers.landing_glob(str(tmp_path), "traffic", "b", ".json")
        found = loads.load_batch(lake, "traffic", "json", path, "2024-01-05", multiline=True)
        assert found["rows"] == found["landed"] == 6 and found["bad_speed"] == 1 and found["bad_id"] == 0
        assert lake.read_table("raw", "traffic").count() == 6 * n
    archived = lake.read_table("archive", "traffic")
    assert archived.count() == 12 and archived.select("batch").distinct().count() == 2
    log = read_log(lake)
    assert [(r["process_name"], r["process_status"], r["processed_rows"]) for r in log.collect()] == [
        ("load-traffic", "Success", 6)] * 2
    assert [f.dataType for f in log.schema] == [f.dataType for f in RUN_LOG]


def test_repeated_batch_replaces_itself(lake, tmp_path):
    land_json(tmp_path / "in", "a.json", READINGS)
    for batch in ("first", "first", "second", None, None):
        loads.load_batch(lake, "traffic", "json", str(tmp_path / "in"), batch=batch, multiline=True)
    raw = lake.read_table("raw", "traffic").groupBy("load_batch").count().collect()
    assert sorted(r["count"] for r in raw) == [6, 6, 6]


def loaded_ids(lake):
    return sorted(int(r["id"]) for r in lake.read_table("raw", "traffic").collect())


def load_again(lake, glob):
    found = loads.load_batch(lake, "traffic", "json", glob, "2024-01-05", multiline=True)
    return found["files"], found["rows"]


def test_a_growing_folder_is_loaded_by_one_glob(lake, tmp_path):
    folder, glob = tmp_path / "in", str(tmp_path / "in" / "*.json")
    land_json(folder, "a.json", READINGS[:2])
    assert load_again(lake, glob) == (1, 2)
    land_json(folder, "b.json", READINGS[2:3])
    assert load_again(lake, glob) == (1, 1) and load_again(lake, glob) == (0, 0)
    assert loaded_ids(lake) == [0, 1, 2]
    # Another path to the same files, and a file that was moved away after its load.
    assert load_again(lake, str(folder)) == (0, 0)
    (folder / "a.json").rename(tmp_path / "a.done")
    land_json(folder, "c d [x].json", READINGS[4:])
    assert load_again(lake, glob) == (1, 2) and loaded_ids(lake) == [0, 1, 2, 4, 5]
    assert [r["process_status"] for r in read_log(lake).collect()] == ["Success"] * 5


def test_a_rewritten_file_replaces_its_rows(lake, tmp_path):
    folder, glob = tmp_path / "in", str(tmp_path / "in" / "*.json")
    land_json(folder, "a.json", READINGS[:2])
    land_json(folder, "b.json", READINGS[2:4])
    assert load_again(lake, glob) == (2, 4)
    land_json(folder, "a.json", READINGS[4:])
    assert load_again(lake, glob) == (1, 2) and loaded_ids(lake) == [2, 3, 4, 5]
    land_json(folder, "a.json", [])  # and one without any rows
    assert load_again(lake, glob) == (1, 0) and loaded_ids(lake) == [2, 3]
    assert load_again(lake, glob) == (0, 0)


def test_a_load_cut_off_before_the_ledger_is_repeated(lake, tmp_path, monkeypatch):
    folder, glob = tmp_path / "in", str(tmp_path / "in" / "*.json")
    land_json(folder, "a.json", READINGS[:3])
    with monkeypatch.context() as broken:
        broken.setattr(loads, "enter", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            load_again(lake, glob)
    assert loaded_ids(lake) == [0, 1, 2]
    land_json(folder, "b.json", READINGS[3:])
    assert load_again(lake, glob) == (2, 6) and loaded_ids(lake) == [0, 1, 2, 3, 4, 5]
    assert load_again(lake, glob) == (0, 0)


def test_the_ledger_is_kept_per_dataset(lake, spark, tmp_path):
    folder, glob = tmp_path / "in", str(tmp_path / "in" / "*.json")
    land_json(folder, "a.json", READINGS)
    assert load_again(lake, glob) == (1, 6)
    other = loads.load_batch(lake, "weather", "json", glob, multiline=True)
    assert other["files"] == 1
    files = ledger.latest(ledger.read_ledger(lake), "traffic").collect()
    assert [r["path"].endswith("a.json") for r in files] == [True] and files[0]["size"] > 0


def test_listing_files_reads_none(lake, tmp_path):
    land_json(tmp_path / "in", "a.json", READINGS)
    text = ledger.landed_files(lake.spark, str(tmp_path / "in"))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in text


def test_parquet_batch_reports_missing_columns(lake, spark, tmp_path):
    spark.createDataFrame([(1, "7.5")], "VendorID int, fare_amount string").write.parquet(str(tmp_path / "in"))
    found = loads.load_batch(lake, "taxi", "parquet", str(tmp_path / "in"))
    assert "airport_fee" in found["missing"] and "VendorID" not in found["missing"]
    row = lake.read_table("raw", "taxi").first()
    assert row["fare_amount"] == 7.5 and row["airport_fee"] is None


def test_failed_load_is_logged_and_raised(lake):
    with pytest.raises(Exception):
        loads.load_batch(lake, "traffic", "json", lake.path("landing", "nothing"))
    assert [r["process_status"] for r in read_log(lake).collect()] == ["Failure"]


START = dt.datetime(2024, 1, 1)


def source(spark, days):
    return spark.createDataFrame([(START + dt.timedelta(days=d), d) for d in days], "ts timestamp_ntz, n int")


def after(days):
    return START + dt.timedelta(days=days)


def loaded_numbers(lake, name="traffic"):
    return sorted(r["n"] for r in lake.read_table("raw", name).collect())


def test_windows_move_on_over_an_empty_one(lake, spark):
    df = source(spark, [0, 1, 15, 50])
    runs = loads.catch_up(lake, df, "traffic", "ts", START)
    assert [r.rows for r in runs] == [2, 1, 0, 1]
    assert [r.last_timestamp for r in runs] == [after(15), after(30), after(45), after(45)]
    assert loaded_numbers(lake) == [0, 1, 15, 50]
    assert {r["process_status"] for r in read_log(lake).collect()} == {"Success"}


def test_one_job_equals_window_by_window(lake, spark):
    df = source(spark, [0, 1, 15, 50])
    runs = [loads.load_increment(lake, df, "traffic", "ts", START) for _ in range(5)]
    assert [(r.rows, r.last_timestamp) for r in runs] == [
        (2, after(15)), (1, after(30)), (0, after(45)), (1, after(45)), (1, after(45))]
    assert loaded_numbers(lake) == [0, 1, 15, 50]


def test_late_rows_of_an_open_window_are_loaded(lake, spark):
    loads.load_increment(lake, source(spark, [0, 1, 2]), "traffic", "ts", START)
    run = loads.load_increment(lake, source(spark, [0, 1, 2, 3, 4, 5]), "traffic", "ts", START)
    assert (run.rows, run.last_timestamp) == (6, START)
    assert loaded_numbers(lake) == [0, 1, 2, 3, 4, 5]


def test_windows_past_the_high_water_mark_stay_open(lake, spark):
    nothing = loads.load_increment(lake, source(spark, []), "traffic", "ts", START, delivered=after(3))
    assert (nothing.rows, nothing.last_timestamp) == (0, START)
    known = loads.load_increment(lake, source(spark, [0]), "traffic", "ts", START, delivered=after(15))
    assert (known.rows, known.last_timestamp) == (1, after(15))
    runs = loads.catch_up(lake, source(spark, [0, 20, 70]), "traffic", "ts", START, delivered=after(40))
    assert [r.last_timestamp for r in runs] == [after(30)] * 4
    assert loaded_numbers(lake) == [0, 20, 70]


def test_late_rows_of_an_open_month_are_loaded(lake, spark):
    loads.load_month(lake, source(spark, [0, 5]), "taxi", "ts", START)
    run = loads.load_month(lake, source(spark, [0, 5, 9]), "taxi", "ts", START)
    assert (run.rows, run.last_timestamp) == (3, START)
    assert loaded_numbers(lake, "taxi") == [0, 5, 9]


def versioned(spark, rows):
    return spark.createDataFrame(
        [(START + dt.timedelta(days=d), k, v, n) for d, k, v, n in rows], "ts timestamp_ntz, k int, v int, n int")


def merged(lake, rows):
    return loads.merge_late(lake, rows, "traffic", "ts", START, ["k"], "v")


def test_late_rows_of_closed_windows_are_merged_by_version(lake, spark):
    loads.catch_up(lake, versioned(spark, [(0, 1, 1, 10), (1, 2, 2, 20), (16, 3, 1, 30), (31, 4, 1, 40)]), "traffic", "ts", START)
    kept = lake.read_table("raw", "traffic").where("window_start = '2024-01-16'").inputFiles()
    late = versioned(spark, [(0, 1, 2, 11), (1, 2, 1, 19), (2, 5, 1, 50), (2, 5, 1, 49), (32, 6, 1, 60)])
    for _ in range(2):
        found = merged(lake, late)
        assert (found["windows"], found["rows"], found["open"]) == ([START.date()], 3, 1)
        assert loaded_numbers(lake) == [11, 20, 30, 40, 50]
    untouched = lake.read_table("raw", "traffic").where("window_start = '2024-01-16'").inputFiles()
    assert [f for f in kept if "2024-01-16" in f] == [f for f in untouched if "2024-01-16" in f]
    # A row older than all windows has no place, and an empty batch changes nothing.
    assert merged(lake, versioned(spark, [(-3, 7, 9, 70)]))["windows"] == []
    assert merged(lake, late.where("false"))["rows"] == 0 and loaded_numbers(lake) == [11, 20, 30, 40, 50]


def test_a_late_row_in_a_window_that_was_empty(lake, spark):
    loads.catch_up(lake, versioned(spark, [(0, 1, 1, 10), (46, 2, 1, 20)]), "traffic", "ts", START)
    assert merged(lake, versioned(spark, [(17, 3, 1, 30)]))["windows"] == [dt.date(2024, 1, 16)]
    assert loaded_numbers(lake) == [10, 20, 30]


def test_kept_moments_equal_a_full_pass(lake, spark):
    rows = [(d, d % 7, 1, 1_000_000 + (d * 37) % 11) for d in range(0, 200, 3)]
    df = versioned(spark, rows).withColumn("x", F.when(F.col("k") > 0, F.col("n") + F.col("k") / 7))
    loads.catch_up(lake, df, "traffic", "ts", START)
    raw = lake.read_table("raw", "traffic")
    windows = [r[0] for r in raw.select("window_start").distinct().collect()]
    loads.update_moments(lake, "traffic", ["n", "x"], windows)
    whole = bands.band_stats(df, ["n", "x"]).first()
    kept = loads.kept_stats(lake, "traffic", ["n", "x"]).first()
    assert all(abs(a - b) <= 1e-9 * abs(a) for a, b in zip(whole, kept))
    # Rows that came later: the windows given are scanned alone, and statistics follow.
    more = versioned(spark, [(1, 1, 1, 7)]).withColumn("x", F.lit(2.0)).withColumn("window_start", F.lit(START.date()))
    lake.overwrite(more, "raw", "traffic", ["window_start"], partitions_only=True)
    loads.update_moments(lake, "traffic", ["n", "x"], [START.date()])
    whole = bands.band_stats(lake.read_table("raw", "traffic"), ["n", "x"]).first()
    assert all(abs(a - b) <= 1e-9 * abs(a) for a, b in zip(whole, loads.kept_stats(lake, "traffic", ["n", "x"]).first()))
    labelled = bands.add_bands(df, [bands.Band("n", "b", "lo", "mid", "hi")], loads.kept_stats(lake, "traffic", ["n"]))
    assert "Scan" in labelled._jdf.queryExecution().executedPlan().toString() and labelled.count() == len(rows)


def test_moments_of_new_windows_scan_them_alone(lake, spark):
    loads.catch_up(lake, source(spark, [0, 16, 31]), "traffic", "ts", START)
    rows = lake.read_table("raw", "traffic").where(F.col("window_start").isin([dt.date(2024, 1, 16)]))
    text = bands.moments(rows, ["n"], ["window_start"])._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*window_start#\d+ = 2024-01-16", text), text
    loads.update_moments(lake, "traffic", ["n"], [dt.date(2024, 1, 1), dt.date(2024, 1, 16)])
    lake.drop_partition("raw", "traffic", "window_start", "2024-01-16")
    loads.update_moments(lake, "traffic", ["n"], [dt.date(2024, 1, 16)])
    one = loads.kept_stats(lake, "traffic", ["n"]).first()
    assert one["mean_n"] == 0 and one["stddev_n"] is None


def test_repeated_window_replaces_its_rows(lake, spark):
    df = source(spark, [0, 1])
    loads.load_increment(lake, df, "traffic", "ts", START)
    # As after a crash between the write and the log entry: the same window runs again.
    window = df.withColumn("window_start", F.lit(START.date()))
    lake.overwrite(window, "raw", "traffic", ["window_start"], partitions_only=True)
    assert lake.read_table("raw", "traffic").count() == 2


def test_failed_run_does_not_move_the_resume_point(lake, spark):
    with pytest.raises(RuntimeError):
        with logged_run(lake, "ingest-traffic") as run:
            run.last_timestamp = START + dt.timedelta(days=99)
            raise RuntimeError("source down")
    run = loads.load_increment(lake, source(spark, [0, 16]), "traffic", "ts", START)
    assert run.last_timestamp == START + dt.timedelta(days=15)


def test_month_load_tags_the_file_month(lake, spark):
    df = source(spark, [0, 30, 31])
    first = loads.load_month(lake, df, "taxi", "ts", START)
    second = loads.load_month(lake, df, "taxi", "ts", START)
    assert (first.rows, first.last_timestamp) == (2, dt.datetime(2024, 2, 1))
    assert (second.rows, second.last_timestamp) == (1, dt.datetime(2024, 2, 1))
    months = lake.read_table("raw", "taxi").groupBy("data_file_month").count().collect()
    assert sorted(map(tuple, months)) == [(1, 2), (2, 1)]


def test_transform_job_overwrites_by_month(lake, spark, sf_dir):
    vehicles = Feeds(spark, sf_dir).vehicles()
    lake.append(vehicles, "raw", "vehicles")
    as_of = dt.date(2024, 5, 13)
    for _ in range(2):
        found = loads.run_transform(
            lake, "vehicles", lambda raw: transforms.transform_vehicles(raw, as_of), ["year", "month"])
        stored = lake.read_table("prod", "vehicles")
        assert stored.count() == found["rows"] == vehicles.filter("crash_date IS NOT NULL").count()
    assert {"year", "month"} <= set(stored.columns)


def test_overwrite_keeps_or_replaces_other_partitions(lake, spark):
    both = spark.createDataFrame([(1, 2020), (2, 2021)], "n int, year int")
    lake.overwrite(both, "prod", "t", ["year"])
    lake.overwrite(both.filter("year = 2021").withColumn("n", F.lit(9)), "prod", "t", ["year"], partitions_only=True)
    assert sorted(map(tuple, lake.read_table("prod", "t").collect())) == [(1, 2020), (9, 2021)]
    lake.overwrite(both.filter("year = 2021"), "prod", "t", ["year"])
    assert sorted(map(tuple, lake.read_table("prod", "t").collect())) == [(2, 2021)]


def test_a_load_keeps_its_files_partitions_open_side_by_side(lake, spark, tmp_path, monkeypatch):
    """Spark sorts all rows of a task by the file they come from otherwise, as it still does beyond so many files."""
    seen, plain = [], DataFrameWriter.parquet

    def parquet(self, path, *args, **kwargs):
        seen.append((path, spark.conf.get(OPEN_WRITERS)))
        return plain(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    for i in range(OPEN_PARTITIONS + 8):
        land_json(tmp_path / "in", f"{i}.json", [{"id": str(10 * i + k)} for k in range(3)])
    loads.load_batch(lake, "traffic", "json", str(tmp_path / "in" / "*.json"), multiline=True)
    raw = lake.read_table("raw", "traffic").groupBy("load_batch").agg(F.collect_set("id").alias("ids")).collect()
    assert sorted(sorted(r["ids"]) for r in raw) == [[10 * i + k for k in range(3)] for i in range(OPEN_PARTITIONS + 8)]
    assert [n for path, n in seen if path == lake.path("raw", "traffic")] == [str(OPEN_PARTITIONS)]
    assert spark.conf.get(OPEN_WRITERS) == "0"


def test_materialized_table_is_readable_by_name(lake, spark):
    lake.materialize(spark.range(3).toDF("n"), "numbers")
    assert spark.sql("SELECT sum(n) AS s FROM numbers").first()["s"] == 3


def test_stream_loads_each_file_once(lake, tmp_path):
    landing, checkpoint = tmp_path / "landing", str(tmp_path / "checkpoint")
    size = len(json.dumps(READINGS[:2]))
    for i in range(3):
        land_json(landing / f"2024-01-0{i + 1}", f"part-{i}.json", READINGS[2 * i:2 * i + 2])

    def run():
        return load_stream(
            lake, "traffic", "json", str(landing), checkpoint, max_bytes=2 * size, multiline=True)

    first = run()
    assert (first.rows, first.batches, first.bad_values) == (6, 2, {"bad_speed": 1})
    assert run().rows == 0
    land_json(landing / "2024-01-04", "part-3.json", READINGS[:1])
    assert run().rows == 1
    stored = lake.read_table(LAYER, "traffic")
    assert stored.count() == 7 and dict(stored.dtypes)["speed"] == "double"
    assert [r["processed_rows"] for r in read_log(lake).orderBy("insert_ts").collect()] == [6, 0, 1]


def test_stream_selects_files_by_pattern(lake, spark, tmp_path):
    for name in ("keep_1", "skip_1"):
        land_json(tmp_path / "landing", f"{name}.json", READINGS[:1])
    loaded = load_stream(lake, "traffic", "json", str(tmp_path / "landing"), str(tmp_path / "cp"),
                         pattern="keep_*.json", multiline=True)
    assert loaded.rows == 1


def test_stream_of_parquet_trips(lake, spark, sf_dir, tmp_path):
    trips = Feeds(spark, sf_dir).taxi()
    trips.repartition(4).write.parquet(str(tmp_path / "landing"))
    loaded = load_stream(lake, "taxi", "parquet", str(tmp_path / "landing"), str(tmp_path / "cp"))
    assert loaded.rows == trips.count() == lake.read_table(LAYER, "taxi").count()


class Session:
    """As much of a session as `scratch_dir` looks at."""

    def __init__(self, folder, master):
        self.conf, self.sparkContext = self, self
        self.folder, self.master, self.given = folder, master, None

    def get(self, key, default):
        assert key == "spark.checkpoint.dir"
        return self.folder or default

    def getCheckpointDir(self):
        return self.given

    def setCheckpointDir(self, folder):
        self.given = folder


def test_scratch_dir_is_below_the_shared_folder():
    session = Session("hdfs://shared/cp/", "yarn")
    a, b = scratch_dir(session, "x"), scratch_dir(session, "x")
    assert a.startswith("hdfs://shared/cp/kerbside/x-") and a != b


def test_a_scratch_folder_must_be_named():
    for master in ("yarn", "local[2]"):
        with pytest.raises(ValueError):
            scratch_dir(Session(None, master), "x")


def test_only_a_local_session_without_one_is_given_a_folder():
    cluster, local = Session(None, "yarn"), Session(None, "local[2]")
    local_scratch(cluster)
    local_scratch(local)
    assert cluster.given is None
    assert scratch_dir(local, "x").startswith(local.given)
    named = Session("hdfs://shared/cp", "local[2]")
    local_scratch(named)
    assert named.given is None
