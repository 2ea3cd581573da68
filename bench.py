"""Times the table builds and the reports; prints one JSON line.

First the six feeds are stored as raw tables (not timed) and transformed to prod tables (timed as
build_*), as the layered design has it; then every report reads the stored tables. BENCH_SF_DIR names
the test tables and BENCH_CPUS the local cores. `--naive` answers the model reports by plain row joins
median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

import bench_rows as naive
from kerbside.harness import registry
from kerbside.harness.adapters import Feeds
from kerbside.plans import loads, model, reports, transforms
from kerbside.session import build_session, local_scratch, scratch_dir
from kerbside.sources.tables import Lake

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
MONTHLY = ["year", "month"]


def timed(run, times: int = 1):
    taken = []
    for _ in range(times):
        start = time.perf_counter()
        run()
        taken.append(time.perf_counter() - start)
    return round(statistics.median(taken), 3)


def build_prod(lake: Lake, feeds: Feeds) -> dict[str, float]:
    tables = {
        "crashes": (transforms.transform_crashes, []),
        "vehicles": (lambda raw: transforms.transform_vehicles(raw, registry.AS_OF), MONTHLY),
        "persons": (transforms.transform_persons, MONTHLY),
        "weather": (transforms.transform_weather, MONTHLY),
        "traffic": (transforms.transform_traffic, MONTHLY),
        "taxi": (transforms.transform_taxi, []),
    }
    for name in tables:
        lake.append(getattr(feeds, name)(), "raw", name)
    return {
        f"build_{name}": timed(lambda: loads.run_transform(lake, name, transform, by))
        for name, (transform, by) in tables.items()
    }


def plans(lake: Lake, by_rows: bool) -> dict:
    tables = {
        name: lake.read_table("prod", name)
        for name in ("crashes", "vehicles", "persons", "weather", "traffic")
    }
    prod = tables.__getitem__

    def crash_model():
        if by_rows:
            return naive.RowModel(naive.unified(prod("crashes"), prod("vehicles"), prod("persons")))
        return model.CrashModel(prod("crashes"), prod("vehicles"), prod("persons"))

    def weather_view():
        if by_rows:
            return naive.RowView(
                crash_model().table, prod("weather"), "burrough", "date", model.WEATHER_SIDE
            )
        return model.crash_weather(crash_model(), prod("weather"))

    def traffic_view():
        if by_rows:
            return naive.RowView(
                crash_model().table, prod("traffic"), "borough", "crash_timestamp",
                model.TRAFFIC_SIDE,
            )
        return model.crash_traffic(crash_model(), prod("traffic"))

    answers = naive if by_rows else reports
    on_model = {f"q{n:02}": getattr(reports, f"q{n:02}") for n in (2, 7, 8, 9, 10, 13)}
    on_view = {f"q{n:02}": getattr(reports, f"q{n:02}") for n in (3, 4, 6)}
    return {
        **{name: (lambda r=r: r(crash_model())) for name, r in on_model.items()},
        **{name: (lambda r=r: r(weather_view())) for name, r in on_view.items()},
        "p1": lambda: answers.p1(weather_view()),
        "p2": lambda: answers.p2(traffic_view()),
        "p3": lambda: reports.p3(crash_model()),
        "p4": lambda: answers.p4(weather_view(), *([prod("vehicles")] if by_rows else [])),
        "q01": lambda: reports.q01(prod("weather")),
        "q05": lambda: reports.q05(prod("persons")),
        "q11": lambda: reports.q11(prod("persons")),
        "q12": lambda: reports.q12(prod("traffic")),
        "q14": lambda: reports.q14(prod("vehicles")),
        "q15": lambda: reports.q15(prod("vehicles")),
    }


def main() -> None:
    by_rows = "--naive" in sys.argv
    spark = build_session(
        "kerbside-bench",
        f"local[{CPUS}]",
        spark__sql__shuffle__partitions=CPUS,
        spark__ui__enabled="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    local_scratch(spark)
    lake = Lake(spark, scratch_dir(spark, "bench"))
    seconds = build_prod(lake, Feeds(spark, SF_DIR))
    for name, make in sorted(plans(lake, by_rows).items()):
        make().collect()
        seconds[name] = timed(lambda: make().collect(), 3)
    print(
        json.dumps(
            {
                "metric": "total seconds of builds and reports" + (" (row joins)" if by_rows else ""),
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
