"""Small files gathered: what readers see at every step, and after a crash between the steps."""

import pytest

from kerbside.sources import compaction
from kerbside.sources.compaction import compact, newest_base, read_compacted
from kerbside.sources.ledger import compact_ledger, enter, read_ledger
from kerbside.sources.runlog import Run, compact_log, log_runs, now, read_log

SCHEMA = "n bigint"


def add(lake, spark, *numbers):
    for n in numbers:
        spark.range(n, n + 1).toDF("n").coalesce(1).write.mode("append").parquet(lake.path("catalog", "t"))


def seen(lake):
    return sorted(r["n"] for r in read_compacted(lake, "catalog", "t", SCHEMA).collect())


def files(lake):
    return len(read_compacted(lake, "catalog", "t", SCHEMA).inputFiles())


def test_rows_stay_and_files_become_few(lake, spark):
    assert seen(lake) == [] and compact(lake, "catalog", "t", SCHEMA, 1) == 0
    add(lake, spark, *range(6))
    assert seen(lake) == list(range(6)) and compact(lake, "catalog", "t", SCHEMA, 7) == 0
    assert compact(lake, "catalog", "t", SCHEMA, 6) == 6
    assert seen(lake) == list(range(6)) and files(lake) == 1
    add(lake, spark, 6, 7)
    assert seen(lake) == list(range(8)) and files(lake) == 3
    assert compact(lake, "catalog", "t", SCHEMA, 2) == 2 and newest_base(lake, "catalog", "t") == 2
    assert seen(lake) == list(range(8)) and files(lake) == 1
    assert [f for f, _ in compaction._listed(lake, lake.path("catalog", "t_base"))] == ["v2"]


@pytest.mark.parametrize("step", range(9))
def test_a_crash_between_the_steps_loses_and_doubles_nothing(lake, spark, monkeypatch, step):
    """The n-th removal or the n-th write of a compaction fails; readers and the next compaction go on."""
    add(lake, spark, 0, 1)
    compact(lake, "catalog", "t", SCHEMA, 2)
    add(lake, spark, 2, 3, 4)
    left, remove, read = [step], compaction._remove, type(lake.spark).createDataFrame

    def failing(real):
        def call(*args, **kwargs):
            left[0] -= 1
            if left[0] < 0:
                raise RuntimeError("gone")
            return real(*args, **kwargs)

        return call

    with monkeypatch.context() as broken:
        broken.setattr(compaction, "_remove", failing(remove))
        broken.setattr(type(lake.spark), "createDataFrame", failing(read))
        try:
            compact(lake, "catalog", "t", SCHEMA, 3)
        except RuntimeError:
            pass
    assert seen(lake) == [0, 1, 2, 3, 4]
    add(lake, spark, 5)
    assert seen(lake) == [0, 1, 2, 3, 4, 5]
    compact(lake, "catalog", "t", SCHEMA, 1)
    assert seen(lake) == [0, 1, 2, 3, 4, 5] and files(lake) == 1


def test_the_log_and_the_ledger_stay_whole(lake, spark):
    for i in range(5):
        log_runs(lake, [Run(f"p{i}", now(), i)])
        files_of = spark.createDataFrame([(f"f{i}", i, now(), "x")], "path string, size bigint, modified timestamp, part string")
        enter(lake, "traffic", files_of)
        if i == 3:
            assert compact_log(lake, 2) == compact_ledger(lake, 2) == 4
    assert sorted((r["process_name"], r["processed_rows"]) for r in read_log(lake).collect()) == [(f"p{i}", i) for i in range(5)]
    assert sorted(r["path"] for r in read_ledger(lake).collect()) == [f"f{i}" for i in range(5)]
    assert len(read_log(lake).inputFiles()) == 2
