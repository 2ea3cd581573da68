"""CSV files of changing headers, and JSON arrays read by many tasks."""

import json
import random

import pytest

from kerbside.plans import loads
from kerbside.sources import headers, json_arrays, readers
from kerbside.streaming.drift import load_stream_drift
from kerbside.streaming.load import LAYER

SCHEMA = "id bigint, name string, inner struct<a: bigint, t: array<string>>"
ODD = ['}', '"', '{', '],[', '\\', '\\"', 'a\nb', '"}', '\\\\}', '', 'é}🙂', ' , ']


def odd_rows(n, seed=7):
    rng = random.Random(seed)
    text = lambda: "".join(rng.choice(ODD) for _ in range(rng.randrange(6)))
    return [
        {"id": i, "name": rng.choice([None, text()]),
         "inner": rng.choice([None, {"a": i, "t": [text() for _ in range(rng.randrange(4))]}])}
        for i in range(n)
    ]


def plain(rows):
    return sorted(
        (r["id"], r["name"], r["inner"] and (r["inner"]["a"], tuple(r["inner"]["t"]))) for r in rows
    )


@pytest.fixture
def small_splits(spark):
    def to(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", 0)
    yield to
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("size, indent", [(40, None), (97, 2), (1000, None), (10**7, 1)])
def test_arrays_are_read_at_any_split(spark, tmp_path, small_splits, size, indent):
    rows = odd_rows(60)
    for i, ascii_only in enumerate((True, False)):
        part = json.dumps(rows[i::2], indent=indent, ensure_ascii=ascii_only)
        (tmp_path / f"{i}.json").write_text(part, encoding="utf-8")
    small_splits(size)
    found = json_arrays.read_json_array(spark, str(tmp_path), SCHEMA)
    if size == 97:
        assert json_arrays._pieces(spark, str(tmp_path)).select("_start").distinct().count() > 20
    got = found.collect()
    assert plain(got) == plain(rows)
    assert all(r[readers.CORRUPT] is None for r in got)
    same = readers.read_json(spark, str(tmp_path), SCHEMA, multiline=True).collect()
    assert plain(same) == plain(got)


def test_blocks_of_an_array_are_small_in_large_splits(spark, tmp_path, monkeypatch):
    """A split of 128 MB was one block, which the windows of one task held whole."""
    rows = [{"id": i} for i in range(20_000)]
    (tmp_path / "a.json").write_text(json.dumps(rows))
    pieces = json_arrays._pieces(spark, str(tmp_path))
    assert pieces.groupBy(*json_arrays._BLOCK).count().agg({"count": "max"}).first()[0] <= 8192
    monkeypatch.setattr(json_arrays, "BLOCK_PIECES", 3)
    rows = odd_rows(80)
    (tmp_path / "a.json").write_text(json.dumps(rows[:50], indent=1))
    (tmp_path / "b.json").write_text(json.dumps(rows[50:]))
    found = json_arrays.read_json_array(spark, str(tmp_path), SCHEMA).collect()
    assert plain(found) == plain(rows) and all(r[readers.CORRUPT] is None for r in found)


def test_arrays_with_odd_ends(spark, tmp_path):
    for name, text in {
        "empty": "", "none": "[]", "space": " [ \n ] \n", "one": ' [ {"id": 1} ] ', "bare": '[{"id": 2}',
        "cut": '[{"id": 3}, {"id": 4', "string": '[{"id": 5}, {"name": "x} {', "junk": '[{"id": 6}, nonsense {"id": 7}, {"id": 8}]',
        "mark": '﻿[{"id": 9}]',
    }.items():
        (tmp_path / f"{name}.json").write_text(text, encoding="utf-8")
    got = json_arrays.read_json_array(spark, str(tmp_path), SCHEMA).collect()
    good = sorted(r["id"] for r in got if r[readers.CORRUPT] is None)
    bad = sorted(r[readers.CORRUPT] for r in got if r[readers.CORRUPT] is not None)
    assert good == [1, 2, 3, 5, 6, 8, 9]
    assert len(bad) == 3 and any('"id": 4' in b for b in bad) and any("x} {" in b for b in bad)


def test_array_files_by_the_ledger(lake, tmp_path, small_splits):
    folder = tmp_path / "in"
    folder.mkdir()
    small_splits(200)
    for name, ids in (("a", range(30)), ("b", range(30, 41))):
        (folder / f"{name}.json").write_text(json.dumps([{"id": i, "speed": i / 2} for i in ids]))
        loads.load_batch(lake, "traffic", "json", f"{folder}/*.json", arrays=True)
    rows = lake.read_table("raw", "traffic").collect()
    assert sorted((r["id"], r["speed"]) for r in rows) == [(i, i / 2) for i in range(41)]
    assert len({r["load_batch"] for r in rows}) == 2


def land_drift(folder):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "1.csv").write_text("id,speed,borough\n1,1.5,Bronx\n2,2.5,Queens\n")
    (folder / "2.csv").write_text("borough,id,more,speed\nBronx,3,x,3.5\n")
    (folder / "3.csv").write_text(",speed,id\n0,4.5,4\n1,5.5,5,too,many\n")
    (folder / "4.csv").write_text("id,speed,borough\n")
    (folder / "empty.csv").write_text("")


WANTED = [(1, 1.5, "Bronx"), (2, 2.5, "Queens"), (3, 3.5, "Bronx"), (4, 4.5, None), (5, 5.5, None)]


def test_headers_are_grouped_and_united(spark, tmp_path):
    land_drift(tmp_path)
    groups = headers.header_groups(spark, f"{tmp_path}/*.csv")
    assert sorted(map(len, groups.values())) == [1, 1, 2]
    df = headers.read_groups(spark, groups)
    assert df.columns == ["id", "speed", "borough", "more", readers.CORRUPT, "_path"]
    got = df.collect()
    assert sorted((int(r["id"]), float(r["speed"]), r["borough"]) for r in got) == WANTED
    assert sum(r[readers.CORRUPT] is not None for r in got) == 1
    report = {r["column"]: tuple(r)[1:] for r in headers.drift_report(spark, groups).collect()}
    assert report == {"id": (4, 0, 3, 3), "speed": (4, 0, 3, 2), "borough": (3, 1, 2, 2), "more": (1, 3, 1, 1)}


def test_drift_in_batch_and_stream(lake, tmp_path):
    folder = tmp_path / "in"
    land_drift(folder)
    found = loads.load_batch(lake, "traffic", "csv", f"{folder}/*.csv", drift=True)
    assert (found["landed"], found["corrupt"]) == (5, 1)
    assert "id" not in found["missing"] and "link_id" in found["missing"]
    first = load_stream_drift(lake, "traffic", f"{folder}", f"{tmp_path}/checkpoint", files=2)
    assert first.rows == 5 and first.batches == 3 and first.bad_values == {"corrupt": 1}
    (folder / "5.csv").write_text("speed,id\n6.5,6\n")
    again = load_stream_drift(lake, "traffic", f"{folder}", f"{tmp_path}/checkpoint", files=2)
    assert again.rows == 1 and load_stream_drift(lake, "traffic", f"{folder}", f"{tmp_path}/checkpoint").rows == 0
    for layer, more in (("raw", []), (LAYER, [(6, 6.5, None)])):
        rows = lake.read_table(layer, "traffic").collect()
        assert sorted((r["id"], r["speed"], r["borough"]) for r in rows) == WANTED + more
