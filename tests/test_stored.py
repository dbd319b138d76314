"""Loads that leave unchanged days alone, removals that stop half way, snapshots of the history."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

from stormgrid import schemas
from stormgrid.checks import fixtures as fx, queries as q
from stormgrid.operators import upsert
from stormgrid.plans import daily
from stormgrid.sources import layers
from test_rollup import assert_current, load, loads, rows_of  # noqa: F401

DAY = datetime.date


def files(*folders):
    found = {}
    for folder in folders:
        for base, _, names in os.walk(folder):
            found |= {os.path.join(base, n): os.stat(os.path.join(base, n)).st_mtime_ns for n in names if n.startswith("part-")}
    return found


def test_a_replayed_load_rewrites_no_file(spark, folder, loads):  # noqa: F811
    load(spark, folder, loads[0])
    load(spark, folder, loads[1])
    kept = [f"{folder}/fact", f"{folder}/rollup"]
    before = files(*kept)
    load(spark, folder, loads[1])
    assert before and files(*kept) == before
    # one row of one day changes: that day is written, the others stay
    first = loads[1].orderBy("forecast_date", "city_id").limit(1)
    day = first.first()["forecast_date"]
    load(spark, folder, first.withColumn("loaded_at", F.lit("2025-01-01 00:00:00").cast("timestamp_ntz")))
    after = files(f"{folder}/fact")
    assert {f for f in after if before.get(f) != after[f]} == {f for f in after if f"forecast_date={day}" in f}
    assert_current(spark, folder)


class Stopped(Exception):
    pass


@pytest.fixture
def stored_root(spark, sf_dir, folder, loads):  # noqa: F811
    daily.load_dim(spark, f"{folder}/dim", fx.dim(spark, sf_dir))
    for day, rows in zip(q.RUN_DAYS, loads):
        load(spark, folder, rows)
        history = upsert.history_rows(rows, F.lit(day), F.lit("2024-02-01 06:00:00")).drop("run_date")
        daily.write_history(spark, folder, history, day)
    held = daily.history_as_of(spark, folder, DAY(2024, 1, 2))
    held.write.parquet(f"{folder}/snapshots/as_of=2024-01-02")
    return folder


def test_a_removal_that_stops_anywhere_is_finished(spark, stored_root, monkeypatch):
    """Stops at one write or drop after the other: the view has lost the cities once the removal is
    written down, and the next start leaves no trace of them."""
    root, gone = stored_root, spark.createDataFrame([(3,), (4,), (99,)], "city_id int")
    want = {
        "fact": rows_of(upsert.cascade_delete(daily.read_fact(spark, f"{root}/fact"), gone)),
        "history": rows_of(upsert.cascade_delete(spark.read.parquet(f"{root}/history"), gone)),
        "dim": rows_of(upsert.cascade_delete(daily.read_dim(spark, f"{root}/dim")[0], gone)),
    }
    assert not daily.read_fact(spark, f"{root}/fact").where("city_id IN (3, 4)").isEmpty()
    calls, limit = [0], [0]

    def counted(step):
        def run(*args, **kwargs):
            calls[0] += 1
            if calls[0] > limit[0]:
                raise Stopped
            return step(*args, **kwargs)

        return run

    monkeypatch.setattr(layers, "write_layer", counted(layers.write_layer))
    monkeypatch.setattr(layers, "drop", counted(layers.drop))
    monkeypatch.setattr(daily, "_write_version", counted(daily._write_version))
    stops = 0
    while True:
        calls[0] = 0
        try:
            if stops == 0:
                daily.remove_cities(spark, root, gone)
            elif not daily._pending_removals(spark, root):
                daily.remove_cities(spark, root, gone)
            else:
                daily.finish_removals(spark, root)
            break
        except Stopped:
            stops, limit[0] = stops + 1, limit[0] + 1
            if daily._pending_removals(spark, root):
                assert daily.open_view(spark, root).where("city_name IN ('NATION_3', 'NATION_4')").isEmpty()
    assert stops >= 5 and not daily._pending_removals(spark, root)
    assert rows_of(daily.read_fact(spark, f"{root}/fact")) == want["fact"]
    assert rows_of(spark.read.parquet(f"{root}/history")) == want["history"]
    assert rows_of(daily.read_dim(spark, f"{root}/dim")[0]) == want["dim"]
    assert spark.read.parquet(f"{root}/snapshots").where("city_id IN (3, 4)").isEmpty()
    assert_current(spark, root)


def test_history_as_of_reads_a_snapshot_and_the_tail(spark, folder, monkeypatch):
    monkeypatch.setattr(daily, "SNAPSHOT_EVERY", 4)
    columns = "city_id int, forecast_date date, risk_score double"
    replayed, states, first = {}, {}, DAY(2024, 3, 1)
    for n in range(11):
        day = first + datetime.timedelta(days=n)
        rows = [(c, first + datetime.timedelta(days=n + c % 3), float(n * 10 + c)) for c in range(n % 4 + 1)]
        daily.write_history(spark, folder, spark.createDataFrame(rows, columns), day.isoformat())
        replayed |= {(c, d): (s, day) for c, d, s in rows}
        states[day] = dict(replayed)

    def state(day):
        rows = daily.history_as_of(spark, folder, day)
        return {(r["city_id"], r["forecast_date"]): (r["risk_score"], r["run_date"]) for r in rows.collect()}

    for day, want in states.items():
        assert state(day) == want
    assert daily.history_as_of(spark, folder, DAY(2024, 2, 1)) is None
    assert len(daily._dates(spark, f"{folder}/snapshots", "as_of")) == 2
    # one snapshot and the runs since, however many there are
    read = daily.history_as_of(spark, folder, DAY(2024, 3, 10)).inputFiles()
    assert {f.split("/")[-2] for f in read} == {"as_of=2024-03-08", "run_date=2024-03-09", "run_date=2024-03-10"}
    # an earlier run again: the snapshots from it on go
    daily.write_history(spark, folder, spark.createDataFrame([(0, first, -1.0)], columns), "2024-03-05")
    assert daily._dates(spark, f"{folder}/snapshots", "as_of")[0] == DAY(2024, 3, 4)
    assert state(DAY(2024, 3, 5))[0, first] == (-1.0, DAY(2024, 3, 5))


def test_rows_that_do_not_fit_are_told_apart(spark, sf_dir):
    gold = q._gold(spark, sf_dir).limit(20)
    spoiled = gold.withColumns(
        {
            "risk_score": F.when(F.col("city") == "NATION_1", 1e9).otherwise(F.col("risk_score")),
            "temp_max": F.when(F.col("city") == "NATION_1", float("nan")).otherwise(F.col("temp_max")),
        }
    )
    sound, rejects = upsert.castable(spoiled)
    bad = gold.where("city = 'NATION_1'").count()
    assert sound.count() == 20 - bad and sound.columns == gold.columns
    assert {(r["reason"], r["value"]) for r in rejects.collect()} <= {("risk_score decimal(5,2)", "1.0E9")}
    assert rejects.count() == bad
    assert upsert.castable(spoiled.limit(0))[1].collect() == []
    assert schemas.SERVING_TYPES["risk_score"].simpleString() == "decimal(5,2)"
