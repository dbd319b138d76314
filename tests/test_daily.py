"""The stored pipeline: landing, defects, replays, and incremental loads."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

from stormgrid import schemas
from stormgrid.checks import fixtures as fx
from stormgrid.operators import constraints, marts, upsert
from stormgrid.plans import daily
from stormgrid.sources import bronze, layers

LOADED = "2024-02-01 06:00:00"


def payload(city, days, **change):
    daily_part = {"time": days}
    for column in schemas.DAILY_COLUMNS:
        if column != "time":
            daily_part[column] = ["1"] * len(days)
    daily_part.update(change.pop("daily", {}))
    return {
        "run_date": change.pop("run_date", "2024-03-01"),
        "latitude": 10.0,
        "longitude": -5.0,
        "daily": daily_part,
        "_city_name": city,
        "_extracted_at": change.pop("at", "2024-03-01T06:00:00"),
    }


SCHEMA = (
    "run_date string, latitude double, longitude double, daily struct<"
    + ",".join(f"{c}:array<string>" for c in schemas.DAILY_COLUMNS)
    + ">, _city_name string, _extracted_at string"
)


def land(spark, root, rows):
    bronze.land_payloads(spark.createDataFrame(rows, SCHEMA), f"{root}/bronze")


def run_dir(root, day):
    return f"{root}/bronze/run_date={day}"


def add_file(root, day, name, text):
    with open(os.path.join(run_dir(root, day), name), "w", encoding="utf-8") as f:
        f.write(text)


def test_run_with_defects(spark, folder):
    land(
        spark,
        folder,
        [
            payload(" Fès ", ["2024-03-01", "2024-03-02"], daily={"temperature_2m_max": ["21.5", "x"]}),
            payload("Safi", ["2024-03-01", "bad day"]),
            payload("Taza", ["2024-03-01"], daily={"weather_code": ["1", "2"]}),
        ],
    )
    add_file(folder, "2024-03-01", "broken.json", '{"latitude": 1.0, "daily": {')
    add_file(folder, "2024-03-01", "empty.json", '{"latitude": 1.0, "_city_name": "Nador"}')
    add_file(folder, "2024-03-01", "_manifest.json", '{"run_date": "2024-03-01"}')
    outcome = daily.run_silver(spark, folder, "2024-03-01")
    assert outcome.counts["usable"] == 2 and outcome.counts["rejected"] == 3
    silver = layers.read_layer(spark, f"{folder}/silver", schemas.SILVER, "2024-03-01")
    rows = {(r["city"], str(r["forecast_date"])): r["temp_max"] for r in silver.collect()}
    assert rows == {
        ("Fès", "2024-03-01"): 21.5,
        ("Fès", "2024-03-02"): None,
        ("Safi", "2024-03-01"): 1.0,
        ("Safi", "None"): 1.0,
    }
    reasons = spark.read.parquet(f"{folder}/quarantine").select("reason").collect()
    assert sorted(r["reason"] for r in reasons) == ["length_mismatch", "malformed", "no_daily"]

    # the run lands again, sound this time
    land(spark, folder, [payload("Safi", ["2024-03-01"])])
    assert daily.run_silver(spark, folder, "2024-03-01").counts["rejected"] == 0
    assert spark.read.parquet(f"{folder}/quarantine").isEmpty()
    assert layers.read_layer(spark, f"{folder}/silver", schemas.SILVER, "2024-03-01").count() == 1


def test_nothing_usable(spark, folder):
    land(spark, folder, [payload("Taza", ["2024-03-01"], daily={"weather_code": ["1", "2"]})])
    with pytest.raises(bronze.NothingUsable):
        daily.run_silver(spark, folder, "2024-03-01")


def test_missing_run(spark, folder):
    land(spark, folder, [payload("Safi", ["2024-03-01"])])
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        daily.run_silver(spark, folder, "2024-03-02")


def test_absent_array_is_null(spark, folder):
    row = payload("Safi", ["2024-03-01"], daily={"weather_code": None})
    land(spark, folder, [row])
    daily.run_silver(spark, folder, "2024-03-01")
    silver = layers.read_layer(spark, f"{folder}/silver", schemas.SILVER)
    assert [r["weather_code"] for r in silver.collect()] == [None]


def test_landing_replaces_its_run_only(spark, folder):
    land(spark, folder, [payload("Safi", ["2024-03-01"]), payload("Fès", ["2024-03-02"], run_date="2024-03-02")])
    land(spark, folder, [payload("Taza", ["2024-03-01"])])
    names = bronze.scan_bronze(spark, f"{folder}/bronze").select("run_date", "_city_name").collect()
    assert sorted((str(r[0]), r[1]) for r in names) == [("2024-03-01", "Taza"), ("2024-03-02", "Fès")]


def test_documents(spark, folder):
    """One indented document per city, in a folder per run."""
    os.makedirs(f"{folder}/bronze/2024-03-01")
    files = {
        "Safi.json": '{\n "latitude": 1.5,\n "daily": {\n  "time": ["2024-03-01"],\n  "temperature_2m_max": [20]\n },'
        '\n "_city_name": "Safi",\n "_extracted_at": "2024-03-01T06:00:00"\n}\n',
        "bad.json": "{\n not json",
        "_manifest.json": '{\n "run_date": "2024-03-01"\n}',
    }
    for name, text in files.items():
        with open(f"{folder}/bronze/2024-03-01/{name}", "w", encoding="utf-8") as f:
            f.write(text)
    outcome = daily.run_silver(spark, folder, "2024-03-01", documents=True)
    assert (outcome.counts["usable"], outcome.counts["rejected"]) == (1, 1)
    row = layers.read_layer(spark, f"{folder}/silver", schemas.SILVER, "2024-03-01").first()
    assert (row["city"], row["temp_max"], row["weather_code"]) == ("Safi", 20.0, None)


def test_three_days_loaded_and_replayed(spark, folder, sf_dir):
    """Loading runs in turn leaves what the history says is in force; repeating a load or a
    whole day changes nothing."""
    start = datetime.date(2024, 1, 1)
    bronze.land_payloads(
        fx.payloads(spark, sf_dir).where(F.col("run_date") < F.lit("2024-01-04").cast("date")), f"{folder}/bronze"
    )
    days = [str(start + datetime.timedelta(days=n)) for n in range(3)]
    for day in days:
        daily.run_day(spark, folder, day, LOADED)

    def state():
        fact = daily.read_fact(spark, f"{folder}/fact")
        return sorted(map(str, fact.collect()))

    before = state()
    fact = daily.read_fact(spark, f"{folder}/fact")
    assert fact.count() == fact.select(*schemas.FACT_KEY).distinct().count() > 0
    history = spark.read.parquet(f"{folder}/history")
    latest = upsert.history_latest(history).select(*schemas.HISTORY_COLUMNS)
    stored = fact.select(*schemas.HISTORY_COLUMNS)
    assert latest.exceptAll(stored).isEmpty() and stored.exceptAll(latest).isEmpty()

    recorded = history.count()
    dim_before = sorted(map(str, daily.read_dim(spark, f"{folder}/dim")[0].collect()))
    daily.run_day(spark, folder, days[-1], LOADED)
    assert state() == before
    assert sorted(map(str, daily.read_dim(spark, f"{folder}/dim")[0].collect())) == dim_before
    assert recorded == spark.read.parquet(f"{folder}/history").count()
    assert marts.kpis(daily.open_view(spark, folder)).first()["n_cities"] == len(dim_before)


def test_load_rewrites_its_days_only(spark, folder):
    land(spark, folder, [payload("Safi", ["2024-03-01", "2024-03-02"]), payload("Fès", ["2024-03-02", "2024-03-03"], run_date="2024-03-02")])
    daily.run_day(spark, folder, "2024-03-01", LOADED)

    def files(day):
        return sorted(os.listdir(f"{folder}/fact/forecast_date={day}"))

    first, second = files("2024-03-01"), files("2024-03-02")
    daily.run_day(spark, folder, "2024-03-02", LOADED)
    assert files("2024-03-01") == first and files("2024-03-02") != second
    keys = daily.read_fact(spark, f"{folder}/fact").join(daily.read_dim(spark, f"{folder}/dim")[0], "city_id")
    assert sorted((r["city_name"], r["forecast_date"].day) for r in keys.collect()) == [
        ("Fès", 2),
        ("Fès", 3),
        ("Safi", 1),
        ("Safi", 2),
    ]


def fact_days(spark, folder):
    return sorted(str(r["forecast_date"]) for r in daily.read_fact(spark, f"{folder}/fact").collect())


def test_rows_without_a_date_are_set_aside(spark, folder):
    """Neither a later load nor a run of nothing else loses or keeps them."""
    land(spark, folder, [payload("Safi", ["2024-03-01", "bad"]), payload("Fès", ["2024-03-01", "bad"], run_date="2024-03-02")])
    for day in ("2024-03-01", "2024-03-02"):
        assert daily.run_day(spark, folder, day, LOADED)["load"].counts["rejected"] == 1
    assert fact_days(spark, folder) == ["2024-03-01", "2024-03-01"]
    rejected = spark.read.parquet(f"{folder}/rejected").collect()
    assert sorted((str(r["run_date"]), r["reason"]) for r in rejected) == [("2024-03-01", "no_date"), ("2024-03-02", "no_date")]

    land(spark, folder, [payload("Safi", ["bad"], run_date="2024-03-03")])
    counts = daily.run_day(spark, folder, "2024-03-03", LOADED)["load"].counts
    assert (counts["loaded"], counts["rejected"]) == (0, 1)
    assert spark.read.parquet(f"{folder}/history").where("run_date = '2024-03-03'").isEmpty()


def test_days_between_are_not_touched(spark, folder):
    week = [f"2024-03-0{d}" for d in range(1, 8)]
    land(spark, folder, [payload("Safi", week), payload("Fès", ["1970-01-01", week[0], week[6]], run_date="2024-03-02")])
    daily.run_day(spark, folder, "2024-03-01", LOADED)
    files = lambda: {d: sorted(os.listdir(f"{folder}/fact/forecast_date={d}")) for d in week}
    before = files()
    daily.run_day(spark, folder, "2024-03-02", LOADED)
    after = files()
    assert {d for d in week if before[d] != after[d]} == {week[0], week[6]}
    assert len(fact_days(spark, folder)) == 10


def test_constraints_end_a_load_before_it_writes(spark, folder):
    land(spark, folder, [payload("Safi", ["2024-03-01"]), payload("x" * 150, ["2024-03-01"], run_date="2024-03-02")])
    daily.run_day(spark, folder, "2024-03-01", LOADED)
    with pytest.raises(constraints.ConstraintViolated, match="city_name at most 100 characters: 1"):
        daily.run_day(spark, folder, "2024-03-02", LOADED)
    assert daily.read_dim(spark, f"{folder}/dim")[1] == 1 and len(fact_days(spark, folder)) == 1
    assert not os.path.exists(f"{folder}/history/run_date=2024-03-02")
    dim, fact = daily.read_dim(spark, f"{folder}/dim")[0], daily.read_fact(spark, f"{folder}/fact")
    with pytest.raises(constraints.ConstraintViolated, match="city_id in dim: 1"):
        constraints.enforce(dim.where("false"), fact)
    with pytest.raises(constraints.ConstraintViolated, match="not null"):
        daily.load_fact(spark, f"{folder}/fact", fact.withColumn("forecast_date", F.lit(None).cast("date")))


def test_loads_need_ansi(spark, folder):
    land(spark, folder, [payload("Safi", ["2024-03-01"])])
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(RuntimeError, match="ansi"):
            daily.run_load(spark, folder, "2024-03-01", LOADED)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_an_empty_rerun_replaces_its_rows(spark, folder):
    land(spark, folder, [payload("Safi", ["2024-03-01"])])
    daily.run_day(spark, folder, "2024-03-01", LOADED)
    land(spark, folder, [payload("Safi", ["bad"])])
    assert daily.run_day(spark, folder, "2024-03-01", LOADED)["load"].counts["loaded"] == 0
    assert spark.read.parquet(f"{folder}/history").isEmpty()
    path = os.path.join(folder, "cities.csv")
    for text, total in (("Safi,1,2\nSafi,1,2\nTaza,3,4\n", 3), ("", 0)):
        with open(path, "w", encoding="utf-8") as f:
            f.write("city,lat,lng\n" + text)
        assert daily.run_manifest(spark, folder, "2024-03-01", path).counts["total_cities"] == total


def test_cities_are_removed_from_all_tables(spark, folder):
    land(spark, folder, [payload("Safi", ["2024-03-01", "2024-03-02"]), payload("Fès", ["2024-03-02", "2024-03-03"])])
    daily.run_day(spark, folder, "2024-03-01", LOADED)
    dim = daily.read_dim(spark, f"{folder}/dim")[0]
    kept = os.listdir(f"{folder}/fact/forecast_date=2024-03-03")
    daily.remove_cities(spark, folder, dim.where("city_name = 'Safi'"))
    assert fact_days(spark, folder) == ["2024-03-02", "2024-03-03"]
    assert os.listdir(f"{folder}/fact/forecast_date=2024-03-03") == kept
    assert not os.path.exists(f"{folder}/fact/forecast_date=2024-03-01")
    assert spark.read.parquet(f"{folder}/history").count() == 2
    assert [r["city_name"] for r in daily.read_dim(spark, f"{folder}/dim")[0].collect()] == ["Fès"]


def test_old_dimension_versions_go(spark, folder):
    dim = spark.createDataFrame([(1, "Safi", 1.0, 2.0)], schemas.DIM)
    for _ in range(6):
        daily.load_dim(spark, f"{folder}/dim", dim)
    assert daily.read_dim(spark, f"{folder}/dim")[1] == 6
    assert len(layers.names(spark, f"{folder}/dim", "version=")) == daily.DIM_VERSIONS_KEPT


def test_cities_without_coordinates_are_left_out(spark, folder):
    row = payload("Safi", ["2024-03-01"])
    land(spark, folder, [row, {**payload("Taza", ["2024-03-01"]), "latitude": None}])
    outcomes = daily.run_day(spark, folder, "2024-03-01", LOADED)
    assert outcomes["load"].counts == {"cities": 1, "loaded": 1, "rejected": 0, "left_out": 1}


def test_a_broken_dimension_load_is_no_version(spark, folder):
    os.makedirs(f"{folder}/dim/version=1/_temporary")
    assert daily.read_dim(spark, f"{folder}/dim")[1] == 0
    land(spark, folder, [payload("Safi", ["2024-03-01"])])
    daily.run_day(spark, folder, "2024-03-01", LOADED)
    dim, version = daily.read_dim(spark, f"{folder}/dim")
    assert version == 1 and [r["city_name"] for r in dim.collect()] == ["Safi"]


def test_csv_copies(spark, folder):
    land(spark, folder, [payload(" Fès ", ["2024-03-02", "2024-03-01"]), payload("Safi", ["2024-03-01"])])
    daily.run_day(spark, folder, "2024-03-01", LOADED, csv=True)
    for layer, schema in [("silver", schemas.SILVER), ("gold", schemas.GOLD)]:
        stored = layers.read_layer(spark, f"{folder}/{layer}", schema, "2024-03-01")
        copied = layers.read_layer(spark, f"{folder}/{layer}_csv", schema, "2024-03-01", fmt="csv")
        assert stored.count() == 3
        assert stored.exceptAll(copied).isEmpty() and copied.exceptAll(stored).isEmpty()


def test_manifest(spark, folder):
    land(spark, folder, [payload("Safi", ["2024-03-01"])])
    path = os.path.join(folder, "cities.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write("city,lat,lng,extra\nSafi,1,2,x\nTaza,3,4,x\nFès,,4,x\n")
    counts = daily.run_manifest(spark, folder, "2024-03-01", path).counts
    assert counts == {"total_cities": 2, "success_count": 1, "failed_cities": 1}
    stored = spark.read.parquet(f"{folder}/manifest").collect()
    assert [(str(r["run_date"]), r["failed_city"]) for r in stored] == [("2024-03-01", "Taza")]
    outcome = daily.run_silver(spark, folder, "2024-03-01", path)
    assert outcome.report["unmatched_rows"] == 0


def test_sample_runs(spark):
    """Known figures of a sample of per-city documents, when one is mounted."""
    sample = os.environ.get("FORECAST_SAMPLE_DIR")
    if not sample:
        pytest.skip("FORECAST_SAMPLE_DIR not set")
    from stormgrid.plans import gold as gold_plan, silver as silver_plan

    for day, mean, top, moderate, first in [
        ("2026-09-16", 13.9940, 33.6, 19, "Martil"),
        ("2026-09-17", 14.8709, 47.1, 30, "Martil"),
        ("2026-09-21", 12.6188, 27.8, 2, "Taroudannt"),
    ]:
        payloads = bronze.scan_documents(spark, sample, day)
        rows = gold_plan.gold(silver_plan.from_payloads(payloads), day).cache()
        assert rows.count() == 714
        figures = rows.agg(F.avg("risk_score"), F.max("risk_score")).first()
        assert round(figures[0], 4) == mean and figures[1] == top
        assert rows.where("risk_level = 'Modéré'").count() == moderate
        from stormgrid.operators.quality import top_city

        assert top_city(rows).first()["city"] == first
