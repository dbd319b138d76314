"""The rollup kept by loads, the joins and pages that use what loads have noted."""

import datetime
import itertools
import os

import pytest
from pyspark.sql import functions as F

from stormgrid import schemas
from stormgrid.checks import fixtures as fx, queries as q
from stormgrid.operators import marts, reports, rollup, sizing, upsert
from stormgrid.plans import daily
from test_plans import tree

DAY = datetime.date


def rows_of(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=str)


@pytest.fixture
def loads(spark, sf_dir):
    """Three overlapping runs as fact rows."""
    facts = q._stored(spark, q._run_facts(spark, sf_dir))
    return [facts.where(F.col("run_date") == F.lit(d).cast("date")).drop("run_date") for d in q.RUN_DAYS]


def load(spark, root, rows):
    daily.load_fact(spark, f"{root}/fact", rows)
    daily.refresh_rollup(spark, root, rows)


def assert_current(spark, root):
    """The stored rollup equals one computed from the whole fact."""
    fact = daily.read_fact(spark, f"{root}/fact")
    for name, (cells, schema, _) in daily.ROLLUPS.items():
        want = cells(fact).select(*schema.fieldNames())
        assert rows_of(daily.read_rollup(spark, root, name)) == rows_of(want), name


def test_three_loads_equal_a_full_recompute(spark, folder, sf_dir, loads):
    for rows in loads:
        load(spark, folder, rows)
        assert_current(spark, folder)
    load(spark, folder, loads[-1])  # a load may be repeated
    assert_current(spark, folder)
    # and the reports over it equal those over the rows
    fact, dim = daily.read_fact(spark, f"{folder}/fact"), fx.dim(spark, sf_dir)
    view = upsert.serving_view(fact, dim)
    cities = rollup.merged(daily.read_rollup(spark, folder, "city_months"), "city_id")
    for kept, plain in (
        (reports.hottest_cities(cities, dim), marts.hottest_cities(fact, dim)),
        (reports.wettest_cities(cities, dim), marts.wettest_cities(fact, dim)),
        (reports.map_points(cities, dim), marts.map_points(view)),
        (reports.kpis(cities, dim), marts.kpis(view)),
        (reports.risk_by_city(cities, dim), marts.risk_by_city(view)),
        (reports.risk_pivot(fact, dim, q.PICKED), marts.risk_pivot(view, q.PICKED)),
        (reports.city_names(cities, dim), marts.city_names(view)),
    ):
        assert rows_of(kept) == rows_of(plain)


def over_months(rows):
    """The same figures for the three months that follow too."""
    later = [rows.withColumn("forecast_date", F.date_add("forecast_date", 31 * n)) for n in (1, 2, 3)]
    for more in later:
        rows = rows.unionByName(more)
    return rows


def test_a_load_leaves_other_months_alone(spark, folder, loads):
    load(spark, folder, over_months(loads[0]))

    def files():
        found = {}
        for base, _, names in os.walk(f"{folder}/rollup"):
            for n in names:
                if n.startswith("part-"):
                    found[os.path.join(base, n)] = os.path.getmtime(os.path.join(base, n))
        return found

    before = files()
    load(spark, folder, loads[1].where("forecast_date BETWEEN '2024-01-01' AND '2024-01-31'"))
    after = files()
    kept = {f for f in before if "month=2024-01-01" not in f}
    assert kept and {f: before[f] for f in kept} == {f: after[f] for f in after if "month=2024-01-01" not in f}
    assert_current(spark, folder)


def test_removal_refreshes_the_rollup(spark, folder, sf_dir, loads):
    daily.load_dim(spark, f"{folder}/dim", fx.dim(spark, sf_dir))
    load(spark, folder, loads[0])
    load(spark, folder, loads[0].where("city_id = 3").limit(1).withColumn("forecast_date", F.lit("2031-05-05").cast("date")))
    assert not daily.read_rollup(spark, folder, "days").where("month = '2031-05-01'").isEmpty()
    daily.remove_cities(spark, folder, fx.dim(spark, sf_dir).where("city_id IN (3, 4)"))
    assert_current(spark, folder)
    assert daily.read_rollup(spark, folder, "days").where("month = '2031-05-01'").isEmpty()


@pytest.fixture(scope="module")
def four_months(spark, sf_dir, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("months"))
    load(spark, root, over_months(q._stored_fact(spark, sf_dir)))
    return root


@pytest.mark.parametrize(
    "first, last",
    [
        (DAY(2024, 1, 1), DAY(2024, 1, 31)),
        (DAY(2024, 1, 2), DAY(2024, 1, 30)),
        (DAY(2024, 1, 31), DAY(2024, 2, 1)),
        (DAY(2023, 12, 15), DAY(2024, 3, 1)),
        (DAY(2024, 1, 1), DAY(2024, 3, 15)),
        (DAY(2024, 2, 10), DAY(2024, 2, 10)),
        (DAY(2030, 1, 1), DAY(2031, 1, 1)),
    ],
)
def test_periods(spark, four_months, first, last):
    root = four_months
    fact = daily.read_fact(spark, f"{root}/fact")
    want = rollup.of_fact(fact.where(F.col("forecast_date").between(first, last)), "city_id")
    assert rows_of(daily.period_figures(spark, root, first, last)) == rows_of(want)


def test_reports_of_nothing(spark, folder):
    cells, dim = daily.read_rollup(spark, folder, "city_months"), spark.createDataFrame([], schemas.DIM)
    cities = rollup.merged(cells, "city_id")
    assert reports.kpis(cities, dim).collect() == [(0, None, None, 0, None)]
    assert reports.summary(cells).collect() == [(0, None, 0)]
    assert reports.bounds(cells).collect() == [(None, None)]
    for report in (reports.map_points, reports.hottest_cities, reports.top_city, reports.city_names):
        assert report(cities, dim).collect() == []
    assert reports.flag_counts(cells).collect() == []
    assert daily.stored_bounds(spark, folder) is None
    assert daily.open_period(spark, folder, "Aujourd'hui", DAY(2024, 1, 1)) is None


def test_the_view_reads_the_fact_once_and_without_a_job(spark, sf_dir, monkeypatch):
    root = q._maintained(spark, sf_dir)
    want = rows_of(daily.open_view(spark, root))
    monkeypatch.setattr(sizing, "BROADCAST_ROWS", 3)
    context = spark.sparkContext
    context.setJobGroup("build", "the plan only")
    view = daily.open_view(spark, root)
    # listing many partitions of a table is the one thing Spark itself may do as a job
    jobs = [context.statusTracker().getJobInfo(j) for j in context.statusTracker().getJobIdsForGroup("build")]
    context.setJobGroup("use", "")
    scans = [f for f in tree(view).splitlines() if "Scan parquet" in f]
    assert len(jobs) <= 1 and len([f for f in scans]) <= 4
    text = view._jdf.queryExecution().executedPlan().toString()
    assert text.count("loaded_at#") and text.count(f"{root}/fact]") <= 1
    assert rows_of(view) == want
    context.setLocalProperty("spark.jobGroup.id", None)


def test_hot_cities_are_noted(spark, folder, sf_dir, monkeypatch):
    monkeypatch.setattr(sizing, "HOT_SHARES", 3)
    daily.load_dim(spark, f"{folder}/dim", fx.dim(spark, sf_dir))
    rows = q._stored_fact(spark, sf_dir)
    load(spark, folder, rows.where("city_id = 7 OR (city_id < 5 AND day(forecast_date) = 1)"))
    known = daily.known_joins(spark, folder)
    assert known.small and [r[0] for r in known.hot.collect()] == [7]
    by_name = daily._known_names(known, fx.dim(spark, sf_dir))
    assert [r[0] for r in by_name.hot.collect()] == ["NATION_7"]


def test_spread_join_gives_the_same_rows(spark, sf_dir):
    """Hot keys, rows without a key and unknown keys, inner and left."""
    rows = spark.createDataFrame(
        [(k, n) for n, k in enumerate([1] * 40 + [2] * 5 + [None] * 6 + [9] * 3 + [1] * 10)], "city_id int, n int"
    ).unionByName(spark.createDataFrame([(1, 0)] * 7, "city_id int, n int"))
    dim = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "city_id int, name string")
    for hot, how in itertools.product(([], [1], [1, 2, 77]), ("inner", "left")):
        known = sizing.Known(False, spark.createDataFrame([(h,) for h in hot], "city_id int"))
        got = sizing.join_known(rows, dim, "city_id", known, how)
        assert rows_of(got) == rows_of(rows.join(dim, "city_id", how)), (hot, how)


def test_pages_make_up_the_table(spark):
    """Ties over page borders, equal cities, and nulls in every key column."""
    days = [None, DAY(2024, 1, 1), DAY(2024, 1, 2), DAY(2024, 1, 3)]
    keys = list(itertools.product([None, 10.5, 20.25, 99.0], [None, "a", "b"], days))
    rows = [(c, d, None, None, None, s, "Faible", "Complet") for s, c, d in keys]
    schema = (
        "city_name string, forecast_date date, temp_max double, precipitation_mm double, wind_gust_max double, "
        "risk_score decimal(5,2), risk_level string, data_quality_flag string"
    )
    view = spark.createDataFrame([], schema).unionByName(
        spark.createDataFrame(rows, schema.replace("decimal(5,2)", "double")).withColumn(
            "risk_score", F.col("risk_score").cast("decimal(5,2)")
        )
    )
    want = [tuple(r) for r in marts.detail_table(view).collect()]
    for size in (1, 7, 48, 100):
        got, after = [], None
        while page := marts.detail_page(view, size, after).collect():
            got += [tuple(r) for r in page]
            after = marts.page_end(page)
            assert len(page) <= size
        assert got == want, size
    assert marts.page_end([]) is None


def test_a_page_is_a_seek(spark, sf_dir):
    view = daily.open_view(spark, q._maintained(spark, sf_dir))
    first = marts.detail_page(view, 10).collect()
    nodes = tree(marts.detail_page(view, 10, marts.page_end(first)))
    assert "TakeOrderedAndProject" in nodes and "rangepartitioning" not in nodes
    text = marts.detail_page(view, 10, marts.page_end(first))._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(risk_score" in text


def test_stored_bounds_scan_nothing(spark, sf_dir):
    root = q._maintained(spark, sf_dir)
    first, last = daily.stored_bounds(spark, root)
    assert tuple(marts.filter_bounds(daily.read_fact(spark, f"{root}/fact")).first()) == (first, last)
    for preset, today in itertools.product([*q.marts.policy.PERIODS, "?"], [first, last, DAY(1999, 1, 1), DAY(2024, 1, 10)]):
        want = marts.period_bounds(daily.open_view(spark, root), preset, today).first()
        assert daily.open_period(spark, root, preset, today) == tuple(want), (preset, today)


def test_ordered_export(spark, sf_dir, folder):
    root = q._maintained(spark, sf_dir)
    daily.export_view(spark, root, f"{folder}/csv")
    lines = []
    for name in sorted(n for n in os.listdir(f"{folder}/csv") if n.startswith("part-")):
        with open(f"{folder}/csv/{name}", encoding="utf-8") as f:
            lines += f.read().splitlines()[1:]
    keys = [(r[0], r[3]) for r in (line.split(",") for line in lines)]
    assert keys == sorted(keys) and len(keys) == daily.open_view(spark, root).count()
    ordered = [(r["city_name"], r["forecast_date"]) for r in q.QUERIES["serving_ordered"](spark, sf_dir).collect()]
    assert ordered == sorted(ordered)
