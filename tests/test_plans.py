"""What the physical plans must and must not contain."""

import contextlib
import datetime
import io
import os
import re

import pytest
from pyspark.sql import functions as F

from stormgrid import schemas
from stormgrid.checks import fixtures as fx, queries as q
from stormgrid.operators import marts, upsert
from stormgrid.plans import silver as silver_plan
from stormgrid.sources import layers


def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def tree(df):
    return plan(df).split("\n\n")[0]


@pytest.mark.parametrize("name", sorted(q.QUERIES))
def test_no_cross_join_and_no_python(spark, sf_dir, name):
    text = plan(q.QUERIES[name](spark, sf_dir))
    for word in ["CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow"]:
        assert word not in text


@pytest.mark.parametrize("name", ["silver", "gold", "gold_orders", "silver_from_bronze"])
def test_one_shuffle_to_gold(spark, sf_dir, name):
    nodes = tree(q.QUERIES[name](spark, sf_dir))
    assert len(re.findall(r"\bExchange\b", nodes)) == 1
    # one row per key and task before the shuffle
    below = nodes[nodes.index("Exchange") :]
    assert "WindowGroupLimit" in below


def test_scores_need_no_shuffle(spark, sf_dir):
    assert not re.findall(r"\bExchange\b", tree(q.risk_score(spark, sf_dir)))


def test_top_lists_do_not_sort_everything(spark, sf_dir):
    for name in ["q1_hottest", "q2_wettest", "q3_riskiest_cities", "risk_by_city_top15", "top_city"]:
        assert "TakeOrderedAndProject" in tree(q.QUERIES[name](spark, sf_dir))


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    """Fact and dimension as the load stores them."""
    root = str(tmp_path_factory.mktemp("run"))
    layers.write_layer(q._fact(spark, sf_dir), f"{root}/fact", "forecast_date", ["city_id"])
    fx.dim(spark, sf_dir).write.parquet(f"{root}/dim")
    fact = spark.read.schema(schemas.FACT).parquet(f"{root}/fact")
    return fact, spark.read.schema(schemas.DIM).parquet(f"{root}/dim")


def test_questions_read_their_columns_only(spark, stored):
    text = plan(marts.hottest_cities(*stored))
    assert "ReadSchema: struct<city_id:int,temp_max:decimal(5,2)>" in text
    assert "ReadSchema: struct<forecast_date" not in text


def test_aggregation_precedes_the_name_join(spark, stored):
    nodes = tree(marts.riskiest_cities(*stored))
    assert nodes.index("BroadcastHashJoin") < nodes.index("HashAggregate")


def test_filters_reach_the_scan(spark, stored):
    view = upsert.serving_view(*stored)
    picked = marts.apply_filters(view, ["NATION_1"], ("2024-01-05", "2024-01-20"), ["Élevé"])
    text = plan(picked)
    assert re.search(r"PartitionFilters: \[.*forecast_date.*2024-01-05", text)
    assert re.search(r"PushedFilters: \[.*(EqualTo|In)\(risk_level", text)
    assert re.search(r"PushedFilters: \[.*(EqualTo|In)\(city_name", text)


def test_fact_is_not_shuffled_by_a_small_load(spark, stored):
    fact, _ = stored
    merged = upsert.upsert_fact(fact, fact.limit(5))
    assert "BroadcastHashJoin" in tree(merged)


def test_run_reads_its_partition_only(spark, sf_dir, tmp_path):
    runs = silver_plan.from_typed(fx.run_forecasts(spark, sf_dir), tiebreak=["id"], run=["run_date"])
    layers.write_layer(runs, str(tmp_path / "silver"), "run_date", ["city", "forecast_date"])
    one = layers.read_layer(spark, str(tmp_path / "silver"), schemas.SILVER, "2024-01-02")
    assert all("run_date=2024-01-02" in f for f in one.inputFiles())


def test_landing_moves_base_rows_and_writes_compressed_lines(spark, folder):
    """The days of a payload are made behind the shuffle and its sort, and land gzipped."""
    start = datetime.datetime(2024, 1, 1)
    events = [
        (i, start + datetime.timedelta(minutes=i), i % 50, "view", f'{{"k": {i % 100}}}') for i in [*range(1500), 7, 7]
    ]
    spark.createDataFrame(
        events, "event_id long, ts timestamp_ntz, user_id long, event_type string, props string"
    ).write.parquet(f"{folder}/events.parquet")
    nations = [(i, f"NATION_{i}") for i in range(25)]
    spark.createDataFrame(nations, "n_nationkey int, n_name string").write.parquet(f"{folder}/nation.parquet")
    for rows in (fx.payloads(spark, folder), fx.defective_lines(spark, folder)):
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        above, below = plan.split("RebalancePartitions")
        assert "Sort" in above and "city_name" in below and "transform" not in below
    path = fx.bronze_folder(spark, folder)
    assert spark.read.text(path).count() == len(events)
    text = spark.read.text(path).agg(F.sum(F.length("value"))).first()[0]
    files = [os.path.join(at, f) for at, _, names in os.walk(path) for f in names if not f.startswith((".", "_"))]
    assert all(f.endswith(".gz") for f in files) and sum(map(os.path.getsize, files)) * 2 < text
