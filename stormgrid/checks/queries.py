"""One query per operator over the driver's tables, each on all their rows."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stormgrid import schemas
from stormgrid.checks import fixtures as fx
from stormgrid.functions import coerce, scoring
from stormgrid.operators import clean, constraints, marts, quality, reference, reports, rollup, sizing, upsert
from stormgrid.plans import daily, gold as gold_plan, silver as silver_plan
from stormgrid.schemas import DAILY_COLUMNS, MEASURES
from stormgrid.session import scratch
from stormgrid.sources import bronze, cities, layers

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

RUN_DAYS = ["2024-01-01", "2024-01-02", "2024-01-03"]
TODAY = datetime.date(2024, 1, 10)
PICKED = ["NATION_1", "NATION_3", "NATION_10", "NATION_24"]
RUN_DATE, LOADED_AT = fx.RUN_DATE, fx.LOADED_AT


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


# --- layers of the fixture ----------------------------------------------------------------


def _latest(spark: SparkSession, sf: str) -> DataFrame:
    return clean.latest_per_key(
        fx.forecasts(spark, sf), ["city", "forecast_date"], "extracted_at", ["id"]
    )


def _silver(spark: SparkSession, sf: str) -> DataFrame:
    return silver_plan.from_typed(fx.forecasts(spark, sf), tiebreak=["id"])


def _gold(spark: SparkSession, sf: str) -> DataFrame:
    return gold_plan.gold(_silver(spark, sf), RUN_DATE)


def _stamp() -> Column:
    return F.lit(LOADED_AT).cast("timestamp_ntz")


def _fact(spark: SparkSession, sf: str) -> DataFrame:
    return upsert.serving_rows(_gold(spark, sf), fx.dim(spark, sf), _stamp())


def _stored(spark: SparkSession, df: DataFrame) -> DataFrame:
    """A table written first, for queries that read it several times or are about what
    reaches a scan. Filters on a computed score would otherwise be pushed below it, and drag
    copies of the whole formula with them."""
    path = scratch(spark, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _stored_fact(spark: SparkSession, sf: str) -> DataFrame:
    return _stored(spark, _fact(spark, sf))


def _stored_view(spark: SparkSession, sf: str) -> DataFrame:
    return upsert.serving_view(_stored_fact(spark, sf), fx.dim(spark, sf))


def _view(spark: SparkSession, sf: str) -> DataFrame:
    return upsert.serving_view(_fact(spark, sf), fx.dim(spark, sf))


def _plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, for comparison with another engine."""
    return df.withColumns(
        {f.name: F.col(f.name).cast("double") for f in df.schema.fields if f.dataType.typeName() == "decimal"}
    )


# --- sources ------------------------------------------------------------------------------


@query
def scan_cities(spark: SparkSession, sf: str) -> DataFrame:
    return cities.scan_cities(spark, fx.city_file(spark, sf))


@query
def contract_check(spark: SparkSession, sf: str) -> DataFrame:
    partial = fx.city_list(spark, sf).drop("lng")
    return schemas.contract_report(partial, schemas.CITY_COLUMNS)


@query
def drop_null_coords(spark: SparkSession, sf: str) -> DataFrame:
    return cities.drop_null_coords(fx.city_list(spark, sf))


def _scan(spark: SparkSession, sf: str) -> DataFrame:
    return bronze.scan_bronze(spark, fx.bronze_folder(spark, sf))


@query
def bronze_scan(spark: SparkSession, sf: str) -> DataFrame:
    return bronze.usable(_scan(spark, sf)).select(
        "run_date",
        F.col("_city_name").alias("city_name"),
        F.col("_extracted_at").alias("extracted_at"),
        F.col("latitude").cast("double").alias("latitude"),
        F.size("daily.time").alias("days"),
        F.element_at("daily.time", -1).alias("last_day"),
    )


@query
def bronze_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    rejected = bronze.quarantine(_scan(spark, sf))
    return rejected.groupBy("run_date", "reason").agg(F.count("*").alias("payloads"))


@query
def explode_daily(spark: SparkSession, sf: str) -> DataFrame:
    rows = bronze.explode_daily(bronze.usable(_scan(spark, sf)))
    numbers = ["latitude", "longitude", *[c for c in DAILY_COLUMNS if c != "time"]]
    return rows.withColumns({c: F.col(c).try_cast("double") for c in numbers})


@query
def standardize(spark: SparkSession, sf: str) -> DataFrame:
    return clean.standardize(bronze.explode_daily(bronze.usable(_scan(spark, sf))))


@query
def silver_from_bronze(spark: SparkSession, sf: str) -> DataFrame:
    return silver_plan.from_payloads(_scan(spark, sf))


@query
def union_runs(spark: SparkSession, sf: str) -> DataFrame:
    runs = fx.run_forecasts(spark, sf)
    first, *others = [runs.where(F.col("run_date") == F.lit(day).cast("date")) for day in RUN_DAYS]
    return bronze.union_runs(first.drop("wind_speed_max"), *others).select("id", "run_date", "city", "wind_speed_max", "temp_max")


@query
def read_layer(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "silver")
    runs = silver_plan.from_typed(fx.run_forecasts(spark, sf), tiebreak=["id"], run=["run_date"])
    layers.write_layer(runs, path, "run_date", ["city", "forecast_date"])
    return layers.read_layer(spark, path, schemas.SILVER, "2024-01-02")


@query
def read_layer_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "silver-csv")
    runs = silver_plan.from_typed(fx.run_forecasts(spark, sf), tiebreak=["id"], run=["run_date"])
    layers.export_csv(runs, path)
    return layers.read_layer(spark, path, schemas.SILVER, "2024-01-03", fmt="csv")


@query
def serving_view(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(_view(spark, sf))


@query
def safe_name(spark: SparkSession, sf: str) -> DataFrame:
    named = F.concat("c_name", F.lit(" / "), "c_mktsegment")
    return fx.table(spark, sf, "customer").select(
        "c_custkey", coerce.safe_name(named).alias("token")
    )


@query
def nan_to_null(spark: SparkSession, sf: str) -> DataFrame:
    nan = F.lit(float("nan"))
    rows = fx.forecasts(spark, sf)
    spoiled = rows.withColumns(
        {c: F.when(F.col("id") % (n + 7) == 0, nan).otherwise(F.col(c)) for n, c in enumerate(MEASURES)}
    )
    return schemas.nan_to_null(spoiled, MEASURES).select("id", *MEASURES)


# --- cleaning -----------------------------------------------------------------------------


@query
def dedupe_latest(spark: SparkSession, sf: str) -> DataFrame:
    return _latest(spark, sf).select("id", "city", "forecast_date", "extracted_at")


@query
def duplicate_count(spark: SparkSession, sf: str) -> DataFrame:
    return clean.duplicate_count(fx.forecasts(spark, sf), ["city", "forecast_date"])


@query
def dedupe_first(spark: SparkSession, sf: str) -> DataFrame:
    return reference.reference_list(cities.drop_null_coords(fx.city_list(spark, sf)), "position")


@query
def fix_inverted_temps(spark: SparkSession, sf: str) -> DataFrame:
    return clean.fix_inverted_temps(fx.forecasts(spark, sf)).select("id", "temp_min", "temp_max")


@query
def null_out_of_range(spark: SparkSession, sf: str) -> DataFrame:
    return clean.null_out_of_range(fx.forecasts(spark, sf)).select("id", *MEASURES)


@query
def dq_rule_counts(spark: SparkSession, sf: str) -> DataFrame:
    return clean.dq_rule_counts(_latest(spark, sf))


@query
def fractional_codes(spark: SparkSession, sf: str) -> DataFrame:
    coded = fx.forecasts(spark, sf).select(
        F.when(F.col("id") % 10 == 3, F.col("weather_code") + 0.5)
        .otherwise(F.col("weather_code"))
        .cast("string")
        .alias("weather_code")
    )
    return clean.unreadable_codes(coded)


@query
def silver(spark: SparkSession, sf: str) -> DataFrame:
    return _silver(spark, sf)


# --- scoring ------------------------------------------------------------------------------


@query
def categories(spark: SparkSession, sf: str) -> DataFrame:
    return gold_plan.with_categories(_silver(spark, sf)).select(
        "city", "forecast_date", "temp_category", "precipitation_category", "wind_category"
    )


@query
def risk_components(spark: SparkSession, sf: str) -> DataFrame:
    parts = [c.alias(n) for n, c in gold_plan.risk_parts().items()]
    return _silver(spark, sf).select("city", "forecast_date", *parts)


@query
def severity_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return fx.forecasts(spark, sf).select(
        "id", "weather_code", scoring.severity(F.col("weather_code")).alias("severity")
    )


@query
def risk_score(spark: SparkSession, sf: str) -> DataFrame:
    """Every uncleaned row: far more rounding cases than the deduplicated layer holds."""
    rows = clean.apply_rules(fx.forecasts(spark, sf))
    return gold_plan.with_score(rows).select("id", "risk_score")


@query
def risk_level(spark: SparkSession, sf: str) -> DataFrame:
    return gold_plan.with_score(_silver(spark, sf)).select("city", "forecast_date", "risk_level")


@query
def quality_flag(spark: SparkSession, sf: str) -> DataFrame:
    rows = clean.apply_rules(fx.forecasts(spark, sf))
    return gold_plan.with_score(rows).select("id", "data_quality_flag")


@query
def calendar(spark: SparkSession, sf: str) -> DataFrame:
    run_date = F.lit(RUN_DATE).cast("date")
    return gold_plan.with_calendar(_silver(spark, sf), run_date).select(
        "city", "forecast_date", "day_of_week", "is_weekend", "days_ahead"
    )


@query
def gold(spark: SparkSession, sf: str) -> DataFrame:
    return _gold(spark, sf)


@query
def gold_orders(spark: SparkSession, sf: str) -> DataFrame:
    """The whole path to gold over the largest base."""
    typed = fx.forecasts(spark, sf, fx.orders_base)
    return gold_plan.gold(silver_plan.from_typed(typed, tiebreak=["id"]), "1995-01-01")


# --- reference list and coverage ----------------------------------------------------------


def _reference(spark: SparkSession, sf: str) -> DataFrame:
    return reference.reference_list(cities.drop_null_coords(fx.partial_city_list(spark, sf)), "position")


@query
def join_cities(spark: SparkSession, sf: str) -> DataFrame:
    joined = reference.join_cities(fx.forecasts(spark, sf), _reference(spark, sf))
    return joined.select("id", "city", "city_lat", "city_lng")


@query
def unmatched_cities(spark: SparkSession, sf: str) -> DataFrame:
    return reference.unmatched(fx.forecasts(spark, sf), _reference(spark, sf))


@query
def coverage_manifest(spark: SparkSession, sf: str) -> DataFrame:
    requests = fx.events_base(spark, sf).select(
        F.col("ts").cast("date").alias("run_date"),
        F.concat(F.lit("city "), F.col("city_key")).alias("city"),
        "kind",
    )
    return reference.coverage(requests, requests.where("kind = 'click'"))


# --- quality ------------------------------------------------------------------------------


@query
def quality_report(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality_report(_silver(spark, sf))


@query
def missing_pct(spark: SparkSession, sf: str) -> DataFrame:
    return quality.missing_pct(_silver(spark, sf))


@query
def days_per_city(spark: SparkSession, sf: str) -> DataFrame:
    return quality.days_per_city(fx.forecasts(spark, sf, fx.orders_base))


@query
def coverage_evenness(spark: SparkSession, sf: str) -> DataFrame:
    return quality.coverage_evenness(fx.forecasts(spark, sf, fx.orders_base))


@query
def gold_summary(spark: SparkSession, sf: str) -> DataFrame:
    return quality.gold_summary(_gold(spark, sf))


@query
def top_city(spark: SparkSession, sf: str) -> DataFrame:
    return quality.top_city(_gold(spark, sf))


@query
def quality_flag_counts(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality_flag_counts(_gold(spark, sf))


@query
def constraint_violations(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs side by side break the key, and a shortened dimension leaves orphans."""
    dim = fx.dim(spark, sf)
    runs = silver_plan.from_typed(fx.run_forecasts(spark, sf), tiebreak=["id"], run=["run_date"])
    rows = gold_plan.gold(runs, F.col("run_date"))
    fact = _stored(spark, upsert.serving_rows(rows, dim, _stamp()))
    return constraints.constraint_violations(dim.where("longitude < 100"), fact)


# --- serving ------------------------------------------------------------------------------


@query
def serving_cast(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(_fact(spark, sf))


@query
def unmapped_cities(spark: SparkSession, sf: str) -> DataFrame:
    return upsert.unmapped_cities(_gold(spark, sf), fx.dim(spark, sf).where("longitude < 100"))


@query
def incoming_cities(spark: SparkSession, sf: str) -> DataFrame:
    return upsert.incoming_cities(_silver(spark, sf))


@query
def upsert_dim(spark: SparkSession, sf: str) -> DataFrame:
    """A dimension that grows with the data: all but one segment of the customers known, all
    but another offered."""
    key = F.col("c_custkey")
    customers = fx.table(spark, sf, "customer")
    existing = customers.where("c_mktsegment <> 'MACHINERY'").select(
        (key + 1).cast("int").alias("city_id"),
        F.col("c_name").alias("city_name"),
        (key % 90).cast("double").alias("latitude"),
        (key % 180).cast("double").alias("longitude"),
    )
    offered = customers.where("c_mktsegment <> 'HOUSEHOLD'").select(
        F.col("c_name").alias("city_name"),
        F.when(key % 11 != 10, (key % 70).cast("double")).alias("latitude"),
        (key % 140).cast("double").alias("longitude"),
    )
    return upsert.upsert_dim(existing, upsert.with_coordinates(offered))


def _run_facts(spark: SparkSession, sf: str) -> DataFrame:
    """Fact rows of three runs, with their run date."""
    runs = silver_plan.from_typed(fx.run_forecasts(spark, sf), tiebreak=["id"], run=["run_date"])
    rows = gold_plan.gold(runs, F.col("run_date"))
    mapped = upsert.with_city_id(rows, fx.dim(spark, sf))
    values = schemas.serving_values()
    return mapped.select(
        "run_date", "city_id", "forecast_date", *[c.alias(n) for n, c in values.items()], _stamp().alias("loaded_at")
    )


@query
def upsert_fact(spark: SparkSession, sf: str) -> DataFrame:
    """The three runs loaded one after the other."""
    facts = _stored(spark, _run_facts(spark, sf))
    table, *later = [
        facts.where(F.col("run_date") == F.lit(day).cast("date")).drop("run_date") for day in RUN_DAYS
    ]
    for run in later:
        table = upsert.upsert_fact(table, run)
    return _plain(table)


@query
def cascade_delete(spark: SparkSession, sf: str) -> DataFrame:
    gone = fx.dim(spark, sf).where("latitude > 20")
    return upsert.cascade_delete(_fact(spark, sf), gone).select("city_id", "forecast_date", "risk_level")


@query
def history_append(spark: SparkSession, sf: str) -> DataFrame:
    facts = _run_facts(spark, sf)
    return _plain(upsert.history_rows(facts, F.col("run_date"), _stamp()))


@query
def history_latest(spark: SparkSession, sf: str) -> DataFrame:
    facts = _run_facts(spark, sf)
    history = upsert.history_rows(facts, F.col("run_date"), _stamp())
    return _plain(upsert.history_latest(history))


@query
def history_as_of(spark: SparkSession, sf: str) -> DataFrame:
    facts = _run_facts(spark, sf)
    history = upsert.history_rows(facts, F.col("run_date"), _stamp())
    second = F.lit("2024-01-02").cast("date")
    return _plain(upsert.history_latest(history, second)).select(
        "run_date", "city_id", "forecast_date", "risk_score"
    )


# --- questions and reports ----------------------------------------------------------------


@query
def q1_hottest(spark: SparkSession, sf: str) -> DataFrame:
    return marts.hottest_cities(_fact(spark, sf), fx.dim(spark, sf))


@query
def q2_wettest(spark: SparkSession, sf: str) -> DataFrame:
    return marts.wettest_cities(_fact(spark, sf), fx.dim(spark, sf))


@query
def q3_riskiest_cities(spark: SparkSession, sf: str) -> DataFrame:
    return marts.riskiest_cities(_fact(spark, sf), fx.dim(spark, sf))


@query
def q4_riskiest_dates(spark: SparkSession, sf: str) -> DataFrame:
    return marts.riskiest_dates(_fact(spark, sf))


@query
def q5_worst_day_per_city(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(marts.worst_days(_stored_fact(spark, sf), fx.dim(spark, sf)))


@query
def filter_view(spark: SparkSession, sf: str) -> DataFrame:
    start, end = datetime.date(2024, 1, 5), datetime.date(2024, 1, 20)
    filtered = marts.apply_filters(_stored_view(spark, sf), PICKED, (start, end), ["Modéré", "Élevé"])
    return _plain(filtered)


@query
def period_filter(spark: SparkSession, sf: str) -> DataFrame:
    week = marts.in_period(_stored_view(spark, sf), "7 prochains jours", TODAY)
    return week.select("city_name", "forecast_date", "risk_level")


@query
def high_risk(spark: SparkSession, sf: str) -> DataFrame:
    gold = _stored(spark, _gold(spark, sf))
    return marts.high_risk(gold).select("city", "forecast_date", "risk_score", "risk_level")


def _cities(spark: SparkSession, sf: str) -> DataFrame:
    return rollup.of_fact(_fact(spark, sf), "city_id")


@query
def map_points(spark: SparkSession, sf: str) -> DataFrame:
    return reports.map_points(_cities(spark, sf), fx.dim(spark, sf))


@query
def kpis(spark: SparkSession, sf: str) -> DataFrame:
    return reports.kpis(_cities(spark, sf), fx.dim(spark, sf))


@query
def risk_by_city_top15(spark: SparkSession, sf: str) -> DataFrame:
    return reports.risk_by_city(_cities(spark, sf), fx.dim(spark, sf))


@query
def risk_pivot(spark: SparkSession, sf: str) -> DataFrame:
    return reports.risk_pivot(_fact(spark, sf), fx.dim(spark, sf), PICKED)


@query
def detail_table(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(marts.detail_table(_view(spark, sf)))


@query
def city_names(spark: SparkSession, sf: str) -> DataFrame:
    return reports.city_names(_fact(spark, sf), fx.dim(spark, sf))


@query
def filter_bounds(spark: SparkSession, sf: str) -> DataFrame:
    return marts.filter_bounds(_fact(spark, sf))


# --- reports over the maintained rollup ---------------------------------------------------

_MAINTAINED: dict[tuple[str, str], str] = {}


def _maintained(spark: SparkSession, sf: str) -> str:
    """A root whose fact was loaded three times, with its rollup: all rows of every other city with
    wrong figures first, then one half of the days, then all rows. Built once a session."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _MAINTAINED:
        root = scratch(spark, "root")
        daily.load_dim(spark, f"{root}/dim", fx.dim(spark, sf))
        rows = _stored_fact(spark, sf)
        wrong = rows.where("city_id % 2 = 0").withColumn("temp_max", F.lit(59).cast("decimal(5,2)"))
        for load in (wrong.withColumn("risk_level", F.lit("Critique")), rows.where("day(forecast_date) < 16"), rows):
            daily.load_fact(spark, f"{root}/fact", load)
            daily.refresh_rollup(spark, root, load)
        _MAINTAINED[key] = root
    return _MAINTAINED[key]


def _cells(spark: SparkSession, sf: str, name: str = "city_months") -> DataFrame:
    return daily.read_rollup(spark, _maintained(spark, sf), name)


def _city_figures(spark: SparkSession, sf: str) -> DataFrame:
    return rollup.merged(_cells(spark, sf), "city_id")


@query
def rollup_hottest(spark: SparkSession, sf: str) -> DataFrame:
    return reports.hottest_cities(_city_figures(spark, sf), fx.dim(spark, sf))


@query
def rollup_wettest(spark: SparkSession, sf: str) -> DataFrame:
    return reports.wettest_cities(_city_figures(spark, sf), fx.dim(spark, sf))


@query
def rollup_riskiest_cities(spark: SparkSession, sf: str) -> DataFrame:
    return reports.riskiest_cities(_city_figures(spark, sf), fx.dim(spark, sf))


@query
def rollup_riskiest_dates(spark: SparkSession, sf: str) -> DataFrame:
    return reports.riskiest_dates(_cells(spark, sf, "days"))


@query
def rollup_summary(spark: SparkSession, sf: str) -> DataFrame:
    return reports.summary(_cells(spark, sf))


@query
def rollup_top_city(spark: SparkSession, sf: str) -> DataFrame:
    return reports.top_city(_city_figures(spark, sf), fx.dim(spark, sf))


@query
def rollup_flag_counts(spark: SparkSession, sf: str) -> DataFrame:
    return reports.flag_counts(_cells(spark, sf))


@query
def rollup_map_points(spark: SparkSession, sf: str) -> DataFrame:
    return reports.map_points(_city_figures(spark, sf), fx.dim(spark, sf))


@query
def rollup_kpis(spark: SparkSession, sf: str) -> DataFrame:
    return reports.kpis(_city_figures(spark, sf), fx.dim(spark, sf))


@query
def rollup_top15(spark: SparkSession, sf: str) -> DataFrame:
    return reports.risk_by_city(_city_figures(spark, sf), fx.dim(spark, sf))


@query
def rollup_city_names(spark: SparkSession, sf: str) -> DataFrame:
    return reports.city_names(_cells(spark, sf), fx.dim(spark, sf))


@query
def rollup_bounds(spark: SparkSession, sf: str) -> DataFrame:
    return reports.bounds(_cells(spark, sf, "days"))


@query
def rollup_period_kpis(spark: SparkSession, sf: str) -> DataFrame:
    """A period from which some months are whole and come from their cells."""
    figures = daily.period_figures(spark, _maintained(spark, sf), datetime.date(2023, 12, 20), datetime.date(2024, 2, 10))
    return reports.kpis(figures, fx.dim(spark, sf))


@query
def stored_period(spark: SparkSession, sf: str) -> DataFrame:
    """The week from today, by days that the fact's partitions name."""
    root = _maintained(spark, sf)
    week = daily.open_period(spark, root, "7 prochains jours", TODAY)
    return marts.apply_filters(daily.open_view(spark, root), date_range=week).select("city_name", "forecast_date", "risk_level")


@query
def serving_view_spread(spark: SparkSession, sf: str) -> DataFrame:
    """The view as it is joined when the dimension is too large to broadcast: hot cities, noted by
    the loads, are spread over all tasks."""
    root = _maintained(spark, sf)
    known = sizing.Known(False, daily.known_joins(spark, root).hot)
    dim, _ = daily.read_dim(spark, f"{root}/dim")
    return _plain(upsert.serving_view(daily.read_fact(spark, f"{root}/fact"), dim, known))


PAGE = 40


@query
def detail_page(spark: SparkSession, sf: str) -> DataFrame:
    """The third page, each found from the end of the one before it."""
    view = daily.open_view(spark, _maintained(spark, sf))
    after = None
    for _ in range(2):
        after = marts.page_end(marts.detail_page(view, PAGE, after).collect())
    return _plain(marts.detail_page(view, PAGE, after))


@query
def serving_ordered(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(daily.open_view(spark, _maintained(spark, sf))).orderBy("city_name", "forecast_date")


# --- stored jobs --------------------------------------------------------------------------


def _stored_history(spark: SparkSession, sf: str) -> str:
    """A root that holds the history of the three runs, with a snapshot after the second."""
    root = scratch(spark, "root")
    facts = _stored(spark, _run_facts(spark, sf))
    for day in RUN_DAYS:
        rows = facts.where(F.col("run_date") == F.lit(day).cast("date"))
        daily.write_history(spark, root, upsert.history_rows(rows, F.col("run_date"), _stamp()).drop("run_date"), day)
        if day == RUN_DAYS[1]:
            held = daily.history_as_of(spark, root, datetime.date.fromisoformat(day))
            held.write.parquet(f"{root}/snapshots/as_of={day}")
    return root


@query
def history_stored_latest(spark: SparkSession, sf: str) -> DataFrame:
    """The newest state, from a snapshot and the one run after it."""
    root = _stored_history(spark, sf)
    rows = daily.history_as_of(spark, root, datetime.date(2024, 1, 3))
    return _plain(rows).select("run_date", "city_id", "forecast_date", "risk_score", "recorded_at")


@query
def cascade_history(spark: SparkSession, sf: str) -> DataFrame:
    """The history after the stored removal of some cities."""
    root = _stored_history(spark, sf)
    daily.load_dim(spark, f"{root}/dim", fx.dim(spark, sf))
    daily.remove_cities(spark, root, fx.dim(spark, sf).where("latitude > 20"))
    rows = spark.read.parquet(f"{root}/history")
    return _plain(rows).select("run_date", "city_id", "forecast_date", "risk_score", "risk_level")


@query
def rejected_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rows whose figures outgrow their declared types, one by one."""
    spoiled = _gold(spark, sf).withColumns(
        {"precipitation_mm": F.col("precipitation_mm") * 1000, "wind_gust_max": F.col("wind_gust_max") * 16}
    )
    return upsert.castable(spoiled)[1].select("city", "forecast_date", "reason")
