"""Forecast-shaped inputs derived from the driver's tables.

Every value is a fixed formula of a unique row number, so that SQL can derive the same rows.
Formulas use integer arithmetic and double literals, in the same order in both dialects.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stormgrid.schemas import DAILY_COLUMNS
from stormgrid.session import scratch
from stormgrid.sources import bronze

RUN_DATE = "2024-01-01"
LOADED_AT = "2024-02-01 06:00:00"
DAYS = 7

# FIXED VALUES: the 28 known weather codes and two unknown ones.
CODES = [
    0, 1, 2, 3, 45, 48, 51, 53, 55, 56, 57, 61, 63, 65, 66,
    67, 71, 73, 75, 77, 80, 81, 82, 85, 86, 95, 96, 99, 42, 100,
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- base rows: id, ts, city_key, k, kind ------------------------------------------------


def events_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "event_id AS id",
        "ts",
        "CAST(user_id % 25 AS INT) AS city_key",
        """CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INT) AS k""",
        "event_type AS kind",
    )


def orders_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS id",
        "CAST(o_orderdate AS TIMESTAMP_NTZ) AS ts",
        "CAST(o_custkey % 25 AS INT) AS city_key",
        "CAST(o_orderkey % 100 AS INT) AS k",
        "IF(o_orderstatus = 'P', 'error', 'ok') AS kind",
    )


# --- measures of a row number ------------------------------------------------------------


def _measures(n: str) -> dict[str, str]:
    """SQL of each measure of row number ``n``, given columns k and kind."""
    temp = f"IF({n} % 97 <> 0, ({n} * 37 % 900 - 250) / 1e1, NULL)"
    rain = f"({n} * 53 % 5300 - 200) / 1e1"
    gust = f"({n} * 7 % 1000) / 1e1"
    codes = ", ".join(map(str, CODES))
    return {
        "temp_max": temp,
        "temp_min": f"{temp} + 2e0 - ({n} * 13 % 200) / 1e1",
        "precipitation_mm": f"""CASE WHEN kind = 'error' AND {n} % 3 = 0 THEN NULL
            WHEN {n} % 5 < 2 THEN 0e0 WHEN {n} % 10 = 9 THEN {rain} ELSE {rain} * 1e-1 END""",
        "precipitation_prob": f"IF({n} % 41 <> 0, CAST((k * 13 + {n}) % 116 - 8 AS DOUBLE), NULL)",
        "wind_speed_max": f"({n} * 11 % 3300 - 100) / 1e1",
        "wind_gust_max": f"IF({n} % 43 <> 0, IF({n} % 50 = 7, {gust} * 4e0, {gust}), NULL)",
        "weather_code": f"IF({n} % 59 <> 0, array({codes})[CAST({n} * 7 % 30 AS INT)], NULL)",
    }


def dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").selectExpr(
        "n_nationkey AS city_id",
        "n_name AS city_name",
        "IF(n_nationkey % 11 <> 10, CAST(n_nationkey * 17 % 140 - 70 AS DOUBLE), NULL) AS latitude",
        "CAST(n_nationkey * 29 % 340 - 170 AS DOUBLE) AS longitude",
    )


def forecasts(spark: SparkSession, sf_dir: str, base=events_base) -> DataFrame:
    """Typed, uncleaned forecast rows, one per base row."""
    cities = dim(spark, sf_dir)
    rows = base(spark, sf_dir).join(cities, F.expr("city_key = city_id"))
    return rows.selectExpr(
        "id",
        "city_id",
        "city_name AS city",
        "latitude",
        "longitude",
        "CAST(ts AS DATE) AS forecast_date",
        *[f"{sql} AS {name}" for name, sql in _measures("id").items()],
        "ts AS extracted_at",
    )


def run_forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows dealt to three daily runs."""
    start = F.lit(RUN_DATE).cast("date")
    return forecasts(spark, sf_dir).withColumn("run_date", F.date_add(start, (F.col("id") % 3).cast("int")))


# --- city list ---------------------------------------------------------------------------


def city_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A long list with repeated, padded names and lacking coordinates."""
    return (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey"))
        .selectExpr(
            "IF(c_custkey % 4 = 0, concat(' \\t', n_name, '  '), n_name) AS city",
            "IF(c_custkey % 11 <> 10, CAST(c_custkey * 17 % 140 - 70 AS DOUBLE), NULL) AS lat",
            "IF(c_custkey % 13 <> 5, CAST(c_custkey * 29 % 340 - 170 AS DOUBLE), NULL) AS lng",
            "c_custkey AS position",
        )
    )


def partial_city_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list without one region's cities: for joins that must meet names they do not know."""
    absent = table(spark, sf_dir, "nation").where("n_regionkey = 4").select(F.col("n_name").alias("name"))
    listed = city_list(spark, sf_dir)
    return listed.join(absent, F.trim(F.regexp_replace("city", "\t", "")) == F.col("name"), "left_anti")


def city_file(spark: SparkSession, sf_dir: str) -> str:
    """The city list as a CSV file among columns a scan does not need."""
    path = scratch(spark, "cities")
    (
        city_list(spark, sf_dir)
        .select(
            F.lit("X").alias("country"),
            "city",
            F.col("lng").alias("lng"),
            F.col("position").alias("population"),
            "lat",
        )
        .write.option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


# --- raw payloads ------------------------------------------------------------------------


DEFECTS = {"cut": "id % 101 = 5", "dayless": "id % 103 = 7", "short": "id % 107 = 9", "worded": "id % 109 = 11"}
DEFECTIVE = " OR ".join(DEFECTS.values())


def _payload_days(spark: SparkSession, sf_dir: str, which: str) -> DataFrame:
    """One payload per base row of those ``which``, by run date: a fetch at ``ts`` with seven days
    of forecasts. Day ``i`` of row ``id`` takes the measures of row number ``id * 7 + i``.

    The base rows are brought together, at a seventh of a payload's size, before the days are made."""
    rows = events_base(spark, sf_dir).where(which).join(dim(spark, sf_dir), F.expr("city_key = city_id"))
    rows = bronze.by_run_date(rows.withColumn("run_date", F.expr("CAST(ts AS DATE)")))
    series = {"forecast_date": "CAST(date_add(CAST(ts AS DATE), i) AS STRING)"}
    series.update(_measures(f"(id * {DAYS} + i)"))
    arrays = [
        f"'{raw}', transform(sequence(0, {DAYS - 1}), i -> {series[silver]})"
        for raw, silver in DAILY_COLUMNS.items()
    ]
    return rows.selectExpr(
        "id",
        "run_date",
        "city_name",
        "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\") AS fetched_at",
        "latitude",
        "longitude",
        f"named_struct({', '.join(arrays)}) AS daily",
    )


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sound payloads, stamped and ready to land."""
    rows = _payload_days(spark, sf_dir, f"NOT ({DEFECTIVE})").select(
        "run_date", "latitude", "longitude", "daily", "city_name", "fetched_at"
    )
    return bronze.stamp_payloads(rows, F.concat(F.lit(" "), "city_name"), F.col("fetched_at")).drop(
        "city_name", "fetched_at"
    )


def defective_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other payloads as text: cut off, without days, with a short array, with words
    among the numbers (which spoils that one cell only)."""
    rows = _payload_days(spark, sf_dir, DEFECTIVE).withColumns(
        {"_city_name": F.concat(F.lit(" "), "city_name"), "_extracted_at": F.col("fetched_at")}
    )
    envelope = ["latitude", "longitude", "_city_name", "_extracted_at"]
    whole = F.to_json(F.struct(*envelope, "daily"))
    short = F.col("daily").withField("weather_code", F.slice(F.col("daily.weather_code"), 1, DAYS - 1))
    worded = F.col("daily").withField(
        "temperature_2m_max",
        F.transform(
            F.col("daily.temperature_2m_max"),
            lambda t, i: F.when(i == 3, "n/a").otherwise(t.cast("string")),
        ),
    )
    line = (
        F.when(F.expr(DEFECTS["cut"]), F.substring(whole, 1, 60))
        .when(F.expr(DEFECTS["dayless"]), F.to_json(F.struct(*envelope)))
        .when(F.expr(DEFECTS["short"]), F.to_json(F.struct(*envelope, short.alias("daily"))))
        .when(F.expr(DEFECTS["worded"]), F.to_json(F.struct(*envelope, worded.alias("daily"))))
    )
    return rows.select("run_date", line.alias("value"))


_LANDED: dict[tuple[str, str], str] = {}


def bronze_folder(spark: SparkSession, sf_dir: str) -> str:
    """Land all payloads once per session; the scans that follow read the same files."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LANDED:
        path = scratch(spark, "bronze")
        bronze.land_payloads(payloads(spark, sf_dir), path)  # by run date as they come
        bronze.land_lines(defective_lines(spark, sf_dir), "text", path, "append")
        _LANDED[key] = path
    return _LANDED[key]
