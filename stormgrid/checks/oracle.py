"""The same questions in plain SQL on the driver's tables, written independently of the plans."""

from __future__ import annotations

MEASURES = [
    "temp_max",
    "temp_min",
    "precipitation_mm",
    "precipitation_prob",
    "wind_speed_max",
    "wind_gust_max",
]
MEASURE_LIST = ", ".join(MEASURES)


def _measures(n: str, k: str, kind: str) -> str:
    """Measures of row number ``n``."""
    temp = f"CASE WHEN {n} % 97 <> 0 THEN ({n} * 37 % 900 - 250) / 1e1 END"
    return f"""
        {temp} AS temp_max,
        {temp} + 2e0 - ({n} * 13 % 200) / 1e1 AS temp_min,
        CASE WHEN {kind} = 'error' AND {n} % 3 = 0 THEN NULL
             WHEN {n} % 5 < 2 THEN 0e0
             WHEN {n} % 10 = 9 THEN ({n} * 53 % 5300 - 200) / 1e1
             ELSE ({n} * 53 % 5300 - 200) / 1e1 * 1e-1 END AS precipitation_mm,
        CASE WHEN {n} % 41 <> 0 THEN CAST(({k} * 13 + {n}) % 116 - 8 AS DOUBLE) END AS precipitation_prob,
        ({n} * 11 % 3300 - 100) / 1e1 AS wind_speed_max,
        CASE WHEN {n} % 43 = 0 THEN NULL
             WHEN {n} % 50 = 7 THEN ({n} * 7 % 1000) / 1e1 * 4e0
             ELSE ({n} * 7 % 1000) / 1e1 END AS wind_gust_max,
        CASE WHEN {n} % 59 <> 0 THEN CAST([0, 1, 2, 3, 45, 48, 51, 53, 55, 56, 57, 61, 63, 65, 66,
             67, 71, 73, 75, 77, 80, 81, 82, 85, 86, 95, 96, 99, 42, 100][{n} * 7 % 30 + 1] AS INTEGER)
             END AS weather_code"""


EVENTS = """
    SELECT event_id AS id, ts, CAST(user_id % 25 AS INTEGER) AS city_key,
           CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) AS k, event_type AS kind
    FROM events"""

ORDERS = """
    SELECT o_orderkey AS id, CAST(o_orderdate AS TIMESTAMP) AS ts, CAST(o_custkey % 25 AS INTEGER) AS city_key,
           CAST(o_orderkey % 100 AS INTEGER) AS k,
           CASE WHEN o_orderstatus = 'P' THEN 'error' ELSE 'ok' END AS kind
    FROM orders"""


def _ctes(base: str = EVENTS, run_date: str = "DATE '2024-01-01'", runs: bool = False) -> str:
    """Fixture, silver, gold and serving tables. With ``runs`` the rows are dealt to three
    runs that are cleaned apart."""
    run = "run_date, " if runs else ""
    dealt = "CAST(DATE '2024-01-01' + CAST(id % 3 AS INTEGER) AS DATE) AS run_date," if runs else ""
    ahead = "run_date" if runs else run_date
    return f"""
WITH base AS ({base}),
dim AS (
    SELECT n_nationkey AS city_id, n_name AS city_name,
           CASE WHEN n_nationkey % 11 <> 10 THEN CAST(n_nationkey * 17 % 140 - 70 AS DOUBLE) END AS latitude,
           CAST(n_nationkey * 29 % 340 - 170 AS DOUBLE) AS longitude
    FROM nation),
wx AS (
    SELECT {dealt} id, city_id, city_name AS city, latitude, longitude, CAST(ts AS DATE) AS forecast_date,
           {_measures("id", "k", "kind")}, ts AS extracted_at
    FROM base JOIN dim ON city_key = city_id),
latest AS (
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY {run} city, forecast_date
                                     ORDER BY extracted_at DESC NULLS FIRST, id DESC) AS rn
        FROM wx) WHERE rn = 1),
{_rules("latest", "clean")},
silver AS (
    SELECT {run} city, latitude, longitude, forecast_date, {MEASURE_LIST}, weather_code, extracted_at
    FROM clean),
{_scored("silver", "scored")},
gold AS (
    SELECT *,
           dayname(forecast_date) AS day_of_week,
           isodow(forecast_date) IN (5, 6) AS is_weekend,
           CAST(forecast_date - {ahead} AS INTEGER) AS days_ahead
    FROM scored),
fact AS (
    SELECT {run} dim.city_id, forecast_date,
           CAST(temp_max AS DECIMAL(5, 2)) AS temp_max, CAST(temp_min AS DECIMAL(5, 2)) AS temp_min,
           CAST(precipitation_mm AS DECIMAL(6, 2)) AS precipitation_mm,
           CAST(precipitation_prob AS DECIMAL(5, 2)) AS precipitation_prob,
           CAST(wind_speed_max AS DECIMAL(5, 2)) AS wind_speed_max,
           CAST(wind_gust_max AS DECIMAL(5, 2)) AS wind_gust_max,
           weather_code, temp_category, precipitation_category, wind_category,
           CAST(risk_score AS DECIMAL(5, 2)) AS risk_score, risk_level, data_quality_flag, extracted_at,
           TIMESTAMP '2024-02-01 06:00:00' AS loaded_at
    FROM gold JOIN dim ON city = city_name),
seen AS (
    SELECT city_name, latitude, longitude, forecast_date, temp_max, temp_min, precipitation_mm,
           precipitation_prob, wind_speed_max, wind_gust_max, weather_code, temp_category,
           precipitation_category, wind_category, risk_score, risk_level, data_quality_flag
    FROM fact JOIN dim USING (city_id))
"""


def _rules(source: str, into: str) -> str:
    return f"""{into}_pairs AS (
    SELECT * REPLACE (CASE WHEN temp_min > temp_max THEN NULL ELSE temp_max END AS temp_max,
                      CASE WHEN temp_min > temp_max THEN NULL ELSE temp_min END AS temp_min)
    FROM {source}),
{into} AS (
    SELECT * REPLACE (
        CASE WHEN temp_max < -20 OR temp_max > 60 THEN NULL ELSE temp_max END AS temp_max,
        CASE WHEN temp_min < -20 OR temp_min > 60 THEN NULL ELSE temp_min END AS temp_min,
        CASE WHEN precipitation_mm < 0 OR precipitation_mm > 500 THEN NULL ELSE precipitation_mm END AS precipitation_mm,
        CASE WHEN precipitation_prob < 0 OR precipitation_prob > 100 THEN NULL ELSE precipitation_prob END AS precipitation_prob,
        CASE WHEN wind_speed_max < 0 OR wind_speed_max > 300 THEN NULL ELSE wind_speed_max END AS wind_speed_max,
        CASE WHEN wind_gust_max < 0 OR wind_gust_max > 300 THEN NULL ELSE wind_gust_max END AS wind_gust_max)
    FROM {into}_pairs)"""


SEVERITY = """CASE WHEN weather_code IS NULL THEN 0
    WHEN weather_code IN (0, 1, 2, 3) THEN 0
    WHEN weather_code IN (51, 53, 61) THEN 1
    WHEN weather_code IN (45, 48, 55, 56, 63, 71, 80) THEN 2
    WHEN weather_code IN (57, 65, 66, 73, 77, 81, 85) THEN 3
    WHEN weather_code IN (67, 75, 82, 86, 95, 96, 99) THEN 4
    ELSE 2 END"""
RAIN_POINTS = """(least(coalesce(precipitation_mm, 0e0), 30e0) / 30e0 * 25e0
    + coalesce(precipitation_prob, 0e0) / 100e0 * 10e0)"""
GUST_POINTS = "(least(coalesce(wind_gust_max, 0e0), 90e0) / 90e0 * 30e0)"
TEMP_POINTS = """(CASE WHEN temp_max > 38 THEN least((temp_max - 38e0) * 15e-1, 15e0)
    WHEN temp_max < 5 THEN least((5e0 - temp_max) * 15e-1, 15e0) ELSE 0e0 END)"""
SEVERITY_POINTS = f"({SEVERITY}) * 5e0"


def _scored(source: str, into: str) -> str:
    return f"""{into}_sum AS (
    SELECT *, least({RAIN_POINTS} + {GUST_POINTS} + {TEMP_POINTS} + {SEVERITY_POINTS}, 100e0) AS total
    FROM {source}),
{into} AS (
    SELECT * EXCLUDE (total),
        CASE WHEN temp_max IS NULL THEN 'Inconnu' WHEN temp_max < 15 THEN 'Froid' WHEN temp_max < 30 THEN 'Normal'
             WHEN temp_max < 38 THEN 'Chaud' ELSE 'Extrême' END AS temp_category,
        CASE WHEN precipitation_mm IS NULL THEN 'Inconnu' WHEN precipitation_mm = 0 THEN 'Aucune'
             WHEN precipitation_mm < 5 THEN 'Faible' WHEN precipitation_mm < 20 THEN 'Modérée'
             ELSE 'Forte' END AS precipitation_category,
        CASE WHEN wind_gust_max IS NULL THEN 'Inconnu' WHEN wind_gust_max < 30 THEN 'Calme'
             WHEN wind_gust_max < 50 THEN 'Modéré' WHEN wind_gust_max < 70 THEN 'Fort'
             ELSE 'Violent' END AS wind_category,
        CAST(format('{{:.1f}}', total) AS DOUBLE) AS risk_score,
        CASE WHEN CAST(format('{{:.1f}}', total) AS DOUBLE) < 25 THEN 'Faible'
             WHEN CAST(format('{{:.1f}}', total) AS DOUBLE) < 50 THEN 'Modéré'
             WHEN CAST(format('{{:.1f}}', total) AS DOUBLE) < 75 THEN 'Élevé' ELSE 'Critique' END AS risk_level,
        CASE (temp_max IS NULL)::INT + (precipitation_mm IS NULL)::INT + (wind_gust_max IS NULL)::INT
             + (weather_code IS NULL)::INT
             WHEN 0 THEN 'Complet' WHEN 1 THEN 'Partiel' WHEN 2 THEN 'Partiel' ELSE 'Manquant' END AS data_quality_flag
    FROM {into}_sum)"""


WX = _ctes()
RUNS = _ctes(runs=True)
ORDERS_WX = _ctes(ORDERS, "DATE '1995-01-01'")

CITY_LIST = """
WITH listed AS (
    SELECT CASE WHEN c_custkey % 4 = 0 THEN ' ' || chr(9) || n_name || '  ' ELSE n_name END AS city,
           CASE WHEN c_custkey % 11 <> 10 THEN CAST(c_custkey * 17 % 140 - 70 AS DOUBLE) END AS lat,
           CASE WHEN c_custkey % 13 <> 5 THEN CAST(c_custkey * 29 % 340 - 170 AS DOUBLE) END AS lng,
           c_custkey AS position, n_name, n_regionkey
    FROM customer JOIN nation ON c_nationkey = n_nationkey),
reference AS (
    SELECT n_name AS city, lat AS city_lat, lng AS city_lng FROM (
        SELECT *, row_number() OVER (PARTITION BY n_name ORDER BY position) AS rn
        FROM listed WHERE lat IS NOT NULL AND lng IS NOT NULL) WHERE rn = 1)
"""

# For the joins, the list lacks one region.
PARTIAL_LIST = CITY_LIST.replace("WITH listed", ", listed").replace(
    "FROM listed WHERE lat", "FROM listed WHERE n_regionkey <> 4 AND lat"
)

# One row per payload and day; defects mirror the landed fixture.
PAYLOADS = f"""
WITH base AS ({EVENTS}),
dim AS (
    SELECT n_nationkey AS city_id, n_name AS city_name,
           CASE WHEN n_nationkey % 11 <> 10 THEN CAST(n_nationkey * 17 % 140 - 70 AS DOUBLE) END AS latitude,
           CAST(n_nationkey * 29 % 340 - 170 AS DOUBLE) AS longitude
    FROM nation),
fetched AS (
    SELECT *, CAST(ts AS DATE) AS run_date,
           CASE WHEN id % 101 = 5 THEN 'malformed' WHEN id % 103 = 7 THEN 'no_daily'
                WHEN id % 107 = 9 THEN 'length_mismatch' END AS reason
    FROM base JOIN dim ON city_key = city_id),
days AS (
    SELECT run_date, city_name AS city, latitude, longitude, ts AS extracted_at, id, i,
           CAST(run_date + CAST(i AS INTEGER) AS DATE) AS forecast_date,
           {_measures("(id * 7 + i)", "k", "kind")}
    FROM fetched CROSS JOIN range(7) AS r(i) WHERE reason IS NULL),
raw AS (
    SELECT * REPLACE (CASE WHEN id % 109 = 11 AND i = 3 THEN NULL ELSE temp_max END AS temp_max) FROM days)
"""

DOUBLES = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in [*MEASURES, "risk_score"])


def _exact_mean(column: str) -> str:
    return f"CAST(sum(CAST({column} AS DECIMAL(8, 2))) AS DOUBLE) / nullif(count({column}), 0)"


HIGH = "risk_level IN ('Élevé', 'Critique')"

_LOADED = RUNS + """, replayed AS (
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY city_id, forecast_date ORDER BY run_date DESC) AS rn
        FROM fact) WHERE rn = 1)
"""

ORACLE: dict[str, str] = {
    # sources
    "scan_cities": CITY_LIST + "SELECT city, lat, lng FROM listed",
    "contract_check": CITY_LIST
    + """SELECT 'city' AS column_name, count(city) AS filled_rows, true AS present FROM listed
         UNION ALL SELECT 'lat', count(lat), true FROM listed
         UNION ALL SELECT 'lng', count(*) - count(*), false FROM listed""",
    "drop_null_coords": CITY_LIST
    + "SELECT city, lat, lng, position FROM listed WHERE lat IS NOT NULL AND lng IS NOT NULL",
    "bronze_scan": PAYLOADS
    + """SELECT run_date, ' ' || city_name AS city_name, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS extracted_at,
                latitude, 7 AS days, strftime(run_date + 6, '%Y-%m-%d') AS last_day
         FROM fetched WHERE reason IS NULL""",
    "bronze_quarantine": PAYLOADS
    + "SELECT run_date, reason, count(*) AS payloads FROM fetched WHERE reason IS NOT NULL GROUP BY 1, 2",
    "explode_daily": PAYLOADS
    + """SELECT run_date, ' ' || city AS city, latitude, longitude,
                strftime(extracted_at, '%Y-%m-%dT%H:%M:%S.%f') AS extracted_at,
                strftime(forecast_date, '%Y-%m-%d') AS "time", temp_max AS temperature_2m_max,
                temp_min AS temperature_2m_min, precipitation_mm AS precipitation_sum,
                precipitation_prob AS precipitation_probability_max, wind_speed_max AS wind_speed_10m_max,
                wind_gust_max AS wind_gusts_10m_max, CAST(weather_code AS DOUBLE) AS weather_code
         FROM raw""",
    "standardize": PAYLOADS
    + f"""SELECT run_date, city, latitude, longitude, extracted_at, forecast_date, {MEASURE_LIST}, weather_code
          FROM raw""",
    "silver_from_bronze": PAYLOADS
    + f""", latest AS (
            SELECT * FROM (
                SELECT *, row_number() OVER (PARTITION BY run_date, city, forecast_date
                                             ORDER BY extracted_at DESC) AS rn
                FROM raw) WHERE rn = 1),
          {_rules("latest", "clean")}
          SELECT run_date, city, latitude, longitude, forecast_date, {MEASURE_LIST}, weather_code, extracted_at
          FROM clean""",
    "union_runs": RUNS
    + """SELECT id, run_date, city, CASE WHEN id % 3 <> 0 THEN wind_speed_max END AS wind_speed_max, temp_max
         FROM wx""",
    "read_layer": RUNS + "SELECT * FROM silver WHERE run_date = DATE '2024-01-02'",
    "read_layer_csv": RUNS + "SELECT * FROM silver WHERE run_date = DATE '2024-01-03'",
    "serving_view": WX + f"SELECT * REPLACE ({DOUBLES}) FROM seen",
    "safe_name": "SELECT c_custkey, replace(c_name, ' ', '_') || '___' || replace(c_mktsegment, ' ', '_') AS token FROM customer",
    "nan_to_null": WX
    + "SELECT id, "
    + ", ".join(f"CASE WHEN id % {n + 7} <> 0 THEN {c} END AS {c}" for n, c in enumerate(MEASURES))
    + " FROM wx",
    # cleaning
    "dedupe_latest": WX + "SELECT id, city, forecast_date, extracted_at FROM latest",
    "duplicate_count": WX
    + """SELECT CAST(sum(n - 1) AS BIGINT) AS duplicates
         FROM (SELECT count(*) AS n FROM wx GROUP BY city, forecast_date)""",
    "dedupe_first": CITY_LIST + "SELECT * FROM reference",
    "fix_inverted_temps": WX
    + """SELECT id, CASE WHEN temp_min > temp_max THEN NULL ELSE temp_min END AS temp_min,
                CASE WHEN temp_min > temp_max THEN NULL ELSE temp_max END AS temp_max FROM wx""",
    "null_out_of_range": WX
    + """SELECT id,
            CASE WHEN temp_max BETWEEN -20 AND 60 THEN temp_max END AS temp_max,
            CASE WHEN temp_min BETWEEN -20 AND 60 THEN temp_min END AS temp_min,
            CASE WHEN precipitation_mm BETWEEN 0 AND 500 THEN precipitation_mm END AS precipitation_mm,
            CASE WHEN precipitation_prob BETWEEN 0 AND 100 THEN precipitation_prob END AS precipitation_prob,
            CASE WHEN wind_speed_max BETWEEN 0 AND 300 THEN wind_speed_max END AS wind_speed_max,
            CASE WHEN wind_gust_max BETWEEN 0 AND 300 THEN wind_gust_max END AS wind_gust_max
         FROM wx""",
    "dq_rule_counts": WX
    + """, hits AS (
            SELECT 'inverted_temps' AS rule, count(*) FILTER (WHERE temp_min > temp_max) AS hits FROM latest
            UNION ALL SELECT 'temp_max_range', count(*) FILTER (WHERE temp_max < -20 OR temp_max > 60) FROM clean_pairs
            UNION ALL SELECT 'temp_min_range', count(*) FILTER (WHERE temp_min < -20 OR temp_min > 60) FROM clean_pairs
            UNION ALL SELECT 'precipitation_negative', count(*) FILTER (WHERE precipitation_mm < 0) FROM latest
            UNION ALL SELECT 'precipitation_excessive', count(*) FILTER (WHERE precipitation_mm > 500) FROM latest
            UNION ALL SELECT 'wind_speed_range', count(*) FILTER (WHERE wind_speed_max < 0 OR wind_speed_max > 300) FROM latest
            UNION ALL SELECT 'wind_gust_range', count(*) FILTER (WHERE wind_gust_max < 0 OR wind_gust_max > 300) FROM latest
            UNION ALL SELECT 'probability_range', count(*) FILTER (WHERE precipitation_prob < 0 OR precipitation_prob > 100) FROM latest)
         SELECT rule, hits FROM hits""",
    "fractional_codes": WX
    + "SELECT count(*) AS fractional_codes FROM wx WHERE id % 10 = 3 AND weather_code IS NOT NULL",
    "silver": WX + "SELECT * FROM silver",
    # scoring
    "categories": WX
    + "SELECT city, forecast_date, temp_category, precipitation_category, wind_category FROM gold",
    "risk_components": WX
    + f"""SELECT city, forecast_date, {RAIN_POINTS} AS rain_points, {GUST_POINTS} AS gust_points,
                 {TEMP_POINTS} AS temp_points, {SEVERITY_POINTS} AS severity_points FROM silver""",
    "severity_lookup": WX + f"SELECT id, weather_code, {SEVERITY} AS severity FROM wx",
    "risk_score": WX
    + f""", {_rules("wx", "every")}, {_scored("every", "rated")} SELECT id, risk_score FROM rated""",
    "risk_level": WX + "SELECT city, forecast_date, risk_level FROM gold",
    "quality_flag": WX
    + f""", {_rules("wx", "every")}, {_scored("every", "rated")} SELECT id, data_quality_flag FROM rated""",
    "calendar": WX + "SELECT city, forecast_date, day_of_week, is_weekend, days_ahead FROM gold",
    "gold": WX + "SELECT * FROM gold",
    "gold_orders": ORDERS_WX + "SELECT * FROM gold",
    # reference list and coverage
    "join_cities": WX
    + PARTIAL_LIST
    + "SELECT id, city, city_lat, city_lng FROM wx LEFT JOIN reference USING (city)",
    "unmatched_cities": WX
    + PARTIAL_LIST
    + """SELECT city, count(*) AS "rows" FROM wx WHERE city NOT IN (SELECT city FROM reference) GROUP BY city""",
    "coverage_manifest": WX
    + """, wanted AS (
            SELECT CAST(ts AS DATE) AS run_date, 'city ' || city_key AS city, max(CASE WHEN kind = 'click' THEN 1 ELSE 0 END) AS ok, count(*) AS listed
            FROM base GROUP BY 1, 2),
         totals AS (SELECT run_date, CAST(sum(listed) AS BIGINT) AS total_cities, CAST(sum(ok * listed) AS BIGINT) AS success_count
                    FROM wanted GROUP BY 1)
         SELECT run_date, total_cities, success_count, city AS failed_city
         FROM totals LEFT JOIN (SELECT * FROM wanted WHERE ok = 0) USING (run_date)""",
    # quality
    "quality_report": WX
    + 'SELECT count(*) AS "rows", count(DISTINCT city) AS cities, min(forecast_date) AS date_min, '
    + "max(forecast_date) AS date_max, "
    + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS missing_{c}" for c in MEASURES)
    + " FROM silver",
    "missing_pct": WX
    + "SELECT column_name, missing, missing * 100 / CAST(n AS DOUBLE) AS pct FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS missing, count(*) AS n FROM silver"
        for c in MEASURES
    )
    + ") WHERE missing > 0",
    "days_per_city": ORDERS_WX + "SELECT city, count(DISTINCT forecast_date) AS days FROM wx GROUP BY city",
    "coverage_evenness": ORDERS_WX
    + """SELECT min(days) AS min_days, max(days) AS max_days, min(days) <> max(days) AS uneven
         FROM (SELECT count(DISTINCT forecast_date) AS days FROM wx GROUP BY city)""",
    "gold_summary": WX
    + f"""SELECT count(*) AS "rows", {_exact_mean("risk_score")} AS mean_score,
                 count(*) FILTER (WHERE risk_score >= 50) AS high_risk_rows FROM gold""",
    "top_city": WX
    + f"""SELECT city, {_exact_mean("risk_score")} AS mean_score FROM gold GROUP BY city
          ORDER BY mean_score DESC, city LIMIT 1""",
    "quality_flag_counts": WX
    + 'SELECT data_quality_flag, count(*) AS "rows" FROM gold GROUP BY data_quality_flag',
    "constraint_violations": RUNS
    + ", few AS (SELECT * FROM dim WHERE longitude < 100) "
    + " UNION ALL ".join(
        [
            f"SELECT '{t}' AS table_name, '{c} not null' AS rule, count(*) FILTER (WHERE {c} IS NULL) AS violations FROM {v}"
            for t, v, cs in [
                ("dim", "few", ["city_id", "city_name", "latitude", "longitude"]),
                ("fact", "fact", ["city_id", "forecast_date", "risk_score", "risk_level", "data_quality_flag"]),
            ]
            for c in cs
        ]
        + [
            f"SELECT '{t}', '{c} at most {n} characters', count(*) FILTER (WHERE length({c}) > {n}) FROM {v}"
            for t, v, n, cs in [
                ("dim", "few", 100, ["city_name"]),
                (
                    "fact",
                    "fact",
                    20,
                    ["temp_category", "precipitation_category", "wind_category", "risk_level", "data_quality_flag"],
                ),
            ]
            for c in cs
        ]
        + [
            "SELECT 'dim', 'city_id unique', count(*) - count(DISTINCT city_id) FROM few",
            "SELECT 'dim', 'city_name unique', count(*) - count(DISTINCT city_name) FROM few",
            """SELECT 'fact', 'city_id, forecast_date unique',
                      count(*) - (SELECT count(*) FROM (SELECT DISTINCT city_id, forecast_date FROM fact)) FROM fact""",
            "SELECT 'fact', 'city_id in dim', count(*) FROM fact WHERE city_id NOT IN (SELECT city_id FROM few)",
        ]
    ),
    # serving
    "serving_cast": WX + f"SELECT * REPLACE ({DOUBLES}) FROM fact",
    "unmapped_cities": WX
    + """SELECT city, count(*) AS "rows" FROM gold
         WHERE city NOT IN (SELECT city_name FROM dim WHERE longitude < 100) GROUP BY city""",
    "incoming_cities": WX
    + """SELECT city AS city_name, latitude, longitude FROM (
            SELECT *, row_number() OVER (PARTITION BY city ORDER BY forecast_date) AS rn FROM silver) WHERE rn = 1""",
    "upsert_dim": """
        WITH existing AS (
            SELECT CAST(c_custkey + 1 AS INTEGER) AS city_id, c_name AS city_name,
                   CAST(c_custkey % 90 AS DOUBLE) AS latitude, CAST(c_custkey % 180 AS DOUBLE) AS longitude
            FROM customer WHERE c_mktsegment <> 'MACHINERY'),
        offered AS (
            SELECT c_name AS city_name, CAST(c_custkey % 70 AS DOUBLE) AS latitude,
                   CAST(c_custkey % 140 AS DOUBLE) AS longitude
            FROM customer WHERE c_mktsegment <> 'HOUSEHOLD' AND c_custkey % 11 <> 10)
        SELECT city_id, city_name, coalesce(o.latitude, e.latitude) AS latitude,
               coalesce(o.longitude, e.longitude) AS longitude
        FROM existing e LEFT JOIN offered o USING (city_name)
        UNION ALL
        SELECT CAST((SELECT max(city_id) FROM existing) + row_number() OVER (ORDER BY city_name) AS INTEGER),
               city_name, latitude, longitude
        FROM offered WHERE city_name NOT IN (SELECT city_name FROM existing)""",
    "upsert_fact": _LOADED + f"SELECT * EXCLUDE (run_date) REPLACE ({DOUBLES}) FROM replayed",
    "cascade_delete": WX + "SELECT city_id, forecast_date, risk_level FROM fact JOIN dim USING (city_id) WHERE latitude <= 20 OR latitude IS NULL",
    "history_append": RUNS
    + f"""SELECT * EXCLUDE (temp_category, precipitation_category, wind_category, loaded_at)
          REPLACE ({DOUBLES}), loaded_at AS recorded_at FROM fact""",
    "history_latest": _LOADED
    + f"""SELECT * EXCLUDE (temp_category, precipitation_category, wind_category, loaded_at)
          REPLACE ({DOUBLES}), loaded_at AS recorded_at FROM replayed""",
    "history_as_of": RUNS
    + """SELECT run_date, city_id, forecast_date, CAST(risk_score AS DOUBLE) AS risk_score FROM (
            SELECT *, row_number() OVER (PARTITION BY city_id, forecast_date ORDER BY run_date DESC) AS rn
            FROM fact WHERE run_date <= DATE '2024-01-02') WHERE rn = 1""",
    # questions and reports
    "q1_hottest": WX
    + f"""SELECT city_name, round({_exact_mean("temp_max")}, 2) AS avg_temp_max,
                 CAST(max(temp_max) AS DOUBLE) AS peak_temp_max
          FROM fact JOIN dim USING (city_id) GROUP BY city_name ORDER BY avg_temp_max DESC NULLS FIRST, city_name LIMIT 10""",
    "q2_wettest": WX
    + f"""SELECT city_name, CAST(sum(precipitation_mm) AS DOUBLE) AS total_mm,
                 {_exact_mean("precipitation_prob")} AS avg_probability
          FROM fact JOIN dim USING (city_id) GROUP BY city_name HAVING sum(precipitation_mm) > 0
          ORDER BY total_mm DESC, city_name LIMIT 10""",
    "q3_riskiest_cities": WX
    + f"""SELECT city_name, {_exact_mean("risk_score")} AS avg_score,
                 count(*) FILTER (WHERE {HIGH}) AS high_risk_days
          FROM fact JOIN dim USING (city_id) GROUP BY city_name ORDER BY avg_score DESC, city_name LIMIT 10""",
    "q4_riskiest_dates": WX
    + f"""SELECT forecast_date, {_exact_mean("risk_score")} AS avg_score,
                 count(*) FILTER (WHERE {HIGH}) AS high_risk_cities
          FROM fact GROUP BY forecast_date ORDER BY avg_score DESC, forecast_date""",
    "q5_worst_day_per_city": WX
    + """SELECT city_name, forecast_date, CAST(risk_score AS DOUBLE) AS risk_score, risk_level FROM (
            SELECT city_name, forecast_date, risk_score, risk_level,
                   rank() OVER (PARTITION BY city_name ORDER BY risk_score DESC) AS place
            FROM fact JOIN dim USING (city_id)) WHERE place = 1""",
    "filter_view": WX
    + f"""SELECT * REPLACE ({DOUBLES}) FROM seen
          WHERE city_name IN ('NATION_1', 'NATION_3', 'NATION_10', 'NATION_24')
            AND forecast_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'
            AND risk_level IN ('Modéré', 'Élevé')""",
    "period_filter": WX
    + """SELECT city_name, forecast_date, risk_level FROM seen
         WHERE forecast_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-16'""",
    "high_risk": WX + "SELECT city, forecast_date, risk_score, risk_level FROM gold WHERE risk_score >= 50",
    "map_points": WX
    + f""", points AS (
            SELECT city_name, latitude, longitude,
                   round_even({_exact_mean("risk_score")} * 10, 0) / 10 AS risk_score,
                   round_even({_exact_mean("temp_max")} * 10, 0) / 10 AS temp_max,
                   round_even({_exact_mean("precipitation_mm")} * 10, 0) / 10 AS precipitation_mm,
                   count(risk_score) AS n_forecasts
            FROM seen WHERE latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY 1, 2, 3)
          SELECT *, CASE WHEN risk_score < 25 THEN 'Faible' WHEN risk_score < 50 THEN 'Modéré'
                         WHEN risk_score < 75 THEN 'Élevé' ELSE 'Critique' END AS risk_level
          FROM points""",
    "kpis": WX
    + f"""SELECT count(DISTINCT city_name) AS n_cities, CAST(max(temp_max) AS DOUBLE) AS temp_max,
                 CAST(max(precipitation_mm) AS DOUBLE) AS precip_max, count(*) FILTER (WHERE {HIGH}) AS n_risky,
                 (SELECT city_name FROM seen GROUP BY city_name
                  ORDER BY {_exact_mean("risk_score")} DESC, city_name LIMIT 1) AS top_city
          FROM seen""",
    "risk_by_city_top15": WX
    + f"""SELECT city_name, {_exact_mean("risk_score")} AS risk_score FROM seen GROUP BY city_name
          ORDER BY {_exact_mean("risk_score")} DESC, city_name LIMIT 15""",
    "risk_pivot": WX
    + "SELECT forecast_date, "
    + ", ".join(
        f"CAST(sum(CASE WHEN city_name = '{c}' THEN risk_score END) AS DOUBLE) "
        f"/ nullif(count(CASE WHEN city_name = '{c}' THEN risk_score END), 0) AS \"{c}\""
        for c in ["NATION_1", "NATION_3", "NATION_10", "NATION_24"]
    )
    + """ FROM seen WHERE city_name IN ('NATION_1', 'NATION_3', 'NATION_10', 'NATION_24')
          GROUP BY forecast_date""",
    "detail_table": WX
    + """SELECT city_name, forecast_date, CAST(temp_max AS DOUBLE) AS temp_max,
                CAST(precipitation_mm AS DOUBLE) AS precipitation_mm, CAST(wind_gust_max AS DOUBLE) AS wind_gust_max,
                CAST(risk_score AS DOUBLE) AS risk_score, risk_level, data_quality_flag FROM seen""",
    "city_names": WX + "SELECT DISTINCT city_name FROM seen",
    "filter_bounds": WX + "SELECT min(forecast_date) AS min_date, max(forecast_date) AS max_date FROM seen",
}

# The same figures, whichever way they are kept.
for _rollup, _plain in {
    "rollup_hottest": "q1_hottest",
    "rollup_wettest": "q2_wettest",
    "rollup_riskiest_cities": "q3_riskiest_cities",
    "rollup_riskiest_dates": "q4_riskiest_dates",
    "rollup_summary": "gold_summary",
    "rollup_top_city": "top_city",
    "rollup_flag_counts": "quality_flag_counts",
    "rollup_map_points": "map_points",
    "rollup_kpis": "kpis",
    "rollup_top15": "risk_by_city_top15",
    "rollup_city_names": "city_names",
    "rollup_bounds": "filter_bounds",
    "stored_period": "period_filter",
    "serving_view_spread": "serving_view",
    "serving_ordered": "serving_view",
}.items():
    ORACLE[_rollup] = ORACLE[_plain]
_PERIOD = "WHERE forecast_date BETWEEN DATE '2023-12-20' AND DATE '2024-02-10'"
ORACLE["rollup_period_kpis"] = WX + f"""
    , span AS (SELECT * FROM seen {_PERIOD})
    SELECT count(DISTINCT city_name) AS n_cities, CAST(max(temp_max) AS DOUBLE) AS temp_max,
           CAST(max(precipitation_mm) AS DOUBLE) AS precip_max, count(*) FILTER (WHERE {HIGH}) AS n_risky,
           (SELECT city_name FROM span GROUP BY city_name
            ORDER BY {_exact_mean("risk_score")} DESC, city_name LIMIT 1) AS top_city
    FROM span"""
ORACLE["detail_page"] = ORACLE["detail_table"] + " ORDER BY risk_score DESC, city_name, forecast_date LIMIT 40 OFFSET 80"
ORACLE["history_stored_latest"] = _LOADED + """SELECT run_date, city_id, forecast_date,
    CAST(risk_score AS DOUBLE) AS risk_score, loaded_at AS recorded_at FROM replayed"""
ORACLE["cascade_history"] = RUNS + """SELECT run_date, city_id, forecast_date,
    CAST(risk_score AS DOUBLE) AS risk_score, risk_level
    FROM fact JOIN dim USING (city_id) WHERE latitude <= 20 OR latitude IS NULL"""
ORACLE["rejected_rows"] = WX + """SELECT city, forecast_date, 'precipitation_mm decimal(6,2)' AS reason
    FROM gold WHERE precipitation_mm * 1000 >= 9999.995
    UNION ALL SELECT city, forecast_date, 'wind_gust_max decimal(5,2)' FROM gold WHERE wind_gust_max * 16 >= 999.995"""
