"""Column contracts of every layer."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T

# FIXED VALUES: payload array -> silver column. The arrays are declared as text: one bad element then costs
# one cell, while a numeric element type would void the whole array.
DAILY_COLUMNS = {
    "time": "forecast_date",
    "temperature_2m_max": "temp_max",
    "temperature_2m_min": "temp_min",
    "precipitation_sum": "precipitation_mm",
    "precipitation_probability_max": "precipitation_prob",
    "wind_speed_10m_max": "wind_speed_max",
    "wind_gusts_10m_max": "wind_gust_max",
    "weather_code": "weather_code",
}

CORRUPT = "_corrupt_record"

PAYLOAD = T.StructType(
    [
        T.StructField("latitude", T.StringType()),
        T.StructField("longitude", T.StringType()),
        T.StructField(
            "daily",
            T.StructType([T.StructField(c, T.ArrayType(T.StringType())) for c in DAILY_COLUMNS]),
        ),
        T.StructField("_city_name", T.StringType()),
        T.StructField("_extracted_at", T.StringType()),
        T.StructField(CORRUPT, T.StringType()),
    ]
)

MEASURES = [
    "temp_max",
    "temp_min",
    "precipitation_mm",
    "precipitation_prob",
    "wind_speed_max",
    "wind_gust_max",
]

SILVER = T.StructType(
    [
        T.StructField("city", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("forecast_date", T.DateType()),
        *[T.StructField(c, T.DoubleType()) for c in MEASURES],
        T.StructField("weather_code", T.IntegerType()),
        T.StructField("extracted_at", T.TimestampNTZType()),
    ]
)
SILVER_COLUMNS = SILVER.fieldNames()

GOLD = T.StructType(
    [
        *SILVER.fields,
        T.StructField("temp_category", T.StringType()),
        T.StructField("precipitation_category", T.StringType()),
        T.StructField("wind_category", T.StringType()),
        T.StructField("risk_score", T.DoubleType()),
        T.StructField("risk_level", T.StringType()),
        T.StructField("data_quality_flag", T.StringType()),
        T.StructField("day_of_week", T.StringType()),
        T.StructField("is_weekend", T.BooleanType()),
        T.StructField("days_ahead", T.IntegerType()),
    ]
)
GOLD_COLUMNS = GOLD.fieldNames()

CITY_COLUMNS = ["city", "lat", "lng"]

DIM = T.StructType(
    [
        T.StructField("city_id", T.IntegerType()),
        T.StructField("city_name", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
    ]
)

VERSIONED_DIM = T.StructType([*DIM.fields, T.StructField("version", T.IntegerType())])

NARROW = T.DecimalType(5, 2)
# Declared types of the serving columns; a value that does not fit is an error.
SERVING_TYPES = {
    "temp_max": NARROW,
    "temp_min": NARROW,
    "precipitation_mm": T.DecimalType(6, 2),
    "precipitation_prob": NARROW,
    "wind_speed_max": NARROW,
    "wind_gust_max": NARROW,
    "weather_code": T.IntegerType(),
    "temp_category": T.StringType(),
    "precipitation_category": T.StringType(),
    "wind_category": T.StringType(),
    "risk_score": NARROW,
    "risk_level": T.StringType(),
    "data_quality_flag": T.StringType(),
    "extracted_at": T.TimestampNTZType(),
}

FACT_KEY = ["city_id", "forecast_date"]
FACT = T.StructType(
    [
        T.StructField("city_id", T.IntegerType()),
        T.StructField("forecast_date", T.DateType()),
        *[T.StructField(c, t) for c, t in SERVING_TYPES.items()],
        T.StructField("loaded_at", T.TimestampNTZType()),
    ]
)

# The history table keeps the payload without the three categories.
HISTORY_COLUMNS = FACT_KEY + [c for c in SERVING_TYPES if not c.endswith("_category")]

VIEW_COLUMNS = ["city_name", "latitude", "longitude", "forecast_date"] + [
    c for c in SERVING_TYPES if c != "extracted_at"
]

NAME_LENGTH = 100
LABEL_LENGTH = 20


class MissingColumns(ValueError):
    """An input lacks columns its contract requires."""


def missing(df: DataFrame, required: Iterable[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def require(df: DataFrame, required: Iterable[str], what: str) -> DataFrame:
    """Fail before any job starts when a required column is absent."""
    absent = missing(df, required)
    if absent:
        raise MissingColumns(f"{what}: missing columns {absent}; available columns {df.columns}")
    return df


def contract_report(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """One row per required column: is it there, and how many rows hold a value."""
    required = list(required)
    counts = df.agg(
        *[
            (F.count(F.col(c)) if c in df.columns else F.lit(0).cast("long")).alias(c)
            for c in required
        ]
    )
    return counts.unpivot([], required, "column_name", "filled_rows").withColumn(
        "present", F.col("column_name").isin([c for c in required if c in df.columns])
    )


def nan_to_null(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """NaN sorts above every number in Spark, so it must be gone before any comparison."""
    doubles = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    wanted = doubles if columns is None else doubles & set(columns)
    return df.withColumns(
        {c: F.when(~F.isnan(c), F.col(c)) for c in df.columns if c in wanted}
    )


def serving_values() -> dict[str, Column]:
    """Payload columns in their declared serving types; plain casts, so overflow raises."""
    return {c: F.col(c).cast(t) for c, t in SERVING_TYPES.items()}
