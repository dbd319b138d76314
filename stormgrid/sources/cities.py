"""The city list."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stormgrid import schemas
from stormgrid.operators.clean import parse_numbers


def scan_cities(spark: SparkSession, path: str) -> DataFrame:
    """City, lat, lng by header name; a declared schema would bind by position instead."""
    raw = spark.read.option("header", True).csv(path)
    schemas.require(raw, schemas.CITY_COLUMNS, f"city list {path}")
    return parse_numbers(raw.select(*schemas.CITY_COLUMNS), ["lat", "lng"])


def drop_null_coords(cities: DataFrame) -> DataFrame:
    return cities.dropna(subset=["lat", "lng"])


def load_cities(spark: SparkSession, path: str) -> DataFrame:
    return drop_null_coords(scan_cities(spark, path))
