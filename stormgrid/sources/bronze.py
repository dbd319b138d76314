"""Raw payloads: landing, scanning, setting rejects aside, and flattening."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, functions as F

from stormgrid.schemas import CORRUPT, DAILY_COLUMNS, PAYLOAD

MALFORMED, NO_DAILY, UNEVEN = "malformed", "no_daily", "length_mismatch"
LINES_PER_FILE = 100_000


class NothingUsable(ValueError):
    """A run left no payload that could be flattened."""


def stamp_payloads(payloads: DataFrame, city: Column, extracted_at: Column) -> DataFrame:
    """Name and fetch time travel inside the payload, so a file explains itself."""
    return payloads.withColumns({"_city_name": city, "_extracted_at": extracted_at})


def by_run_date(rows: DataFrame) -> DataFrame:
    """Rows brought together by run date, which AQE splits again where a run is large, and in its
    order within a task. What is then made of a row neither travels nor is sorted by the write."""
    return rows.hint("rebalance", "run_date").sortWithinPartitions("run_date")


def land_lines(rows: DataFrame, fmt: str, path: str, mode: str) -> None:
    """Rows as gzipped lines under one directory per run date. Such files cannot be split, so each
    holds a bounded number of lines."""
    (
        rows.write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "gzip")
        .option("maxRecordsPerFile", LINES_PER_FILE)
        .partitionBy("run_date")
        .format(fmt)
        .save(path)
    )


def land_payloads(payloads: DataFrame, path: str, several_runs: bool = False) -> None:
    """Write stamped payloads as JSON lines under one directory per run date.

    Re-landing a run replaces exactly that run. One run is written as it comes, without a
    shuffle, and so are rows made of others that ``by_run_date`` has ordered; several runs in any
    order are first brought together here, payloads and all.
    """
    land_lines(by_run_date(payloads) if several_runs else payloads, "json", path, "overwrite")


def _reader(spark: SparkSession) -> DataFrameReader:
    return (
        spark.read.schema(PAYLOAD).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    )


def scan_bronze(spark: SparkSession, path: str, run_date: str | None = None) -> DataFrame:
    """Landed payloads under ``path``, of one run when a date is given.

    One run is read from its own directory, so neither listing nor planning grows with the
    number of runs kept, and a missing run is an error. Files named ``_*`` are skipped by
    the source.
    """
    if run_date is None:
        payloads = _reader(spark).json(path)
    else:
        payloads = _reader(spark).option("basePath", path).json(f"{path.rstrip('/')}/run_date={run_date}")
    return payloads.withColumn("run_date", F.col("run_date").cast("date"))


def scan_documents(spark: SparkSession, path: str, run_date: str) -> DataFrame:
    """Payloads kept as one indented document per city in a directory per run date. Such
    files cannot be split, but Spark packs many of them into one task."""
    payloads = _reader(spark).option("multiLine", True).json(f"{path.rstrip('/')}/{run_date}")
    return payloads.withColumn("run_date", F.lit(run_date).cast("date"))


def reject_reason() -> Column:
    """Why a payload cannot be flattened; null for a usable one. Absent arrays are allowed."""
    sizes = [F.size(F.col("daily")[c]) for c in DAILY_COLUMNS]
    return (
        F.when(F.col(CORRUPT).isNotNull(), MALFORMED)
        .when(F.col("daily").isNull(), NO_DAILY)
        # least and greatest skip nulls, that is, absent arrays
        .when(F.least(*sizes) != F.greatest(*sizes), UNEVEN)
    )


def usable(payloads: DataFrame) -> DataFrame:
    return payloads.where(reject_reason().isNull()).drop(CORRUPT)


def quarantine(payloads: DataFrame) -> DataFrame:
    return payloads.withColumn("reason", reject_reason()).where(F.col("reason").isNotNull())


def explode_daily(payloads: DataFrame) -> DataFrame:
    """One row per payload and day; the envelope repeats on each of its days."""
    # An absent array would void the whole zip; an empty one is padded with nulls.
    arrays = [
        F.coalesce(F.col("daily")[c], F.array().cast("array<string>")).alias(c) for c in DAILY_COLUMNS
    ]
    envelope = [
        "run_date",
        F.col("_city_name").alias("city"),
        "latitude",
        "longitude",
        F.col("_extracted_at").alias("extracted_at"),
    ]
    return payloads.select(*envelope, F.inline(F.arrays_zip(*arrays)).alias(*DAILY_COLUMNS))


def union_runs(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows, columns matched by name, absent ones null."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first
