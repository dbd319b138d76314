"""Reading and writing the silver, gold, fact, dimension and history tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, types as T

from stormgrid.schemas import nan_to_null

# The default text form of a zone-less timestamp stops at milliseconds.
CSV_STAMP = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"


def write_layer(df: DataFrame, path: str, partition: str, order: Sequence[str]) -> None:
    """Replace the partitions present in ``df``. Rows are ordered inside each file, which
    gives later city filters narrow row-group statistics without a global sort."""
    (
        df.sortWithinPartitions(partition, *order)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )


def write_spread(df: DataFrame, path: str, partition: str, order: Sequence[str]) -> None:
    """``write_layer`` for rows whose partitions are scattered over all tasks: brought together
    first, so that a partition gets as few files as its size allows and a large one several."""
    write_layer(df.hint("rebalance", partition), path, partition, order)


def read_layer(
    spark: SparkSession, path: str, schema: T.StructType, run_date: str | None = None, fmt: str = "parquet"
) -> DataFrame:
    """One layer, of one run when a date is given; a missing run is an error.

    A run is read from its own directory, so listing does not grow with the runs kept. CSV is
    an explicit choice, never a fallback.
    """
    full = T.StructType([*schema.fields, T.StructField("run_date", T.DateType())])
    reader = spark.read.schema(full).option("basePath", path)
    if fmt == "csv":
        reader = reader.option("header", True).option("timestampNTZFormat", CSV_STAMP)
    df = reader.format(fmt).load(path if run_date is None else f"{path}/run_date={run_date}")
    return nan_to_null(df) if fmt == "csv" else df


def export_csv(df: DataFrame, path: str, partition: str = "run_date") -> None:
    """CSV copy of a layer; text is written as it is, without trimming."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("header", True)
        .option("timestampNTZFormat", CSV_STAMP)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .partitionBy(partition)
        .csv(path)
    )


def _located(spark: SparkSession, path: str):
    """A path and its file system, whichever it names. Needs a classic session."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    target, system = _located(spark, path)
    return system.exists(target)


def names(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """Names in a folder that begin so."""
    target, system = _located(spark, path)
    return [n for n in (f.getPath().getName() for f in system.listStatus(target)) if n.startswith(prefix)]


def committed_versions(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """Number and folder of the versions whose job committed, by the folders' names; no data is
    read. A name may go on with what is known of the version: ``version=7-rows=25-bytes=1800``."""
    found = names(spark, path, "version=") if exists(spark, path) else []
    numbered = sorted((int(n.partition("=")[2].partition("-")[0]), n) for n in found)
    return [v for v in numbered if exists(spark, f"{path}/{v[1]}/_SUCCESS")]


def drop(spark: SparkSession, path: str) -> None:
    target, system = _located(spark, path)
    system.delete(target, True)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table, or no rows of its declared shape before its first load."""
    if exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)
