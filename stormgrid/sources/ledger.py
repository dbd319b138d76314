"""A ledger of landed documents: each is opened and parsed once, and again only when it changes.

``<store>/run_date=<day>/version=<n>`` holds what the n-th reading of a run found: a row for each
document that was new, had changed or was gone, with its size, time, digest and parsed payload.
The newest row of a document is in force. A version counts once its job commits, so a reading that
breaks off leaves nothing behind, and the next one reads the same documents.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from stormgrid.schemas import CORRUPT, PAYLOAD
from stormgrid.sources import layers

ENTRY = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("size", T.LongType()),
        T.StructField("modified", T.TimestampType()),
        T.StructField("digest", T.StringType()),
        T.StructField("payload", PAYLOAD),
        T.StructField("gone", T.BooleanType()),
        T.StructField("version", T.IntegerType()),
    ]
)


@dataclass(frozen=True)
class Reading:
    """``opened`` documents, of which ``changed`` differ from what was known; documents ``gone``."""

    opened: int = 0
    changed: int = 0
    gone: int = 0


def _files(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of a folder; their content is read only where it is selected."""
    return spark.read.format("binaryFile").load(folder).select(
        F.substring_index("path", "/", -1).alias("name"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("modified"),
        "content",
    )


def entries(spark: SparkSession, store: str, run_date: str) -> DataFrame:
    """The rows in force of a run, documents that are gone included."""
    path = f"{store.rstrip('/')}/run_date={run_date}"
    folders = [f"{path}/{name}" for _, name in layers.committed_versions(spark, path)]
    if not folders:
        return spark.createDataFrame([], ENTRY)
    rows = spark.read.schema(ENTRY).option("basePath", path).parquet(*folders)
    if len(folders) == 1:
        return rows
    newest = Window.partitionBy("name").orderBy(F.desc("version"))
    return rows.withColumn("_i", F.row_number().over(newest)).where("_i = 1").drop("_i")


def refresh(spark: SparkSession, folder: str, store: str, run_date: str) -> Reading:
    """Bring the ledger of a run up to date with its folder, and tell what that took.

    Documents are told apart by name, size and time without being opened. The earliest time among
    those that are not known as they are reaches the scan as a bound, so that of older ones only
    the names are listed, however many there are.
    """
    known = entries(spark, store, run_date).where("NOT gone").select("name", "size", "modified", "digest")
    files = _files(spark, folder)
    pending = files.select("name", "size", "modified").join(known, ["name", "size", "modified"], "left_anti")
    gone = known.join(files.select("name"), "name", "left_anti")
    first = pending.agg(F.unix_micros(F.min("modified")).alias("at")).first()["at"]
    lost = gone.count()
    if first is None and not lost:
        return Reading()

    left = gone.select("name", F.lit(True).alias("gone"))
    if first is not None:
        text = F.col("content").cast("string")
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
        opened = (
            files.where(F.col("modified") >= F.timestamp_micros(F.lit(first)))
            .join(pending.select("name"), "name", "left_semi")
            .select(
                "name",
                "size",
                "modified",
                F.sha2("content", 256).alias("digest"),
                # a document without text holds no payload
                F.when(F.length(F.trim(text)) > 0, F.from_json(text, PAYLOAD, options)).alias("payload"),
                F.lit(False).alias("gone"),
            )
        )
        left = opened.unionByName(left, allowMissingColumns=True)
    path = f"{store.rstrip('/')}/run_date={run_date}"
    versions = layers.committed_versions(spark, path)
    number = versions[-1][0] + 1 if versions else 1
    left.write.mode("overwrite").parquet(f"{path}/version={number}")

    fresh = spark.read.schema(ENTRY).parquet(f"{path}/version={number}").where("NOT gone")
    same = F.count("known").alias("same")
    before = known.select("name", "digest", F.lit(True).alias("known"))
    told = fresh.select("name", "digest").join(before, ["name", "digest"], "left").agg(F.count("*").alias("n"), same).first()
    return Reading(told["n"], told["n"] - told["same"], lost)


def read_documents(spark: SparkSession, folder: str, store: str, run_date: str) -> DataFrame:
    """Payloads of a run that is kept as one document per city, through the ledger."""
    refresh(spark, folder, store, run_date)
    rows = entries(spark, store, run_date).where("NOT gone AND payload IS NOT NULL")
    return rows.select("payload.*", F.lit(run_date).cast("date").alias("run_date"))
