"""The daily run: bronze -> silver -> gold -> serving tables under one root folder.

Every step reads a stored layer and replaces its own run's output, so a step that was cut
short is simply run again. Figures about a layer are computed from its stored, column-pruned
form; only what the layer no longer shows is counted while it is being written.
"""

from __future__ import annotations

import datetime
import logging
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from stormgrid import schemas
from stormgrid.operators import clean, constraints, marts, quality, reference, rollup, sizing, upsert
from stormgrid.plans import gold as gold_plan, silver as silver_plan
from stormgrid.session import require_ansi, scratch
from stormgrid.sources import bronze, cities, layers, ledger

log = logging.getLogger("stormgrid")


@dataclass
class Outcome:
    """What a step reports. Hit counts come from observed metrics, which a repeated task can
    raise but never lower: read them as a signal, and the stored layer for exact numbers."""

    counts: dict = field(default_factory=dict)
    report: dict = field(default_factory=dict)


def _row(df: DataFrame) -> dict:
    return df.first().asDict()


def _run_day(run_date: str):
    return F.lit(run_date).cast("date")


def _payloads(spark: SparkSession, root: str, run_date: str, documents: bool) -> DataFrame:
    if documents:
        return ledger.read_documents(spark, f"{root}/bronze/{run_date}", f"{root}/landed", run_date)
    return bronze.scan_bronze(spark, f"{root}/bronze", run_date)


def _write_run(df: DataFrame, path: str, run_date: str, order: list[str]) -> None:
    """Replace a run's own folder, also when the run now has no rows."""
    rows = df.drop("run_date").sortWithinPartitions(*order)
    rows.write.mode("overwrite").parquet(f"{path}/run_date={run_date}")


def run_manifest(
    spark: SparkSession, root: str, run_date: str, city_file: str, documents: bool = False
) -> Outcome:
    """Expected against landed cities of a run, stored beside the layers."""
    day = _run_day(run_date).alias("run_date")
    expected = cities.load_cities(spark, city_file).select(day, "city")
    landed = _payloads(spark, root, run_date, documents).select("run_date", F.col("_city_name").alias("city"))
    covered = reference.coverage(expected, landed)
    _write_run(covered, f"{root}/manifest", run_date, ["failed_city"])
    stored = spark.read.schema(covered.schema).parquet(f"{root}/manifest/run_date={run_date}")
    counts = _row(
        stored.agg(
            F.coalesce(F.max("total_cities"), F.lit(0)).alias("total_cities"),
            F.coalesce(F.max("success_count"), F.lit(0)).alias("success_count"),
            F.count("failed_city").alias("failed_cities"),
        )
    )
    log.info("manifest %s: %s", run_date, counts)
    return Outcome(counts)


def run_silver(
    spark: SparkSession, root: str, run_date: str, city_file: str | None = None, documents: bool = False
) -> Outcome:
    payloads = _payloads(spark, root, run_date, documents)
    read, ruled = Observation("read"), Observation("ruled")
    reason = bronze.reject_reason()
    watched = payloads.observe(
        read,
        F.count_if(reason.isNull()).alias("usable"),
        F.count_if(reason.isNotNull()).alias("rejected"),
    )
    typed = silver_plan.typed_rows(watched)
    latest = silver_plan.latest_rows(typed, silver_plan.PAYLOAD_TIES, ["run_date"])
    inputs = clean.with_rule_inputs(latest)
    counted = inputs.observe(ruled, *clean.rule_counts(inputs))
    silver = clean.null_out_of_range(counted).select("run_date", *schemas.SILVER_COLUMNS)
    layers.write_layer(silver, f"{root}/silver", "run_date", ["city", "forecast_date"])

    counts = read.get
    # Rejects are rare: only a run that has some is read a second time. Without any, an empty
    # table still replaces what an earlier attempt at this run may have set aside.
    rejects = bronze.quarantine(payloads).drop("run_date")
    if counts.get("rejected"):
        log.warning("%s: %d payloads set aside", run_date, counts["rejected"])
    else:
        rejects = spark.createDataFrame([], rejects.schema)
    rejects.write.mode("overwrite").parquet(f"{root}/quarantine/run_date={run_date}")
    if not counts.get("usable"):
        raise bronze.NothingUsable(f"no usable payload for {run_date} under {root}/bronze")
    counts.update(ruled.get)

    stored = layers.read_layer(spark, f"{root}/silver", schemas.SILVER, run_date)
    report = {**_row(quality.quality_report(stored)), **_row(quality.coverage_evenness(stored))}
    if city_file is not None:
        known = reference.reference_list(cities.load_cities(spark, city_file))
        lost = reference.unmatched(stored, known).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("unmatched_rows"))
        report.update(_row(lost))
    log.info("silver %s: %s %s", run_date, counts, report)
    return Outcome(counts, report)


def run_gold(spark: SparkSession, root: str, run_date: str) -> Outcome:
    silver = layers.read_layer(spark, f"{root}/silver", schemas.SILVER, run_date)
    gold = gold_plan.gold(silver, run_date).withColumn("run_date", _run_day(run_date))
    layers.write_layer(gold, f"{root}/gold", "run_date", ["city", "forecast_date"])

    stored = layers.read_layer(spark, f"{root}/gold", schemas.GOLD, run_date)
    report = _row(quality.gold_summary(stored))
    top = quality.top_city(stored).first()
    report["top_city"] = top["city"] if top else None
    flags = {r["data_quality_flag"]: r["rows"] for r in quality.quality_flag_counts(stored).collect()}
    log.info("gold %s: %s %s", run_date, report, flags)
    return Outcome(flags, report)


# --- serving tables -----------------------------------------------------------------------


DIM_VERSIONS_KEPT = 3


def _write_version(spark: SparkSession, path: str, rows: DataFrame, known: str = "") -> None:
    """Write a table as its next version; readers of the current one are not disturbed, and the folder
    counts only once the job commits. All but the last few versions are dropped."""
    versions = layers.committed_versions(spark, path)
    number = versions[-1][0] + 1 if versions else 1
    rows.write.mode("overwrite").parquet(f"{path}/version={number}{known}")
    for _, old in layers.committed_versions(spark, path)[:-DIM_VERSIONS_KEPT]:
        layers.drop(spark, f"{path}/{old}")


def read_dim(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    """The newest version of the dimension and its number; no rows and 0 before the first.

    A version's folder is marked when its job commits, so what a broken load left behind is
    not a version. Only the newest is read, however many there are.
    """
    versions = layers.committed_versions(spark, path)
    if not versions:
        return spark.createDataFrame([], schemas.DIM), 0
    number, folder = versions[-1]
    return spark.read.schema(schemas.DIM).parquet(f"{path}/{folder}"), number


def next_dim(spark: SparkSession, path: str, gold: DataFrame) -> DataFrame:
    """The dimension with a load's cities, not yet stored as a version."""
    existing, _ = read_dim(spark, path)
    incoming = upsert.with_coordinates(upsert.incoming_cities(gold))
    staged = scratch(spark, "dim")
    upsert.upsert_dim(existing, incoming).write.parquet(staged)
    return spark.read.schema(schemas.DIM).parquet(staged)


def load_dim(spark: SparkSession, path: str, dim: DataFrame) -> DataFrame:
    """Write the dimension as its next version, under a name that tells its size."""
    rows, size = sizing.measured(dim)
    _write_version(spark, path, dim, f"-rows={rows}-bytes={size}")
    return read_dim(spark, path)[0]


def known_joins(spark: SparkSession, root: str) -> sizing.Known | None:
    """What the last load noted for joins with the dimension, read from folder names and a table
    of fewer than ``sizing.HOT_SHARES`` rows that is left to the plan; None before any load."""
    dims, noted = layers.committed_versions(spark, f"{root}/dim"), layers.committed_versions(spark, f"{root}/hot")
    if not dims or not noted or "-rows=" not in dims[-1][1]:
        return None
    told = dict(part.split("=") for part in dims[-1][1].split("-")[1:])
    hot = spark.read.schema("city_id int").parquet(f"{root}/hot/{noted[-1][1]}")
    return sizing.Known(sizing.small_enough(int(told["rows"]), int(told["bytes"])), hot)


def _known_names(known: sizing.Known | None, dim: DataFrame) -> sizing.Known | None:
    """The same by name, for rows that have no id yet; a city that is new to the load cannot be
    known, and the size of the dimension that the load is about to store is measured."""
    if known is None:
        return None
    named = dim.join(F.broadcast(known.hot), "city_id").select(F.col("city_name").alias("city"))
    return sizing.Known(sizing.is_small(dim), named)


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    return layers.read_or_empty(spark, path, schemas.FACT)


def _digests(rows: DataFrame, key: str) -> DataFrame:
    """Rows of each key and two sums of their hashes, which do not depend on any order."""
    h = F.xxhash64(*sorted(c for c in rows.columns if c != key))
    low = F.sum(h.bitwiseAND(F.lit((1 << 31) - 1)))
    return rows.groupBy(key).agg(F.count("*").alias("_n"), F.bit_xor(h).alias("_xor"), low.alias("_sum"))


def changed_parts(new: DataFrame, old: DataFrame, key: str) -> list:
    """Keys of ``new`` whose rows are not exactly those of ``old``: one row for each stored part.
    Equal figures of unlike rows would need 64 bits of hash and a sum of others to agree."""
    told = _digests(old.select(*new.columns), key)
    return [r[0] for r in _digests(new, key).join(told, [key, "_n", "_xor", "_sum"], "left_anti").select(key).collect()]


# A run brings a week or so of days. Beyond this many, they are joined in place of listed.
LISTED_DAYS = 1000


def load_fact(spark: SparkSession, path: str, incoming: DataFrame) -> None:
    """Upsert into the fact, which is partitioned by forecast date.

    Only the days that a load brings are read and rewritten, not those between them. The merged
    days go to a folder of their own first: a path must not be overwritten by a plan that reads
    it, and a load cut short between the two writes can be repeated.
    """
    upsert.require_unique(incoming, schemas.FACT_KEY, "load")
    days = incoming.select("forecast_date").distinct()
    listed = [r[0] for r in days.limit(LISTED_DAYS + 1).collect()]
    if None in listed:
        raise constraints.ConstraintViolated("fact: forecast_date not null")
    if not listed:
        return
    fact = read_fact(spark, path)
    few = len(listed) <= LISTED_DAYS
    touched = fact.where(F.col("forecast_date").isin(listed)) if few else fact.join(days, "forecast_date", "left_semi")
    staged = scratch(spark, "fact")
    upsert.upsert_fact(touched, incoming).write.parquet(staged)
    merged_days = spark.read.schema(schemas.FACT).parquet(staged)
    if few:  # days that the load leaves as they are keep their files
        changed = changed_parts(merged_days, touched, "forecast_date")
        if not changed:
            return
        merged_days = merged_days.where(F.col("forecast_date").isin(changed))
    layers.write_spread(merged_days, path, "forecast_date", ["city_id"])


ROLLUPS = {"city_months": (rollup.city_months, rollup.CITY_MONTHS, "city_id"), "days": (rollup.days, rollup.DAYS, "forecast_date")}


def read_rollup(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Stored figures by city and month (``city_months``) or by day (``days``)."""
    return layers.read_or_empty(spark, f"{root}/rollup/{name}", ROLLUPS[name][1])


def stored_bounds(spark: SparkSession, root: str) -> tuple[datetime.date, datetime.date] | None:
    """First and last day of the fact from the names of its partitions: nothing is scanned."""
    path = f"{root}/fact"
    names = layers.names(spark, path, "forecast_date=") if layers.exists(spark, path) else []
    days = sorted(datetime.date.fromisoformat(n.partition("=")[2]) for n in names)
    return (days[0], days[-1]) if days else None


def refresh_rollup(spark: SparkSession, root: str, days: DataFrame) -> None:
    """Recompute the rollup of the months in which some days of the fact have changed, and note the
    cities that now hold so many rows that joins must spread them.

    Months are replaced whole, from the fact as it is stored, so this can be repeated at will.
    """
    month = F.trunc("forecast_date", "MM").alias("month")
    months = [r[0] for r in days.where("forecast_date IS NOT NULL").select(month).distinct().collect()]
    if not months:
        return
    fact = rollup.in_months(read_fact(spark, f"{root}/fact"), months)
    path = f"{root}/fact"
    stored = layers.names(spark, path, "forecast_date=") if layers.exists(spark, path) else []
    left = {n.partition("=")[2][:7] for n in stored}
    for name, (cells, schema, order) in ROLLUPS.items():
        staged = scratch(spark, name)
        cells(fact).select(*schema.fieldNames()).write.parquet(staged)
        fresh = spark.read.schema(schema).parquet(staged)
        kept = read_rollup(spark, root, name).where(F.col("month").isin(months))
        changed = changed_parts(fresh, kept, "month")
        if changed:
            fresh = fresh.where(F.col("month").isin(changed))
            layers.write_spread(fresh, f"{root}/rollup/{name}", "month", [order])
        for gone in (m for m in months if m.isoformat()[:7] not in left):  # nothing overwrites these
            layers.drop(spark, f"{root}/rollup/{name}/month={gone}")
    counts = read_rollup(spark, root, "city_months").groupBy("city_id").agg(F.sum("rows").alias("rows"))
    _write_version(spark, f"{root}/hot", sizing.hot_keys(counts, "city_id"))


# Runs between two snapshots of the history.
SNAPSHOT_EVERY = 30


def _dates(spark: SparkSession, path: str, key: str) -> list[datetime.date]:
    names = layers.names(spark, path, f"{key}=") if layers.exists(spark, path) else []
    return sorted(datetime.date.fromisoformat(n.partition("=")[2]) for n in names)


def write_history(spark: SparkSession, root: str, history: DataFrame, run_date: str) -> None:
    """Replace a run's history. Snapshots from that run on no longer hold and go first; a new one is
    written where enough runs lie behind the last."""
    day = datetime.date.fromisoformat(run_date)
    snapshots = _dates(spark, f"{root}/snapshots", "as_of")
    for later in (s for s in snapshots if s >= day):
        layers.drop(spark, f"{root}/snapshots/as_of={later}")
    _write_run(history, f"{root}/history", run_date, ["city_id", "forecast_date"])
    last = max((s for s in snapshots if s < day), default=datetime.date.min)
    runs = [r for r in _dates(spark, f"{root}/history", "run_date") if r > last]
    if len(runs) >= SNAPSHOT_EVERY:
        rows = history_as_of(spark, root, runs[-1])
        rows.sortWithinPartitions("city_id", "forecast_date").write.mode("overwrite").parquet(
            f"{root}/snapshots/as_of={runs[-1]}"
        )


def history_as_of(spark: SparkSession, root: str, day: datetime.date) -> DataFrame | None:
    """The forecast in force per key as of a run date: the last snapshot before it and the runs since,
    however many came earlier. None where no run is that old."""
    snapshots = [s for s in _dates(spark, f"{root}/snapshots", "as_of") if s <= day]
    since = snapshots[-1] if snapshots else datetime.date.min
    runs = [r for r in _dates(spark, f"{root}/history", "run_date") if since < r <= day]
    parts = [spark.read.parquet(f"{root}/snapshots/as_of={since}")] if snapshots else []
    if runs:
        folders = [f"{root}/history/run_date={r}" for r in runs]
        parts.append(spark.read.option("basePath", f"{root}/history").parquet(*folders))
    if not parts:
        return None
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return upsert.history_latest(rows)


def run_load(spark: SparkSession, root: str, run_date: str, loaded_at: str) -> Outcome:
    """Load a run's gold rows. Rows without a date cannot be placed: they are set aside, with a
    reason and a count. Everything else that breaks a constraint ends the load before any table
    is written."""
    require_ansi(spark)
    finish_removals(spark, root)
    gold = layers.read_layer(spark, f"{root}/gold", schemas.GOLD, run_date)
    dim = next_dim(spark, f"{root}/dim", gold)
    staged = scratch(spark, "load")
    known = _known_names(known_joins(spark, root), dim)
    upsert.serving_rows(gold, dim, F.lit(loaded_at), known).write.parquet(staged)
    rows = spark.read.schema(schemas.FACT).parquet(staged)
    incoming, rejected = upsert.placeable(rows)
    constraints.enforce(dim, incoming)

    dim = load_dim(spark, f"{root}/dim", dim)
    _write_run(rejected, f"{root}/rejected", run_date, ["city_id"])
    load_fact(spark, f"{root}/fact", incoming)
    refresh_rollup(spark, root, incoming)
    history = upsert.history_rows(incoming, _run_day(run_date), F.lit(loaded_at))
    write_history(spark, root, history, run_date)

    left_out = upsert.unmapped_cities(gold, dim).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))
    counts = {
        "cities": dim.count(),
        "loaded": incoming.count(),
        "rejected": rejected.count(),
        "left_out": left_out.first()["rows"],
    }
    log.info("load %s: %s", run_date, counts)
    return Outcome(counts)


def _pending_removals(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    return layers.committed_versions(spark, f"{root}/removals")


def _removed_ids(spark: SparkSession, root: str) -> DataFrame:
    folders = [f"{root}/removals/{name}" for _, name in _pending_removals(spark, root)]
    return spark.read.schema("city_id int").parquet(*folders).distinct()


def remove_cities(spark: SparkSession, root: str, deleted: DataFrame) -> None:
    """Take cities out of the dimension, the fact and the history; other partitions stay as they are.

    What is to go is written first. From then on the view leaves those cities out, and whatever
    stops the work half way, the next load or removal finishes it.
    """
    finish_removals(spark, root)
    _write_version(spark, f"{root}/removals", deleted.select(F.col("city_id").cast("int")).distinct())
    finish_removals(spark, root)


def finish_removals(spark: SparkSession, root: str) -> None:
    """Carry out the removals that are still written down; each step can be repeated."""
    pending = _pending_removals(spark, root)
    if not pending:
        return
    deleted = _removed_ids(spark, root)
    tables = [("fact", schemas.FACT, "forecast_date"), ("history", None, "run_date"), ("snapshots", None, "as_of")]
    for table, schema, key in tables:
        path = f"{root}/{table}"
        if not layers.exists(spark, path) or not layers.names(spark, path, f"{key}="):
            continue
        rows = spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)
        affected = rows.join(deleted, "city_id", "left_semi").select(key).distinct()
        parts = [r[0] for r in affected.collect()]  # one row per stored day
        if not parts:
            continue
        staged = scratch(spark, table)
        upsert.cascade_delete(rows.where(F.col(key).isin(parts)), deleted).write.parquet(staged)
        rest = spark.read.schema(rows.schema).parquet(staged)
        if table == "fact":  # before the rows go, for afterwards nothing tells which days they had
            _write_version(spark, f"{root}/stale", spark.createDataFrame([(p,) for p in parts], "forecast_date date"))
        order = [c for c in ("city_id", "forecast_date") if c != key]
        layers.write_layer(rest.hint("rebalance", key), path, key, order)
        kept = {r[0] for r in rest.select(key).distinct().collect()}
        for part in parts:  # nothing is left to overwrite these with
            if part not in kept:
                layers.drop(spark, f"{path}/{key}={part}")
    for _, name in layers.committed_versions(spark, f"{root}/stale"):
        refresh_rollup(spark, root, spark.read.schema("forecast_date date").parquet(f"{root}/stale/{name}"))
        layers.drop(spark, f"{root}/stale/{name}")
    dim, _ = read_dim(spark, f"{root}/dim")
    if not dim.join(deleted, "city_id", "left_semi").isEmpty():
        load_dim(spark, f"{root}/dim", upsert.cascade_delete(dim, deleted))
    for _, name in pending:
        layers.drop(spark, f"{root}/removals/{name}")


def export_day(spark: SparkSession, root: str, run_date: str) -> None:
    """CSV copies of a run's silver and gold, ordered as the tables are."""
    for layer, schema in [("silver", schemas.SILVER), ("gold", schemas.GOLD)]:
        stored = layers.read_layer(spark, f"{root}/{layer}", schema, run_date)
        layers.export_csv(stored.orderBy("city", "forecast_date"), f"{root}/{layer}_csv")


def run_day(
    spark: SparkSession,
    root: str,
    run_date: str,
    loaded_at: str,
    city_file: str | None = None,
    documents: bool = False,
    csv: bool = False,
) -> dict[str, Outcome]:
    outcomes = {}
    if city_file is not None:
        outcomes["manifest"] = run_manifest(spark, root, run_date, city_file, documents)
    outcomes["silver"] = run_silver(spark, root, run_date, city_file, documents)
    outcomes["gold"] = run_gold(spark, root, run_date)
    outcomes["load"] = run_load(spark, root, run_date, loaded_at)
    if csv:
        export_day(spark, root, run_date)
    return outcomes


def open_view(spark: SparkSession, root: str) -> DataFrame:
    """The serving view over the stored tables, lazy, for questions and reports."""
    dim, _ = read_dim(spark, f"{root}/dim")
    known = known_joins(spark, root)
    if _pending_removals(spark, root):  # gone as soon as they are written down
        dim = upsert.cascade_delete(dim, _removed_ids(spark, root))
    return upsert.serving_view(read_fact(spark, f"{root}/fact"), dim, known)


def open_period(
    spark: SparkSession, root: str, preset: str, today: datetime.date
) -> tuple[datetime.date, datetime.date] | None:
    """First and last day of a preset period, from the partitions that are stored."""
    bounds = stored_bounds(spark, root)
    return None if bounds is None else marts.period_days(preset, today, *bounds)


def period_figures(spark: SparkSession, root: str, first: datetime.date, last: datetime.date) -> DataFrame:
    """City figures of a period, for ``operators.reports``."""
    cells, fact = read_rollup(spark, root, "city_months"), read_fact(spark, f"{root}/fact")
    return rollup.of_period(cells, fact, first, last)


def export_view(spark: SparkSession, root: str, path: str) -> None:
    """The serving view as CSV in the order of city and date: a file for each range of it, whose names
    sort as the ranges do, so the files one after the other are the ordered table."""
    view = open_view(spark, root).orderBy("city_name", "forecast_date")
    view.write.mode("overwrite").option("header", True).option("timestampNTZFormat", layers.CSV_STAMP).csv(path)
