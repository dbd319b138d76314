"""The serving tables' declared constraints as a query that lists violations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stormgrid.operators.upsert import repeated_keys
from stormgrid.schemas import FACT_KEY, LABEL_LENGTH, NAME_LENGTH

DIM_REQUIRED = ["city_id", "city_name", "latitude", "longitude"]
FACT_REQUIRED = ["city_id", "forecast_date", "risk_score", "risk_level", "data_quality_flag"]
FACT_LABELS = [
    "temp_category",
    "precipitation_category",
    "wind_category",
    "risk_level",
    "data_quality_flag",
]


def _row_rules(df: DataFrame, required: list[str], texts: dict[str, int], table: str) -> DataFrame:
    """Every per-row rule of a table in one pass."""
    counts = df.agg(
        *[F.count_if(F.col(c).isNull()).alias(f"{c} not null") for c in required],
        *[F.count_if(F.length(c) > n).alias(f"{c} at most {n} characters") for c, n in texts.items()],
    )
    return counts.unpivot([], counts.columns, "rule", "violations").withColumn("table_name", F.lit(table))


def _one_rule(violations: DataFrame, table: str, rule: str) -> DataFrame:
    return violations.withColumns({"table_name": F.lit(table), "rule": F.lit(rule)})


def _surplus(df: DataFrame, keys: list[str]) -> DataFrame:
    return repeated_keys(df, keys).agg(
        F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).cast("long").alias("violations")
    )


class ConstraintViolated(ValueError):
    """Rows to load break constraints that the tables declare."""


def enforce(dim: DataFrame, fact: DataFrame) -> None:
    """Raise with every broken rule and its count, one row a rule, before anything is written."""
    broken = constraint_violations(dim, fact).where("violations > 0").collect()
    if broken:
        raise ConstraintViolated(
            "; ".join(f"{r['table_name']}: {r['rule']}: {r['violations']}" for r in sorted(broken))
        )


def constraint_violations(dim: DataFrame, fact: DataFrame) -> DataFrame:
    """One row per constraint with its number of violations."""
    per_city = fact.groupBy("city_id").agg(F.count("*").alias("rows"))
    orphans = per_city.join(dim.select("city_id"), "city_id", "left_anti").agg(
        F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("violations")
    )
    parts = [
        _row_rules(dim, DIM_REQUIRED, {"city_name": NAME_LENGTH}, "dim"),
        _row_rules(fact, FACT_REQUIRED, {c: LABEL_LENGTH for c in FACT_LABELS}, "fact"),
        _one_rule(_surplus(dim, ["city_id"]), "dim", "city_id unique"),
        _one_rule(_surplus(dim, ["city_name"]), "dim", "city_name unique"),
        _one_rule(_surplus(fact, FACT_KEY), "fact", "city_id, forecast_date unique"),
        _one_rule(orphans, "fact", "city_id in dim"),
    ]
    out = parts[0].select("table_name", "rule", "violations")
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
