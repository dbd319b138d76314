"""Raw or typed rows to the silver layer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from stormgrid.operators import clean
from stormgrid.schemas import SILVER_COLUMNS
from stormgrid.sources import bronze


# Without a row number the values themselves decide between equal stamps.
PAYLOAD_TIES = [c for c in SILVER_COLUMNS if c not in ("city", "forecast_date", "extracted_at")]


def typed_rows(payloads: DataFrame) -> DataFrame:
    return clean.standardize(bronze.explode_daily(bronze.usable(payloads)))


def latest_rows(typed: DataFrame, tiebreak: Sequence[str] = (), run: Sequence[str] = ()) -> DataFrame:
    """Silver columns of the latest row per city and day.

    ``run`` names the columns that separate runs when several are processed at once. This is
    the only shuffle on the way to gold.
    """
    wanted = [*run, *[c for c in SILVER_COLUMNS if c in typed.columns]]
    carried = typed.select(*wanted, *[c for c in tiebreak if c not in wanted])
    latest = clean.latest_per_key(carried, [*run, "city", "forecast_date"], "extracted_at", tiebreak)
    return latest.select(*wanted)


def from_typed(typed: DataFrame, tiebreak: Sequence[str] = (), run: Sequence[str] = ()) -> DataFrame:
    return clean.apply_rules(latest_rows(typed, tiebreak, run))


def from_payloads(payloads: DataFrame) -> DataFrame:
    """Scanned payloads to silver, one result per run date."""
    return from_typed(typed_rows(payloads), PAYLOAD_TIES, ["run_date"])
