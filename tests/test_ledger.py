"""Documents that are read once, and again only when they change."""

import json
import os

import pytest

from stormgrid import schemas
from stormgrid.plans import daily
from stormgrid.sources import bronze, layers, ledger

DAY = "2024-03-01"


def document(city, warm=20):
    daily_ = {"time": [DAY], "temperature_2m_max": [warm]}
    return json.dumps({"latitude": 1.5, "daily": daily_, "_city_name": city, "_extracted_at": f"{DAY}T06:00:00"}, indent=1)


def put(folder, name, text, seconds):
    path = f"{folder}/bronze/{DAY}/{name}"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    os.utime(path, (1_700_000_000 + seconds,) * 2)


def refresh(spark, folder):
    return ledger.refresh(spark, f"{folder}/bronze/{DAY}", f"{folder}/landed", DAY)


def payloads(spark, folder):
    return ledger.read_documents(spark, f"{folder}/bronze/{DAY}", f"{folder}/landed", DAY)


def rows(df):
    return sorted(df.select(*schemas.PAYLOAD.names, "run_date").collect(), key=str)


def test_second_reading_opens_nothing(spark, folder):
    for i in range(5):
        put(folder, f"c{i}.json", document(f"c{i}"), i)
    put(folder, "_manifest.json", "{}", 9)
    assert refresh(spark, folder) == ledger.Reading(5, 5, 0)
    assert refresh(spark, folder) == ledger.Reading()
    assert len(layers.committed_versions(spark, f"{folder}/landed/run_date={DAY}")) == 1
    # a new, a changed, a touched and a removed document; the last two stay as they are
    put(folder, "new.json", document("new"), 20)
    put(folder, "c1.json", document("c1", 33), 21)
    put(folder, "c2.json", document("c2"), 22)
    os.remove(f"{folder}/bronze/{DAY}/c0.json")
    assert refresh(spark, folder) == ledger.Reading(3, 2, 1)
    got = {r["_city_name"]: r["daily"]["temperature_2m_max"] for r in payloads(spark, folder).collect()}
    assert got == {"c1": ["33"], "c2": ["20"], "c3": ["20"], "c4": ["20"], "new": ["20"]}
    # one that comes back, older than all that is known
    put(folder, "c0.json", document("c0", 1), -50)
    assert refresh(spark, folder).changed == 1
    assert payloads(spark, folder).count() == 6
    assert rows(payloads(spark, folder)) == rows(bronze.scan_documents(spark, f"{folder}/bronze", DAY))


def test_older_documents_are_left_closed(spark, folder):
    """The scan itself is given the bound, so a known document that cannot be read does no harm."""
    put(folder, "old.json", document("old"), 0)
    refresh(spark, folder)
    files = ledger._files(spark, f"{folder}/bronze/{DAY}")
    plan = files.where("modified >= timestamp_micros(1700000010000000)")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(modificationTime" in plan
    put(folder, "new.json", document("new"), 10)
    assert refresh(spark, folder) == ledger.Reading(1, 1, 0)


@pytest.mark.parametrize("text", ["{\n not json", "", " \n", '{"daily": 3}', "[1, 2]", '{"daily": {"time": ["x"', "null", '"x"'])
def test_odd_documents_like_the_plain_scan(spark, folder, text):
    put(folder, "odd.json", text, 0)
    put(folder, "fine.json", document("Oslo"), 1)
    reasons = lambda df: sorted(str(r[0]) for r in df.select(bronze.reject_reason()).collect())
    plain = bronze.scan_documents(spark, f"{folder}/bronze", DAY)
    assert reasons(payloads(spark, folder)) == reasons(plain)


def test_a_reading_that_broke_off_is_done_again(spark, folder):
    put(folder, "a.json", document("a"), 0)
    refresh(spark, folder)
    put(folder, "b.json", document("b"), 1)
    refresh(spark, folder)
    os.remove(f"{folder}/landed/run_date={DAY}/version=2/_SUCCESS")
    assert refresh(spark, folder) == ledger.Reading(1, 1, 0)
    assert sorted(r["_city_name"] for r in payloads(spark, folder).collect()) == ["a", "b"]


def test_a_run_replayed_after_a_correction(spark, folder):
    for i in range(3):
        put(folder, f"c{i}.json", document(f"c{i}"), i)
    assert daily.run_silver(spark, folder, DAY, documents=True).counts["usable"] == 3
    put(folder, "c1.json", document("c1", 41), 60)
    put(folder, "bad.json", "{", 61)
    outcome = daily.run_silver(spark, folder, DAY, documents=True)
    assert (outcome.counts["usable"], outcome.counts["rejected"]) == (3, 1)
    silver = layers.read_layer(spark, f"{folder}/silver", schemas.SILVER, DAY)
    assert {r["city"]: r["temp_max"] for r in silver.collect()} == {"c0": 20.0, "c1": 41.0, "c2": 20.0}
