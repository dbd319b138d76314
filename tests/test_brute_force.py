"""Whole layers on random tables, against the same rules as a plain Python loop."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from stormgrid import policy, schemas
from stormgrid.operators import marts, upsert
from stormgrid.plans import gold as gold_plan, silver as silver_plan

DAY, STAMP = datetime.date(2026, 5, 1), datetime.datetime(2026, 5, 1, 6)


def random_rows(seed, n=1500):
    """Few keys and stamps, so most rows repeat a key and many repeat a stamp; a third of all
    rows fall on one key."""
    draw = random.Random(seed)

    def cell(low, high):
        return None if draw.random() < 0.1 else draw.randrange(low * 10, high * 10) / 10

    rows = []
    for i in range(n):
        hot = draw.random() < 1 / 3
        city = "hot" if hot else draw.choice(["a", "b", "c", "d", None])
        day = DAY if hot else DAY + datetime.timedelta(draw.randrange(6))
        at = None if draw.random() < 0.02 else STAMP + datetime.timedelta(seconds=draw.randrange(5))
        values = [cell(-40, 80), cell(-40, 80), cell(-20, 600), cell(-10, 120), cell(-10, 350), cell(-10, 350)]
        code = draw.choice([*policy.SEVERITY_OF_CODE, 42, None])
        rows.append((i, city, 1.0, 2.0, day, *values, code, at))
    return rows


def python_silver(rows):
    latest = {}
    for row in rows:
        key = (row[1], row[4])
        rank = (row[12] is None, row[12] or STAMP, row[0])
        if key not in latest or rank > latest[key][0]:
            latest[key] = (rank, row)
    out = []
    for _, row in latest.values():
        high, low, mm, chance, speed, gust = row[5:11]
        if high is not None and low is not None and low > high:
            high = low = None
        kept = [
            None if v is None or not bottom <= v <= top else v
            for v, (bottom, top) in zip(
                [high, low, mm, chance, speed, gust], [(-20, 60), (-20, 60), (0, 500), (0, 100), (0, 300), (0, 300)]
            )
        ]
        out.append((*row[1:5], *kept, row[11], row[12]))
    return out


def python_score(row):
    high, _, mm, chance, _, gust, code = row[4:11]
    total = min(mm or 0, 30.0) / 30.0 * 25 + (chance or 0) / 100 * 10 + min(gust or 0, 90.0) / 90.0 * 30
    if high is not None:
        total += min(max(high - 38, 5 - high, 0) * 1.5, 15)
    total += 0 if code is None else policy.SEVERITY_OF_CODE.get(code, 2) * 5
    return round(min(total, 100), 1)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_silver_gold_and_reports(spark, seed):
    rows = random_rows(seed)
    typed = spark.createDataFrame(rows, "id int, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.SILVER.fields))
    silver = silver_plan.from_typed(typed.repartition(7), tiebreak=["id"])
    want = python_silver(rows)
    assert sorted(map(str, map(tuple, silver.collect()))) == sorted(map(str, want))

    gold = gold_plan.gold(silver, DAY)
    scores = {(r["city"], r["forecast_date"]): r["risk_score"] for r in gold.collect()}
    assert scores == {(row[0], row[3]): python_score(row) for row in want}

    dim = spark.createDataFrame([(n, c, 1.0, 2.0) for n, c in enumerate(["a", "b", "hot"])], schemas.DIM)
    fact = upsert.serving_rows(gold, dim, F.lit("2026-05-02 00:00:00"))
    known = {k: v for k, v in scores.items() if k[0] in ("a", "b", "hot")}
    assert fact.count() == len(known)
    means = {c: [v for (city, _), v in known.items() if city == c] for c in ("a", "b", "hot")}
    got = {r["city_name"]: (r["avg_score"], r["high_risk_days"]) for r in marts.riskiest_cities(fact, dim).collect()}
    for city, values in means.items():
        assert got[city][0] == pytest.approx(sum(values) / len(values), abs=1e-9)
        assert got[city][1] == sum(v >= 50 for v in values)
    worst = {(r["city_name"], r["forecast_date"]) for r in marts.worst_days(fact, dim).collect()}
    assert worst == {k for k, v in known.items() if v == max(means[k[0]])}
