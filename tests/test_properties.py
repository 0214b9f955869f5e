"""Random inputs against plain Python."""

from __future__ import annotations

import random
import re
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pluvia.functions import parse_decimal, split_cells, split_key_value
from pluvia.operators import (
    bind_columns_by_name,
    check_unique,
    dedup_readings,
    dim_station,
    monthly_mean,
    station_totals,
    top_stations,
)

NUMBER = re.compile(r"[+-]?([0-9]+([.,][0-9]*)?|[.,][0-9]+)([eE][+-]?[0-9]+)?")


def rows(frame):
    return sorted((tuple(row) for row in frame.collect()), key=repr)


def test_numbers(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choices("0123456789,.+-eEdxNa ", k=rng.randint(0, 6))) for _ in range(5000)]

    def number(text):
        text = text.strip(" ")
        return float(text.replace(",", ".")) if NUMBER.fullmatch(text) else None

    frame = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    result = dict(frame.select("i", parse_decimal(F.col("t"))).collect())
    assert sum(v is not None for v in result.values()) > 500
    assert {i: v for i, v in result.items() if v != number(texts[i])} == {}


def test_lines(spark):
    rng = random.Random(2)
    lines = ["".join(rng.choices("ab:; ,", k=rng.randint(0, 8))) for _ in range(2000)]
    pair = split_key_value(F.col("l"))
    frame = spark.createDataFrame(list(enumerate(lines)), "i int, l string")
    for i, cells, key, value in frame.select("i", split_cells(F.col("l")), pair["key"], pair["value"]).collect():
        head, _, tail = lines[i].strip().partition(";")
        assert (cells, key, value) == (lines[i].split(";"), head.replace(":", "").strip(), tail.strip())


def test_binding(spark):
    rng = random.Random(3)
    names, data = ["A", "B", "C"], []
    for i in range(300):
        header = rng.sample(["A", "B", "C", "D", ""], rng.randint(1, 5))
        data.append((i, header, [rng.choice(["", "x", "y"]) for _ in range(rng.randint(0, 6))]))
    frame = spark.createDataFrame(data, "i int, header array<string>, cells array<string>")
    bound = bind_columns_by_name(frame, {name: name.lower() for name in names}).orderBy("i")
    for (_, header, cells), row in zip(data, bound.collect()):
        for name in names:
            position = header.index(name) if name in header else len(cells)
            assert row[name.lower()] == ((cells[position] or None) if position < len(cells) else None)


@pytest.mark.parametrize("seed", range(3))
def test_dedup(spark, seed):
    rng = random.Random(seed)
    # A third of the rows share one key.
    data = [
        ("hot" if rng.random() < 0.33 else rng.choice("abc"), rng.choice([1, 2, None]), rng.randint(0, 50), rng.random())
        for _ in range(500)
    ]
    best = {}
    for k, t, v, w in data:
        best[k, t] = min(best.get((k, t), (v, w)), (v, w))
    frame = spark.createDataFrame(data, "k string, t int, v int, w double").repartition(5)
    assert rows(dedup_readings(frame, ["k", "t"])) == sorted(((*key, *value) for key, value in best.items()), key=repr)


def _readings(rng, n):
    start = datetime(2022, 11, 1)
    return [
        (
            "hot" if rng.random() < 0.33 else f"s{rng.randint(0, 9)}",
            rng.choice(["N", "S", None]),
            start + timedelta(hours=rng.randint(0, 3000)),
            rng.choice([None, rng.randint(-50, 400) / 10]),
        )
        for _ in range(n)
    ]


SCHEMA = "estacao_codigo string, k string, datetime timestamp_ntz, v double"


def test_monthly_mean(spark):
    data = _readings(random.Random(4), 2000)
    groups = defaultdict(list)
    for _, k, t, v in data:
        groups[k, t.year, t.month].append(v)

    def mean(values):
        present = [round(v * 10) for v in values if v is not None]
        return sum(present) / 10 / len(present) if present else None

    expected = {key: mean(values) for key, values in groups.items()}
    frame = spark.createDataFrame(data, SCHEMA).repartition(7)
    for scale in (None, 1):
        result = {tuple(row)[:3]: row.m for row in monthly_mean(frame, "k", "v", "m", scale=scale).collect()}
        assert result == pytest.approx(expected)


def test_stations_and_totals(spark):
    data = _readings(random.Random(5), 2000)
    frame = spark.createDataFrame(data, SCHEMA).repartition(7)
    latest, sums = {}, defaultdict(int)
    for s, k, t, v in data:
        latest[s] = max(latest.get(s, (t, k or "")), (t, k or ""))
        sums[s] += round((v or 0) * 10)
    dim = dim_station(frame, attributes=["k"])
    assert rows(dim) == sorted(((s, k or None) for s, (_, k) in latest.items()), key=repr)
    totals = station_totals(frame, dim, "v", "total", attributes=["k"])
    top = top_stations(totals.withColumn("total", F.round("total", 1)), "total", 4).collect()
    expected = sorted(((-n, s) for s, n in sums.items()))[:4]
    assert [(row.estacao_codigo, row.total) for row in top] == [(s, pytest.approx(-n / 10)) for n, s in expected]


def test_unique(spark):
    data = [random.Random(6).choice([None, 1, 2, 3, 4]) for _ in range(3)] + [7, 7, 8, 9, 9, 9, None, None]
    frame = spark.createDataFrame([(v,) for v in data], "v int")
    expected = sum(data.count(v) > 1 for v in set(data) - {None})
    assert rows(check_unique(frame, "v")) == [(expected,)]
