"""Checks and counts in one scan, and a log that many drivers append to."""

from __future__ import annotations

import json
import os
import random
import subprocess
import sys
from concurrent.futures import ThreadPoolExecutor

import pytest

from pluvia.operators import (
    accepted_range,
    check_accepted_range,
    check_not_null,
    check_unique,
    not_null,
    quality_report,
    row_counts,
    unique,
    value_counts,
)
from pluvia.plans import append_run_log, read_run_log

SCHEMA = "a int, b string, v double, extra int"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def rows(frame):
    return sorted((tuple(row) for row in frame.collect()), key=repr)


def _plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def _table(spark, rng, n):
    data = [
        ("hot" == rng.choice(["hot", "", "", ""]) and 7 or rng.choice([None, *range(n // 3)]), rng.choice([None, "x", "y", ""]),
         rng.choice([None, rng.random() * 10]), rng.randrange(3))
        for _ in range(n)
    ]
    return spark.createDataFrame(data, SCHEMA).repartition(5)


@pytest.mark.parametrize("seed, n", [(1, 300), (2, 40), (3, 0)])
def test_report_is_what_the_single_checks_say(spark, seed, n):
    frame = _table(spark, random.Random(seed), n)
    rules = [
        unique("a"), not_null("a"), unique("a", "b"), accepted_range("v", 2, 8, severity="warn"), unique("b", "a", severity="warn"),
        not_null("b"), unique("extra"),
    ]
    single = {
        "unique": lambda rule: check_unique(frame, *rule.columns),
        "not_null": lambda rule: check_not_null(frame, *rule.columns),
        "accepted_range": lambda rule: check_accepted_range(frame, *rule.columns, rule.low, rule.high),
    }
    report = quality_report(frame, rules, "t")
    assert report.columns == ["table", "column", "check", "severity", "failures", "passed"]
    found = report.collect()
    assert [(r.table, r.column, r.check, r.severity) for r in found] == [("t", r.column, r.check, r.severity) for r in rules]
    expected = [single[rule.check](rule).first().failures for rule in rules]
    assert [r.failures for r in found] == expected
    assert [r.passed for r in found] == [failures == 0 for failures in expected]


def test_report_without_unique_rules(spark):
    frame = _table(spark, random.Random(4), 50)
    found = quality_report(frame, [not_null("a"), not_null("b")]).collect()
    assert [r.failures for r in found] == [frame.where("a is null").count(), frame.where("b is null").count()]


@pytest.mark.parametrize("n", [200, 0])
def test_counts_of_distinct_values(spark, n):
    frame = _table(spark, random.Random(5), n)
    tables = {"rows": (), "a": ("a",), "ab": ("a", "b"), "ba": ("b", "a"), "extra": ("extra",)}
    single = {name: frame.select(*columns).distinct() if columns else frame for name, columns in tables.items()}
    assert rows(value_counts(frame, tables)) == rows(row_counts(single))


def test_one_scan(spark, tmp_path):
    _table(spark, random.Random(6), 100).write.parquet(str(tmp_path / "t"))
    frame = spark.read.parquet(str(tmp_path / "t"))
    report = quality_report(frame, [unique("a"), unique("a", "b"), not_null("b"), accepted_range("v", 0, 1)])
    counts = value_counts(frame, {"rows": (), "a": ("a",), "b": ("b",)})
    for plan in (_plan(report), _plan(counts)):
        assert plan.count("FileScan parquet") == 1 and "extra" not in plan
        assert "partial_count" in plan  # before the shuffle


APPENDER = """
import sys
sys.path.insert(0, {root!r})
from pluvia.plans import append_run_log
from pluvia.session import build_session
spark = build_session("appender", master="local[1]")
for i in range(50):
    append_run_log(spark, {log!r}, "etapa", 2000 + i, "sucesso", i)
"""


def test_two_drivers_append_to_one_log(spark, tmp_path):
    log = str(tmp_path / "log")
    program = APPENDER.format(root=ROOT, log=log)
    other = subprocess.Popen([sys.executable, "-c", program], stdout=subprocess.DEVNULL, stderr=subprocess.DEVNULL)
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(lambda i: append_run_log(spark, log, "outra", i, "falha", erro='a "b"\n\tç'), range(50)))
    assert other.wait(timeout=120) == 0
    found = read_run_log(spark, log)
    assert rows(found.groupBy("etapa").count()) == [("etapa", 50), ("outra", 50)]
    assert rows(found.where("etapa = 'outra'").select("erro").distinct()) == [('a "b"\n\tç',)]
    assert found.select("ano", "etapa").distinct().count() == 100
    files = [name for name in os.listdir(log) if not name.startswith(".")]
    assert len(files) == 100
    with open(os.path.join(log, files[0]), encoding="utf-8") as file:
        assert list(json.loads(file.read())) == ["etapa", "ano", "status", "linhas", "inicio", "fim", "duracao_s", "erro"]
