from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pluvia.functions import (
    invalid_number,
    month_window,
    parse_decimal,
    parse_measure,
    parse_utc_timestamp,
    season,
    split_cells,
    split_key_value,
)


def values(spark, rows, schema, *columns):
    return [tuple(row) for row in spark.createDataFrame(rows, schema).select(*columns).collect()]


NUMBERS = [
    (",8", 0.8, False),
    (" 1,5 ", 1.5, False),
    ("1.5", 1.5, False),
    ("1e3", 1000.0, False),
    ("-15,78", -15.78, False),
    ("+3", 3.0, False),
    ("5,", 5.0, False),
    ("-9999", -9999.0, False),
    ("", None, False),
    ("  ", None, False),
    ("NULL", None, False),
    ("null", None, False),
    ("NaN", None, False),
    ("N/A", None, False),
    (None, None, False),
    ("x", None, True),
    ("1.234,5", None, True),
    ("1d", None, True),
    ("0x1p3", None, True),
    ("Infinity", None, True),
    ("1,2,3", None, True),
    ("-", None, True),
    ("1 2", None, True),
]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_numbers(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        rows = [(i, text) for i, (text, _, _) in enumerate(NUMBERS)]
        text, value = F.col("t"), parse_decimal(F.col("t"))
        frame = spark.createDataFrame(rows, "i int, t string").select("i", "t", value.alias("v"))
        result = frame.orderBy("i").select("v", F.coalesce(invalid_number(text, F.col("v")), F.lit(False)))
        assert [tuple(row) for row in result.collect()] == [(v, bad) for _, v, bad in NUMBERS]
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_sentinels_are_off_by_default(spark):
    rows = [("-9999",), ("1,5",), (None,)]
    text = F.col("t")
    assert values(spark, rows, "t string", parse_measure(text), parse_measure(text, [-9999])) == [
        (-9999.0, None), (1.5, 1.5), (None, None),
    ]


TIMES = [
    ("2023/01/01", "0100 UTC", datetime(2023, 1, 1, 1)),
    ("2018/11/04", "0000 UTC", datetime(2018, 11, 4)),
    ("2023/01/01", "2359 UTC", datetime(2023, 1, 1, 23, 59)),
    ("2023/01/01", "0100", datetime(2023, 1, 1, 1)),
    (None, "0100 UTC", None),
    ("2023/01/01", None, None),
]
BAD_TIMES = [
    ("2023/01/01", "2400 UTC"),
    ("2023/02/30", "0000 UTC"),
    ("2023-01-01", "0000 UTC"),
    ("2023/01/01", "01000 UTC"),
    ("2023/01/01", "01:00 UTC"),
    ("x", "0000 UTC"),
]


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo"])
@pytest.mark.parametrize("strict", [True, False])
def test_times_ignore_the_session_zone(spark, zone, strict):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        time = parse_utc_timestamp(F.col("d"), F.col("h"), strict)
        rows = [(d, h) for d, h, _ in TIMES]
        assert values(spark, rows, "d string, h string", time) == [(t,) for _, _, t in TIMES]
        assert spark.createDataFrame(rows, "d string, h string").select(time).dtypes[0][1] == "timestamp_ntz"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("bad", BAD_TIMES)
def test_unreadable_times(spark, ansi, bad):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        lenient = parse_utc_timestamp(F.col("d"), F.col("h"), strict=False)
        assert values(spark, [bad], "d string, h string", lenient) == [(None,)]
        with pytest.raises(Exception, match="not a UTC date and hour"):
            values(spark, [bad], "d string, h string", parse_utc_timestamp(F.col("d"), F.col("h")))
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_season(spark):
    months = [*range(1, 13), None]
    result = values(spark, [(m,) for m in months], "m int", season(F.col("m")))
    expected = dict.fromkeys((12, 1, 2), "verao") | dict.fromkeys((3, 4, 5), "outono")
    expected |= dict.fromkeys((6, 7, 8), "inverno")
    assert [r[0] for r in result] == [expected.get(m, "primavera") for m in months]


def test_other_seasons(spark):
    northern = {"winter": (12, 1, 2), "summer": (6, 7, 8)}
    result = values(spark, [(1,), (7,), (4,)], "m int", season(F.col("m"), northern, "between"))
    assert result == [("winter",), ("summer",), ("between",)]


def test_cells_and_keys(spark):
    rows = [("a;b;",), ('"x;y";"say ""hi""";3',), ("",), (";",)]
    assert values(spark, rows, "l string", split_cells(F.col("l"))) == [
        (["a", "b", ""],), (["x;y", 'say "hi"', "3"],), ([""],), (["", ""],),
    ]
    rows = [("REGIAO:;CO",), (" UF : ; DF ",), ("CODIGO (WMO):;A;B",), ("lonely",), ("K:; v ",)]
    pair = split_key_value(F.col("l"))
    assert values(spark, rows, "l string", pair["key"], pair["value"]) == [
        ("REGIAO", "CO"), ("UF", "DF"), ("CODIGO (WMO)", "A;B"), ("lonely", ""), ("K", "v"),
    ]


def test_month_window_is_half_open(spark):
    times = [datetime(2022, 11, 30, 23, 59), datetime(2022, 12, 1), datetime(2022, 12, 31, 23), datetime(2023, 1, 1)]
    result = values(spark, [(t,) for t in times], "t timestamp_ntz", month_window(F.col("t"), 2022, 12))
    assert [r[0] for r in result] == [False, True, True, False]
