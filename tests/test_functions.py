from __future__ import annotations

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from portolan.functions import (
    calendar_columns,
    date_to_serial_day,
    hemisphere_coordinate,
    null_to,
    parse_date,
    place_key,
    season_of_month,
    sentinel_date,
    serial_day_to_date,
    serial_day_to_timestamp,
    split_pick,
    to_number,
    trimmed,
    zero_as_missing,
)


def values(spark, kind, rows, *expressions):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], f"i int, x {kind}")
    out = df.orderBy("i").select(*expressions).collect()
    return [r[0] if len(expressions) == 1 else tuple(r) for r in out]


def test_serial_day(spark):
    day = dt.date(2016, 4, 29)
    rows = [None, 0.0, -5.0, 20573.0, 20573.5, float("nan"), 1.0]
    expected = [None, None, None, day, day, None, dt.date(1960, 1, 2)]
    assert values(spark, "double", rows, serial_day_to_date("x")) == expected


def test_serial_day_keeps_time_of_day(spark):
    rows = [None, 0.0, 20573.0, 20573.75]
    expected = [None, None, dt.datetime(2016, 4, 29), dt.datetime(2016, 4, 29, 18)]
    assert values(spark, "double", rows, serial_day_to_timestamp("x")) == expected


def test_serial_day_round_trip(spark):
    days = [dt.date(1960, 1, 2), dt.date(2000, 2, 29), dt.date(2016, 12, 31)]
    assert values(spark, "date", days, serial_day_to_date(date_to_serial_day("x"))) == days


@pytest.mark.parametrize(
    ("kind", "rows", "expected"),
    [
        ("int", [None, 0.0, -0.0, 1.9, -2.7, 0.4, 92478461600.0, float("nan")],
         [None, None, None, 1, -2, 0, None, None]),
        ("bigint", [92478461600.0, 0.0], [92478461600, None]),
    ],
)
def test_zero_as_missing(spark, kind, rows, expected):
    assert values(spark, "double", rows, zero_as_missing("x", kind)) == expected


def test_split_pick(spark):
    rows = ["US-PA", "US", "a-b-c", None, "US-"]
    assert values(spark, "string", rows, split_pick("x", "-", 1)) == ["PA", None, "b", None, ""]
    pair = ["40.07, -74.93", "junk, 1", "7", None]
    first, second = split_pick("x", ",", 0, "float"), split_pick("x", ",", 1, "float")
    expected = [(40.07, -74.93), (None, 1.0), (7.0, None), (None, None)]
    assert values(spark, "string", pair, first, second) == expected
    assert values(spark, "string", ["a.b|c", "1.2"], split_pick("x", ".", 1)) == ["b|c", "2"]
    assert values(spark, "string", ["a||7"], split_pick("x", "||", 1, "int")) == [7]


def test_split_pick_takes_only_known_types():
    with pytest.raises(ValueError):
        split_pick("x", "-", 0, "__import__('os')")
    with pytest.raises(ValueError):
        split_pick("x", "")
    with pytest.raises(ValueError):
        split_pick("x", "-", -1)


def test_hemisphere_coordinate(spark):
    rows = ["57.05N", "10.33W", "12.5", "5N", None, "33.1S", "4.2E", "N", "xN", "1N2S"]
    expected = [57.05, -10.33, 0.0, 5.0, None, -33.1, 4.2, None, None, None]
    assert values(spark, "string", rows, hemisphere_coordinate("x")) == expected


def test_sentinel_date(spark):
    rows = ["D/S", "2016-04-29", "junk", None]
    expected = [(None, True), (dt.date(2016, 4, 29), False), (None, False), (None, False)]
    assert values(spark, "string", rows, *sentinel_date("x")) == expected


def test_parse_date(spark):
    rows = ["2000-01-31", "2000-02-31", "x", None]
    assert values(spark, "string", rows, parse_date("x")) == [dt.date(2000, 1, 31), None, None, None]


def test_numbers_and_text(spark):
    assert values(spark, "string", [" 5 ", "5.5", "n/a", None], to_number("x")) == [5, 5.5, None, None]
    assert values(spark, "double", [None, 2.0], null_to("x", 0.0)) == [0.0, 2.0]
    assert values(spark, "string", ["  A B "], trimmed("x")) == ["A B"]
    keys = values(spark, "string", ["Nome", None], place_key("x", F.lit("AK")))
    assert keys == ["NOME, AK", None]


def test_calendar_columns(spark):
    c = calendar_columns("x")
    got = values(spark, "date", [dt.date(2016, 1, 1), dt.date(2016, 1, 3)], *c.values())
    assert list(c) == ["day", "week", "month", "month_name", "year", "day_of_week", "day_of_week_name"]
    assert got == [(1, 53, 1, "January", 2016, 6, "Fri"), (3, 53, 1, "January", 2016, 1, "Sun")]


def test_seasons(spark):
    got = values(spark, "int", list(range(1, 13)), season_of_month("x"))
    assert got == ["winter"] * 2 + ["spring"] * 3 + ["summer"] * 3 + ["autumn"] * 3 + ["winter"]


def test_text_functions_against_plain_python(spark):
    """Random text, the rules spelled out row by row."""
    draw = random.Random(7)
    texts = [
        "".join(draw.choice("NESW-,. 0123456789ab") for _ in range(draw.randint(0, 7)))
        for _ in range(2000)
    ]

    def number(text):
        try:
            return float(text) if re.fullmatch(r"\s*[-+]?(\d+\.?\d*|\.\d+)\s*", text) else None
        except ValueError:
            return None

    def coordinate(text):
        if "N" in text or "E" in text:
            return number(text.replace("N", "").replace("E", ""))
        if "S" in text or "W" in text:
            n = number(text.replace("S", "").replace("W", ""))
            return None if n is None else -n
        return 0.0

    def part(text, i):
        parts = text.split(",")
        return parts[i] if i < len(parts) else None

    got = values(
        spark, "string", texts,
        hemisphere_coordinate("x"), split_pick("x", ",", 0), split_pick("x", ",", 1),
        split_pick("x", ",", 1, "float"),
    )
    expected = [
        (coordinate(t), part(t, 0), part(t, 1), number(part(t, 1) or "")) for t in texts
    ]
    wrong = [(t, g, e) for t, g, e in zip(texts, got, expected) if g != e]
    assert not wrong, wrong[:5]


def test_numbers_against_plain_python(spark):
    draw = random.Random(11)
    numbers = [draw.choice([0.0, draw.uniform(-5, 5), draw.uniform(1, 3e4)]) for _ in range(2000)]
    got = values(spark, "double", numbers, zero_as_missing("x"), serial_day_to_date("x"))
    epoch = dt.date(1960, 1, 1)
    expected = [
        (int(n) if n != 0 else None, epoch + dt.timedelta(days=int(n)) if n > 0 else None)
        for n in numbers
    ]
    assert got == expected
