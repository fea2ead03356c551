"""Scalar functions on single values, against plain Python where there is one."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from sportmart.functions import (
    academic_year,
    clock_minutes,
    has_column,
    hms,
    initials,
    last_segment,
    local_date,
    local_time,
    london_to_local,
    nth,
    object_keys,
    parse_long_date,
    path_or_null,
    season_label,
)


def apply(spark, function, values, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, v {dtype}")
    got = df.select("i", function(F.col("v")).alias("r")).collect()
    return [row["r"] for row in sorted(got, key=lambda row: row["i"])]


@pytest.mark.parametrize(
    "function, values, expected",
    [
        (initials, ["Central Defender/Midfielder", "Goalkeeper", "a  b", "", None], ["CDM", "G", "ab", "", None]),
        (last_segment, ["/stats/top/goals", "/x/saves?po=GOALKEEPER", "plain", "/x/", None],
         ["goals", "saves", "plain", "", None]),
        (season_label, ["2022/23", "2022-23", None], ["2022-23", "2022-23", None]),
        (object_keys, ['{"a": 1, "b": {"c": 2}}', "[1]", "junk", None], [["a", "b"], None, None, None]),
        (clock_minutes, ["90 +5'00", "45", "90 +5'12", "", None], [95, 45, None, None, None]),
        (parse_long_date, ["31 March 1998", "1 May 2000", "32 May 2000", "May", None],
         [dt.date(1998, 3, 31), dt.date(2000, 5, 1), None, None, None]),
        (local_time, ["Sat 12 Aug 2023, 15:00 BST", "Mon 26 Dec 2022, 20:00 GMT", "Sun 29 Oct 2023, 01:30",
                      "Sun 26 Mar 2023, 01:30", "Sat 12 Aug 2023", "Sat 12 Aug 2023, 25:00", None],
         ["21:00", "03:00", "08:30", "08:30", None, None, None]),
        (local_date, ["Sat 12 Aug 2023, 15:00 BST", "Mon 26 Dec 2022, 20:00 GMT", "nothing", None],
         [dt.date(2023, 8, 12), dt.date(2022, 12, 27), None, None]),
    ],
)
def test_text_functions(spark, function, values, expected):
    assert apply(spark, function, values) == expected


def test_kickoff_does_not_depend_on_the_session_zone(spark):
    values = ["Sat 12 Aug 2023, 15:00 BST", "Sun 26 Mar 2023, 01:30", "Sun 29 Oct 2023, 01:30"]
    before = spark.conf.get("spark.sql.session.timeZone")
    expected = [dt.datetime(2023, 8, 12, 21), dt.datetime(2023, 3, 26, 8, 30), dt.datetime(2023, 10, 29, 8, 30)]
    try:
        for zone in ("UTC", "Europe/London", "America/Sao_Paulo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert apply(spark, london_to_local, values) == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_academic_year_against_python(spark):
    rng = random.Random(1)
    days = [dt.date(2023, 5, 13), dt.date(2023, 9, 1), dt.date(1999, 9, 1), dt.date(2023, 8, 31)]
    days += [dt.date(1990, 1, 1) + dt.timedelta(days=rng.randrange(20000)) for _ in range(300)]

    def label(day, start_month=9):
        start = day.year - (day.month < start_month)
        return f"{start}-{str(start + 1)[2:]}"

    assert apply(spark, academic_year, days, "date") == [label(d) for d in days]
    july = apply(spark, lambda c: academic_year(c, start_month=7), days, "date")
    assert july == [label(d, 7) for d in days]


def test_hms_against_python(spark):
    rng = random.Random(2)
    values = [0.0, 0.5, 1.5, 2.5, 59.5, 3599.5, 360000.0, -5.0] + [rng.uniform(0, 500000) for _ in range(300)]

    def text(value):
        minutes, s = divmod(round(value), 60)
        h, m = divmod(minutes, 60)
        return f"{h:02d}:{m:02d}:{s:02d}"

    assert apply(spark, hms, values, "double") == [text(v) for v in values]
    assert apply(spark, hms, [None], "double") == [None]


def test_decimals_round_half_up(spark):
    got = apply(spark, lambda c: c.cast("decimal(10,0)").cast("int"), [2.5, 3.5, -2.5], "double")
    assert got == [3, 4, -3]


def test_paths(spark):
    df = spark.createDataFrame([((1, None),)], "s STRUCT<a: INT, b: STRUCT<c: STRING>>")
    row = df.select(
        path_or_null(df, "s.a", "bigint"), path_or_null(df, "s.b.c", "string"), path_or_null(df, "s.x.y", "bigint")
    )
    assert [c.dataType.simpleString() for c in row.schema] == ["bigint", "string", "bigint"]
    assert tuple(row.first()) == (1, None, None)
    assert has_column(df, "s") and not has_column(df, "t")


def test_nth_beyond_the_end_is_null(spark):
    df = spark.createDataFrame([([(5,)],)], "a ARRAY<STRUCT<id: INT>>")
    assert tuple(df.select(nth("a", 0, "id"), nth("a", 1, "id")).first()) == (5, None)
