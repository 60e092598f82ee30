import datetime as dt
import uuid

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shiftledger.functions import (
    divide_or_zero,
    has_reason,
    normalize_date,
    normalize_line,
    normalize_shift,
    parse_int,
    safe_divide,
    shift_log_id,
    strip,
    uuid_v5,
)

from .logs import NAMESPACE


def apply(spark, function, values):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, v string")
    return [r[0] for r in df.orderBy("i").select(function(F.col("v")).alias("x")).collect()]


# what a text stands for, written out by hand
INTEGERS = {
    None: None, "": None, "  ": None, "1__0": None, "_1": None, "12_": None, "1.0": None, "1e3": None,
    "- 3": None, "abc": None, "+-1": None, "+": None, "1 2": None, "\x017": None, "12": 12, " 12 ": 12,
    " 12\u3000": 12, "+5": 5, "-3": -3, "1_000": 1000, "007": 7, "\x1c7": 7, "12\n": 12, " 7 ": 7, "0": 0, "-0": 0,
    "9223372036854775807": 2**63 - 1, "-9223372036854775808": -(2**63), "99999999999999999999": None,
    "\uff11\uff12": 12, "\u0663": 3, "\u0967_\u0968": 12, "\U0001d7ce\U0001d7cf": 1, "\u00b2": None,
}
JANUARY_5 = dt.date(2026, 1, 5)
DATES = {
    "2026-01-05": JANUARY_5, "2026/1/5": JANUARY_5, "2026.01.05": JANUARY_5, "05-01-2026": JANUARY_5,
    "5/1/2026": JANUARY_5, "05.01.2026": JANUARY_5, " 2026-01-05 ": JANUARY_5, "\u30005/1/2026": JANUARY_5,
    "2026-01- 5": JANUARY_5, "\uff12\uff10\uff12\uff16-01-05": JANUARY_5, "29.02.2024": dt.date(2024, 2, 29),
    "0999-01-01": dt.date(999, 1, 1), "31-12-1999\n": dt.date(1999, 12, 31), "9999-12-31": dt.date(9999, 12, 31),
    **dict.fromkeys(
        [None, "", "   ", "2026-13-01", "2026-02-30", "0000-01-01", "2026-01/05", "2026-01-05 00:00", "26-01-05",
         "2026-001-05", "20260105", "12/31/2026", "2026-01-5x", "2026- 1-05", "00-01-2026", "05/ 1/2026", "2026",
         "2026-01", "2026-01- 15", "--", "1/1/0000", "2026-01-05\n2026-01-06"]
    ),
}


def test_parse_int(spark):
    assert apply(spark, parse_int, list(INTEGERS)) == list(INTEGERS.values())


def test_normalize_date(spark):
    assert apply(spark, normalize_date, list(DATES)) == list(DATES.values())


TEXTS = [None, "", " ", "a", " a b ", "\t x ", "\x1f", "​z", "líné 　", "\n a\n b \n", "\x00a\x00"]


def test_strip_and_labels(spark):
    stripped = [None if v is None else v.strip() for v in TEXTS]
    assert apply(spark, strip, TEXTS) == stripped
    assert apply(spark, normalize_line, TEXTS) == [v or None for v in stripped]
    assert apply(spark, normalize_shift, TEXTS) == [v.upper() if v else None for v in stripped]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.dates(), min_size=20, max_size=40), st.lists(st.integers(-(2**63), 2**63 - 1), min_size=20, max_size=40))
def test_written_values_are_read_back(spark, dates, numbers):
    for form in ("{0.year:04}-{0.month}-{0.day:02}", "{0.day}.{0.month:02}.{0.year:04}", " {0.year:04}/{0.month:02}/{0.day} "):
        assert apply(spark, normalize_date, [form.format(d) for d in dates]) == dates
    assert apply(spark, normalize_date, [f"{d.day}.{d.month}/{d.year:04}" for d in dates]) == [None] * len(dates)
    assert apply(spark, parse_int, [f" {n:_}\t" for n in numbers]) == numbers
    assert apply(spark, parse_int, [f"{n}." for n in numbers]) == [None] * len(numbers)


UUIDS = {
    "2026-01-05|A|Saw 1": "9bc71558-e071-5697-8c71-b6c9986594f3",
    "2026-01-05|B|Saw 1": "82fef11d-79dd-51b6-b3c2-9c04d84fa5be",
    "2026-12-31|C|Saw 4": "4737f6e0-db06-5358-bdab-899db60f2b64",
    "2024-02-29|A|Säge 2": "b3669f59-392f-5127-a636-e0e954c01f83",
}


def test_uuid_v5(spark):
    names = list(UUIDS) + [f"name {i}" for i in range(300)]
    expected = [str(uuid.uuid5(uuid.UUID(NAMESPACE), n)) for n in names]
    assert expected[: len(UUIDS)] == list(UUIDS.values())
    assert apply(spark, lambda c: uuid_v5(NAMESPACE, c), names) == expected


@pytest.mark.parametrize(
    "date, shift, line, expected",
    [
        ("2026-01-05", "A", "Saw 1", UUIDS["2026-01-05|A|Saw 1"]),
        (None, "A", "Saw 1", None),
        ("2026-01-05", "D", "Saw 1", None),
        ("2026-01-05", None, "Saw 1", None),
        ("2026-01-05", "A", None, None),
        ("2026-01-05", "A", "  ", None),
    ],
)
def test_shift_log_id(spark, date, shift, line, expected):
    df = spark.createDataFrame([(date, shift, line)], "d string, s string, l string")
    key = shift_log_id(NAMESPACE, F.col("d").cast("date"), F.col("s"), F.col("l"))
    assert df.select(key).first()[0] == expected


def test_division(spark):
    df = spark.createDataFrame([(1, 4), (1, 0), (1, None), (None, 2)], "a bigint, b bigint")
    a, b = F.col("a"), F.col("b")
    got = df.select(safe_divide(a, b).alias("s"), divide_or_zero(a, b).alias("z")).collect()
    assert [r.s for r in got] == [0.25, None, None, None]
    assert [r.z for r in got] == [0.25, 0.0, 0.0, 0.0]


def test_has_reason_is_never_null(spark):
    df = spark.createDataFrame([(["x"],), ([],), (None,)], "r array<string>")
    assert [r[0] for r in df.select(has_reason(F.col("r"), "x")).collect()] == [True, False, False]
