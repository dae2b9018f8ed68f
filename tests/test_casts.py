"""Lenient and strict casts. Expected values were read off DuckDB's try_cast."""

from datetime import datetime

import pytest

from billweave.functions import ingest_time, lenient_int, lenient_number, lenient_time, no_number, unreadable
from billweave.functions.casts import ingest_value

INTS = {
    "12": 12, "1.5": 2, "2.5": 3, "-1.5": -2, "0.5": 1, "278254.0": 278254, "1e3": 1000,
    "abc": None, "": None, " 7 ": 7, "99999999999": 99999999999, "-0": 0, "+5": 5, "1.": 1,
    ".5": 1, "1e-1": 0, "INV-77": None, "9223372036854775808": None, "-": None, "1e30": None,
}
NUMBERS = {
    "1.5": 1.5, " 1.5 ": 1.5, ".5": 0.5, "5.": 5.0, "+2": 2.0, "-2.5e-1": -0.25, "1,5": None,
    "n/a": None, "": None, "1e": None, "1-2": None, "nan": None, "inf": None, "-inf": None,
    "Infinity": None, "1e400": None, "1e39": None, "1.5f": None, "1.5d": None, "0x1p3": None,
}
DAY = datetime(2024, 4, 2)
TIMES = {
    "2024-04-02 13:20:45.000000": datetime(2024, 4, 2, 13, 20, 45),
    "2024-04-02T13:20:45.337Z": datetime(2024, 4, 2, 13, 20, 45, 337000),
    "2024-04-02 10:00:00 UTC": datetime(2024, 4, 2, 10),
    "2024-04-02 10:00:00+05:30": datetime(2024, 4, 2, 10),
    "2024-04-02": DAY, "2024-4-2": DAY, "2024-04-31": None, "2024": None, "2024-04": None,
    "now": None, "today": None, "": None, "junk": None, "1712000000": None,
    "2024-03-10 02:30:00": datetime(2024, 3, 10, 2, 30),  # does not exist in New York
}
INGESTED = {
    "2024-04-02T10:00:00Z": datetime(2024, 4, 2, 10),
    "2024-04-02T10:00:00+05:30": datetime(2024, 4, 2, 4, 30),
    "2024-04-02 10:00:00-0300": datetime(2024, 4, 2, 13),
    "2024-04-02 10:00:00.25": datetime(2024, 4, 2, 10, 0, 0, 250000),
    "1712000000": datetime(2024, 4, 1, 19, 33, 20),
    "1712000000123": datetime(2024, 4, 1, 19, 33, 20, 123000),
    "2024-04-02": DAY, "": None, "bad": None,
    "2024-03-10 02:30:00": datetime(2024, 3, 10, 2, 30),
}


@pytest.mark.parametrize(
    "cast, expected",
    [(lenient_int, INTS), (lenient_number, NUMBERS), (lenient_time, TIMES), (ingest_time, INGESTED)],
)
def test_cast_list(spark, cast, expected):
    rows = spark.createDataFrame([(v,) for v in expected], "x string")
    assert {r.x: r.got for r in rows.select("x", cast("x").alias("got")).collect()} == expected


def test_types(spark):
    row = spark.createDataFrame([("100000000001",)], "x string").select(
        lenient_int("x", "int").alias("short"),
        lenient_int("x").alias("long"),
        lenient_number("x", "double").alias("double"),
        lenient_number("x", "decimal(28,10)").alias("exact"),
    )
    assert row.dtypes[0][1] == "int" and row.dtypes[3][1] == "decimal(28,10)"
    assert row.first()[:3] == (None, 100000000001, 100000000001.0)


def test_ingest_int_is_cut_not_rounded(spark):
    got = spark.createDataFrame([("7",), ("7.9",), ("x",), (" ",)], "x string")
    assert [r[0] for r in got.select(ingest_value("x", "int")).collect()] == [7, 7, None, None]


def test_edges_of_casts(spark):
    from pyspark.sql import functions as F

    from billweave.functions.casts import ingest_time, lenient_int, lenient_time

    texts = ["0.4999999999", "2.4999999999", "2.5", " 2024-04-02", "2024-04-02 10", "2024-04-02 10:30", "9" * 20, "9" * 13]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t",
        lenient_int("t").alias("n"),
        F.date_format(lenient_time("t"), "yyyy-MM-dd HH:mm").alias("at"),
        ingest_time("t").isNull().alias("unread"),
    )
    found = {r.t: r for r in rows.collect()}
    assert [found[t].n for t in texts[:3]] == [0, 2, 3]
    assert [found[t].at for t in texts[3:6]] == ["2024-04-02 00:00", None, "2024-04-02 10:30"]
    assert found["9" * 20].unread and not found["9" * 13].unread


def test_unreadable_numbers_are_told_by_one_cast(spark):
    """The same texts count as unreadable as by the cast that names its number twice."""
    texts = ["1", "-2.5", "1e99", "-1e99", "1e400", "NaN", "Infinity", "0x1p3", "1.5f", "n/a", "", "  ", " 7 ", "1 2", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for target in ("float", "double"):
        value = no_number("t", target)
        got = [r[0] for r in df.select(value).collect()]
        expected = [r[0] for r in df.select(unreadable("t", lenient_number("t", target))).collect()]
        assert [bool(x) for x in got] == [bool(x) for x in expected]
        assert df.select(value)._jdf.queryExecution().optimizedPlan().toString().count(f"as {target}") <= 1
