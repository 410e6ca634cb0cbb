import datetime as dt

import pytest
from conftest import T
from pyspark.sql import functions as F

from opsmetrics.functions.windows import ReportWindow, in_window, next_window, overlaps


def test_bounds(spark):
    w = ReportWindow.of("2024-01-08 10:00:00", "2024-01-08 10:59:59")
    df = spark.createDataFrame([(T("2024-01-08 10:00:00"),), (T("2024-01-08 10:00:01"),), (T("2024-01-08 10:59:59"),)],
                               "ts timestamp_ntz")

    def kept(bounds):
        return sorted(r.ts.strftime("%H:%M:%S") for r in df.where(in_window("ts", w, bounds)).collect())

    assert kept("open") == ["10:00:01"]
    assert kept("half_open") == ["10:00:00", "10:00:01"]
    assert kept("closed") == ["10:00:00", "10:00:01", "10:59:59"]


@pytest.mark.parametrize(
    "start,end,kept",
    [
        ("09:00", "10:00", True),  # end touches S
        ("09:00", "13:00", True),  # covers the window
        ("12:00", "13:00", True),  # start touches E
        ("12:01", "13:00", False),  # after
        ("11:00", None, True),  # open task starting inside
        ("09:00", None, False),  # open task starting before: every other test is NULL
        ("11:00", "09:00", True),  # reversed, start inside
    ],
)
def test_overlap(spark, start, end, kept):
    w = ReportWindow.of("2024-01-08 10:00:00", "2024-01-08 12:00:00")
    day = "2024-01-08 "
    row = (T(day + start), T(day + end) if end else None)
    df = spark.createDataFrame([row], "startdate timestamp_ntz, enddate timestamp_ntz")
    assert (df.where(overlaps("startdate", "enddate", w)).count() == 1) is kept


def test_next_window():
    now = dt.datetime(2024, 1, 8, 12, 34, 56)
    w = next_window(dt.datetime(2024, 1, 8, 9), now)
    assert (w.start, w.end) == (dt.datetime(2024, 1, 8, 10), dt.datetime(2024, 1, 8, 11, 59, 59))
    assert next_window(dt.datetime(2024, 1, 8, 11), dt.datetime(2024, 1, 8, 12, 34)) is None
    with pytest.raises(ValueError):
        next_window(None, now)
    w = next_window(None, now, bootstrap="2024-01-08 00:00:00")
    assert w.start == dt.datetime(2024, 1, 8)


def test_window_length():
    w = ReportWindow.of("2024-01-08 00:00:00", "2024-01-14 23:59:59")
    assert w.length_micros == 604_799 * 1_000_000
