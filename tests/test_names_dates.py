from datetime import date, datetime

import pytest

from tributary.errors import ExtractError
from tributary.functions import dates, names


@pytest.mark.parametrize(
    "name,safe", [("snow depth?", "snow_depth_"), ("....", "table"), ("", "table"), ("..x..y.", "x..y"), ("mü", "m_"), ("A-9_z.csv", "A-9_z.csv")]
)
def test_safe_segment(name, safe):
    assert names.safe_segment(name) == safe


def test_child_names():
    assert names.child_names("river", ["gauge", "low water"]) == {"gauge": "river_gauge", "low water": "river_low_water"}
    with pytest.raises(ExtractError, match="share the table name"):
        names.child_names("river", ["low water", "low?water"])


def test_default_names():
    assert names.default_table_name("record", record_type="tide table") == "tide_table"
    assert names.default_table_name("sql") == "sql_result"
    assert names.default_table_name("saved_search") == "saved_search"
    assert names.default_table_name("saved_search", search_id="s1") == "s1"
    assert names.default_table_name("endpoint", script_id="12") == "endpoint_12"
    with pytest.raises(ExtractError):
        names.default_table_name("other")


NOW = datetime(2024, 5, 15, 10, 30, 1)


@pytest.mark.parametrize(
    "text,expected",
    [
        ("now", NOW), ("today", NOW), ("yesterday", datetime(2024, 5, 14, 10, 30, 1)),
        ("5 days ago", datetime(2024, 5, 10, 10, 30, 1)), ("2 months ago", datetime(2024, 3, 15, 10, 30, 1)),
        ("a week ago", datetime(2024, 5, 8, 10, 30, 1)), ("1 hour ago", datetime(2024, 5, 15, 9, 30, 1)),
        ("in 2 days", datetime(2024, 5, 17, 10, 30, 1)), ("1 year ago", datetime(2023, 5, 15, 10, 30, 1)),
        ("2024-01-01", datetime(2024, 1, 1)), ("2024-01-01T10:00:00+02:00", datetime(2024, 1, 1, 8)),
    ],
)
def test_resolve_instant(text, expected):
    assert dates.resolve_instant(text, NOW) == expected


def test_resolve_range_errors_name_both_inputs():
    with pytest.raises(ExtractError, match="'whenever'.*'now'"):
        dates.resolve_range("whenever", "now", NOW)
    with pytest.raises(ExtractError, match="after the end"):
        dates.resolve_range("now", "5 days ago", NOW)


def test_add_months_keeps_to_the_month_end():
    assert dates.add_months(date(2024, 3, 31), -1) == date(2024, 2, 29)
    assert dates.add_months(date(2023, 12, 5), 1) == date(2024, 1, 5)


DAY = date(2024, 5, 15)  # a Wednesday


@pytest.mark.parametrize(
    "name,start,end",
    [
        ("today", "2024-05-15", "2024-05-16"), ("ninetyDaysAgo", "2024-02-15", "2024-02-16"),
        ("lastWeek", "2024-05-06", "2024-05-13"), ("lastBusinessWeek", "2024-05-06", "2024-05-11"),
        ("thisWeekToDate", "2024-05-13", "2024-05-16"), ("weekAfterNext", "2024-05-27", "2024-06-03"),
        ("lastMonthToDate", "2024-04-01", "2024-04-16"), ("monthBeforeLast", "2024-03-01", "2024-04-01"),
        ("thisYear", "2024-01-01", "2025-01-01"), ("oneYearBeforeLast", "2022-01-01", "2023-01-01"),
        ("thisFiscalYear", "2023-07-01", "2024-07-01"), ("lastFiscalQuarter", "2024-01-01", "2024-04-01"),
        ("thisFiscalHalf", "2024-01-01", "2024-07-01"), ("startOfLastMonth", "2024-04-01", "2024-04-02"),
        ("thisRollingQuarter", "2024-02-16", "2024-05-16"), ("lastRollingQuarter", "2023-11-16", "2024-02-16"),
        ("nextOneWeek", "2024-05-16", "2024-05-23"), ("previousOneMonth", "2024-04-15", "2024-05-15"),
        ("nextFourWeeks", "2024-05-16", "2024-06-13"), ("fourWeeksStartingThisWeek", "2024-05-13", "2024-06-10"),
        ("sameDayLastMonth", "2024-04-15", "2024-04-16"), ("sameMonthLastFiscalYear", "2023-05-01", "2023-06-01"),
        ("threeMonthsAgo", "2024-02-01", "2024-03-01"), ("lastMonthOneFiscalYearAgo", "2023-04-01", "2023-05-01"),
        ("previousMonthsThisFiscalHalf", "2024-01-01", "2024-05-01"),
        ("previousFiscalQuartersLastFiscalYear", "2022-07-01", "2023-04-01"),
    ],
)
def test_named_periods(name, start, end):
    assert dates.relative_range(name, DAY, 7) == (date.fromisoformat(start), date.fromisoformat(end))


@pytest.mark.parametrize("name", ["someday", "elevenDaysAgo", "lastDay", "sameDayNever", "startOfNothing", "previousMonthsSameFiscalYear"])
def test_unknown_periods_are_errors(name):
    with pytest.raises(ExtractError, match="unknown relative date"):
        dates.relative_range(name, DAY)
