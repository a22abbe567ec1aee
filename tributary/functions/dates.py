"""Dates named in words: instants for SQL ranges, and calendar or fiscal periods for date filters.

Everything here runs once on the driver and yields literals, so filters built from it reach the scan.
All instants are UTC. Periods are half-open ``[start, end)`` pairs of dates; weeks start on Monday.
"""

from __future__ import annotations

import re
from datetime import UTC, date, datetime, timedelta

from tributary.errors import ExtractError

# --------------------------------------------------------------------------------------------------
# Instants
# --------------------------------------------------------------------------------------------------

_AGO = re.compile(
    r"(?:in\s+)?(\d+|an?)\s+(second|minute|hour|day|week|month|year)s?(?:\s+(ago|from now))?", re.IGNORECASE
)
_SPAN = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def utc_now() -> datetime:
    return datetime.now(UTC).replace(tzinfo=None)


def add_months(day: date, months: int) -> date:
    """Shift by months, keeping the day of month where the target month has it (datetimes keep the time)."""
    index = day.year * 12 + day.month - 1 + months
    year, month = divmod(index, 12)
    following = date(year + (month == 11), (month + 1) % 12 + 1, 1)
    last = (following - timedelta(days=1)).day
    return day.replace(year=year, month=month + 1, day=min(day.day, last))


def resolve_instant(text: str, as_of: datetime | None = None) -> datetime:
    """``2024-01-01``, ``2024-01-01T10:00:00Z``, ``5 days ago``, ``now``, ``today``, ``yesterday`` as UTC.

    Relative words count from ``as_of`` and keep its time of day.
    """
    now = (as_of or utc_now()).replace(tzinfo=None)
    word = text.strip().lower()
    if word in ("now", "today"):
        return now
    if word in ("yesterday", "tomorrow"):
        return now + timedelta(days=1 if word == "tomorrow" else -1)
    match = _AGO.fullmatch(word)
    if match and (match[3] or word.startswith("in ")):
        amount = int(match[1]) if match[1].isdigit() else 1
        amount = -amount if match[3] == "ago" else amount
        if match[2] in _SPAN:
            return now + timedelta(seconds=amount * _SPAN[match[2]])
        return add_months(now, amount * (12 if match[2] == "year" else 1))
    parsed = datetime.fromisoformat(text.strip())
    return parsed.astimezone(UTC).replace(tzinfo=None) if parsed.tzinfo else parsed


def resolve_range(date_from: str, date_to: str = "now", as_of: datetime | None = None) -> tuple[datetime, datetime]:
    """Both ends of a range, to the second; the message of a failure names both inputs."""
    now = as_of or utc_now()
    try:
        start, end = resolve_instant(date_from, now), resolve_instant(date_to, now)
        if start > end:
            raise ValueError("the start lies after the end")
    except ValueError as exc:
        raise ExtractError(
            f"cannot read the date range (start '{date_from}', end '{date_to}'): {exc}; "
            "give dates such as 2024-01-01, or words such as '5 days ago' and 'now'"
        ) from exc
    return start.replace(microsecond=0), end.replace(microsecond=0)


# --------------------------------------------------------------------------------------------------
# Periods
# --------------------------------------------------------------------------------------------------

Period = tuple[date, date]

_UNITS = "FiscalYear|FiscalHalf|FiscalQuarter|BusinessWeek|Year|Half|Quarter|Month|Week|Day"
_MONTHS = {"Month": 1, "Quarter": 3, "Half": 6, "Year": 12}
# The number words the period names use.
_NUMBER = {"one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "ten": 10, "thirty": 30, "sixty": 60, "ninety": 90}


def _shift(day: date, unit: str, count: int) -> date:
    unit = unit.removeprefix("Fiscal")
    if unit in _MONTHS:
        return add_months(day, count * _MONTHS[unit])
    return day + timedelta(days=count * (1 if unit == "Day" else 7))


class Calendar:
    """Periods around ``as_of``; fiscal quarters, halves and years count from ``fiscal_start_month``."""

    def __init__(self, as_of: date, fiscal_start_month: int = 1):
        if not 1 <= fiscal_start_month <= 12:
            raise ExtractError("fiscal_start_month must be 1 to 12")
        self.today = as_of.date() if isinstance(as_of, datetime) else as_of
        self.fiscal = fiscal_start_month

    def start(self, day: date, unit: str) -> date:
        if unit in ("Week", "BusinessWeek"):
            return day - timedelta(days=day.weekday())
        if unit == "Day":
            return day
        months = _MONTHS[unit.removeprefix("Fiscal")]
        first = self.fiscal if unit.startswith("Fiscal") else 1
        return add_months(day.replace(day=1), -((day.month - first) % months))

    def period(self, unit: str, offset: int = 0, around: date | None = None) -> Period:
        """The period of ``unit`` that is ``offset`` away from the one holding ``around`` (today)."""
        start = _shift(self.start(around or self.today, unit), unit, offset)
        return start, start + timedelta(days=5) if unit == "BusinessWeek" else _shift(start, unit, 1)

    def to_date(self, period: Period, unit: str) -> Period:
        """Cut a period at the point today has reached in its own period of that unit (inclusive)."""
        reached = self.today - self.start(self.today, unit)
        return period[0], min(period[1], period[0] + reached + timedelta(days=1))

    def rolling(self, unit: str, offset: int) -> Period:
        """A unit-long span ending today (0), or that span moved back by whole units."""
        tomorrow = self.today + timedelta(days=1)
        return _shift(tomorrow, unit, offset - 1), _shift(tomorrow, unit, offset)

    def day(self, day: date) -> Period:
        return day, day + timedelta(days=1)

    # ---- named periods ---------------------------------------------------

    def named(self, name: str) -> Period:
        """Period for a name such as ``lastWeek``, ``thisMonthToDate`` or ``fiveDaysAgo``."""
        if name.startswith("startOf"):
            inner = name.removeprefix("startOf")
            return self.day(self.named(inner[:1].lower() + inner[1:])[0])
        for rule in (
            self._days, self._near, self._far, self._rolling, self._adjacent, self._same_day, self._same, self._ago,
            self._previous,
        ):
            found = rule(name)
            if found:
                return found
        raise ExtractError(f"unknown relative date '{name}'")

    def _days(self, name: str) -> Period | None:
        fixed = {"today": 0, "yesterday": -1, "tomorrow": 1}
        if name in fixed:
            return self.day(self.today + timedelta(days=fixed[name]))
        match = re.fullmatch(r"([a-z]+)Days(Ago|FromNow)", name)
        if match and match[1] in _NUMBER:
            sign = -1 if match[2] == "Ago" else 1
            return self.day(self.today + timedelta(days=sign * _NUMBER[match[1]]))
        return None

    def _near(self, name: str) -> Period | None:
        match = re.fullmatch(rf"(last|this|next)({_UNITS})(ToDate)?", name)
        if not match or match[2] == "Day":
            return None
        period = self.period(match[2], {"last": -1, "this": 0, "next": 1}[match[1]])
        return self.to_date(period, match[2]) if match[3] else period

    def _far(self, name: str) -> Period | None:
        if name == "oneYearBeforeLast":
            return self.period("Year", -2)
        match = re.fullmatch(rf"({_UNITS})(BeforeLast|AfterNext)(ToDate)?", name[:1].upper() + name[1:])
        if not match:
            return None
        period = self.period(match[1], -2 if match[2] == "BeforeLast" else 2)
        return self.to_date(period, match[1]) if match[3] else period

    def _rolling(self, name: str) -> Period | None:
        match = re.fullmatch(r"(this|last|previous)Rolling(Half|Quarter|Year)", name)
        return self.rolling(match[2], {"this": 0, "last": -1, "previous": -2}[match[1]]) if match else None

    def _adjacent(self, name: str) -> Period | None:
        """Spans that touch today: the next or previous N units, counted from today."""
        tomorrow = self.today + timedelta(days=1)
        if name == "nextFourWeeks":
            return tomorrow, tomorrow + timedelta(days=28)
        if name == "fourWeeksStartingThisWeek":
            start = self.start(self.today, "Week")
            return start, start + timedelta(days=28)
        match = re.fullmatch(r"(next|previous)One(Day|Week|Month|Quarter|Half|Year)", name)
        if not match:
            return None
        if match[1] == "next":
            return tomorrow, _shift(tomorrow, match[2], 1)
        return _shift(self.today, match[2], -1), self.today

    def _anchor(self, name: str) -> tuple[str, int] | None:
        """``LastFiscalYear`` is (FiscalYear, -1); ``FiscalYearBeforeLast`` is (FiscalYear, -2)."""
        match = re.fullmatch(rf"Last({_UNITS})|({_UNITS})BeforeLast", name)
        if not match:
            return None
        return (match[1], -1) if match[1] else (match[2], -2)

    def _same_day(self, name: str) -> Period | None:
        anchor = self._anchor(name.removeprefix("sameDay")) if name.startswith("sameDay") else None
        return self.day(_shift(self.today, *anchor)) if anchor else None

    def _same(self, name: str) -> Period | None:
        match = re.fullmatch(r"same(Week|Month|FiscalQuarter|FiscalHalf)(\w+?)(ToDate)?", name)
        anchor = self._anchor(match[2]) if match else None
        if not anchor:
            return None
        period = self.period(match[1], around=_shift(self.today, *anchor))
        return self.to_date(period, match[1]) if match[3] else period

    def _ago(self, name: str) -> Period | None:
        match = re.fullmatch(rf"([a-z]+)({_UNITS})s?Ago(ToDate)?", name)
        if match and match[1] in _NUMBER and match[2] != "Day":
            period = self.period(match[2], -_NUMBER[match[1]])
            return self.to_date(period, match[2]) if match[3] else period
        match = re.fullmatch(r"last(Month|FiscalQuarter|FiscalHalf)(One|Two)(FiscalQuarter|FiscalYear)s?Ago", name)
        if not match:
            return None
        return self.period(match[1], -1, around=_shift(self.today, match[3], -_NUMBER[match[2].lower()]))

    def _previous(self, name: str) -> Period | None:
        """Whole months or quarters already finished inside a larger period."""
        match = re.fullmatch(r"previous(Months|FiscalQuarters)(This|Last|Same)(FiscalQuarter|FiscalHalf|FiscalYear)(LastFiscalYear)?", name)
        if not match or (match[2] == "Same") != bool(match[4]):
            return None
        small = match[1].removesuffix("s")
        around = _shift(self.today, "Year", -1) if match[4] else self.today
        if match[2] == "Last":
            around = _shift(self.today, match[3], -1)
        return self.start(around, match[3]), self.start(around, small)


def relative_range(name: str, as_of: date, fiscal_start_month: int = 1) -> Period:
    """``[start, end)`` of a named period."""
    return Calendar(as_of, fiscal_start_month).named(name)
