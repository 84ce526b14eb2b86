"""Calendar expressions.

Column helpers return Spark Columns (JVM-side, codegen'd).  Run-date
arithmetic (which days make up "last week") is parameter work done once on
the driver; it never touches data.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_str(d: ColumnOrName) -> Column:
    """zero-padded month of a date, e.g. '05'."""
    return F.date_format(_col(d), "MM")


def year_str(d: ColumnOrName) -> Column:
    """four-digit year of a date as text, e.g. '2020'."""
    return F.date_format(_col(d), "yyyy")


def week_number(d: ColumnOrName) -> Column:
    """Monday-based week of year plus one (strftime ``%W`` + 1), not ISO.

    Days before the first Monday of the year are week 1, the first Monday
    starts week 2 -- unless the year starts on a Monday, then it is week 2
    from Jan 1.  ``weekday`` is 0 for Monday.
    """
    d = _col(d)
    return (F.floor((F.dayofyear(d) + 6 - F.weekday(d)) / 7) + 1).cast("int")


def week_number_py(day: _dt.date) -> int:
    """Driver-side twin of :func:`week_number` for labels."""
    return int(day.strftime("%W")) + 1


def compact_to_iso(s: ColumnOrName) -> Column:
    """'YYYYMMDD' -> 'YYYY-MM-DD' by slicing (no validation)."""
    s = _col(s)
    return F.concat_ws("-", F.substring(s, 1, 4), F.substring(s, 5, 2), F.substring(s, 7, 2))


def compact_to_date(s: ColumnOrName) -> Column:
    """'YYYYMMDD' text -> DATE; malformed text becomes NULL (never raises)."""
    return F.try_to_date(_col(s), "yyyyMMdd")


def report_days(report: DataFrame, days: list[_dt.date], column: str = "date") -> DataFrame:
    """Rows of the given days.  The report's own text is compared with the
    days' text, so the test reaches the scan."""
    return report.filter(F.col(column).isin(*[day.strftime("%Y%m%d") for day in days]))


def is_integer_text(s: ColumnOrName) -> Column:
    """Keep rows whose date is an integer (drops repeated header lines).

    Mirrors Python ``int()`` on text: optional surrounding blanks and sign.
    NULL dates are dropped too.
    """
    return F.coalesce(_col(s).rlike(r"^\s*[+-]?[0-9]+\s*$"), F.lit(False))


# ---------------------------------------------------------------- run dates

def _on_or_before(run_date: _dt.date, weekday: int, back: int = 1) -> _dt.date:
    """The ``back``-th occurrence of ``weekday`` (0=Mon) counting back from
    ``run_date`` inclusive: back=1 is the latest on or before the run date."""
    lag = (run_date.weekday() - weekday) % 7
    return run_date - _dt.timedelta(days=lag + 7 * (back - 1))


def monday_of(day: _dt.date) -> _dt.date:
    return day - _dt.timedelta(days=day.weekday())


def reporting_week(run_date: _dt.date, snap: bool = False) -> list[_dt.date]:
    """the seven report days for a run date, Monday first.

    The literal rule is "second-last Monday, last Tuesday .. last Sunday",
    which is one calendar week only when run on a Monday.  ``snap=True``
    moves the run date to its own Monday first, so any day of a week yields
    the previous Monday-Sunday.
    """
    if snap:
        run_date = monday_of(run_date)
    days = [_on_or_before(run_date, 0, 2)]
    days += [_on_or_before(run_date, wd, 1) for wd in range(1, 7)]
    return days


def four_week_calendar(run_date: _dt.date, snap: bool = False) -> list[_dt.date]:
    """the report days of the run date and of the same day one, two and
    three weeks before, ascending (28 days)."""
    back = [run_date - _dt.timedelta(weeks=n) for n in range(4)]
    return sorted(day for run in back for day in reporting_week(run, snap))


def week_range_label(days: list[_dt.date]) -> str:
    """P10: 'startWeek - endWeek  -  startDate - endDate' for a calendar."""
    first, last = min(days), max(days)
    return (f"{week_number_py(first)} - {week_number_py(last)}  -  "
            f"{first.isoformat()} - {last.isoformat()}")


def week_label(run_date: _dt.date, snap: bool = False) -> str:
    """P10: the WeekNumber text stamped on weekly tables (week of the report Monday)."""
    return str(week_number_py(reporting_week(run_date, snap)[0]))
