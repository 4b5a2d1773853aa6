from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the only date spelling that counts as valid; a time of day may follow and is left out.
DATE_PATTERN = r"^\d{4}-\d{1,2}-\d{1,2}(?:[ T]\d{1,2}:\d{2}[^\n]*)?\z"

# Fixed value: the fiscal year starts this many months after the calendar year.
FISCAL_SHIFT = 1


def strict_date(value: Column, stored_as: T.DataType) -> Column:
    """NULL unless ``value`` is a full calendar date, with or without a time of day.

    A feed that already stores dates (or timestamps) passes straight through, so a filter on the result still
    reaches the file scan.
    """
    if isinstance(stored_as, T.DateType):
        return value
    if not isinstance(stored_as, T.StringType):
        return value.cast("date")
    return F.when(_plain(value) | value.rlike(DATE_PATTERN), value.try_cast("date"))


def _plain(value: Column) -> Column:
    """Ten bytes with dashes and a last digit where yyyy-mm-dd has them: such text is a date by the pattern or none at all, so
    the pattern, which costs more than the cast, need not be tried."""
    return ((F.octet_length(value) == 10) & (F.substring(value, 5, 1) == "-") & (F.substring(value, 8, 1) == "-")
            & F.substring(value, 10, 1).between("0", "9"))


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start)


def fiscal_quarter(day: Column) -> Column:
    """Label such as ``FY2024-Q3``."""
    shifted = F.add_months(day, -FISCAL_SHIFT)
    return F.concat(F.lit("FY"), F.year(shifted).cast("string"), F.lit("-Q"), F.quarter(shifted).cast("string"))


def today_or(as_of: dt.date | None) -> Column:
    return F.current_date() if as_of is None else F.lit(as_of)


def now_or(run_ts: dt.datetime | None) -> Column:
    return F.current_timestamp() if run_ts is None else F.lit(run_ts)
