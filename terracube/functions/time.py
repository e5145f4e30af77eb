"""Calendar helpers (F1-F3, F12, W7) as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def relative_month_year(time: Column | str, pred_month: int) -> tuple[Column, Column]:
    """month/year relative to the prediction month.

    ``t - pred_month months`` gives the month; its year + 1 is the prediction
    year, so the 11 months before ``pred_month`` and ``pred_month`` itself
    share one ``gb_year``.  For ``pred_month == 12`` the formula reduces to
    the calendar month and year.  Month-end dates clamp (Jul 31 - 5 months =
    Feb 28), the same as calendar-offset arithmetic.
    """
    t = F.col(time) if isinstance(time, str) else time
    shifted = F.add_months(t.cast("date"), -int(pred_month))
    return F.month(shifted), F.year(shifted) + 1


def with_relative_time(df, pred_month: int, time: str = "time"):
    m, y = relative_month_year(time, pred_month)
    return df.withColumns({"gb_month": m.cast("int"), "gb_year": y.cast("int")})


def trunc_ntz(unit: str, time: Column | str) -> Column:
    """``date_trunc`` kept as a zone-less timestamp.

    Spark's ``date_trunc`` returns a session-zone timestamp even for a
    ``timestamp_ntz`` input; cube times stay wall-clock (ntz) throughout.
    """
    t = F.col(time) if isinstance(time, str) else time
    return F.date_trunc(unit, t).cast("timestamp_ntz")


def parse_time(col: Column | str, fmt: str | None = None) -> Column:
    """text to a zone-less timestamp (ISO by default)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.to_timestamp_ntz(c, F.lit(fmt)) if fmt else F.to_timestamp_ntz(c)


def month_name(time: Column | str) -> Column:
    """English month name."""
    t = F.col(time) if isinstance(time, str) else time
    return F.date_format(t, "MMMM")
