"""Column expressions shared by the operators (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ntz(ts: str) -> Column:
    """A ``timestamp_ntz`` literal (load stamps are wall-clock values, no zone)."""
    return F.lit(ts).cast("timestamp_ntz")


def null_ts() -> Column:
    return F.lit(None).cast("timestamp_ntz")


def days_after(ts: Column | str, days: Column | int) -> Column:
    """``ts + days * interval 1 day`` on a timestamp_ntz."""
    return F.timestamp_add("DAY", days if isinstance(days, Column) else F.lit(days), F.col(ts) if isinstance(ts, str) else ts)


def money(c: Column | str, precision: int = 12) -> Column:
    """Money as an exact decimal (the reference declares float; float sums drift)."""
    return (F.col(c) if isinstance(c, str) else c).cast(f"decimal({precision},2)")


def as_double(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def ratio(num: Column, den: Column) -> Column:
    """``num / den`` as double, NULL when ``den`` is 0 (ANSI mode raises on / 0)."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def mean(c: Column | str) -> Column:
    """Average as sum / count in double: exact decimal sum first, one rounding at the end."""
    col = F.col(c) if isinstance(c, str) else c
    return ratio(F.sum(col), F.count(col))


def month_start(d: Column | str) -> Column:
    """``date_trunc('month', d)`` as a date (Spark's date_trunc returns a timestamp)."""
    return F.trunc(F.col(d) if isinstance(d, str) else d, "month")
