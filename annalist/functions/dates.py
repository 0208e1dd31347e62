"""Date helpers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(c: Column | str) -> Column:
    """``yyyyMMdd`` as an integer, by arithmetic so that it stays in generated code."""
    d = _col(c)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def date_text(c: Column | str) -> Column:
    return F.date_format(_col(c), "yyyy-MM-dd")


def month_start(c: Column | str) -> Column:
    return F.trunc(_col(c), "month")


def parse_date(c: Column | str) -> Column:
    """Text to date; unreadable text gives NULL also under ANSI mode."""
    return F.try_to_date(_col(c))


def parse_int(c: Column | str) -> Column:
    """Text to int; unreadable text gives NULL also under ANSI mode."""
    return _col(c).try_cast("int")
