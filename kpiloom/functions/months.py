"""Arithmetic on integer month keys of the form YYYYMM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _div(value: Column, by: int) -> Column:
    return F.call_function("div", value, F.lit(by)).cast("int")


def month_index(key: Column) -> Column:
    """Months since year 0, so that differences are month distances."""
    return _div(key, 100) * 12 + key % 100 - 1


def shift_month(key: Column, months: int | Column) -> Column:
    index = month_index(key) + months
    return (_div(index, 12) * 100 + index % 12 + 1).cast("int")


def months_between_keys(later: Column, earlier: Column) -> Column:
    return (month_index(later) - month_index(earlier)).cast("int")


def month_key(ts: Column) -> Column:
    return (F.year(ts) * 100 + F.month(ts)).cast("int")


def date_key(ts: Column) -> Column:
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)).cast("int")


def month_label(key: Column) -> Column:
    return F.format_string("%04d-%02d", _div(key, 100), key % 100)
