"""Number rules: tolerant casts, seconds per interval, billing constant."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterloom.functions.text import _col


def number(c: Column | str, kind: str = "double") -> Column:
    """Parsed number, null where the text is not one."""
    return F.trim(_col(c).cast("string")).try_cast(kind)


def seconds_per_interval(minutes: Column | str) -> Column:
    return number(minutes, "int") * F.lit(60)


def scaled_value(value: Column | str, constant: Column | str, flag: Column | str) -> Column:
    """Value times the billing constant where the unit asks for it, computed in double."""
    return F.when(
        _col(flag) == "Y", _col(value).cast("double") * _col(constant).cast("double")
    ).otherwise(_col(value).cast("double"))
