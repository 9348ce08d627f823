"""Text rules: trimmed units, slices, joined identifiers, register names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterloom import spec


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def raw_unit(c: Column | str) -> Column:
    return F.lower(F.trim(_col(c)))


def or_unknown(c: Column | str, default: str = spec.UNKNOWN) -> Column:
    return F.coalesce(_col(c), F.lit(default))


def first_chars(c: Column | str, n: int) -> Column:
    return F.substring(_col(c), 1, n)


def last_chars(c: Column | str, n: int) -> Column:
    return F.substring(_col(c), -n, n)


def meter_bucket(serial: Column | str) -> Column:
    return last_chars(F.trim(_col(serial)), 2)


def delivery_id(*parts: Column | str) -> Column:
    """All parts run together, a missing part counting as empty text."""
    return F.concat(*[F.coalesce(_col(p), F.lit("")) for p in parts])


def service_point(premise: Column | str, tariff: Column | str, meter: Column | str) -> Column:
    """``premise-tariff-meter``; null as soon as one part is missing."""
    return F.concat(_col(premise), F.lit("-"), _col(tariff), F.lit("-"), _col(meter))


def register_name(template: Column | str, length: Column | str, default: str = spec.UNKNOWN) -> Column:
    """The template with its length placeholder replaced literally."""
    filled = F.replace(_col(template), F.lit(spec.REGISTER_PLACEHOLDER), _col(length).cast("string"))
    return F.when(_col(template).isNotNull(), filled).otherwise(F.lit(default))
