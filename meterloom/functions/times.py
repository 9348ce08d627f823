"""Time rules.

Times are whole seconds: an *epoch* is an instant, a *wall* is what a clock shows, counted as if
the clock ran on UTC. Every conversion between the two names its zone and nothing reads the
session time zone, so results are the same whatever zone a cluster is configured with. The zone
functions used take a literal zone, which Spark resolves once and not per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterloom import spec
from meterloom.functions.numbers import number
from meterloom.functions.text import _col

_DAY_FORM = r"^\d{4}-\d{2}-\d{2}$"
_WALL_FORM = r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}:\d{2}(\.\d{1,6})?)?$"
_STATED_FORM = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})$"
_SECONDS_FORM = "____-__-__T__:__:__"
_TWELVE_HOUR_FORM = r"^(\d{2})(\d{2})(\d{4})(\d{2})(\d{2})(\d{2})([AaPp])[Mm]$"


def _origin() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def wall_of(clock: Column | str) -> Column:
    """Wall seconds of a TIMESTAMP_NTZ."""
    return (_col(clock) - _origin()).cast("interval second").cast("long")


def clock_of(wall: Column | str) -> Column:
    """TIMESTAMP_NTZ of wall seconds."""
    return F.timestamp_add("SECOND", _col(wall), _origin())


def to_zone(epoch: Column | str, zone: str) -> Column:
    """Wall seconds in ``zone`` at an instant."""
    return F.unix_seconds(F.from_utc_timestamp(F.timestamp_seconds(_col(epoch)), zone))


def from_zone(wall: Column | str, zone: str) -> Column:
    """Instant at which clocks in ``zone`` show ``wall``. A time that the clocks skip counts
    with the offset before the change, a time they show twice means the first of the two."""
    return F.unix_seconds(F.to_utc_timestamp(F.timestamp_seconds(_col(wall)), zone))


def zone_convert(wall: Column | str, source: str, target: str) -> Column:
    """Wall seconds in ``target`` when clocks in ``source`` show ``wall``."""
    return to_zone(from_zone(wall, source), target)


def wall_seconds(text: Column | str) -> Column:
    """Wall seconds from ``yyyy-MM-dd`` or ``yyyy-MM-dd HH:mm:ss[.SSSSSS]``, else null."""
    t = F.trim(_col(text))
    return F.when(t.rlike(_WALL_FORM), wall_of(t.try_cast("timestamp_ntz")))


def end_wall(text: Column | str) -> Column:
    """Wall seconds of ``yyyy-MM-ddTHH:mm:ss``, null for any other text."""
    c = _col(text)
    parsed = F.unix_seconds(F.concat(c, F.lit("Z")).try_cast("timestamp"))
    return F.when(c.like(_SECONDS_FORM), parsed)


def wall_text(wall: Column | str) -> Column:
    """``yyyy-MM-ddTHH:mm:ss`` of wall seconds."""
    return F.replace(clock_of(wall).cast("string"), F.lit(" "), F.lit("T"))


def offset_text(offset: Column | str) -> Column:
    """``+HH:MM`` of an offset in seconds."""
    size = F.substring(clock_of(F.abs(_col(offset))).cast("string"), 12, 5)
    return F.concat(F.when(_col(offset) < 0, F.lit("-")).otherwise(F.lit("+")), size)


def stated_offset(text: Column | str) -> Column:
    """The offset after the first 19 characters of a time text, ``Z`` written as ``+00:00``;
    null if there is none."""
    tail = F.substring(F.trim(_col(text)), 20, 40)
    return F.when(tail.like("%Z"), F.lit("+00:00")).when(
        tail.like("%+__:__") | tail.like("%-__:__"), F.substring(tail, -6, 6)
    )


def end_epoch(text: Column | str, zone: str = spec.DEFAULT_ZONE) -> Column:
    """Epoch seconds of an end time: by its own offset, or in ``zone`` if it has none."""
    c = F.trim(_col(text))
    return F.when(c.rlike(_STATED_FORM), F.unix_seconds(c.try_cast("timestamp"))).otherwise(
        from_zone(end_wall(c), zone)
    )


def day_of(text: Column | str) -> Column:
    """The date in the first ten characters, null where they are no date."""
    head = F.substring(_col(text), 1, 10)
    return F.when(head.rlike(_DAY_FORM), head.try_cast("date"))


def first_interval_wall(text: Column | str) -> Column:
    """Wall seconds from ``MMddyyyyhhmmssa`` (12-hour clock) or the ISO-like default form."""
    t = F.trim(_col(text))
    part = [number(F.regexp_extract(t, _TWELVE_HOUR_FORM, i), "int") for i in range(7)]
    afternoon = F.upper(F.regexp_extract(t, _TWELVE_HOUR_FORM, 7)) == "P"
    hour = part[4] % 12 + F.when(afternoon, F.lit(12)).otherwise(F.lit(0))
    clock = F.try_make_timestamp_ntz(
        part[3],
        part[1],
        part[2],
        F.when(part[4].between(1, 12), hour),
        part[5],
        part[6].cast("decimal(16,6)"),
    )
    return F.when(t.rlike(_TWELVE_HOUR_FORM), wall_of(clock)).otherwise(wall_seconds(t))


def run_stamp_day_name(stamp: Column | str) -> Column:
    """Weekday name of a ``yyyyMMdd_HHmmss`` stamp, null where it is no such stamp."""
    s = _col(stamp)
    iso = F.concat_ws("-", F.substring(s, 1, 4), F.substring(s, 5, 2), F.substring(s, 7, 2))
    day = F.when(s.rlike(r"^\d{8}_\d{6}$"), iso.try_cast("date"))
    return F.date_format(day, "EEEE")
