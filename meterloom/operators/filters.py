"""Row filters, written so that their literal part can be pushed into the scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterloom import spec
from meterloom.functions.times import day_of


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which none of ``columns`` is null."""
    return df.dropna(subset=list(columns))


def date_floor(df: DataFrame, column: str, floor: str = spec.DATE_FLOOR, inclusive: bool = True) -> DataFrame:
    """Rows whose day is on or after ``floor`` (after it, if not ``inclusive``).

    Text columns hold ISO times. The plain comparison of the text is implied by the exact one
    on the parsed day; it is added because a Parquet scan can skip row groups with it.
    """
    c = F.col(column)
    day = F.lit(floor).cast("date")
    if isinstance(df.schema[column].dataType, T.StringType):
        exact = day_of(c) >= day if inclusive else day_of(c) > day
        coarse = c >= floor if inclusive else c > floor
        return df.filter(coarse & exact)
    first = day if inclusive else F.date_add(day, 1)
    return df.filter(c >= first.cast(df.schema[column].dataType))


def company_filter(df: DataFrame, opco: str, column: str = "co_cd_ownr") -> DataFrame:
    """Rows owned by the companies that belong to one operating unit."""
    return df.filter(F.col(column).isin(spec.COMPANY_CODES[opco]))


def by_operating_unit(df: DataFrame, column: str = "co_cd_ownr", name: str = "opco") -> DataFrame:
    """Rows of all operating units in one pass: each row once for every unit its company belongs
    to, with that unit as ``name``. Rows of other companies are left out."""
    units: dict[str, list[str]] = {}
    for unit, companies in spec.COMPANY_CODES.items():
        for company in companies:
            units.setdefault(company, []).append(unit)
    listed = F.create_map(*[x for c, u in units.items() for x in (F.lit(c), F.array(*map(F.lit, u)))])
    return df.filter(F.col(column).isin(list(units))).withColumn(name, F.explode(F.element_at(listed, F.col(column))))


def batch_window(df: DataFrame, ts_col: str, start=None, end=None, control: DataFrame | None = None) -> DataFrame:
    """Rows with ``start <= ts < end``.

    Without ``start`` the last processed time in ``control`` (its newest ``last_processed``)
    is used. That is the only value brought to the driver; as a literal it reaches the scan.
    """
    if start is None:
        if control is None:
            raise ValueError("give a start or a control table")
        start = control.agg(F.max("last_processed").alias("m")).first()["m"]
        if start is None:
            raise ValueError("the control table holds no last processed time")
    kind = df.schema[ts_col].dataType
    kept = df.filter(F.col(ts_col) >= F.lit(start).cast(kind))
    return kept if end is None else kept.filter(F.col(ts_col) < F.lit(end).cast(kind))


def read_back(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Rows in the listed partitions; no values, no rows."""
    return df.filter(F.col(column).isin(list(values))) if values else df.limit(0)
