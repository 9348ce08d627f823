"""Versions of a lookup in time."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from meterloom.operators import history
from meterloom.session import scratch_path

D1, D2, D3 = (dt.date(2024, 1, n) for n in (1, 2, 3))


def lookup(spark, *data):
    return spark.createDataFrame(list(data), "k string, unit string")


STATES = [
    (D1, [("a", "x"), ("b", "x"), (None, "n"), (None, "n")]),
    (D2, [("a", "y"), ("b", "x"), ("b", "z"), (None, "n")]),
    (D3, [("a", "x"), ("b", "z")]),
]
VERSIONS = [
    ("a", "x", D3, None),
    ("a", "x", None, D2),
    ("a", "y", D2, D3),
    ("b", "x", None, D3),
    ("b", "z", D2, None),
    (None, "n", None, D3),
]


def entered(spark, states=STATES):
    state = scratch_path(spark, "lookup")
    for day, data in states:
        history.enter(spark, state, lookup(spark, *data), day)
    return state


def test_versions_of_whole_rows(spark):
    found = history.read_versions(spark, entered(spark))
    assert rows(found) == sorted(VERSIONS, key=repr)
    for day, data in [(dt.date(2000, 1, 1), STATES[0][1]), *STATES, (dt.date(2030, 1, 1), STATES[2][1])]:
        assert rows(history.as_of(found, day)) == sorted(set(data), key=repr)


def test_a_day_entered_again(spark):
    state = entered(spark, [*STATES, STATES[2]])
    assert rows(history.read_versions(spark, state)) == sorted(VERSIONS, key=repr)
    history.enter(spark, state, lookup(spark, ("a", "x"), ("c", "w")), D3)  # corrected: b goes, c comes
    again = history.read_versions(spark, state)
    assert rows(history.as_of(again, D3)) == [("a", "x"), ("c", "w")]
    assert rows(history.as_of(again, D2)) == sorted(set(STATES[1][1]), key=repr)
    with pytest.raises(ValueError, match="lies before"):
        history.enter(spark, state, lookup(spark), D2)


def test_a_state_without_rows_closes_all(spark):
    state = entered(spark, [STATES[0]])
    found = history.enter(spark, state, lookup(spark).limit(0), D2)
    assert history.as_of(found, D2).isEmpty() and history.as_of(found, D1).count() == 3
    back = history.enter(spark, state, lookup(spark, ("a", "x")), D3)
    assert rows(history.as_of(back, D3)) == [("a", "x")] and history.as_of(back, D2).isEmpty()


def test_refused_states(spark):
    state = entered(spark, [STATES[0]])
    with pytest.raises(ValueError, match="columns are not"):
        history.enter(spark, state, lookup(spark).drop("unit"), D2)
    with pytest.raises(ValueError, match="of its own"):
        history.enter(spark, state, lookup(spark).withColumn(history.FROM, F.lit(None)), D2)
    with pytest.raises(ValueError, match="no state"):
        history.read_versions(spark, scratch_path(spark, "none"))


@pytest.mark.parametrize("bounds", [{}, {"max_rows": 0, "salts": 3}])
def test_a_late_reading_takes_the_row_of_its_day(spark, bounds):
    found = history.read_versions(spark, entered(spark))
    readings = spark.createDataFrame(
        [(1, "a", D1), (2, "a", D2), (3, "a", D3), (4, "b", D2), (5, None, D1), (6, "q", D1), (7, "a", None)], "id int, meter string, day date"
    )
    joined = history.join_as_of(readings, found, {"meter": "k"}, "day", ["id"], **bounds)
    assert rows(joined, "id", "unit") == [
        (1, "x"), (2, "y"), (3, "x"), (4, "x"), (4, "z"), (5, None), (6, None), (7, None),
    ]
