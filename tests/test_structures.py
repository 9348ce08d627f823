"""Structures of feeds: merged, stored in versions, read by one scan."""

from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterloom import spec
from meterloom.session import scratch_path
from meterloom.sources import structures
from meterloom.sources.xml import VALUE_TAG


@pytest.fixture(autouse=True)
def session(spark):
    """A type's text is parsed by a session."""


def struct(ddl):
    return T.StructType.fromDDL(ddl)


@pytest.mark.parametrize(
    ("a", "b", "both"),
    [
        ("x int", "x bigint", "x bigint"),
        ("x bigint", "x double", "x double"),
        ("x int", "x boolean", "x string"),
        ("x void", "x date", "x date"),
        ("x string", "x array<string>", "x array<string>"),
        ("x struct<p:string>", "x array<struct<q:string>>", "x array<struct<p:string,q:string>>"),
        ("x string", "x struct<p:string>", f"x struct<{VALUE_TAG}:string,p:string>"),
        ("x string, y string", "z string, y string", "x string, y string, z string"),
    ],
)
def test_the_widest_type_holds_both(a, b, both):
    merged = structures.union(struct(a), struct(b))
    assert merged == struct(both)
    assert structures.union(merged, struct(a)) == structures.union(merged, struct(b)) == merged
    swapped = structures.union(struct(b), struct(a))
    assert sorted(swapped.names) == sorted(merged.names)


def test_names_that_differ_in_case_are_refused():
    with pytest.raises(ValueError, match="differ in case"):
        structures.union(struct("Unit string"), struct("unit string"))


def test_changes_are_listed_by_path():
    stored, found = struct("a string, b struct<c:string,d:string>"), struct("b array<struct<c:string,e:string>>")
    assert structures.changes(stored, found) == [
        ("/a", "absent", "string", "string"),
        ("/b", "widened", "fields", "array of fields"),
        ("/b/d", "absent", "string", "string"),
        ("/b/e", "new", None, "string"),
    ]
    assert structures.changes(stored, stored) == []


def write(spark, *texts):
    path = scratch_path(spark, "structured")
    spark.createDataFrame([(f"<MeterFeed>{''.join(texts)}</MeterFeed>",)], "value string").coalesce(1).write.text(path)
    return path


def test_feeds_are_read_as_one(spark):
    state = scratch_path(spark, "structures")
    tag = spec.ROW_TAG
    first = write(spark, f'<{tag} MeterName="007"><Note>plain</Note><Unit>k</Unit></{tag}>')
    second = write(
        spark,
        f'<{tag} MeterName="8"><Note lang="en">marked</Note><Unit>a</Unit><Unit>b</Unit><Extra>x</Extra></{tag}>',
        f'<{tag} MeterName="9"/>',
    )
    with pytest.raises(ValueError, match="no structure"):
        structures.read_registered(spark, [first], state)
    one = structures.register(spark, state, "one", structures.infer(spark, first))
    two = structures.register(spark, state, "two", structures.infer(spark, second))
    assert (one.version, two.version) == (1, 2)
    assert ("/Extra", "new", None, "string") in two.changes and ("/Unit", "widened", "string", "array of string") in two.changes
    again = structures.register(spark, state, "one", structures.infer(spark, first))
    assert again.version == 2 and ("/Extra", "absent", "string", "string") in again.changes
    assert structures.versions(spark, state).count() == 2
    assert structures.current(spark, state).schema == two.schema
    read = structures.read_registered(spark, [first, second], state)
    assert read.filter(F.col(spec.CORRUPT_COLUMN).isNotNull() & F.col("_MeterName").isNotNull()).isEmpty()
    found = rows(read, "_MeterName", f"Note.{VALUE_TAG}", "Note._lang", "Unit", "Extra")
    assert found == [("007", "plain", None, ["k"], None), ("8", "marked", "en", ["a", "b"], "x"), ("9", None, None, None, None)]


def test_a_version_that_another_run_wrote_is_refused(spark, monkeypatch):
    state = scratch_path(spark, "structures")
    structures.register(spark, state, "one", struct("a string"))
    monkeypatch.setattr(structures, "current", lambda *_: None)
    with pytest.raises(RuntimeError, match="another run"):
        structures.register(spark, state, "two", struct("b string"))
