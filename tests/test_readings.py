"""Flattening, filters, units and assignments on hand-made rows."""

from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from meterloom import spec
from meterloom.functions import text
from meterloom.operators import audit, conform, dedup, enrich, flatten
from meterloom.sources import tables, xml
from meterloom.workload import queries

DOCS = [
    # two blocks, a status-only interval, a reading without a unit, a bad number
    """<MeterData MeterName=" M01 " MacID="a">
         <IntervalReadData StartTime="2026-01-01T00:00:00-05:00" IntervalLength="15" NumberIntervals="2">
           <Interval EndTime="2026-01-01T00:15:00-05:00" GatewayCollectedTime="1">
             <Reading Channel="1" RawValue="10" Value="1.5" UOM=" kWh "/>
             <Reading Channel="2" RawValue="11" Value="oops" UOM="kW"/>
             <Reading Channel="3" RawValue="12" Value="2.5"/>
           </Interval>
           <Interval EndTime="2026-01-01T00:30:00-05:00"><IntervalStatus>ERR</IntervalStatus></Interval>
         </IntervalReadData>
         <IntervalReadData StartTime="2014-01-01T00:00:00-05:00" IntervalLength="30">
           <Interval EndTime="2014-01-01T00:30:00-05:00" GatewayCollectedTime="2">
             <Reading Channel="100" Value="3.5" UOM="wh"/>
           </Interval>
         </IntervalReadData>
       </MeterData>""",
    """<MeterData MeterName="M02"/>""",
    """<MeterData MeterName="M03"><IntervalReadData IntervalLength="15">""",
]


@pytest.fixture(scope="module")
def docs(spark):
    return xml.parse_meter_xml(spark.createDataFrame([(x,) for x in DOCS], "x string"), "x")


def test_levels(docs):
    blocks = flatten.explode_blocks(docs)
    assert rows(blocks, "metername", "intervallength") == [("M01", "15"), ("M01", "30")]
    intervals = flatten.explode_intervals(blocks)
    assert intervals.count() == 3
    assert flatten.explode_readings(intervals).count() == 4


def test_required_columns(docs):
    assert rows(flatten.flatten_readings(docs), "channel", "value") == [("1", 1.5)]
    loose = flatten.flatten_readings(docs, ("channel", "value", "uom"))
    assert rows(loose, "channel", "rawvalue") == [("1", 10.0), ("100", None)]
    recent = flatten.flatten_readings(docs, ("channel", "value", "uom"), block_floor="2015-03-01")
    assert rows(recent, "channel") == [("1",)]


def test_corrupt_documents_are_counted(docs):
    assert rows(xml.corrupt_rows(docs)) == [(3, 1, 1)]


def test_document_counts_agree_with_explodes(docs):
    counts = audit.document_counts(docs, ("channel", "value", "uom")).first()
    assert tuple(counts) == (3, 3, 4, 2)


@pytest.mark.parametrize("max_rows", [1000, 0])
def test_uom_join_broadcast_and_salted(spark, max_rows):
    df = spark.createDataFrame(
        [("m", "100", "15", " WH "), ("m", "7", "15", "kvar"), ("m", "2", "30", "KW")],
        "metername string, channel string, intervallength string, uom string",
    )
    got = enrich.uom_join(df, tables.sample_uom(spark), "oh", max_rows=max_rows)
    assert rows(got, "channel", "uom", "aep_uom", "name_register", "aep_sqi", "value_mltplr_flg") == [
        ("100", "wh", "KWH", "kWh_del_15_min", "INTERVAL", "Y"),
        ("2", "kw", "KW", "kW_del_30_min", "DEMAND", "N"),
        ("7", "kvar", "UNK", "UNK", "UNK", None),
    ]


def _assignments(spark):
    fixed = {
        "co_cd_ownr": "10", "acct_clas_cd": "c", "acct_type_cd": "t", "devc_cd": "d", "pgm_id_nm": "p",
        "tx_mand_data": None, "doe_nb": "doe", "serv_deliv_id": "sd", "bill_acct_nb": "b", "mtr_pnt_nb": "1",
        "tarf_pnt_nb": None, "serv_city_ad": "city", "serv_zip_ad": "123456789", "state_cd": "OH",
    }
    periods = [
        # serial, premise, install, removal, on, off, constant
        ("A", "0000001", "2020-01-01 00:00:00", "2020-06-01 00:00:00", "2019-01-01", "9999-01-01", 2.0),
        ("A", "0000002", "2020-05-01 00:00:00.500000", "9999-01-01", "2019-01-01", "9999-01-01", 3.0),
        ("A", "0000003", "2020-01-01 00:00:00", "9999-01-01", "2021-01-01", "2021-02-01", None),
        ("B", "0000004", "garbage", "9999-01-01", "2019-01-01", "9999-01-01", 5.0),
    ]
    df = spark.createDataFrame(
        periods,
        "mfr_devc_ser_nbr string, prem_nb string, mtr_inst_ts string, mtr_rmvl_ts string, acct_turn_on_dt string, "
        "acct_turn_off_dt string, bill_cnst double",
    )
    return df.withColumns({k: F.lit(v).cast("string") for k, v in fixed.items()})


def _readings(spark):
    def at(text_):
        return int(__import__("datetime").datetime.fromisoformat(text_).timestamp())

    points = [
        ("A", "2020-01-01T00:00:00-05:00"),  # equal to the install
        ("A", "2019-12-31T23:59:59-05:00"),  # just before it
        ("A", "2020-05-15T00:00:00-04:00"),  # two assignments
        ("A", "2020-06-01T00:00:00-04:00"),  # equal to the removal: still both
        ("A", "2021-01-15T00:00:00-05:00"),  # the later one and the account-bound one
        ("B", "2020-05-15T00:00:00-04:00"),  # its bound cannot be read
        ("C", "2020-05-15T00:00:00-04:00"),  # no assignment
    ]
    return spark.createDataFrame(
        [(m, e, at(e), "1", "kwh", 1.0) for m, e in points],
        "metername string, endtime string, unix_endtime long, channel string, uom string, value double",
    )


@pytest.mark.parametrize("max_rows", [1000, 0])
def test_assignment_join(spark, max_rows):
    bounded = enrich.validity_bounds(_assignments(spark), "oh")
    got = enrich.assignment_join(_readings(spark), bounded, max_rows=max_rows)
    assert rows(got, "metername", "endtime", "aep_premise_nb") == sorted(
        [
            ("A", "2020-01-01T00:00:00-05:00", "0000001"),
            ("A", "2019-12-31T23:59:59-05:00", None),
            ("A", "2020-05-15T00:00:00-04:00", "0000001"),
            ("A", "2020-05-15T00:00:00-04:00", "0000002"),
            ("A", "2020-06-01T00:00:00-04:00", "0000001"),
            ("A", "2020-06-01T00:00:00-04:00", "0000002"),
            ("A", "2021-01-15T00:00:00-05:00", "0000002"),
            ("A", "2021-01-15T00:00:00-05:00", "0000003"),
            ("B", "2020-05-15T00:00:00-04:00", None),
            ("C", "2020-05-15T00:00:00-04:00", None),
        ],
        key=repr,
    )
    latest = enrich.assignment_join(_readings(spark), bounded, pick="latest", max_rows=max_rows)
    assert latest.columns == got.columns
    assert rows(latest.groupBy("metername", "endtime").count(), "count") == [(1,)] * 7
    assert rows(latest.filter("endtime like '2020-05-15%' and metername = 'A'"), "aep_premise_nb") == [("0000002",)]
    lost = enrich.assignment_join(_readings(spark), bounded, how="left_anti", max_rows=max_rows)
    assert lost.count() == 3


def test_hot_meter_is_spread_and_complete(spark):
    """One meter with a third of all rows: the salted join spreads it and loses nothing."""
    base = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "A").otherwise(F.concat(F.lit("m"), F.col("id"))).alias("metername"),
        F.col("id").cast("string").alias("endtime"),
        (F.lit(1590000000) + F.col("id")).alias("unix_endtime"),
        F.lit("1").alias("channel"),
        F.lit("kwh").alias("uom"),
    )
    bounded = enrich.validity_bounds(_assignments(spark), "oh")
    plain = enrich.assignment_join(base, bounded)
    salted = enrich.assignment_join(base, bounded, max_rows=0)
    assert rows(plain) == rows(salted.select(*plain.columns))


def test_company_filter_and_conflicts(spark):
    assert enrich.validity_bounds(_assignments(spark), "pso").count() == 0
    twice = tables.sample_uom(spark).withColumn("aep_raw_uom", F.lit("x"))
    both = tables.sample_uom(spark).unionByName(twice)
    assert enrich.lookup_conflicts(tables.sample_uom(spark)).count() == 0
    assert enrich.lookup_conflicts(both).count() == 10


def test_text_rules(spark):
    df = spark.createDataFrame([("a", None, "c"), ("a", "b", "c")], "a string, b string, c string")
    assert rows(df.select(text.delivery_id("a", "b", "c"))) == [("abc",), ("ac",)]
    assert rows(df.select(text.service_point("a", "b", "c"))) == [("a-b-c",), (None,)]


def test_conform_types_and_bad_numbers(spark):
    row = {c: "x" for c in spec.TRANSFORM_COLUMNS} | {"value": "1.25", "aep_raw_value": "bad", "hdp_insert_dttm": "2026-01-01 00:00:00"}
    df = spark.createDataFrame([row], spec.ddl([]) or ", ".join(f"{c} string" for c in sorted(row)))
    out = conform.conform(df)
    assert out.columns == spec.TRANSFORM_COLUMNS and len(out.columns) == 48
    assert {n: k for n, k in out.dtypes if k != "string"} == spec.NON_STRING_TYPES
    first = out.first()
    assert first["value"] == 1.25 and first["aep_raw_value"] is None
    assert len(conform.consume(df).columns) == 47
    assert len(spec.FEED_COLUMNS) == 47 and spec.FEED_COLUMNS[-1] == "run_date"
    assert len(spec.MERGE_UPDATE_COLUMNS) == 25


def test_keep_latest_is_total_and_idempotent(spark):
    df = spark.createDataFrame(
        [("k", 1, "a"), ("k", 2, "a"), ("k", 2, "b"), ("k", None, "z"), (None, 1, "n"), (None, 3, "n")],
        "k string, at int, v string",
    )
    once = dedup.keep_latest(df, ["k"], ["at"])
    assert rows(once) == [("k", 2, "b"), (None, 3, "n")]
    assert rows(dedup.keep_latest(once, ["k"], ["at"])) == rows(once)
    assert rows(dedup.keep_latest_agg(df, ["k"], ["at"])) == rows(once)
    assert rows(dedup.duplicate_count(df, ["k"])) == [(6, 2, 4)]


FAULTS = [
    """<MeterData MeterName="F1"><IntervalReadData><Interval><Reading Channel=1/></Interval></IntervalReadData></MeterData>""",
    """<MeterData MeterName="F2"><IntervalReadData><Interval><Other></Interval></Other></IntervalReadData></MeterData>""",
    """<MeterData MeterName="F3"><IntervalReadData><Interval GatewayCollectedTime="1" GatewayCollectedTime="2"/></IntervalReadData></MeterData>""",
    """<MeterData MeterName="F4"><IntervalReadData><Interval><Status>&nothing;</Status></Interval></IntervalReadData></MeterData>""",
    """<MeterData MeterName="F5"><IntervalReadData><Interval><Status>a < b</Status></Interval></IntervalReadData></MeterData>""",
    """<MeterData MeterName="F6"><IntervalReadData LpSetId="&amp;&#0;"/></MeterData>""",
    """<MeterData MeterName="F7"><IntervalReadData><!-- a -- b --></IntervalReadData></MeterData>""",
    """<MeterData MeterName="F8"><IntervalReadData/></MeterData><MeterData MeterName="F9"/>""",
    """<MeterData MeterName="F10"><IntervalReadData/></MeterData> and more""",
    "",
    None,
    # these are well formed
    """<MeterData UtilDeviceID="u"><IntervalReadData LpSetId="1"/><IntervalReadData/></MeterData>""",
    """<MeterData MeterName="G1"><IntervalReadData>text<Interval/><Interval>text<Reading/><Reading BlockEndValue="1"/></Interval></IntervalReadData></MeterData>""",
    """<m:MeterData xmlns:m="u" MeterName="G2"><m:IntervalReadData m:StartTime="s"><Interval EndTime="e" x="1"><Reading Channel=" 7 " Value="1e3" Extra="x"><Quality>3</Quality></Reading></Interval></m:IntervalReadData></m:MeterData>""",
    """<MeterData MeterName="G3"><IntervalReadData><_StartTime>s<b>t</b></_StartTime><_LpSetId><b/></_LpSetId><Interval><Reading Channel="&lt;&#65;"><![CDATA[<x>]]></Reading></Interval></IntervalReadData></MeterData>""",
]
WANTED = ["metername", "macid", "intervallength", "blockstarttime", "int_endtime", "channel", "rawvalue", "value", "uom"]


@pytest.mark.parametrize("wanted", [WANTED, ["metername", "value"], ["blockstarttime", "channel", "uom"]])
def test_part_of_the_layout_gives_the_same_readings(spark, wanted):
    texts = spark.createDataFrame([(x,) for x in DOCS + FAULTS], "x string")
    whole = xml.parse_meter_xml(texts, "x")
    part = xml.parse_meter_xml(texts, "x", layout=flatten.layout(wanted))
    assert rows(flatten.flatten_readings(part, ()), *wanted) == rows(flatten.flatten_readings(whole, ()), *wanted)
    assert set(flatten.flatten_readings(part, ()).columns) == set(wanted)
    broken = lambda df: rows(df, spec.CORRUPT_COLUMN)
    assert broken(part) == broken(whole)
    assert sum(r[0] is not None for r in broken(whole)) > 7


def test_names_alone_count_corrupt_documents_alike(spark):
    texts = spark.createDataFrame([(x,) for x in DOCS + FAULTS], "x string")
    named = xml.parse_meter_xml(texts, "x", layout=flatten.layout(["metername"]))
    whole = xml.parse_meter_xml(texts, "x")
    assert rows(named, "_MeterName", spec.CORRUPT_COLUMN) == rows(whole, "_MeterName", spec.CORRUPT_COLUMN)
    assert rows(xml.corrupt_rows(named)) == rows(xml.corrupt_rows(whole))


def test_layout_names_unknown_columns():
    readings = "Interval ARRAY<STRUCT<Reading ARRAY<STRUCT<_Channel STRING>>>>"
    assert flatten.layout(["macid", "blockendtime"]) == f"_MacID STRING, IntervalReadData ARRAY<STRUCT<_EndTime STRING, {readings}>>"
    with pytest.raises(ValueError, match="gives other"):
        flatten.layout(["metername", "other"])


@pytest.mark.parametrize("name", ["xml_from_text", "xml_corrupt_rows", "quarantine_replay"])
def test_queries_parse_what_they_use(spark, monkeypatch, tmp_path, name):
    line = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, day string"
    lines = [(k, k, k, 5 + k % 3, 1.0, 2.5, 0.1, 0.1, "R", "1998-07-01") for k in range(6)]
    made = spark.createDataFrame(lines, line).withColumn("l_shipdate", F.col("day").cast("timestamp_ntz")).drop("day")
    made.write.parquet(f"{tmp_path}/lineitem.parquet")
    layouts, parse = [], F.from_xml
    monkeypatch.setattr(F, "from_xml", lambda c, schema, o: layouts.append(schema) or parse(c, schema, o))
    assert queries.QUERIES[name](spark, str(tmp_path)).count() == (1 if name == "xml_corrupt_rows" else 6)
    assert layouts and not any("_BlockEndValue" in x or "_NumberIntervals" in x for x in layouts)
