"""The library's input shapes, derived from the given tables.

Every shape is made row by row or by aggregates that combine before the shuffle; none gathers
a group. Times are moved 20 years ahead so that the date floors fall inside the data.

Meter documents and wide records can be landed: Spark writes them once per session and table
folder as Parquet into the shared scratch folder, and what reads them more than once scans those
files, as it would scan a feed that has arrived. What reads documents once takes them as they are
made (``arriving``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom import spec
from meterloom.functions import times as t
from meterloom.session import scratch_path
from meterloom.sources import tables

ZONE = spec.DEFAULT_ZONE
WIDE_ZONE = "America/Chicago"
N_PAIRS = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tables.read_parquet(spark, f"{sf_dir}/{name}.parquet")


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp_ntz"))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz"))


def serial(key: str) -> Column:
    return F.concat(F.lit("MTR"), F.lpad(F.col(key).cast("string"), 8, "0"))


def channel() -> Column:
    line = F.col("l_linenumber")
    return F.when(line == 6, "100").when(line == 7, "999").otherwise(line.cast("string"))


def _local_text(epoch: str) -> Column:
    wall = t.to_zone(epoch, ZONE)
    return F.concat(t.wall_text(wall), t.offset_text(wall - F.col(epoch)))


def feed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reading per lineitem row, as texts. Ends fall on 06:00 UTC of the first of a month;
    two of those are minutes after the clocks went back. Readings of one supplier, month,
    channel and unit are versions of each other. The texts of times are made once for each ship
    day, of which there are few, and broadcast."""
    lines = lineitem(spark, sf_dir)
    shifted = F.add_months(F.col("day"), 12 * 20)
    end_day = F.date_add(F.last_day(shifted), 1)
    days = (
        lines.select(F.col("l_shipdate").cast("date").alias("day"))
        .distinct()
        .withColumn("end", (F.unix_date(end_day).cast("long") * 24 + 6) * 3600)
        .withColumn("block_start", F.col("end") - 86400)
        .select(
            "*",
            _local_text("end").alias("end_text"),
            _local_text("block_start").alias("block_start_text"),
            F.concat(shifted.cast("string"), F.lit("T00:00:00Z")).alias("collected_text"),
        )
    )
    by_length = F.col("l_linenumber") % 3
    dated = _spread(lines).join(F.broadcast(days), F.col("l_shipdate").cast("date") == F.col("day"), "left").drop("day")
    return dated.select(
        "*",
        serial("l_suppkey").alias("serial"),
        channel().alias("channel"),
        F.when(by_length == 0, "15").when(by_length == 1, "30").otherwise("60").alias("length"),
        F.when(F.col("l_tax") != 0, F.col("l_quantity").cast("string")).alias("raw_text"),
        F.when(F.col("l_discount") == 0, "n/a").otherwise(F.col("l_extendedprice").cast("string")).alias("value_text"),
    )


_LANDED: dict[tuple[str, str, str], str] = {}


def _spread(df: DataFrame) -> DataFrame:
    """Rows over all cores where the scan has fewer splits than there are cores; a scan of a
    large table has more and is left alone."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def _land(spark: SparkSession, sf_dir: str, name: str, make) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _LANDED:
        path = scratch_path(spark, f"landed-{name}")
        make(spark, sf_dir).write.parquet(path)
        _LANDED[key] = path
    return spark.read.parquet(_LANDED[key])


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _land(spark, sf_dir, "documents", make_documents)


def arriving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same documents, for a flow that reads them once: handed on as they are made. They pass a
    generator, so that the optimizer does not copy their making into later filters."""
    made = make_documents(spark, sf_dir)
    return made.select(F.inline(F.array(F.struct(*made.columns))))


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _land(spark, sf_dir, "wide", wide_rows)


def make_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One meter document per lineitem row: a block with a full interval and one that carries
    only a status, and for even line numbers a second block without intervals. The full
    interval has the reading and an incomplete one."""
    text = F.lit(None).cast("string")

    def reading(unit: Column, value: Column, raw: Column) -> Column:
        return F.struct(
            unit.alias("_UOM"),
            text.alias("_BlockEndValue"),
            value.alias("_Value"),
            raw.alias("_RawValue"),
            F.col("channel").alias("_Channel"),
        )

    def interval(number: int, readings: Column) -> Column:
        return F.struct(
            F.col("collected_text").alias("_GatewayCollectedTime"),
            F.lit(str(number)).alias("_IntervalSequenceNumber"),
            F.lit("1").alias("_BlockSequenceNumber"),
            F.col("end_text").alias("_EndTime"),
            readings.alias("Reading"),
        )

    def block(label: str, intervals: Column) -> Column:
        return F.struct(
            F.lit(label).alias("_LpSetId"),
            F.lit("2").alias("_NumberIntervals"),
            F.col("end_text").alias("_EndTime"),
            F.col("block_start_text").alias("_StartTime"),
            F.col("length").alias("_IntervalLength"),
            intervals.alias("Interval"),
        )

    unit = F.concat(F.lit(" "), "l_returnflag", F.lit(" "))
    readings = F.array(
        reading(unit, F.col("value_text"), F.col("raw_text")), reading(text, F.lit("0"), F.lit("0"))
    )
    no_readings = F.lit(None).cast(f"array<{_reading_type()}>")
    full = block("1", F.array(interval(1, readings), interval(2, no_readings)))
    empty = block("2", F.lit(None).cast(f"array<{_interval_type()}>"))
    return feed_rows(spark, sf_dir).select(
        F.concat(F.lit("  "), "serial", F.lit(" ")).alias("_MeterName"),
        F.concat(F.lit("U"), "l_partkey").alias("_UtilDeviceID"),
        F.concat(F.lit("M"), "l_orderkey").alias("_MacID"),
        F.concat(F.lit("SP"), "l_suppkey").alias("_UtilServicePointID"),
        F.when(F.col("l_linenumber") % 2 == 0, F.array(full, empty))
        .otherwise(F.array(full))
        .alias("IntervalReadData"),
    )


def _reading_type() -> str:
    names = ("_UOM", "_BlockEndValue", "_Value", "_RawValue", "_Channel")
    return "struct<" + ",".join(f"{n}:string" for n in names) + ">"


def _interval_type() -> str:
    names = ("_GatewayCollectedTime", "_IntervalSequenceNumber", "_BlockSequenceNumber", "_EndTime")
    return "struct<" + ",".join(f"{n}:string" for n in names) + f",Reading:array<{_reading_type()}>>"


def document_texts(spark: SparkSession, sf_dir: str, cut_last: bool = False) -> DataFrame:
    """The main reading of each lineitem row as an XML text; with ``cut_last`` the texts of line
    number 7 lack their end tag."""

    def attribute(name: str, value: Column) -> Column:
        return F.concat(F.lit(f' {name}="'), value, F.lit('"'))

    reading = F.concat(
        F.lit("<Reading"),
        attribute("Channel", F.col("channel")),
        F.coalesce(attribute("RawValue", F.col("raw_text")), F.lit("")),
        attribute("Value", F.col("value_text")),
        attribute("UOM", F.col("l_returnflag")),
        F.lit("/>"),
    )
    document = F.concat(
        F.lit("<MeterData"),
        attribute("MeterName", F.col("serial")),
        attribute("MacID", F.concat(F.lit("M"), "l_orderkey")),
        F.lit("><IntervalReadData"),
        attribute("IntervalLength", F.col("length")),
        attribute("StartTime", F.col("block_start_text")),
        F.lit("><Interval"),
        attribute("EndTime", F.col("end_text")),
        attribute("GatewayCollectedTime", F.col("collected_text")),
        F.lit(">"),
        reading,
        F.lit("</Interval></IntervalReadData>"),
    )
    end = F.when((F.col("l_linenumber") == 7) & F.lit(cut_last), "").otherwise("</MeterData>")
    return feed_rows(spark, sf_dir).select("l_linenumber", F.concat(document, end).alias("xml"))


def assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two assignments per supplier; every fourth pair overlaps, the others leave a gap."""
    k = F.col("s_suppkey")
    first = F.date_add(F.lit("2015-01-01").cast("date"), (k * 37 % 700).cast("int"))
    second = F.date_add(F.col("first"), F.when(k % 4 == 0, 870).otherwise(915))

    def day(c: Column) -> Column:
        return c.cast("string")

    def row(install: Column, removal: Column) -> Column:
        clock = F.when(k % 2 == 0, " 00:00:00").otherwise(" 00:00:00.250000")
        return F.struct(
            F.concat(day(install), clock).alias("mtr_inst_ts"),
            removal.alias("mtr_rmvl_ts"),
            day(F.date_sub(install, 10)).alias("acct_turn_on_dt"),
            F.when(k % 7 == 0, day(F.date_add(install, 400)))
            .otherwise(spec.OPEN_ENDED)
            .alias("acct_turn_off_dt"),
        )

    removed = F.when(k % 17 == 0, "unknown").otherwise(
        F.concat(day(F.date_add(F.col("first"), 900)), F.lit(" 00:00:00"))
    )
    both = F.array(row(F.col("first"), removed), row(F.col("second"), F.lit(spec.OPEN_ENDED)))
    company = F.element_at(
        F.array(*[F.lit(c) for c in ("10", "07", "95", "04", "01")]), (F.col("s_nationkey") % 5 + 1).cast("int")
    )
    point = F.when(k % 13 != 0, (k % 3).cast("string"))
    text = k.cast("string")
    return (
        table(spark, sf_dir, "supplier")
        .withColumn("first", first)
        .withColumn("second", second)
        .select(
            company.alias("co_cd_ownr"),
            F.lpad(text, 9, "0").alias("prem_nb"),
            F.when(k % 11 != 0, 1 + (k % 5) * 0.5).cast("double").alias("bill_cnst"),
            F.concat(F.lit("C"), (k % 3).cast("string")).alias("acct_clas_cd"),
            F.concat(F.lit("T"), (k % 2).cast("string")).alias("acct_type_cd"),
            F.concat(F.lit("D"), (k % 6).cast("string")).alias("devc_cd"),
            F.concat(F.lit("P"), (k % 4).cast("string")).alias("pgm_id_nm"),
            F.when(k % 2 == 0, F.lit("tx")).alias("tx_mand_data"),
            F.when(k % 3 == 0, F.concat(F.lit("doe"), text)).alias("doe_nb"),
            F.when(k % 5 != 0, F.concat(F.lit("sd"), text)).alias("serv_deliv_id"),
            serial("s_suppkey").alias("mfr_devc_ser_nbr"),
            F.concat(F.lit("B"), text).alias("bill_acct_nb"),
            point.alias("mtr_pnt_nb"),
            point.alias("tarf_pnt_nb"),
            F.concat(F.lit("City"), (k % 9).cast("string")).alias("serv_city_ad"),
            F.lpad((k * 97).cast("string"), 9, "0").alias("serv_zip_ad"),
            F.lit("OH").alias("state_cd"),
            F.explode(both).alias("a"),
        )
        .select("*", "a.*")
        .drop("a")
    )


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitem with its natural versions of (order, line); ship date as text."""
    return lineitem(spark, sf_dir).withColumn("l_shipdate", F.col("l_shipdate").cast("string"))


MERGE_LINE_KEYS = ["l_orderkey", "l_linenumber", "l_shipdate"]


def merge_input(spark: SparkSession, sf_dir: str, side: str) -> DataFrame:
    """Rows to merge, with a month to partition by. Target: before 1999. Source: from
    mid 1998 on, values up by a tenth. In both, part 0 of every 50 lacks its line number. The
    days are compared as times, so only rows that are kept have their text made."""
    day = F.col("l_shipdate")
    rows = lineitem(spark, sf_dir)
    if side == "target":
        rows = rows.filter(day < F.lit("1999-01-01").cast("timestamp_ntz"))
        value, user = F.col("l_extendedprice"), "loaded"
    else:
        rows = rows.filter(day >= F.lit("1998-07-01").cast("timestamp_ntz"))
        value, user = F.col("l_extendedprice") * 1.1, "incoming"
    return rows.withColumn("l_shipdate", day.cast("string")).select(
        "l_orderkey",
        F.when(F.col("l_partkey") % 50 != 0, F.col("l_linenumber")).alias("l_linenumber"),
        "l_shipdate",
        F.substring(day, 1, 7).alias("ship_month"),
        "l_partkey",
        "l_suppkey",
        value.alias("value"),
        F.when(F.lit(side == "target"), F.col("l_returnflag")).otherwise(F.lower("l_returnflag")).alias("flag"),
        F.lit(user).alias("hdp_update_user"),
    )


def held_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as stage rows: the order day is the usage day."""
    day = F.substring(F.col("o_orderdate").cast("string"), 1, 10)
    return orders(spark, sf_dir).select(
        serial("o_custkey").alias("serialnumber"),
        F.concat(F.substring(day, 1, 7), F.lit("-01T00:00:00Z")).alias("endtimeperiod"),
        F.substring("o_orderpriority", 1, 1).alias("aep_channel_id"),
        F.lower("o_orderstatus").alias("aep_raw_uom"),
        F.concat(day, F.lit("T00:00:00Z")).alias("int_gatewaycollectedtime"),
        F.col("o_totalprice").alias("value"),
        F.col("o_orderkey").alias("source_id"),
        F.element_at(
            F.array(*[F.lit(o) for o in ("oh", "im", "swp", "pso", "ap")]), (F.col("o_custkey") % 5 + 1).cast("int")
        ).alias("aep_opco"),
        day.alias("aep_usage_dt"),
    )


def wide_rows(spark: SparkSession, sf_dir: str, n_pairs: int = N_PAIRS) -> DataFrame:
    """One wide record per order: line numbers 1 to 7 are the pairs, lines an order lacks are
    gaps. The first time is in the 12-hour form for even orders and ISO for odd ones."""
    line = F.col("l_linenumber")
    prices = [
        F.max(F.when(line == i, F.col("l_extendedprice"))).cast("string").alias(f"v{i}") for i in range(1, 8)
    ]
    k = F.col("l_orderkey")
    first = F.col("first") + F.expr("INTERVAL '20' YEAR") + F.make_dt_interval(hours=(4 + k % 20).cast("int"))
    iso = F.col("first_text")
    hour = F.substring(iso, 12, 2).cast("int")
    twelve = F.concat(
        F.substring(iso, 6, 2),
        F.substring(iso, 9, 2),
        F.substring(iso, 1, 4),
        F.lpad(((hour + 11) % 12 + 1).cast("string"), 2, "0"),
        F.substring(iso, 15, 2),
        F.substring(iso, 18, 2),
        F.when(hour < 12, "AM").otherwise("PM"),
    )
    base = {
        "record_type": F.lit("MEPMD01"),
        "record_version": F.lit("1"),
        "timestamp": F.lit(None).cast("string"),
        "premise_id": F.lpad(k.cast("string"), 9, "0"),
        "esiid": F.concat(F.lit("E"), k.cast("string")),
        "provisioned": F.lit("Y"),
        "meter_id": F.concat(F.lit("LG"), F.lpad(k.cast("string"), 9, "0")),
        "purpose": F.element_at(F.array(*[F.lit(c) for c in ("1", "2", "100", "999")]), (k % 4 + 1).cast("int")),
        "commodity": F.lit("E"),
        "units": F.when(k % 2 == 0, " KWH").otherwise("kW"),
        "calculation_constant": F.lit("1"),
        "cinterval": F.when(k % 3 == 0, "900").otherwise("1800"),
        "count": F.lit(str(n_pairs)),
        "firstintervaldatetime": F.when(k % 2 == 0, twelve).otherwise(iso),
    }
    nothing = F.lit(None).cast("string")
    pairs = []
    for i in range(1, n_pairs + 1):
        value = F.col(f"v{i}") if i < 8 else nothing
        pairs += [F.when(value.isNotNull(), f"q{i}").alias(f"t{i}"), value.alias(f"v{i}")]
    return (
        lineitem(spark, sf_dir)
        .groupBy("l_orderkey")
        .agg(F.min("l_shipdate").alias("first"), *prices)
        .withColumn("first_text", F.substring(first.cast("string"), 1, 19))
        .select(*[base[c].alias(c) for c in spec.WIDE_BASE_COLUMNS], *pairs)
    )


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a file listing: the user is the folder, a sign-up its marker file, any other
    event a file whose size is the event's value."""
    name = F.when(F.col("event_type") == "signup", spec.MARKER_FILE).otherwise(
        F.concat("event_type", F.lit("-"), F.col("event_id").cast("string"), F.lit(".xml.gz"))
    )
    directory = F.concat(F.lit("u"), F.col("user_id").cast("string"))
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("/feed/in/"), directory, F.lit("/"), name).alias("path"),
        F.col("ts").cast("timestamp_ntz").alias("modificationTime"),
        F.floor("value").cast("long").alias("length"),
    )
