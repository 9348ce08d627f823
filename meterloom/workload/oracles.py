"""DuckDB SQL that computes each query's result on its own, straight from the given tables.

The statements share common table expressions; ``_sql`` puts the needed ones in front.
"""

from __future__ import annotations

from meterloom import spec
from meterloom.workload import queries as q
from meterloom.workload import shapes

ZONE, WIDE_ZONE = shapes.ZONE, shapes.WIDE_ZONE


def _offset(local: str, utc: str) -> str:
    hours = f"date_diff('hour', {local}, {utc})"
    return f"printf('-%02d:00', {hours})"


def _text(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%dT%H:%M:%S')"


def _local(utc: str, zone: str = ZONE) -> str:
    return f"timezone('{zone}', timezone('UTC', {utc}))"


_UOM_ROWS = ", ".join(
    "(" + ", ".join(f"'{v}'" for v in line.split()) + ")" for line in spec.UOM_SAMPLE.strip().splitlines()
)

_CHANNEL = "CASE l_linenumber WHEN 6 THEN '100' WHEN 7 THEN '999' ELSE l_linenumber::VARCHAR END"

CTES = {
    "uom": f"SELECT * FROM (VALUES {_UOM_ROWS}) AS u({', '.join(spec.UOM_COLUMNS)})",
    # One row per lineitem: the feed's main reading with its instants.
    "feed0": f"""
        SELECT l.*, 'MTR' || lpad(l_suppkey::VARCHAR, 8, '0') AS serial, {_CHANNEL} AS channel,
          CASE l_linenumber % 3 WHEN 0 THEN 15 WHEN 1 THEN 30 ELSE 60 END AS len,
          date_trunc('month', l_shipdate) + INTERVAL 20 YEAR + INTERVAL 1 MONTH + INTERVAL 6 HOUR AS end_utc,
          strftime(l_shipdate + INTERVAL 20 YEAR, '%Y-%m-%dT00:00:00Z') AS collected,
          CASE WHEN l_tax <> 0 THEN l_quantity END AS rawvalue,
          CASE WHEN l_discount <> 0 THEN l_extendedprice END AS val
        FROM lineitem l""",
    "feed1": f"""
        SELECT *, end_utc - to_minutes(len) AS start_utc, end_utc - INTERVAL 1 DAY AS block_utc,
          {_local("end_utc")} AS end_local,
          {_local("end_utc - to_minutes(len)")} AS start_local,
          {_local("end_utc - INTERVAL 1 DAY")} AS block_local
        FROM feed0""",
    "feed": f"""
        SELECT *, {_text("end_local")} || {_offset("end_local", "end_utc")} AS end_text,
          {_text("start_local")} || {_offset("start_local", "start_utc")} AS start_text,
          {_text("block_local")} || {_offset("block_local", "block_utc")} AS block_text,
          {_offset("end_local", "end_utc")} AS end_offset, epoch(end_utc)::BIGINT AS end_epoch
        FROM feed1""",
    # Two assignments per supplier, bounds as instants.
    "assign0": """
        SELECT s.*, s_suppkey AS k, DATE '2015-01-01' + (s_suppkey * 37 % 700)::INTEGER AS i1 FROM supplier s""",
    "assign1": """
        SELECT *, i1 AS inst, (i1 + 900) AS rmvl, FALSE AS is_open FROM assign0
        UNION ALL
        SELECT *, i1 + CASE WHEN k % 4 = 0 THEN 870 ELSE 915 END AS inst, DATE '9999-01-01' AS rmvl, TRUE AS is_open
        FROM assign0""",
    "assign": f"""
        SELECT *, 'MTR' || lpad(k::VARCHAR, 8, '0') AS a_serial,
          ['10', '07', '95', '04', '01'][(s_nationkey % 5) + 1] AS co,
          strftime(inst, '%Y-%m-%d') || CASE WHEN k % 2 = 0 THEN ' 00:00:00' ELSE ' 00:00:00.250000' END AS inst_text,
          CASE WHEN is_open THEN '9999-01-01' WHEN k % 17 = 0 THEN 'unknown'
            ELSE strftime(rmvl, '%Y-%m-%d') || ' 00:00:00' END AS rmvl_text,
          timezone('{ZONE}', inst::TIMESTAMP) AS lo1,
          CASE WHEN is_open OR k % 17 <> 0 THEN timezone('{ZONE}', rmvl::TIMESTAMP) END AS hi1,
          timezone('{ZONE}', (inst - 10)::TIMESTAMP) AS lo2,
          timezone('{ZONE}', (CASE WHEN k % 7 = 0 THEN inst + 400 ELSE DATE '9999-01-01' END)::TIMESTAMP) AS hi2,
          lpad(k::VARCHAR, 9, '0') AS premise,
          CASE WHEN k % 11 <> 0 THEN 1 + (k % 5) * 0.5::DOUBLE END AS bill,
          CASE WHEN k % 2 = 0 THEN 'tx' ELSE '' END || CASE WHEN k % 3 = 0 THEN 'doe' || k ELSE '' END
            || CASE WHEN k % 5 <> 0 THEN 'sd' || k ELSE '' END AS sd,
          CASE WHEN k % 13 <> 0 THEN (k % 3)::VARCHAR END AS point,
          'City' || (k % 9) AS city, lpad((k * 97)::VARCHAR, 9, '0') AS zip
        FROM assign1""",
    "owned": "SELECT * FROM assign WHERE co IN ('10', '07')",
    "source": f"""
        SELECT f.serial AS metername, 'U' || l_partkey AS utildeviceid, 'M' || l_orderkey AS macid,
          len::VARCHAR AS intervallength, block_text AS blockstarttime, end_text AS blockendtime,
          '2' AS numberintervals, start_text AS starttime, end_text AS endtime, end_offset AS interval_epoch,
          collected AS int_gatewaycollectedtime, '1' AS int_blocksequencenumber, '1' AS int_intervalsequencenumber,
          channel, rawvalue, val AS value, lower(l_returnflag) AS uom,
          coalesce(u.aep_derived_uom, '{spec.UNKNOWN}') AS aep_uom,
          coalesce(replace(u.name_register, 'mtr_ivl_len', len::VARCHAR), '{spec.UNKNOWN}') AS name_register,
          coalesce(u.aep_srvc_qlty_idntfr, '{spec.UNKNOWN}') AS aep_sqi, u.value_mltplr_flg, end_utc, end_epoch
        FROM feed f LEFT JOIN uom u ON f.channel = u.aep_channel_id
        WHERE rawvalue IS NOT NULL AND val IS NOT NULL AND start_local >= TIMESTAMP '{spec.DATE_FLOOR}'""",
    "latest": """
        SELECT * FROM source QUALIFY row_number() OVER (PARTITION BY metername, endtime, channel, uom
          ORDER BY int_gatewaycollectedtime DESC, utildeviceid DESC, macid DESC, rawvalue DESC, value DESC) = 1""",
    "unit_rows": """
        SELECT f.*, u.aep_channel_id AS listed FROM feed f LEFT JOIN uom u ON f.channel = u.aep_channel_id""",
    "versions": """
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
          l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate FROM lineitem""",
    "versions_latest": """
        SELECT * FROM versions QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
          ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
            l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) = 1""",
    "merge_rows": """
        SELECT l_orderkey, CASE WHEN l_partkey % 50 <> 0 THEN l_linenumber END AS l_linenumber,
          strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_returnflag,
          l_shipdate AS ts FROM lineitem""",
    "tgt": """
        SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice AS value,
          l_returnflag AS flag, 'loaded' AS hdp_update_user FROM merge_rows WHERE ts < TIMESTAMP '1999-01-01'""",
    "src": """
        SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice * 1.1::DOUBLE AS value,
          lower(l_returnflag) AS flag FROM merge_rows
        WHERE ts >= TIMESTAMP '1998-07-01'
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_shipdate
          ORDER BY l_partkey DESC, l_suppkey DESC, value DESC, flag DESC) = 1""",
    "held_stage": f"""
        SELECT 'MTR' || lpad(o_custkey::VARCHAR, 8, '0') AS serialnumber,
          strftime(o_orderdate, '%Y-%m-01T00:00:00Z') AS endtimeperiod,
          substr(o_orderpriority, 1, 1) AS aep_channel_id, lower(o_orderstatus) AS aep_raw_uom,
          strftime(o_orderdate, '%Y-%m-%dT00:00:00Z') AS int_gatewaycollectedtime, o_totalprice AS value,
          o_orderkey AS source_id, ['oh', 'im', 'swp', 'pso', 'ap'][(o_custkey % 5) + 1] AS aep_opco,
          strftime(o_orderdate, '%Y-%m-%d') AS aep_usage_dt
        FROM orders""",
    "held": """
        SELECT *, '20010725' AS run_dt FROM held_stage
        WHERE aep_usage_dt >= strftime(DATE '2001-07-25' - 185, '%Y-%m-%d')
          AND aep_usage_dt < strftime(DATE '2001-07-25' - 15, '%Y-%m-%d')
        UNION ALL
        SELECT *, '20010801' AS run_dt FROM held_stage
        WHERE aep_usage_dt >= strftime(DATE '2001-08-01' - 185, '%Y-%m-%d')
          AND aep_usage_dt < strftime(DATE '2001-08-01' - 15, '%Y-%m-%d')""",
    "wide0": """
        SELECT l_orderkey AS k, min(l_shipdate) + INTERVAL 20 YEAR + to_hours(4 + l_orderkey % 20) AS first_local
        FROM lineitem GROUP BY l_orderkey""",
    "wide_long": f"""
        SELECT k, line AS position, price,
          CASE WHEN k % 3 = 0 THEN 900 ELSE 1800 END AS secs,
          timezone('{ZONE}', first_local) AT TIME ZONE 'UTC' + to_seconds(
            (line - 1) * CASE WHEN k % 3 = 0 THEN 900 ELSE 1800 END) AS s_utc
        FROM wide0 JOIN (SELECT l_orderkey, l_linenumber AS line, max(l_extendedprice) AS price
          FROM lineitem GROUP BY ALL) p ON p.l_orderkey = k""",
    "wide_times": f"""
        SELECT *, s_utc + to_seconds(secs) AS e_utc, {_local("s_utc", WIDE_ZONE)} AS s_local,
          {_local("s_utc + to_seconds(secs)", WIDE_ZONE)} AS e_local FROM wide_long""",
    "files": f"""
        SELECT 'u' || user_id AS directory,
          CASE WHEN event_type = 'signup' THEN '{spec.MARKER_FILE}'
            ELSE event_type || '-' || event_id || '.xml.gz' END AS file_name,
          2 AS depth, floor(value)::BIGINT AS length, ts FROM events""",
    "ready": f"""
        SELECT directory, file_name, depth, length FROM files
        WHERE length > 0 AND file_name LIKE '%.xml%' AND directory IN (
          SELECT directory FROM files WHERE file_name = '{spec.MARKER_FILE}'
            AND ts >= TIMESTAMP '{q.READY_START}' AND ts < TIMESTAMP '{q.READY_END}')""",
}

_VALID = """f.serial = a.a_serial AND timezone('UTC', f.end_utc) BETWEEN a.lo1 AND a.hi1
  AND timezone('UTC', f.end_utc) BETWEEN a.lo2 AND a.hi2"""


def _sql(body: str, *ctes: str) -> str:
    if not ctes:
        return body.strip()
    return "WITH " + ",\n".join(f"{c} AS ({CTES[c].strip()})" for c in ctes) + "\n" + body.strip()


_FEED = ("feed0", "feed1", "feed")
_ASSIGN = ("assign0", "assign1", "assign")
_SOURCE = (*_FEED, "uom", "source")
_OWNED = (*_ASSIGN, "owned")


def _target_values(extra: dict[str, str] | None = None) -> dict[str, str]:
    """Target column to SQL over a reading ``f`` (source columns) and an assignment ``a``."""
    values = {
        "serialnumber": "f.metername",
        "source": f"'{spec.SOURCE_NAME}'",
        "aep_devicecode": "'D' || (a.k % 6)",
        "isvirtual_meter": "'N'",
        "timezoneoffset": "f.interval_epoch",
        "aep_premise_nb": "a.premise",
        "aep_service_point": "a.premise || '-' || a.point || '-' || a.point",
        "aep_mtr_install_ts": "a.inst_text",
        "aep_mtr_removal_ts": "a.rmvl_text",
        "aep_srvc_dlvry_id": "a.sd",
        "aep_comp_mtr_mltplr": "NULL::DOUBLE",
        "name_register": "f.name_register",
        "isvirtual_register": "'N'",
        "aep_srvc_qlty_idntfr": "f.aep_sqi",
        "aep_channel_id": "f.channel",
        "aep_raw_uom": "f.uom",
        "aep_sec_per_intrvl": "f.intervallength::DOUBLE * 60",
        "aep_meter_program": "'P' || (a.k % 4)",
        "aep_usage_type": f"'{spec.USAGE_TYPE}'",
        "aep_timezone_cd": f"'{spec.TIMEZONE_CODE}'",
        "endtimeperiod": "f.endtime",
        "starttimeperiod": "f.starttime",
        "value": "CASE WHEN f.value_mltplr_flg = 'Y' THEN f.value * a.bill ELSE f.value END",
        "aep_raw_value": "f.value",
        "scalarfloat": "a.bill",
        "aep_acct_cls_cd": "'C' || (a.k % 3)",
        "aep_acct_type_cd": "'T' || (a.k % 2)",
        "aep_mtr_pnt_nb": "a.point",
        "aep_tarf_pnt_nb": "a.point",
        "aep_endtime_utc": "f.end_epoch::VARCHAR",
        "aep_city": "a.city",
        "aep_zip": "substr(a.zip, 1, 5)",
        "aep_state": "CASE WHEN a.k IS NOT NULL THEN 'OH' END",
        "hdp_update_user": f"'{spec.STAGE_USER}'",
        "hdp_insert_dttm": f"{q.NOW_EPOCH}::BIGINT",
        "hdp_update_dttm": f"{q.NOW_EPOCH}::BIGINT",
        "authority": "substr(a.premise, 1, 2)",
        "aep_derived_uom": "upper(f.aep_uom)",
        "data_type": f"'{spec.DATA_TYPE_NEW}'",
        "aep_opco": f"'{q.OPCO}'",
        "aep_usage_dt": "substr(f.starttime, 1, 10)",
        "aep_meter_bucket": "right(f.metername, 2)",
        "run_date": f"'{q.RUN_DATE}'",
    }
    return values | (extra or {})


def _target(columns: list[str], readings: str, extra: dict[str, str] | None = None, pick: bool = False) -> str:
    values = _target_values(extra)
    chosen = ", ".join(f"{values.get(c, 'NULL::VARCHAR')} AS {c}" for c in columns)
    join = _VALID.replace("f.serial", "f.metername")
    newest = """
      QUALIFY row_number() OVER (PARTITION BY f.metername, f.endtime, f.channel, f.uom
        ORDER BY a.inst DESC NULLS LAST) = 1"""
    return f"SELECT {chosen} FROM {readings} f LEFT JOIN owned a ON {join} {newest if pick else ''}"


def _floats(columns: dict[str, str]) -> dict[str, str]:
    return {c: f"({v})::FLOAT::DOUBLE" for c, v in columns.items()}


_FLOAT_COLUMNS = _floats({c: _target_values()[c] for c in ("value", "aep_raw_value", "scalarfloat")})

_ASSIGNED = """f.serial AS metername, f.l_orderkey, f.l_partkey, f.channel, f.l_extendedprice AS value,
  f.end_text AS endtime, a.premise AS aep_premise_nb, a.bill AS bill_cnst, a.sd AS aep_srvc_dlvry_id,
  a.inst_text AS aep_mtr_install_ts, a.rmvl_text AS aep_mtr_removal_ts, a.city AS aep_city, a.zip AS aep_zip"""

_MERGE_KEY = "t.l_orderkey = s.l_orderkey AND t.l_linenumber = s.l_linenumber AND t.l_shipdate = s.l_shipdate"


def _merge(kind: str) -> str:
    hit = "t.l_orderkey IS NOT NULL AND s.l_orderkey IS NOT NULL"
    update = "FALSE" if kind == "insert" else hit
    join = "LEFT JOIN" if kind == "update" else "FULL JOIN"

    def kept(c: str) -> str:
        return f"CASE WHEN t.l_orderkey IS NOT NULL THEN t.{c} ELSE s.{c} END AS {c}"

    columns = ", ".join(kept(c) for c in ("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "flag"))
    return f"""
      SELECT {columns},
        CASE WHEN {update} THEN s.value WHEN t.l_orderkey IS NOT NULL THEN t.value ELSE s.value END AS value,
        CASE WHEN {update} THEN 'info-update' WHEN t.l_orderkey IS NOT NULL THEN t.hdp_update_user
          ELSE 'info-insert' END AS hdp_update_user
      FROM tgt t {join} src s ON {_MERGE_KEY}"""


_MERGE_CTES = ("merge_rows", "tgt", "src")
_WIDE = ("wide0", "wide_long", "wide_times")


def _wide_pivot(i: int) -> str:
    return f"max(l_extendedprice) FILTER (l_linenumber = {i})"


_WIDE_HEAD = """'LG' || lpad(l_orderkey::VARCHAR, 9, '0') AS meter_id"""
_FIRST = "min(l_shipdate) + INTERVAL 20 YEAR + to_hours(4 + l_orderkey % 20)"

_BLOCK = """serial AS metername, 'M' || l_orderkey AS macid, 'U' || l_partkey AS utildeviceid,
  len::VARCHAR AS intervallength, block_text AS blockstarttime"""
_VERSION_COLUMNS = "SELECT * FROM versions_latest"

ORACLES: dict[str, str] = {
    "xml_scan": _sql(
        f"""SELECT serial AS metername, 'M' || l_orderkey AS macid, channel, rawvalue, val AS value,
          l_returnflag AS uom, end_text AS int_endtime, '{q.PART_DATE}' AS part_date, TRUE AS from_gzip
        FROM feed WHERE rawvalue IS NOT NULL AND val IS NOT NULL""",
        *_FEED,
    ),
    "xml_infer": _sql(
        """SELECT channel, count(*) AS readings, min(val) AS lowest, max(val) AS highest FROM feed0
        WHERE rawvalue IS NOT NULL AND val IS NOT NULL GROUP BY channel""",
        "feed0",
    ),
    "structure_versions": _sql(
        """SELECT serial AS metername, CASE WHEN l_linenumber % 2 = 1 THEN 'M' || l_orderkey END AS macid,
          CASE WHEN l_linenumber % 2 = 0 THEN 'U' || l_partkey END AS utildeviceid,
          CASE WHEN l_linenumber % 2 = 1 THEN 1 ELSE 2 END AS blocks, 2 AS version
        FROM feed0""",
        "feed0",
    ),
    "xml_from_text": _sql(
        """SELECT serial AS metername, 'M' || l_orderkey AS macid, len::VARCHAR AS intervallength,
          block_text AS blockstarttime, end_text AS int_endtime, channel, rawvalue, val AS value, l_returnflag AS uom
        FROM feed WHERE val IS NOT NULL""",
        *_FEED,
    ),
    "quarantine_replay": _sql(
        """SELECT serial AS metername, 'M' || l_orderkey AS macid, end_text AS int_endtime, channel, val AS value,
          l_returnflag AS uom, CASE WHEN l_linenumber <> 7 THEN 1 WHEN l_returnflag = 'R' THEN 2 ELSE 3 END AS attempt
        FROM feed WHERE val IS NOT NULL""",
        *_FEED,
    ),
    "xml_corrupt_rows": """SELECT count(*) AS documents, count(*) FILTER (l_linenumber = 7) AS corrupt,
        count(*) FILTER (l_linenumber = 7) AS unnamed FROM lineitem""",
    "delimited_scan": f"""
        SELECT {_WIDE_HEAD}, lpad(l_orderkey::VARCHAR, 9, '0') AS premise_id, NULL::VARCHAR AS "timestamp",
          CASE WHEN l_orderkey % 2 = 0 THEN ' KWH' ELSE 'kW' END AS units,
          ['1', '2', '100', '999'][(l_orderkey % 4) + 1] AS purpose,
          CASE WHEN l_orderkey % 2 = 0 THEN strftime({_FIRST}, '%m%d%Y%I%M%S%p')
            ELSE strftime({_FIRST}, '%Y-%m-%d %H:%M:%S') END AS firstintervaldatetime,
          {", ".join(f"CASE WHEN {_wide_pivot(i)} IS NOT NULL THEN 'q{i}' END AS t{i}, {_wide_pivot(i)} AS v{i}" for i in range(1, shapes.N_PAIRS + 1))},
          {", ".join(f"NULL::VARCHAR AS t{i}, NULL::DOUBLE AS v{i}" for i in range(shapes.N_PAIRS + 1, spec.WIDE_PAIRS + 1))}
        FROM lineitem GROUP BY l_orderkey""",
    "union_all": "SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity FROM lineitem",
    "table_scan": "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem",
    "uom_lookup": _sql(
        f"""SELECT u.* EXCLUDE (aep_channel_id), u.aep_channel_id AS channel, n.readings
        FROM uom u LEFT JOIN (SELECT {_CHANNEL} AS channel, count(*) AS readings FROM lineitem GROUP BY 1) n
          ON n.channel = u.aep_channel_id WHERE aep_opco = 'oh'""",
        "uom",
    ),
    "lookup_conflicts": f"""
        SELECT 'oh' AS aep_opco, {_CHANNEL} AS aep_channel_id, count(DISTINCT l_returnflag) AS definitions
        FROM lineitem GROUP BY ALL HAVING count(DISTINCT l_returnflag) > 1""",
    "ready_files": _sql("SELECT * FROM ready", "files", "ready"),
    "ready_files_summary": _sql(
        "SELECT directory, count(*) AS files, sum(length)::BIGINT AS bytes FROM ready GROUP BY directory",
        "files",
        "ready",
    ),
    "intake_windows": f"""
        SELECT l_orderkey, l_partkey || '-' || l_linenumber AS part_line,
          CASE WHEN l_orderkey % {q.FOLDERS} IN (0, 1) AND l_linenumber <> 7 THEN 1 ELSE 2 END::BIGINT AS "window"
        FROM lineitem WHERE l_orderkey % {q.FOLDERS} IN (1, 2, 3) OR l_orderkey % {q.FOLDERS} = 0 AND l_linenumber <> 7""",
    "batch_window": f"""SELECT event_id, user_id, event_type, value FROM events
        WHERE ts >= TIMESTAMP '{q.BATCH_START}' AND ts < TIMESTAMP '{q.BATCH_END}'""",
    "read_back": f"""
        SELECT l_orderkey, CASE WHEN l_partkey % 50 <> 0 THEN l_linenumber END AS l_linenumber,
          l_extendedprice * 1.1::DOUBLE AS value, strftime(l_shipdate, '%Y-%m') AS ship_month
        FROM lineitem WHERE strftime(l_shipdate, '%Y-%m') IN ({", ".join(f"'{m}'" for m in q.READ_MONTHS)})""",
    "merge_upsert": _sql(_merge("upsert"), *_MERGE_CTES),
    "merge_update_only": _sql(_merge("update"), *_MERGE_CTES),
    "merge_insert_only": _sql(_merge("insert"), *_MERGE_CTES),
    "stream_upsert": _sql(_merge("upsert"), *_MERGE_CTES),
    "merge_bucketed": _sql(_merge("upsert"), *_MERGE_CTES),
    "upsert_replay": _sql(_merge("upsert"), *_MERGE_CTES),
    "upsert_ledger": _sql(
        f"""SELECT s.l_orderkey % 2 AS batch_id, 'done' AS state, count(t.l_orderkey) AS updated,
          (count(*) - count(t.l_orderkey))::BIGINT AS inserted,
          count(DISTINCT substr(s.l_shipdate, 1, 7))::INTEGER AS partitions
        FROM src s LEFT JOIN tgt t ON {_MERGE_KEY} GROUP BY 1""",
        *_MERGE_CTES,
    ),
    "merge_metrics": _sql(
        f"""SELECT CASE WHEN t.l_orderkey IS NULL THEN 'insert' WHEN s.l_orderkey IS NULL THEN 'keep' ELSE 'update' END
            AS outcome, count(*) AS row_count,
          count(*) FILTER (CASE WHEN t.l_orderkey IS NULL THEN s.l_linenumber ELSE t.l_linenumber END IS NULL)
            AS null_key_rows
        FROM tgt t FULL JOIN src s ON {_MERGE_KEY} GROUP BY 1""",
        *_MERGE_CTES,
    ),
    "incremental_feed": _sql(
        _target(spec.FEED_COLUMNS, "latest", _FLOAT_COLUMNS, pick=True), *_SOURCE, "latest", *_OWNED
    ),
    "feed_by_opco": _sql("SELECT aep_opco, count(*) AS row_count FROM held_stage GROUP BY 1", "held_stage"),
    "create_target": _sql(
        _target(spec.TARGET_COLUMNS, "latest", _FLOAT_COLUMNS, pick=True), *_SOURCE, "latest", *_OWNED
    ),
    "merge_readings": _sql(
        f"""SELECT * REPLACE (
          CASE WHEN aep_channel_id IN ('1', '2', '3') THEN 'first' ELSE 'second' END AS toutier,
          CASE WHEN aep_channel_id IN ('1', '2') THEN 'first' ELSE aep_city END AS aep_city,
          CASE WHEN aep_channel_id IN ('1', '2') THEN hdp_update_user
            WHEN aep_channel_id = '3' THEN 'info-update' ELSE 'info-insert' END AS hdp_update_user,
          CASE WHEN aep_channel_id IN ('1', '2', '3') THEN hdp_insert_dttm - 86400 ELSE hdp_insert_dttm END
            AS hdp_insert_dttm,
          CASE WHEN aep_channel_id IN ('1', '2') THEN hdp_update_dttm - 86400 ELSE hdp_update_dttm END
            AS hdp_update_dttm)
        FROM ({_target(spec.TARGET_COLUMNS, "latest", _FLOAT_COLUMNS, pick=True)})""",
        *_SOURCE, "latest", *_OWNED,
    ),
    "describe_target": _sql(
        f"""SELECT c.*, (SELECT count(*) FROM latest) AS stored_rows
        FROM (VALUES {", ".join(f"('{c}', '{spec.type_of(c)}')" for c in spec.TARGET_COLUMNS)}) AS c(col_name, data_type)""",
        *_SOURCE,
        "latest",
    ),
    "partition_profile": _sql("SELECT count(*) AS row_count FROM lineitem"),
    "compact_files": _sql(
        """SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, substr(l_shipdate, 1, 4) AS ship_year, TRUE AS packed
        FROM versions""",
        "versions",
    ),
    "materialise_once": _sql(
        """SELECT substr(l_shipdate, 1, 7) AS month, count(*) AS row_count FROM versions_latest GROUP BY 1
        UNION ALL SELECT 'all', count(*) FROM versions_latest""",
        "versions",
        "versions_latest",
    ),
    "explode_blocks": _sql(
        """SELECT serial AS metername, len::VARCHAR AS intervallength, end_text AS blockendtime,
          sum(CASE WHEN l_linenumber % 2 = 0 THEN 2 ELSE 1 END)::BIGINT AS blocks, count(*) AS filled_blocks
        FROM feed GROUP BY ALL""",
        *_FEED,
    ),
    "explode_intervals": _sql(
        """SELECT serial AS metername, end_text AS int_endtime, n AS int_intervalsequencenumber,
          count(*) AS intervals, count(*) FILTER (n = '1') AS with_readings
        FROM feed, (VALUES ('1'), ('2')) AS v(n) GROUP BY ALL""",
        *_FEED,
    ),
    "flatten_readings": _sql(
        """SELECT serial AS metername, 'U' || l_partkey AS utildeviceid, 'M' || l_orderkey AS macid,
          len::VARCHAR AS intervallength, block_text AS blockstarttime, end_text AS blockendtime,
          '2' AS numberintervals, end_text AS int_endtime, collected AS int_gatewaycollectedtime,
          '1' AS int_blocksequencenumber, '1' AS int_intervalsequencenumber, channel, rawvalue, val AS value,
          ' ' || l_returnflag || ' ' AS uom
        FROM feed WHERE rawvalue IS NOT NULL AND val IS NOT NULL""",
        *_FEED,
    ),
    "not_null_filter": _sql(
        """SELECT channel, count(*) AS readings, count(rawvalue) AS with_raw_value FROM feed0
        WHERE val IS NOT NULL GROUP BY channel""",
        "feed0",
    ),
    "wide_values_array": f"""
        SELECT {_WIDE_HEAD}, CASE WHEN l_orderkey % 3 = 0 THEN '900' ELSE '1800' END AS intervallength,
          CASE WHEN l_orderkey % 3 = 0 THEN 900 ELSE 1800 END AS aep_sec_per_intrvl, {shapes.N_PAIRS} AS positions,
          {", ".join(f"{_wide_pivot(i)} AS at_{i}" for i in range(1, shapes.N_PAIRS + 1))},
          ({shapes.N_PAIRS} - count(DISTINCT l_linenumber))::INTEGER AS gaps
        FROM lineitem GROUP BY l_orderkey""",
    "wide_to_long": _sql(
        f"""SELECT 'LG' || lpad(k::VARCHAR, 9, '0') AS meter_id, position, 'q' || position AS interval_note,
          price AS value, {_text("s_local")} || {_offset("s_local", "s_utc")} AS starttime,
          {_text("e_local")} || {_offset("e_local", "e_utc")} AS endtime,
          {_offset("e_local", "e_utc")} AS interval_epoch, epoch(e_utc)::BIGINT AS unix_endtime
        FROM wide_times""",
        *_WIDE,
    ),
    "wide_source_view": _sql(
        f"""SELECT 'LG' || lpad(k::VARCHAR, 9, '0') AS metername, 'E' || k AS utildeviceid,
          (secs // 60)::VARCHAR AS intervallength, position, 'q' || position AS interval_note,
          {_text("s_local")} || {_offset("s_local", "s_utc")} AS starttime,
          {_text("e_local")} || {_offset("e_local", "e_utc")} AS endtime,
          {_offset("e_local", "e_utc")} AS interval_epoch, ['1', '2', '100', '999'][(k % 4) + 1] AS channel,
          price AS value, CASE WHEN k % 2 = 0 THEN 'kwh' ELSE 'kw' END AS uom,
          coalesce(u.aep_derived_uom, 'UNK') AS aep_uom,
          coalesce(replace(u.name_register, 'mtr_ivl_len', (secs // 60)::VARCHAR), 'UNK') AS name_register,
          coalesce(u.aep_srvc_qlty_idntfr, 'UNK') AS aep_sqi, u.value_mltplr_flg
        FROM wide_times LEFT JOIN uom u ON u.aep_channel_id = ['1', '2', '100', '999'][(k % 4) + 1]
        WHERE s_local >= TIMESTAMP '{spec.DATE_FLOOR}'""",
        *_WIDE,
        "uom",
    ),
    "stage_view": _sql(
        _target(
            [*spec.TRANSFORM_COLUMNS, "int_gatewaycollectedtime"],
            "source",
            {
                "aep_comp_mtr_mltplr": "NULL::VARCHAR",
                "aep_sec_per_intrvl": "f.intervallength::INTEGER * 60",
                "int_gatewaycollectedtime": "f.int_gatewaycollectedtime",
            },
        ),
        *_SOURCE,
        *_OWNED,
    ),
    "conform_schema": _sql(_target(spec.TRANSFORM_COLUMNS, "source", _FLOAT_COLUMNS), *_SOURCE, *_OWNED),
    "date_floor": _sql(
        f"""SELECT {_BLOCK} FROM feed, range(CASE WHEN l_linenumber % 2 = 0 THEN 2 ELSE 1 END)
        WHERE block_local >= TIMESTAMP '{spec.DATE_FLOOR}'""",
        *_FEED,
    ),
    "date_floor_strict": _sql(
        f"""SELECT {_BLOCK} FROM feed, range(CASE WHEN l_linenumber % 2 = 0 THEN 2 ELSE 1 END)
        WHERE block_local::DATE > DATE '{spec.DATE_FLOOR_STRICT}'""",
        *_FEED,
    ),
    "company_filter": _sql(
        f"""SELECT a_serial AS mfr_devc_ser_nbr, co AS co_cd_ownr, inst_text AS mtr_inst_ts, c.opco
        FROM assign JOIN (VALUES {", ".join(f"('{o}', '{code}')" for o, codes in spec.COMPANY_CODES.items() for code in codes)})
          AS c(opco, code) ON c.code = co""",
        *_ASSIGN,
    ),
    "uom_join": _sql(
        """SELECT serial AS metername, l_orderkey, l_partkey, channel, len::VARCHAR AS intervallength,
          l_extendedprice AS value, lower(l_returnflag) AS uom, coalesce(u.aep_derived_uom, 'UNK') AS aep_uom,
          coalesce(replace(u.name_register, 'mtr_ivl_len', len::VARCHAR), 'UNK') AS name_register,
          coalesce(u.aep_srvc_qlty_idntfr, 'UNK') AS aep_sqi, u.value_mltplr_flg
        FROM feed LEFT JOIN uom u ON channel = u.aep_channel_id""",
        *_FEED,
        "uom",
    ),
    "lookup_history": f"""SELECT l_orderkey, l_linenumber, l_suppkey, l_shipdate::DATE::VARCHAR AS day,
          'u' || (s_nationkey + CASE WHEN s_suppkey % 3 = 0 THEN n ELSE 0 END) AS unit
        FROM (SELECT *, CASE WHEN l_shipdate::DATE < DATE '{q.LOOKUP_DAYS[1]}' THEN 0
          WHEN l_shipdate::DATE < DATE '{q.LOOKUP_DAYS[2]}' THEN 1 ELSE 2 END AS n FROM lineitem)
        LEFT JOIN supplier ON l_suppkey = s_suppkey AND s_suppkey % 5 <> n""",
    "assignment_join": _sql(f"SELECT {_ASSIGNED} FROM feed f LEFT JOIN owned a ON {_VALID}", *_FEED, *_OWNED),
    "assignment_join_binned": _sql(f"SELECT {_ASSIGNED} FROM feed f LEFT JOIN owned a ON {_VALID}", *_FEED, *_OWNED),
    "open_orders": """
        WITH placed AS (SELECT o_orderkey, o_custkey % 20 AS customer, epoch(date_trunc('day', o_orderdate))::BIGINT AS sec FROM orders),
        opened AS (SELECT o_orderkey AS earlier, customer AS owner, sec + 1 AS lo, sec + CASE WHEN o_orderkey % 50 = 0
          THEN 86400 * 3000 WHEN o_orderkey % 7 = 0 THEN 86400 * 40 ELSE 3600 END AS hi FROM placed WHERE o_orderkey % 3 = 0)
        SELECT o_orderkey, count(*) AS open_orders, sum(earlier)::BIGINT AS keys_sum
        FROM placed JOIN opened ON owner = customer AND sec BETWEEN lo AND hi GROUP BY o_orderkey""",
    "assignment_join_latest": _sql(
        f"""SELECT {_ASSIGNED} FROM (
          SELECT * FROM feed QUALIFY row_number() OVER (PARTITION BY serial, end_text, channel, l_returnflag
            ORDER BY l_orderkey DESC, l_partkey DESC, l_extendedprice DESC) = 1) f
        LEFT JOIN assign a ON {_VALID}
        QUALIFY row_number() OVER (PARTITION BY f.serial, f.end_text, f.channel, f.l_returnflag
          ORDER BY a.inst DESC NULLS LAST) = 1""",
        *_FEED,
        *_ASSIGN,
    ),
    "unmatched_readings": _sql(
        f"""SELECT f.serial AS metername, f.l_orderkey, f.l_partkey, f.channel, f.l_extendedprice AS value,
          f.end_text AS endtime, 'assignment' AS reason
        FROM feed f WHERE NOT EXISTS (SELECT 1 FROM owned a WHERE {_VALID})
        UNION ALL
        SELECT serial, l_orderkey, l_partkey, channel, l_extendedprice, end_text, 'unit' FROM feed
        WHERE channel NOT IN (SELECT aep_channel_id FROM uom)""",
        *_FEED,
        "uom",
        *_OWNED,
    ),
    "touched_dates": _sql("SELECT DISTINCT aep_usage_dt FROM held_stage", "held_stage"),
    "touched_dates_range": _sql(
        """SELECT min(aep_usage_dt) AS first_date, max(aep_usage_dt) AS last_date, count(DISTINCT aep_usage_dt) AS dates
        FROM held_stage""",
        "held_stage",
    ),
    "stage_counts": _sql(
        f"""SELECT 'documents' AS step, count(*) AS row_count FROM lineitem
        UNION ALL SELECT 'intervals', 2 * count(*) FROM lineitem
        UNION ALL SELECT 'readings', 2 * count(*) FROM lineitem
        UNION ALL SELECT 'complete_readings', count(*) FROM feed0 WHERE rawvalue IS NOT NULL AND val IS NOT NULL
        UNION ALL SELECT 'unit_joined', count(*) FROM unit_rows WHERE rawvalue IS NOT NULL AND val IS NOT NULL
        UNION ALL SELECT 'after_date_floor', count(*) FROM source
        UNION ALL SELECT 'staged', count(*) FROM source f LEFT JOIN owned a ON {_VALID.replace("f.serial", "f.metername")}
        UNION ALL SELECT 'latest', count(*) FROM latest
        UNION ALL SELECT 'duplicates_removed', (SELECT count(*) FROM source f LEFT JOIN owned a
          ON {_VALID.replace("f.serial", "f.metername")}) - (SELECT count(*) FROM latest)""",
        *_FEED,
        "uom",
        "unit_rows",
        "source",
        "latest",
        *_OWNED,
    ),
    "duplicate_count": """
        SELECT sum(n)::BIGINT AS row_count, count(*) AS distinct_keys, sum(n - 1)::BIGINT AS duplicates
        FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""",
    "keep_latest": _sql(_VERSION_COLUMNS, "versions", "versions_latest"),
    "keep_latest_agg": _sql(_VERSION_COLUMNS, "versions", "versions_latest"),
    "keep_latest_collected": _sql(
        """SELECT * FROM held_stage
        QUALIFY row_number() OVER (PARTITION BY serialnumber, endtimeperiod, aep_channel_id, aep_raw_uom
          ORDER BY int_gatewaycollectedtime DESC, value DESC, source_id DESC, aep_opco DESC, aep_usage_dt DESC) = 1""",
        "held_stage",
    ),
    "uom_normalise": """
        SELECT l_orderkey, l_linenumber, lower(l_returnflag) AS raw_unit,
          upper(coalesce(nullif(l_linestatus, 'F'), 'UNK')) AS status_or_unknown FROM lineitem""",
    "string_slices": _sql(
        """SELECT l_orderkey, l_linenumber, substr(lpad(l_partkey::VARCHAR, 9, '0'), 1, 2) AS authority,
          substr(lpad(l_partkey::VARCHAR, 9, '0'), 1, 5) AS zip5, strftime(end_local, '%Y-%m-%d') AS usage_day,
          end_offset AS offset_part, right(serial, 2) AS bucket, substr(serial, 1, 3) AS from_zero FROM feed""",
        *_FEED,
    ),
    "delivery_id": """
        SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'F'), '')
          || CASE WHEN o_custkey % 2 = 0 THEN o_custkey::VARCHAR ELSE '' END
          || coalesce(nullif(o_orderpriority, '5-LOW'), '') AS delivery FROM orders""",
    "service_point": """
        SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' AND o_orderpriority <> '5-LOW'
          THEN o_orderstatus || '-' || o_custkey || '-' || o_orderpriority END AS point FROM orders""",
    "register_name": _sql(
        """SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 7 THEN 'UNK'
          ELSE l_returnflag || '_del_' || len || '_min' END AS register FROM feed0""",
        "feed0",
    ),
    "interval_times": _sql(
        """SELECT l_orderkey, l_linenumber, len::VARCHAR AS length, start_text AS starttime, end_text AS endtime,
          end_offset AS interval_epoch, end_epoch AS unix_endtime FROM feed""",
        *_FEED,
    ),
    "end_epoch": _sql(
        """SELECT l_orderkey, l_linenumber, end_epoch::VARCHAR AS by_offset,
          (epoch(by_zone) - CASE WHEN timezone('America/Chicago', by_zone - INTERVAL 1 HOUR) = end_local
            THEN 3600 ELSE 0 END)::BIGINT::VARCHAR AS by_zone
        FROM (SELECT *, timezone('America/Chicago', end_local) AS by_zone FROM feed)""",
        *_FEED,
    ),
    "scaled_value": _sql(
        """SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 6 THEN
            CASE WHEN l_suppkey % 11 <> 0 THEN l_extendedprice * (1 + (l_suppkey % 5) * 0.5::DOUBLE) END
            ELSE l_extendedprice END AS scaled, len * 60 AS seconds, val AS parsed FROM feed0""",
        "feed0",
    ),
    "validity_bounds": _sql(
        """SELECT a_serial AS mfr_devc_ser_nbr, inst_text AS mtr_inst_ts, rmvl_text AS mtr_rmvl_ts,
          epoch(lo1)::BIGINT AS unix_mtr_inst_ts, epoch(hi1)::BIGINT AS unix_mtr_rmvl_ts,
          epoch(lo2)::BIGINT AS unix_acct_turn_on_dt, epoch(hi2)::BIGINT AS unix_acct_turn_off_dt, sd FROM assign""",
        *_ASSIGN,
    ),
    "zone_convert": f"""
        SELECT l_orderkey, l_linenumber,
          {_text("timezone('America/Chicago', timezone('America/New_York', l_shipdate + INTERVAL 12 HOUR))")} AS central,
          {_text("timezone('UTC', timezone('America/New_York', l_shipdate + INTERVAL 12 HOUR))")} AS utc
        FROM lineitem""",
    "release_day": _sql(
        """SELECT source_id, aep_opco, replace(aep_usage_dt, '-', '') || '_040000' AS run_stamp,
          dayname(aep_usage_dt::DATE) AS day_name,
          (dayname(aep_usage_dt::DATE) = 'Sunday' AND aep_opco IN ('oh', 'im', 'swp'))
            OR (dayname(aep_usage_dt::DATE) = 'Monday' AND aep_opco IN ('pso', 'ap')) AS is_release_day
        FROM held_stage""",
        "held_stage",
    ),
    "hold_split": _sql(
        """SELECT source_id, aep_usage_dt, CASE WHEN aep_usage_dt::DATE >= DATE '2001-08-01' - 15 THEN 'keep'
          WHEN aep_usage_dt::DATE >= DATE '2001-08-01' - 185 THEN 'hold' ELSE 'expired' END AS hold_label
        FROM held_stage""",
        "held_stage",
    ),
    "hold_append": _sql("SELECT * FROM held", "held_stage", "held"),
    "hold_release": _sql(
        """SELECT * FROM held_stage WHERE aep_usage_dt::DATE >= DATE '2001-08-01' - 15
        UNION ALL
        SELECT * EXCLUDE (run_dt) FROM held
        QUALIFY row_number() OVER (PARTITION BY serialnumber, endtimeperiod, aep_channel_id, aep_raw_uom
          ORDER BY int_gatewaycollectedtime DESC, value DESC, source_id DESC, aep_opco DESC, aep_usage_dt DESC) = 1""",
        "held_stage",
        "held",
    ),
    "hold_release_table": _sql(
        """SELECT *, 'released' AS place FROM held_stage WHERE aep_usage_dt::DATE >= DATE '2001-08-01' - 15
        UNION ALL
        SELECT *, 'released' AS place FROM (SELECT * EXCLUDE (run_dt) FROM held
        QUALIFY row_number() OVER (PARTITION BY serialnumber, endtimeperiod, aep_channel_id, aep_raw_uom
          ORDER BY int_gatewaycollectedtime DESC, value DESC, source_id DESC, aep_opco DESC, aep_usage_dt DESC) = 1)
        UNION ALL
        SELECT *, 'held 20010808' AS place FROM held_stage
        WHERE aep_usage_dt >= strftime(DATE '2001-08-08' - 185, '%Y-%m-%d')
          AND aep_usage_dt < strftime(DATE '2001-08-08' - 15, '%Y-%m-%d')""",
        "held_stage",
        "held",
    ),
    "hold_audit": _sql(
        "SELECT run_dt, aep_usage_dt, count(*) AS row_count FROM held GROUP BY ALL", "held_stage", "held"
    ),
    "source_view": _sql("SELECT * EXCLUDE (end_utc, end_epoch) FROM source", *_SOURCE),
    "consume_view": _sql(
        _target(spec.TARGET_COLUMNS, "latest", _FLOAT_COLUMNS, pick=True), *_SOURCE, "latest", *_OWNED
    ),
    "auth_stage": _sql(
        f"""SELECT serial AS serialnumber, len::VARCHAR AS intervallength, start_text AS starttimeperiod,
          end_text AS endtimeperiod, end_offset AS interval_epoch, collected AS int_gatewaycollectedtime,
          lower(l_returnflag) AS aep_raw_uom, rawvalue AS aep_raw_value, val AS value, 'oh' AS aep_opco,
          channel AS aep_channel_id, substr(start_text, 1, 10) AS aep_usage_dt,
          coalesce(u.aep_derived_uom, 'UNK') AS aep_derived_uom, right(serial, 2) AS aep_meter_bucket
        FROM feed LEFT JOIN uom u ON channel = u.aep_channel_id
        WHERE val IS NOT NULL AND start_local::DATE > DATE '{spec.DATE_FLOOR_STRICT}'""",
        *_FEED,
        "uom",
    ),
    "stream_intake": "SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity FROM lineitem",
    "stream_keep_first": f"""
        WITH RECURSIVE e AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS n FROM events),
        walk AS (
          SELECT event_id, user_id, event_type, ts, value, n, ts AS kept FROM e WHERE n = 1
          UNION ALL
          SELECT e.event_id, e.user_id, e.event_type, e.ts, e.value, e.n,
            CASE WHEN e.ts > w.kept + INTERVAL {q.FORGET_HOURS} HOUR THEN e.ts ELSE w.kept END
          FROM walk w JOIN e ON e.user_id = w.user_id AND e.event_type = w.event_type AND e.n = w.n + 1)
        SELECT event_id, user_id, event_type, floor(epoch(ts))::BIGINT AS seconds, value FROM walk
        QUALIFY row_number() OVER (PARTITION BY user_id, event_type, kept ORDER BY n) = 1""",
    "stream_dedup": "SELECT DISTINCT user_id, event_type FROM events",
}
