"""Schemas, column lists and lookup values shared by the whole library."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. Names, orders, types and codes below are part of the data
# contract (feed layout, target table layout, lookup content) and are stated
# as they have to appear in the data.
# ---------------------------------------------------------------------------

ROW_TAG = "MeterData"

# One meter document. Every leaf is text: numbers and times are parsed later
# with try_* so that one bad attribute cannot discard the rest of a document.
METER_DOCUMENT = """
_MeterName STRING, _UtilDeviceID STRING, _MacID STRING, _UtilServicePointID STRING,
IntervalReadData ARRAY<STRUCT<
  _LpSetId: STRING, _NumberIntervals: STRING, _EndTime: STRING, _StartTime: STRING,
  _IntervalLength: STRING,
  Interval: ARRAY<STRUCT<
    _GatewayCollectedTime: STRING, _IntervalSequenceNumber: STRING,
    _BlockSequenceNumber: STRING, _EndTime: STRING,
    Reading: ARRAY<STRUCT<
      _UOM: STRING, _BlockEndValue: STRING, _Value: STRING, _RawValue: STRING,
      _Channel: STRING>>>>>>
"""
CORRUPT_COLUMN = "_corrupt_record"

# Wide delimited record: these columns, then t1, v1, t2, v2, ...
WIDE_BASE_COLUMNS = """
record_type record_version timestamp premise_id esiid provisioned meter_id purpose
commodity units calculation_constant cinterval count firstintervaldatetime
""".split()
WIDE_PAIRS = 100

# Target table, in table order. FLOAT / DOUBLE / TIMESTAMP where noted, else STRING.
TARGET_COLUMNS = """
serialnumber source aep_devicecode isvirtual_meter timezoneoffset aep_premise_nb
aep_service_point aep_mtr_install_ts aep_mtr_removal_ts aep_srvc_dlvry_id
aep_comp_mtr_mltplr name_register isvirtual_register toutier toutiername
aep_srvc_qlty_idntfr aep_channel_id aep_raw_uom aep_sec_per_intrvl aep_meter_alias
aep_meter_program aep_billable_ind aep_usage_type aep_timezone_cd endtimeperiod
starttimeperiod value aep_raw_value scalarfloat aep_data_quality_cd
aep_data_validation aep_acct_cls_cd aep_acct_type_cd aep_mtr_pnt_nb aep_tarf_pnt_nb
aep_endtime_utc aep_city aep_zip aep_state hdp_update_user hdp_insert_dttm
hdp_update_dttm authority aep_derived_uom aep_opco aep_usage_dt aep_meter_bucket
""".split()
NON_STRING_TYPES = {
    "aep_comp_mtr_mltplr": "double",
    "aep_sec_per_intrvl": "double",
    "value": "float",
    "aep_raw_value": "float",
    "scalarfloat": "float",
    "hdp_insert_dttm": "timestamp",
    "hdp_update_dttm": "timestamp",
}
TARGET_PARTITION = "aep_usage_dt"

MERGE_KEYS = """
aep_usage_dt aep_meter_bucket serialnumber aep_channel_id aep_raw_uom endtimeperiod
""".split()
MERGE_UPDATE_COLUMNS = """
aep_srvc_qlty_idntfr aep_channel_id aep_sec_per_intrvl aep_meter_alias
aep_meter_program aep_usage_type aep_timezone_cd endtimeperiod starttimeperiod value
aep_raw_value scalarfloat aep_acct_cls_cd aep_acct_type_cd aep_mtr_pnt_nb
aep_comp_mtr_mltplr aep_endtime_utc aep_mtr_removal_ts aep_mtr_install_ts aep_city
aep_zip aep_state hdp_update_user hdp_update_dttm authority
""".split()
MERGE_LABELS = ("info-update", "info-insert")
LABEL_COLUMN = "hdp_update_user"

# A reading is identified by these columns once it is staged.
READING_KEYS = "serialnumber endtimeperiod aep_channel_id aep_raw_uom".split()

AUTH_STAGE_COLUMNS = """
serialnumber intervallength starttimeperiod endtimeperiod interval_epoch
int_gatewaycollectedtime aep_raw_uom aep_raw_value value aep_opco aep_channel_id
aep_usage_dt aep_derived_uom aep_meter_bucket
""".split()

UOM_COLUMNS = """
aep_opco aep_channel_id aep_derived_uom aep_raw_uom name_register
aep_srvc_qlty_idntfr value_mltplr_flg
""".split()
UOM_SAMPLE = """
oh 1   KWH   kwh      kWh_del_mtr_ivl_len_min   INTERVAL N
oh 2   KW    kw       kW_del_mtr_ivl_len_min    DEMAND   N
oh 3   KVARH kvarh    kVArh_del_mtr_ivl_len_min INTERVAL N
oh 4   KVAR  kvar     kVAr_del_mtr_ivl_len_min  DEMAND   N
oh 5   KVAH  kvah     kVAh_del_mtr_ivl_len_min  INTERVAL N
oh 100 KWH   wh       kWh_del_mtr_ivl_len_min   INTERVAL Y
oh 101 KWH   kwh      kWh_del_mtr_ivl_len_min   INTERVAL N
oh 102 KWH   kwh(rec) kWh_rec_mtr_ivl_len_min   INTERVAL N
oh 108 KVARH kvarh    kVArh_del_mtr_ivl_len_min INTERVAL N
oh 109 KVAH  kvah     kVAh_del_mtr_ivl_len_min  INTERVAL N
"""
REGISTER_PLACEHOLDER = "mtr_ivl_len"
UNKNOWN = "UNK"
OPEN_ENDED = "9999-01-01"

COMPANY_CODES = {
    "oh": ["10", "07"],
    "pso": ["95"],
    "im": ["04"],
    "ap": ["01", "02", "06"],
    "swp": ["96"],
    "tx": ["94", "97"],
}
RELEASE_DAYS = {
    "Sunday": ["oh", "im", "swp"],
    "Monday": ["pso", "ap"],
}

SOURCE_NAME = "nonvee-hes"
TIMEZONE_CODE = "US/Eastern"
USAGE_TYPE = "interval"
DATA_TYPE_NEW = "new"
STAGE_USER = "pyspark-info"
DATE_FLOOR = "2015-03-01"
DATE_FLOOR_STRICT = "2020-01-01"
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"
RUN_STAMP = "yyyyMMdd_HHmmss"
MARKER_FILE = "index.txt"
KEEP_DAYS, HOLD_DAYS = 15, 185

# --------------------------- end of fixed values ---------------------------

DEFAULT_ZONE = "America/New_York"


def _insert_after(columns: list[str], anchor: str, new: str) -> list[str]:
    at = columns.index(anchor) + 1
    return columns[:at] + [new] + columns[at:]


# Conformed rows carry data_type on top of the target layout.
TRANSFORM_COLUMNS = _insert_after(TARGET_COLUMNS, "aep_derived_uom", "data_type")

# The change feed has no bucket, moves the usage date ahead of the unit and adds run_date.
_FEED_TAIL = ["aep_usage_dt", "aep_derived_uom", "aep_opco", "run_date"]
FEED_COLUMNS = [
    c for c in TARGET_COLUMNS if c not in {*_FEED_TAIL, "aep_meter_bucket"}
] + _FEED_TAIL


def type_of(column: str) -> str:
    return NON_STRING_TYPES.get(column, "string")


def ddl(columns: list[str]) -> str:
    return ", ".join(f"`{c}` {type_of(c)}" for c in columns)


def wide_schema(n_pairs: int = WIDE_PAIRS) -> T.StructType:
    pairs = [f"{side}{i}" for i in range(1, n_pairs + 1) for side in ("t", "v")]
    return T.StructType([T.StructField(c, T.StringType()) for c in WIDE_BASE_COLUMNS + pairs])
