"""Fixed schemas and fixed reference values.

Everything in the "fixed values" blocks below must equal the values used by the
telemetry gateway this engine re-implements (seed mappings, fault table, unit
constants, rename tables).  They are data, not logic: the engine compiles them
into Spark column expressions at run time.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Canonical readings table
# --------------------------------------------------------------------------

STRING_DETAILS = ["slave_id", "serial_no", "model_name"]
DOUBLE_DETAILS = [
    "total_output_power", "total_e", "today_e",
    "pv1_voltage", "pv1_current", "pv2_voltage", "pv2_current",
    "pv3_voltage", "pv3_current", "pv4_voltage", "pv4_current",
    "grid_voltage_r", "grid_voltage_s", "grid_voltage_t",
    "grid_current_r", "grid_current_s", "grid_current_t",
    "inverter_temp", "frequency",
]
LONG_DETAILS = ["alarm_1", "alarm_2", "alarm_3", "fault_code"]
DETAIL_COLUMNS = STRING_DETAILS + DOUBLE_DETAILS + LONG_DETAILS
ENVELOPE_COLUMNS = ["request_id", "raw_id", "device_type", "device_name",
                    "device_id", "signal_strength", "ts"]
READING_COLUMNS = ENVELOPE_COLUMNS + DETAIL_COLUMNS


def canonical_type(column: str) -> str:
    if column in STRING_DETAILS:
        return "string"
    if column in DOUBLE_DETAILS:
        return "double"
    if column in LONG_DETAILS:
        return "bigint"
    raise KeyError(column)


READINGS_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in ENVELOPE_COLUMNS[:-1]]
    + [T.StructField("ts", T.TimestampType())]
    + [T.StructField(c, T.StringType()) for c in STRING_DETAILS]
    + [T.StructField(c, T.DoubleType()) for c in DOUBLE_DETAILS]
    + [T.StructField(c, T.LongType()) for c in LONG_DETAILS]
)

RAW_SCHEMA = T.StructType([
    T.StructField("raw_id", T.StringType()),
    T.StructField("request_id", T.StringType()),
    T.StructField("payload", T.StringType()),
    T.StructField("received_at", T.TimestampType()),
    T.StructField("source_ip", T.StringType()),
    T.StructField("received_date", T.DateType()),
])

RAW_STATUS_SCHEMA = T.StructType([
    T.StructField("raw_id", T.StringType()),
    T.StructField("processed", T.BooleanType()),
    T.StructField("error", T.StringType()),
    T.StructField("attempts", T.IntegerType()),
    T.StructField("at", T.TimestampType()),
    T.StructField("seq", T.LongType()),
])

REJECTS_COLUMNS = ["raw_id", "request_id", "payload", "error", "received_at"]

RULE_TYPE = T.StructType([
    T.StructField("source_field", T.StringType()),
    T.StructField("standard_field", T.StringType()),
    T.StructField("data_type", T.StringType()),
    T.StructField("transform", T.StringType()),
    # JSON text of the default value; parsed to VARIANT when the registry is read
    T.StructField("default_json", T.StringType()),
    T.StructField("required", T.BooleanType()),
])

REGISTRY_SCHEMA = T.StructType([
    T.StructField("source_id", T.StringType()),
    T.StructField("version", T.LongType()),
    T.StructField("description", T.StringType()),
    T.StructField("nested_path", T.StringType()),
    T.StructField("mappings", T.ArrayType(RULE_TYPE)),
    T.StructField("active", T.BooleanType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("updated_at", T.TimestampType()),
])

DATA_TYPES = ("string", "int", "float", "bool")
TRANSFORM_OPS = ("multiply", "divide", "add", "subtract")

# --------------------------------------------------------------------------
# Messages stored in the reject table and status log, names of the
# measurement, its constant tag and the store, share of fields that a signature needs
# --------------------------------------------------------------------------
ERR_INVALID_JSON = "invalid JSON"
ERR_UNKNOWN_SOURCE = "unknown data source"
ERR_REQUIRED = "required field missing: "
ERR_DUPLICATE = "duplicate request_id"
ERR_UNKNOWN_RAW_ID = "unknown raw id"
ERR_NO_DATA = "no data object found in payload"

MEASUREMENT = "inverter_data"
DEFAULT_TAGS = {"source": "solar_monitoring"}
STORE_TYPE = "parquet"
SIGNATURE_THRESHOLD_PERCENT = 40

# --------------------------------------------------------------------------
# Fault dimension (code, name, description, severity, action)
# --------------------------------------------------------------------------
FAULT_CODES = [
    (0, "Normal Operation", "System working properly", "INFO", "No action needed"),
    (1, "Low Energy Output", "Energy below expected level", "WARNING", "Check panels"),
    (2, "High Temperature", "Temperature exceeding normal range", "WARNING", "Check cooling"),
    (3, "Grid Connection Issue", "Problem with grid connection", "CRITICAL", "Check grid connection"),
    (4, "Low Voltage", "Voltage below minimum threshold", "WARNING", "Check connections"),
    (5, "High Voltage", "Voltage above maximum threshold", "CRITICAL", "Disconnect immediately"),
    (6, "Frequency Out of Range", "AC frequency deviation", "WARNING", "Monitor grid frequency"),
    (7, "Inverter Overload", "Load exceeding capacity", "CRITICAL", "Reduce load"),
    (8, "Communication Error", "Lost communication", "WARNING", "Check network"),
    (9, "Hardware Fault", "Component failure detected", "CRITICAL", "Contact technician"),
    (10, "System Shutdown", "Emergency shutdown activated", "CRITICAL", "Contact support"),
]

# --------------------------------------------------------------------------
# Unit scale constants
# --------------------------------------------------------------------------
UNIT_SCALES = {
    "power": 0.001,        # milliwatts to watts
    "energy": 0.01,        # 0.01 kWh units
    "voltage": 0.1,        # decivolts to volts
    "current": 0.001,      # milliamps to amps
    "temperature": 0.1,    # 0.1 degC to degC
    "frequency": 0.01,     # 0.01 Hz to Hz
}

# --------------------------------------------------------------------------
# Seed mappings.
# Rule tuple: (source_field, standard_field, data_type, transform, default, required)
# A default of None means "no default".
# --------------------------------------------------------------------------
SEED_MAPPINGS = [
    {
        "source_id": "Inv",
        "description": "FoxESS long-key format with integer scaling",
        "nested_path": "data",
        "rules": [
            ("slaveid", "slave_id", "string", "", None, False),
            ("serialno", "serial_no", "string", "", None, True),
            ("modelname", "model_name", "string", "", None, False),
            ("totaloutputpower", "total_output_power", "int", "divide:1000", None, False),
            ("todaye", "today_e", "int", "divide:1000", None, False),
            ("totale", "total_e", "int", "divide:1000", None, False),
            ("pv1voltage", "pv1_voltage", "int", "divide:100", None, False),
            ("pv1current", "pv1_current", "int", "divide:100", None, False),
            ("pv2voltage", "pv2_voltage", "int", "divide:100", None, False),
            ("pv2current", "pv2_current", "int", "divide:100", None, False),
            ("pv3voltage", "pv3_voltage", "int", "divide:100", 0, False),
            ("pv3current", "pv3_current", "int", "divide:100", 0, False),
            ("pv4voltage", "pv4_voltage", "int", "divide:100", 0, False),
            ("pv4current", "pv4_current", "int", "divide:100", 0, False),
            ("gridvoltager", "grid_voltage_r", "int", "divide:100", None, False),
            ("gridvoltages", "grid_voltage_s", "int", "divide:100", None, False),
            ("gridvoltaget", "grid_voltage_t", "int", "divide:100", None, False),
            ("gridcurrentr", "grid_current_r", "int", "divide:1000", None, False),
            ("gridcurrents", "grid_current_s", "int", "divide:1000", None, False),
            ("gridcurrentt", "grid_current_t", "int", "divide:1000", None, False),
            ("invertertemp", "inverter_temp", "int", "divide:10", None, False),
            ("frequency", "frequency", "int", "divide:1000", None, False),
            ("alarm1", "alarm1", "int", "", 0, False),
            ("alarm2", "alarm2", "int", "", 0, False),
            ("alarm3", "alarm3", "int", "", 0, False),
        ],
    },
    {
        "source_id": "Inv_short",
        "description": "FoxESS Inverter with scaled measurements",
        "nested_path": "data",
        "rules": [
            ("sno", "serial_no", "string", "", None, True),
            ("model", "model", "string", "", None, False),
            ("p", "power", "int", "multiply:0.001", None, False),
            ("e", "today_energy", "int", "multiply:0.01", None, False),
            ("te", "total_energy", "int", "multiply:0.01", None, False),
            ("pv1v", "pv1_voltage", "int", "multiply:0.1", None, False),
            ("pv2v", "pv2_voltage", "int", "multiply:0.1", None, False),
            ("pv3v", "pv3_voltage", "int", "multiply:0.1", None, False),
            ("pv4v", "pv4_voltage", "int", "multiply:0.1", None, False),
            ("pv1c", "pv1_current", "int", "multiply:0.001", None, False),
            ("pv2c", "pv2_current", "int", "multiply:0.001", None, False),
            ("pv3c", "pv3_current", "int", "multiply:0.001", None, False),
            ("pv4c", "pv4_current", "int", "multiply:0.001", None, False),
            ("gvr", "grid_voltage_r", "int", "multiply:0.1", None, False),
            ("gvs", "grid_voltage_s", "int", "multiply:0.1", None, False),
            ("gvt", "grid_voltage_t", "int", "multiply:0.1", None, False),
            ("gcr", "grid_current_r", "int", "multiply:0.001", None, False),
            ("gcs", "grid_current_s", "int", "multiply:0.001", None, False),
            ("gct", "grid_current_t", "int", "multiply:0.001", None, False),
            ("itmp", "temperature", "int", "multiply:0.1", None, False),
            ("fr", "frequency", "int", "multiply:0.01", None, False),
            ("al1", "alarm1", "int", "", 0, False),
            ("al2", "alarm2", "int", "", 0, False),
            ("al3", "alarm3", "int", "", 0, False),
        ],
    },
    {
        "source_id": "current_format",
        "description": "Default format",
        "nested_path": "data",
        "rules": [
            ("serial_no", "serial_no", "string", "", "UNKNOWN", False),
            ("s1v", "voltage", "int", "", 0, False),
            ("total_output_power", "power", "int", "", 0, False),
            ("f", "frequency", "int", "", 0, False),
            ("today_e", "today_energy", "int", "", 0, False),
            ("total_e", "total_energy", "int", "", 0, False),
            ("inv_temp", "temperature", "int", "", 0, False),
            ("fault_code", "fault_code", "int", "", 0, False),
        ],
    },
]

# Sample mapping from the mapping API documentation.
SAMPLE_MAPPING = {
    "source_id": "MyDevice",
    "description": "My custom device mapping",
    "nested_path": "data",
    "rules": [
        ("sno", "serial_no", "string", "", None, True),
        ("p", "power", "int", "divide:1000", None, False),
    ],
}

# --------------------------------------------------------------------------
# Standard-field aliases into canonical columns (decision Q11/Q12)
# --------------------------------------------------------------------------
STANDARD_ALIASES = {
    "power": "total_output_power",
    "voltage": "pv1_voltage",
    "temperature": "inverter_temp",
    "today_energy": "today_e",
    "total_energy": "total_e",
    "model": "model_name",
    "alarm1": "alarm_1",
    "alarm2": "alarm_2",
    "alarm3": "alarm_3",
}

# --------------------------------------------------------------------------
# Short-key table, canonical/standard name -> short key
# (e = today energy, te = total energy, decision Q11)
# --------------------------------------------------------------------------
SHORT_KEYS = {
    "slave_id": "slid",
    "serial_no": "sno",
    "model": "model",
    "power": "p",
    "today_energy": "e",
    "total_energy": "te",
    "pv1_voltage": "pv1v",
    "pv1_current": "pv1c",
    "pv2_voltage": "pv2v",
    "pv2_current": "pv2c",
    "pv3_voltage": "pv3v",
    "pv3_current": "pv3c",
    "pv4_voltage": "pv4v",
    "pv4_current": "pv4c",
    "grid_voltage_r": "gvr",
    "grid_voltage_s": "gvs",
    "grid_voltage_t": "gvt",
    "grid_current_r": "gcr",
    "grid_current_s": "gcs",
    "grid_current_t": "gct",
    "temperature": "itmp",
    "frequency": "fr",
    "alarm1": "al1",
    "alarm2": "al2",
    "alarm3": "al3",
}

# --------------------------------------------------------------------------
# Alias coalescing, canonical column -> keys tried in order
# (short key first, then long key; P16).  Missing everywhere -> 0 / "".
# --------------------------------------------------------------------------
RECORD_ALIASES = {
    "slave_id": ["slid", "slave_id"],
    "serial_no": ["sno", "serial_no"],
    "model_name": ["model", "model_name"],
    "total_output_power": ["p", "total_output_power"],
    "today_e": ["e", "today_e"],
    "total_e": ["te", "total_e"],
    "pv1_voltage": ["pv1v", "pv1_voltage"],
    "pv1_current": ["pv1c", "pv1_current"],
    "pv2_voltage": ["pv2v", "pv2_voltage"],
    "pv2_current": ["pv2c", "pv2_current"],
    "pv3_voltage": ["pv3v"],
    "pv3_current": ["pv3c"],
    "pv4_voltage": ["pv4v"],
    "pv4_current": ["pv4c"],
    "grid_voltage_r": ["gvr", "grid_voltage_r"],
    "grid_voltage_s": ["gvs", "grid_voltage_s"],
    "grid_voltage_t": ["gvt", "grid_voltage_t"],
    "grid_current_r": ["gcr", "grid_current_r"],
    "grid_current_s": ["gcs", "grid_current_s"],
    "grid_current_t": ["gct", "grid_current_t"],
    "inverter_temp": ["itmp", "temperature"],
    "frequency": ["fr", "frequency"],
    "alarm_1": ["al1"],
    "alarm_2": ["al2"],
    "alarm_3": ["al3"],
}

# --------------------------------------------------------------------------
# Expected-format rename tables (payload key -> canonical field)
# "Inv" is the short-key table and also the fallback for unknown device types.
# --------------------------------------------------------------------------
EXPECTED_RENAMES = {
    "Inv": {
        "slid": "slave_id", "sno": "serial_no", "model": "model_name",
        "p": "total_output_power", "e": "today_e", "te": "total_e",
        "pv1v": "pv1_voltage", "pv1c": "pv1_current",
        "pv2v": "pv2_voltage", "pv2c": "pv2_current",
        "pv3v": "pv3_voltage", "pv3c": "pv3_current",
        "pv4v": "pv4_voltage", "pv4c": "pv4_current",
        "gvr": "grid_voltage_r", "gvs": "grid_voltage_s", "gvt": "grid_voltage_t",
        "gcr": "grid_current_r", "gcs": "grid_current_s", "gct": "grid_current_t",
        "itmp": "inverter_temp", "fr": "frequency",
        "al1": "alarm_1", "al2": "alarm_2", "al3": "alarm_3",
    },
    "current_format": {
        "serial_no": "serial_no", "s1v": "pv1_voltage",
        "total_output_power": "total_output_power", "f": "frequency",
        "today_e": "today_e", "total_e": "total_e", "inv_temp": "inverter_temp",
        "fault_code": "fault_code",
    },
}
EXPECTED_FALLBACK_LAYOUT = "Inv"

# Expected-format envelope: (payload key, default when absent or not a string)
EXPECTED_ENVELOPE = [
    ("device_type", ""), ("device_name", ""), ("device_id", ""),
    ("date", ""), ("time", ""), ("time_zone", ""),
    ("latitude", "0"), ("longitude", "0"), ("software_ver", ""),
    ("signal_strength", ""), ("loginterval", ""), ("battery_status", "0"),
    ("request_id", ""),
]
# Canonical fields the expected format carries (fault_code has no slot there).
EXPECTED_DETAILS = STRING_DETAILS + DOUBLE_DETAILS + ["alarm_1", "alarm_2", "alarm_3"]

# Limits and defaults of the query surface.
DEFAULT_LIMIT = 100
DEFAULT_OFFSET = 0
RETRY_BATCH = 100
RATE_INTERVAL_SECONDS = 5
FLUSH_INTERVAL_MS_BOUNDS = (50, 5000)
BATCH_SIZE_BOUNDS = (1, 10000)
DEFAULT_FLUSH_INTERVAL_MS = 200
LATEST_PER_CODE = 10
