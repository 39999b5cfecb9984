"""Oracle SQL (DuckDB) for the driver queries.

Each statement computes the expected answer straight from ``events`` by
event kind, without parsing any JSON: the payload layouts of FIXTURES §4 and
the decisions of SURVEY §1.5 are spelled out per kind.  Doubles are produced
by the same single IEEE operation on the same integers as the engine does.
"""

from __future__ import annotations

from . import queries as QS

# Fixed values, stated here again so that a wrong one in the engine shows:
# the fault table (code, name, description, severity, action),
FAULTS = [
    (0, 'Normal Operation', 'System working properly', 'INFO', 'No action needed'),
    (1, 'Low Energy Output', 'Energy below expected level', 'WARNING', 'Check panels'),
    (2, 'High Temperature', 'Temperature exceeding normal range', 'WARNING', 'Check cooling'),
    (3, 'Grid Connection Issue', 'Problem with grid connection', 'CRITICAL', 'Check grid connection'),
    (4, 'Low Voltage', 'Voltage below minimum threshold', 'WARNING', 'Check connections'),
    (5, 'High Voltage', 'Voltage above maximum threshold', 'CRITICAL', 'Disconnect immediately'),
    (6, 'Frequency Out of Range', 'AC frequency deviation', 'WARNING', 'Monitor grid frequency'),
    (7, 'Inverter Overload', 'Load exceeding capacity', 'CRITICAL', 'Reduce load'),
    (8, 'Communication Error', 'Lost communication', 'WARNING', 'Check network'),
    (9, 'Hardware Fault', 'Component failure detected', 'CRITICAL', 'Contact technician'),
    (10, 'System Shutdown', 'Emergency shutdown activated', 'CRITICAL', 'Contact support'),
]
# the seed mappings (id, rules, required rules, rules with a transform, targets),
SEEDS = [
    ('Inv', 25, 1, 19, 'slave_id,serial_no,model_name,total_output_power,today_e,total_e,pv1_voltage,pv1_current,pv2_voltage,pv2_current,pv3_voltage,pv3_current,pv4_voltage,pv4_current,grid_voltage_r,grid_voltage_s,grid_voltage_t,grid_current_r,grid_current_s,grid_current_t,inverter_temp,frequency,alarm1,alarm2,alarm3'),
    ('Inv_short', 24, 1, 19, 'serial_no,model,power,today_energy,total_energy,pv1_voltage,pv2_voltage,pv3_voltage,pv4_voltage,pv1_current,pv2_current,pv3_current,pv4_current,grid_voltage_r,grid_voltage_s,grid_voltage_t,grid_current_r,grid_current_s,grid_current_t,temperature,frequency,alarm1,alarm2,alarm3'),
    ('current_format', 8, 0, 0, 'serial_no,voltage,power,frequency,today_energy,total_energy,temperature,fault_code'),
]
# and the keys of the payloads that have a short name.
SHORT = {'serial_no': 'sno', 'model': 'model', 'frequency': 'fr', 'alarm1': 'al1'}


def _s(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


def _d(x) -> str:
    return f"CAST({x} AS DOUBLE)"


def _ts(dt) -> str:
    return f"TIMESTAMP '{dt.strftime('%Y-%m-%d %H:%M:%S')}'"


BASE = f"""
ev AS (
  SELECT event_id, user_id AS uid, event_type AS kind, ts,
         CAST(regexp_extract(props, '[0-9]+', 0) AS BIGINT) AS k,
         CAST(round(value * 100) AS BIGINT) AS cents,
         'INV-' || lpad({_s('user_id')}, 4, '0') AS dev
  FROM events),
sent AS (
  SELECT *, 0 AS copy FROM ev
  UNION ALL
  SELECT *, 1 AS copy FROM ev WHERE event_id % 50 = 7),
pay AS (
  SELECT *,
         'raw-' || {_s('event_id')} || '-' || {_s('copy')} AS raw_id,
         ts + to_minutes(CAST(copy + 1 AS BIGINT)) AS received_at,
         (kind <> 'error' OR k % 3 = 2) AS is_object,
         CASE WHEN kind <> 'error' OR k % 3 = 2 THEN 'req-' || {_s('event_id')}
              ELSE 'raw-' || {_s('event_id')} || '-' || {_s('copy')} END AS request_id
  FROM sent),
obj AS (
  SELECT *,
         CASE kind WHEN 'click' THEN 'Inv' WHEN 'view' THEN 'Inv_short'
                   WHEN 'purchase' THEN 'current_format' WHEN 'signup' THEN 'current_format'
         END AS src
  FROM pay WHERE is_object AND copy = 0),
rd AS (
  SELECT request_id, raw_id, src AS device_type,
    'N' || {_s('uid')} AS device_name,
    CASE WHEN kind = 'signup' THEN 'unknown' ELSE dev END AS device_id,
    CASE WHEN kind = 'click' THEN {_s('k % 5')} ELSE '' END AS signal_strength,
    CASE WHEN kind = 'signup' THEN received_at ELSE ts END AS ts,
    '' AS slave_id,
    CASE WHEN kind IN ('click', 'view') OR k % 2 = 1 THEN 'SN' || {_s('uid')} ELSE 'UNKNOWN' END AS serial_no,
    CASE WHEN kind = 'view' THEN 'M' || {_s('k % 4')} ELSE '' END AS model_name,
    CASE kind WHEN 'click' THEN {_d('cents * 10')} / {_d(1000)}
              WHEN 'view' THEN {_d('cents')} * {_d('0.001')}
              ELSE {_d('cents')} END AS total_output_power,
    CASE kind WHEN 'click' THEN {_d(0)} WHEN 'view' THEN {_d('cents')} * {_d('0.01')}
              ELSE {_d('cents')} END AS total_e,
    CASE kind WHEN 'click' THEN {_d(0)} WHEN 'view' THEN {_d('k')} * {_d('0.01')}
              ELSE {_d('k')} END AS today_e,
    CASE kind WHEN 'click' THEN {_d('cents')} / {_d(100)} WHEN 'view' THEN {_d('k')} * {_d('0.1')}
              WHEN 'purchase' THEN {_d('k')} ELSE {_d(0)} END AS pv1_voltage,
    {_d(0)} AS pv1_current, {_d(0)} AS pv2_voltage, {_d(0)} AS pv2_current,
    {_d(0)} AS pv3_voltage, {_d(0)} AS pv3_current, {_d(0)} AS pv4_voltage, {_d(0)} AS pv4_current,
    CASE WHEN kind = 'view' THEN {_d(2300)} * {_d('0.1')} ELSE {_d(0)} END AS grid_voltage_r,
    {_d(0)} AS grid_voltage_s, {_d(0)} AS grid_voltage_t,
    {_d(0)} AS grid_current_r, {_d(0)} AS grid_current_s, {_d(0)} AS grid_current_t,
    CASE kind WHEN 'click' THEN {_d('k * 10 + 5')} / {_d(10)} WHEN 'view' THEN {_d('k')} * {_d('0.1')}
              ELSE {_d('k')} END AS inverter_temp,
    CASE kind WHEN 'click' THEN {_d(50000)} / {_d(1000)} WHEN 'view' THEN {_d(5000)} * {_d('0.01')}
              ELSE {_d(50)} END AS frequency,
    CASE WHEN kind = 'click' THEN k % 11 ELSE 0 END AS alarm_1,
    CASE WHEN kind = 'view' THEN k % 3 ELSE 0 END AS alarm_2,
    CAST(0 AS BIGINT) AS alarm_3,
    CASE WHEN kind IN ('purchase', 'signup') THEN k % 11 ELSE 0 END AS fault_code,
    received_at
  FROM obj
  WHERE src IS NOT NULL AND NOT (kind = 'click' AND event_id % 25 = 3)),
rj AS (
  SELECT raw_id, request_id, received_at, 'invalid JSON' AS error FROM pay WHERE NOT is_object
  UNION ALL
  SELECT raw_id, request_id, received_at,
         CASE WHEN src IS NULL THEN 'unknown data source'
              ELSE 'required field missing: serialno' END AS error
  FROM obj WHERE src IS NULL OR (kind = 'click' AND event_id % 25 = 3)),
dup AS (
  SELECT raw_id, request_id, received_at, 'duplicate request_id' AS error FROM pay
  WHERE is_object AND copy = 1),
outc AS (
  SELECT raw_id, request_id, received_at, NULL AS error, 'reading' AS outcome,
         (alarm_1 > 0 OR alarm_2 > 0 OR alarm_3 > 0 OR fault_code > 0) AS fault FROM rd
  UNION ALL SELECT raw_id, request_id, received_at, error, 'reject', false FROM rj
  UNION ALL SELECT raw_id, request_id, received_at, error, 'duplicate', false FROM dup),
cur AS (
  SELECT p.raw_id, p.request_id, p.received_at,
         o.outcome IN ('reading', 'duplicate') AS processed, o.error, 1 AS attempts
  FROM pay p JOIN outc o ON p.raw_id = o.raw_id)
"""

READING_COLS = ("request_id, raw_id, device_type, device_name, device_id, signal_strength, ts, "
                "slave_id, serial_no, model_name, total_output_power, total_e, today_e, "
                "pv1_voltage, pv1_current, pv2_voltage, pv2_current, pv3_voltage, pv3_current, "
                "pv4_voltage, pv4_current, grid_voltage_r, grid_voltage_s, grid_voltage_t, "
                "grid_current_r, grid_current_s, grid_current_t, inverter_temp, frequency, "
                "alarm_1, alarm_2, alarm_3, fault_code")


DETAIL_COLS = READING_COLS[READING_COLS.index("slave_id"):]


def w(body: str) -> str:
    return "WITH " + BASE.strip() + "\n" + body


def _values(rows, cols) -> str:
    def lit(x):
        if isinstance(x, str):
            return "'" + x.replace("'", "''") + "'"
        if isinstance(x, bool):
            return "true" if x else "false"
        return str(x)
    body = ", ".join("(" + ", ".join(lit(x) for x in r) + ")" for r in rows)
    return f"(VALUES {body}) AS t({', '.join(cols)})"


# ---------------------------------------------------------------- key lists

def _key_variants():
    """(kind condition, root keys, data keys) for every payload shape."""
    click_root = ["request_id", "device_type", "device_id", "device_name", "signal_strength",
                  "device_timestamp", "data"]
    click_data = ["totaloutputpower", "pv1voltage", "invertertemp", "frequency", "alarm1"]
    view_root = ["request_id", "device_id", "device_name", "device_timestamp", "data"]
    view_data = ["sno", "model", "p", "e", "te", "pv1v", "gvr", "itmp", "fr", "al2"]
    legacy_data = ["s1v", "total_output_power", "f", "today_e", "total_e", "fault_code"]
    p_root = ["request_id", "device_id", "device_name", "device_timestamp", "data"]
    s_root = ["request_id", "source_id", "device_name", "device_timestamp", "data"]
    return [
        ("kind = 'click' AND event_id % 25 <> 3", click_root, click_data + ["serialno"]),
        ("kind = 'click' AND event_id % 25 = 3", click_root, click_data),
        ("kind = 'view'", view_root, view_data),
        ("kind = 'purchase' AND k % 2 = 1", p_root + ["inv_temp"], legacy_data + ["serial_no"]),
        ("kind = 'purchase' AND k % 2 = 0", p_root, legacy_data + ["inv_temp"]),
        ("kind = 'signup' AND k % 2 = 1", s_root + ["inv_temp"], legacy_data + ["serial_no"]),
        ("kind = 'signup' AND k % 2 = 0", s_root, legacy_data + ["inv_temp"]),
        ("kind = 'error'", ["device_id", "request_id", "foo"], None),
    ]


def _keys_sql(mode: str) -> str:
    cases = []
    for cond, root, data in _key_variants():
        if mode == "all":
            keys = sorted(root + (data or []))
        else:
            if data is None:
                continue
            keys = sorted(SHORT.get(k, k) for k in data)
        cases.append(f"WHEN {cond} THEN '{','.join(keys)}'")
    return "CASE " + " ".join(cases) + " END"


# ---------------------------------------------------------------- statements

def _fault_dim():
    return _values([(c, n, d, s, a) for c, n, d, s, a in FAULTS],
                   ["code", "name", "description", "severity", "action"])


def _listing(where: str, limit: int, offset: int = 0, cols="request_id, device_id, ts, "
             "total_output_power, fault_code") -> str:
    off = f" OFFSET {offset}" if offset else ""
    return w(f"SELECT {cols} FROM rd {where} ORDER BY ts DESC, request_id ASC LIMIT {limit}{off}")


def _fault_cond() -> str:
    return "(alarm_1 > 0 OR alarm_2 > 0 OR alarm_3 > 0 OR fault_code > 0)"


def _normal_cond() -> str:
    return "(alarm_1 = 0 AND alarm_2 = 0 AND alarm_3 = 0 AND fault_code = 0)"


LEGACY = "kind IN ('purchase', 'signup')"


def _convert(kind: str) -> str:
    def legacy(x):
        return f"CASE WHEN {LEGACY} THEN {x} END"
    if kind in ("int", "float"):
        cast = "BIGINT" if kind == "int" else "DOUBLE"
        z = "CAST(0 AS BIGINT)" if kind == "int" else _d(0)
        power, fault = f"CAST(cents AS {cast})", f"CAST(k % 11 AS {cast})"
        s1v, serial = f"CASE WHEN kind = 'purchase' THEN CAST(k AS {cast}) ELSE {z} END", z
    elif kind == "string":
        power, fault = _s("cents"), _s("k % 11")
        s1v, serial = f"CASE WHEN kind = 'purchase' THEN {_s('k')} ELSE '' END", f"'SN' || {_s('uid')}"
    else:
        power, fault = "CASE WHEN kind = 'purchase' THEN cents <> 0 ELSE cents = 1 END", "k % 11 <> 0"
        s1v, serial = "CASE WHEN kind = 'purchase' THEN k <> 0 ELSE false END", "false"
    return w(f"""SELECT request_id, {legacy(power)} AS power, {legacy(s1v)} AS s1v, {legacy(fault)} AS fault,
        CASE WHEN {LEGACY} AND k % 2 = 1 THEN {serial} END AS serial FROM obj""")


def _transform(op: str) -> str:
    spec = {"multiply": f"{_d('cents')} * {_d(2.5)}", "divide": f"{_d('cents')} / {_d(8)}",
            "add": f"{_d('cents')} + {_d(1.5)}", "subtract": f"{_d('cents')} - {_d(0.25)}"}[op]
    second = "zero_divisor" if op == "divide" else "raw"
    return w(f"""SELECT request_id, CASE WHEN kind = 'view' THEN {spec} END AS value,
        CASE WHEN kind = 'view' THEN {_d('cents')} END AS {second} FROM obj""")


def _unit_scale() -> str:
    scaled = {"power": f"{_d('cents')} * {_d('0.001')}", "energy": f"{_d('cents')} * {_d('0.01')}",
              "voltage": f"{_d('k')} * {_d('0.1')}", "current": f"{_d('cents')} * {_d('0.001')}",
              "temperature": f"{_d('k')} * {_d('0.1')}", "frequency": f"{_d(5000)} * {_d('0.01')}"}
    return w("SELECT request_id, " + ", ".join(f"CASE WHEN kind = 'view' THEN {x} END AS {n}" for n, x in scaled.items())
             + " FROM obj")


ENVELOPE = ("device_type", "device_name", "device_id", "date", "time", "time_zone", "latitude", "longitude",
            "software_ver", "signal_strength", "loginterval", "battery_status", "request_id", "valid")
EXPECTED_TEXT = ("slave_id", "serial_no", "model_name")
EXPECTED_NUMBERS = ("total_output_power", "total_e", "today_e", "pv1_voltage", "pv1_current", "pv2_voltage",
                    "pv2_current", "pv3_voltage", "pv3_current", "pv4_voltage", "pv4_current", "grid_voltage_r",
                    "grid_voltage_s", "grid_voltage_t", "grid_current_r", "grid_current_s", "grid_current_t",
                    "inverter_temp", "frequency")
EXPECTED_ALARMS = ("alarm_1", "alarm_2", "alarm_3")


def _expected_columns(given: dict[str, str]) -> str:
    """All 40 columns; those not given are empty."""
    zero = {**dict.fromkeys(ENVELOPE + EXPECTED_TEXT, "''"), **dict.fromkeys(EXPECTED_NUMBERS, _d(0)),
            **dict.fromkeys(EXPECTED_ALARMS, "CAST(0 AS BIGINT)"), "latitude": "'0'", "longitude": "'0'",
            "battery_status": "'0'", "valid": "true", "error": "CAST(NULL AS VARCHAR)"}
    assert set(given) <= set(zero)
    return ", ".join(f'{given.get(c, z)} AS "{c}"' for c, z in zero.items())


def _expected() -> str:
    # device_type 'Inv' (click) and unknown types use the short-key table; only
    # view payloads carry short keys, so they are the only rows with values.
    def view(x):
        return f"CASE WHEN kind = 'view' THEN {_d(x)} ELSE {_d(0)} END"
    columns = _expected_columns({
        "device_type": "CASE WHEN kind = 'click' THEN 'Inv' ELSE '' END",
        "device_name": f"CASE WHEN kind = 'error' THEN '' ELSE 'N' || {_s('uid')} END",
        "device_id": "CASE WHEN kind = 'signup' THEN '' ELSE dev END",
        "signal_strength": f"CASE WHEN kind = 'click' THEN {_s('k % 5')} ELSE '' END",
        "request_id": "request_id",
        "serial_no": f"CASE WHEN kind = 'view' THEN 'SN' || {_s('uid')} ELSE '' END",
        "model_name": f"CASE WHEN kind = 'view' THEN 'M' || {_s('k % 4')} ELSE '' END",
        "total_output_power": view("cents"), "today_e": view("k"), "total_e": view("cents"),
        "pv1_voltage": view("k"), "grid_voltage_r": view(2300), "inverter_temp": view("k"), "frequency": view(5000),
        # a click's frequency has its long name, which the short-key table does not read
        "alarm_2": "CASE WHEN kind = 'view' THEN k % 3 ELSE 0 END",
        "error": "CASE WHEN kind = 'error' THEN 'no data object found in payload' END"})
    return w(f"SELECT {columns} FROM obj")


def _mixed_columns() -> dict[str, str]:
    power = f"CASE m WHEN 0 THEN {_d('cents')} WHEN 1 THEN {_d('cents')} + {_d('0.25')} ELSE {_d(0)} END"
    alarm = "CASE WHEN m = 2 THEN 0 ELSE k % 11 END"

    def short(x, z):
        return f"CASE WHEN event_id % 2 = 0 THEN {x} ELSE {z} END"

    def legacy(x, z):
        return f"CASE WHEN event_id % 2 = 1 THEN {x} ELSE {z} END"
    return {
        "device_type": "CASE WHEN event_id % 2 = 0 THEN 'Inv' ELSE 'current_format' END",
        "device_name": f"'N' || {_s('uid')}", "device_id": "dev",
        "date": "strftime(ts, '%d/%m/%Y')", "time": "strftime(ts, '%H:%M:%S')",
        "time_zone": "CASE uid % 3 WHEN 0 THEN 'Asia/Kolkata' WHEN 1 THEN 'UTC' ELSE '' END",
        "latitude": f"CASE WHEN m < 3 THEN {_s('k % 90')} || '.5' ELSE '0' END",
        "software_ver": f"'v' || {_s('k % 7')}", "request_id": f"'mix-' || {_s('event_id')}",
        "serial_no": f"CASE WHEN m = 5 THEN '' ELSE 'SN' || {_s('uid')} END",
        "total_output_power": power, "today_e": power, "pv1_voltage": _d("k"),
        "grid_current_t": short(power, _d(0)), "inverter_temp": legacy(power, _d(0)),
        "alarm_1": short(alarm, "CAST(0 AS BIGINT)"), "alarm_3": short("k % 2", "CAST(0 AS BIGINT)")}


MIXED = "mixed AS (SELECT *, (event_id // 2) % 6 AS m FROM ev)\n"


def _mixed_base() -> str:
    return "WITH " + BASE.strip() + ",\n" + MIXED


def _documents() -> str:
    """The document's text: fields in order, empty ones left out."""
    given = _mixed_columns()
    inner = _mixed_base() + f"SELECT {_expected_columns(given)} FROM mixed"
    parts = []
    for c in ENVELOPE + EXPECTED_TEXT + EXPECTED_NUMBERS + EXPECTED_ALARMS:
        if c == "valid":
            parts.append("'\"valid\":true'")
        elif c in EXPECTED_NUMBERS + EXPECTED_ALARMS:
            parts.append(f"CASE WHEN \"{c}\" <> 0 THEN '\"{c}\":' || CAST(\"{c}\" AS VARCHAR) END")
        else:
            parts.append(f"CASE WHEN \"{c}\" <> '' THEN '\"{c}\":\"' || \"{c}\" || '\"' END")
    return (f"SELECT request_id, '{{' || concat_ws(',', {', '.join(parts)}) "
            f"|| '}}' AS document FROM ({inner})")


def _alias_canonical() -> str:
    z = _d(0)
    return w(f"""SELECT request_id,
        CASE WHEN kind = 'view' THEN 'SN' || {_s('uid')}
             WHEN kind IN ('purchase', 'signup') AND k % 2 = 1 THEN 'SN' || {_s('uid')}
             ELSE '' END AS serial_no,
        CASE WHEN kind = 'view' THEN 'M' || {_s('k % 4')} ELSE '' END AS model_name,
        CASE WHEN kind IN ('view', 'purchase', 'signup') THEN {_d('cents')} ELSE {z} END AS total_output_power,
        CASE WHEN kind IN ('view', 'purchase', 'signup') THEN {_d('k')} ELSE {z} END AS today_e,
        CASE WHEN kind IN ('view', 'purchase', 'signup') THEN {_d('cents')} ELSE {z} END AS total_e,
        CASE WHEN kind = 'view' THEN {_d('k')} ELSE {z} END AS pv1_voltage,
        CASE WHEN kind = 'view' THEN {_d(2300)} ELSE {z} END AS grid_voltage_r,
        CASE WHEN kind = 'view' THEN {_d('k')} ELSE {z} END AS inverter_temp,
        CASE kind WHEN 'view' THEN {_d(5000)} WHEN 'click' THEN {_d(50000)} ELSE {z} END AS frequency,
        '' AS slave_id,
        {z} AS pv1_current, {z} AS pv2_voltage, {z} AS pv2_current, {z} AS pv3_voltage, {z} AS pv3_current,
        {z} AS pv4_voltage, {z} AS pv4_current, {z} AS grid_voltage_s, {z} AS grid_voltage_t,
        {z} AS grid_current_r, {z} AS grid_current_s, {z} AS grid_current_t,
        CAST(0 AS BIGINT) AS alarm_1,
        CASE WHEN kind = 'view' THEN k % 3 ELSE 0 END AS alarm_2,
        CAST(0 AS BIGINT) AS alarm_3
        FROM obj WHERE kind <> 'error'""")


def _typed_getters() -> str:
    m1 = _d(-1)
    return w(f"""SELECT request_id,
        CASE WHEN kind = 'error' THEN 'unknown' ELSE 'N' || {_s('uid')} END AS device_name,
        CASE WHEN kind = 'signup' THEN 'unknown' ELSE dev END AS device_id,
        CASE WHEN kind = 'signup' THEN 'current_format' ELSE '' END AS source_hint,
        CASE WHEN kind IN ('purchase', 'signup') THEN {_d('cents')} ELSE {m1} END AS power,
        CASE WHEN kind = 'purchase' THEN {_d('k')} ELSE {m1} END AS s1v,
        CASE WHEN kind IN ('purchase', 'signup') THEN k % 11 ELSE -1 END AS fault
        FROM obj""")


def _payload_text() -> str:
    """The payload JSON text, identical to sources.payloads."""
    def kv(key, val, quoted=False, comma=True):
        v = f"'\"' || {val} || '\"'" if quoted else val
        return f"'\"{key}\":' || {v}" + (" || ','" if comma else "")
    rid = f"'req-' || {_s('event_id')}"
    name = f"'N' || {_s('uid')}"
    serial = f"'SN' || {_s('uid')}"
    dts = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')"
    head = f"'{{' || {kv('request_id', rid, True)}"
    click = " || ".join([
        head, kv("device_type", "'Inv'", True), kv("device_id", "dev", True),
        kv("device_name", name, True), kv("signal_strength", _s("k % 5"), True),
        kv("device_timestamp", dts, True), "'\"data\":{'",
        f"(CASE WHEN event_id % 25 = 3 THEN '' ELSE {kv('serialno', serial, True)} END)",
        kv("totaloutputpower", _s("cents * 10")), kv("pv1voltage", _s("cents")),
        kv("invertertemp", _s("k * 10 + 5")), kv("frequency", "'50000'"),
        kv("alarm1", _s("k % 11"), comma=False), "'}}'"])
    view = " || ".join([
        head, kv("device_id", "dev", True), kv("device_name", name, True),
        kv("device_timestamp", dts, True), "'\"data\":{'",
        kv("sno", serial, True), kv("model", f"'M' || {_s('k % 4')}", True),
        kv("p", _s("cents")), kv("e", _s("k")), kv("te", _s("cents")), kv("pv1v", _s("k")),
        kv("gvr", "'2300'"), kv("itmp", _s("k")), kv("fr", "'5000'"),
        kv("al2", _s("k % 3"), comma=False), "'}}'"])

    def legacy(hinted):
        if hinted:
            root = " || ".join([kv("source_id", "'current_format'", True), kv("device_name", name, True),
                                kv("device_timestamp", "'not-a-time'", True)])
            power = kv("total_output_power", _s("cents"), True)
            s1v = "'\"s1v\":null,'"
        else:
            root = " || ".join([kv("device_id", "dev", True), kv("device_name", name, True),
                                kv("device_timestamp", dts, True)])
            power = kv("total_output_power", _s("cents"))
            s1v = kv("s1v", _s("k"))
        return " || ".join([
            head, root, f"(CASE WHEN k % 2 = 1 THEN {kv('inv_temp', _s('k'))} ELSE '' END)",
            "'\"data\":{'", f"(CASE WHEN k % 2 = 1 THEN {kv('serial_no', serial, True)} ELSE '' END)",
            s1v, power, kv("f", "'50'"), kv("today_e", _s("k")), kv("total_e", _s("cents")),
            f"(CASE WHEN k % 2 = 1 THEN '' ELSE {kv('inv_temp', _s('k'))} END)",
            kv("fault_code", _s("k % 11"), comma=False), "'}}'"])
    error = (f"CASE WHEN k % 3 = 0 THEN '{{\"device_id\": \"' || dev || '\", \"id\": ' || {_s('event_id')} "
             f"WHEN k % 3 = 1 THEN '[' || {_s('event_id')} || ']' "
             f"ELSE '{{\"device_id\": \"' || dev || '\", \"request_id\": \"' || {rid} || "
             f"'\", \"foo\": ' || {_s('k')} || '}}' END")
    return (f"CASE kind WHEN 'click' THEN {click} WHEN 'view' THEN {view} "
            f"WHEN 'purchase' THEN {legacy(False)} WHEN 'signup' THEN {legacy(True)} "
            f"ELSE {error} END")


def _mapping_usage() -> str:
    reg = _values(SEEDS, ["source_id", "fields", "required_fields", "transformed_fields", "targets"])
    return w(f"""SELECT t.source_id, CAST(t.fields AS BIGINT) AS fields,
        CAST(t.required_fields AS BIGINT) AS required_fields,
        CAST(t.transformed_fields AS BIGINT) AS transformed_fields, t.targets,
        CAST(coalesce(u.payloads, 0) AS BIGINT) AS payloads
        FROM {reg} LEFT JOIN (SELECT src, count(*) AS payloads FROM obj GROUP BY src) u
        ON t.source_id = u.src""")


def _mapping_lookup() -> str:
    reg = _values([seed[:2] for seed in SEEDS], ["source_id", "n_rules"])
    return w(f"""SELECT t.source_id, CAST(t.n_rules AS INTEGER) AS n_rules, count(*) AS n
        FROM obj JOIN {reg} ON obj.src = t.source_id GROUP BY t.source_id, t.n_rules""")


def _mapping_preview() -> str:
    return w(f"""SELECT request_id,
        CASE WHEN kind = 'view' THEN 'SN' || {_s('uid')} END AS serial_no,
        CASE WHEN kind = 'view' THEN {_d('cents')} / {_d(1000)} END AS power,
        CASE WHEN kind = 'view' THEN NULL ELSE 'required field missing: sno' END AS error
        FROM obj""")


def _reprocess() -> str:
    return w(f"""SELECT request_id,
        CASE WHEN kind = 'click' THEN 'Inv' ELSE 'foo_device' END AS device_type,
        CASE WHEN kind = 'click' THEN 'UNKNOWN' ELSE '' END AS serial_no,
        CASE WHEN kind = 'click' THEN {_d('k * 10 + 5')} / {_d(10)} ELSE {_d('k')} END AS inverter_temp
        FROM obj WHERE (kind = 'click' AND event_id % 25 = 3) OR kind = 'error'""")


def statements() -> dict[str, str]:
    fstart, fend = _ts(QS.FILTER_START), _ts(QS.FILTER_END)
    flt = f"WHERE device_id = '{QS.FILTER_DEVICE}' AND ts >= {fstart} AND ts <= {fend}"
    page_cols = "request_id, ts, device_name, pv1_voltage, total_output_power, inverter_temp, fault_code"
    detect_default = w("SELECT coalesce(src, 'Inv') AS source_id, count(*) AS n FROM obj GROUP BY 1")
    return {
        "normalize_canonical": w(f"SELECT {READING_COLS} FROM rd"),
        "normalize_rule_plan": w(f"SELECT {READING_COLS} FROM rd"),
        "detect_source": w("SELECT src AS source_id, count(*) AS n FROM obj GROUP BY src"),
        "detect_default_source": detect_default,
        "detect_rule_join": w("SELECT src AS source_id, count(*) AS n FROM obj GROUP BY src"),
        "rejects": w("SELECT raw_id, request_id, error FROM rj"),
        "root_fallback_defaults": w(
            "SELECT request_id, serial_no, inverter_temp, pv1_voltage FROM rd"),
        "convert_int": _convert("int"),
        "convert_float": _convert("float"),
        "convert_string": _convert("string"),
        "convert_bool": _convert("bool"),
        "transform_multiply": _transform("multiply"),
        "transform_divide": _transform("divide"),
        "transform_add": _transform("add"),
        "transform_subtract": _transform("subtract"),
        "unit_scale": _unit_scale(),
        "payload_keys": w(f"SELECT {_keys_sql('all')} AS keys, count(*) AS n FROM obj GROUP BY 1"),
        "short_keys": w(f"SELECT {_keys_sql('short')} AS keys, count(*) AS n FROM obj "
                        "WHERE kind <> 'error' GROUP BY 1"),
        "alias_canonical": _alias_canonical(),
        "event_time": w("SELECT request_id, CASE WHEN kind IN ('signup', 'error') THEN received_at "
                        "ELSE ts END AS ts FROM obj"),
        "request_ids": w("SELECT request_id, raw_id FROM obj UNION ALL "
                         "SELECT request_id, raw_id FROM pay WHERE NOT is_object"),
        "expected_format": _expected(),
        "points": w("""SELECT request_id, 'inverter_data' AS measurement,
            'device_id=' || device_id || ',device_name=' || device_name || ',device_type=' || device_type
            || CASE WHEN signal_strength <> '' THEN ',signal_strength=' || signal_strength ELSE '' END
            || ',source=solar_monitoring' AS tags,
            """ + DETAIL_COLS + """, ts AS time FROM rd"""),
        "points_roundtrip": w("SELECT request_id, device_type, device_name, device_id, signal_strength, "
                              f"{DETAIL_COLS}, ts FROM rd"),
        "records_filter": _listing(flt, QS.FILTER_LIMIT, QS.FILTER_OFFSET),
        "records_count": w(f"SELECT count(*) AS total FROM rd {flt}"),
        "fault_only": w(f"SELECT request_id, alarm_1, alarm_2, alarm_3, fault_code FROM rd "
                        f"WHERE {_fault_cond()}"),
        "normal_only": w(f"SELECT request_id, alarm_1, alarm_2, alarm_3, fault_code FROM rd "
                         f"WHERE {_normal_cond()}"),
        "time_range": w(f"""SELECT raw_id, request_id, received_at FROM pay
            WHERE received_at BETWEEN {_ts(QS.RANGE_START)} AND {_ts(QS.RANGE_END)}
            ORDER BY received_at DESC, raw_id ASC LIMIT {QS.RANGE_LIMIT}"""),
        "page_listing": _listing("", QS.PAGE_SIZE, (QS.PAGE_NO - 1) * QS.PAGE_SIZE, page_cols),
        "page_meta": w(f"""SELECT CAST({QS.PAGE_NO} AS BIGINT) AS page, CAST({QS.PAGE_SIZE} AS BIGINT) AS "limit",
            CAST(greatest(least(count(*) - {(QS.PAGE_NO - 1) * QS.PAGE_SIZE}, {QS.PAGE_SIZE}), 0) AS BIGINT) AS count,
            count(*) AS total, CAST(ceil(count(*) / {QS.PAGE_SIZE}) AS BIGINT) AS total_pages,
            {str(QS.PAGE_NO > 1).lower()} AS has_prev, {QS.PAGE_NO} < ceil(count(*) / {QS.PAGE_SIZE}) AS has_next
            FROM rd"""),
        "latest_n": _listing("", QS.LATEST_N),
        "latest_faults": _listing("WHERE fault_code > 0", QS.LATEST_N),
        "active_faults": w(f"SELECT request_id, ts, fault_code, pv1_voltage, total_output_power, "
                           f"inverter_temp FROM rd WHERE {_fault_cond()}"),
        "latest_faults_per_code": w(f"""SELECT fault_code, request_id, ts, rn FROM (
            SELECT fault_code, request_id, ts, CAST(row_number() OVER (PARTITION BY fault_code
              ORDER BY ts DESC, request_id ASC) AS INTEGER) AS rn FROM rd WHERE {_fault_cond()})
            WHERE rn <= 10"""),
        "fault_stats": w(f"""SELECT c.fault_code, c.count, t.name, t.severity, t.description, t.action
            FROM (SELECT fault_code, count(*) AS count FROM rd GROUP BY fault_code) c
            LEFT JOIN {_fault_dim()} ON c.fault_code = t.code"""),
        "fault_codes": w(f"""SELECT CAST(t.code AS BIGINT) AS code, t.name, t.description, t.severity, t.action,
            CAST(coalesce(c.n, 0) AS BIGINT) AS readings FROM {_fault_dim()}
            LEFT JOIN (SELECT fault_code, count(*) AS n FROM rd GROUP BY fault_code) c
            ON c.fault_code = t.code"""),
        "fault_totals": w(f"""SELECT fault_code, count(*) AS n,
            grouping(fault_code) = 1 AS is_total
            FROM rd WHERE {_fault_cond()} GROUP BY ROLLUP (fault_code)"""),
        "device_power": w("""SELECT device_name, count(*) AS n,
            CAST(sum(CAST(round(total_output_power * 1000) AS BIGINT)) AS BIGINT) AS power_milli,
            CAST(sum(CAST(round(total_output_power * 1000) AS BIGINT)) AS BIGINT) / count(*) / 1000.0::DOUBLE AS avg_power
            FROM rd GROUP BY device_name"""),
        "total_count": w("SELECT count(*) AS total FROM rd"),
        "sql_adhoc": w("SELECT device_type, count(*) AS n, max(ts) AS last_time FROM rd "
                       "WHERE fault_code > 0 GROUP BY device_type"),
        "ingest_stats": w("""SELECT count(*) FILTER (WHERE outcome = 'reading') AS total_records,
            count(*) FILTER (WHERE outcome = 'reading' AND NOT fault) AS normal_records,
            count(*) FILTER (WHERE outcome = 'reading' AND fault) AS fault_records,
            count(*) FILTER (WHERE outcome = 'reading') AS inserted_count,
            count(*) FILTER (WHERE outcome <> 'reading') AS failed_count,
            CAST(0 AS BIGINT) AS buffer_size,
            CASE WHEN count(*) = 0 THEN 100.0::DOUBLE ELSE
              count(*) FILTER (WHERE outcome = 'reading') / count(*) * 100 END AS success_rate,
            'parquet' AS database_type FROM outc"""),
        "raw_stats": w("""SELECT count(*) AS total_raw, count(*) FILTER (WHERE NOT processed) AS unprocessed,
            count(*) FILTER (WHERE error IS NOT NULL AND error <> '') AS with_errors,
            count(*) FILTER (WHERE processed) AS processed,
            CASE WHEN count(*) = 0 THEN 0.0::DOUBLE ELSE
              count(*) FILTER (WHERE processed) / count(*) * 100 END AS processing_rate FROM cur"""),
        "raw_current_status": w("SELECT raw_id, processed, error, CAST(attempts AS INTEGER) AS attempts FROM cur"),
        "pending_oldest": w("""SELECT raw_id, received_at, error FROM cur WHERE NOT processed
            ORDER BY received_at ASC, raw_id ASC LIMIT 100"""),
        "reprocess": _reprocess(),
        "retention": w(f"SELECT raw_id, received_at FROM cur WHERE NOT (processed AND "
                       f"received_at < {_ts(QS.RETENTION_CUTOFF)})"),
        "reconcile": w("""SELECT count(*) AS inserted_count, count(*) AS total_records,
            CAST(0 AS BIGINT) AS discrepancy, CAST(0 AS BIGINT) AS missing FROM rd"""),
        "ingest_rate": w("""SELECT time_bucket(INTERVAL '5 seconds', received_at) AS window_start,
            count(*) AS received, count(*) FILTER (WHERE outcome = 'reading') AS processed,
            count(*) FILTER (WHERE outcome <> 'reading') AS failed,
            count(*) / 5.0::DOUBLE AS received_per_sec,
            count(*) FILTER (WHERE outcome = 'reading') / 5.0::DOUBLE AS processed_per_sec
            FROM outc GROUP BY 1"""),
        "raw_landing": w(f"""SELECT raw_id, request_id, {_payload_text()} AS payload, received_at,
            CAST(received_at AS DATE) AS received_date FROM pay"""),
        "mapping_usage": _mapping_usage(),
        "mapping_exists": w("""SELECT CASE WHEN kind = 'click' THEN 'Inv' ELSE 'current_format' END AS source_id,
            count(*) AS n FROM obj WHERE kind IN ('click', 'signup') GROUP BY 1"""),
        "mapping_lookup": _mapping_lookup(),
        "mapping_preview": _mapping_preview(),
        "typed_getters": _typed_getters(),
        "stream_ingest": w(f"SELECT {READING_COLS} FROM rd"),
        "expected_format_mixed": _mixed_base() + f"SELECT {_expected_columns(_mixed_columns())} FROM mixed",
        "documents_omit_empty": _documents(),
        "device_local_time": _mixed_base() + f"""SELECT 'mix-' || {_s('event_id')} AS request_id,
            CASE uid % 3 WHEN 0 THEN 'Asia/Kolkata' WHEN 1 THEN 'UTC' ELSE '' END AS time_zone,
            date_trunc('second', ts) - CASE WHEN uid % 3 = 0 THEN INTERVAL 330 MINUTE ELSE INTERVAL 0 MINUTE END
              AS device_time FROM mixed""",
        "page_deep": _listing("", QS.DEEP_SIZE, (QS.DEEP_PAGE - 1) * QS.DEEP_SIZE, page_cols),
        "mark_status": w(f"""SELECT 'raw-' || {_s('event_id')} || '-0' AS raw_id, true AS processed,
              CAST(NULL AS VARCHAR) AS error, CAST(2 AS INTEGER) AS attempts FROM ev WHERE event_id % 20 = 1
            UNION ALL SELECT 'raw-' || {_s('event_id')} || '-9', NULL, 'unknown raw id', NULL
              FROM ev WHERE event_id % 20 = 3"""),
        "registry_as_of": w(f"""SELECT request_id, device_type, serial_no, inverter_temp FROM rd
            UNION ALL SELECT request_id, CASE WHEN kind = 'click' THEN 'Inv' ELSE 'foo_device' END,
              CASE WHEN kind = 'click' THEN 'UNKNOWN' ELSE '' END,
              CASE WHEN kind = 'click' THEN {_d('k * 10 + 5')} / {_d(10)} ELSE {_d('k')} END
            FROM obj WHERE ((kind = 'click' AND event_id % 25 = 3) OR kind = 'error')
              AND received_at >= {_ts(QS.RETENTION_CUTOFF)}"""),
        "stream_dedupe": w("SELECT raw_id, processed, error, CAST(attempts AS INTEGER) AS attempts FROM cur"),
        "batch_stats": w("SELECT CAST(2 AS BIGINT) AS batches, count(*) AS records FROM pay"),
        "stream_flush": w(f"""SELECT (n - 1) // {QS.FLUSH_SIZE} AS flush, count(*) AS records,
              count(*) FILTER (WHERE outcome = 'reading') AS readings,
              count(*) FILTER (WHERE outcome = 'reject') AS rejects,
              count(*) FILTER (WHERE outcome = 'duplicate') AS duplicates
            FROM (SELECT outcome, row_number() OVER (ORDER BY received_at, raw_id) AS n FROM outc) GROUP BY 1"""),
        "stream_rate": w("""SELECT time_bucket(INTERVAL '5 seconds', received_at) AS window_start,
            count(*) AS received, count(*) / 5.0::DOUBLE AS received_per_sec FROM pay GROUP BY 1"""),
    }
