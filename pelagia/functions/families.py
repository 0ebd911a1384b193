"""The single-line record families and the Iridium event payload, as expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pelagia.functions.lines import artifact_name, extract, severity, strip, whole

#: Message shapes of the published line families.
_N = r"([+-]?\d+)"
PRESSURE = (
    (rf"\bP\s*{_N}mbar,\s*T\s*{_N}mdegC\b", ("pressure_mbar", "temperature_mdegc")),
    (rf"^P\s*{_N}mbar$", ("pressure_mbar",)),
    (rf"\b{_N}dbar,\s*{_N}degC\b", ("pressure_dbar", "temperature_degc")),
    (rf"\binternal pressure\s+{_N}Pa\b", ("internal_pressure_pa",)),
    (rf"\bPint\s+{_N}Pa\b", ("internal_pressure_pa",)),
    (rf"\bPext\s+{_N}mbar\s+\(rng\s+{_N}mbar\)", ("external_pressure_mbar", "external_pressure_range_mbar")),
)
PRESSURE_FIELDS = ("pressure_mbar", "temperature_mdegc", "pressure_dbar", "temperature_degc", "internal_pressure_pa", "external_pressure_mbar", "external_pressure_range_mbar")
BATTERY = (
    ("voltage_current", rf"(?i)\bbattery\s+{_N}mV,\s+{_N}uA\b", ("voltage_mv", "current_ua")),
    ("vbat_summary", rf"(?i)\bVbat\s+{_N}mV\s+\(min\s+{_N}mV\)", ("voltage_mv", "minimum_voltage_mv")),
)
POSITION = r"(?i)(?:Latitude\s*:\s*)?([NS]\d+deg\d+(?:\.\d+)?mn)\s*,\s*(?:Longitude\s*:\s*)?([EW]\d+deg\d+(?:\.\d+)?mn)"
HDOP, VDOP = (rf"(?i)\b{x}\s+([+-]?\d+(?:\.\d+)?)" for x in ("hdop", "vdop"))
GPSACK, GPSOFF = r"\$?GPSACK:([^;]+)", r"\$?GPSOFF:([+-]?\d+)"
ACQUISITION = {"acq started": ("started", "transition"), "acq stopped": ("stopped", "transition"), "acq already started": ("started", "assertion"), "acq already stopped": ("stopped", "assertion")}
ASCENT = {"ascent request accepted": "accepted", "ascent request rejected": "rejected"}
_FILE = r"(\d{2,4}/[A-Za-z0-9]+\.(?:MER|LOG|BIN))"
COMMAND = r"^\$([A-Za-z0-9_]+)(?::([^;]*))?;$"
#: In order of precedence: kind, pattern, integer fields by group, artifact group.
EVENTS = (
    ("session_start", r"(?i)^Iridium\.\.\.$", {}, 0),
    ("connection", rf"(?i)connected in (\d+)s,\s*signal quality {_N}", {"connection_duration_s": 1, "signal_quality": 2}, 0),
    ("connection_failure", rf"(?i)failed to connect #(\d+),\s*code {_N},\s*net {_N},\s*qual {_N},\s*dial {_N}", {"connect_attempt": 1, "failure_code": 2, "network": 3, "signal_quality": 4, "dial_attempt": 5}, 0),
    ("no_connection", r"(?i)no connection after (\d+)s", {"connection_duration_s": 1}, 0),
    ("command", COMMAND, {}, 0),
    ("command_summary", r"(?i)(\d+) cmd(?:\(s\)|s)? received", {"received_command_count": 1}, 0),
    ("remote_command_end", r"(?i)prompt received,\s*remote cmd end", {}, 0),
    ("upload_artifact", rf'(?i)"{_FILE}" uploaded at (\d+)bytes/s', {"rate_bytes_per_s": 2}, 1),
    ("upload_resume", rf"(?i)peer ask to resume {_FILE}(?: \((\d+)bytes\))? from byte (\d+)", {"artifact_size_bytes": 2, "byte_offset": 3}, 1),
    ("upload_progress_artifact", rf"(?i)(\d+) bytes in {_FILE}", {"byte_count": 1}, 2),
    ("upload_error_artifact", rf"(?i)<ERR>\s*upload\b.*?{_FILE}", {}, 1),
    ("upload_retry", r"(?i)transfer interrupted\s*,?\s*retry(?: now)?", {}, 0),
    ("upload_failed", r"(?i)<ERR>\s*uploading failed", {}, 0),
    ("upload_session_summary", r"(?i)(\d+) file(?:\(s\)|s)? uploaded", {"uploaded_file_count": 1}, 0),
    ("disconnect", r"(?i)disconnected after (\d+)s", {"disconnect_duration_s": 1}, 0),
    ("upload_batch", r"(?i)^Upload data files\.\.\.$", {}, 0),
)
#: What a message of the kind holds, lower-cased: looked for before the pattern is tried.
EVENT_HINTS = {
    "session_start": "iridium...", "connection": "connected in ", "connection_failure": "failed to connect #", "no_connection": "no connection after ", "command": "$",
    "command_summary": " cmd", "remote_command_end": "prompt received,", "upload_artifact": "uploaded at ", "upload_resume": "peer ask to resume ", "upload_progress_artifact": " bytes in ",
    "upload_error_artifact": "<err>", "upload_retry": "transfer interrupted", "upload_failed": "uploading failed", "upload_session_summary": " file", "disconnect": "disconnected after ", "upload_batch": "upload data files...",
}
EVENT_FIELDS = tuple(dict.fromkeys(f for _, _, fields, _ in EVENTS for f in fields))
#: The kinds that have each payload field; other kinds lack its key in JSON.
KINDS_OF = {f: tuple(kind for kind, _, fields, _ in EVENTS if f in fields) for f in EVENT_FIELDS} | {
    "referenced_artifact": tuple(kind for kind, _, _, group in EVENTS if group), "command_name": ("command",), "command_payload": ("command",),
}
FAMILIES = ("acquisition", "ascent_request", "gps", "pressure_temperature", "battery")


def collapsed(message: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(message), r"(?U)\s+", " "))


def event_kind(message: Column, own: Column | None = None, low: Column | None = None) -> Column:
    """The Iridium kind of a message; session_line if it is no event. ``own`` is the stripped message, ``low`` that in lower case, where they are columns already."""
    own = strip(message) if own is None else own
    low = F.lower(own) if low is None else low
    kind = None
    for name, pattern, _, _ in EVENTS:
        value: Column | str = name
        if name == "command":
            value = F.when(F.upper(F.regexp_extract(own, COMMAND, 1)).isin("GPSACK", "GPSOFF"), "session_line").otherwise("command")
        fits = low.contains(EVENT_HINTS[name]) & own.rlike(pattern)
        kind = F.when(fits, value) if kind is None else kind.when(fits, value)
    return kind.otherwise("session_line")


def event_fields(own: Column, kind: Column) -> dict[str, Column]:
    """Every kind-specific field of a stripped message; null where the kind has none."""
    fields: dict[str, Column] = {}
    for field in EVENT_FIELDS:
        made = F.lit(None).cast("long")
        for name, pattern, groups, _ in EVENTS:
            if field in groups:
                made = F.when(kind == name, whole(own, pattern, groups[field])).otherwise(made)
        fields[field] = made
    artifact = F.lit(None).cast("string")
    for name, pattern, _, group in EVENTS:
        if group:
            artifact = F.when(kind == name, artifact_name(extract(own, pattern, group))).otherwise(artifact)
    command = F.when(kind == "command", extract(own, COMMAND, 1))
    payload = F.when((kind == "command") & own.contains(":"), F.regexp_extract(own, COMMAND, 2))
    return fields | {"referenced_artifact": artifact, "command_name": command, "command_payload": payload}


def event_payload(message: Column, kind: Column) -> Column:
    """``event_fields`` as a struct."""
    return F.struct(*(c.alias(f) for f, c in event_fields(strip(message), kind).items()))


def gps_kind(message: Column) -> Column:
    # patterns find their place anywhere, so the message needs no strip
    own = message
    return (
        F.when(own.contains("GPS fix..."), "fix_attempt").when(own.rlike(POSITION), "fix_position").when(own.rlike(HDOP) | own.rlike(VDOP), "dop")
        .when(own.rlike(GPSACK), "gps_ack").when(own.rlike(GPSOFF), "gps_off")
    )


def gps_values(message: Column) -> Column:
    """The matched texts by name; null for a fix attempt."""
    own, kind = strip(message), gps_kind(message)
    pick = lambda names, *kinds: [(F.lit(n), F.when(kind.isin(*kinds), extract(own, p, g))) for n, p, g in names]
    pairs = pick((("latitude", POSITION, 1), ("longitude", POSITION, 2)), "fix_position") + pick((("hdop", HDOP, 1), ("vdop", VDOP, 1)), "dop")
    pairs += pick((("gpsack", GPSACK, 1),), "gps_ack") + pick((("gpsoff", GPSOFF, 1),), "gps_off")
    every = F.create_map(*(x for p in pairs for x in p))
    return F.when(kind.isNotNull() & (kind != "fix_attempt"), F.map_filter(every, lambda _, v: v.isNotNull()))


def pressure_values(message: Column) -> dict[str, Column]:
    """Integer fields; the first pattern that matches fills its own."""
    first = F.lit(None).cast("int")
    for n, (pattern, _) in reversed(list(enumerate(PRESSURE))):
        first = F.when(message.rlike(pattern), n).otherwise(first)
    out = {}
    for field in PRESSURE_FIELDS:
        made = F.lit(None).cast("long")
        for n, (pattern, names) in enumerate(PRESSURE):
            if field in names:
                made = F.when(first == n, whole(message, pattern, names.index(field) + 1)).otherwise(made)
        out[field] = made
    return out


def battery_values(message: Column) -> dict[str, Column]:
    kind = F.when(message.rlike(BATTERY[0][1]), BATTERY[0][0]).when(message.rlike(BATTERY[1][1]), BATTERY[1][0])
    out = {"battery_record_kind": kind}
    for field in ("voltage_mv", "current_ua", "minimum_voltage_mv"):
        made = F.lit(None).cast("long")
        for name, pattern, names in BATTERY:
            if field in names:
                made = F.when(kind == name, whole(message, pattern, names.index(field) + 1)).otherwise(made)
        out[field] = made
    return out


def matches(message: Column) -> Column:
    """Array of the specific families that a message fits."""
    fits = {
        "acquisition": collapsed(message).isin(*ACQUISITION),
        "ascent_request": collapsed(message).isin(*ASCENT),
        "gps": gps_kind(message).isNotNull(),
        "pressure_temperature": F.greatest(*(message.rlike(p) for p, _ in PRESSURE)),
        "battery": F.greatest(*(message.rlike(p) for _, p, _ in BATTERY)),
    }
    return F.filter(F.array(*(F.when(fits[f], f) for f in FAMILIES)), lambda f: f.isNotNull())


def classify(message: Column) -> Column:
    """The one family that fits, 'unclassified' for none; two or more fail the job."""
    return classified(matches(message), message)


def classified(found: Column, message: Column) -> Column:
    """``classify`` for an array of matches that is a column already, so that its patterns run once."""
    clash = F.raise_error(F.concat(F.lit("line fits several families: "), F.array_join(found, ", "), F.lit(": "), message)).cast("string")
    return F.when(F.size(found) == 0, "unclassified").when(F.size(found) == 1, found[0]).otherwise(clash)


def family_fields(family: str, message: Column) -> dict[str, Column]:
    """The family's own columns."""
    if family == "acquisition":
        own = collapsed(message)
        state, evidence = (F.create_map(*(F.lit(x) for k, v in ACQUISITION.items() for x in (k, v[i])))[own] for i in (0, 1))
        return {"acquisition_state": state, "acquisition_evidence_kind": evidence}
    if family == "ascent_request":
        return {"ascent_request_state": F.create_map(*(F.lit(x) for kv in ASCENT.items() for x in kv))[collapsed(message)]}
    if family == "gps":
        return {"gps_record_kind": gps_kind(message), "raw_values": gps_values(message)}
    if family == "pressure_temperature":
        return pressure_values(message)
    if family == "battery":
        return battery_values(message)
    reason = F.when(F.col("rollover_target").isNotNull(), "rollover_banner").otherwise("no_family_match")
    return {"switched_to_log_file": artifact_name(F.col("rollover_target"), ".LOG"), "severity": severity(message), "unclassified_reason": reason}


def family_rows(lines: DataFrame, family: str) -> DataFrame:
    """One single-line family from classified lines (``family`` column)."""
    own = lines.where(F.col("family") == family)
    return own.withColumns(family_fields(family, F.col("message")))
