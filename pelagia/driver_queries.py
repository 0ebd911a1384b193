"""Queries over the driver's tables, with their DuckDB oracles.

Instrument logs are synthesised from ``events`` by one SQL text that both
engines run: a user is a file, the order of its events that of its lines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pelagia.functions.families import EVENT_FIELDS, battery_values, classified, event_fields, event_kind, family_fields, gps_kind, matches, pressure_values
from pelagia.functions.lines import artifact_name, explode_lines, format_time, iso_time, log_epoch_time, parse_lines, severity, strip
from pelagia.operators.episodes import build_episodes, ctd_samples, group_episodes, iridium_sessions
from pelagia.operators.mer import attributes, events, judged, sections
from pelagia.operators.state import actions, diff_sources, snapshot_id
from pelagia.plans.audit import audit_family, sample_rows
from pelagia.plans.metrics import mer_summary as summary_of_mer
from pelagia.plans.metrics import value_counts
from pelagia.plans.normalize import accounted, grouped_lines, mer_tables
from pelagia.sources.files import authoritative, instrument, with_provenance

_V = "CAST(CAST(floor(value) AS BIGINT) AS STRING)"
_MESSAGES = (
    "'[MRMAID,123]acq started'", "'[MRMAID]ACQ  already stopped'", "'[SURFIN,007]Ascent request accepted'", "'[SURF,0022]GPS fix...'",
    f"'[SURF,0394]N35deg19.262mn, E139deg' || {_V} || '.043mn'", f"'[SURF]hdop 1.' || {_V} || ', vdop 1.9'", f"'[PRESS,0038]P' || {_V} || 'mbar,T-25120mdegC'",
    f"'[MRMAID,0152]' || {_V} || 'dbar, -27degC'", f"'[MONITR,0461]internal pressure ' || {_V} || 'Pa'", f"'[MAIN,0013]Pext -' || {_V} || 'mbar (rng 300mbar)'",
    f"'[MAIN,0013]Vbat ' || {_V} || 'mV (min 13665mV)'", f"'[MONITR,0082]battery ' || {_V} || 'mV,   19840uA'", "'[SURF,0021]Iridium...'",
    f"'[SURF,0029]connected in ' || {_V} || 's, signal quality 4'", "'[ZTX,0038]$TIME:12;'", "'[ZTX]$GPSACK:+48,+10;'", f"'[ZTX]' || {_V} || ' cmd(s) received'",
    f"'[UPLOAD,0231]\"07/5F5F98DC.MER\" uploaded at ' || {_V} || 'bytes/s'", f"'[UPLOAD]peer ask to resume 07/5F5F.LOG (' || {_V} || 'bytes) from byte 4294967294'",
    f"'[UPLOAD,0218]' || {_V} || ' file(s) uploaded'", f"'[SURF,0025]disconnected after ' || {_V} || 's'", "'[TESTMD,0053]enter test mode'", "'[TESTMD]\"quit\"'",
    "'[SBE61,0420]P 100, T 200, S 300'", "'[STAGE,0091]Stage [3] surfacing 1000mbar'", "'    bypass 1000 20000'", "'    stage[0] 150000mbar'", "'*** switching to 0007/5F5F98DC ***'",
    f"'<WARN>[SURF,0292]timeout ' || {_V}", "'<ERR>[PUMP]pump error'", f"'[PUMP,0016]pump during ' || {_V} || 'ms'", "'not a known line'",
)
_CASE = "CASE event_id % 33 " + " ".join(f"WHEN {i} THEN {m}" for i, m in enumerate(_MESSAGES)) + " ELSE '' END"
LINES_SQL = f"""
SELECT 'log' || CAST(user_id AS STRING) AS source_path, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS line_number,
  CASE WHEN event_id % 33 = 32 THEN '' ELSE CAST(1600000000 + event_id AS STRING) || ':' || {_CASE} END AS raw_line
FROM events
"""
_L = f"lines AS ({LINES_SQL})"
_TAGGED = r"^(.+?):\[([^\]]+)\](.*)$"
_WRAPPED = r"^(.+?):(<(?:ERR|WARN|WRN)>)\[([^\]]+)\](.*)$"
_P = rf"""{_L}, parsed AS (
  SELECT source_path, line_number, raw_line, regexp_matches(raw_line, '{_TAGGED}') OR regexp_matches(raw_line, '{_WRAPPED}') AS tagged,
    CASE WHEN regexp_matches(raw_line, '{_TAGGED}') THEN regexp_extract(raw_line, '{_TAGGED}', 2) ELSE nullif(regexp_extract(raw_line, '{_WRAPPED}', 3), '') END AS tag,
    CASE WHEN regexp_matches(raw_line, '{_TAGGED}') THEN regexp_extract(raw_line, '{_TAGGED}', 3)
         WHEN regexp_matches(raw_line, '{_WRAPPED}') THEN regexp_extract(raw_line, '{_WRAPPED}', 2) || regexp_extract(raw_line, '{_WRAPPED}', 4) END AS message
  FROM lines), t AS (SELECT *, trim(split_part(tag, ',', 1)) AS subsystem, nullif(trim(split_part(tag, ',', 2)), '') AS code FROM parsed)"""
_N = r"([+-]?\d+)"
_FAMILY = rf"""CASE WHEN lower(regexp_replace(trim(message), '\s+', ' ', 'g')) IN ('acq started', 'acq stopped', 'acq already started', 'acq already stopped') THEN 'acquisition'
  WHEN lower(message) IN ('ascent request accepted', 'ascent request rejected') THEN 'ascent_request'
  WHEN message LIKE '%GPS fix...%' OR regexp_matches(message, '[NS]\d+deg\d+(\.\d+)?mn\s*,\s*[EW]\d+deg\d+(\.\d+)?mn') OR regexp_matches(message, '\b[hv]dop\s+[+-]?\d') OR regexp_matches(message, 'GPSACK:[^;]') OR regexp_matches(message, 'GPSOFF:[+-]?\d') THEN 'gps'
  WHEN regexp_matches(message, '\bP\s*{_N}mbar,\s*T\s*{_N}mdegC\b') OR regexp_matches(message, '^P\s*{_N}mbar$') OR regexp_matches(message, '\b{_N}dbar,\s*{_N}degC\b') OR regexp_matches(message, '\b(internal pressure|Pint)\s+{_N}Pa\b') OR regexp_matches(message, '\bPext\s+{_N}mbar\s+\(rng') THEN 'pressure_temperature'
  WHEN regexp_matches(message, '(?i)\b(battery|Vbat)\s+{_N}mV') THEN 'battery' ELSE 'unclassified' END"""
_KIND = r"""CASE WHEN regexp_matches(m, '(?i)^Iridium\.\.\.$') THEN 'session_start' WHEN regexp_matches(m, '(?i)connected in \d+s,\s*signal quality') THEN 'connection'
  WHEN regexp_matches(m, '^\$(GPSACK|GPSOFF)(:[^;]*)?;$') THEN 'session_line' WHEN regexp_matches(m, '^\$\w+(:[^;]*)?;$') THEN 'command'
  WHEN regexp_matches(m, '\d+ cmd(\(s\)|s)? received') THEN 'command_summary' WHEN regexp_matches(m, '"[0-9]{2,4}/\w+\.(MER|LOG|BIN)" uploaded at \d+bytes/s') THEN 'upload_artifact'
  WHEN m LIKE 'peer ask to resume%' THEN 'upload_resume' WHEN regexp_matches(m, '\d+ file(\(s\)|s)? uploaded') THEN 'upload_session_summary'
  WHEN regexp_matches(m, 'disconnected after \d+s') THEN 'disconnect' ELSE 'session_line' END"""


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_lines(spark.sql(LINES_SQL.replace("FROM events", "FROM {events}"), events=_read(spark, sf_dir, "events")))


def _tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir).where("tagged")


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tagged lines with their family; every pattern runs once a line."""
    rows = _tagged(spark, sf_dir).withColumn("found", matches(F.col("message")))
    return rows.withColumn("family", classified(F.col("found"), F.col("message")))


def line_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_lines(_read(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("content")))


def tagged_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tagged(spark, sf_dir).select("source_path", "line_number", "time_text", "subsystem", "code", "message", "record_time", log_epoch_time(F.col("raw_line")).alias("log_epoch_time"))


def classify_single_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir).select("source_path", "line_number", "family")


def classify_exclusivity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir).groupBy(F.size("found").cast("long").alias("n_families")).agg(F.count("*").alias("n_lines"))


def family_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir).groupBy("family").agg(F.count("*").alias("n_records"))


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir).groupBy("family").agg(F.count("*").alias("n_rows"), F.countDistinct("source_path").alias("n_files"))


def pressure_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.col("message")
    rows = _classified(spark, sf_dir).where("family = 'pressure_temperature'")
    return rows.select("source_path", "line_number", *(c.cast("string").alias(n) for n, c in pressure_values(m).items()))


def battery_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.col("message")
    return _classified(spark, sf_dir).where("family = 'battery'").select("source_path", "line_number", *(c.cast("string").alias(n) for n, c in battery_values(m).items()))


def gps_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tagged(spark, sf_dir).groupBy(gps_kind(F.col("message")).alias("gps_record_kind")).agg(F.count("*").alias("n")).where("gps_record_kind is not null")


def severities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tagged(spark, sf_dir).groupBy(severity(F.col("message")).alias("severity")).agg(F.count("*").alias("n"))


def artifact_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = artifact_name(F.col("rollover_target"), ".LOG")
    return _lines(spark, sf_dir).where("rollover_target is not null").select("source_path", "line_number", target.alias("switched_to_log_file"))


def iridium_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _tagged(spark, sf_dir).withColumn("own", strip(F.col("message"))).withColumn("kind", event_kind(F.col("message"), F.col("own"))).where("kind <> 'session_line'")
    rows = rows.withColumn("p", F.struct(*(c.alias(f) for f, c in event_fields(F.col("own"), F.col("kind")).items())))
    fields = ("connection_duration_s", "signal_quality", "received_command_count", "byte_offset", "artifact_size_bytes", "rate_bytes_per_s", "uploaded_file_count", "disconnect_duration_s")
    assert set(fields) <= set(EVENT_FIELDS)
    return rows.select("source_path", "line_number", F.col("kind").alias("iridium_event_kind"), *(F.col(f"p.{f}").cast("string").alias(f) for f in fields), "p.referenced_artifact", "p.command_name", "p.command_payload")


def episodes_latch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_episodes(_lines(spark, sf_dir), keep=()).where("episode is not null").select("source_path", "line_number", "episode", "episode_index")


def episode_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = build_episodes(group_episodes(_lines(spark, sf_dir)))
    return rows.select("source_path", "episode", "episode_index", "line_start_index", "line_end_index", F.size("lines").cast("long").alias("n_lines"), F.array_join("raw_lines", "\n").alias("raw_text"))


def topk_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _classified(spark, sf_dir).where("family = 'unclassified'")
    counts = rows.groupBy("subsystem", F.coalesce("code", F.lit("")).alias("code"), "message").agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "subsystem", "code", "message").limit(10)


def log_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of states and kinds with the place of the first record of each."""
    rows, found = _classified(spark, sf_dir), None
    for family in ("acquisition", "ascent_request", "gps", "battery"):
        own = rows.where(F.col("family") == family).withColumns(family_fields(family, F.col("message")))
        one = value_counts(own.withColumn("source_line_number", F.col("line_number")), f"log_{family}")
        found = one if found is None else found.unionByName(one)
    return found


def iso_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates written in four forms of ISO 8601 and read again."""
    day, k = F.col("o_orderdate").cast("date"), F.col("o_orderkey")
    week = F.concat(F.expr("extract(YEAROFWEEK FROM day)").cast("string"), F.lit("-W"), F.lpad(F.weekofyear("day").cast("string"), 2, "0"), F.lit("-"), (F.weekday("day") + 1).cast("string"))
    basic = F.date_format("day", "yyyyMMdd")
    text = F.when(k % 4 == 0, F.concat(week, F.lit("T07:08:09,5+01:30"))).when(k % 4 == 1, F.concat(basic, F.lit("T224722"))).when(k % 4 == 2, F.concat(basic, F.lit(" 22:47-0100"))).otherwise(F.date_format("day", "yyyy-MM-dd"))
    return _read(spark, sf_dir, "orders").withColumn("day", day).select("o_orderkey", format_time(iso_time(text)).alias("record_time"))


def attr_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "pages").select("page_id", attributes(F.regexp_extract("html", r"<(html [^>]*)>", 1)).alias("a"))
    return rows.select("page_id", F.explode("a").alias("name", "content"))


def section_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sections(spark, sf_dir).select("source_path", "section", "line_pos", "tag", "line")


def source_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "orders").select((F.col("o_custkey") % 50).cast("string").alias("instrument_serial"), F.col("o_orderkey").cast("string").alias("source_file"), F.when(F.col("o_orderkey") % 3 == 0, "mer").otherwise("log").alias("source_kind"), F.col("o_orderkey").alias("size_bytes"), F.col("o_orderstatus").alias("content_hash"), F.col("o_orderkey").alias("k"))
    old = rows.where("k % 7 <> 0").withColumn("content_hash", F.when(F.col("k") % 11 == 0, "X").otherwise(F.col("content_hash")))
    return diff_sources(old, rows.where("k % 13 <> 0")).select("instrument_serial", "source_file", "source_kind", "change_kind")


def source_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("instrument_serial"), F.col("o_orderkey").cast("string").alias("source_file"), F.when(F.col("o_orderkey") % 3 == 0, "mer").otherwise("log").alias("source_kind"), F.col("o_orderstatus").alias("content_hash"), F.col("o_orderkey").alias("k"))
    old = rows.where("k % 5 <> 0").withColumn("content_hash", F.when(F.col("k") % 11 == 0, "X").otherwise(F.col("content_hash")))
    return actions(diff_sources(old, rows)).select("instrument_serial", "family", "action")


def authority_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents stand for files: their language is the kind, their source the prefix."""
    kind = F.when(F.col("lang") == "de", "BIN").otherwise("LOG")
    path = F.concat(F.lit("/x/"), F.col("source"), F.lit("_"), F.floor(F.col("doc_id") / 3).cast("string"), F.lit("."), kind)
    docs = _read(spark, sf_dir, "documents").select("doc_id", path.alias("source_path"), F.col("text").alias("content"))
    return authoritative(with_provenance(docs)).where("source_kind = 'log'").select("doc_id")


#: MER files written from events by one SQL text for both engines: a user is a file.
_MER = """SELECT user_id, 'mer' || CAST(user_id AS STRING) AS source_path,
  '<ENVIRONMENT>' || chr(10) || chr(13) || chr(9) || '<SOFTWARE 2.1344' || CASE WHEN user_id % 3 = 0 THEN ' STANFORD' ELSE '' END || ' />' || chr(10) || chr(13) || chr(9) || '<DIVE ID=' || CAST(user_id AS STRING) || ' EVENTS=' || CAST(count(*) AS STRING) || ' />' || chr(10) || chr(13) || chr(9) || '<SAMPLE MIN=-' || CAST(user_id AS STRING) || ' MAX=7 />' || chr(10) || chr(13) || '</ENVIRONMENT>' || chr(13) || chr(10)
  || '<PARAMETERS>' || chr(10) || chr(13) || chr(9) || '<ADC GAIN=' || CAST(user_id % 5 AS STRING) || ' BUFFER=ON />' || chr(10) || chr(13) || chr(9) || '<STANFORD_PROCESS DURATION_h=' || CAST(user_id % 9 AS STRING) || ' WINDOW_LEN=1024 />' || CASE WHEN user_id % 2 = 0 THEN '<x' ELSE '' END || chr(10) || chr(13) || '</PARAMETERS>' || chr(13) || chr(10)
  || (CASE WHEN user_id % 4 = 0 THEN '' ELSE '<EVENT>' || chr(10) || '<INFO DATE=2024-01-02T03:04:05 ROUNDS=' || CAST(count(*) AS STRING) || ' />' || chr(10) || '<FORMAT ENDIANNESS=LITTLE BYTES_PER_SAMPLE=2 LENGTH=' || CAST(user_id % 6 AS STRING) || ' /><DATA>' || chr(10) || chr(13) || repeat('ab', CAST(user_id % 7 AS INT)) || chr(10) || chr(13) || chr(9) || '</DATA></EVENT>' || chr(10) END) AS content
  FROM events GROUP BY user_id"""


def _mer_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_MER.replace("FROM events", "FROM {events}"), events=_read(spark, sf_dir, "events")).withColumn("content", F.encode("content", "UTF-8"))


def _sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sections(_mer_files(spark, sf_dir))


def mer_environment(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mer_tables(_mer_files(spark, sf_dir)).families["mer_environment"]
    return rows.select("source_path", "environment_kind", "software", *(F.col(c).cast("string").alias(c) for c in ("dive_id", "dive_declared_event_count", "sample_min", "sample_max")))


def mer_parameter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mer_tables(_mer_files(spark, sf_dir)).families["mer_parameter"]
    return rows.select("source_path", "parameter_kind", "adc_buffer", *(F.col(c).cast("string").alias(c) for c in ("adc_gain", "stanford_process_duration_h", "stanford_process_window_len")))


def mer_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mer_tables(_mer_files(spark, sf_dir)).families["mer_event"]
    return rows.select("source_path", "block_index", "rounds", "date", "data_payload_nbytes", "expected_payload_nbytes", "payload_length_matches_expected", "encoded_payload")


def file_param_attach(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mer_tables(_mer_files(spark, sf_dir)).families["mer_event"]
    return rows.select("source_path", F.col("stanford_psd_processing.duration_h").cast("string").alias("duration_h"), "stanford_psd_processing.raw_parameter_line")


def mer_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mer_tables(_mer_files(spark, sf_dir)).quarantine.select("source_path", "block_kind", "raw_block")


#: Some files with tags and keys that no record knows.
_ODD = """SELECT source_path, CASE WHEN user_id % 10 = 1 THEN replace(replace(content, '<ADC ', '<ODDTAG '), '<DIVE ', '<EXTRA ') WHEN user_id % 10 = 3 THEN replace(content, 'ROUNDS=', 'BADKEY=') ELSE content END AS content FROM mer"""


def mer_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the MER files hold: files, events, kinds, and tags and keys that are unknown."""
    rows = spark.sql(f"WITH mer AS ({_MER.replace('FROM events', 'FROM {events}')}) {_ODD}", events=_read(spark, sf_dir, "events"))
    files = rows.withColumn("content", F.encode("content", "UTF-8"))
    return summary_of_mer(files, sections(files), judged(events(files), strict=False))


def content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("/x/"), F.col("source"), F.lit("_"), F.col("doc_id").cast("string"), F.lit(".LOG")).alias("source_path"), F.col("text").alias("content"))
    return with_provenance(docs).select("doc_id", "source_file", "source_kind", "prefix", "source_sha256", "source_id")


def log_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source lines by the table that holds them, and those in none or several: there must be none of these."""
    lines = spark.sql(LINES_SQL.replace("FROM events", "FROM {events}"), events=_read(spark, sf_dir, "events"))
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line_number", "raw_line"))), lambda x: x["raw_line"]), "\n")
    files = lines.groupBy("source_path").agg(F.concat(text, F.lit("\n")).alias("content"))
    return accounted(grouped_lines(files, keep=()))


def snapshot_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tree's listing, a line a file, is one value by definition."""
    rows = _read(spark, sf_dir, "nation").select(F.col("n_name").alias("path"), F.col("n_nationkey").alias("byte_size"), F.sha2("n_name", 256).alias("sha256"))
    return snapshot_id(rows)


def instrument_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    serial = F.concat(F.lit("452."), F.lpad((F.col("s_suppkey") % 1000).cast("string"), 3, F.lit("0")), F.lit("-"), F.when(F.col("s_suppkey") % 2 == 0, "P").otherwise("R"), F.lit("-"), F.lpad((F.col("s_suppkey") % 100).cast("string"), 2, F.lit("0")))
    return _read(spark, sf_dir, "supplier").select("s_suppkey", instrument(serial).alias("i")).select("s_suppkey", "i.serial", "i.instrument_id")


def audit_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of battery rows of which every 17th holds a wrong voltage."""
    m = F.col("message")
    rows = _classified(spark, sf_dir).where("family = 'battery'").withColumns(battery_values(m)).withColumn("voltage_mv", F.when(F.col("line_number") % 17 == 0, F.col("voltage_mv") + 1).otherwise(F.col("voltage_mv")))
    stored = rows.select(F.lit("x").alias("instrument_serial"), F.col("source_path").alias("source_file"), F.col("line_number").alias("source_line_number"), "record_time", log_epoch_time(F.col("raw_line")).alias("log_epoch_time"), "subsystem", "code", "message", *battery_values(m).keys(), "raw_line")
    return audit_family(stored, "log_battery").select("source_file", "place", "issue")


def _without_first(field: str) -> Callable[[Column, Column], Column]:
    return lambda entry, place: F.when(place == 0, entry.withField(field, F.lit(None))).otherwise(entry)


def audit_grouped_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of all Iridium and CTD episodes; of every 5th by its first line one event's or sample's field is wrong."""
    grouped, found = build_episodes(group_episodes(_lines(spark, sf_dir))), None
    wrong = F.col("line_start_index") % 5 == 0
    for name, made, column, field in (("log_iridium", iridium_sessions(grouped), "iridium_events", "message"), ("log_ctd", ctd_samples(grouped), "ctd_samples", "temperature_mdegc_tenths")):
        changed = F.transform(column, _without_first(field))
        rows = made.withColumn(column, F.when(wrong, changed).otherwise(F.col(column))).withColumns({"instrument_serial": F.lit("x"), "source_file": F.col("source_path")})
        one = audit_family(rows, name)
        found = one if found is None else found.unionByName(one)
    return found.select("family", "source_file", "place", "issue")


def audit_mer_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of all MER rows: of every 5th user's file the dive, the gain and the event's rounds are wrong."""
    made, found = mer_tables(_mer_files(spark, sf_dir)).families, None
    wrong = F.regexp_extract("source_path", r"\d+", 0).cast("long") % 5 == 0
    for name, column, other in (("mer_environment", "dive_id", F.col("dive_id") + 1), ("mer_parameter", "adc_gain", F.col("adc_gain") + 1), ("mer_event", "rounds", F.lit("odd"))):
        rows = made[name].withColumn(column, F.when(wrong, other).otherwise(F.col(column))).withColumns({"instrument_serial": F.lit("x"), "source_file": F.col("source_path")})
        one = audit_family(rows, name)
        found = one if found is None else found.unionByName(one)
    return found.select("family", "source_file", "issue")


def hash_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A seeded row of each of up to three files a family, of distinct instruments first: a country stands for an instrument, a customer for a file."""
    rows = _read(spark, sf_dir, "orders").join(_read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
    named = rows.select(F.col("c_mktsegment").alias("family"), F.col("c_nationkey").cast("string").alias("instrument_serial"), F.col("c_custkey").cast("string").alias("source_file"), F.col("o_orderkey").alias("place"))
    return sample_rows(named, 3, 7)


QUERIES = {f.__name__: f for f in (
    line_explode, tagged_parse, classify_single_line, classify_exclusivity, family_counts, inventory, pressure_fields, battery_fields, gps_kinds, severities,
    artifact_references, iridium_events, episodes_latch, episode_build, topk_patterns, attr_parse, section_extract, source_diff, source_actions,
    authority_antijoin, mer_environment, mer_parameter, mer_events, file_param_attach, mer_quarantine, content_hash, log_accounting, snapshot_digest, instrument_name,
    audit_findings, hash_sample, log_summary, mer_summary, iso_times, audit_grouped_findings, audit_mer_findings,
)}

#: An independent line-by-line automaton: each line extends the state of the one before it.
_WALK = rf"""WITH RECURSIVE {_P}, k AS (SELECT *, trim(coalesce(message, '')) AS m FROM t), f AS (
  SELECT source_path, line_number, raw_line, coalesce(subsystem, '') = 'TESTMD' AS test, lower(m) IN ('"q"', '"quit"') AND subsystem = 'TESTMD' AS quits,
    tagged AND {_KIND} <> 'session_line' AS event, tagged AND ({_KIND} <> 'session_line' OR regexp_matches(m, '^\$\w+(:[^;]*)?;$')) AS follows, m = 'Iridium...' AS opens, regexp_matches(m, 'disconnected after \d+s') AS ends,
    coalesce(subsystem, '') = 'SBE61' AS ctd, coalesce(subsystem, '') = 'STAGE' AS stage, regexp_matches(raw_line, ':\s*(bypass|stage\[0\])\s') AND NOT tagged AS par
  FROM k), a AS (
  SELECT source_path, CAST(0 AS BIGINT) AS line_number, CAST('' AS VARCHAR) AS raw_line, CAST('' AS VARCHAR) AS episode, CAST('' AS VARCHAR) AS nxt, false AS starts FROM (SELECT DISTINCT source_path FROM f)
  UNION ALL
  SELECT source_path, line_number, raw_line, episode, CASE WHEN (episode = 'testmode' AND quits) OR (episode = 'iridium' AND ends) THEN '' ELSE episode END,
    episode <> '' AND (episode <> was OR (episode = 'iridium' AND opens)) AS starts
  FROM (SELECT f.*, a.nxt AS was, CASE WHEN a.nxt = 'testmode' THEN 'testmode' WHEN a.nxt = 'iridium' AND follows THEN 'iridium' WHEN test THEN 'testmode'
      WHEN ctd OR (stage AND a.nxt = 'ctd') THEN 'ctd' WHEN event THEN 'iridium' WHEN par THEN 'parameter' ELSE '' END AS episode
    FROM a JOIN f ON f.source_path = a.source_path AND f.line_number = a.line_number + 1)
), e AS (SELECT source_path, line_number, raw_line, episode, CAST(sum(CAST(starts AS BIGINT)) OVER (PARTITION BY source_path, episode ORDER BY line_number) - 1 AS BIGINT) AS episode_index FROM a WHERE line_number > 0 AND episode <> '')"""
_INT = lambda pattern, group=1: f"CAST(TRY_CAST(nullif(regexp_extract(message, '{pattern}', {group}), '') AS BIGINT) AS VARCHAR)"
_PT, _DB = rf"\bP\s*{_N}mbar,\s*T\s*{_N}mdegC\b", rf"\b{_N}dbar,\s*{_N}degC\b"
_DIFF = """SELECT coalesce(n.s, o.s) AS instrument_serial, coalesce(n.f, o.f) AS source_file, coalesce(n.k, o.k) AS source_kind,
  CASE WHEN o.f IS NULL THEN 'new' WHEN n.f IS NULL THEN 'removed' WHEN n.h = o.h THEN 'unchanged' ELSE 'changed' END AS change_kind FROM o FULL OUTER JOIN n ON n.s = o.s AND n.f = o.f"""
ORACLE_SQL = {
    "line_explode": r"SELECT doc_id, CAST(i AS BIGINT) AS line_number, parts[i] AS raw_line FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM (SELECT doc_id, string_split_regex(regexp_replace(text, '(\r\n|\r|\n)$', ''), '\r\n|\r|\n') AS parts FROM documents WHERE text <> ''))",
    "tagged_parse": f"WITH {_P} SELECT source_path, line_number, split_part(raw_line, ':', 1) AS time_text, subsystem, code, message, strftime(make_timestamp(CAST(split_part(raw_line, ':', 1) AS BIGINT) * 1000000), '%Y-%m-%dT%H:%M:%S.%f') || 'Z' AS record_time, split_part(raw_line, ':', 1) AS log_epoch_time FROM t WHERE tagged",
    "classify_single_line": f"WITH {_P} SELECT source_path, line_number, {_FAMILY} AS family FROM t WHERE tagged",
    "classify_exclusivity": f"WITH {_P} SELECT CAST(CASE WHEN family = 'unclassified' THEN 0 ELSE 1 END AS BIGINT) AS n_families, count(*) AS n_lines FROM (SELECT {_FAMILY} AS family FROM t WHERE tagged) GROUP BY 1",
    "family_counts": f"WITH {_P} SELECT {_FAMILY} AS family, count(*) AS n_records FROM t WHERE tagged GROUP BY 1",
    "inventory": f"WITH {_P} SELECT {_FAMILY} AS family, count(*) AS n_rows, count(DISTINCT source_path) AS n_files FROM t WHERE tagged GROUP BY 1",
    "pressure_fields": rf"WITH {_P} SELECT source_path, line_number, {_INT(_PT)} AS pressure_mbar, {_INT(_PT, 2)} AS temperature_mdegc, {_INT(_DB)} AS pressure_dbar, {_INT(_DB, 2)} AS temperature_degc, {_INT(rf'internal pressure\s+{_N}Pa')} AS internal_pressure_pa, {_INT(rf'Pext\s+{_N}mbar')} AS external_pressure_mbar, {_INT(rf'rng\s+{_N}mbar')} AS external_pressure_range_mbar FROM t WHERE tagged AND {_FAMILY} = 'pressure_temperature'",
    "battery_fields": rf"WITH {_P} SELECT source_path, line_number, CASE WHEN message LIKE 'Vbat%' THEN 'vbat_summary' ELSE 'voltage_current' END AS battery_record_kind, {_INT(rf'(?:battery|Vbat)\s+{_N}mV', 1)} AS voltage_mv, {_INT(rf'{_N}uA')} AS current_ua, {_INT(rf'min\s+{_N}mV')} AS minimum_voltage_mv FROM t WHERE tagged AND {_FAMILY} = 'battery'",
    "gps_kinds": rf"WITH {_P} SELECT CASE WHEN message LIKE '%GPS fix...%' THEN 'fix_attempt' WHEN message LIKE '%deg%mn%' THEN 'fix_position' WHEN message LIKE '%dop%' THEN 'dop' ELSE 'gps_ack' END AS gps_record_kind, count(*) AS n FROM t WHERE tagged AND {_FAMILY} = 'gps' GROUP BY 1",
    "severities": f"WITH {_P} SELECT CASE WHEN message LIKE '%<ERR>%' THEN 'err' WHEN message LIKE '%<WARN>%' OR message LIKE '%<WRN>%' THEN 'warn' END AS severity, count(*) AS n FROM t WHERE tagged GROUP BY 1",
    "artifact_references": f"WITH {_L} SELECT source_path, line_number, replace(regexp_extract(raw_line, 'switching to (.*) ', 1), '/', '_') || '.LOG' AS switched_to_log_file FROM lines WHERE raw_line LIKE '%switching to%'",
    "iridium_events": rf"""WITH {_P}, e AS (SELECT *, {_KIND.replace('(m,', '(message,').replace('WHEN m ', 'WHEN message ')} AS kind FROM t WHERE tagged) SELECT source_path, line_number, kind AS iridium_event_kind,
      {_INT(r'connected in (\d+)s')} AS connection_duration_s, {_INT(r'signal quality (\d+)')} AS signal_quality, {_INT(r'(\d+) cmd')} AS received_command_count, {_INT(r'from byte (\d+)')} AS byte_offset, {_INT(r'\((\d+)bytes\)')} AS artifact_size_bytes,
      {_INT(r'uploaded at (\d+)')} AS rate_bytes_per_s, {_INT(r'(\d+) file')} AS uploaded_file_count, {_INT(r'disconnected after (\d+)s')} AS disconnect_duration_s,
      nullif(replace(regexp_extract(message, '\d+/\w+\.(?:MER|LOG|BIN)', 0), '/', '_'), '') AS referenced_artifact, CASE WHEN kind = 'command' THEN regexp_extract(message, '^\$(\w+)', 1) END AS command_name, CASE WHEN kind = 'command' THEN regexp_extract(message, ':([^;]*);', 1) END AS command_payload FROM e WHERE kind <> 'session_line'""",
    "episodes_latch": f"{_WALK} SELECT source_path, line_number, episode, episode_index FROM e",
    "episode_build": f"{_WALK} SELECT source_path, episode, episode_index, min(line_number) AS line_start_index, max(line_number) AS line_end_index, count(*) AS n_lines, string_agg(raw_line, chr(10) ORDER BY line_number) AS raw_text FROM e GROUP BY 1, 2, 3",
    "topk_patterns": f"WITH {_P} SELECT subsystem, coalesce(code, '') AS code, message, count(*) AS n FROM t WHERE tagged AND {_FAMILY} = 'unclassified' GROUP BY 1, 2, 3 ORDER BY n DESC, 1, 2, 3 LIMIT 10",
    "attr_parse": r"SELECT page_id, regexp_extract(a, '^([^=]*)=', 1) AS name, regexp_extract(a, '=(.*)$', 1) AS content FROM (SELECT page_id, unnest(regexp_extract_all(regexp_extract(html, '<(html [^>]*)>', 1), '[A-Za-z_][A-Za-z0-9_\[\]]*=[^\s>]+')) AS a FROM pages)",
    "source_diff": f"WITH r AS (SELECT CAST(o_custkey % 50 AS VARCHAR) AS s, CAST(o_orderkey AS VARCHAR) AS f, CASE WHEN o_orderkey % 3 = 0 THEN 'mer' ELSE 'log' END AS k, o_orderstatus AS h, o_orderkey AS q FROM orders), o AS (SELECT s, f, k, CASE WHEN q % 11 = 0 THEN 'X' ELSE h END AS h FROM r WHERE q % 7 <> 0), n AS (SELECT * FROM r WHERE q % 13 <> 0) {_DIFF}",
    "source_actions": f"WITH n AS (SELECT CAST(o_custkey AS VARCHAR) AS s, CAST(o_orderkey AS VARCHAR) AS f, CASE WHEN o_orderkey % 3 = 0 THEN 'mer' ELSE 'log' END AS k, o_orderstatus AS h, o_orderkey AS q FROM orders), o AS (SELECT s, f, k, CASE WHEN q % 11 = 0 THEN 'X' ELSE h END AS h FROM n WHERE q % 5 <> 0), d AS ({_DIFF}) SELECT instrument_serial, source_kind AS family, CASE WHEN bool_or(change_kind IN ('changed', 'removed')) THEN 'rewrite' WHEN bool_or(change_kind = 'new') THEN 'append' ELSE 'noop' END AS action FROM d GROUP BY 1, 2",
    "snapshot_digest": "SELECT sha256(string_agg(n_name || chr(9) || n_nationkey || chr(9) || sha256(n_name), chr(10) ORDER BY n_name) || chr(10)) AS snapshot_id, count(*) AS file_count FROM nation",
    "instrument_name": "SELECT s_suppkey, '452.' || lpad(CAST(s_suppkey % 1000 AS VARCHAR), 3, '0') || '-' || c || '-' || lpad(CAST(s_suppkey % 100 AS VARCHAR), 2, '0') AS serial, c || '00' || lpad(CAST(s_suppkey % 100 AS VARCHAR), 2, '0') AS instrument_id FROM (SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 'P' ELSE 'R' END AS c FROM supplier)",
    "section_extract": f"""WITH m AS ({_MER}), s AS (SELECT source_path, 'environment' AS section, unnest([1, 2, 3]) AS i, ['<SOFTWARE 2.1344' || CASE WHEN user_id % 3 = 0 THEN ' STANFORD' ELSE '' END || ' />', '<DIVE ID=' || user_id || ' EVENTS=' || n || ' />', '<SAMPLE MIN=-' || user_id || ' MAX=7 />'] AS lines FROM (SELECT user_id, source_path, e.n FROM m JOIN (SELECT user_id, count(*) AS n FROM events GROUP BY 1) e USING (user_id))
      UNION ALL SELECT source_path, 'parameter', unnest([1, 2]), ['<ADC GAIN=' || user_id % 5 || ' BUFFER=ON />', '<STANFORD_PROCESS DURATION_h=' || user_id % 9 || ' WINDOW_LEN=1024 />' || CASE WHEN user_id % 2 = 0 THEN '<x' ELSE '' END] FROM m)
      SELECT source_path, section, CAST(i * 2 AS INTEGER) AS line_pos, regexp_extract(lines[i], '^<([A-Z_]+)', 1) AS tag, lines[i] AS line FROM s""",
    "authority_antijoin": "SELECT doc_id FROM documents d WHERE lang <> 'de' AND NOT EXISTS (SELECT 1 FROM documents b WHERE b.lang = 'de' AND b.source = d.source AND b.doc_id // 3 = d.doc_id // 3)",
    "mer_environment": """WITH u AS (SELECT user_id, count(*) AS n FROM events GROUP BY 1) SELECT 'mer' || user_id AS source_path, k AS environment_kind, CASE WHEN k = 'software' THEN '2.1344' || CASE WHEN user_id % 3 = 0 THEN ' STANFORD' ELSE '' END END AS software,
      CASE WHEN k = 'dive' THEN CAST(user_id AS VARCHAR) END AS dive_id, CASE WHEN k = 'dive' THEN CAST(n AS VARCHAR) END AS dive_declared_event_count, CASE WHEN k = 'sample' THEN CAST(-user_id AS VARCHAR) END AS sample_min, CASE WHEN k = 'sample' THEN '7' END AS sample_max FROM (SELECT *, unnest(['software', 'dive', 'sample']) AS k FROM u)""",
    "mer_parameter": """SELECT 'mer' || user_id AS source_path, k AS parameter_kind, CASE WHEN k = 'adc' THEN 'ON' END AS adc_buffer, CASE WHEN k = 'adc' THEN CAST(user_id % 5 AS VARCHAR) END AS adc_gain,
      CASE WHEN k <> 'adc' THEN CAST(user_id % 9 AS VARCHAR) END AS stanford_process_duration_h, CASE WHEN k <> 'adc' THEN '1024' END AS stanford_process_window_len FROM (SELECT user_id, unnest(['adc', 'stanford_process']) AS k FROM (SELECT DISTINCT user_id FROM events)) WHERE k = 'adc' OR user_id % 2 = 1""",
    "mer_events": """SELECT 'mer' || user_id AS source_path, CAST(0 AS BIGINT) AS block_index, CAST(count(*) AS VARCHAR) AS rounds, '2024-01-02T03:04:05.000000Z' AS date, CAST(user_id % 7 * 2 AS BIGINT) AS data_payload_nbytes, CAST(user_id % 6 * 2 AS BIGINT) AS expected_payload_nbytes,
      user_id % 7 = user_id % 6 AS payload_length_matches_expected, to_base64(encode(repeat('ab', CAST(user_id % 7 AS INTEGER)))) AS encoded_payload FROM events WHERE user_id % 4 <> 0 GROUP BY user_id""",
    "file_param_attach": """SELECT 'mer' || user_id AS source_path, CASE WHEN user_id % 3 = 0 AND user_id % 2 = 1 THEN CAST(user_id % 9 AS VARCHAR) END AS duration_h, CASE WHEN user_id % 3 = 0 AND user_id % 2 = 1 THEN '<STANFORD_PROCESS DURATION_h=' || user_id % 9 || ' WINDOW_LEN=1024 />' END AS raw_parameter_line FROM (SELECT DISTINCT user_id FROM events WHERE user_id % 4 <> 0)""",
    "mer_quarantine": """SELECT 'mer' || user_id AS source_path, 'parameter' AS block_kind, '<STANFORD_PROCESS DURATION_h=' || user_id % 9 || ' WINDOW_LEN=1024 /><x' AS raw_block FROM (SELECT DISTINCT user_id FROM events WHERE user_id % 2 = 0)""",
    "content_hash": "SELECT doc_id, source || '_' || doc_id || '.LOG' AS source_file, 'log' AS source_kind, split_part(source, '_', 1) AS prefix, sha256(text) AS source_sha256, 'sha256:' || sha256(text) AS source_id FROM documents",
    "log_accounting": rf"""{_WALK}, h AS (SELECT k.source_path, k.line_number, CASE WHEN e.episode IS NOT NULL THEN e.episode WHEN k.tagged THEN {_FAMILY} WHEN k.raw_line LIKE '%*** switching to%' THEN 'unclassified' WHEN trim(k.raw_line) = '' THEN 'blank' ELSE 'malformed' END AS held_by FROM k LEFT JOIN e ON e.source_path = k.source_path AND e.line_number = k.line_number)
      SELECT held_by, count(*) AS n_lines FROM h GROUP BY 1 UNION ALL SELECT 'misassigned', 0""",
    "audit_findings": f"WITH {_P} SELECT source_path AS source_file, line_number AS place, 'voltage_mv does not match raw_line' AS issue FROM t WHERE tagged AND {_FAMILY} = 'battery' AND line_number % 17 = 0",
    "hash_sample": """WITH r AS (SELECT c_mktsegment AS family, CAST(c_nationkey AS VARCHAR) AS instrument_serial, CAST(c_custkey AS VARCHAR) AS source_file, o_orderkey AS place, md5('7|' || c_mktsegment || '|' || c_nationkey || '|' || c_custkey || '|' || o_orderkey) AS h FROM orders JOIN customer ON o_custkey = c_custkey),
      o AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY family, instrument_serial, source_file ORDER BY h, place) = 1), n AS (SELECT *, row_number() OVER (PARTITION BY family, instrument_serial ORDER BY h, place) AS nth FROM o)
      SELECT family, instrument_serial, source_file, place FROM n QUALIFY row_number() OVER (PARTITION BY family ORDER BY nth, h, place) <= 3""",
    "log_summary": rf"""WITH {_P}, c AS (SELECT *, {_FAMILY} AS family, lower(message) AS low FROM t WHERE tagged),
      a AS (SELECT *, CASE WHEN low LIKE '%started' THEN 'started' ELSE 'stopped' END AS state, CASE WHEN low LIKE '%already%' THEN 'assertion' ELSE 'transition' END AS kind FROM c WHERE family = 'acquisition'),
      v AS (SELECT source_path, line_number, family, 'acquisition_state' AS counter, state AS value FROM a UNION ALL SELECT source_path, line_number, family, 'acquisition_evidence_kind', kind FROM a UNION ALL SELECT source_path, line_number, family, 'acquisition', state || ':' || kind FROM a
        UNION ALL SELECT source_path, line_number, family, 'ascent_request_state', split_part(low, ' ', 3) FROM c WHERE family = 'ascent_request'
        UNION ALL SELECT source_path, line_number, family, 'gps_record_kind', CASE WHEN message LIKE '%GPS fix...%' THEN 'fix_attempt' WHEN message LIKE '%deg%mn%' THEN 'fix_position' WHEN message LIKE '%dop%' THEN 'dop' ELSE 'gps_ack' END FROM c WHERE family = 'gps'
        UNION ALL SELECT source_path, line_number, family, 'battery_record_kind', CASE WHEN message LIKE 'Vbat%' THEN 'vbat_summary' ELSE 'voltage_current' END FROM c WHERE family = 'battery'),
      g AS (SELECT family, counter, value, count(*) AS n, min(source_path || chr(1) || lpad(CAST(line_number AS VARCHAR), 12, '0')) AS p FROM v GROUP BY 1, 2, 3)
      SELECT 'log_' || family AS family, counter, value, n, split_part(p, chr(1), 1) AS first_path, CAST(split_part(p, chr(1), 2) AS BIGINT) AS first_line FROM g""",
    "mer_summary": rf"""WITH mer AS ({_MER}), o AS ({_ODD}), tag AS (SELECT unnest(regexp_extract_all(content, '<(SOFTWARE|DIVE|EXTRA|SAMPLE|ADC|ODDTAG|STANFORD_PROCESS) ', 1)) AS tag FROM o),
      k AS (SELECT CASE WHEN tag IN ('SOFTWARE', 'DIVE', 'EXTRA', 'SAMPLE') THEN 'environment' ELSE 'parameter' END AS section, tag, tag IN ('EXTRA', 'ODDTAG') AS odd FROM tag),
      r AS (SELECT 'total_files' AS item, '' AS key FROM o UNION ALL SELECT CASE WHEN content LIKE '%<EVENT>%' THEN 'event_blocks' ELSE 'zero_event_files' END, '' FROM o UNION ALL SELECT section || '_kind', CASE WHEN odd THEN 'unknown' ELSE lower(tag) END FROM k
        UNION ALL SELECT 'unknown_' || section || '_tag', tag FROM k WHERE odd UNION ALL SELECT 'unknown_info_key', 'BADKEY' FROM o WHERE content LIKE '%BADKEY=%') SELECT item, key, count(*) AS n FROM r GROUP BY 1, 2""",
    "iso_times": """SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE) + CASE o_orderkey % 4 WHEN 0 THEN INTERVAL '20289500' MILLISECOND WHEN 1 THEN INTERVAL '82042' SECOND WHEN 2 THEN INTERVAL '85620' SECOND ELSE INTERVAL '0' SECOND END, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' AS record_time FROM orders""",
    "audit_grouped_findings": f"""{_WALK}, g AS (SELECT source_path, episode, min(line_number) AS place, bool_or(regexp_matches(raw_line, 'P 100, T 200, S 300')) AS sampled FROM e GROUP BY source_path, episode, episode_index)
      SELECT 'log_' || episode AS family, source_path AS source_file, place, CASE WHEN episode = 'ctd' THEN 'ctd_samples' ELSE 'iridium_events' END || ' does not match the raw lines' AS issue FROM g WHERE place % 5 = 0 AND (episode = 'iridium' OR episode = 'ctd' AND sampled)""",
    "audit_mer_findings": """WITH u AS (SELECT DISTINCT user_id FROM events WHERE user_id % 5 = 0) SELECT 'mer_environment' AS family, 'mer' || user_id AS source_file, 'dive_id does not match the line' AS issue FROM u
      UNION ALL SELECT 'mer_parameter', 'mer' || user_id, 'adc_gain does not match the line' FROM u UNION ALL SELECT 'mer_event', 'mer' || user_id, 'rounds does not match INFO' FROM u WHERE user_id % 4 <> 0""",
}
