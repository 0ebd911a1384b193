"""Audit of published records: every field is derived anew from the kept raw text of all rows and compared."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pelagia.functions.families import classify, family_fields
from pelagia.functions.lines import format_time, iso_time, log_epoch_time, parse_lines
from pelagia.operators.episodes import build_episodes, ctd_samples, iridium_sessions
from pelagia.operators.mer import FORMAT_KEYS, INFO_KEYS, attributes, environment, parameters
from pelagia.plans import manifests
from pelagia.plans.normalize import LOG_FAMILIES, MER_FAMILIES, SINGLE, read_family


def _issues(checks: dict[str, Column]) -> Column:
    return F.filter(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(said)) for said, ok in checks.items())), lambda x: x.isNotNull())


def _same(stored: Column, derived: Column) -> Column:
    return F.to_json(F.struct(stored.alias("x"))) == F.to_json(F.struct(derived.alias("x")))


def audit_single(rows: DataFrame, family: str) -> DataFrame:
    """``rows`` of a single-line LOG family with issues: what their raw_line does not bear out."""
    stored = [c for c in rows.columns if c not in ("raw_line",)]
    anew = parse_lines(rows.select(*(F.col(c).alias(f"s_{c}") for c in stored), "raw_line"))
    rollover = F.col("rollover_target").isNotNull()
    message = F.coalesce("message", F.expr("substring(raw_line, instr(raw_line, ':') + 1)"))
    anew = anew.withColumn("message", message)
    checks = {
        "family does not match raw_line": F.when(F.col("tagged"), classify(F.col("message"))).when(rollover, "unclassified") == family,
        "message does not match raw_line": F.col("s_message") == F.col("message"),
        "record_time does not match raw_line": F.col("s_record_time") == F.col("record_time"),
        "log_epoch_time does not match raw_line": F.col("s_log_epoch_time") == log_epoch_time(F.col("raw_line")),
        "subsystem does not match raw_line": F.col("s_subsystem") == F.when(F.col("tagged"), F.col("subsystem")).otherwise("ROLLOVER"),
        "code does not match raw_line": F.col("s_code").eqNullSafe(F.col("code")),
    }
    checks |= {f"{n} does not match raw_line": _same(F.col(f"s_{n}"), c) for n, c in family_fields(family, F.col("message")).items()}
    return anew.withColumn("issues", _issues(checks)).select(*(F.col(f"s_{c}").alias(c) for c in stored), "raw_line", "issues")


#: What an episode's own lines say, and what its families add.
EPISODE_FIELDS = ("line_start_index", "line_end_index", "start_record_time", "end_record_time", "start_log_epoch_time", "end_log_epoch_time", "source_line_numbers", "raw_lines")
GROUP_FIELDS = {"ctd": ("ctd_sample_count", "ctd_samples"), "iridium": ("session_index", "session_kind", "iridium_event_count", "iridium_events")}


def audit_grouped(rows: DataFrame, family: str) -> DataFrame:
    """``rows`` of a grouped LOG family with issues.

    The raw lines of every row are parsed and grouped again as one episode, and
    each field, nested ones as a whole, is compared with what comes out.
    """
    keyed = rows.withColumn("_key", F.concat_ws("\u0000", "source_path", F.col("line_start_index").cast("string"), F.col("episode_index").cast("string")))
    kind = "struct<line_number:bigint,raw_line:string>"
    line = F.coalesce(F.arrays_zip(F.col("source_line_numbers").alias("line_number"), F.col("raw_lines").alias("raw_line")).cast(f"array<{kind}>"), F.array().cast(f"array<{kind}>"))
    # a row goes first and its lines follow, so that both meet again in one grouping
    opened = keyed.select("_key", F.lit(family).alias("episode"), "episode_index", F.struct(*rows.columns).alias("_row"), F.posexplode(F.concat(F.array(F.lit(None).cast(kind)), line)).alias("_at", "l"))
    lines = opened.select("_key", "episode", "episode_index", "l.line_number", "l.raw_line", F.when(F.col("_at") == 0, F.col("_row")).alias("_row"))
    anew = build_episodes(parse_lines(lines), "_key", F.collect_list("_row").alias("_rows"))
    anew = ctd_samples(anew) if family == "ctd" else iridium_sessions(anew) if family == "iridium" else anew
    fields = (*EPISODE_FIELDS, *GROUP_FIELDS.get(family, ()))
    both = anew.select(F.explode("_rows").alias("_row"), F.when(F.size("lines") > 0, F.struct(*fields)).alias("_anew")).select("_row.*", "_anew")
    c = F.col
    checks = {
        "line numbers and raw lines differ in number": F.size("source_line_numbers") == F.size("raw_lines"),
        "line numbers do not ascend": c("source_line_numbers") == F.sort_array("source_line_numbers"),
        "start is after end": F.coalesce(c("start_log_epoch_time").try_cast("long") <= c("end_log_epoch_time").try_cast("long"), F.lit(True)),
        "a time is missing": c("start_record_time").isNotNull() & c("end_record_time").isNotNull(),
    }
    checks |= {f"{n} does not match the raw lines": _same(c(n), c("_anew")[n]) for n in fields}
    return both.withColumn("issues", _issues(checks)).drop("_anew")


def audit_mer(rows: DataFrame, family: str) -> DataFrame:
    """``rows`` of a MER family with issues: every field is derived anew from the kept line or lines."""
    c = F.col
    if family == "event":
        info, form = (attributes(F.coalesce(line, F.lit(""))) for line in ("raw_info_line", "raw_format_line"))
        rows = rows.withColumns({"_info": info, "_format": form})
        size = F.octet_length(F.unbase64("encoded_payload")).cast("long")
        date, expected = format_time(iso_time(c("_info")["DATE"])), c("_format")["LENGTH"].try_cast("long") * c("_format")["BYTES_PER_SAMPLE"].try_cast("long")
        checks = {f"{n} does not match the payload": c(n).eqNullSafe(size) for n in ("encoded_payload_byte_count", "data_payload_nbytes")}
        checks |= {"expected_payload_nbytes does not match FORMAT": c("expected_payload_nbytes").eqNullSafe(expected), "payload_length_matches_expected is wrong": c("payload_length_matches_expected").eqNullSafe(size == c("expected_payload_nbytes"))}
        checks |= {f"{n} does not match INFO": c(n).eqNullSafe(date) for n in ("date", "event_info_date")} | {"event_rounds does not match INFO": c("event_rounds").eqNullSafe(c("_info")["ROUNDS"])}
        checks |= {f"{k.lower()} does not match INFO": c(k.lower()).eqNullSafe(c("_info")[k]) for k in INFO_KEYS if k != "DATE"}
        checks |= {f"{k.lower()} does not match FORMAT": c(k.lower()).eqNullSafe(c("_format")[k]) for k in FORMAT_KEYS}
        checks["the event has neither a FORMAT line nor rounds"] = c("raw_format_line").isNotNull() | c("rounds").isNotNull()
        return rows.withColumn("issues", _issues(checks)).drop("_info", "_format")
    derive = environment if family == "environment" else parameters
    tag = F.regexp_extract("line", r"^<([A-Z0-9_]+)\b", 1)
    stored = rows.select(F.struct(*rows.columns).alias("_stored"), "source_path", "body_pos", "line_pos", "line", F.lit(family).alias("section"), F.when(tag == "", "UNKNOWN").otherwise(tag).alias("tag"))
    fields = [x for x in derive(stored).columns if x in rows.columns and x not in ("source_path", "body_pos", "line_pos", "line")]
    anew = derive(stored, ("_stored",)).select("_stored", F.struct(*fields).alias("_anew"))
    checks = {f"{n} does not match the line": _same(c("_stored")[n], c("_anew")[n]) for n in fields}
    return anew.withColumn("issues", _issues(checks)).select("_stored.*", "issues")


def audit_family(rows: DataFrame, name: str) -> DataFrame:
    """(family, instrument_serial, source_file, place, issue): every finding in the rows of the family table ``name``."""
    container, _, family = name.partition("_")
    if container == "mer":
        checked, place = audit_mer(rows, family), F.col("event_pos") if family == "event" else F.col("line_pos")
    elif family in SINGLE:
        checked, place = audit_single(rows, family), F.col("source_line_number")
    else:
        checked, place = audit_grouped(rows, family), F.col("line_start_index")
    return checked.select(F.lit(name).alias("family"), "instrument_serial", "source_file", place.cast("long").alias("place"), F.explode("issues").alias("issue"))


def audit(spark: SparkSession, out: str) -> DataFrame:
    """Every finding in all rows published below ``out``."""
    found = None
    for name in (*LOG_FAMILIES, *MER_FAMILIES):
        if manifests.exists(spark, f"{out}/{name}"):
            one = audit_family(read_family(spark, out, name), name)
            found = one if found is None else found.unionByName(one)
    if found is None:
        raise ValueError(f"{out} holds no family")
    return found


def is_stanford(rows: DataFrame) -> Column:
    """Whether a MER row is of the processed kind: of such an instrument, or an event with rounds and no FORMAT line."""
    processed = F.col("raw_format_line").isNull() & F.col("rounds").isNotNull() if {"raw_format_line", "rounds"} <= set(rows.columns) else F.lit(False)
    return F.col("family").startswith("mer_") & (F.col("instrument_serial").startswith("465.152-R-") | processed)


def sample_rows(rows: DataFrame, files: int, seed: int, *, keys: tuple[str, ...] = ("family", "instrument_serial", "source_file"), forced: Column | None = None) -> DataFrame:
    """One row of each file by seeded hash, of at most ``files`` files a family, of distinct instruments as far as there are.

    If none of them is ``forced`` but some file's row is, the first such row by
    the same order comes too. The choice within a file is an aggregated minimum;
    of an instrument's or a family's files no more than ``files`` are ranked, as
    Spark limits each group before it is shuffled.
    """
    family, serial, file = keys
    order = F.struct(F.md5(F.concat_ws("|", F.lit(str(seed)), *(F.col(c).cast("string") for c in rows.columns if c in (*keys, "place")))), *(c for c in ("place",) if c in rows.columns))
    flag = F.lit(False) if forced is None else F.coalesce(forced, F.lit(False))
    one = rows.withColumn("_forced", flag).groupBy(family, serial, file).agg(F.min_by(F.struct(*rows.columns, "_forced"), order).alias("r"), F.min(order).alias("o"))
    # the first file of each instrument before any second one
    nth = F.row_number().over(Window.partitionBy(family, serial).orderBy("o"))
    pick = F.row_number().over(Window.partitionBy(family).orderBy("nth", "o"))
    picked = one.withColumn("nth", nth).where(F.col("nth") <= files).withColumn("pick", pick).where(F.col("pick") <= files).select("r.*")
    if forced is not None:
        first = one.where("r._forced").agg(F.min_by("r", "o").alias("r")).where("r is not null").select("r.*")
        have = picked.agg(F.coalesce(F.bool_or("_forced"), F.lit(False)).alias("have"))
        picked = picked.unionByName(first.join(have, ~F.col("have")).select(picked.columns))
    return picked.drop("_forced")
