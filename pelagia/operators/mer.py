"""MER files: tag sections, attributes and length-framed events."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pelagia.functions.lines import format_time, iso_time, strip

ATTRIBUTE = r"([A-Za-z_][A-Za-z0-9_\[\]]*)=([^\s>]+)"
#: Known tags and attribute keys.
ENVIRONMENT = ("BOARD", "SOFTWARE", "DIVE", "POOL", "GPSINFO", "DRIFT", "CLOCK", "SAMPLE", "TRUE_SAMPLE_FREQ")
PARAMETERS = ("ADC", "INPUT_FILTER", "STALTA", "EVENT_LEN", "RATING", "CDF24", "MODEL", "ASCEND_THRESH", "STANFORD_PROCESS", "MISC")
INFO_KEYS = ("DATE", "ROUNDS", "PRESSURE", "TEMPERATURE", "CRITERION", "SNR", "TRIG", "DETRIG", "FNAME", "SMP_OFFSET", "TRUE_FS")
#: Said of a file that holds neither a section nor an event.
NOTHING = "no MER section or event"
FORMAT_KEYS = ("ENDIANNESS", "BYTES_PER_SAMPLE", "SAMPLING_RATE", "STAGES", "NORMALIZED", "LENGTH")


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of ``value``, which is evaluated once however often ``use`` reads it, and wherever the optimiser moves it."""
    return F.transform(F.array(value), use)[0]


def attributes(line: Column) -> Column:
    """KEY=value pairs of a tag line; the last of a repeated key wins."""
    found = F.struct(*(F.regexp_extract_all(line, F.lit(ATTRIBUTE), F.lit(k)).alias(n) for k, n in ((1, "names"), (2, "values"))))

    def pairs(f: Column) -> Column:
        names, size = f["names"], F.size(f["names"])
        last = F.filter(F.arrays_zip(names.alias("k"), f["values"].alias("v"), F.sequence(F.lit(1), size).alias("n")), lambda x: x["n"] == size - F.array_position(F.reverse(names), x["k"]) + 1)
        return F.when(size > 0, F.map_from_entries(F.transform(last, lambda x: F.struct(x["k"], x["v"])))).otherwise(F.create_map().cast("map<string,string>"))

    return bound(found, pairs)


def sections(files: DataFrame) -> DataFrame:
    """One row per non-blank line of every complete section: section, line_pos, line, tag.

    Bytes are read as latin-1, so none is lost in framing; the line then keeps
    its ASCII part.
    """
    text = F.decode("content", "ISO-8859-1")
    parts = None
    for name, close in (("environment", "ENVIRONMENT"), ("parameter", "PARAMETERS")):
        bodies = F.regexp_extract_all(text, F.lit(rf"(?s)<{close}>(.*?)</{close}>"), F.lit(1))
        one = files.select("source_path", F.lit(name).alias("section"), F.posexplode(bodies).alias("body_pos", "body"))
        parts = one if parts is None else parts.unionByName(one)
    return section_lines(parts)


def section_lines(parts: DataFrame) -> DataFrame:
    """The lines of section bodies (source_path, section, body_pos, body)."""
    ascii_only = F.regexp_replace("body", r"[^\x00-\x7F]", "")
    lines = parts.select("source_path", "section", "body_pos", F.posexplode(F.split(ascii_only, r"\r\n|[\n\r\x0b\x0c\x1c-\x1e]")).alias("line_pos", "raw"))
    lines = lines.withColumn("line", strip(F.col("raw"))).where("line <> ''").drop("raw")
    tag = F.regexp_extract("line", r"^<([A-Z0-9_]+)\b", 1)
    return lines.withColumn("tag", F.when(tag == "", "UNKNOWN").otherwise(tag))


def _bare(tag: str) -> Column:
    found = F.regexp_extract("line", rf"^<{tag}\s+([^>]+?)\s*/>$", 1)
    return F.when((F.col("tag") == tag) & (found != ""), found)


def _typed(tag: str, kind: str, *keys: str) -> Column:
    value = F.coalesce(*(F.col("attrs")[k] for k in keys)).try_cast(kind)
    if kind == "double":
        value = F.when(~F.isnan(value) & (F.abs(value) < float("inf")), value)
    return F.when(F.col("tag") == tag, value)


def environment(lines: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The environment rows of metadata lines, with the columns ``keep`` of these."""
    rows = lines.where("section = 'environment'").withColumn("attrs", attributes(F.col("line")))
    kind = F.when(F.col("tag").isin(*ENVIRONMENT), F.lower("tag")).otherwise("unknown")
    bare = F.regexp_extract("line", r"^<[A-Z0-9_]+\s+([^>]+?)\s*/>$", 1)
    lowered = F.transform_keys("attrs", lambda k, _: F.lower(k))
    single = F.when(bare != "", F.create_map(F.lower("tag"), bare))
    raw = F.when(F.col("tag").isin("BOARD", "SOFTWARE"), single).when(F.size("attrs") > 0, lowered).otherwise(single)
    return rows.select(
        "source_path", "body_pos", "line_pos", kind.alias("environment_kind"), _bare("BOARD").alias("board"), _bare("SOFTWARE").alias("software"),
        _typed("DIVE", "long", "ID").alias("dive_id"), _typed("DIVE", "long", "EVENTS").alias("dive_declared_event_count"),
        _typed("POOL", "long", "EVENTS").alias("pool_declared_event_count"), _typed("POOL", "long", "SIZE").alias("pool_declared_size_bytes"),
        _typed("SAMPLE", "long", "MIN").alias("sample_min"), _typed("SAMPLE", "long", "MAX").alias("sample_max"),
        _typed("TRUE_SAMPLE_FREQ", "double", "FS_Hz").alias("true_sample_freq_hz"),
        format_time(iso_time(_typed("GPSINFO", "string", "DATE"))).alias("gpsinfo_date"), raw.alias("raw_values"), "line", *keep,
    )


def parameters(lines: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The parameter rows of metadata lines, with the columns ``keep`` of these."""
    rows = lines.where("section = 'parameter'").withColumn("attrs", attributes(F.col("line")))
    kind = F.when(F.col("tag").isin(*PARAMETERS), F.lower("tag")).otherwise("unknown")
    s = "STANFORD_PROCESS"
    raw = F.when(F.size("attrs") > 0, F.transform_keys("attrs", lambda k, _: F.lower(k)))
    return rows.select(
        "source_path", "body_pos", "line_pos", kind.alias("parameter_kind"), _typed("ADC", "long", "GAIN").alias("adc_gain"), _typed("ADC", "string", "BUFFER").alias("adc_buffer"),
        _typed(s, "long", "DURATION_h", "DURATION_H").alias("stanford_process_duration_h"), _typed(s, "long", "PROCESS_PERIOD_h", "PROCESS_PERIOD_H").alias("stanford_process_period_h"),
        _typed(s, "long", "WINDOW_LEN").alias("stanford_process_window_len"), _typed(s, "string", "WINDOW_TYPE").alias("stanford_process_window_type"),
        _typed(s, "long", "OVERLAP_PERCENT").alias("stanford_process_overlap_percent"), _typed(s, "double", "dB_OFFSET", "DB_OFFSET").alias("stanford_process_db_offset"),
        _typed("MISC", "string", "UPLOAD_MAX").alias("upload_max"), raw.alias("raw_values"), "line", *keep,
    )


def _tag_at(head: bytes, name: bytes) -> str | None:
    start = head.find(b"<" + name)
    stop = head.find(b">", start)
    return head[start : stop + 1].decode("ascii", "ignore") if 0 <= start < stop else None


def _number(line: str | None, key: str) -> int | None:
    for part in (line or "").replace(">", " ").split():
        name, _, value = part.partition("=")
        if name == key and value.isdigit():
            return int(value)
    return None


def frame_events(data: bytes) -> Iterator[tuple[int, str | None, str | None, bytes | None, str | None]]:
    """(event_pos, info_line, format_line, payload, error) of every event.

    The declared length decides where a payload ends; if no close tag stands
    there, the last one before the event's end does. Without a declared length
    the close tag must be the only one.
    """
    at, pos = data.find(b"<EVENT>"), 0
    while at >= 0:
        body = at + 7
        tag = data.find(b"<DATA>", body)
        nearest = data.find(b"</EVENT>", body)
        if tag < 0 or 0 <= nearest < tag:
            yield pos, None, None, None, "event without data"
            at, pos = data.find(b"<EVENT>", body), pos + 1
            continue
        head = data[body:tag]
        info, form = _tag_at(head, b"INFO"), _tag_at(head, b"FORMAT")
        start = tag + 6
        start += 2 if data.startswith(b"\n\r", start) else 0
        length, width = _number(form, "LENGTH"), _number(form, "BYTES_PER_SAMPLE")
        close, error = -1, None
        if length is not None and width is not None:
            end = start + length * width
            end += 3 if data.startswith(b"\n\r\t", end) else 0
            close = end if data.startswith(b"</DATA>", end) else -1
        stop = data.find(b"</EVENT>", close + 7) if close >= 0 else -1
        if close < 0:
            close = data.find(b"</DATA>", start)
            seen = 1
            while close >= 0:
                stop = data.find(b"</EVENT>", close + 7)
                if stop < 0 or not data[close + 7 : stop].strip(b" \t\r\n"):
                    break
                close, seen = data.find(b"</DATA>", close + 7), seen + 1
            if close >= 0 and stop >= 0 and seen > 1 and length is None:
                error = "ambiguous data without a declared length"
        if close < 0 or stop < 0:
            yield pos, info, form, None, "incomplete event"
            at, pos = data.find(b"<EVENT>", start), pos + 1
            continue
        end = close - 3 if data.startswith(b"\n\r\t", close - 3) and close - 3 >= start else close
        yield pos, info, form, None if error else data[start:end], error
        at, pos = data.find(b"<EVENT>", stop + 8), pos + 1


def events(files: DataFrame) -> DataFrame:
    """event_pos, info_line, format_line, payload, error of every event of every file."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(path, *event) for path, data in zip(b["source_path"], b["content"], strict=True) for event in frame_events(bytes(data))]
            yield pd.DataFrame(rows, columns=["source_path", "event_pos", "info_line", "format_line", "payload", "error"])

    return files.select("source_path", "content").mapInPandas(run, "source_path string, event_pos long, info_line string, format_line string, payload binary, error string")


#: Attributes that must be numbers, times or yes and no, where they are given.
_INFO_TYPES = {"DATE": "time", **dict.fromkeys(("PRESSURE", "TEMPERATURE", "CRITERION", "SNR"), "double"), "TRIG": "long", "DETRIG": "long"}
_FORMAT_TYPES = {"BYTES_PER_SAMPLE": "long", "SAMPLING_RATE": "double", "STAGES": "long", "NORMALIZED": "bool", "LENGTH": "long"}


def typed(value: Column, kind: str) -> Column:
    """An attribute's text as long, finite double, YES or NO, or time; null if it is none."""
    if kind == "bool":
        return F.when(F.upper(value) == "YES", True).when(F.upper(value) == "NO", False)
    if kind == "time":
        return iso_time(value)
    number = value.try_cast(kind)
    return F.when(~F.isnan(number) & (F.abs(number) < float("inf")), number) if kind == "double" else number


def judged(framed: DataFrame, *, strict: bool) -> DataFrame:
    """``framed`` with block_kind and error of events that can't be records.

    An event without INFO is one of them, but not in strict mode.
    """
    parsed = F.struct("error", F.col("info_line").isNull().alias("bare"), *(attributes(F.coalesce(x, F.lit(""))).alias(x) for x in ("info_line", "format_line")))

    def verdict(e: Column) -> Column:
        checks = [(e["error"].isNotNull(), "event_data", e["error"])]
        if not strict:
            checks.append((e["bare"], "event_info", F.lit("missing INFO tag")))
        for line, kind, types in (("info_line", "event_info", _INFO_TYPES), ("format_line", "event_format", _FORMAT_TYPES)):
            checks += [(e[line][k].isNotNull() & typed(e[line][k], t).isNull(), kind, F.lit(f"unparseable {k}")) for k, t in types.items()]
        kind, error = F.lit(None).cast("string"), F.lit(None).cast("string")
        for bad, name, said in reversed(checks):
            kind, error = F.when(bad, name).otherwise(kind), F.when(bad, said).otherwise(error)
        return F.struct(kind.alias("kind"), error.alias("error"))

    # bound, as a filter on the error would else parse the lines again in every check
    framed = framed.withColumn("_verdict", bound(parsed, verdict))
    return framed.withColumns({"block_kind": F.col("_verdict.kind"), "error": F.col("_verdict.error")}).drop("_verdict")


def odd_metadata(lines: DataFrame) -> DataFrame:
    """(source_path, block_index, block_kind, raw_block, error): metadata lines that are no tag, and repeated sections."""
    no_tag = lines.where(~tag_line()).select("source_path", F.lit(None).cast("long").alias("block_index"), F.col("section").alias("block_kind"), F.col("line").alias("raw_block"), F.concat(F.lit("malformed "), "section", F.lit(" tag line")).alias("error"))
    again = lines.where("body_pos > 0").select("source_path", F.col("body_pos").cast("long").alias("block_index"), F.lit("repeated_metadata_section").alias("block_kind"), F.lit(None).cast("string").alias("raw_block"), F.concat(F.lit("repeated complete "), "section", F.lit(" section kept in the records")).alias("error")).distinct()
    return no_tag.unionByName(again)


def tag_line() -> Column:
    return F.col("line").rlike(r"^<.*/>$")


def hopeless(files: DataFrame) -> DataFrame:
    """(source_path, error) of files that hold neither a complete section nor an event."""
    text = F.decode("content", "ISO-8859-1")
    found = text.rlike(r"(?s)<(ENVIRONMENT|PARAMETERS)>.*?</\1>") | text.contains("<EVENT>")
    return files.where(~found).select("source_path", F.lit(NOTHING).alias("error"))


def event_records(framed: DataFrame, params: DataFrame, env: DataFrame) -> DataFrame:
    """Event rows with payload accounting; unknown keys fail the job.

    The file's processing parameters are attached if its software names
    STANFORD and it has exactly one such parameter line.
    """
    info, form = attributes(F.coalesce("info_line", F.lit(""))), attributes(F.coalesce("format_line", F.lit("")))
    # events that became records are counted from 0 in each file
    by = Window.partitionBy("source_path").orderBy("event_pos")
    rows = framed.where("error is null").withColumn("block_index", (F.row_number().over(by) - 1).cast("long")).withColumns({"_info": info, "_format": form, "event_index": F.col("block_index")})
    odd = F.concat(F.array_except(F.map_keys("_info"), F.array(*map(F.lit, INFO_KEYS))), F.array_except(F.map_keys("_format"), F.array(*map(F.lit, FORMAT_KEYS))))
    checked = F.when(F.size(odd) == 0, F.col("source_path")).otherwise(F.raise_error(F.concat(F.lit("unknown keys in "), F.col("source_path"), F.lit(": "), F.array_join(odd, ", "))).cast("string"))
    rows = rows.withColumn("source_path", checked)
    names = {k.lower(): F.col("_info")[k] for k in INFO_KEYS if k != "DATE"} | {k.lower(): F.col("_format")[k] for k in FORMAT_KEYS}
    expected = F.col("_format")["LENGTH"].try_cast("long") * F.col("_format")["BYTES_PER_SAMPLE"].try_cast("long")
    date = format_time(iso_time(F.col("_info")["DATE"]))
    size = F.octet_length("payload").cast("long")
    rows = rows.withColumns(names | {"date": date, "event_info_date": date, "event_rounds": F.col("_info")["ROUNDS"], "expected_payload_nbytes": expected, "encoded_payload_byte_count": size, "data_payload_nbytes": size, "payload_length_matches_expected": size == expected, "encoded_payload": F.translate(F.base64("payload"), "\r\n", "")})
    stanford = env.where("software like '%STANFORD%'").select("source_path").distinct()
    own = params.where("parameter_kind = 'stanford_process'").groupBy("source_path").agg(F.count("*").alias("n"), F.first(F.struct(*(F.col(f"stanford_process_{c}").alias(c) for c in ("duration_h", "period_h", "window_len", "window_type", "overlap_percent", "db_offset")), F.col("line").alias("raw_parameter_line"))).alias("stanford_psd_processing")).where("n = 1").drop("n")
    rows = rows.withColumnsRenamed({"info_line": "raw_info_line", "format_line": "raw_format_line"})
    return rows.drop("_info", "_format", "error", "block_kind").join(own.join(stanford, "source_path", "left_semi"), "source_path", "left")
