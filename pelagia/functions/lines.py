"""Source lines: explode, tagged-line parse, time parse."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ``(?d)`` keeps U+2028 and its like inside a line, as only \n ends one here.
TAGGED = r"(?d)^(.+?):\[([^\]]+)\](.*)$"
WRAPPED = r"(?d)^(.+?):(<(?:ERR|WARN|WRN)>)\[([^\]]+)\](.*)$"
TIMED = r"(?d)^(.+?):(.*)$"
ROLLOVER = r"(?i)^\*\*\*\s+switching to\s+(.+?)\s+\*\*\*$"
#: The words that open an untagged parameter line.
PARAMETER_WORDS = ("bypass", "valve", "pump", "rate", "surface", "near", "far", "ascent", "dead", "coeff", "stab", "delay", "mmtime", r"stage\[0\]", r"stage\[1\]")
PARAMETER = r"(?i)^\s*(?:(?:" + "|".join(PARAMETER_WORDS) + r")(?:\s|$)|p2t37:)"
_SPACE = r"(?U)^\s+|\s+$"


def strip(text: Column) -> Column:
    """Unicode-wide trim; a text that begins and ends with visible ASCII needs no pattern."""
    firm = F.ascii(text).between(33, 126) & F.ascii(F.substring(text, -1, 1)).between(33, 126)
    return F.when(firm, text).otherwise(F.regexp_replace(text, _SPACE, ""))


def extract(text: Column, pattern: str, group: int = 1) -> Column:
    """The group, or null where the pattern does not match."""
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, group))


def whole(text: Column, pattern: str, group: int = 1) -> Column:
    """The group as a 64-bit integer; null if absent or out of range."""
    return extract(text, pattern, group).try_cast("long")


def explode_lines(files: DataFrame, content: str = "content") -> DataFrame:
    """One row per line: line_number from 1, raw_line; \\r, \\n and \\r\\n end lines.

    Invalid UTF-8 becomes U+FFFD. A last line end adds no empty line. Other
    columns of ``files`` pass through.
    """
    text = F.make_valid_utf8(F.col(content).cast("string"))
    parts = F.split(F.regexp_replace(text, r"(?:\r\n|\r|\n)\z", ""), r"\r\n|\r|\n", -1)
    keep = [c for c in files.columns if c != content]
    some = files.where(F.length(F.col(content).cast("binary")) > 0)
    return some.select(*keep, F.posexplode(parts).alias("pos", "raw_line")).select(*keep, (F.col("pos") + 1).cast("long").alias("line_number"), "raw_line")


#: The first and the last microsecond of years 1 to 9999.
_FIRST, _LAST = -62135596800_000000, 253402300799_999999
_HOUR, _SIXTY, _FRACTION = r"(?:[01]\d|2[0-3])", r"[0-5]\d", r"(?:[.,]\d+)?"
_DATE = r"\d{4}(?:-\d\d-\d\d|\d{4}|-W\d\d(?:-[1-7])?|W\d\d[1-7]?)"
_CLOCK = rf"(?:{_HOUR}(?::{_SIXTY}(?::{_SIXTY}{_FRACTION})?)?|{_HOUR}{_SIXTY}(?:{_SIXTY}{_FRACTION})?)"
#: ISO 8601: a date, and after any sign a clock time with or without an offset, each in the extended or the basic form.
ISO = rf"(?ds)^({_DATE})(?:.({_CLOCK})(Z|[+-]{_CLOCK})?)?$"


def _micros(clock: Column) -> Column:
    """Microseconds of a clock time or offset without its sign; 0 where it is empty."""
    digits = F.rpad(F.translate(clock, ":.,", ""), 12, "0")  # HHMMSSffffff
    at = lambda k, n: F.substring(digits, k, n).try_cast("long")
    return at(1, 2) * 3_600_000_000 + at(3, 2) * 60_000_000 + at(5, 8)


def iso_parts(text: Column) -> list[Column]:
    """Date, clock time and offset of an ISO-8601 time; empty where ``text`` is none."""
    return [F.regexp_extract(text, ISO, k) for k in (1, 2, 3)]


def _days(date: Column) -> Column:
    """Days since 1970 of a calendar or week date; null if there is no such day."""
    plain = F.regexp_replace(date, "-", "")
    year = F.substring(plain, 1, 4)
    calendar = F.unix_date(F.concat_ws("-", year, F.substring(plain, 5, 2), F.substring(plain, 7, 2)).try_cast("date"))
    # the Monday of the week that the 4th of January is in; 1970 began on a Thursday
    fourth = F.unix_date(F.concat(year, F.lit("-01-04")).try_cast("date"))
    monday = fourth - F.pmod(fourth + 3, F.lit(7)) + F.substring(plain, 6, 2).try_cast("int") * 7 - 7
    # a week belongs to the year that its Thursday is in
    weekly = F.when(F.date_format(F.date_from_unix_date(monday + 3), "yyyy") == year, monday + F.rpad(F.substring(plain, 8, 1), 1, "1").cast("int") - 1)
    return F.when(plain.contains("W"), F.when(~F.substring(plain, 6, 2).isin("00"), weekly)).otherwise(calendar).cast("long")


def iso_from(date: Column, clock: Column, offset: Column) -> Column:
    """The time of ``iso_parts``."""
    shift = F.when(offset.startswith("-"), -1).otherwise(1) * _micros(F.translate(offset, "+-Z", ""))
    micros = F.when(date >= "0001", _days(date)) * 86_400_000_000 + _micros(clock) - shift
    return F.when(micros.between(_FIRST, _LAST), F.timestamp_micros(micros))


def iso_time(text: Column) -> Column:
    """An ISO-8601 time in UTC: calendar and week dates, basic and extended, any sign between date and time, fractions of a
    second (cut to microseconds) and offsets to them. Without a time it is midnight, without an offset UTC; null if it is none
    or falls outside years 1 to 9999."""
    return iso_from(*iso_parts(text))


def epoch_time(text: Column) -> Column:
    """Whole epoch seconds; null if it is none or falls outside years 1 to 9999."""
    seconds = F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("long"))
    return F.when(seconds.between(_FIRST // 1_000_000, _LAST // 1_000_000), F.timestamp_seconds(F.when(seconds.between(_FIRST // 1_000_000, _LAST // 1_000_000), seconds)))


def parse_time(text: Column) -> Column:
    """Epoch seconds or ISO-8601 (naive is UTC); null outside years 1 to 9999."""
    return F.coalesce(epoch_time(text), iso_time(text))


def format_time(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def compiled(spark: SparkSession) -> None:
    """Keep Spark from fusing an expression-heavy stage into one method of over 8,000 bytes, which Java would only interpret."""
    if int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) > 8000:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


def parse_lines(lines: DataFrame) -> DataFrame:
    """Adds tagged, time_text, subsystem, code, message, record_time, is_blank and is_parameter."""
    compiled(lines.sparkSession)
    raw = F.col("raw_line")
    plain, wrapped = raw.rlike(TAGGED), raw.rlike(WRAPPED)
    tag = F.when(plain, F.regexp_extract(raw, TAGGED, 2)).when(wrapped, F.regexp_extract(raw, WRAPPED, 3))
    time = F.when(plain, F.regexp_extract(raw, TAGGED, 1)).when(wrapped, F.regexp_extract(raw, WRAPPED, 1))
    message = F.when(plain, F.regexp_extract(raw, TAGGED, 3)).when(wrapped, F.concat(F.regexp_extract(raw, WRAPPED, 2), F.regexp_extract(raw, WRAPPED, 4)))
    content = extract(raw, TIMED, 2)
    out = lines.withColumns({"tagged": plain | wrapped, "_tag": tag, "time_text": F.coalesce(time, extract(raw, TIMED, 1)), "message": message, "_content": content})
    return out.withColumns(
        {
            "subsystem": strip(F.split_part("_tag", F.lit(","), F.lit(1))),
            "code": F.nullif(strip(F.expr("substring(_tag, nullif(instr(_tag, ','), 0) + 1)")), F.lit("")),
            "_epoch": epoch_time(F.col("time_text")),
            "is_blank": strip(raw) == "",
            "is_parameter": ~F.col("tagged") & F.coalesce(F.col("_content").rlike(PARAMETER), F.lit(False)),
            "rollover_target": extract(F.col("_content"), ROLLOVER),
        }
    ).withColumns(
        # only what is no epoch time is matched against ISO 8601
        dict(zip(("_date", "_clock", "_offset"), iso_parts(F.when(F.col("_epoch").isNull(), F.col("time_text"))), strict=True))
    ).withColumn("_day", F.when(F.col("_epoch").isNull(), iso_from(F.col("_date"), F.col("_clock"), F.col("_offset")))).withColumn("record_time", format_time(F.coalesce("_epoch", "_day"))).drop("_tag", "_content", "_epoch", "_date", "_clock", "_offset", "_day")


def severity(message: Column) -> Column:
    """err, warn or null; ERR beats WARN."""
    return F.when(message.contains("<ERR>"), "err").when(message.contains("<WARN>") | message.contains("<WRN>"), "warn")


def artifact_name(reference: Column, suffix: str | None = None) -> Column:
    """Slashes become underscores; ``suffix`` is added where there is no dot."""
    name = F.translate(reference, "/", "_")
    return F.when(~name.contains("."), F.concat(name, F.lit(suffix))).otherwise(name) if suffix else name


def log_epoch_time(raw: Column) -> Column:
    """The text before the first colon (it cuts an ISO time short, as published rows do)."""
    return F.split_part(raw, F.lit(":"), F.lit(1))
