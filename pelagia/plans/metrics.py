"""Counters and first examples of a run, gathered by the jobs that write its tables, and summaries of both containers.

Every table is observed as it is written (``DataFrame.observe``), so no row is
read a second time. The values that a counter tells apart are fixed by the
record format, so what comes back has a fixed size.
"""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pelagia.functions.families import ACQUISITION, ASCENT, BATTERY
from pelagia.operators.mer import ENVIRONMENT, FORMAT_KEYS, INFO_KEYS, PARAMETERS, attributes

#: What is counted in each family besides its rows: a name, the counted value and the values that it can have.
COUNTED: dict[str, tuple[tuple[str, Column, tuple[str, ...]], ...]] = {}


def _counted() -> dict[str, tuple[tuple[str, Column, tuple[str, ...]], ...]]:
    if not COUNTED:  # columns need a session
        of = lambda column, values: (column, F.col(column), tuple(dict.fromkeys(values)))
        pair = F.concat_ws(":", "acquisition_state", "acquisition_evidence_kind")
        COUNTED.update(
            log_acquisition=(of("acquisition_state", (s for s, _ in ACQUISITION.values())), of("acquisition_evidence_kind", (k for _, k in ACQUISITION.values())), ("acquisition", pair, tuple(":".join(v) for v in ACQUISITION.values()))),
            log_ascent_request=(of("ascent_request_state", ASCENT.values()),),
            log_gps=(of("gps_record_kind", ("fix_attempt", "fix_position", "dop", "gps_ack", "gps_off")),),
            log_battery=(of("battery_record_kind", (k for k, _, _ in BATTERY)),),
            log_unclassified=(of("unclassified_reason", ("rollover_banner", "no_family_match")), of("severity", ("err", "warn"))),
            log_iridium=(of("session_kind", ("explicit_session", "event_sequence")),),
            mer_environment=(of("environment_kind", (*(t.lower() for t in ENVIRONMENT), "unknown")),),
            mer_parameter=(of("parameter_kind", (*(t.lower() for t in PARAMETERS), "unknown")),),
        )
    return COUNTED


def counters(name: str, columns: list[str]) -> list[Column]:
    """Aggregates over the rows of a table: their number, the source lines that they hold, and each counted value with its first record."""
    grouped = "source_line_numbers" in columns
    lines = F.sum(F.size("source_line_numbers")) if grouped else F.count("*")
    place = next(c for c in ("source_line_number", "line_start_index", "line_number", "event_pos", "line_pos", "block_index", "source_file") if c in columns)
    out = [F.count("*").alias("n"), F.coalesce(lines, F.lit(0)).cast("long").alias("lines")]
    for k, (_, value, values) in enumerate(_counted().get(name, ())):
        for j, v in enumerate(values):
            own = F.when(value == v, F.struct("source_path", *((F.col("body_pos"),) if "body_pos" in columns else ()), F.col(place)))
            record = F.struct(*(c for c in columns if c != "source_path"))
            out += [F.count_if(value == v).alias(f"n{k}_{j}"), F.min_by(record, own).alias(f"e{k}_{j}")]
    return out


def counted_rows(name: str, got: dict[str, Any]) -> list[tuple[str, str, int, str | None]]:
    """(family, counter, n, example) of what was observed."""
    rows = [(name, "records", got["n"], None), (name, "source_lines", got["lines"], None)]
    for k, (column, _, values) in enumerate(_counted().get(name, ())):
        for j, v in enumerate(values):
            if got.get(f"n{k}_{j}"):
                rows.append((name, f"{column}={v}", got[f"n{k}_{j}"], json.dumps(got[f"e{k}_{j}"].asDict(recursive=True), default=str)))
    return rows


def log_summary(rows: list) -> dict:
    """The LOG part of a run's ``metrics`` rows: records and source lines by family, counts and first examples by counter."""
    out: dict[str, Any] = {"total_records": 0, "family_record_counts": {}, "family_source_line_counts": {}, "counts": {}, "examples": {}}
    for r in rows:
        if not r.family.startswith("log_"):
            continue
        family = r.family.removeprefix("log_")
        if r.counter == "records":
            out["family_record_counts"][family] = r.n
            out["total_records"] += r.n
        elif r.counter == "source_lines":
            out["family_source_line_counts"][family] = r.n
        else:
            column, _, value = r.counter.partition("=")
            out["counts"].setdefault(column, {})[value] = r.n
            out["examples"].setdefault(column, {})[value] = json.loads(r.example)
    return out


def value_counts(rows: DataFrame, name: str) -> DataFrame:
    """(family, counter, value, n, first_path, first_line) of a table's counted values, as rows: what ``counters`` observes, for any rows of a single-line family."""
    pairs = F.array(*(F.struct(F.lit(c).alias("counter"), v.cast("string").alias("value")) for c, v, _ in _counted()[name]))
    every = rows.select("source_path", "source_line_number", F.explode(pairs).alias("c")).where("c.value is not null")
    first = F.min(F.struct("source_path", "source_line_number")).alias("first")
    counts = every.groupBy("c.counter", "c.value").agg(F.count("*").alias("n"), first)
    return counts.select(F.lit(name).alias("family"), "counter", "value", "n", F.col("first.source_path").alias("first_path"), F.col("first.source_line_number").alias("first_line"))


def mer_summary(files: DataFrame, lines: DataFrame, framed: DataFrame) -> DataFrame:
    """(item, key, n): what MER files hold, of ``files`` (source_path), their metadata ``lines`` and their ``framed`` events.

    Items: total_files, zero_event_files, event_blocks,
    environment_kind and parameter_kind by kind, and how often each unknown tag
    or key occurs: unknown_environment_tag, unknown_parameter_tag,
    unknown_info_key, unknown_format_key. Sets of names are rows, so none is
    gathered in one place. Each of the three inputs is read once.
    """
    item = lambda name, key=F.lit(""): F.struct(F.lit(name).alias("item"), key.alias("key"))
    odd = lambda line, keys: F.array_except(F.map_keys(attributes(F.coalesce(line, F.lit("")))), F.array(*map(F.lit, keys)))
    named = lambda keys, name: F.transform(keys, lambda k: item(name, k))
    unknown = (named(odd("info_line", INFO_KEYS), "unknown_info_key"), named(odd("format_line", FORMAT_KEYS), "unknown_format_key"))
    held = framed.where("error is null").select("source_path", F.explode(F.concat(F.array(item("event_blocks")), *unknown)).alias("i")).select("source_path", "i.*")
    by_file = files.select("source_path", F.lit("total_files").alias("item"), F.lit("").alias("key")).unionByName(held).groupBy("source_path", "item", "key").agg(F.count("*").alias("n"))
    # a file counts once; it has no event until a row of its events takes that back
    once = F.when(F.col("item") == "total_files", F.array(F.struct("item", "key", F.lit(1).cast("long").alias("n")), F.struct(F.lit("zero_event_files").alias("item"), "key", F.lit(1).cast("long").alias("n"))))
    own = F.struct("item", "key", "n")
    by_item = by_file.select(F.explode(once.when(F.col("item") == "event_blocks", F.array(own, F.struct(F.lit("zero_event_files").alias("item"), "key", F.lit(-1).cast("long").alias("n")))).otherwise(F.array(own))).alias("i")).select("i.*")
    of_line = None
    for section, tags in (("environment", ENVIRONMENT), ("parameter", PARAMETERS)):
        known = F.col("tag").isin(*tags)
        made = F.when(known, F.array(item(f"{section}_kind", F.lower("tag")))).otherwise(F.array(item(f"{section}_kind", F.lit("unknown")), item(f"unknown_{section}_tag", F.col("tag"))))
        of_line = F.when(F.col("section") == section, made) if of_line is None else of_line.when(F.col("section") == section, made)
    tagged = lines.select(F.explode(of_line).alias("i")).select("i.*", F.lit(1).cast("long").alias("n"))
    return by_item.unionByName(tagged).groupBy("item", "key").agg(F.sum("n").alias("n")).where("n <> 0")
