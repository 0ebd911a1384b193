"""Ordered grouping of lines into episodes, as an exact walk.

The lines of a file, sorted by line_number, move a state of five values. A
line's flags are one small code, so a step is a look-up. Very long files are
walked in blocks of lines, spread over tasks by composing what each block does
to every state.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from pelagia.functions.families import COMMAND, event_fields, event_kind
from pelagia.functions.lines import strip

#: Subsystems and messages that steer the grouping.
CTD_SUBSYSTEMS = ("SBE", "SBE41", "SBE61", "PROFIL")
TEST_EXITS = ("end of test mode", "reboot mermaid board", "reboot float")
#: Lines that one task walks of a file in one go.
BLOCK_LINES = 50_000
#: What a line may find open.
STATES = (None, "testmode", "iridium", "ctd", "parameter")
FLAGS = ("is_test", "is_exit", "ir_start", "ir_event", "ir_line", "ir_end", "ctd_hard", "ctd_soft")
#: What a line's code tells, a bit each, and the number of such codes.
CODED = ("tagged", "is_parameter", *FLAGS)
LINE_CODES = 1 << len(CODED)


def predicates(lines: DataFrame) -> DataFrame:
    """Adds the flags of FLAGS, false on untagged lines."""
    # stripped once and classified once, not in every flag
    lines = lines.withColumn("_own", strip(F.col("message"))).withColumn("_low", F.lower("_own"))
    lines = lines.withColumn("_kind", event_kind(F.col("message"), F.col("_own"), F.col("_low")))
    own, low, kind = F.col("_own"), F.col("_low"), F.col("_kind")
    stage = F.col("subsystem") == "STAGE"
    flags = {
        "is_test": F.col("subsystem") == "TESTMD",
        "is_exit": ((F.col("subsystem") == "TESTMD") & low.isin('"q"', '"quit"')) | low.isin(*TEST_EXITS) | low.startswith("rebooting with code"),
        "ir_start": low.startswith("iridium...") & own.rlike(r"(?i)^Iridium\.\.\.$"),
        "ir_event": kind != "session_line",
        "ir_line": (kind != "session_line") | own.startswith("$") & own.rlike(COMMAND),
        "ir_end": low.contains("connect") & (own.rlike(r"(?i)disconnected after \d+s") | own.rlike(r"(?i)no connection after \d+s")),
        "ctd_hard": F.col("subsystem").isin(*CTD_SUBSYSTEMS) | (stage & (F.col("message").contains("SBE41") | F.col("message").contains("SBE61"))),
        "ctd_soft": stage,
    }
    return lines.withColumns({n: F.col("tagged") & F.coalesce(c, F.lit(False)) for n, c in flags.items()}).drop("_own", "_low", "_kind")


def advance(state: str | None, r: dict) -> tuple[str | None, bool, str | None]:
    """(episode, starts, next state) of a line after ``state``: the plain meaning of the grouping."""
    if state == "testmode":
        return "testmode", False, None if r["is_exit"] else state
    if r["tagged"] and state == "iridium" and (r["ir_start"] or r["ir_line"]):
        return "iridium", r["ir_start"], None if r["ir_end"] else "iridium"
    new = None
    if r["is_test"]:
        new = "testmode"
    elif r["ctd_hard"] or (r["ctd_soft"] and state == "ctd"):
        new = "ctd"
    elif r["ir_event"]:
        new = "iridium"
    elif r["is_parameter"]:
        new = "parameter"
    ends = (new == "testmode" and r["is_exit"]) or (new == "iridium" and r["ir_end"])
    return new, new is not None and new != state or new in ("testmode", "iridium"), None if ends else new


def walk(rows: Iterable[dict], state: str | None = None) -> list[tuple[str | None, bool]]:
    """(episode, starts) of each line, in order, from ``state`` on."""
    out = []
    for r in rows:
        episode, starts, state = advance(state, r)
        out.append((episode, starts))
    return out


@cache
def _moves() -> tuple[list[int], np.ndarray, np.ndarray]:
    """``advance`` as tables by state and code: next state, episode (as a place in STATES) and whether it starts.

    A code holds the FLAGS of a line as bits; one of LINE_CODES + k stands for no
    line and sets the state k.
    """
    after, episode, starts = ([0] * (len(STATES) * 2 * LINE_CODES) for _ in range(3))
    for s, state in enumerate(STATES):
        for code in range(LINE_CODES):
            key = s * 2 * LINE_CODES + code
            own, begins, then = advance(state, {n: bool(code >> k & 1) for k, n in enumerate(CODED)})
            after[key], episode[key], starts[key] = STATES.index(then), STATES.index(own), int(bool(begins))
        for k in range(len(STATES)):
            after[s * 2 * LINE_CODES + LINE_CODES + k] = k
    return after, np.array(episode, "int8"), np.array(starts, bool)


def _transition(codes: list[int]) -> list[tuple[int, list[int]]]:
    after, episode, starts = _moves()
    out = []
    for state in range(len(STATES)):
        keys = []
        for code in codes:
            key = state * 2 * LINE_CODES + code
            keys.append(key)
            state = after[key]
        own = np.array(keys, "int64")
        out.append((state, np.bincount(episode[own][starts[own]], minlength=len(STATES)).tolist()))
    return out


def transition(rows: list[dict]) -> list[tuple[int, list[int]]]:
    """What a block of lines does to each state of STATES: the state after it, and the episodes that start in it by kind."""
    return _transition([sum(bool(r[n]) << k for k, n in enumerate(CODED)) for r in rows])


def _begins(rows: DataFrame, source: str) -> DataFrame:
    """(source, _block, _code, _count) of every block of ``rows`` (source, _block, line_number, _code): the state, as a code, and the counts that it begins with.

    Each block is reduced to its transition, one row a block, and a file's
    transitions are composed in order. No task holds a file's lines. Counts are
    text, as Spark's measuring of Arrow batches is quadratic in the rows of one
    whose array column is null.
    """

    def reduce(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        made = _transition(pdf.sort_values("line_number")["_code"].tolist())
        return pd.DataFrame({source: [key[0]], "_block": [key[1]], "ends": [[e for e, _ in made]], "counts": [[n for _, own in made for n in own]]})

    def compose(pdf: pd.DataFrame) -> pd.DataFrame:
        state, count, out, width = 0, [0] * len(STATES), [], len(STATES)
        for r in pdf.sort_values("_block").itertuples(index=False):
            out.append((r[0], r[1], LINE_CODES + state, " ".join(map(str, count))))
            count = [x + y for x, y in zip(count, r[3][state * width : (state + 1) * width], strict=True)]
            state = r[2][state]
        return pd.DataFrame(out, columns=[source, "_block", "_code", "_count"])

    kind = rows.schema[source].dataType.simpleString()
    maps = rows.groupBy(source, "_block").applyInPandas(reduce, f"`{source}` {kind}, _block long, ends array<int>, counts array<long>")
    return maps.groupBy(source).applyInPandas(compose, f"`{source}` {kind}, _block long, _code int, _count string")


def _unlike_last(column: pa.Array) -> np.ndarray:
    """Whether each value but the first differs from the one before it."""
    one, two = column.slice(1), column.slice(0, len(column) - 1)
    both, either = pc.and_(one.is_null(), two.is_null()), pc.or_(one.is_null(), two.is_null())
    return pc.if_else(either, pc.invert(both), pc.fill_null(pc.not_equal(one, two), True)).to_numpy(zero_copy_only=False)


def _follow(source: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The walk over rows sorted by source, _block and line_number; a block's row without a line comes first and says how it begins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        after, episodes, begin = _moves()
        names, wide = pa.array(STATES, pa.string()), 2 * LINE_CODES
        last, state, count = None, 0, np.zeros(len(STATES), "int64")
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            files, blocks, codes = b.column(source), b.column("_block").to_numpy(), b.column("_code").to_numpy()
            new = np.ones(n, bool)
            new[1:] = _unlike_last(files) | (blocks[1:] != blocks[:-1])
            new[0] = (files[0].as_py(), blocks[0]) != last
            last = (files[n - 1].as_py(), blocks[n - 1])
            keys = []
            for code, fresh in zip(codes.tolist(), new.tolist(), strict=True):
                key = code if fresh else state * wide + code
                keys.append(key)
                state = after[key]
            own = np.array(keys, "int64")
            episode, starts, group = episodes[own], begin[own], np.cumsum(new)
            heads = np.flatnonzero(codes >= LINE_CODES)
            at = np.concatenate(([0], np.flatnonzero(new)))  # the first is the block that the batch before ended in
            before = np.zeros((len(at), len(STATES)), "int64")
            before[0] = count
            for i in heads:
                before[group[i]] = [int(x) for x in b.column("_count")[int(i)].as_py().split()]
            index = np.zeros(n, "int64")
            for k in range(1, len(STATES)):
                seen = np.concatenate(([0], np.cumsum(starts & (episode == k))))
                base = before[:, k] - seen[at]
                index = np.where(episode == k, seen[1:] + base[group] - 1, index)
                count[k] = seen[-1] + base[-1]
            keep = [c for c in b.schema.names if c not in ("_block", "_code", "_count")]
            made = pa.RecordBatch.from_arrays([*map(b.column, keep), names.take(pa.array(episode)), pa.array(index, mask=episode == 0)], [*keep, "episode", "episode_index"])
            yield made.filter(pa.array(codes < LINE_CODES)) if len(heads) else made

    return run


def group_episodes(lines: DataFrame, source: str = "source_path", *, block: int = BLOCK_LINES, keep: tuple[str, ...] | None = None, large: DataFrame | None = None) -> DataFrame:
    """Adds episode (testmode, iridium, ctd, parameter or null) and episode_index.

    ``lines`` has line_number, raw_line and what parse_lines adds; ``keep`` names
    the columns that the result carries, all where it is None. episode_index
    counts from 0 per file and episode family. Lines are parsed, shuffled and
    sorted once and walked as they stream by, so a task's memory is that of its
    sort, which spills. Files of more than ``block`` lines are spread over blocks;
    their names, one for ``block`` lines at least, are sent to all tasks. ``large``
    gives the lines of the files that may be so long, where fewer have to be looked at.
    """
    kept = list(lines.columns if keep is None else dict.fromkeys((source, "line_number", *keep)))
    coded = lambda rows: predicates(rows).withColumns({"_code": sum(F.when(F.col(n), 1 << k).otherwise(0) for k, n in enumerate(CODED)), "_block": F.floor((F.col("line_number") - 1) / block)})
    large = lines if large is None else large
    long = large.where(F.col("line_number") > block).select(source).distinct()
    begins = _begins(coded(large.join(F.broadcast(long), source, "left_semi")).select(source, "_block", "line_number", "_code"), source)
    rows = coded(lines).select(*kept, "_block", "_code").unionByName(begins, allowMissingColumns=True)
    made = StructType([StructField(f.name, f.dataType) for f in rows.schema if f.name in kept]).add("episode", "string").add("episode_index", "long")
    return rows.repartition(source, "_block").sortWithinPartitions(source, "_block", "line_number").mapInArrow(_follow(source), made)


def build_episodes(grouped: DataFrame, source: str = "source_path", *more: Column) -> DataFrame:
    """One row per episode: line span, times of its first and last timed line, lines, and the aggregates ``more``; rows without a line_number are no lines."""
    timed = F.when(F.col("record_time").isNotNull(), F.col("line_number"))
    line = F.struct("line_number", "raw_line", "message", "tagged", "record_time", "time_text", "subsystem", "code")
    rows = grouped.where("episode is not null").groupBy(source, "episode", "episode_index").agg(
        F.min("line_number").alias("line_start_index"), F.max("line_number").alias("line_end_index"),
        F.min_by("record_time", timed).alias("start_record_time"), F.max_by("record_time", timed).alias("end_record_time"),
        F.min_by("time_text", timed).alias("start_log_epoch_time"), F.max_by("time_text", timed).alias("end_log_epoch_time"),
        F.sort_array(F.collect_list(F.when(F.col("line_number").isNotNull(), line))).alias("lines"), *more,
    )
    return rows.withColumns({"source_line_numbers": F.transform("lines", lambda x: x["line_number"]), "raw_lines": F.transform("lines", lambda x: x["raw_line"])})


CTD_SAMPLE = r"\bP\s*([+-]?\d+)\s*,\s*T\s*([+-]?\d+)\s*,\s*S\s*([+-]?\d+)\b"


def ctd_samples(episodes: DataFrame) -> DataFrame:
    """Adds ctd_samples and ctd_sample_count to CTD episodes."""
    def sample(x: Column) -> Column:
        parts = [F.regexp_extract(x["message"], CTD_SAMPLE, i) for i in (1, 2, 3)]
        raw = F.struct(*(p.alias(n) for p, n in zip(parts, "PTS", strict=True)))
        names = ("pressure_cbar_tenths", "temperature_mdegc_tenths", "salinity_psu_thousandths")
        return F.struct(x["line_number"].alias("source_line_number"), raw.alias("raw_values"), *(p.try_cast("long").alias(n) for p, n in zip(parts, names, strict=True)))

    own = F.filter("lines", lambda x: F.coalesce(x["message"].rlike(CTD_SAMPLE), F.lit(False)))
    rows = episodes.where("episode = 'ctd'").withColumn("ctd_samples", F.transform(own, sample))
    return rows.withColumn("ctd_sample_count", F.size("ctd_samples").cast("long"))


def iridium_sessions(episodes: DataFrame) -> DataFrame:
    """Adds session_kind, iridium_events and iridium_event_count to Iridium episodes."""
    # one step after the other, or each field would classify the message again
    def known(x: Column) -> Column:
        own = strip(x["message"])
        return F.struct(x.alias("line"), own.alias("own"), event_kind(x["message"], own).alias("kind"))

    def event(x: Column) -> Column:
        own = [x["line"][n].alias(n) for n in ("record_time", "subsystem", "code", "message")]
        fields = [c.alias(f) for f, c in event_fields(x["own"], x["kind"]).items()]
        return F.struct(x["line"]["line_number"].alias("source_line_number"), own[0], x["line"]["time_text"].alias("log_epoch_time"), *own[1:], x["kind"].alias("iridium_event_kind"), *fields, x["line"]["raw_line"].alias("raw_line"))

    rows = episodes.where("episode = 'iridium'").withColumn("iridium_events", F.transform(F.transform(F.filter("lines", lambda x: x["tagged"]), known), event))
    explicit = F.exists("iridium_events", lambda e: e["iridium_event_kind"] == "session_start")
    return rows.withColumns({"session_index": F.col("episode_index"), "session_kind": F.when(explicit, "explicit_session").otherwise("event_sequence"), "iridium_event_count": F.size("iridium_events").cast("long")})
