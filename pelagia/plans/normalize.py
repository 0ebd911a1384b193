"""A normalisation run: raw files to record families, quarantine, state and manifests.

A run lists the sources, reads what changed once, parses it once into a staging
table and writes the families of the instruments concerned into folders of its
own; then it is published as a whole (see ``journal``).
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pelagia import __version__
from pelagia.functions.families import FAMILIES, KINDS_OF, PRESSURE_FIELDS, classified, event_kind, family_fields, matches
from pelagia.functions.filenames import record_filename, validated_serial
from pelagia.functions.lines import explode_lines, log_epoch_time, parse_lines
from pelagia.operators import mer
from pelagia.operators.episodes import BLOCK_LINES, build_episodes, ctd_samples, group_episodes, iridium_sessions
from pelagia.operators.state import actions, diff_sources, invalidated, paths_for, snapshot_id
from pelagia.plans import journal, manifests
from pelagia.plans.metrics import counted_rows, counters
from pelagia.sources import mer_format
from pelagia.sources.files import authoritative, belonging_to, contents, decoded_owner, identify, instrument, listing, named, vit_names

SINGLE = (*FAMILIES, "unclassified")
GROUPED = ("parameter", "testmode", "ctd", "iridium")
LOG_FAMILIES = tuple(f"log_{f}" for f in (*SINGLE, *GROUPED))
MER_FAMILIES = ("mer_environment", "mer_parameter", "mer_event")
QUARANTINE = ("malformed_log_lines", "untimed_log_episodes", "malformed_mer_blocks", "skipped_files")
#: Parsed columns that a line's family is told from.
JUDGED = ("tagged", "is_blank", "rollover_target", "record_time", "message")
#: Of a line's place: it is read twice, or held by several tables, or by none though it is not blank.
_WRONG = "times > 1 or n > 1 or (n = 0 and not blank)"
#: Rows of one data file at most.
RECORDS_A_FILE = 2_000_000
#: Turns BIN files (source_path, prefix, stem, content, ...) into LOG files (prefix, stem, content).
Decoder = Callable[[DataFrame], DataFrame]
#: Columns that begin every row, and those of an episode.
PREFIX = ("instrument_id", "instrument_serial", "records_version", "source_file", "source_id", "source_sha256")
_EPISODE = ("source_path", "episode_index", "line_start_index", "line_end_index", "source_line_numbers", "start_record_time", "end_record_time", "start_log_epoch_time", "end_log_epoch_time", "raw_lines")


@dataclass
class LogTables:
    families: dict[str, DataFrame]
    malformed: DataFrame
    untimed: DataFrame
    lines: DataFrame


@dataclass
class MerTables:
    families: dict[str, DataFrame]
    quarantine: DataFrame
    skipped: DataFrame


def grouped_lines(files: DataFrame, *, keep: tuple[str, ...] | None = None) -> DataFrame:
    """Every line of ``files`` (source_path, content, ...) parsed, in its episode, with its family; this is all that the log tables read.

    ``keep`` names the parsed columns that are carried besides those of ``JUDGED``, all where it is None.
    """
    lines = lambda some: parse_lines(explode_lines(some.select("source_path", "content")))
    # a file of more lines than a block has as many bytes at least
    large = lines(files.where(F.octet_length("content") >= BLOCK_LINES))
    rows = group_episodes(lines(files), keep=None if keep is None else (*keep, *JUDGED), large=large)
    ordinary = F.col("episode").isNull() & ~F.col("is_blank")
    fine = (F.col("tagged") | F.col("rollover_target").isNotNull()) & F.col("record_time").isNotNull()
    rows = rows.withColumn("_found", F.when(ordinary & fine & F.col("tagged"), matches(F.col("message"))))
    family = F.when(ordinary & ~fine, "malformed").when(ordinary & F.col("tagged"), classified(F.col("_found"), F.col("message"))).when(ordinary, "unclassified")
    return rows.withColumn("family", family).drop("_found")


def log_tables(files: DataFrame) -> LogTables:
    """The ten LOG families and what is in none of them, of ``files`` (source_path, content, ...)."""
    return tables_of(grouped_lines(files))


def tables_of(lines: DataFrame) -> LogTables:
    """``log_tables`` of lines that ``grouped_lines`` made."""
    malformed = lines.where("family = 'malformed'").select("source_path", "line_number", "raw_line", F.lit("no tagged, parameter or rollover line with a time").alias("error"))
    rows = lines.where("family is not null and family <> 'malformed'")
    rows = rows.withColumns({"subsystem": F.when(F.col("tagged"), F.col("subsystem")).otherwise("ROLLOVER"), "message": F.coalesce("message", F.expr("substring(raw_line, instr(raw_line, ':') + 1)"))})
    tables = {}
    for family in SINGLE:
        fields = family_fields(family, F.col("message"))
        own = rows.where(F.col("family") == family).withColumns(fields)
        tables[f"log_{family}"] = own.select("source_path", F.lit("log").alias("source_container"), "record_time", log_epoch_time(F.col("raw_line")).alias("log_epoch_time"), "subsystem", "code", "message", F.col("line_number").alias("source_line_number"), *fields, "raw_line")
    episodes = build_episodes(lines)
    # an episode without one parseable time is kept apart, not fatal
    timed = episodes.where("start_record_time is not null")
    untimed = episodes.where("start_record_time is null").select("source_path", "episode", "episode_index", "source_line_numbers", "raw_lines", F.lit("no parseable time").alias("error"))
    for family in ("parameter", "testmode"):
        tables[f"log_{family}"] = timed.where(F.col("episode") == family).select(*_EPISODE)
    tables["log_ctd"] = ctd_samples(timed).select(*_EPISODE, "ctd_sample_count", "ctd_samples")
    tables["log_iridium"] = iridium_sessions(timed).select(*_EPISODE, F.lit("log").alias("source_container"), "session_index", "session_kind", "iridium_event_count", "iridium_events")
    return LogTables(tables, malformed, untimed, rows)


def mer_tables(files: DataFrame, *, strict: bool = False) -> MerTables:
    """The three MER families, the quarantined blocks and the files that hold nothing.

    ``strict`` keeps odd metadata lines and events without INFO as records and
    fails the job on any other block that can't be one.
    """
    return mer_tables_of(mer.sections(files), mer.events(files), mer.hopeless(files), strict=strict)


def read_mer(spark: SparkSession, root: str, *, strict: bool = False) -> MerTables:
    """``mer_tables`` of all MER files below ``root``, framed as they are read (see ``mer_format``)."""
    return mer_tables_of(*mer_format.framed(spark, root), strict=strict)


def mer_tables_of(lines: DataFrame, events: DataFrame, hopeless: DataFrame, *, strict: bool = False) -> MerTables:
    """``mer_tables`` of metadata lines, framed events and files without either."""
    framed = mer.judged(events, strict=strict)
    bad = framed.where("error is not null").select("source_path", F.col("event_pos").alias("block_index"), "block_kind", F.concat_ws("\n", "info_line", "format_line").alias("raw_block"), "error")
    if strict:
        said = F.concat(F.lit("malformed MER block in "), F.col("source_path"), F.lit(": "), F.col("error"))
        framed = framed.withColumn("event_pos", F.when(F.col("error").isNull(), F.col("event_pos")).otherwise(F.raise_error(said).cast("long"))).where("event_pos >= 0")
        good, quarantine = lines, bad.limit(0)
    else:
        good, quarantine = lines.where(mer.tag_line()), bad.unionByName(mer.odd_metadata(lines))
    env, par = mer.environment(good), mer.parameters(good)
    own = lambda df: df.withColumn("source_container", F.lit("mer"))
    tables = {"mer_environment": own(env), "mer_parameter": own(par), "mer_event": own(mer.event_records(framed, par, env))}
    return MerTables(tables, quarantine, hopeless)


def unassigned(tables: LogTables, lines: DataFrame) -> DataFrame:
    """Source lines that are in no table, or in more than one: must be empty."""
    seen = tables.malformed.select("source_path", "line_number")
    for t in (*tables.families.values(), tables.untimed):
        own = t.select("source_path", F.explode("source_line_numbers").alias("line_number")) if "source_line_numbers" in t.columns else t.select("source_path", F.col("source_line_number").alias("line_number"))
        seen = seen.unionByName(own)
    times = seen.groupBy("source_path", "line_number").agg(F.count("*").alias("n"))
    return lines.join(times, ["source_path", "line_number"], "left").where("coalesce(n, 0) <> 1 and not (n is null and is_blank)")


def misassigned(lines: DataFrame) -> DataFrame:
    """(source_path, line_number) of lines of ``grouped_lines`` that the tables would not hold exactly once: must be empty."""
    rows = lines.groupBy("source_path", "line_number").agg(F.sum(_tables()).alias("n"), F.count("*").alias("times"), F.bool_and("is_blank").alias("blank"))
    return rows.where(_WRONG)


def _tables() -> Column:
    """How many tables hold a line of ``grouped_lines``."""
    single = F.col("family").isNotNull().cast("int")
    return F.coalesce(single + F.col("episode").isin(*GROUPED).cast("int"), single)


def accounted(lines: DataFrame) -> DataFrame:
    """(held_by, n_lines) of lines of ``grouped_lines``, and how many of them are ``misassigned``, all in one pass over the lines."""
    holder = F.coalesce("family", "episode", F.when(F.col("is_blank"), "blank"))
    # a line counts once for what holds it, once for its own place
    place = lambda own, *at: F.struct(F.lit(own).alias("own"), *(c.alias(n) for c, n in zip(at, ("held_by", "source_path", "line_number"), strict=True)))
    held = place(False, holder, F.lit(None).cast("string"), F.lit(None).cast("long"))
    own = place(True, F.lit("misassigned"), F.col("source_path"), F.col("line_number"))
    both = lines.select(_tables().alias("n"), "is_blank", F.explode(F.array(held, own)).alias("at")).select("n", "is_blank", "at.*")
    rows = both.groupBy("own", "held_by", "source_path", "line_number").agg(F.sum("n").alias("n"), F.count("*").alias("times"), F.bool_and("is_blank").alias("blank"))
    counts = rows.select("held_by", F.when(~F.col("own"), F.col("times")).when(F.expr(_WRONG), 1).otherwise(0).alias("n_lines"))
    none = lines.sparkSession.sql("SELECT 'misassigned' AS held_by, 0L AS n_lines")
    return counts.unionByName(none).groupBy("held_by").agg(F.sum("n_lines").alias("n_lines"))


def _fail_on(rows: DataFrame, what: str, place: Column) -> None:
    """Ends the run with up to three examples if there are rows."""
    some = [r.p for r in rows.select(place.alias("p")).limit(3).collect()]
    if some:
        raise ValueError(f"{what}: {'; '.join(some)}")


def sources(spark: SparkSession, root: str | list[str], out: str | None = None) -> DataFrame:
    """Every source with its instrument, each file read."""
    found = listing(spark, root)
    state = manifests.latest_state(spark, out) if out is not None else None
    return _identified(spark, found.join(contents(spark, root, found), "source_path"), root, state)


def _identified(spark: SparkSession, files: DataFrame, root: str | list[str], state: DataFrame | None) -> DataFrame:
    """``files`` (listing, named_serial, ...) with their instruments."""
    folder, previous = root if isinstance(root, str) else None, None
    if state is not None:
        name = F.split_part(F.element_at(F.split("source_file", "/"), -1), F.lit("_"), F.lit(1))
        previous = state.groupBy(F.regexp_replace(name, r"\.[^.]+$", "").alias("prefix")).agg(F.max("instrument_serial").alias("serial"))
    sniffed = files.where("named_serial is not null").select("source_path", F.col("named_serial").alias("serial"))
    return identify(files, vit_names(spark, folder) if folder else None, folder or "", previous, sniffed)


def _state(files: DataFrame, root: str | list[str], fingerprint: str | None) -> DataFrame:
    where = root if isinstance(root, str) else ""
    return files.select(
        "instrument_serial", F.col("source_path").alias("source_file"), "source_kind", "size_bytes", "modified_at", F.col("source_sha256").alias("content_hash"), "named_serial",
        F.lit(where).alias("input_root"), F.lit(__version__).alias("normalization_version"), F.lit(fingerprint).cast("string").alias("decoder_fingerprint"),
    )


def _family() -> Column:
    return F.when(F.col("source_kind") == "mer", "mer").otherwise("log")


def _owned(rows: DataFrame, files: DataFrame) -> DataFrame:
    """``rows`` of ``files`` with the columns that begin every record."""
    named = F.coalesce(instrument(F.col("instrument_serial"))["instrument_id"], F.col("instrument_serial"))
    own = files.select("source_path", named.alias("instrument_id"), "instrument_serial", F.lit(__version__).alias("records_version"), "source_file", F.concat(F.lit("sha256:"), "source_sha256").alias("source_id"), "source_sha256")
    joined = rows.join(own, "source_path")
    return joined.select(*PREFIX, *(c for c in joined.columns if c not in PREFIX))


def reached(step: str) -> None:
    """Called as a run has come to a step; the tests break off here."""


@dataclass
class _Plan:
    """What a run found: sources with their instruments, what it has read of them, and the difference with its actions."""

    files: DataFrame
    bins: DataFrame
    read: DataFrame
    state: DataFrame
    told: DataFrame


def _plan(
    spark: SparkSession, root: str | list[str], out: str, found: DataFrame, keep: Callable[[DataFrame, str], DataFrame], *,
    previous: DataFrame | None, force: bool, serial: str | None, decoder: Decoder | None, fingerprint: str | None,
) -> _Plan:
    """The difference between the sources and the kept state.

    Hashes are memoised: a file whose path, size and modification time are those
    of the kept state has its kept hash, and only the others are read, once.
    ``keep`` stores a table that is used more than once.
    """
    found = keep(found, "listing")
    stateful = isinstance(root, str)
    kept = spark.createDataFrame([], f"{manifests.TABLES['source_state']}, run_id string") if not stateful else manifests.latest_state(spark, out) if previous is None else previous
    for column in ("modified_at", "named_serial"):
        if column not in kept.columns:
            kept = kept.withColumn(column, F.lit(None).cast("timestamp" if column == "modified_at" else "string"))
    same = ["source_path", "size_bytes", "modified_at"]
    memo = kept.withColumnRenamed("source_file", "source_path").groupBy(*same).agg(F.max("content_hash").alias("kept_hash"), F.max("named_serial").alias("kept_serial"))
    known = found.join(memo.where(F.lit(not force)), same, "left")
    unread = known.where("kept_hash is null" + ("" if decoder is not None else " and source_kind <> 'bin'"))
    read = keep(contents(spark, root, unread), "read")
    fresh = read.select("source_path", F.col("source_sha256").alias("own_hash"), F.col("named_serial").alias("own_serial"))
    hashed = known.join(fresh, "source_path", "left").withColumns({"source_sha256": F.coalesce("own_hash", "kept_hash"), "named_serial": F.when(F.col("own_hash").isNotNull(), F.col("own_serial")).otherwise(F.col("kept_serial"))})
    every = keep(_identified(spark, hashed.drop("own_hash", "own_serial", "kept_hash", "kept_serial"), root, kept if stateful else None), "files")
    if serial is not None:
        every, kept = belonging_to(every, serial), kept.where(F.col("instrument_serial") == serial)
    bins = every.where("source_kind = 'bin'")
    files = authoritative(every) if decoder is not None else every.where("source_kind <> 'bin'")
    state = _state(files, root, fingerprint)
    diff = diff_sources(kept, state)
    if stateful:
        failed = manifests.latest_runs(spark, out).where("status <> 'success'")
        spoilt = invalidated(kept, state, failed) if set(state.columns) <= set(kept.columns) else None
        plan = actions(diff, force=force, spoilt=spoilt)
    else:
        plan = actions(diff, force=True)
    told = diff.withColumn("family", _family()).join(plan.select("instrument_serial", "family", "action"), ["instrument_serial", "family"])
    return _Plan(files, bins, read, state, told)


def normalize(
    spark: SparkSession, root: str | list[str], out: str, previous: DataFrame | None = None, *, force: bool = False, dry_run: bool = False, strict: bool = False,
    serial: str | None = None, decoder: Decoder | None = None, fingerprint: str | None = None, manifest: bool = True,
) -> DataFrame:
    """Read what changed below ``root``, write one table per family below ``out``.

    ``root`` is a folder, whose state is kept from run to run, or a list of
    files, which has none: such a run replaces all rows in ``out`` and is refused
    where a folder's state is kept. Only the families of an instrument whose
    sources changed are touched; a rewritten family keeps nothing of before.
    ``previous`` stands for the state kept in ``out``; ``serial`` limits the run
    to one instrument. A BIN file needs a ``decoder``, whose ``fingerprint``
    names its version; without one BIN files are listed as skipped and LOG
    files of the same name are read instead. ``strict`` ends the run at the
    first malformed line, episode or block, which otherwise go to the quarantine.
    ``force`` reads and writes everything anew, also files whose size and
    modification time are as before.
    Returns the difference with its action per file; ``dry_run`` writes nothing.

    Readers see the rows of before until the run is published, all at once. A run
    that ends in any way before that leaves them as they are, and the next one
    starts from them.
    """
    stateful = isinstance(root, str)
    if not stateful and journal.is_stateful(spark, out):
        raise ValueError(f"{out} holds the state of runs over a folder; files alone need another output")
    found = listing(spark, root)
    options = {"previous": previous, "force": force, "serial": serial, "decoder": decoder, "fingerprint": fingerprint}
    if dry_run:
        return _plan(spark, root, out, found, lambda df, _: df, **options).told
    recover(spark, out)
    run_id = journal.new_run_id()
    facts = {"started_at": journal.now(), "input_root": root if stateful else None, "output_root": out, "normalization_version": __version__}
    if stateful:
        journal.begin(spark, out, run_id, facts)

    def keep(table: DataFrame, name: str) -> DataFrame:
        path = f"{out}/_staging/{run_id}/{name}"
        table.write.parquet(path)
        return spark.read.schema(table.schema).parquet(path)

    try:
        reached("begun")
        made = _plan(spark, root, out, found, keep, **options)
        reached("read")
        if stateful:
            manifests.put(made.told, out, "diffs", run_id)
            told = manifests.table(spark, out, "diffs").where(F.col("run_id") == run_id).drop("run_id")
        else:
            told = keep(made.told, "told")
        reached("planned")
        plan = told.select("instrument_serial", "family", "action").distinct()
        todo = not plan.where("action <> 'noop'").isEmpty()
        state, metrics = made.state, []
        if todo:
            state, metrics = _write(spark, root, out, run_id, made, told, plan, keep, strict=strict, decoder=decoder)
        reached("written")
        if stateful:
            _account(spark, out, run_id, state, plan, metrics, todo=todo)
        journal.prepare(spark, out, run_id, plan)
        reached("prepared")
        journal.publish(spark, out, run_id, stateful=stateful)
        reached("published")
    except BaseException as broke:
        _failed(spark, out, run_id, facts if stateful else None, broke)
        raise
    if stateful:
        _succeeded(spark, out, run_id, facts)
        reached("recorded")
    if manifest:
        manifests.write_root_manifest(spark, out, facts["input_root"])
    reached("listed")
    told = spark.createDataFrame(told.collect(), told.schema) if not stateful else told
    if stateful:
        journal.close(spark, out, run_id)
    journal.remove(spark, f"{out}/_staging/{run_id}")
    return told


def _write(
    spark: SparkSession, root: str | list[str], out: str, run_id: str, made: _Plan, told: DataFrame, plan: DataFrame, keep: Callable[[DataFrame, str], DataFrame], *, strict: bool, decoder: Decoder | None
) -> tuple[DataFrame, list[tuple]]:
    """The tables of what the plan asks for, in folders of the run; the state with the hashes of what was read, and the counters."""
    chosen = paths_for(told.drop("family", "action"), plan).select(F.col("source_file").alias("source_path"))
    own = made.files.join(chosen, "source_path", "left_semi")
    # what a rewrite needs besides the files that were read to compare them
    more = own.join(made.read.select("source_path"), "source_path", "left_anti")
    again = keep(contents(spark, root, more), "reread").join(made.read.select("source_path"), "source_path", "left_anti")
    reached("reread")
    now_read = again.select("source_path", F.col("source_sha256").alias("new_hash"))
    own = keep(own.join(now_read, "source_path", "left").withColumn("source_sha256", F.coalesce("new_hash", "source_sha256")).drop("new_hash"), "own")
    state = made.state.join(now_read.withColumnRenamed("source_path", "source_file"), "source_file", "left").withColumn("content_hash", F.coalesce("new_hash", "content_hash")).drop("new_hash")
    raw = named(made.read.select("source_path", "content").unionByName(again.select("source_path", "content")))
    logs = raw.where("source_kind = 'log'").select("source_path", "content")
    if decoder is not None:
        bins = raw.where("source_kind = 'bin'").join(own.select("source_path", "instrument_serial", "size_bytes", "source_sha256"), "source_path")
        logs = logs.unionByName(decoded_owner(decoder(bins), bins).select(F.col("bin_path").alias("source_path"), "content"))
    # parsed once, read by every family
    held, families = Observation(), (*SINGLE, *GROUPED, "malformed")
    parsed = grouped_lines(logs)
    lines = keep(parsed.observe(held, *(F.count_if((F.col("family").eqNullSafe(f)) | F.col("episode").eqNullSafe(f)).alias(f) for f in families)), "lines")
    counts = held.get
    # what no line belongs to is not planned
    idle = {f"log_{f}" for f in (*SINGLE, *GROUPED) if not counts[f]} | ({"quarantine/malformed_log_lines"} if not counts["malformed"] else set())
    idle |= {"quarantine/untimed_log_episodes"} if not any(counts[f] for f in GROUPED) else set()
    reached("parsed")
    log, mers = tables_of(lines), mer_tables(raw.where("source_kind = 'mer'"), strict=strict)
    _fail_on(misassigned(lines), "lines in no family, in several or read twice", F.concat_ws(":", "source_path", "line_number"))
    skipped = mers.skipped.withColumn("family", F.lit("mer"))
    everything = own
    if decoder is None:
        lacking = _new_bins(spark, out, made.bins, plan)
        skipped = skipped.unionByName(lacking.select("source_path", F.lit("no decoder for BIN files").alias("error"), F.lit("log").alias("family")))
        everything = own.unionByName(lacking.select(own.columns))
    aside = {"malformed_log_lines": log.malformed, "untimed_log_episodes": log.untimed, "malformed_mer_blocks": mers.quarantine, "skipped_files": skipped.withColumn("skipped_at", F.lit(journal.now()))}
    if strict:
        for name in QUARANTINE[:2]:
            _fail_on(aside[name], f"{name.replace('_', ' ')} in a strict run", F.concat_ws(" ", "source_path", "error", F.col("raw_line") if "raw_line" in aside[name].columns else F.lit("")))
    tables = {name: _owned(table, own) for name, table in (log.families | mers.families).items()}
    tables |= {f"quarantine/{name}": _owned(table, everything).withColumn("run_id", F.lit(run_id)) for name, table in aside.items()}

    active = {r.family for r in plan.where("action <> 'noop'").select("family").distinct().collect()}  # log, mer or both

    def put(name: str, table: DataFrame) -> list[tuple]:
        layout = f"{out}/{name}/run=none/instrument_serial=none"
        if not journal.exists(spark, layout):  # a table without any row keeps its schema as a file of no rows
            spark.createDataFrame([], table.drop("instrument_serial").schema).coalesce(1).write.mode("overwrite").parquet(layout)
        if not active & set(manifests.kinds_of(name)):
            return []
        if name in idle:
            return counted_rows(name, {"n": 0, "lines": 0})
        seen = Observation()
        counted = table.observe(seen, *counters(name, table.columns))
        counted.write.mode("overwrite").partitionBy("instrument_serial").option("maxRecordsPerFile", RECORDS_A_FILE).parquet(f"{out}/{name}/run={run_id}")
        return counted_rows(name, seen.get)

    # the tables are independent, and most are small beside what it takes to plan them
    with ThreadPoolExecutor(6) as pool:
        return state, [row for done in [pool.submit(put, *x) for x in tables.items()] for row in done.result()]


def _new_bins(spark: SparkSession, out: str, bins: DataFrame, plan: DataFrame) -> DataFrame:
    """BIN files of the instruments whose LOG family is written, without those that stay listed as skipped."""
    logs = plan.where("family = 'log' and action <> 'noop'")
    own = bins.join(logs.select("instrument_serial", "action"), "instrument_serial")
    if journal.pointer(spark, out) is None or not journal.exists(spark, f"{out}/quarantine/skipped_files"):
        return own.drop("action")
    listed = read_family(spark, out, "quarantine/skipped_files").select("instrument_serial", "source_file", F.lit("append").alias("action")).distinct()
    return own.join(listed, ["instrument_serial", "source_file", "action"], "left_anti").drop("action")


def _account(spark: SparkSession, out: str, run_id: str, state: DataFrame, plan: DataFrame, metrics: list[tuple], *, todo: bool) -> None:
    """State, data files, rows a family and counters of a run; none of it counts before the run is published."""
    manifests.put(state, out, "source_state", run_id)
    names = [*LOG_FAMILIES, *MER_FAMILIES, *(f"quarantine/{q}" for q in QUARANTINE)] if todo else []
    manifests.put(manifests.written_files(spark, out, names, run_id), out, "files", run_id)
    new = manifests.table(spark, out, "files").where((F.col("run_id") == run_id) & ~F.col("name").startswith("quarantine/"))
    rewritten = plan.where("action = 'rewrite'").select("instrument_serial", F.col("family").alias("of"))
    before = manifests.latest_outputs(spark, out).withColumn("of", F.split_part("family", F.lit("_"), F.lit(1)))
    stay = before.join(rewritten, ["instrument_serial", "of"], "left_anti").join(plan.select("instrument_serial").distinct(), "instrument_serial", "left_semi")
    every = stay.select("instrument_serial", "family", "n_rows").unionByName(new.select("instrument_serial", F.col("name").alias("family"), "n_rows"))
    manifests.put(every.groupBy("instrument_serial", "family").agg(F.sum("n_rows").alias("n_rows")), out, "outputs", run_id)
    manifests.put(spark.createDataFrame(metrics, manifests.TABLES["metrics"]), out, "metrics", run_id)


def _succeeded(spark: SparkSession, out: str, run_id: str, facts: dict) -> None:
    """The outcome of a published run, and the sources that it found removed."""
    told = manifests.table(spark, out, "diffs").where(F.col("run_id") == run_id)
    manifests.put(told.where("change_kind = 'removed'").withColumn("removed_at", F.lit(journal.now())), out, "pruned", run_id)
    _outcome(spark, out, run_id, facts, "success", None)


def _failed(spark: SparkSession, out: str, run_id: str, facts: dict | None, broke: BaseException) -> None:
    """The outcome of a run that broke off; nothing of it is live."""
    if facts is not None:
        at = journal.pointer(spark, out)
        if at and at["run_id"] == run_id:  # broke off after it was published
            return
        _outcome(spark, out, run_id, facts, "partial" if at else "failed", f"{type(broke).__name__}: {broke}"[:2000])
        journal.close(spark, out, run_id)
    journal.remove(spark, f"{out}/_staging/{run_id}")


def _outcome(spark: SparkSession, out: str, run_id: str, facts: dict, status: str, error: str | None) -> None:
    touched = manifests.table(spark, out, "diffs").where(F.col("run_id") == run_id).select("instrument_serial").distinct()
    given = {c: facts.get(c) for c in ("started_at", "input_root", "output_root", "normalization_version")} | {"completed_at": journal.now(), "status": status, "error": error}
    manifests.put(touched.withColumns({k: F.lit(v) for k, v in given.items()}), out, "runs", run_id)


def recover(spark: SparkSession, out: str) -> None:
    """Ends what a killed run left open, then deletes what no snapshot reads.

    A run that was killed after it was published is recorded as a success, any
    other as broken off; its folders are not live, so nothing of it is lost or
    doubled.
    """
    at = journal.pointer(spark, out)
    for intent in journal.open_intents(spark, out):
        run_id = intent["run_id"]
        if at and at["run_id"] == run_id:
            _succeeded(spark, out, run_id, intent)
            manifests.write_root_manifest(spark, out, intent["input_root"])
        else:
            _outcome(spark, out, run_id, intent, "partial" if at else "failed", "broke off")
        journal.close(spark, out, run_id)
    if journal.exists(spark, out):
        names = (*LOG_FAMILIES, *MER_FAMILIES, *(f"quarantine/{q}" for q in QUARANTINE))
        journal.vacuum(spark, out, {n: manifests.kinds_of(n) for n in names})


def read_family(spark: SparkSession, out: str, family: str) -> DataFrame:
    """A family or quarantine table of the published snapshot, with the instrument among its first columns."""
    if journal.pointer(spark, out) is None:
        raise ValueError(f"{out} holds no finished run")
    rows = spark.read.parquet(f"{out}/{family}").where("instrument_serial <> 'none'").withColumns({c: F.col(c).cast("string") for c in ("instrument_serial", "run")})
    live = journal.live(spark, out).withColumnRenamed("run_id", "run")
    kinds = manifests.kinds_of(family)
    if len(kinds) == 1:
        rows = rows.join(live.where(F.col("kind") == kinds[0]), ["run", "instrument_serial"], "left_semi")
    else:
        rows = rows.join(live.withColumnRenamed("kind", "family"), ["run", "instrument_serial", "family"], "left_semi")
    rows = rows.drop("run")
    return rows.select(*(c for c in PREFIX if c in rows.columns), *(c for c in rows.columns if c not in PREFIX))


def _pair(name: str, value: Column, kind: str) -> Column:
    """``"name":value`` as JSON, with null as null; a number that JSON lacks fails the job."""
    if kind == "double":
        value = F.when(value.isNull() | ~(F.isnan(value) | (F.abs(value) == float("inf"))), value).otherwise(F.raise_error(F.lit(f"{name} is no JSON number")).cast("double"))
    text = F.to_json(F.struct(value.alias(name)), {"ignoreNullFields": "false"})
    return F.substring(text, F.lit(2), F.length(text) - 2)


def json_lines(table: DataFrame, absent: tuple[str, ...] = (), keep: tuple[str, ...] = ()) -> DataFrame:
    """One JSON object a row in column ``value``, in column order; columns ``keep`` are in none of them and come before it.

    Keys of null columns in ``absent`` are left out, all other nulls written.
    Events of ``iridium_events`` have the keys of their kind only.
    """
    parts = []
    for field in table.schema:
        if field.name in keep:
            continue
        value = F.col(f"`{field.name}`")
        if field.name == "iridium_events":
            text = F.concat(F.lit('"iridium_events":['), F.array_join(F.transform(value, partial(_event_json, field.dataType.elementType.names)), ","), F.lit("]"))
        else:
            text = _pair(field.name, value, field.dataType.simpleString())
        parts.append(F.when(value.isNotNull(), text) if field.name in absent else text)
    return table.select(*keep, F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}")).alias("value"))


def _event_json(names: list[str], event: Column) -> Column:
    kind = event["iridium_event_kind"]
    parts = [F.when(kind.isin(*KINDS_OF[n]), _pair(n, event[n], "")) if n in KINDS_OF else _pair(n, event[n], "") for n in names]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


#: Columns whose keys a family's JSON rows lack where they are null.
ABSENT = {"log_pressure_temperature": PRESSURE_FIELDS, "log_unclassified": ("switched_to_log_file",), "mer_event": ("stanford_psd_processing",)}


def export_jsonl(table: DataFrame, path: str, absent: tuple[str, ...] = ()) -> None:
    """Writes ``json_lines``; rows of one source stay in the order of its lines."""
    json_lines(table, absent).write.mode("overwrite").text(path)


def export_all(spark: SparkSession, out: str, target: str) -> None:
    """All thirteen families as JSON lines below ``target``, a folder each, also those without rows."""
    for family in (*LOG_FAMILIES, *MER_FAMILIES):
        export_jsonl(read_family(spark, out, family).drop("source_path"), f"{target}/{family}", ABSENT.get(family, ()))


def export_canonical(spark: SparkSession, out: str, target: str) -> None:
    """One JSON-lines file a family and instrument, ``target/<serial>/<family>_records.<serial>.jsonl``, all thirteen for each.

    Rows follow their sources by path and these by line, so a file is the same
    for the same records. Instruments are dealt over the tasks; as one file is
    wanted, an instrument's family is sorted and written by one task, which
    spills. Each file appears whole, by a rename.
    """
    serials = sorted(r[0] for r in manifests.latest_outputs(spark, out).select("instrument_serial").distinct().collect())
    spare = f"{target}/_parts-{journal.new_run_id()}"
    fs, _ = journal.file_system(spark, target)
    for family in (*LOG_FAMILIES, *MER_FAMILIES):
        rows = read_family(spark, out, family)
        place = [c for c in ("body_pos", "line_pos", "event_pos", "source_line_number", "line_start_index") if c in rows.columns]
        lines = json_lines(rows.withColumn("_serial", F.col("instrument_serial")).withColumns({f"_{c}": F.col(c) for c in place}), ABSENT.get(family, ()), ("source_path", "_serial", *(f"_{c}" for c in place)))
        order = ["_serial", "source_path", *(f"_{c}" for c in place)]
        lines.repartition("_serial").sortWithinPartitions(*order).select("_serial", "value").write.mode("overwrite").partitionBy("_serial").text(f"{spare}/{family}")
        part = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
        for serial in serials:
            folder = f"{spare}/{family}/{part('_serial', serial)}"
            made = [n for n in journal.children(spark, folder) if n.startswith("part-")]
            path = f"{target}/{validated_serial(serial)}/{record_filename(family, serial)}"
            fs.mkdirs(journal.file_system(spark, path)[1].getParent())
            if made:
                journal.replace(spark, f"{folder}/{made[0]}", path)
            else:
                journal.write_text(spark, path, "")
    journal.remove(spark, spare)


__all__ = ["event_kind", "export_all", "export_canonical", "export_jsonl", "grouped_lines", "json_lines", "log_tables", "mer_tables", "mer_tables_of", "normalize", "read_family", "read_mer", "recover", "snapshot_id", "tables_of", "unassigned"]
