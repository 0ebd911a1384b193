"""LOG lines: explode, parse, families, episodes, exactly-once."""

import random

import pytest
from pyspark.sql import functions as F

from pelagia.functions.families import classify, event_kind, event_payload
from pelagia.functions.lines import explode_lines, parse_lines
from pelagia.operators.episodes import FLAGS, STATES, advance, group_episodes, predicates, transition, walk
from pelagia.plans.normalize import accounted, grouped_lines, log_tables, misassigned, unassigned


def _files(spark, **texts):
    rows = [(name, text if isinstance(text, bytes) else text.encode()) for name, text in texts.items()]
    return spark.createDataFrame(rows, "source_path string, content binary")


def test_line_ends_and_bad_bytes(spark):
    rows = explode_lines(_files(spark, a="x\ry\r\nz\n\nq", b=b"\xff\n", c="")).orderBy("source_path", "line_number").collect()
    assert [(r.source_path, r.line_number, r.raw_line) for r in rows] == [("a", 1, "x"), ("a", 2, "y"), ("a", 3, "z"), ("a", 4, ""), ("a", 5, "q"), ("b", 1, "�")]


@pytest.mark.parametrize(("message", "family"), [
    ("acq  Started", "acquisition"), ("acq started now", "unclassified"), ("Ascent request rejected", "ascent_request"), ("GPS fix...", "gps"),
    ("N35deg19.262mn, E139deg39.043mn", "gps"), ("$GPSACK:+48,+10;", "gps"), ("P+24mbar,T-25120mdegC", "pressure_temperature"), ("Pint 83000Pa", "pressure_temperature"),
    ("battery 14500mV,   19840uA", "battery"), ("pump during 30000ms", "unclassified"),
])
def test_classifier(spark, message, family):
    assert spark.createDataFrame([(message,)], "m string").select(classify(F.col("m"))).first()[0] == family


def test_two_families_fail(spark):
    with pytest.raises(Exception, match="several families"):
        spark.createDataFrame([("battery 1mV, 2uA Pint 3Pa",)], "m string").select(classify(F.col("m"))).collect()


def test_iridium_payloads(spark):
    cases = {
        'connected in 37s, signal quality 5': ("connection", {"connection_duration_s": 37, "signal_quality": 5}),
        '"07/5F5F98DC.MER" uploaded at 98bytes/s': ("upload_artifact", {"referenced_artifact": "07_5F5F98DC.MER", "rate_bytes_per_s": 98}),
        "peer ask to resume 07/5F.LOG (12bytes) from byte 4294967294": ("upload_resume", {"byte_offset": 4294967294, "artifact_size_bytes": 12}),
        "$TIME:12;": ("command", {"command_name": "TIME", "command_payload": "12"}), "$GPSACK:1;": ("session_line", {}), "nothing": ("session_line", {}),
    }
    kind = event_kind(F.col("m"))
    for r in spark.createDataFrame([(m,) for m in cases], "m string").select("m", kind.alias("k"), event_payload(F.col("m"), kind).alias("p")).collect():
        assert r.k == cases[r.m][0]
        assert {k: r.p[k] for k in cases[r.m][1]} == cases[r.m][1]


MIX = [
    "[TESTMD]in", '[TESTMD]"quit"', "[SURF]Iridium...", "[SURF]connected in 3s, signal quality 4", "[ZTX]$GPSACK:1;", "[SURF]disconnected after 9s", "[SBE61]P 1, T 2, S 3",
    "[STAGE]surfacing", "[STAGE]SBE41 on", "    bypass 1 2", "[PUMP]during 3ms", "*** switching to a/b ***", "junk", "[TESTMD]$TIME:1;", "[STAGE]2 file(s) uploaded", "[MAIN]end of test mode",
]


def test_windows_agree_with_the_walk(spark):
    rng = random.Random(5)
    texts = {f"f{n}": "\n".join("" if rng.random() < 0.1 else f"{1500000000 + i}:{rng.choice(MIX[:13] if n % 2 else MIX)}" for i in range(25)) for n in range(120)}
    lines = parse_lines(explode_lines(_files(spark, **texts)))
    got, blocks = ({(r.source_path, r.line_number): (r.episode, r.episode_index) for r in group_episodes(lines, block=n).collect()} for n in (10_000, 4))
    assert blocks == got  # all files in blocks of four lines
    flagged = {}
    for r in predicates(lines).select("source_path", "line_number", "tagged", "is_parameter", *FLAGS).collect():
        flagged.setdefault(r.source_path, {})[r.line_number] = r.asDict()
    for path, rows in flagged.items():
        count = {}
        for at, (episode, starts) in zip(sorted(rows), walk(rows[i] for i in sorted(rows)), strict=True):
            count[episode] = count.get(episode, -1) + starts
            assert got[path, at] == (episode, count[episode] if episode else None), (path, at)


def test_lines_are_read_once_and_walked_in_small_batches(spark):
    rng = random.Random(7)
    texts = {f"f{n}": "\n".join(f"{1500000000 + i}:{rng.choice(MIX)}" for i in range(n)) for n in range(30)}
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    rows = explode_lines(_files(spark, **texts)).localCheckpoint()
    lines = parse_lines(rows.mapInPandas(count, rows.schema))
    whole = {tuple(r) for r in group_episodes(lines).select("source_path", "line_number", "episode", "episode_index").collect()}
    # once to find very long files, once to walk
    assert len(whole) == rows.count() and seen.value <= 2 * rows.count()
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        for block in (50_000, 4):
            assert {tuple(r) for r in group_episodes(lines, block=block, keep=()).collect()} == whole
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_transitions_compose():
    rng = random.Random(9)
    for _ in range(200):
        rows = [{n: rng.random() < 0.3 for n in ("tagged", "is_parameter", *FLAGS)} for _ in range(12)]
        for k, state in enumerate(STATES):
            at, count = k, [0] * len(STATES)
            for block in (rows[:5], rows[5:6], rows[6:6], rows[6:]):
                at, more = transition(block)[at]
                count = [x + y for x, y in zip(count, more, strict=True)]
            found = walk(rows, state)
            assert count == [sum(starts for episode, starts in found if episode == s) for s in STATES]
            after = state
            for r in rows:
                after = advance(after, r)[2]
            assert STATES[at] == after


def test_every_line_once(spark):
    files = _files(spark, a="\n".join(f"{1500000000 + i}:{m}" for i, m in enumerate(MIX[4:] + MIX[2:6])) + "\n<ERR> no tag\n\nxx:[A]bad time", b="")
    tables = log_tables(files)
    assert unassigned(tables, parse_lines(explode_lines(files))).count() == 0
    assert sorted(r.raw_line for r in tables.malformed.collect()) == ["1500000008:junk", "<ERR> no tag", "xx:[A]bad time"]


def test_no_files(spark):
    tables = log_tables(_files(spark, a="").limit(0))
    assert all(t.count() == 0 for t in tables.families.values())


def _iso_forms(rng):
    date = rng.choice([f"{rng.choice((1, 1999, 2020, 2024, 9999)):04}-{rng.randrange(0, 14):02}-{rng.randrange(0, 33):02}", f"{rng.choice((1999, 2024)):04}{rng.randrange(1, 13):02}{rng.randrange(1, 32):02}", f"{rng.choice((1998, 2015, 2020, 2021, 2024)):04}-W{rng.choice((0, 1, 9, 52, 53, 54)):02}", f"{rng.choice((2015, 2020, 2024)):04}-W{rng.choice((1, 52, 53)):02}-{rng.randrange(0, 9)}", f"2020W{rng.choice((1, 52, 53)):02}{rng.randrange(1, 8)}", "2024W07"])
    h, m, s = rng.randrange(0, 25), rng.choice((0, 5, 59, 60)), rng.choice((0, 7, 59, 60))
    fraction = rng.choice(("", ".5", ",5", ".123456", ".1234567", ",000001"))
    clock = rng.choice(("", f"{h:02}", f"{h:02}:{m:02}", f"{h:02}{m:02}", f"{h:02}:{m:02}:{s:02}{fraction}", f"{h:02}{m:02}{s:02}{fraction}", f"{h:02}:{m:02}{s:02}"))
    offset = rng.choice(("", "", "Z", "+00:00", "-0130", "+05", "+23:59", "-00:00:30", "+01:02:03.5", "+24:00"))
    return date + (rng.choice("T  x_") + clock + offset if clock else "")


def test_times_are_read_as_iso_8601(spark):
    import random
    from datetime import UTC, datetime

    from pelagia.functions.lines import format_time, iso_time

    rng = random.Random(11)
    texts = sorted({_iso_forms(rng) for _ in range(6000)} | {"20240207T224722", "2024-02-07T22:47:22+0000", "2024-W06-3", "2024-02-07T22:47:22,5", "", "x", "2024-02-07T", "2024-02-07T22:47:22z", "0000-01-01", "9999-12-31T23:59:59-01:00", "0001-01-01T00:00:00+01:00"})

    def expected(text):
        try:
            made = datetime.fromisoformat(text[:-1] + "+00:00" if text.endswith("Z") else text)
            made = made.replace(tzinfo=UTC) if made.tzinfo is None else made.astimezone(UTC)
            return made.isoformat(timespec="microseconds").replace("+00:00", "Z")
        except (ValueError, OverflowError):
            return None

    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", format_time(iso_time(F.col("t"))).alias("got")).collect()
    wrong = [(r.t, r.got, expected(r.t)) for r in rows if r.got != expected(r.t)]
    assert not wrong, wrong[:10]
    assert sum(r.got is not None for r in rows) > 500


def test_accounting_walks_its_lines_once(spark, tmp_path):
    path = str(tmp_path / "files")
    _files(spark, a="1:[SBE61]P 1, T 2, S 3\n2:[X]odd\n\nnothing\n", b="1:[MRMAID]acq started\n").write.parquet(path)
    lines = grouped_lines(spark.read.parquet(path), keep=())
    plan = accounted(lines)._jdf.queryExecution().sparkPlan().toString()
    # the walk itself and, behind a grouping, that of files longer than a block
    assert plan.count("MapInArrow") == 1
    assert {r.held_by: r.n_lines for r in accounted(lines).collect()} == {"ctd": 1, "unclassified": 1, "blank": 1, "malformed": 1, "acquisition": 1, "misassigned": 0}
    # read twice, held twice, held by none
    held = spark.createDataFrame(
        [("a", 1, "gps", None, False)] * 3 + [("a", 2, "gps", "ctd", False), ("a", 3, None, None, False), ("a", 4, None, None, True), ("a", 5, "gps", None, False), ("b", 1, None, "ctd", False)],
        "source_path string, line_number long, family string, episode string, is_blank boolean",
    )
    assert {r.held_by: r.n_lines for r in accounted(held).collect()} == {"gps": 5, "ctd": 1, "blank": 1, None: 1, "misassigned": 3} and misassigned(held).count() == 3
    assert [tuple(r) for r in accounted(held.limit(0)).collect()] == [("misassigned", 0)]


def test_only_large_files_are_looked_through_for_long_ones(spark):
    texts = {"a": "".join(f"{n}:[STAGE]x\n" for n in range(40)), "b": "1:[SBE61]x\n" + "\n" * 30, "c": "1:[SBE61]x\n2:[STAGE]y"}
    lines = parse_lines(explode_lines(_files(spark, **texts)))
    large = lines.where("source_path <> 'c'")
    got = [group_episodes(lines, block=b, large=some).select("source_path", "line_number", "episode", "episode_index") for b, some in ((8, large), (8, None), (1000, None))]
    rows = [sorted(map(tuple, df.collect())) for df in got]
    assert rows[0] == rows[1] == rows[2] and len(rows[0]) == 73
