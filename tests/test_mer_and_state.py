"""MER framing and records, sources, incremental planning, sinks."""

import json

import pytest
from pyspark.sql import functions as F

from pelagia.operators.mer import frame_events
from pelagia.operators.state import actions, diff_sources, paths_for, snapshot_id
from pelagia import cli
from pelagia.plans import journal, manifests
from pelagia.plans.audit import audit_family, sample_rows
from pelagia.plans.normalize import PREFIX, export_all, json_lines, log_tables, mer_tables, normalize, read_family, sources
from pelagia.sources.files import authoritative, count_kinds, decoded_owner, instrument, parse_inputs, with_provenance
from pelagia.streaming.append import append_logs

EVENT = b"<EVENT>\n\r\t<INFO DATE=2024-01-02T03:04:05 ROUNDS=3 />\n\r\t<FORMAT ENDIANNESS=LITTLE BYTES_PER_SAMPLE=4 LENGTH=3 />\n\r\t<DATA>\n\r%s\n\r\t</DATA>\n\r</EVENT>\n\r"
HEAD = b"<ENVIRONMENT>\n\r\t<BOARD 452116600-0B />\n\r\t<SOFTWARE 2.1344 STANFORD />\n\r\t<DIVE ID=3 EVENTS=2 />\n\r\t<NEWTAG A=1 />\n\r</ENVIRONMENT>\r\n<PARAMETERS>\n\r\t<ADC GAIN=1 BUFFER=ON />\n\r\t<STANFORD_PROCESS DURATION_h=6 WINDOW_LEN=1024 dB_OFFSET=1.5 />\n\r</PARAMETERS>\r\n"


@pytest.mark.parametrize("payload", [b"0123456789ab", b"</DATA><EVEN", b"<EVENT>abcde"])
def test_length_frames_payload(payload):
    assert [e[3] for e in frame_events(EVENT % payload + EVENT % b"0123456789ab")] == [payload, b"0123456789ab"]


def test_other_framing():
    assert [e[3] for e in frame_events(EVENT % b"short")] == [b"short"]
    plain = b"<EVENT><INFO DATE=1 /><DATA>\n\rab</DATA>c</DATA></EVENT>"
    assert [e[4] for e in frame_events(plain)] == ["ambiguous data without a declared length"]
    assert [e[4] for e in frame_events(b"<EVENT><INFO DATE=1 /><DATA>abc" + EVENT % b"0123456789ab")][-1] is None
    assert list(frame_events(b"no tags")) == []


def test_records(spark):
    files = spark.createDataFrame([("m", HEAD + EVENT % b"0123456789ab")], "source_path string, content binary")
    made = mer_tables(files)
    tables, bad = made.families, made.quarantine
    env = {r.environment_kind: r for r in tables["mer_environment"].collect()}
    assert (env["board"].board, env["dive"].dive_id, env["unknown"].raw_values) == ("452116600-0B", 3, {"a": "1"})
    event = tables["mer_event"].first()
    assert (event.payload_length_matches_expected, event.encoded_payload, event.date) == (True, "MDEyMzQ1Njc4OWFi", "2024-01-02T03:04:05.000000Z")
    assert event.stanford_psd_processing.duration_h == 6 and bad.count() == 0


def test_unknown_key_fails(spark):
    bad = spark.createDataFrame([("m", (EVENT % b"0123456789ab").replace(b"ROUNDS", b"BADKEY"))], "source_path string, content binary")
    with pytest.raises(Exception, match="BADKEY"):
        mer_tables(bad).families["mer_event"].collect()


def test_sources(spark):
    files = with_provenance(spark.createDataFrame([("/x/06_A.BIN", b"1"), ("/x/06_a.LOG", b"2"), ("/x/07_a.LOG", b"3")], "source_path string, content binary"))
    assert sorted(r.source_file for r in authoritative(files).collect()) == ["06_A.BIN", "07_a.LOG"]
    names = spark.createDataFrame([("452.020-P-06",), ("467.174-T-0100",), ("x",)], "n string").select(instrument(F.col("n")).alias("i")).collect()
    assert [r.i and r.i.instrument_id for r in names] == ["P0006", "T0100", None]


def test_planning(spark):
    schema = "instrument_serial string, source_file string, source_kind string, content_hash string"
    old = spark.createDataFrame([("a", "1", "log", "x"), ("a", "2", "mer", "x"), ("b", "1", "log", "x"), ("c", "1", "log", "x")], schema)
    new = spark.createDataFrame([("a", "1", "log", "y"), ("a", "2", "mer", "x"), ("b", "1", "log", "x"), ("b", "2", "log", "z")], schema)
    diff = diff_sources(old, new)
    plan = actions(diff)
    assert {(r.instrument_serial, r.family): r.action for r in plan.collect()} == {("a", "log"): "rewrite", ("a", "mer"): "noop", ("b", "log"): "append", ("c", "log"): "rewrite"}
    assert sorted((r.instrument_serial, r.source_file) for r in paths_for(diff, plan).collect()) == [("a", "1"), ("b", "2")]
    assert {r.action for r in actions(diff, force=True).collect()} == {"rewrite"}


def test_snapshot_ignores_order(spark):
    rows = [("b", 2, "y"), ("a", 1, "x")]
    one, two = (snapshot_id(spark.createDataFrame(r, "path string, byte_size long, sha256 string")).first() for r in (rows, rows[::-1]))
    assert one == two and one.file_count == 2


def _put(folder, **texts):
    folder.mkdir(parents=True, exist_ok=True)
    for name, text in texts.items():
        (folder / name.replace("__", ".")).write_bytes(text if isinstance(text, bytes) else text.encode())


def _rows(spark, out, family, *columns):
    return sorted(tuple(r) for r in read_family(spark, out, family).select(*columns).collect())


def test_run_and_export(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    _put(tmp_path / "raw" / "452.020-P-06", **{"06_1__LOG": "1500000000:[MAIN]acq started\n1500000001:[SURF]GPS fix...\nodd line\n", "06_2__MER": HEAD})
    dry = normalize(spark, raw, out, dry_run=True)
    assert {r.action for r in dry.collect()} == {"append"} and not (tmp_path / "out").exists()
    normalize(spark, raw, out)
    assert _rows(spark, out, "log_acquisition", "acquisition_state", "instrument_serial", "instrument_id") == [("started", "452.020-P-06", "P0006")]
    assert _rows(spark, out, "quarantine/malformed_log_lines", "line_number", "raw_line") == [(3, "odd line")]
    assert read_family(spark, out, "log_battery").count() == 0  # all thirteen are there
    assert read_family(spark, out, "log_acquisition").columns[:6] == list(PREFIX)
    again = normalize(spark, raw, out)  # the state is read from the same folder it is written to
    assert {r.action for r in again.collect()} == {"noop"} and read_family(spark, out, "log_acquisition").count() == 1
    made = json.loads((tmp_path / "out" / "normalization_manifest.json").read_text())
    assert made["file_count"] == len(made["files"]) > 13 and not any(f["path"].startswith("manifests") for f in made["files"])
    assert {r.status for r in manifests.table(spark, out, "runs").collect()} == {"success"}
    counts = {(r.family): r.n_rows for r in manifests.latest_outputs(spark, out).collect()}
    assert counts["log_acquisition"] == 1 and counts["mer_environment"] == 4
    export_all(spark, out, str(tmp_path / "json"))
    line = json.loads(spark.read.text(str(tmp_path / "json" / "log_acquisition")).first().value)
    assert line["acquisition_state"] == "started" and line["code"] is None and len(list((tmp_path / "json").iterdir())) == 13


def test_rewrite_leaves_no_stale_rows(spark, tmp_path):
    raw, out, folder = str(tmp_path / "raw"), str(tmp_path / "out"), tmp_path / "raw" / "452.020-P-06"
    _put(folder, **{"06_1__LOG": "1500000000:[MAIN]acq started\n", "06_2__LOG": "1500000002:[MAIN]ascent request accepted\n"})
    _put(tmp_path / "raw" / "467.174-T-0100", **{"0100_1__LOG": "1500000000:[MAIN]acq stopped\n"})
    normalize(spark, raw, out)
    _put(folder, **{"06_1__LOG": "1500000000:[SURF]GPS fix...\n"})
    diff = normalize(spark, raw, out)
    assert sorted((r.change_kind, r.family, r.action) for r in diff.collect()) == [("changed", "log", "rewrite"), ("unchanged", "log", "noop"), ("unchanged", "log", "rewrite")]
    assert _rows(spark, out, "log_acquisition", "acquisition_state") == [("stopped",)]
    assert _rows(spark, out, "log_gps", "instrument_serial") == [("452.020-P-06",)] and len(_rows(spark, out, "log_ascent_request", "message")) == 1
    _put(folder, **{"06_3__LOG": "1500000009:[MAIN]acq started\n"})
    assert ("new", "append") in {(r.change_kind, r.action) for r in normalize(spark, raw, out).collect()}
    assert _rows(spark, out, "log_acquisition", "acquisition_state") == [("started",), ("stopped",)]
    for f in folder.iterdir():
        f.unlink()
    normalize(spark, raw, out)
    assert _rows(spark, out, "log_gps", "message") == [] and _rows(spark, out, "log_acquisition", "acquisition_state") == [("stopped",)]
    assert manifests.table(spark, out, "pruned").count() == 3


def test_broken_run_is_written_anew(spark, tmp_path):
    raw, out, folder = str(tmp_path / "raw"), str(tmp_path / "out"), tmp_path / "raw" / "452.020-P-06"
    _put(folder, **{"06_1__LOG": "1500000000:[MAIN]acq started\n"})
    normalize(spark, raw, out)
    _put(folder, **{"06_2__MER": (EVENT % b"0123456789ab").replace(b"ROUNDS", b"BADKEY")})
    with pytest.raises(Exception, match="BADKEY"):
        normalize(spark, raw, out)
    assert {r.status for r in manifests.latest_runs(spark, out).collect()} == {"partial"}
    _put(folder, **{"06_2__MER": EVENT % b"0123456789ab"})
    assert {r.action for r in normalize(spark, raw, out).collect()} == {"rewrite"}
    assert len(_rows(spark, out, "log_acquisition", "message")) == len(_rows(spark, out, "mer_event", "block_index")) == 1
    assert {r.action for r in normalize(spark, raw, out, force=True, dry_run=True).collect()} == {"rewrite"}


def test_bin_files_and_decoder(spark, tmp_path):
    raw, out, folder = str(tmp_path / "raw"), str(tmp_path / "out"), tmp_path / "raw" / "452.020-P-06"
    _put(folder, **{"06_1__BIN": "1500000000:[MAIN]acq stopped\n", "06_1__log": "1500000000:[MAIN]acq started\n"})
    normalize(spark, raw, out)
    assert _rows(spark, out, "log_acquisition", "acquisition_state") == [("started",)]  # no decoder: the LOG is read
    assert _rows(spark, out, "quarantine/skipped_files", "source_file", "error") == [("06_1.BIN", "no decoder for BIN files")]
    decoder = lambda bins: bins.select("prefix", "stem", "content")
    normalize(spark, raw, out, decoder=decoder, fingerprint="1")
    assert _rows(spark, out, "log_acquisition", "acquisition_state", "source_file") == [("stopped", "06_1.BIN")]
    plan = lambda f: {r.action for r in normalize(spark, raw, out, decoder=decoder, fingerprint=f, dry_run=True).collect()}
    assert (plan("1"), plan("2"), plan(None)) == ({"noop"}, {"rewrite"}, {"rewrite"})
    two = with_provenance(spark.createDataFrame([("/x/06_a.BIN", b"1"), ("/x/06_b.BIN", b"2")], "source_path string, content binary"))
    logs = spark.createDataFrame([("06", "06_c", b"")], "prefix string, stem string, content binary")
    with pytest.raises(Exception, match="no single BIN"):
        decoded_owner(logs, two).collect()
    assert decoded_owner(logs, two.where("stem = '06_a'")).first().bin_path == "/x/06_a.BIN"


def test_strict_run_of_listed_files(spark, tmp_path):
    _put(tmp_path / "raw", **{"06_1__LOG": "1500000000:[MAIN]acq started\nodd line\n", "06_2__MER": b"<EVENT><DATA>\n\rab\n\r\t</DATA></EVENT>", "06_3__MER": b"junk"})
    out = str(tmp_path / "out")
    with pytest.raises(ValueError, match="odd line"):
        normalize(spark, [str(tmp_path / "raw" / "06_1.LOG")], out, strict=True)
    assert not journal.is_stateful(spark, out)
    with pytest.raises(ValueError, match="not a BIN, LOG, MER file"):
        normalize(spark, [str(tmp_path / "raw" / "x.txt")], str(tmp_path / "o"))
    with pytest.raises(ValueError, match="not a folder"):
        normalize(spark, str(tmp_path / "none"), str(tmp_path / "o"))
    files = spark.read.format("binaryFile").load(str(tmp_path / "raw" / "*.MER")).select(F.col("path").alias("source_path"), "content")
    loose, tight = mer_tables(files), mer_tables(files, strict=True)
    assert [(r.block_kind, r.error) for r in loose.quarantine.collect()] == [("event_info", "missing INFO tag")] and loose.families["mer_event"].count() == 0
    assert [r.data_payload_nbytes for r in tight.families["mer_event"].collect()] == [2]
    assert loose.skipped.count() == 1 and loose.skipped.first().source_path.endswith("06_3.MER")


def test_quarantined_blocks(spark):
    body = HEAD.replace(b"<NEWTAG A=1 />", b"no tag at all") + b"<ENVIRONMENT>\n\r\t<DIVE ID=4 />\n\r</ENVIRONMENT>" + (EVENT % b"0123456789ab").replace(b"LENGTH=3", b"LENGTH=x") + EVENT % b"0123456789ab"
    made = mer_tables(spark.createDataFrame([("m", body)], "source_path string, content binary"))
    assert sorted((r.block_kind, r.error) for r in made.quarantine.collect()) == [("environment", "malformed environment tag line"), ("event_format", "unparseable LENGTH"), ("repeated_metadata_section", "repeated complete environment section kept in the records")]
    assert [r.block_index for r in made.families["mer_event"].collect()] == [0]
    assert sorted(r.dive_id for r in made.families["mer_environment"].where("environment_kind = 'dive'").collect()) == [3, 4]


def test_identity_chain(spark, tmp_path):
    _put(tmp_path / "raw", **{"06_1__LOG": "1500000000:[MAIN]acq started\n", "07_1__LOG": "1500000000:[MAIN]buoy 467.174-T-07\n", "07_2__MER": b"x", "08_1__LOG": "x", "465.152-R-08__vit": "v", "odd__vit": "v"})
    _put(tmp_path / "raw" / "452.020-P-09", **{"09_1__LOG": "x"})
    got = {r.source_file: r.instrument_serial for r in sources(spark, str(tmp_path / "raw")).collect()}
    assert got == {"06_1.LOG": "06", "07_1.LOG": "467.174-T-07", "07_2.MER": "467.174-T-07", "08_1.LOG": "465.152-R-08", "09_1.LOG": "452.020-P-09"}
    _put(tmp_path / "452.021-P-06", **{"06_1__LOG": "x"})
    assert sources(spark, str(tmp_path / "452.021-P-06")).first().instrument_serial == "452.021-P-06"
    assert [(r.source_kind, r.n_files) for r in count_kinds(sources(spark, str(tmp_path / "raw"))).orderBy("source_kind").collect()] == [("log", 4), ("mer", 1)]
    assert parse_inputs(["a,b", "c a"]) == ["a", "b", "c"]


def test_json_lines(spark, tmp_path):
    table = spark.createDataFrame([(1, None, None, 0.5), (2, "x", "y", None)], "a int, b string, c string, d double")
    lines = [json.loads(r.value) for r in json_lines(table, absent=("c",)).collect()]
    assert sorted(lines, key=lambda x: x["a"]) == [{"a": 1, "b": None, "d": 0.5}, {"a": 2, "b": "x", "c": "y", "d": None}] and list(lines[1]) == ["a", "b", "c", "d"]
    with pytest.raises(Exception, match="no JSON number"):
        json_lines(spark.sql("SELECT double('NaN') AS d")).collect()
    text = "1500000000:[SURF]Iridium...\n1500000001:[SURF]connected in 37s, signal quality 5\n1500000002:[ZTX]$TIME;\n1500000003:[SURF]disconnected after 9s\n"
    rows = log_tables(spark.createDataFrame([("f", text.encode())], "source_path string, content binary")).families["log_iridium"]
    events = json.loads(json_lines(rows).first().value)["iridium_events"]
    assert [set(e) - {"source_line_number", "record_time", "log_epoch_time", "subsystem", "code", "message", "iridium_event_kind", "raw_line"} for e in events] == [set(), {"connection_duration_s", "signal_quality"}, {"command_name", "command_payload"}, {"disconnect_duration_s"}]
    assert events[1]["connection_duration_s"] == 37 and events[2]["command_payload"] is None


def test_audit_and_command_line(spark, tmp_path, capsys):
    raw, out, folder = str(tmp_path / "raw"), str(tmp_path / "out"), tmp_path / "raw" / "452.020-P-06"
    _put(folder, **{"06_1__LOG": "1500000000:[MAIN]Vbat 14000mV (min 13665mV)\n1500000001:[PRESS]P 10mbar,T-2mdegC\n1500000002:[SBE61]P 1, T 2, S 3\n1500000004:*** switching to 06/2 ***\n1500000005:[SURF]Iridium...\n", "06_2__MER": HEAD + EVENT % b"0123456789ab"})
    assert cli.main(["normalize", "-i", raw, "-o", out, "--dry-run", "--json"], spark) == 0
    plan = json.loads(capsys.readouterr().out)["instruments"][0]
    assert plan["counts"]["new"] == 2 and plan["families"]["log"]["action"] == "append" and len(plan["families"]["mer"]["file_diffs"]) == 1
    assert cli.main(["normalize", "-i", raw, "-o", out, "-v"], spark) == 0
    assert "452.020-P-06: append" in capsys.readouterr().out
    assert cli.main(["audit", "-o", out], spark) == 0, capsys.readouterr().out
    rows = read_family(spark, out, "log_battery")
    bad = audit_family(rows.withColumn("voltage_mv", F.lit(1)), "log_battery").collect()
    assert [(r.issue, r.place) for r in bad] == [("voltage_mv does not match raw_line", 1)]
    event = read_family(spark, out, "mer_event").withColumn("encoded_payload", F.lit("AAAA"))
    assert audit_family(event, "mer_event").count() == 1 or "payload" in audit_family(event, "mer_event").first().issue
    for wrong in (["normalize", "-o", out], ["normalize", "-i", raw, "-o", out, "--json"], ["normalize", "-i", raw, "-o", out, "--instrument-serial", "x"], ["normalize", "-i", raw, "-o", out, "--decoder", "no_such:thing"]):
        assert cli.main(wrong, spark) == 2
    assert cli.main(["export", "-o", out, "--target", str(tmp_path / "json")], spark) == 0


def test_sample_takes_distinct_instruments_first(spark):
    rows = spark.createDataFrame([("f", f"i{i}", f"i{i}_{k}", n) for i in range(3) for k in range(4) for n in range(5)], "family string, instrument_serial string, source_file string, place long")
    got = sample_rows(rows, 5, 7).collect()
    assert len(got) == 5 and len({r.source_file for r in got}) == 5 and {r.instrument_serial for r in got} == {"i0", "i1", "i2"}
    assert sorted(got) == sorted(sample_rows(rows.repartition(3), 5, 7).collect()) and {r.instrument_serial for r in sample_rows(rows, 3, 1).collect()} == {"i0", "i1", "i2"}


def test_stream_writes_each_batch_once(spark, tmp_path):
    _put(tmp_path / "raw", **{"06_1__LOG": "1500000000:[MAIN]acq started\nodd\n"})
    raw, out, check = (str(tmp_path / x) for x in ("raw", "out", "check"))
    append_logs(spark, raw, out, check).awaitTermination()
    _put(tmp_path / "raw", **{"06_2__LOG": "1500000001:[MAIN]acq stopped\n"})
    append_logs(spark, raw, out, check).awaitTermination()
    append_logs(spark, raw, out, check).awaitTermination()
    got = spark.read.parquet(f"{out}/log_acquisition")
    assert sorted((r.acquisition_state, r.instrument_serial) for r in got.collect()) == [("started", "06"), ("stopped", "06")]
    assert spark.read.parquet(f"{out}/malformed_log_lines").count() == 1


def test_mer_summary_reads_each_input_once(spark):
    from pelagia.operators.mer import events, judged, sections
    from pelagia.plans.metrics import mer_summary

    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    event = b"<EVENT><INFO DATE=2024-01-02T03:04:05 ROUNDS=1 ODD=1 ODD=2 /><FORMAT LENGTH=1 BYTES_PER_SAMPLE=2 /><DATA>xx</DATA></EVENT>"
    rows = [("a", event + event), ("b", b"<ENVIRONMENT>\n<DIVE ID=1 />\n<NEW />\n</ENVIRONMENT>"), ("c", event.replace(b"2024-01", b"2024-31"))]
    files = spark.createDataFrame(rows, "source_path string, content binary")
    counted = files.mapInPandas(count, files.schema)
    got = {(r.item, r.key): r.n for r in mer_summary(counted, sections(counted), judged(events(counted), strict=False)).collect()}
    assert got == {("total_files", ""): 3, ("zero_event_files", ""): 2, ("event_blocks", ""): 2, ("environment_kind", "dive"): 1, ("environment_kind", "unknown"): 1, ("unknown_environment_tag", "NEW"): 1, ("unknown_info_key", "ODD"): 2}
    assert seen.value == 4 * len(rows)  # the paths, the events and both kinds of sections
    every = [("a", event), ("b", event)]
    files = spark.createDataFrame(every, "source_path string, content binary")
    assert not [r for r in mer_summary(files, sections(files), judged(events(files), strict=False)).collect() if r.item == "zero_event_files"]


def test_audit_of_episodes_reads_its_rows_once(spark):
    from pelagia.operators.episodes import build_episodes, group_episodes, iridium_sessions
    from pelagia.functions.lines import parse_lines

    texts = ["1500000000:[SURF]Iridium...", "1500000001:[SURF]connected in 37s, signal quality 5", "1500000003:[SURF]disconnected after 9s"]
    lines = spark.createDataFrame([("f", n + 1, x) for n, x in enumerate(texts)], "source_path string, line_number long, raw_line string")
    made = iridium_sessions(build_episodes(group_episodes(parse_lines(lines)))).withColumns({"instrument_serial": F.lit("x"), "source_file": F.col("source_path")})
    rows = spark.createDataFrame(made.collect(), made.schema)
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    counted = rows.mapInArrow(count, rows.schema)
    assert audit_family(counted, "log_iridium").count() == 0 and seen.value == 1
    # rows without lines, or without numbers, are findings; rows stored twice are both judged
    none = rows.withColumns({"source_line_numbers": F.array().cast("array<bigint>"), "raw_lines": F.array().cast("array<string>")})
    for odd, column in ((none, "source_line_numbers"), (rows.withColumn("source_line_numbers", F.lit(None).cast("array<bigint>")), "raw_lines")):
        assert {f"{c} does not match the raw lines" for c in (column, "iridium_events")} <= {r.issue for r in audit_family(odd, "log_iridium").collect()}
    assert {r.issue for r in audit_family(rows.union(rows), "log_iridium").collect()} >= {"raw_lines does not match the raw lines"}


def test_kinds_and_trims_equal_their_patterns(spark):
    from pelagia.functions.families import EVENTS, event_kind
    from pelagia.functions.lines import parse_lines, strip

    texts = ["IRIDIUM...", "xConnected IN 3s, signal quality -1", "Failed to connect #1,code 2,net 3,qual 4,dial 5", "NO connection after 7s", "$TIME:1;", " $GPSACK:1;", "a$b;", "1 CMD received", "2 cmd(s) received", "Prompt received,  remote cmd end",
             '"07/AB.MER" Uploaded at 3bytes/s', "peer ask to resume 07/AB.LOG (1bytes) from byte 2", "3 bytes in 07/AB.BIN", "<err> upload of 07/AB.MER", "transfer interrupted, RETRY now", "<ERR>uploading failed", "1 FILE(S) uploaded", "Disconnected after 2s", "upload data FILES...",
             "connecKed", " x ", "　", "", " ", "\ta b\x0b", "İridium...", "é x", "x é", "x\x85"]
    rows = spark.createDataFrame([(x,) for x in texts], "m string")
    trim = F.regexp_replace("m", r"(?U)^\s+|\s+$", "")
    plain = F.lit("session_line")
    for name, pattern, _, _ in reversed(EVENTS):
        value = F.when(F.upper(F.regexp_extract(trim, pattern, 1)).isin("GPSACK", "GPSOFF"), "session_line").otherwise(name) if name == "command" else F.lit(name)
        plain = F.when(trim.rlike(pattern), value).otherwise(plain)
    got = rows.select("m", strip(F.col("m")).alias("s"), trim.alias("t"), event_kind(F.col("m")).alias("k"), plain.alias("p")).collect()
    assert all(r.s == r.t and r.k == r.p for r in got), [r for r in got if r.s != r.t or r.k != r.p]
    assert {r.k for r in got} >= {n for n, *_ in EVENTS}
    parse_lines(rows.select(F.col("m").alias("raw_line")))
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000
