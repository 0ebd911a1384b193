"""External decoders with their failures, and the canonical JSON-lines files."""

import json
import sys

import pytest

from pelagia import cli
from pelagia.functions.filenames import parsed_filename, record_filename
from pelagia.plans.normalize import LOG_FAMILIES, MER_FAMILIES, export_canonical, normalize, read_family
from pelagia.sources.decoder import DecoderError, Program, bundle_hash, decode_files, decoder, run_preflight

SCRIPT = """
import pathlib, sys, time
for p in pathlib.Path(sys.argv[-1]).glob("*.BIN"):
    text = p.read_text()
    if text == "fail":
        print("boom", file=sys.stderr); sys.exit(3)
    if text == "hang":
        time.sleep(60)
    if text != "none":
        p.with_suffix(".LOG").write_text(text)
        p.unlink()
"""


@pytest.fixture
def program(tmp_path):
    (tmp_path / "decode.py").write_text(SCRIPT)
    return Program((sys.executable, str(tmp_path / "decode.py")), seconds=20)


def test_programs_and_their_failures(program):
    assert decode_files(program, [("/x/06_a.BIN", b"one"), ("/x/06_b.BIN", b"two")]) == [("06_a", b"one"), ("06_b", b"two")]
    for text, said in ((b"fail", "exit code 3: boom"), (b"none", "no LOG file")):
        with pytest.raises(DecoderError, match=said) as told:
            decode_files(program, [("/x/06_a.BIN", text), ("/x/06_b.BIN", text)])
        assert "/x/06_a.BIN, /x/06_b.BIN" in str(told.value)
    with pytest.raises(DecoderError, match="no end within 1 s"):
        decode_files(Program(program.command, seconds=1), [("/x/06_a.BIN", b"hang")])
    with pytest.raises(DecoderError, match="No such file"):
        decode_files(Program(("/no/such/program",)), [("/x/06_a.BIN", b"one")])
    with pytest.raises(ValueError, match="command"):
        Program(())


def test_preflight_and_fingerprint(program, tmp_path):
    data = tmp_path / "db.json"
    data.write_text("1")
    full = Program(program.command, preflight=(sys.executable, "-c", "import sys; sys.exit(2)"), database=(str(data),))
    with pytest.raises(DecoderError, match="preflight failed: exit code 2"):
        run_preflight(full, "strict")
    assert run_preflight(full, "cached")["status"] == "failed" and run_preflight(program, "strict")["status"] == "none"
    before = full.fingerprint()
    data.write_text("2")
    assert full.fingerprint() != before and bundle_hash([str(tmp_path / "none")]) is None


def test_bins_are_decoded_on_the_executors(spark, program, tmp_path):
    folder, raw, out = tmp_path / "raw" / "452.020-P-06", str(tmp_path / "raw"), str(tmp_path / "out")
    folder.mkdir(parents=True)
    for k in range(5):
        (folder / f"06_{k}.BIN").write_text(f"150000000{k}:[MAIN]line {k}\n")
    small = Program(program.command, files_a_run=2)
    normalize(spark, raw, out, decoder=decoder(small), fingerprint=small.fingerprint())
    assert sorted((r.source_file, r.message) for r in read_family(spark, out, "log_unclassified").collect()) == [(f"06_{k}.BIN", f"line {k}") for k in range(5)]
    (folder / "06_9.BIN").write_text("fail")
    with pytest.raises(Exception, match=r"error while decoding .*06_9.BIN: exit code 3: boom"):
        normalize(spark, raw, out, decoder=decoder(small), fingerprint=small.fingerprint())
    assert read_family(spark, out, "log_unclassified").count() == 5 and (folder / "06_0.BIN").exists()
    assert cli.main(["normalize", "-i", raw, "-o", out, "--decoder", "a:b", "--decoder-command", "x"], spark) == 2


def test_canonical_files(spark, tmp_path):
    raw, out, target = tmp_path / "raw", str(tmp_path / "out"), tmp_path / "json"
    for serial, prefix in (("452.020-P-06", "06"), ("467.174-T-0100", "0100")):
        (raw / serial).mkdir(parents=True)
        for k in (2, 1):
            (raw / serial / f"{prefix}_{k}.LOG").write_text("".join(f"{1500000000 + i}:[MAIN]{prefix} {k} {i}\n" for i in range(30)))
    normalize(spark, str(raw), out)
    for _ in range(2):
        export_canonical(spark, out, str(target))
        families = (*LOG_FAMILIES, *MER_FAMILIES)
        for serial, prefix in (("452.020-P-06", "06"), ("467.174-T-0100", "0100")):
            assert sorted(p.name for p in (target / serial).iterdir() if not p.name.startswith(".")) == sorted(record_filename(f, serial) for f in families)
            lines = (target / serial / record_filename("log_unclassified", serial)).read_text().splitlines()
            assert [json.loads(x)["message"] for x in lines] == [f"{prefix} {k} {i}" for k in (1, 2) for i in range(30)]
            assert "source_path" not in json.loads(lines[0]) and (target / serial / record_filename("log_gps", serial)).read_text() == ""
    assert parsed_filename("log_gps_records.452.020-P-06.jsonl", families) == ("log_gps", "452.020-P-06")
    assert [parsed_filename(n, families) for n in ("log_gps_records.jsonl", "log_x_records.1.jsonl", "log_gps_records.1.json")] == [None] * 3
    with pytest.raises(ValueError, match="file name"):
        record_filename("log_gps", "a/b")
