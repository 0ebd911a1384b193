"""Runs that break off, files that change meanwhile, memoised hashes, and runs without state."""

import os
import time

import pytest

from pelagia.plans import journal, manifests
from pelagia.plans import normalize as module
from pelagia.plans.metrics import log_summary
from pelagia.plans.normalize import normalize, read_family

STEPS = ("begun", "read", "planned", "reread", "parsed", "written", "prepared", "published", "recorded", "listed")


class Killed(BaseException):
    """Stands for the end of the driver's process."""


def _put(folder, **texts):
    folder.mkdir(parents=True, exist_ok=True)
    for name, text in texts.items():
        path = folder / name.replace("__", ".")
        path.write_text(text)
        os.utime(path, ns=(time.time_ns(), time.time_ns()))


def _messages(spark, out):
    return sorted((r.source_file, r.message) for r in read_family(spark, out, "log_unclassified").select("source_file", "message").collect())


def _expected(folder):
    return sorted((p.name, line.split("]", 1)[1]) for p in folder.iterdir() for line in p.read_text().splitlines())


@pytest.mark.parametrize("ends", ["interrupt", "kill"])
def test_a_run_may_end_at_any_step(spark, tmp_path, monkeypatch, ends):
    """Each run changes one file, adds one and ends at a step; readers see all of it or nothing, and no row is lost or doubled."""
    folder, raw, out = tmp_path / "raw" / "452.020-P-06", str(tmp_path / "raw"), str(tmp_path / "out")
    _put(folder, **{"06_0__LOG": "1500000000:[MAIN]first\n", "06_c__LOG": "1500000000:[MAIN]changes 0\n"})
    normalize(spark, raw, out)
    seen = _expected(folder)
    if ends == "kill":
        monkeypatch.setattr(module, "_failed", lambda *a: None)
    steps = STEPS if ends == "kill" else ("written", "published")
    for k, step in enumerate(steps):
        _put(folder, **{f"06_{k + 1}__LOG": f"1500000001:[MAIN]new {step}\n", "06_c__LOG": f"1500000000:[MAIN]changes {k + 1}\n"})

        def stop(at, step=step):
            if at == step:
                raise Killed(step) if ends == "kill" else KeyboardInterrupt(step)

        with monkeypatch.context() as patch, pytest.raises((Killed, KeyboardInterrupt)):
            patch.setattr(module, "reached", stop)
            normalize(spark, raw, out)
        if STEPS.index(step) >= STEPS.index("published"):
            seen = _expected(folder)
        assert _messages(spark, out) == seen, step
    last = {r.instrument_serial: r.action for r in normalize(spark, raw, out).collect()}
    assert _messages(spark, out) == _expected(folder) and set(last.values()) <= {"noop", "rewrite"}
    runs = manifests.table(spark, out, "runs").collect()
    assert sum(r.status == "success" for r in runs) == 2 + sum(STEPS.index(s) >= STEPS.index("published") for s in steps) and {r.status for r in runs} == {"success", "partial"}
    assert journal.open_intents(spark, out) == [] and not os.path.exists(f"{out}/_staging/x")
    made = journal.read_json(spark, f"{out}/{manifests.MANIFEST}")
    assert made["run_id"] == journal.pointer(spark, out)["run_id"] and {r.n_rows for r in manifests.latest_outputs(spark, out).where("family = 'log_unclassified'").collect()} == {len(_expected(folder))}
    for f in made["files"]:
        assert os.path.getsize(f"{out}/{f['path']}") == f["byte_size"]


def test_the_first_run_may_break_off(spark, tmp_path, monkeypatch):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    _put(tmp_path / "raw", **{"06_0__LOG": "1500000000:[MAIN]first\n"})
    monkeypatch.setattr(module, "_failed", lambda *a: None)
    monkeypatch.setattr(module, "reached", lambda at: (_ for _ in ()).throw(Killed()) if at == "prepared" else None)
    with pytest.raises(Killed):
        normalize(spark, raw, out)
    with pytest.raises(ValueError, match="no finished run"):
        read_family(spark, out, "log_unclassified")
    monkeypatch.undo()
    normalize(spark, raw, out)
    rows = read_family(spark, out, "log_unclassified").collect()
    assert [(r.message, r.instrument_serial) for r in rows] == [("first", "06")]  # a serial of digits stays a text
    assert {r.status for r in manifests.table(spark, out, "runs").collect()} <= {"success", "failed"}


@pytest.mark.parametrize("step", ["planned", "written"])
def test_a_file_that_changes_during_a_run_is_changed_in_the_next(spark, tmp_path, monkeypatch, step):
    """Rows and state are of one reading: what is published is what the state says, so the next run sees the change."""
    folder, raw, out = tmp_path / "raw" / "452.020-P-06", str(tmp_path / "raw"), str(tmp_path / "out")
    _put(folder, **{"06_a__LOG": "1500000000:[MAIN]a\n", "06_b__LOG": "1500000000:[MAIN]b\n"})
    normalize(spark, raw, out)
    _put(folder, **{"06_a__LOG": "1500000000:[MAIN]a changed\n"})  # the whole family is read again
    with monkeypatch.context() as patch:
        patch.setattr(module, "reached", lambda at: _put(folder, **{"06_a__LOG": "1500000000:[MAIN]a during\n", "06_b__LOG": "1500000000:[MAIN]b during the run\n"}) if at == step else None)
        normalize(spark, raw, out)
    hashes = {r.source_file.rpartition("/")[2]: r.content_hash for r in manifests.latest_state(spark, out).collect()}
    rows = {r.source_file: r.source_sha256 for r in read_family(spark, out, "log_unclassified").collect()}
    assert hashes == rows
    changes = {r.source_file.rpartition("/")[2]: r.change_kind for r in normalize(spark, raw, out).collect()}
    assert changes["06_a.LOG"] == "changed" and _messages(spark, out) == _expected(folder)


def test_hashes_are_memoised_by_size_and_time(spark, tmp_path):
    folder, raw, out = tmp_path / "raw" / "452.020-P-06", str(tmp_path / "raw"), str(tmp_path / "out")
    _put(folder, **{"06_a__LOG": "1500000000:[MAIN]a\n", "06_b__LOG": "1500000000:[MAIN]b\n"})
    normalize(spark, raw, out)
    path = folder / "06_a.LOG"
    was = path.stat().st_mtime_ns
    path.write_text("1500000000:[MAIN]z\n")
    os.utime(path, ns=(was, was))
    _put(folder, **{"06_c__LOG": "1500000000:[MAIN]c\n"})
    plan = lambda **k: {r.source_file.rpartition("/")[2]: (r.change_kind, r.action) for r in normalize(spark, raw, out, dry_run=True, **k).collect()}
    # only the new file is opened
    assert plan() == {"06_a.LOG": ("unchanged", "append"), "06_b.LOG": ("unchanged", "append"), "06_c.LOG": ("new", "append")}
    assert plan(force=True)["06_a.LOG"] == ("changed", "rewrite")
    os.utime(folder / "06_b.LOG")  # touched, but the same
    assert plan()["06_b.LOG"] == ("unchanged", "append")


def test_runs_without_state_replace_all_rows(spark, tmp_path):
    _put(tmp_path / "raw", **{"06_1__LOG": "1500000000:[MAIN]first\n", "06_2__LOG": "1500000000:[MAIN]second\n", "07_1__LOG": "1500000000:[MAIN]third\n"})
    out, at = str(tmp_path / "out"), lambda *n: [str(tmp_path / "raw" / f"{x}.LOG") for x in n]
    assert {r.action for r in normalize(spark, at("06_1"), out, dry_run=True).collect()} == {"rewrite"} and not os.path.exists(out)
    for names, want in ((("06_1",), ["first"]), (("06_1",), ["first"]), (("06_2", "07_1"), ["second", "third"])):
        assert {r.action for r in normalize(spark, at(*names), out).collect()} == {"rewrite"}
        assert [m for _, m in _messages(spark, out)] == want
    assert not journal.is_stateful(spark, out)
    normalize(spark, str(tmp_path / "raw"), out)  # a folder's run takes the output over
    assert len(_messages(spark, out)) == 3
    with pytest.raises(ValueError, match="state of runs"):
        normalize(spark, at("06_1"), out)


def test_a_bin_without_decoder_is_listed_once(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    for name in ("452.020-P-06", "467.174-T-0100"):
        prefix = name.rpartition("-")[2]
        _put(tmp_path / "raw" / name, **{f"{prefix}_1__BIN": "x", f"{prefix}_1__LOG": "1500000000:[MAIN]a\n"})
    listed = lambda: sorted(r.source_file for r in read_family(spark, out, "quarantine/skipped_files").collect())
    for k in range(3):
        _put(tmp_path / "raw" / "452.020-P-06", **{f"06_{k + 2}__LOG": "1500000000:[MAIN]b\n"})
        normalize(spark, raw, out)
        assert listed() == ["0100_1.BIN", "06_1.BIN"]
    _put(tmp_path / "raw" / "452.020-P-06", **{"06_9__BIN": "y", "06_2__LOG": "1500000000:[MAIN]changed\n"})
    normalize(spark, raw, out)
    assert listed() == ["0100_1.BIN", "06_1.BIN", "06_9.BIN"]


def test_counters_come_from_the_writing_jobs(spark, tmp_path):
    raw, out, folder = str(tmp_path / "raw"), str(tmp_path / "out"), tmp_path / "raw" / "452.020-P-06"
    _put(folder, **{"06_1__LOG": "1500000000:[MAIN]acq started\n1500000001:[MAIN]acq already started\n1500000002:[MAIN]acq started\n1500000003:[SURF]GPS fix...\nodd\n", "06_2__LOG": "1500000000:[SBE61]P 1, T 2, S 3\n1500000001:[SBE61]P 1, T 2, S 3\n"})
    normalize(spark, raw, out)
    made = log_summary(manifests.table(spark, out, "metrics").collect())
    assert made["total_records"] == 5 and made["family_record_counts"] == {"acquisition": 3, "gps": 1, "ctd": 1, **dict.fromkeys(("ascent_request", "pressure_temperature", "battery", "unclassified", "parameter", "testmode", "iridium"), 0)}
    assert made["family_source_line_counts"]["ctd"] == 2
    assert made["counts"] == {"acquisition_state": {"started": 3}, "acquisition_evidence_kind": {"transition": 2, "assertion": 1}, "acquisition": {"started:transition": 2, "started:assertion": 1}, "gps_record_kind": {"fix_attempt": 1}}
    assert made["examples"]["acquisition_evidence_kind"]["transition"]["source_line_number"] == 1 and made["examples"]["gps_record_kind"]["fix_attempt"]["source_file"] == "06_1.LOG"
