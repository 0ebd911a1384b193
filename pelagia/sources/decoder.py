"""BIN files decoded by an external program: an own folder and process for each group of files, on the executors.

The program itself is no part of this library. It is called with a folder that
holds copies of the group's BIN files and leaves LOG files there; the sources
are never touched. A group is the files of one instrument, or a share of them
where there are many; a task whose executor is lost runs again in a new folder.
"""

from __future__ import annotations

import hashlib
import json
import subprocess
import tempfile
from collections.abc import Callable
from dataclasses import dataclass, field
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOGS = "prefix string, stem string, content binary"


class DecoderError(RuntimeError):
    """A program that failed, hung or left nothing, with the sources it was given."""


@dataclass(frozen=True)
class Program:
    """An external decoder: ``command`` gets the folder as its last argument.

    ``preflight`` is run once on the driver before a run, to refresh what the
    program needs; ``database`` are the files that it decodes with.
    """

    command: tuple[str, ...]
    seconds: float = 600
    files_a_run: int = 64
    preflight: tuple[str, ...] = ()
    database: tuple[str, ...] = ()
    environment: dict[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if not self.command or self.seconds <= 0 or self.files_a_run < 1:
            raise ValueError("a decoder needs a command, a time limit and at least one file a run")

    def fingerprint(self) -> str:
        """Names the program and its database by content: another one spoils what the last has decoded."""
        scripts = [p for p in self.command if Path(p).is_file()]
        facts = {"command": self.command, "scripts": bundle_hash(scripts), "database": bundle_hash(self.database)}
        return hashlib.sha256(json.dumps(facts, sort_keys=True).encode()).hexdigest()


def bundle_hash(paths: tuple[str, ...] | list[str]) -> str | None:
    """sha256 over the lines ``name<tab>sha256`` of the files that exist, in order; null without any."""
    found = [Path(p) for p in sorted(paths) if Path(p).is_file()]
    lines = [f"{p.name}\t{hashlib.sha256(p.read_bytes()).hexdigest()}" for p in found]
    return hashlib.sha256("\n".join(lines).encode()).hexdigest() if lines else None


def run_preflight(program: Program, mode: str) -> dict:
    """Status of the preflight: ok, or failed with the reason; a failure raises in mode ``strict`` and is only told in mode ``cached``."""
    status = {"mode": mode, "status": "none", "detail": None, "database_bundle_hash": bundle_hash(program.database)}
    if not program.preflight:
        return status
    detail = _ran(program.preflight, program)
    status |= {"status": "failed" if detail else "ok", "detail": detail, "database_bundle_hash": bundle_hash(program.database)}
    if detail and mode == "strict":
        raise DecoderError(f"decoder preflight failed: {detail}")
    return status


def _ran(command: tuple[str, ...], program: Program, folder: str | None = None) -> str | None:
    """Runs a command; what went wrong, or null."""
    import os

    try:
        done = subprocess.run(command, cwd=folder, env=os.environ | program.environment, capture_output=True, timeout=program.seconds, check=False)
    except subprocess.TimeoutExpired:
        return f"no end within {program.seconds:g} s"
    except OSError as broke:
        return str(broke)
    if done.returncode:
        said = (done.stderr or done.stdout).decode("utf-8", "replace").strip()
        return f"exit code {done.returncode}: {said[-1000:]}"
    return None


def decode_files(program: Program, files: list[tuple[str, bytes]]) -> list[tuple[str, bytes]]:
    """(stem, content) of the LOG files that the program makes of BIN ``files`` (path, content), in a folder of its own."""
    sources = ", ".join(p for p, _ in files)
    with tempfile.TemporaryDirectory(prefix="decode-") as folder:
        for path, content in files:
            Path(folder, path.rpartition("/")[2]).write_bytes(content)
        wrong = _ran((*program.command, folder), program, folder)
        made = sorted(p for p in Path(folder).rglob("*") if p.suffix.lower() == ".log" and p.is_file())
        if wrong or not made:
            raise DecoderError(f"error while decoding {sources}: {wrong or 'the program left no LOG file'}")
        return [(p.stem.lower(), p.read_bytes()) for p in made]


def decoder(program: Program) -> Callable[[DataFrame], DataFrame]:
    """The decoder for ``normalize``: BIN files (source_path, prefix, stem, content, ...) to LOG files (prefix, stem, content)."""

    def group(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("source_path")
        made = decode_files(program, list(zip(pdf["source_path"], map(bytes, pdf["content"]), strict=True)))
        return pd.DataFrame([(key[0], stem, content) for stem, content in made], columns=["prefix", "stem", "content"])

    def run(bins: DataFrame) -> DataFrame:
        groups = bins.groupBy("prefix").agg(F.ceil(F.count("*") / program.files_a_run).alias("_n"))
        rows = bins.join(groups, "prefix").withColumn("_part", F.pmod(F.xxhash64("stem"), "_n"))
        return rows.select("prefix", "_part", "source_path", "content").groupBy("prefix", "_part").applyInPandas(group, LOGS)

    return run
