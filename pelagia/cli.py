"""Command line: ``python -m pelagia.cli normalize | audit | export``."""

from __future__ import annotations

import argparse
import importlib
import json
import os
import re
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pelagia import __version__
from pelagia.operators.state import overall_action
from pelagia.plans import journal, manifests
from pelagia.plans.audit import audit
from pelagia.plans.normalize import QUARANTINE, export_all, export_canonical, normalize, read_family
from pelagia.sources.decoder import DecoderError, Program, run_preflight
from pelagia.sources.decoder import decoder as program_decoder
from pelagia.sources.files import NAME, parse_inputs

#: Environment variables that stand for options not given.
OUTPUT, DECODER, FINGERPRINT = "PELAGIA_OUTPUT", "PELAGIA_DECODER", "PELAGIA_DECODER_FINGERPRINT"


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="pelagia")
    top.add_argument("-v", "--version", action="version", version=__version__)
    jobs = top.add_subparsers(dest="job", required=True)
    run = jobs.add_parser("normalize", help="write the records of raw files")
    run.add_argument("-i", "--input-root")
    run.add_argument("--input-file", action="append", nargs="+", default=[])
    run.add_argument("--instrument-serial")
    run.add_argument("-o", "--output-dir", default=os.environ.get(OUTPUT))
    run.add_argument("--decoder", default=os.environ.get(DECODER), help="module:function from BIN files to LOG files")
    run.add_argument("--decoder-command", nargs="+", help="program and its arguments; it gets a folder of BIN files and leaves LOG files there")
    run.add_argument("--decoder-preflight", nargs="+", default=[], help="command that refreshes what the program needs")
    run.add_argument("--decoder-database", nargs="+", default=[], help="files that the program decodes with")
    run.add_argument("--decoder-seconds", type=float, default=600, help="time limit of one call")
    run.add_argument("--decoder-fingerprint", default=os.environ.get(FINGERPRINT))
    run.add_argument("--preflight-mode", choices=("strict", "cached"), default="strict", help="whether the decoder must refresh its database")
    run.add_argument("--dry-run", action="store_true")
    run.add_argument("-f", "--force", action="store_true")
    run.add_argument("--json", action="store_true")
    run.add_argument("-v", "--verbose", action="store_true")
    for name in ("audit", "export"):
        job = jobs.add_parser(name)
        job.add_argument("-o", "--output-dir", default=os.environ.get(OUTPUT))
        if name == "export":
            job.add_argument("--canonical", action="store_true", help="one file a family and instrument, in the order of the sources")
        job.add_argument("--target" if name == "export" else "--limit", **({"required": True} if name == "export" else {"type": int, "default": 25}))
    return top


def checked(args: argparse.Namespace) -> argparse.Namespace:
    """Options that fit each other, or ValueError."""
    if not args.output_dir:
        raise ValueError(f"give --output-dir or set {OUTPUT}")
    if args.job == "normalize":
        args.input_file = parse_inputs([x for xs in args.input_file for x in xs])
        if bool(args.input_root) == bool(args.input_file):
            raise ValueError("give either --input-root or --input-file")
        if args.json and not args.dry_run:
            raise ValueError("--json needs --dry-run")
        if args.instrument_serial and not re.match(NAME, args.instrument_serial):
            raise ValueError(f"not an instrument serial: {args.instrument_serial}")
        if args.decoder and args.decoder_command:
            raise ValueError("give either --decoder or --decoder-command")
        if args.instrument_serial and args.input_file:
            raise ValueError("--instrument-serial needs --input-root")
    return args


def load_decoder(name: str | None, preflight: str):
    """The function ``module:function``; its optional ``preflight(mode)`` runs first and may fail only in strict mode."""
    if not name:
        return None
    module, _, function = name.partition(":")
    made = getattr(importlib.import_module(module), function)
    if hasattr(made, "preflight"):
        try:
            made.preflight(preflight)
        except Exception as broke:
            if preflight == "strict":
                raise
            print(f"decoder preflight failed, going on with what is cached: {broke}", file=sys.stderr)
    return made


def _counts(diff: DataFrame) -> list[dict]:
    """One dict for each instrument: changes by kind and actions by family."""
    rows = diff.groupBy("instrument_serial", "family", "action", "change_kind").agg(F.count("*").alias("n")).collect()
    out: dict[str, dict] = {}
    for r in sorted(rows, key=lambda r: (r.instrument_serial, r.family, r.change_kind)):
        one = out.setdefault(r.instrument_serial, {"instrument_serial": r.instrument_serial, "counts": dict.fromkeys(("new", "changed", "removed", "unchanged"), 0), "families": {}})
        one["counts"][r.change_kind] += r.n
        one["families"][r.family] = {"action": r.action}
    return list(out.values())


def report(diff: DataFrame, *, as_json: bool) -> str:
    """The plan or what was done, an instrument a line."""
    found = _counts(diff)
    if as_json:
        changed = diff.where("change_kind <> 'unchanged'").select("instrument_serial", "family", "source_file", "change_kind").orderBy("source_file").collect()
        by: dict[tuple[str, str], list[dict]] = {}
        for r in changed:
            by.setdefault((r.instrument_serial, r.family), []).append(r.asDict())
        for one in found:
            for family, own in one["families"].items():
                own["file_diffs"] = by.get((one["instrument_serial"], family), [])
        return json.dumps({"instruments": found}, indent=2)
    overall = {r.instrument_serial: r.action for r in overall_action(diff).collect()}
    lines = [f"{x['instrument_serial']}: {overall[x['instrument_serial']]} (" + ", ".join(f"{f} {a['action']}" for f, a in x["families"].items()) + "); " + ", ".join(f"{n} {k}" for k, n in x["counts"].items() if n) for x in found]
    return "\n".join(lines or ["no sources"])


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    try:
        args = checked(parser().parse_args(argv))
        spark = spark or SparkSession.builder.appName("pelagia").config("spark.sql.session.timeZone", "UTC").getOrCreate()
        out = args.output_dir
        if args.job == "export":
            (export_canonical if args.canonical else export_all)(spark, out, args.target)
            return 0
        if args.job == "audit":
            found = audit(spark, out)
            n = found.count()
            for r in found.orderBy("family", "source_file", "place").limit(args.limit).collect():
                print(f"{r.family} {r.source_file}:{r.place}: {r.issue}")
            print(f"{n} findings")
            return int(n > 0)
        root = args.input_root or args.input_file
        decoder, fingerprint = load_decoder(args.decoder, args.preflight_mode), args.decoder_fingerprint
        if args.decoder_command:
            program = Program(tuple(args.decoder_command), args.decoder_seconds, preflight=tuple(args.decoder_preflight), database=tuple(args.decoder_database))
            status = run_preflight(program, args.preflight_mode)
            decoder, fingerprint = program_decoder(program), fingerprint or program.fingerprint()
            if not args.dry_run:
                journal.write_json(spark, f"{out}/preflight_status.json", status)
        diff = normalize(spark, root, out, force=args.force, dry_run=args.dry_run, strict=bool(args.input_file), serial=args.instrument_serial, decoder=decoder, fingerprint=fingerprint)
        print(report(diff, as_json=args.json))
        if not args.dry_run and args.verbose:
            done = manifests.latest_runs(spark, out).agg({"run_id": "max"}).first()[0]
            for r in manifests.table(spark, out, "metrics").where(F.col("run_id") == done).where("counter like '%=%'").orderBy("family", "counter").collect():
                print(f"  {r.family} {r.counter}: {r.n} written")
            for r in manifests.latest_outputs(spark, out).orderBy("instrument_serial", "family").collect():
                print(f"  {r.instrument_serial} {r.family}: {r.n_rows} rows")
            for name in QUARANTINE:
                if manifests.exists(spark, f"{out}/quarantine/{name}"):
                    print(f"  {name}: {read_family(spark, out, f'quarantine/{name}').count()} rows")
        return 0
    except (ValueError, ImportError, AttributeError, DecoderError) as wrong:
        print(f"pelagia: {wrong}", file=sys.stderr)
        return 2


if __name__ == "__main__":
    sys.exit(main())
