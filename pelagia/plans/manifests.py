"""Bookkeeping tables of the runs into one output folder, and its root manifest.

Below ``out/manifests``, a folder a run in each table: ``runs`` (a row for each
instrument), ``source_state`` (the sources that the run saw), ``outputs`` (rows a
family after the run), ``files`` (the data files it wrote), ``metrics`` (counters
of what it wrote), ``diffs`` (changes it found) and ``pruned`` (removed sources).
A run's folder is written as a whole, so writing it again changes nothing. What
counts of ``source_state``, ``outputs`` and ``files`` is decided by the snapshot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pelagia import __version__
from pelagia.operators.state import snapshot_id
from pelagia.plans import journal
from pelagia.plans.journal import exists, new_run_id, now, remove

MANIFEST = "normalization_manifest.json"
#: Columns of the tables.
TABLES = {
    "runs": "instrument_serial string, started_at string, completed_at string, input_root string, output_root string, normalization_version string, status string, error string",
    "source_state": "instrument_serial string, source_file string, source_kind string, size_bytes long, modified_at timestamp, content_hash string, named_serial string, input_root string, normalization_version string, decoder_fingerprint string",
    "outputs": "instrument_serial string, family string, n_rows long",
    "files": "name string, instrument_serial string, path string, byte_size long, sha256 string, n_rows long",
    "metrics": "family string, counter string, n long, example string",
    "diffs": "instrument_serial string, source_file string, source_kind string, old_hash string, new_hash string, change_kind string, family string, action string",
    "pruned": "instrument_serial string, source_file string, source_kind string, removed_at string",
}


def kinds_of(name: str) -> tuple[str, ...]:
    """Whether a table's rows are live with the LOG or the MER families; ``skipped_files`` has both, by its column family."""
    return ("log", "mer") if name.endswith("skipped_files") else ("mer",) if "mer_" in name else ("log",)


def table(spark: SparkSession, out: str, name: str) -> DataFrame:
    """A bookkeeping table with its run_id; empty where no run has written it."""
    path, schema = f"{out}/manifests/{name}", f"{TABLES[name]}, run_id string"
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def put(rows: DataFrame, out: str, name: str, run_id: str) -> None:
    """The rows of a run in a bookkeeping table."""
    kinds = dict(x.rsplit(" ", 1) for x in TABLES[name].split(", "))
    rows.select(*(F.col(c).cast(k).alias(c) for c, k in kinds.items())).write.mode("overwrite").parquet(f"{out}/manifests/{name}/run_id={run_id}")


def _of_snapshot(spark: SparkSession, out: str, name: str) -> DataFrame:
    """The rows of the runs that saw each instrument last."""
    states = journal.live(spark, out).where("kind = 'state'").select("instrument_serial", "run_id")
    return table(spark, out, name).join(states, ["instrument_serial", "run_id"], "left_semi")


def latest_runs(spark: SparkSession, out: str) -> DataFrame:
    """instrument_serial, run_id, status of each instrument's last run."""
    last = F.max_by(F.struct("run_id", "status"), "run_id").alias("r")
    return table(spark, out, "runs").groupBy("instrument_serial").agg(last).select("instrument_serial", "r.*")


def latest_state(spark: SparkSession, out: str) -> DataFrame:
    """The sources of each instrument as the published snapshot has them."""
    return _of_snapshot(spark, out, "source_state")


def latest_outputs(spark: SparkSession, out: str) -> DataFrame:
    """instrument_serial, family, n_rows of the published snapshot."""
    return _of_snapshot(spark, out, "outputs").select("instrument_serial", "family", "n_rows")


def hashed(spark: SparkSession, out: str, folders: list[str]) -> DataFrame:
    """path (below ``out``), byte_size, sha256, n_rows of the data files in ``folders``."""
    if not folders:
        return spark.createDataFrame([], "path string, byte_size long, sha256 string, n_rows long")
    fs, where = journal.file_system(spark, out)
    base = fs.makeQualified(where).toString().split(":", 1)[1].lstrip("/")
    deep = lambda r: r.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    own = F.col("_metadata.file_path").alias("key")
    files = deep(spark.read.format("binaryFile")).load(folders).select(own, "path", "length", F.sha2("content", 256).alias("sha256"))
    # rows are counted by the files' footers alone
    counts = deep(spark.read.schema("none int")).parquet(*folders).select(own).groupBy("key").agg(F.count("*").alias("n_rows"))
    # one scheme may be written with one slash or three
    path = F.substring(F.regexp_replace("path", r"^[a-z0-9]+:/+", ""), len(base) + 2, 1 << 30)
    return files.join(counts, "key", "left").select(path.alias("path"), F.col("length").alias("byte_size"), "sha256", F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


def written_files(spark: SparkSession, out: str, names: list[str], run_id: str) -> DataFrame:
    """The rows of ``files`` for what ``run_id`` wrote: each file is hashed once, by the run that made it."""
    own = hashed(spark, out, [f for n in names if exists(spark, f := f"{out}/{n}/run={run_id}")]).withColumn("p", F.split("path", f"/run={run_id}/instrument_serial="))
    serial = F.url_decode(F.replace(F.split_part(F.col("p")[1], F.lit("/"), F.lit(1)), F.lit("+"), F.lit("%2B")))
    return own.select(F.col("p")[0].alias("name"), serial.alias("instrument_serial"), "path", "byte_size", "sha256", "n_rows")


def inventory(spark: SparkSession, out: str) -> DataFrame:
    """path, byte_size, sha256 of every published data file: those of the snapshot's runs, and of the tables' empty layout."""
    mixed, mer = F.col("name").endswith("skipped_files"), F.col("name").contains("mer_")
    kinds = F.when(mixed, F.array(F.lit("log"), F.lit("mer"))).otherwise(F.array(F.when(mer, "mer").otherwise("log")))
    own = table(spark, out, "files").withColumn("kind", F.explode(kinds)).join(journal.live(spark, out), ["kind", "instrument_serial", "run_id"], "left_semi")
    layout = [f"{out}/{top}{n}/run=none" for top in ("", "quarantine/") for n in journal.children(spark, f"{out}/{top}") if exists(spark, f"{out}/{top}{n}/run=none")]
    return own.select("path", "byte_size", "sha256").distinct().unionByName(hashed(spark, out, layout).drop("n_rows"))


def write_root_manifest(spark: SparkSession, out: str, input_root: str | None) -> dict:
    """``normalization_manifest.json``: what is published, by content; replaced as a whole.

    The listing, one short line a file, is one value by definition and passes the
    driver. Only files that are new to the run were hashed, and only once.
    """
    files = inventory(spark, out).persist()
    one, at = snapshot_id(files).first(), journal.pointer(spark, out)
    listed = [r.asDict() for r in files.orderBy("path").collect()]
    files.unpersist()
    made = {
        "schema_version": 1, "version": __version__, "generated_at": now(), "run_id": at and at["run_id"], "input_root": input_root, "checksum_algorithm": "sha256",
        "snapshot_id": one.snapshot_id, "file_count": one.file_count, "files": listed,
    }
    journal.write_json(spark, f"{out}/{MANIFEST}", made)
    return made


__all__ = ["exists", "inventory", "kinds_of", "latest_outputs", "latest_runs", "latest_state", "new_run_id", "now", "put", "remove", "table", "write_root_manifest", "written_files"]
