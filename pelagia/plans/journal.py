"""Run journal and published snapshots of one output folder.

A run writes only into folders that bear its number, so nothing that readers see
changes before it is published. Publishing is one atomic step: the pointer
``snapshot.json`` is replaced by a rename and names the table of what is live
(kind, instrument_serial, run_id): of which runs the rows of an instrument's LOG
(``log``) and MER families (``mer``) count, and which run saw its sources
(``state``). An intent is recorded before the first write and removed when the
run's outcome is known, so a run that was killed at any point is found by the
next one, which records its outcome. Folders that are no longer live are deleted
at the start of a later run; until then readers of the snapshot before keep
theirs. One run at a time may write into a folder.
"""

from __future__ import annotations

import json
import secrets
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

POINTER = "snapshot.json"
LIVE = "kind string, instrument_serial string, run_id string"


def now() -> str:
    return datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%S.%fZ")


def new_run_id() -> str:
    """Ascends with time; fit for a folder's name."""
    return f"{datetime.now(UTC):%Y%m%dT%H%M%S.%fZ}-{secrets.token_hex(3)}"


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _conf(spark: SparkSession):
    return spark._jsparkSession.sessionState().newHadoopConf()


def file_system(spark: SparkSession, path: str):
    where = _path(spark, path)
    return where.getFileSystem(_conf(spark)), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = file_system(spark, path)
    return fs.exists(where)


def remove(spark: SparkSession, path: str) -> None:
    fs, where = file_system(spark, path)
    fs.delete(where, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    fs, where = file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def read_json(spark: SparkSession, path: str) -> dict | None:
    fs, where = file_system(spark, path)
    if not fs.exists(where):
        return None
    stream = fs.open(where)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def replace(spark: SparkSession, source: str, path: str) -> None:
    """Moves a file to ``path`` in one step, also where there is one already."""
    jvm = spark.sparkContext._jvm
    fs, where = file_system(spark, path)
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.OVERWRITE
    qualified = [fs.makeQualified(p) for p in (_path(spark, source), where)]
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(qualified[1].toUri(), _conf(spark)).rename(*qualified, options)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replaces the file as a whole: a reader sees the old text or the new one."""
    spare = f"{path.rpartition('/')[0]}/.{secrets.token_hex(6)}"
    fs, where = file_system(spark, spare)
    stream = fs.create(where, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    replace(spark, spare, path)


def write_json(spark: SparkSession, path: str, value: dict) -> None:
    write_text(spark, path, json.dumps(value, indent=2))


def pointer(spark: SparkSession, out: str) -> dict | None:
    """The published snapshot: run_id, previous, stateful, published_at."""
    return read_json(spark, f"{out}/{POINTER}")


def _none(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LIVE)


def live(spark: SparkSession, out: str) -> DataFrame:
    """(kind, instrument_serial, run_id) of the published snapshot; nothing where there is none."""
    at = pointer(spark, out)
    return spark.read.schema(LIVE).parquet(f"{out}/_snapshots/{at['run_id']}") if at else _none(spark)


def is_stateful(spark: SparkSession, out: str) -> bool:
    """Whether runs over a folder have kept their state here."""
    return exists(spark, f"{out}/manifests")


def begin(spark: SparkSession, out: str, run_id: str, facts: dict) -> None:
    """Records the intent of a run before it writes anything else."""
    write_json(spark, f"{out}/manifests/journal/{run_id}.json", facts | {"run_id": run_id, "status": "started"})


def close(spark: SparkSession, out: str, run_id: str) -> None:
    """Removes the intent: the outcome is on record."""
    remove(spark, f"{out}/manifests/journal/{run_id}.json")


def open_intents(spark: SparkSession, out: str) -> list[dict]:
    """Runs that have begun and have no outcome."""
    return [read_json(spark, f"{out}/manifests/journal/{n}") for n in children(spark, f"{out}/manifests/journal") if not n.startswith(".")]


def prepare(spark: SparkSession, out: str, run_id: str, plan: DataFrame | None) -> None:
    """Writes the live table that ``run_id`` will publish.

    ``plan`` has instrument_serial, family and action of every instrument the
    run saw. Rows of rewritten families leave, those of the run come; other
    instruments stay as they are. Without a plan the run alone is live, and
    ``plan`` of a run without state is all it has.
    """
    acted = plan.where("action <> 'noop'").select(F.col("family").alias("kind"), "instrument_serial", F.lit(run_id).alias("run_id"))
    seen = plan.select(F.lit("state").alias("kind"), "instrument_serial").distinct()
    at = pointer(spark, out)
    before = live(spark, out) if at and at["stateful"] and is_stateful(spark, out) else _none(spark)
    gone = plan.where("action = 'rewrite'").select(F.col("family").alias("kind"), "instrument_serial").unionByName(seen)
    stay = before.join(gone, ["kind", "instrument_serial"], "left_anti").select("kind", "instrument_serial", "run_id")
    every = stay.unionByName(acted).unionByName(seen.withColumn("run_id", F.lit(run_id)))
    every.coalesce(1).write.mode("overwrite").parquet(f"{out}/_snapshots/{run_id}")


def publish(spark: SparkSession, out: str, run_id: str, *, stateful: bool) -> None:
    """Makes the prepared live table of ``run_id`` the snapshot that readers follow."""
    before = pointer(spark, out)
    write_json(spark, f"{out}/{POINTER}", {"run_id": run_id, "previous": before and before["run_id"], "stateful": stateful, "published_at": now()})


def vacuum(spark: SparkSession, out: str, tables: dict[str, tuple[str, ...]]) -> None:
    """Deletes what no snapshot reads: folders of runs that were replaced or never published, and staging tables.

    ``tables`` names the kinds that each table's rows are live with. Walks the
    folders of runs and instruments, not their files.
    """
    at, kept = pointer(spark, out), set()
    name = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    for r in live(spark, out).where("kind <> 'state'").collect():  # one short row an instrument and run
        kept.add((r.kind, f"run={r.run_id}", name("instrument_serial", r.instrument_serial)))
    for table, kinds in tables.items():
        for run in children(spark, f"{out}/{table}"):
            if run == "run=none" or not run.startswith("run="):
                continue
            parts = {p for k, r, p in kept if r == run and k in kinds}
            if not parts:
                remove(spark, f"{out}/{table}/{run}")
                continue
            for part in children(spark, f"{out}/{table}/{run}"):
                if part.startswith("instrument_serial=") and part not in parts:
                    remove(spark, f"{out}/{table}/{run}/{part}")
    for old in children(spark, f"{out}/_snapshots"):
        if not at or old != at["run_id"]:
            remove(spark, f"{out}/_snapshots/{old}")
    remove(spark, f"{out}/_staging")
