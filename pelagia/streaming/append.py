"""Append-only path: new LOG files as a stream of classified lines.

It cannot see changed or removed files; the batch difference stays the authority.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pelagia.plans.journal import remove
from pelagia.plans.normalize import grouped_lines, tables_of
from pelagia.sources.files import identify, with_provenance


def append_logs(spark: SparkSession, root: str, out: str, checkpoint: str) -> StreamingQuery:
    """Write every family of each new LOG file below ``root`` to ``out``, and the malformed lines.

    A batch has a folder of its own that a retry replaces, so none is written twice.
    """
    schema = "path string, modificationTime timestamp, length long, content binary"
    files = spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", "*.[lL][oO][gG]").option("recursiveFileLookup", "true").load(root)

    def write(batch: DataFrame, number: int) -> None:
        found = identify(with_provenance(batch.select(F.col("path").alias("source_path"), F.col("length").alias("size_bytes"), "content")), root=root)
        staged = f"{out}/_staging/batch={number}"
        grouped_lines(found).write.mode("overwrite").parquet(staged)
        made = tables_of(spark.read.parquet(staged))
        names = found.select("source_path", "instrument_serial", "source_id")
        for name, table in {**made.families, "malformed_log_lines": made.malformed}.items():
            table.join(names, "source_path").write.mode("overwrite").parquet(f"{out}/{name}/batch={number}")
        remove(spark, f"{out}/_staging")

    return files.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
