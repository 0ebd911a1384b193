"""Incremental planning: source snapshots, their difference and the action it asks for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATE = ("instrument_serial", "source_file", "source_kind", "size_bytes", "content_hash")


def diff_sources(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Full outer comparison by instrument and file: change_kind new, removed, changed or unchanged."""
    key = ["instrument_serial", "source_file"]
    old = previous.select(*key, F.col("source_kind").alias("old_kind"), F.col("content_hash").alias("old_hash"), F.lit(True).alias("was"))
    new = current.select(*key, F.col("source_kind").alias("new_kind"), F.col("content_hash").alias("new_hash"), F.lit(True).alias("now"))
    kind = F.when(F.col("was").isNull(), "new").when(F.col("now").isNull(), "removed").when(F.col("old_hash").eqNullSafe(F.col("new_hash")), "unchanged").otherwise("changed")
    return old.join(new, key, "full_outer").select(*key, F.coalesce("new_kind", "old_kind").alias("source_kind"), "old_hash", "new_hash", kind.alias("change_kind"))


def actions(diff: DataFrame, *, force: bool = False, spoilt: DataFrame | None = None) -> DataFrame:
    """noop, append or rewrite per instrument and family (log covers bin); ``spoilt`` (instrument_serial, family) are rewritten."""
    family = F.when(F.col("source_kind") == "mer", "mer").otherwise("log")
    rows = diff.withColumn("family", family).groupBy("instrument_serial", "family").agg(
        F.count_if(F.col("change_kind").isin("changed", "removed")).alias("n_rewrite"), F.count_if(F.col("change_kind") == "new").alias("n_new"), F.count_if(F.col("change_kind") != "removed").alias("n_now")
    )
    again = F.lit(force)
    if spoilt is not None:
        rows = rows.join(spoilt.distinct().withColumn("_again", F.lit(True)), ["instrument_serial", "family"], "left")
        again = again | F.col("_again").isNotNull()
    act = F.when(again | (F.col("n_rewrite") > 0), "rewrite").when(F.col("n_new") > 0, "append").otherwise("noop")
    return rows.withColumn("action", act).drop("_again")


def invalidated(previous: DataFrame, current: DataFrame, failed: DataFrame) -> DataFrame:
    """(instrument_serial, family) to be written anew although no file changed.

    Both have one input_root, normalization_version and decoder_fingerprint an
    instrument. Another root or version, or a last run that failed (``failed``:
    instrument_serial), spoils both families; for instruments with BIN files a
    missing or changed decoder fingerprint spoils the LOG family.
    """
    facts = ("input_root", "normalization_version", "decoder_fingerprint")
    has_bin = F.bool_or(F.col("source_kind") == "bin")
    old, new = (df.groupBy("instrument_serial").agg(has_bin.alias(f"{n}_bin"), *(F.max(c).alias(f"{n}_{c}") for c in facts)) for n, df in (("old", previous), ("new", current)))
    rows = new.join(old.withColumn("_old", F.lit(True)), "instrument_serial", "left").join(failed.select("instrument_serial", F.lit(True).alias("_failed")), "instrument_serial", "left")
    known = F.col("_old").isNotNull()
    both = F.col("_failed").isNotNull() | known & (~F.col("old_input_root").eqNullSafe(F.col("new_input_root")) | ~F.col("old_normalization_version").eqNullSafe(F.col("new_normalization_version")))
    decoder = known & (F.col("old_bin") | F.col("new_bin")) & (F.col("new_decoder_fingerprint").isNull() | ~F.col("old_decoder_fingerprint").eqNullSafe(F.col("new_decoder_fingerprint")))
    spoilt = F.when(both, F.array(F.lit("log"), F.lit("mer"))).when(decoder, F.array(F.lit("log")))
    return rows.select("instrument_serial", F.explode(spoilt).alias("family"))


def overall_action(plan: DataFrame) -> DataFrame:
    """(instrument_serial, action): the strongest of its families' actions."""
    rank = F.when(F.col("action") == "rewrite", 2).when(F.col("action") == "append", 1).otherwise(0)
    return plan.groupBy("instrument_serial").agg(F.max(rank).alias("r")).select("instrument_serial", F.element_at(F.array(*map(F.lit, ("noop", "append", "rewrite"))), F.col("r") + 1).alias("action"))


def paths_for(diff: DataFrame, plan: DataFrame) -> DataFrame:
    """Files to read: all present ones of a rewrite, the new ones of an append."""
    family = F.when(F.col("source_kind") == "mer", "mer").otherwise("log")
    rows = diff.withColumn("family", family).join(plan.select("instrument_serial", "family", "action"), ["instrument_serial", "family"])
    return rows.where("(action = 'rewrite' and change_kind <> 'removed') or (action = 'append' and change_kind = 'new')")


def snapshot_id(files: DataFrame) -> DataFrame:
    """One row: sha256 over the sorted lines path, size, hash (tab-separated).

    The listing of a published tree, one short line a file, is what is hashed.
    """
    line = F.concat_ws("\t", "path", F.col("byte_size").cast("string"), "sha256")
    return files.agg(F.sha2(F.concat(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("path", line.alias("l")))), lambda x: x["l"]), "\n"), F.lit("\n")), 256).alias("snapshot_id"), F.count("*").alias("file_count"))
