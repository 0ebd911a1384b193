"""The corpus pipeline: five stages over documents, each written as Parquet and reread."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pelagia.llm import decontam, minhash, mixing, pii, toxicity
from pelagia.llm.queries import TARGETS, labelled_domains
from pelagia.llm.scratch import drop, release, save


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go."""
    return toxicity.reject_toxic(docs, _labels(spark, sf_dir))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return minhash.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def hide_persons(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal values become pseudonyms; n_chars follows the text."""
    new = pii.pseudonymize(docs, key=pii.session_key(spark))
    return new.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def weigh(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, text and all, with its rate and its whole number of copies in the mix."""
    rates = mixing.mix(docs, labelled_domains(docs, _labels(spark, sf_dir)), TARGETS, keep=True)
    return rates.withColumnsRenamed({f"p_{k}": f"p_{d}" for k, d in enumerate(TARGETS)})


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash", drop_near_copies),
    ("decontaminate", drop_benchmark),
    ("pii", hide_persons),
    ("mixing", weigh),
]
#: Trained scores have no SQL form; the tests hold the stages against plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs, spent = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir))
        if spent is not None:  # what the stage before wrote has been read
            drop(spent)
        release(spark)
        spent = docs
    return docs
