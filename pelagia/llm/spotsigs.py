"""SpotSigs document fingerprints.

Every common word of a text is an anchor; the anchor and the chain of the next
``CHAIN`` content (not common) words after it form one signature. The
fingerprint is the set of signatures, written as its length class, its size and
its sorted 32-bit hashes in hex. Texts whose lengths alone rule out the wanted
likeness are told apart without reading the sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from math import ceil, floor, log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pelagia.llm.words import WordTable, mix, small_batches, stream, word_table

CHAIN = 3
#: Text of one range bucket.
BUCKET_BYTES = 8 << 20
#: Sets of one length class differ in size by less than this factor.
CLASS = 1.25
#: Common words that anchor signatures.
ANCHORS = (
    "a an and are as at be by for from has have he her his i in is it its not of on or she that the their they this to was we were which with you "
    "au aux ce dans de des du elle en est et il je la le les ne ou par pas pour que qui se sur un une vous "
    "als auf aus bei das dem den der des die ein eine er es für im ist mit nicht sich sie sind und von wie zu zur "
    "al con como del el en esta la las lo los más no o para pero por que se su un una y"
)
_ANCHORS = np.unique(word_table(pa.array(ANCHORS.split()), terms=True).hash)
_CHAIN = stream(CHAIN + 1, 31)


def _table(texts: pa.Array) -> WordTable:
    return word_table(pc.utf8_lower(texts.fill_null("")), terms=True)


def _chains(head: np.ndarray, follow: np.ndarray) -> np.ndarray:
    out = head * _CHAIN[0]
    for k in range(follow.shape[1]):
        out = out + follow[:, k] * _CHAIN[k + 1]
    return (mix(out) >> np.uint64(32)).astype(np.uint32)


def signatures(texts: pa.Array) -> list[np.ndarray]:
    """The sorted signature hashes of every text.

    A text without a full chain uses every word as an anchor and chains may stop
    at its end, so only texts without words have no signature.
    """
    t = _table(texts)
    common = np.isin(t.hash, _ANCHORS)
    content = np.flatnonzero(~common)
    padded = np.concatenate((t.hash, np.zeros(CHAIN, np.uint64)))
    sets = []
    for a, z in zip(t.first[:-1], t.first[1:], strict=True):
        spots = a + np.flatnonzero(common[a:z])
        nxt = np.searchsorted(content, spots)
        last = np.searchsorted(content, z)
        full = nxt + CHAIN <= last
        spots, nxt = spots[full], nxt[full]
        if len(spots):
            own = _chains(t.hash[spots], t.hash[content[nxt[:, None] + np.arange(CHAIN)]])
        else:
            at = np.arange(a, z)[:, None] + np.arange(1, CHAIN + 1)
            own = _chains(t.hash[a:z], np.where(at < z, padded[np.minimum(at, len(padded) - 1)], np.uint64(0)))
        sets.append(np.unique(own))
    return sets


def length_class(size: int) -> int:
    return floor(log(size) / log(CLASS)) if size else -1


def likeness(x: np.ndarray, y: np.ndarray, least: float = 0.0) -> float:
    """Jaccard of two sorted sets; 0.0 at once if their sizes can't reach ``least``."""
    if not len(x) and not len(y):
        return 1.0
    low, high = sorted((len(x), len(y)))
    if not low or low < least * high:
        return 0.0
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both)


def written(own: np.ndarray) -> str:
    return f"{length_class(len(own))}:{len(own)}:{own.astype('>u4').tobytes().hex()}"


def _edited(text: str, following: str) -> str:
    k = len(text) // 4
    return text[: len(text) - k] + following[:k] if k else text


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one bucket after the other in order; a bucket's copy rows close it."""
    held: tuple | None = None
    for b in batches:
        rows = []
        for bucket, copy, doc, text in zip(*(b.column(c).to_pylist() for c in ("bucket", "copy", "doc_id", "text")), strict=True):
            text = text or ""
            if held is not None and held[0] == bucket:
                rows.append((*held[1:], text))
            held = None if copy else (bucket, doc, text)
        if not rows:
            continue
        texts, nexts = [r[1] for r in rows], [r[2] for r in rows]
        edits = [_edited(x, y) for x, y in zip(texts, nexts, strict=True)]
        # each next text but the bucket's last is the following row's own
        own = signatures(pa.array([*texts, nexts[-1]], pa.string()))
        near_next = [
            likeness(own[i], own[i + 1] if i + 1 < len(rows) and texts[i + 1] is nexts[i] else own[-1] if i + 1 == len(rows) else signatures(pa.array([nexts[i]]))[0])
            for i in range(len(rows))
        ]
        new = signatures(pa.array(edits, pa.string()))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in rows], pa.int64()),
                pa.array([len(x) for x in texts], pa.int64()),
                pa.array([sha256(x.encode()).hexdigest() for x in edits]),
                pa.array([written(x) for x in own[:-1]]),
                pa.array([written(x) for x in new]),
                pa.array([likeness(x, y) for x, y in zip(own, new, strict=False)], pa.float64()),
                pa.array(near_next, pa.float64()),
            ],
            ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )


def _bucket(edges: list[int]) -> Column:
    """How many of the ascending ``edges`` are not above k, found in two steps of about sqrt(n) comparisons."""
    if not edges:
        return F.lit(0)
    width = ceil(len(edges) ** 0.5)
    groups = [edges[i : i + width] for i in range(0, len(edges), width)]
    upto = lambda known: F.size(F.filter(known, lambda e: e <= F.col("k")))
    coarse = upto(F.from_json(F.lit(str([g[0] for g in groups])), "array<bigint>"))
    fine = upto(F.get(F.from_json(F.lit(str(groups)), "array<array<bigint>>"), coarse - 1))
    return F.when(coarse > 0, (coarse - 1) * width + fine).otherwise(0).cast("int")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text of docs (doc_id, text) and of its edited text.

    Rows go once to range buckets of doc_id; the first row of each bucket is
    copied to the bucket before it, so every row meets its next one. Only bucket
    edges, one number per bucket, pass through the driver. Defined cases: null
    text counts as empty; null ids come first; rows of one doc_id follow each
    other by text; one row alone is its own next; two empty sets are alike (1.0);
    an empty table gives an empty result; extra columns are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("k", F.coalesce("doc_id", F.lit(-(1 << 63))))
    n = ceil((rows.agg(F.sum(F.octet_length("text"))).first()[0] or 1) / BUCKET_BYTES)
    edges = sorted({int(q) for q in rows.where("doc_id is not null").approxQuantile("doc_id", [i / n for i in range(1, n)], 0.2 / n)}) if n > 1 else []
    rows = rows.withColumn("bucket", _bucket(edges))
    heads = sorted((r.bucket, r.k) for r in rows.groupBy("bucket").agg(F.min("k").alias("k")).collect())
    # the first bucket's head closes the last one; two numbers a bucket go to every task
    before = spark.createDataFrame([(k, heads[i - 1][0]) for i, (_, k) in enumerate(heads)], "k long, back int")
    rows = rows.join(F.broadcast(before), "k", "left")
    back = F.col("back")
    own = F.struct(F.col("bucket"), F.lit(False).alias("copy"))
    both = F.when(back.isNull(), F.array(own)).otherwise(F.array(own, F.struct(back.alias("bucket"), F.lit(True).alias("copy"))))
    dealt = rows.withColumn("at", F.explode(both)).select("at.bucket", "at.copy", "k", "doc_id", "text")
    ordered = dealt.repartitionById(n, "bucket").sortWithinPartitions("bucket", "copy", "k", F.coalesce("text", F.lit("")))
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return ordered.select("bucket", "copy", "doc_id", "text").mapInArrow(_walk, schema)
