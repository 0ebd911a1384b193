"""Benchmark decontamination by spaced seeds.

Each mask looks at 7 of up to 11 consecutive terms and ignores the rest. Under
some mask and shift a passage of 11 terms or more still hashes alike when the
verifier accepts its substituted words; shorter items have masks of their own. Hashes of all
documents that pass a filter of fixed size are joined with those of the benchmark;
around every hit the two are laid side by side and a stretch of ``WORDS`` terms (or the whole item, if shorter) with at
least ``SHARE`` of them equal confirms the overlap.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pelagia.llm.scratch import release, save
from pelagia.llm.words import WordTable, mix, small_batches, stream, word_table

WORDS, SHARE, LEAST = 13, 0.8, 5
#: 1 marks a term that counts.
MASKS = ("11110111", "110011111", "1111010011", "1101110101", "1101001111", "101111011")
SPAN = 11
#: Items under so many terms must occur unchanged.
TOLERANT = 7
#: Terms on either side of a seed that a confirmed stretch which holds it can reach.
AROUND = WORDS + SPAN
#: Bound of the filter before the join, as a power of two: 16 MB.
MOST_BITS = 27


def _table(texts: pa.Array) -> WordTable:
    return word_table(pc.utf8_lower(texts.fill_null("")), terms=True)


def need(size: int) -> int:
    """Equal terms that confirm an overlap of ``size`` terms."""
    return size if size < TOLERANT else ceil(round(SHARE * size, 9))


def masks(size: int) -> tuple[str, ...]:
    """Masks that find every overlap the verifier accepts with items of ``size`` terms."""
    if size >= SPAN:
        return MASKS
    # each substituted term spoils one block; one mask for each choice of spoiled blocks
    spare = size - need(size)
    blocks = [len(b) for b in np.array_split(np.arange(size), 2 * spare + 1)]
    return tuple("".join("01"[k not in gone] * n for k, n in enumerate(blocks)) for gone in combinations(range(len(blocks)), spare))


def _seeds(h: np.ndarray, mask: str) -> np.ndarray:
    on = [i for i, c in enumerate(mask) if c == "1"]
    n = max(len(h) - len(mask) + 1, 0)
    mult = stream(len(mask), 50 + int(mask, 2))
    out = np.zeros(n, np.uint64)
    for i in on:
        out += h[i : i + n] * mult[i]
    return mix(out)


def _inside(t: WordTable, mask: str) -> tuple[np.ndarray, np.ndarray]:
    """Seeds of a mask over all texts of a table and the first term of each; none crosses texts."""
    seeds, text = _seeds(t.hash, mask), np.repeat(np.arange(len(t.first) - 1), np.diff(t.first))
    at = np.flatnonzero(text[: len(seeds)] == text[len(mask) - 1 :]) if len(seeds) else np.zeros(0, np.int64)
    return seeds[at], at


def _item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each item's seeds under the masks of its own length."""
    for b in batches:
        t = _table(b.column("text"))
        for item, a, z in zip(b.column("item_id").to_pylist(), t.first[:-1], t.first[1:], strict=True):
            for mask in masks(z - a) if z - a >= LEAST else ():
                seed = _seeds(t.hash[a:z], mask).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([item] * len(seed), pa.int64()), pa.array(seed), pa.array(np.arange(len(seed), dtype=np.int32)), pa.array([mask] * len(seed))], ["item_id", "seed", "place", "mask"])


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        t = _table(b.column("text"))
        yield pa.RecordBatch.from_arrays([b.column("item_id"), pa.array([t.hash[a:z].tobytes() for a, z in zip(t.first[:-1], t.first[1:], strict=True)], pa.binary())], ["item", "terms"])


def _spots(seed: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two bits of a filter of 2 ** bits for each seed."""
    return (seed >> np.uint64(64 - bits)).astype(np.int64), (seed & np.uint64((1 << bits) - 1)).astype(np.int64)


def _bitmaps(bits: int) -> Callable:
    """One bitmap of 2 ** (bits - 8) bits for each of 256 ranges of spots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps: dict[int, np.ndarray] = {}
        for b in batches:
            spot = b.column("s").to_numpy()
            for k in np.unique(spot >> (bits - 8)):
                own = maps.setdefault(int(k), np.zeros(1 << (bits - 8), bool))
                own[spot[spot >> (bits - 8) == k] & ((1 << (bits - 8)) - 1)] = True
        yield pa.RecordBatch.from_arrays([pa.array(list(maps), pa.int64()), pa.array([np.packbits(m, bitorder="little").tobytes() for m in maps.values()], pa.binary())], ["k", "map"])

    return run


def _filter(seeds: DataFrame) -> tuple[int, np.ndarray]:
    """(bits, a bit for each of two spots of every seed): at most 2 ** MOST_BITS bits, whatever the benchmark."""
    bits = min(MOST_BITS, max(16, (64 * seeds.count()).bit_length()))
    spots = F.array(F.shiftrightunsigned("seed", 64 - bits), F.col("seed").bitwiseAND((1 << bits) - 1))
    rows = seeds.select(F.explode(spots).alias("s")).distinct().withColumn("k", F.shiftright("s", bits - 8).cast("int"))
    out = np.zeros(1 << (bits - 3), np.uint8)
    # 256 rows of 2 ** bits / 8 bytes in all
    for r in rows.repartitionById(8, "k").select("s").mapInArrow(_bitmaps(bits), "k long, map binary").collect():
        out[r.k << (bits - 11) : (r.k + 1) << (bits - 11)] = np.frombuffer(r.map, np.uint8)
    return bits, out


def _set(table: np.ndarray, spot: np.ndarray) -> np.ndarray:
    return (table[spot >> 3] >> (spot & 7).astype(np.uint8)) & 1 > 0


def _hits(sent) -> Callable:
    """Places of the documents whose seed may be the benchmark's, with the terms around them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, table, used = sent.value
        for b in batches:
            t = _table(b.column("text"))
            found = []
            for seed, at in (_inside(t, mask) for mask in used):
                one, two = _spots(seed, bits)
                some = np.flatnonzero(_set(table, one))
                some = some[_set(table, two[some])]
                found.append((seed[some], at[some]))
            seed, at = (np.concatenate(c) for c in zip(*found, strict=True)) if found else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            if not len(seed):
                continue
            own = np.searchsorted(t.first, at, side="right") - 1
            low, high = np.maximum(at - AROUND, t.first[own]), np.minimum(at + AROUND, t.first[own + 1])
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("doc_id").take(pa.array(own)), b.column("text_hash").take(pa.array(own)), pa.array(seed.view(np.int64)), pa.array(at - t.first[own]),
                    pa.array(low - t.first[own]), pa.array([t.hash[x:y].tobytes() for x, y in zip(low, high, strict=True)], pa.binary()),
                ],
                ["doc_id", "text_hash", "seed", "p", "low", "around"],
            )

    return run


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The confirmed stretch around each hit, if there is one."""
    for b in batches:
        start, stop = [], []
        for p, q, low, around, terms in zip(*(b.column(c).to_pylist() for c in ("p", "place", "low", "around", "terms")), strict=True):
            got = overlap(np.frombuffer(around, np.uint64), np.frombuffer(terms, np.uint64), p - low - q)
            start.append(got and got[0] + low)
            stop.append(got and got[1] + low)
        out = pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text_hash"), b.column("item_id"), pa.array(start, pa.int64()), pa.array(stop, pa.int64()), b.column("shift")], ["doc_id", "text_hash", "item_id", "start", "stop", "shift"])
        yield out.filter(pc.is_valid(out.column("start")))


def overlap(own: np.ndarray, item: np.ndarray, shift: int) -> tuple[int, int] | None:
    """First and last place (exclusive) in own of the confirmed stretches when
    item starts at ``shift``, else None."""
    a, z = max(shift, 0), min(shift + len(item), len(own))
    size = min(WORDS, len(item))
    if z - a < size:
        return None
    same = (own[a:z] == item[a - shift : z - shift]).astype(np.int64)
    total = np.concatenate(([0], np.cumsum(same)))
    good = np.flatnonzero(total[size:] - total[:-size] >= need(size))
    return (int(a + good[0]), int(a + good[-1] + size)) if len(good) else None


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(k, t, item_id, start, stop): the longest confirmed overlap of every document that has one, by doc_id and hash of its text."""
    small_batches(docs.sparkSession)
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id is not null and text is not null").distinct()
    seeds = save(items.mapInArrow(_item_seeds, "item_id long, seed long, place int, mask string"))
    release(docs.sparkSession)
    used = sorted(r.mask for r in seeds.select("mask").distinct().collect())  # at most all of the masks above
    sent = docs.sparkSession.sparkContext.broadcast((*_filter(seeds), used))
    release(docs.sparkSession)
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    hits = keyed.mapInArrow(_hits(sent), "doc_id long, text_hash long, seed long, p long, low long, around binary")
    met = hits.join(seeds.drop("mask"), "seed").withColumn("shift", F.col("p") - F.col("place"))
    met = met.join(items.mapInArrow(_item_terms, "item long, terms binary"), F.col("item_id") == F.col("item"))
    good = met.select("doc_id", "text_hash", "item_id", "p", "place", "low", "around", "terms", "shift").mapInArrow(_confirm, "doc_id long, text_hash long, item_id long, start long, stop long, shift long")
    whole = good.groupBy("doc_id", "text_hash", "item_id", "shift").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    best = F.min_by(F.struct("item_id", "start", "stop"), F.struct(F.col("start") - F.col("stop"), "item_id", "start"))
    return whole.groupBy(F.col("doc_id").alias("k"), F.col("text_hash").alias("t")).agg(best.alias("r")).select("k", "t", "r.*")


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, contaminated, item_id, first_term, last_term of every row of docs.

    item_id is the item of the longest confirmed overlap (then the smallest id).
    Defined cases: null and empty texts are clean; items under ``LEAST`` terms
    are too common to search and match nothing; items under ``TOLERANT`` terms
    must occur whole and unchanged, those up to ``WORDS`` whole; repeated rows
    and null ids are kept, each judged by its text; rows of one item_id are
    searched each; other columns are ignored; an empty benchmark leaves all
    clean.
    """
    found = overlaps(docs, benchmark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"))
    rows = rows.join(found, F.col("doc_id").eqNullSafe(F.col("k")) & (F.col("text_hash") == F.col("t")), "left")
    return rows.select("doc_id", F.col("item_id").isNotNull().alias("contaminated"), "item_id", F.col("start").alias("first_term"), (F.col("stop") - 1).alias("last_term"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs, all columns, without a confirmed overlap."""
    found = overlaps(docs, benchmark)
    return docs.join(found, docs["doc_id"].eqNullSafe(found["k"]) & (F.xxhash64(docs["text"]) == found["t"]), "left_anti")
