"""Interaction audit of five text filters by Walsh-Hadamard sums.

Every document has a failure mask, a bit a filter. Of each part and label class
32 signed parity sums are aggregated, ``S[w] = sum((-1)^popcount(mask & w))``;
the transform is its own inverse up to a factor of 32, so the number of
documents with each mask comes back exactly. All orders, their losses and the
Shapley counts are functions of these 32 cells alone, so no order reads a
document: a document that fails k filters is removed by each of them in 120 / k
of the 120 orders.
"""

from __future__ import annotations

import json
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pelagia.llm.scratch import save

FILTERS = "ABCDE"
CELLS = 1 << len(FILTERS)
LEAST_WORDS, LEAST_DISTINCT, MOST_UPPER = 200, 50, 2
#: Blanks between words, what are no capitals, and the signs that a text may not hold.
_BLANKS, _NO_CAPITALS, _SIGNS = r"[\x20\x09-\x0D]+", "[^A-Z]+", r"[#$%&*|]"
_COUNTS = ("n", "good", "toxic")


def failures(text: Column) -> Column:
    """Mask of the filters A to D (bits 0 to 3) that a text fails; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(text, _BLANKS), lambda w: w != "")
    few = lambda w: F.when(F.size(w) < LEAST_WORDS, 1).otherwise(0)
    repeated = lambda w: F.when(100 * F.size(F.array_distinct(w)) < LEAST_DISTINCT * F.size(w), 2).otherwise(0)
    by_words = F.transform(F.array(words), lambda w: few(w) + repeated(w))[0]  # bound, so that a text is split once
    capitals = 100 * F.length(F.regexp_replace(text, _NO_CAPITALS, "")) > MOST_UPPER * F.length(text)
    return by_words + F.when(capitals, 4).otherwise(0) + F.when(text.rlike(_SIGNS), 8).otherwise(0)


def failure_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents of one text in a part with one failure mask, and the labelled ones among them.

    Texts are told apart by SHA-256 digests, so no text is shuffled. All rows of
    one text share filters A to D; all but those of its smallest id fail E.
    """
    flag = lambda c: F.max(F.when(F.col(c) == 1, 1).otherwise(0).cast("long"))
    known = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(flag("quality").alias("good"), flag("toxic").alias("toxic"))
    digest = F.unhex(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("source", F.lit("")).alias("part"), digest.alias("digest"), failures(F.col("text")).alias("mask"))
    rows = rows.join(known, "doc_id", "left").select("doc_id", "part", "digest", "mask", F.lit(1).cast("long").alias("n"), *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in _COUNTS[1:]))
    # repeated ids are summed first, so that min_by finds all rows of the smallest id
    by_id = rows.groupBy("doc_id", "digest", "part", "mask").agg(*(F.sum(c).alias(c) for c in _COUNTS))
    named = F.when(F.col("doc_id").isNotNull(), F.struct(*_COUNTS))
    by_part = save(  # read twice below, the texts once
        by_id.groupBy("digest", "part", "mask").agg(
            *(F.sum(c).alias(c) for c in _COUNTS), *(F.coalesce(F.sum(named[c]), F.lit(0)).alias(f"named_{c}") for c in _COUNTS),
            F.min_by(F.struct(*_COUNTS), "doc_id").alias("head"), F.min("doc_id").alias("least"),
        )
    )
    found = by_part.join(by_part.groupBy("digest").agg(F.min("least").alias("first")), "digest")
    head = lambda c: F.when(F.col("least") == F.col("first"), F.col("head")[c]).otherwise(0)
    copies = lambda c: F.col(f"named_{c}") - head(c)  # noqa: E731  rows without an id are copies of nothing
    cases = F.array(F.struct(F.col("mask").alias("mask"), *((F.col(c) - copies(c)).alias(c) for c in _COUNTS)), F.struct((F.col("mask") + 16).alias("mask"), *(copies(c).alias(c) for c in _COUNTS)))
    return found.select("part", F.explode(cases).alias("c")).select("part", "c.*").where("n > 0")


def _odd(mask: Column, w: Column | int) -> Column:
    return F.bit_count(mask.bitwiseAND(w)) % 2 == 1


def parity_sums(counts: DataFrame) -> DataFrame:
    """(part, label, sums): the 32 signed sums of all documents of a part (label n) and of the labelled ones (good, toxic)."""
    each = F.explode(F.array(*(F.struct(F.lit(c).alias("label"), F.col(c).alias("weight")) for c in _COUNTS)))
    rows = counts.select("part", "mask", each.alias("l")).select("part", "mask", "l.*")
    sums = [F.sum(F.when(_odd(F.col("mask"), F.lit(w)), -F.col("weight")).otherwise(F.col("weight"))) for w in range(CELLS)]
    return rows.groupBy("part", "label").agg(F.array(*sums).alias("sums"))


def mask_cells(sums: DataFrame) -> DataFrame:
    """(part, n, good, toxic): arrays of the documents of each of the 32 masks, by the inverse transform."""
    every = F.sequence(F.lit(0), F.lit(CELLS - 1))
    signed = lambda m: F.aggregate(every, F.lit(0).cast("long"), lambda a, w: a + F.when(_odd(m, w), -F.get("sums", w)).otherwise(F.get("sums", w)))
    back = sums.select("part", "label", F.transform(every, lambda m: F.shiftright(signed(m), len(FILTERS))).alias("cells"))
    return back.groupBy("part").agg(*(F.first(F.when(F.col("label") == c, F.col("cells")), ignorenulls=True).alias(c) for c in _COUNTS))


def _steps() -> Column:
    """The steps of all orders: order, step, the filter's bit and the mask of those before it."""
    rows = []
    for order in permutations(range(len(FILTERS))):
        for k, f in enumerate(order):
            rows.append({"filter_order": "".join(FILTERS[g] for g in order), "step": k + 1, "bit": 1 << f, "before": sum(1 << g for g in order[:k])})
    return F.from_json(F.lit(json.dumps(rows)), "array<struct<filter_order:string,step:int,bit:int,before:int>>")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """What each filter removes in every order, part by part.

    docs (doc_id, text, source), labels (doc_id, quality, toxic). Defined cases:
    null and empty sources are one part; null text is empty; rows of one doc_id
    are no copies of each other; rows with a null id fail E never and cause it
    never, and have no label; of a doc_id's repeated labels any 1 counts; an
    empty table has no part; extra columns are ignored.
    """
    cells = mask_cells(parity_sums(failure_counts(docs, labels)))
    rows = cells.select("part", *_COUNTS, F.explode(_steps()).alias("s")).select("part", *_COUNTS, "s.*")
    masks = F.sequence(F.lit(0), F.lit(CELLS - 1))

    def total(column: str, when: object, weight: object = None) -> Column:
        value = lambda m: F.get(column, m) if weight is None else F.get(column, m) * weight(m)
        return F.aggregate(masks, F.lit(0).cast("long"), lambda a, m: a + F.when(when(m), value(m)).otherwise(F.lit(0).cast("long")))

    fails = lambda m: m.bitwiseAND(F.col("bit")) != 0
    gone = lambda m: m.bitwiseAND(F.col("before")) != 0
    share = lambda m: F.lit(factorial(len(FILTERS))).cast("long") / F.bit_count(m)
    return rows.select(
        "part", "filter_order", "step", total("n", lambda m: ~fails(m) & ~gone(m)).alias("kept"), total("n", lambda m: fails(m) & ~gone(m)).alias("removed"),
        total("n", lambda m: fails(m) & gone(m)).alias("redundant"), F.get("n", F.col("bit")).alias("unique_fails"),
        total("good", lambda m: fails(m) & ~gone(m)).alias("good_lost"), total("toxic", lambda m: fails(m) & ~gone(m)).alias("toxic_lost"),
        total("n", fails, lambda m: share(m).cast("long")).alias("shapley"),
    )


#: The same from the definition: every order is applied to the masks, and Shapley counts are summed over the orders.
OP12_SQL = r"""
WITH RECURSIVE texts AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
worded AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY t) AS first_id FROM texts),
marks AS (SELECT doc_id, part, (CASE WHEN len(w) < 200 THEN 1 ELSE 0 END) + (CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END)
 + (CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 2 * length(t) THEN 4 ELSE 0 END) + (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END)
 + (CASE WHEN doc_id > first_id THEN 16 ELSE 0 END) AS mask FROM worded),
known AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
cell AS (SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic FROM marks LEFT JOIN known USING (doc_id) GROUP BY part, mask),
filters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS bit),
walk AS (SELECT '' AS o, 0 AS before, 0 AS step, 0 AS bit, 0 AS used UNION ALL
 SELECT o || f, used, step + 1, f.bit, used + f.bit FROM walk, filters f WHERE used & f.bit = 0),
orders AS (SELECT o AS filter_order FROM walk WHERE step = 5),
steps AS (SELECT filter_order, step, bit, before FROM orders JOIN walk ON step > 0 AND starts_with(filter_order, o)),
here AS (SELECT part, filter_order, step, bit,
 sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept, sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS removed,
 sum(CASE WHEN mask & before <> 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS redundant, sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
 sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN toxic ELSE 0 END) AS toxic_lost
 FROM cell, steps GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
 CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley FROM here
"""
