"""Mixing to target weights with soft domain membership, in DataFrame functions only.

A naive Bayes over hashed terms, fitted on a labelled table, gives each document
a posterior over domains. Projected gradient then solves the least squares
problem

    min over r >= 0 of sum_d (sum_i r_i n_i p_id - target_d)^2 / mass_d

for the rate r_i of every document. A document's rate depends on the
steps only through one shift per domain and step, so rates are never stored: a
step is one aggregation over the posteriors that returns the domain totals and
how they answer to a shift (as many numbers as there are domains, and their
square). The gradient is scaled by the inverse of that answer, which meets
targets in a few steps; where this does not lower the squares, the plain
gradient takes the step.
"""

from __future__ import annotations

import json
from math import log

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pelagia.llm.scratch import release, save, short_plans

#: Slots of the hashed terms; the model is this many numbers a domain.
SLOTS = 4096
#: Bound of the labelled rows that the classifier is fitted on.
TRAIN_ROWS = 20_000
#: Characters that end a term besides blanks and line ends.
MARKS = ".,;:!?()[]{}<>\"'`/\\|*+=_#-"
STEPS = 300
TOLERANCE = 1e-6


def _slots(text: Column) -> Column:
    """The slots of a text's distinct terms: lower-cased runs between blanks and marks."""
    gaps = MARKS + "\t\n\x0b\x0c\r"
    terms = F.array_distinct(F.split(F.translate(F.lower(text), gaps, " " * len(gaps)), " "))
    return F.transform(F.array_remove(terms, ""), lambda t: F.pmod(F.hash(t), F.lit(SLOTS)))


def _fit(docs: DataFrame, labelled: DataFrame, domains: list[str]) -> tuple[list[float], list[list[float]]]:
    """Log priors and log slot weights by domain, smoothed by one; at most domains x SLOTS numbers."""
    known = labelled.where(F.col("domain").isin(domains)).select("doc_id", "domain").distinct().orderBy(F.xxhash64("doc_id", "domain"), "doc_id", "domain").limit(TRAIN_ROWS)
    rows = docs.join(F.broadcast(known), "doc_id").where("text is not null")
    n = dict(rows.groupBy("domain").count().collect())
    seen = {(r.domain, r.slot): r.n for r in rows.select("domain", F.explode(_slots(F.col("text"))).alias("slot")).groupBy("domain", "slot").agg(F.count("*").alias("n")).collect()}
    prior, weight = [], []
    for d in domains:
        own = [seen.get((d, s), 0) + 1 for s in range(SLOTS)]
        prior.append(log((n.get(d, 0) + 1) / (sum(n.values()) + len(domains))))
        weight.append([log(c / sum(own)) for c in own])
    return prior, weight


def posteriors(docs: DataFrame, labelled: DataFrame, domains: list[str], *, keep: bool = False) -> DataFrame:
    """doc_id, tokens and p_<k> for the k-th domain, for every row of docs (doc_id, text); ``keep``: with the row as ``doc``.

    The evidence of n distinct terms counts as that of sqrt(n) independent ones,
    as terms of one text are not independent. A text without terms gets the
    prior. ``labelled`` is (doc_id, domain); labels of other domains and of
    unknown rows are ignored.
    """
    short_plans(docs.sparkSession)
    release(docs.sparkSession)
    docs = docs.select("doc_id", "text", *([F.struct(*docs.columns).alias("doc")] if keep else []))
    own = ["doc_id", "tokens", *(["doc"] if keep else [])]
    prior, weight = _fit(docs, labelled, domains)
    release(docs.sparkSession)
    tokens = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    # one column first, else every sum would split the text again
    rows = docs.withColumns({"tokens": tokens, "_s": _slots(F.coalesce("text", F.lit("")))}).select(*own, "_s", F.sqrt(F.greatest(F.size("_s"), F.lit(1))).alias("_n"))
    rows = save(rows.select(*own, *(_log(k, prior[k], weight[k]) for k in range(len(domains)))))
    names = [f"_l{k}" for k in range(len(domains))]
    rows = rows.withColumn("_top", F.greatest(*names) if len(names) > 1 else F.col(names[0]))
    rows = rows.withColumns({n: F.exp(F.col(n) - F.col("_top")) for n in names})
    total = sum((F.col(n) for n in names), F.lit(0.0))
    return rows.select(*own, *((F.col(n) / total).alias(f"p_{k}") for k, n in enumerate(names)))


def _log(k: int, prior: float, weight: list[float]) -> Column:
    # the prior follows the slots: as data, so that every fit has the same compiled code
    table = F.from_json(F.lit(json.dumps([*weight, prior])), "array<double>")
    return (F.get(table, F.lit(SLOTS)) + F.aggregate("_s", F.lit(0.0), lambda a, s: a + F.get(table, s)) / F.col("_n")).alias(f"_l{k}")


def _folded(live: list[int], shifts: list[list[float]]) -> Column:
    """A row's rate after ``shifts``: each moves it by the posteriors' share, and never below zero.

    The numbers are one JSON text, so all steps have the same compiled code.
    """
    own = F.array(*(F.col(f"p_{k}") for k in live))
    dot = lambda s: F.aggregate(F.zip_with(own, s, lambda p, x: p * x), F.lit(0.0), lambda a, x: a + x)
    return F.aggregate(F.from_json(F.lit(json.dumps(shifts)), "array<array<double>>"), F.lit(1.0), lambda r, s: F.greatest(F.lit(0.0), r + dot(s)))


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], *, keep: bool = False) -> DataFrame:
    """doc_id, tokens, p_<k>, rate, copies for every row of docs; ``keep``: after all columns of docs.

    Targets are shares of the smallest total at which no domain has to shrink,
    so rates say how often a document is read and no document is dropped by
    them. ``copies`` rounds the rate up or down by a hash of doc_id, to the same
    expected tokens. The steps end when all expected totals are met to
    ``TOLERANCE``, or, where they can't be, when a step lowers the sum of squares
    by less than that share of what it was at first; without either after
    ``STEPS`` the job fails. Defined cases: null and empty texts have no tokens and rate 1; an
    empty table or one without tokens gives rates of 1; a domain without mass
    keeps none; repeated rows are rated each; extra columns are ignored, and
    with ``keep`` those named like a column of the result give way to it.
    """
    domains = list(targets)
    total_weight = sum(targets.values())
    base = save(posteriors(docs, labelled, domains, keep=keep))
    release(docs.sparkSession)
    n_p = [(F.col("tokens") * F.col(f"p_{k}")) for k in range(len(domains))]
    mass = [float(x or 0.0) for x in base.agg(*(F.sum(x).alias(f"m{k}") for k, x in enumerate(n_p))).first()]
    live = [k for k, m in enumerate(mass) if m > 0 and targets[domains[k]] > 0]
    budget = max((mass[k] * total_weight / targets[domains[k]] for k in live), default=0.0)
    goal = np.array([budget * targets[domains[k]] / total_weight for k in live])
    weight = 1 / np.array([mass[k] for k in live])
    shifts: list[list[float]] = []
    squares, plain, steps = [], False, STEPS if live else -1
    pairs = [(i, j) for i in range(len(live)) for j in range(i, len(live))]
    for step in range(steps + 1):
        # how totals answer to a shift: only rows above zero move with it
        moved = [F.sum(F.when(F.col("rate") > 0, n_p[live[i]] * F.col(f"p_{live[j]}")).otherwise(0.0)) for i, j in pairs]
        got = base.withColumn("rate", _folded(live, shifts)).agg(*(F.sum(n_p[k] * F.col("rate")) for k in live), *moved).first()
        have, answer = np.array(got[: len(live)], float), np.zeros((len(live), len(live)))
        for (i, j), v in zip(pairs, got[len(live) :], strict=True):
            answer[i, j] = answer[j, i] = v
        now = float(((goal - have) ** 2 * weight).sum())
        if squares and now > squares[-1] and not plain:
            shifts.pop()  # the scaled step went astray: take the plain one from where it began
            plain, miss = True, last
        else:
            gained = squares[-1] - now if squares else None
            squares.append(now)
            if np.abs(goal - have).max() <= TOLERANCE * budget or (gained is not None and gained <= TOLERANCE * squares[0] and plain):
                break
            # a small gain of a scaled step is no end yet
            plain, miss = gained is not None and gained <= TOLERANCE * squares[0], goal - have
        if step == steps:
            raise RuntimeError(f"rates do not settle in {STEPS} steps: {have} for {goal}")
        last = miss
        shifts.append((miss * weight if plain else np.linalg.lstsq(answer, miss, rcond=1e-12)[0]).tolist())
    release(docs.sparkSession)  # a plan a step
    part = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 20)) / float(1 << 20)
    rated = base.withColumn("rate", F.when(F.col("tokens") > 0, _folded(live, shifts)).otherwise(1.0) if live else F.lit(1.0))
    rated = rated.withColumn("copies", (F.floor("rate") + (part < F.col("rate") - F.floor("rate")).cast("long")).cast("long"))
    made = ["tokens", *(f"p_{k}" for k in range(len(domains))), "rate", "copies"]
    if not keep:
        return rated.select("doc_id", *made)
    return rated.select(*(F.col("doc")[c].alias(c) for c in docs.columns if c not in made), *made)
