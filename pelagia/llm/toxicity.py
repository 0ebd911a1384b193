"""Toxicity by a factorization machine over hashed terms.

A text is the set of its lower-cased terms (runs of letters, digits and
non-ASCII characters) and of the stems of longer terms, told apart by how many
distinct terms of the text share them, each hashed to one of ``DIMS`` slots; no
term is left out. The machine's value is

    w0 + sum w_i + sum over pairs <v_i, v_j>

over the slots of the text, so a pair such as an insult next to a group mention
has a weight of its own. Fitting sees at most ``TRAIN_ROWS`` labelled rows
(those of smallest hash of doc_id; equal texts count once); an L1 penalty on
weights and factors keeps slots that say nothing at zero. The score is the
share of toxic rows at that value, isotonic, learnt from values that machines of
the other folds give to each fold of the same rows; a toxic row weighs
``TOXIC_WEIGHT`` clean ones there as in fitting, so 0.7 is reached where over
0.37 of the rows are toxic. Scoring reads every whole text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pelagia.llm.scratch import release
from pelagia.llm.words import byte_hashes, mix, small_batches, word_table

#: Bound of the labelled rows that fitting reads.
TRAIN_ROWS = 12_000
DIMS = 1 << 18
#: Bytes of the stems.
STEMS = (5, 8)
#: A stem's slots tell up to so many distinct terms of one text that share it.
KINSHIP = 4
FACTORS = 4
THRESHOLD = 0.7
EPOCHS, BATCH, RATE, L1 = 10, 256, 0.1, 5e-3
#: Least number of steps; few rows are read more often than EPOCHS times.
STEPS = 400
#: The penalty is at least this over the root of the rows, or what few texts share by chance would count.
SMALL = 0.35
FOLDS = 3
#: Weight of a toxic row against a clean one, as they are few.
TOXIC_WEIGHT = 4.0


def held_out() -> Column:
    """Rows never used for fitting; a null doc_id is not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def slots(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text, slot) pairs, each once, ascending."""
    t = word_table(pc.utf8_lower(texts.fill_null("")), terms=True)
    text = np.repeat(np.arange(len(texts)), np.diff(t.first))
    owner, slot = [text], [t.hash]
    for size in STEMS:
        long = np.flatnonzero(t.end - t.start > size)
        if not len(long):
            continue
        stem = byte_hashes(t.buf, t.start[long], np.full(len(long), size)) + np.uint64(size)
        # each distinct term counts once for its stem
        term = np.unique(np.rec.fromarrays((text[long], stem, t.hash[long])))
        new = np.append(True, (term.f0[1:] != term.f0[:-1]) | (term.f1[1:] != term.f1[:-1]))
        nth = np.arange(len(term)) - np.maximum.accumulate(np.where(new, np.arange(len(term)), 0))
        some = np.flatnonzero(nth < KINSHIP)
        owner.append(term.f0[some])
        slot.append(term.f1[some] + mix(nth[some].astype(np.uint64) + np.uint64(1)))
    slot = mix(np.concatenate(slot)) % np.uint64(DIMS)
    pair = np.unique(np.concatenate(owner) * DIMS + slot.astype(np.int64))
    return pair // DIMS, pair % DIMS


def _slot_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        text, slot = slots(b.column("text"))
        edge = np.searchsorted(text, np.arange(len(b) + 1))
        own = [slot[a:z].astype("<i4").tobytes() for a, z in zip(edge[:-1], edge[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([b.column("toxic"), pa.array(own, pa.binary())], ["toxic", "slots"])


@dataclass
class Machine:
    w0: float
    w: np.ndarray
    v: np.ndarray
    #: Values and shares of toxic rows there, both ascending; none: the sigmoid.
    knots: tuple[np.ndarray, np.ndarray] | None = None

    def logits(self, text: np.ndarray, slot: np.ndarray, n: int) -> np.ndarray:
        """w0 + sum w_i + sum over pairs <v_i, v_j> of each of n texts, given its (text, slot) pairs."""
        z = self.w0 + np.bincount(text, self.w[slot], n)
        for v in self.v:
            z += 0.5 * (np.bincount(text, v[slot], n) ** 2 - np.bincount(text, v[slot] ** 2, n))
        return z

    def scores(self, text: np.ndarray, slot: np.ndarray, n: int) -> np.ndarray:
        """Of each of n texts, rising with the value; the sigmoid tells apart what lies on one step of the knots."""
        z = self.logits(text, slot, n)
        rough = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        return rough if self.knots is None else 0.999 * np.interp(z, *self.knots) + 0.001 * rough


def _shrunk(x: np.ndarray, step: np.ndarray) -> np.ndarray:
    return np.sign(x) * np.maximum(np.abs(x) - step, 0)


def _small(x: np.ndarray) -> np.ndarray:
    return x.astype(np.min_scalar_type(int(x.max(initial=0))))


def train(sets: list[np.ndarray], toxic: np.ndarray) -> Machine:
    """Proximal Adagrad on the weighted logistic loss with an L1 penalty, in batches of a fixed order."""
    rng, n, bad = np.random.default_rng(7), len(sets), float(toxic.sum())
    m = Machine(float(np.log((bad + 1) / (n - bad + 1))), np.zeros(DIMS), rng.normal(0, 0.01, (FACTORS, DIMS)))
    if not 0 < bad < n:
        return Machine(m.w0, m.w, np.zeros((FACTORS, DIMS)))
    parts, active = [], np.zeros(DIMS)
    for rows in np.array_split(rng.permutation(n), max(1, n // BATCH)):
        known, at = np.unique(np.concatenate([sets[i] for i in rows]), return_inverse=True)
        parts.append((rows, _small(np.repeat(np.arange(len(rows)), [len(sets[i]) for i in rows])), known, _small(at)))
        active[known] += 1
    # a slot of few batches is shrunk as much over all of them as any other
    penalty = max(L1, SMALL / np.sqrt(n)) * len(parts) / np.maximum(active, 1)
    sum0, sum_w, sum_v = 1e-8, np.full(DIMS, 1e-8), np.full((FACTORS, DIMS), 1e-8)
    for _ in range(max(EPOCHS, STEPS // len(parts))):
        for k in rng.permutation(len(parts)):
            rows, text, known, at = parts[k]
            w, v, size = m.w[known], m.v[:, known], len(rows)
            own = Machine(m.w0, w, v)
            y = toxic[rows]
            e = (own.scores(text, at, size) - y) * np.where(y > 0, TOXIC_WEIGHT, 1.0) / size
            g = np.bincount(at, e[text], len(known))
            sum_w[known] += g**2
            step = RATE / np.sqrt(sum_w[known])
            m.w[known] = _shrunk(w - step * g, step * penalty[known])
            for f in range(FACTORS):
                gv = np.bincount(at, (e * np.bincount(text, v[f][at], size))[text], len(known)) - g * v[f]
                sum_v[f, known] += gv**2
                step = RATE / np.sqrt(sum_v[f, known])
                m.v[f, known] = _shrunk(v[f] - step * gv, 0.3 * step * penalty[known])
            sum0 += e.sum() ** 2
            m.w0 -= float(RATE * e.sum() / np.sqrt(sum0))
    return m


def isotonic(z: np.ndarray, toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean values and weighted toxic shares of the steps of the rising fit of toxic (0 or 1) over z."""
    steps: list[list[float]] = []  # toxic weight, weight, sum of values, rows
    for i in np.lexsort((toxic, z)):
        weight = TOXIC_WEIGHT if toxic[i] else 1.0
        steps.append([weight * toxic[i], weight, z[i], 1])
        while len(steps) > 1 and steps[-2][0] * steps[-1][1] >= steps[-1][0] * steps[-2][1]:
            last = steps.pop()
            steps[-1] = [x + y for x, y in zip(steps[-1], last, strict=True)]
    bad, weight, value, rows = np.array(steps).T
    return value / rows, bad / weight


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The machine of all rows or, of the rows outside a fold, its values of those inside."""
    sets, toxic, inside, model = [], [], [], FOLDS
    for b in batches:
        sets += [np.frombuffer(x, "<i4") for x in b.column("slots").to_pylist()]
        toxic += b.column("toxic").to_pylist()
        inside += b.column("inside").to_pylist()
        model = b.column("model")[0].as_py()
    toxic, inside = np.array(toxic, float), np.array(inside, bool)
    m = train([sets[i] for i in np.flatnonzero(~inside)], toxic[~inside])
    asked = [sets[i] for i in np.flatnonzero(inside)]
    z = m.logits(np.repeat(np.arange(len(asked)), [len(x) for x in asked]), np.concatenate(asked), len(asked)) if asked else np.zeros(0)
    sent = (z, toxic[inside]) if model < FOLDS else (m.w.astype(np.float32), m.v.astype(np.float32))
    yield pa.RecordBatch.from_arrays([pa.array([model], pa.int32()), pa.array([m.w0]), *(pa.array([x.tobytes()], pa.binary()) for x in sent)], ["model", "w0", "one", "two"])


def _machine(once: DataFrame) -> Machine:
    """Learnt and calibrated from at most TRAIN_ROWS rows (slots, toxic): a task a fold and one for all, whose machine alone passes the driver beside two numbers a row."""
    fold = F.pmod(F.xxhash64("slots"), F.lit(FOLDS)).cast("int")
    dealt = once.select("slots", "toxic", fold.alias("fold"), F.explode(F.array(*map(F.lit, range(FOLDS + 1)))).alias("model"))
    dealt = dealt.select("slots", "toxic", "model", (F.col("fold") == F.col("model")).alias("inside"))
    tasks = dealt.repartitionById(FOLDS + 1, "model").sortWithinPartitions("slots")
    made = tasks.mapInArrow(_learn, "model int, w0 double, one binary, two binary").collect()
    m = next((r for r in made if r.model == FOLDS), None)
    if m is None:
        return train([], np.zeros(0))
    z, toxic = (np.concatenate([np.zeros(0), *(np.frombuffer(r[c]) for r in made if r.model < FOLDS)]) for c in ("one", "two"))
    knots = isotonic(z, toxic) if 0 < toxic.sum() < len(toxic) else None
    return Machine(m.w0, np.frombuffer(m.one, np.float32), np.frombuffer(m.two, np.float32).reshape(FACTORS, DIMS), knots)


def fit(docs: DataFrame, labels: DataFrame) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A scorer of Arrow batches (doc_id, text), learnt from labels (doc_id, toxic)."""
    small_batches(docs.sparkSession)
    known = labels.where("doc_id is not null and toxic is not null").where(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # at most TRAIN_ROWS rows of two numbers: small enough to send to every task
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_ROWS)
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("text", F.col("toxic").cast("int"))
    once = rows.mapInArrow(_slot_sets, "toxic int, slots binary").groupBy("slots").agg(F.max("toxic").alias("toxic"))
    m = _machine(once)
    sent = docs.sparkSession.sparkContext.broadcast(m)
    release(docs.sparkSession)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = sent.value.scores(*slots(b.column("text")), len(b))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(got)], ["doc_id", "score"])

    return score


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs (doc_id, text).

    Defined cases: null and empty texts get the base score; a null doc_id is
    scored and not held out; repeated rows are scored each; with no labels or
    one class the score is the smoothed base rate; extra columns are ignored.
    """
    score = fit(docs, labels)
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(score, "doc_id long, score double")
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def reject_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs, all columns, that the machine does not predict toxic."""
    score = fit(docs, labels)
    schema = docs.schema

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = next(score(iter([b.select(["doc_id", "text"])])))
            yield b.filter(pc.less(got.column("score"), THRESHOLD))

    return docs.mapInArrow(keep, schema)
