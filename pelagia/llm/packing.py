"""Packing of whole documents into training windows with their lexical neighbours.

Documents are encoded once and sorted by range of four MinHash minima of their
token ids, so that alike ones lie near each other. A range is packed shard by
shard: a bounded run of documents gets an inverted BM25 index over token ids,
with document frequencies counted over all documents. A window starts with a
seed document; the index returns the unused documents nearest to it, best first,
and they fill the window. The last one is cut where the window ends, and its
rest seeds the next window, so only the last window of a range has padding.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from math import ceil
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pelagia.llm.encode import encoder
from pelagia.llm.scratch import save
from pelagia.llm.words import mix, small_batches

WINDOW = 2048
#: Id that ends every document.
END = 1
#: Tokens of one range of documents, and of one index; documents of one index.
RANGE_TOKENS, SHARD_TOKENS, SHARD_DOCS = 1 << 22, 1 << 18, 2048
#: Texts of one batch, besides its bytes.
BATCH_ROWS = 4096
#: Minima of a document's sorting key.
MINIMA = 4
#: BM25's saturation and length weight.
K1, B = 1.2, 0.75
_SALT = np.arange(1, MINIMA + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
_PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def distinct(ids: np.ndarray) -> np.ndarray:
    """The ids in order, each once; a stable sort of 16-bit numbers takes linear time."""
    own = np.sort(ids, kind="stable")
    return own[np.append(True, own[1:] != own[:-1])] if len(own) else own


def _encoded(tokenizer: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    made = encoder(tokenizer)
    for b in batches:
        ids, first = made.encode(b.column("text"))
        held, keys, size = [], [], []
        order = mix(np.arange(np.iinfo(made.kind).max + 1 if made.kind == np.uint16 else int(ids.max(initial=0)) + 1, dtype=np.uint64)[:, None] + _SALT) >> np.uint64(48)
        order = order.astype(np.uint16)
        for a, z in zip(first[:-1], first[1:], strict=True):
            own = ids[a:z]
            held.append(np.append(own, made.kind(END)).tobytes())
            size.append(z - a + 1)
            # the top 16 bits of the least hashes: many documents share one only if they share tokens
            keys.append(order[distinct(own)].min(0).astype(">u2").tobytes() if z > a else b"")
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(held, pa.binary()), pa.array(size, pa.int64()), pa.array(keys, pa.binary())], ["doc_id", "ids", "doc_tokens", "near"])


def encode_documents(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, ids, doc_tokens, near) of docs (doc_id, text): token ids with ``END``, two or four bytes each, and the sorting key; null text is empty."""
    small_batches(docs.sparkSession, BATCH_ROWS)  # the more words a batch repeats, the fewer lookups
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(partial(_encoded, tokenizer), "doc_id long, ids binary, doc_tokens long, near binary")


def _documents_of(kind: type, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many of a task's documents each id occurs."""
    n = np.zeros(0, np.int64)
    for b in batches:
        for raw in b.column("ids"):
            seen = distinct(np.frombuffer(raw.as_buffer(), kind))
            if int(seen[-1]) >= len(n):
                n = np.append(n, np.zeros(int(seen[-1]) + 1 - len(n), np.int64))
            n[seen] += 1
    at = np.flatnonzero(n)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(n[at], pa.int64())], ["id", "n"])


def inverse_frequency(encoded: DataFrame, kind: type, n_docs: int) -> np.ndarray:
    """BM25's weight of every token id over all documents, 0 for ids in half of them and more; as long as the vocabulary at most."""
    counts = encoded.select("ids").mapInArrow(partial(_documents_of, kind), "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(max((r.id for r in counts), default=0) + 1, np.float32)
    for r in counts:
        out[r.id] = max(0.0, np.log((n_docs - r.n + 0.5) / (r.n + 0.5)))
    return out


class Index:
    """Inverted BM25 index of a shard: the postings of each token id with the scores they add."""

    def __init__(self, texts: list[np.ndarray], weight: np.ndarray, mean: float):
        every = [np.sort(t[:-1], kind="stable") for t in texts]  # without END
        size = np.array([len(t) for t in texts])
        term, doc = np.concatenate(every).astype(np.int64), np.repeat(np.arange(len(texts)), size - 1)
        lead = np.flatnonzero(np.append(True, (term[1:] != term[:-1]) | (doc[1:] != doc[:-1]))[: len(term)])
        often, term, doc = np.diff(np.append(lead, len(term))), term[lead], doc[lead]
        kept = weight[term] > 0
        term, doc, often = term[kept], doc[kept], often[kept]
        score = weight[term] * often * (K1 + 1) / (often + K1 * (1 - B + B * size[doc] / mean))
        by = np.argsort(term, kind="stable")
        self.n, self.terms = len(texts), np.split(term, np.searchsorted(doc, np.arange(1, len(texts))))
        self.doc, self.score = doc[by], score[by]
        self.ends = np.searchsorted(term[by], np.arange(len(weight) + 1))

    def scores(self, terms: np.ndarray) -> np.ndarray:
        """BM25 of every document of the shard for the query ``terms``."""
        lead, size = self.ends[terms], self.ends[terms + 1] - self.ends[terms]
        end = np.cumsum(size)
        at = np.repeat(lead - end + size, size) + np.arange(int(end[-1]) if len(end) else 0)
        return np.bincount(self.doc[at], self.score[at], self.n)


class Packer:
    """Fills windows with one shard after the other; the open window stays open between them."""

    def __init__(self, first: int, weight: np.ndarray, mean: float, window: int):
        self.sequence, self.room, self.window = first, window, window
        self.weight, self.mean, self.query = weight, mean, None

    def _put(self, doc: tuple, start: int) -> tuple[tuple, int]:
        """The piece of ``doc`` from ``start`` that fits the window, and where its rest starts."""
        doc_id, ids = doc
        k = min(self.room, len(ids) - start)
        piece = (doc_id, start, k, crc32(ids[start : start + k].astype("<u4").tobytes()), len(ids), self.sequence, self.window - self.room)
        self.room -= k
        if not self.room:
            self.sequence, self.room, self.query = self.sequence + 1, self.window, None
        return piece, start + k

    def pack(self, docs: list[tuple]) -> Iterator[tuple]:
        """Every piece of ``docs`` (doc_id, ids)."""
        index = Index([d[1] for d in docs], self.weight, self.mean)
        unused, seed, ranked = np.ones(len(docs), bool), 0, iter(())
        if self.query is not None:
            ranked = self._ranked(index, unused)
        while True:
            if self.query is None:
                while seed < len(docs) and not unused[seed]:
                    seed += 1
                if seed == len(docs):
                    return
                at, ranked = seed, None
            else:
                at = next(ranked, None)
                if at is None:
                    return
            unused[at], start = False, 0
            while start < len(docs[at][1]):
                if self.query is None:  # a seed, or the rest of a document that opens the next window
                    self.query, ranked = index.terms[at], None
                piece, start = self._put(docs[at], start)
                yield piece
            if self.query is not None and ranked is None:
                ranked = self._ranked(index, unused)

    def _ranked(self, index: Index, unused: np.ndarray) -> Iterator[int]:
        """The shard's unused documents, nearest to the open window's seed first; ties in their order."""
        score = index.scores(self.query[self.query < len(self.weight)])
        left = np.flatnonzero(unused)
        return iter(left[np.argsort(-score[left], kind="stable")].tolist())


def _packed(kind: type, weight: np.ndarray, mean: float, window: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    packer = Packer(TaskContext.get().partitionId() << 40, weight, mean, window)
    shard, tokens = [], 0

    def done() -> pa.RecordBatch:
        rows = list(zip(*packer.pack(shard), strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in rows], [x.split()[0] for x in _PIECE.split(", ")])

    for b in batches:
        for doc_id, raw in zip(b.column("doc_id").to_pylist(), b.column("ids"), strict=True):
            ids = np.frombuffer(raw.as_py(), kind)
            if shard and (tokens + len(ids) > SHARD_TOKENS or len(shard) == SHARD_DOCS):
                yield done()
                shard, tokens = [], 0
            shard.append((doc_id, ids))
            tokens += len(ids)
    if shard:
        yield done()


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW) -> DataFrame:
    """Pieces of all docs (doc_id, text) in sequences of ``window`` tokens; every token is in exactly one.

    doc_id, start and length (the piece within its document), ids_crc32,
    doc_tokens, sequence_id and offset (the piece within its sequence). Defined
    cases: a null or empty text is the one token ``END``; rows of one doc_id,
    repeated ones too, are documents of their own; ties are ranked in sorting
    order; documents without a rare token are neighbours of nothing and taken in
    that order; an empty table gives no piece; extra columns are ignored.
    """
    kind = encoder(tokenizer).kind
    encoded = save(encode_documents(docs, tokenizer))
    n_docs, tokens = encoded.agg(F.count("*"), F.coalesce(F.sum("doc_tokens"), F.lit(0))).first()
    weight = inverse_frequency(encoded, kind, n_docs)
    # equal texts have equal keys: the hash of the id spreads them over ranges
    cut = [F.col("near"), F.xxhash64("doc_id"), F.col("doc_id")]
    dealt = encoded.repartitionByRange(max(1, ceil(tokens / RANGE_TOKENS)), *cut).sortWithinPartitions(*cut, "ids")
    return dealt.select("doc_id", "ids").mapInArrow(partial(_packed, kind, weight, tokens / max(1, n_docs), window), _PIECE)
