"""Repeated passages: exact removal of 20-word windows seen earlier.

Documents are dealt into shards of about ``SHARD_BYTES`` of text.

1. Every window is named by the smallest hash among its 8-grams, so equal
   windows have equal names. Shards send their names, each once, to counting
   tasks; only names that recur can hold recurring windows.
2. Shards send the windows under recurring names, each once with its number,
   first place and following window. The counting tasks keep those that recur,
   with the shards that hold them: these are the confirmed windows.
3. The shard of a window's first place chains confirmed windows that always
   follow one another into passages and sends each passage's words to the
   shards that hold it.
4. A shard compiles its passages into an Aho-Corasick automaton and streams all
   its documents through it. The automaton locates every occurrence; words of
   all but the first occurrence go.

Between the steps windows and passages travel as packed columns, one row for
each pair of tasks, so a passage common to all documents is one entry a shard.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256
from itertools import compress
from math import ceil

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pelagia.llm.scratch import drop, release, save
from pelagia.llm.words import WordTable, gram_hashes, small_batches, word_table

WINDOW = 20
GRAM = 8
#: Text of one shard; with its windows and automaton it fits a Python worker.
SHARD_BYTES = 8 << 20
#: Shards whose windows, at most all of them, one counting task holds.
SHARDS_PER_BUCKET = 4
#: Words of passages packed at a time.
CHUNK = 1 << 20
_FIRST = -(1 << 63)
#: Fewer bytes can't hold WINDOW words.
_LEAST_BYTES = 2 * WINDOW - 1
_NAMES = ("<u8", "u1")
_WINDOWS = ("<u8", "<u4", "<i8", "<i4", "<i4", "<i4")
_PASSAGES = ("<i8", "<i4", "<i4", "<i4", "<u8")


def _pack(columns: list[np.ndarray]) -> bytes:
    """Columns as differences of neighbours, byte by byte: what grows slowly or is small is then nearly all zeros to Spark's codec."""
    steps = (np.diff(c, prepend=c.dtype.type(0)) for c in columns)
    return b"".join(c.view(np.uint8).reshape(len(c), c.itemsize).T.tobytes() for c in steps)


def _unpack(blob: bytes, kinds: tuple[str, ...], n: int | None = None) -> list[np.ndarray]:
    n, at, out = len(blob) // sum(np.dtype(k).itemsize for k in kinds) if n is None else n, 0, []
    for k in kinds:
        width = np.dtype(k).itemsize
        planes = np.frombuffer(blob, np.uint8, n * width, at).reshape(width, n)
        out.append(np.cumsum(np.ascontiguousarray(planes.T).view(k)[:, 0], dtype=k))
        at += n * width
    return out


def _parts(key: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(value, rows with it) of every value of ``key``."""
    order = np.argsort(key, kind="stable")
    edge = np.flatnonzero(np.diff(key[order], prepend=-1, append=-1))
    for a, z in zip(edge[:-1], edge[1:], strict=True):
        yield int(key[order[a]]), order[a:z]


def _ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... size[0] numbers, then those from start[1], and so on."""
    before = np.cumsum(size) - size
    return np.arange(int(size.sum())) + np.repeat(start - before, size)


def _rows(columns: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = {"doc_id": pa.int64(), "n_words": pa.int64(), "n_removed": pa.int64(), "kept_sha256": pa.string(), "kept_text": pa.string(), "blob": pa.binary(), "more": pa.binary()}
    cols = list(zip(*columns, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds.get(n, pa.int32())) for c, n in zip(cols, names, strict=True)], names)


def _names(t: WordTable) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every window inside one text: its first word and its name (48 bits);
    and the names that lie twice within two adjoining windows."""
    m = len(t.hash) - WINDOW + 1
    if m <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    grams = low = gram_hashes(t.hash, GRAM, 5) >> np.uint64(16)
    # places of a name that are further apart leave a window without it between them, which shows as a gap
    twice = np.unique(np.concatenate([grams[:-d][grams[:-d] == grams[d:]] for d in range(1, WINDOW - GRAM + 2)]))
    # the minimum of WINDOW - GRAM + 1 = 13 neighbours from those of 8 and 8
    for step in (1, 2, 4):
        low = np.minimum(low[:-step], low[step:])
    low = np.minimum(low[:m], low[5 : m + 5])
    sizes = np.diff(t.first)
    text = np.repeat(np.arange(len(sizes)), sizes)
    inside = np.flatnonzero(text[:m] == text[WINDOW - 1 :])
    return inside, low[inside], twice


def _owners(t: WordTable, words: np.ndarray) -> np.ndarray:
    return np.searchsorted(t.first, words, side="right") - 1


def _counted(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, the place of each row among them and their sums of ``n``."""
    value, at = np.unique(key, return_inverse=True)
    return value, at, np.bincount(at, n, len(value)).astype(np.int64)


def _shard_names(buckets: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, found = -1, []
        for b in batches:
            t, shard = word_table(b.column("text")), b.column("shard")[0].as_py() if len(b) else shard
            at, name, twice = _names(t)
            own = _owners(t, at)
            order = np.lexsort((name, own))
            at, own, name = at[order], own[order], name[order]
            new = np.ones(len(own), bool)
            new[1:] = (own[1:] != own[:-1]) | (name[1:] != name[:-1])
            head = np.flatnonzero(new)
            # a name occurs again in its text if its windows have a gap or two adjoining ones hold it twice
            apart = np.zeros(len(own), bool)
            apart[1:] = ~new[1:] & (at[1:] - at[:-1] > 1)
            again = np.logical_or.reduceat(apart, head) if len(head) else apart[:0]
            again |= np.isin(name[head], twice)
            found.append(_counted(name[head], again + 1)[::2])
        if found:
            name, _, n = _counted(*(np.concatenate(c) for c in zip(*found, strict=True)))
            n = np.minimum(n, 2).astype(np.uint8)
            yield _rows([(k, shard, _pack([name[i], n[i]])) for k, i in _parts((name % np.uint64(buckets)).astype(np.int64))], ["bucket", "shard", "blob"])

    return run


def _recurring_names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shards, names, counts = [], [], []
    for b in batches:
        for shard, blob in zip(b.column("shard").to_pylist(), b.column("blob").to_pylist(), strict=True):
            name, n = _unpack(blob, _NAMES)
            shards.append(np.full(len(name), shard))
            names.append(name)
            counts.append(n)
    if names:
        shard, name = np.concatenate(shards), np.concatenate(names)
        _, at, n = _counted(name, np.concatenate(counts))
        keep = n[at] > 1
        name = name[keep]
        yield _rows([(k, _pack([name[i]])) for k, i in _parts(shard[keep])], ["shard", "blob"])


def _places(t: WordTable, b: pa.RecordBatch, words: np.ndarray) -> list[np.ndarray]:
    """k, t and place in its text of each of ``words``."""
    own = _owners(t, words)
    return [b.column("k").to_numpy()[own], b.column("t").to_numpy()[own], (words - t.first[own]).astype(np.int32)]


def _shard_windows(buckets: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, replies, known, found = -1, [], None, []
        for b in batches:
            shard = b.column("shard")[0].as_py() if len(b) else shard
            replies += [_unpack(x, _NAMES[:1])[0] for x in b.column("blob").drop_null().to_pylist()]
            b = b.filter(b.column("blob").is_null())
            if not len(b) or not replies:
                continue
            known = np.sort(np.concatenate(replies)) if known is None else known
            t = word_table(b.column("text"))
            at, name, _ = _names(t)
            if not len(at):
                continue
            h = gram_hashes(t.hash, WINDOW, 7)[at]
            after = np.zeros(len(h), np.uint32)
            after[:-1] = np.where(at[1:] == at[:-1] + 1, h[1:].astype(np.uint32), np.uint32(0))
            keep = known[np.minimum(np.searchsorted(known, name), len(known) - 1)] == name
            found.append([h[keep], after[keep], *_places(t, b, at[keep])])
        if found:
            h, after, k, doc, start = (np.concatenate(c) for c in zip(*found, strict=True))
            one = _firsts(h, after, k, doc, start, np.ones(len(h), np.int32))[:6]
            order = np.lexsort((one[4], one[3], one[2]))
            one = [c[order] for c in one]
            yield _rows([(i, shard, _pack([c[j] for c in one])) for i, j in _parts((one[0] % np.uint64(buckets)).astype(np.int64))], ["bucket", "shard", "blob"])

    return run


def _firsts(h, after, k, doc, start, n) -> tuple:
    """One row for each window: h, the low bits of the window that always follows it or 0, first place, number; and the rows' order and edges."""
    order = np.lexsort((start, doc, k, h))
    h, after = h[order], after[order]
    head = np.flatnonzero(np.diff(h, prepend=h[:1] ^ np.uint64(1)))
    low, high = (f.reduceat(after, head) for f in (np.minimum, np.maximum))
    total = np.add.reduceat(n[order], head).astype(np.int32)
    first = order[head]
    return h[head], np.where(low == high, low, np.uint32(0)), k[first], doc[first], start[first], total, order, head


def _recurring_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Confirmed windows, to the shard of their first place, each with its shards."""
    shards, cols = [], []
    for b in batches:
        for shard, blob in zip(b.column("shard").to_pylist(), b.column("blob").to_pylist(), strict=True):
            cols.append(_unpack(blob, _WINDOWS))
            shards.append(np.full(len(cols[-1][0]), shard, np.int32))
    if not cols:
        return
    h, after, k, doc, start, n = (np.concatenate(c) for c in zip(*cols, strict=True))
    shard = np.concatenate(shards)
    *one, order, head = _firsts(h, after, k, doc, start, n)
    size = np.diff(np.append(head, len(h)))
    keep = np.flatnonzero(one[5] > 1)
    keep = keep[np.lexsort((one[4][keep], one[3][keep], one[2][keep]))]
    home, shard = shard[order[head]], shard[order]
    yield _rows(
        [(s, _pack([c[keep[i]] for c in one]), _pack([size[keep[i]].astype("<i4")]) + _pack([shard[_ragged(head[keep[i]], size[keep[i]])]])) for s, i in _parts(home[keep])],
        ["shard", "blob", "more"],
    )


def _chained(blobs: list[tuple[bytes, bytes]]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Passages: k, t, start, number of words; the shards of each as (flat, sizes)."""
    each = [_unpack(x, _WINDOWS) for x, _ in blobs]
    cols = [np.concatenate(c) for c in zip(*each, strict=True)]
    sizes = [_unpack(more, ("<i4",), len(c[0]))[0] for c, (_, more) in zip(each, blobs, strict=True)]
    flat = [_unpack(more[4 * len(n) :], ("<i4",))[0] for n, (_, more) in zip(sizes, blobs, strict=True)]
    sizes, flat = np.concatenate(sizes), np.concatenate(flat)
    order = np.lexsort((cols[4], cols[3], cols[2]))
    h, after, k, doc, start, n = (c[order] for c in cols)
    joined = np.zeros(len(h), bool)
    joined[1:] = (k[1:] == k[:-1]) & (doc[1:] == doc[:-1]) & (start[1:] == start[:-1] + 1) & (after[:-1] == h[1:].astype(np.uint32)) & (n[1:] == n[:-1])
    head = np.flatnonzero(~joined)
    words = np.diff(np.append(head, len(h))) + WINDOW - 1
    at, own = (np.cumsum(sizes) - sizes)[order[head]], sizes[order[head]]
    return [k[head], doc[head], start[head], words.astype(np.int32)], flat[_ragged(at, own)], own


def _passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    blobs, place, todo = [], None, {}
    for b in batches:
        blobs += [(x, y) for x, y in zip(b.column("blob").to_pylist(), b.column("more").to_pylist(), strict=True) if x is not None]
        b = b.filter(b.column("blob").is_null())
        if not len(b) or not blobs:
            continue
        if place is None:
            place, flat, sizes = _chained(blobs)
            before = np.cumsum(sizes) - sizes
            edge = np.flatnonzero(np.append(True, (place[0][1:] != place[0][:-1]) | (place[1][1:] != place[1][:-1])))
            todo = {(int(place[0][a]), int(place[1][a])): (a, z) for a, z in zip(edge, np.append(edge[1:], len(place[0])), strict=True)}
        t = word_table(b.column("text"))
        rows, first = [], []
        for d, key in enumerate(zip(b.column("k").to_pylist(), b.column("t").to_pylist(), strict=True)):
            if key in todo:  # a repeated row is not asked again
                a, z = todo.pop(key)
                rows.append(np.arange(a, z))
                first.append(np.full(z - a, t.first[d]))
        if not rows:
            continue
        rows, first = np.concatenate(rows), np.concatenate(first) + place[2][np.concatenate(rows)]
        whole = np.concatenate((np.zeros(1, np.uint64), np.cumsum(t.hash, dtype=np.uint64)))
        code = t.hash.astype("<u2")
        # a passage to every shard that holds it, so many words at a time
        upto = np.cumsum(place[3][rows].astype(np.int64) * sizes[rows])
        for cut in np.split(np.arange(len(rows)), np.searchsorted(upto, np.arange(CHUNK, upto[-1], CHUNK))):
            if not len(cut):
                continue
            each, at = np.repeat(cut, sizes[rows[cut]]), flat[_ragged(before[rows[cut]], sizes[rows[cut]])]
            out = []
            for shard, i in _parts(at):
                r, a = rows[each[i]], first[each[i]]
                n = place[3][r]
                out.append((shard, _pack([place[0][r], place[1][r], place[2][r], n, whole[a + n] - whole[a]]), code[_ragged(a, n)].tobytes()))
            yield _rows(out, ["shard", "blob", "more"])


class _Shard:
    """The automaton of a shard's passages. A word is two letters, the low bits of its hash; sums of whole hashes confirm a match."""

    def __init__(self, blobs: list[tuple[bytes, bytes]]):
        self.k, self.t, self.start, self.size, self.sum = (np.concatenate(c) for c in zip(*(_unpack(x, _PASSAGES) for x, _ in blobs), strict=True))
        text = b"".join(y for _, y in blobs).decode("latin-1")
        keys: dict[str, list[int]] = {}
        end = 2 * np.cumsum(self.size.astype(np.int64))
        for i, (a, z) in enumerate(zip((end - 2 * self.size).tolist(), end.tolist(), strict=True)):
            keys.setdefault(text[a:z], []).append(i)
        self.own = list(keys.values())
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, key in enumerate(keys):
            self.automaton.add_word(key, i)
        self.automaton.make_automaton()

    def repeated(self, t: WordTable, k: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Which words a later occurrence of a passage covers."""
        hits = [((e + 1) // 2, i) for e, g in self.automaton.iter(t.hash.astype("<u2").tobytes().decode("latin-1")) if e % 2 for i in self.own[g]]
        change = np.zeros(len(t.hash) + 1, np.int64)
        if hits:
            z, i = np.array(hits, np.int64).T
            a = z - self.size[i]
            own = _owners(t, a)
            whole = np.concatenate((np.zeros(1, np.uint64), np.cumsum(t.hash, dtype=np.uint64)))
            real = (z <= t.first[own + 1]) & (whole[z] - whole[a] == self.sum[i])
            earliest = (k[own] == self.k[i]) & (doc[own] == self.t[i]) & (a - t.first[own] == self.start[i])
            late = real & ~earliest
            np.add.at(change, a[late], 1)
            np.add.at(change, z[late], -1)
        return np.cumsum(change[:-1]) > 0


def _cut(keep_text: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs, shard = [], None
        for b in batches:
            if "blob" in b.schema.names:
                blobs += [(x, y) for x, y in zip(b.column("blob").to_pylist(), b.column("more").to_pylist(), strict=True) if x is not None]
                b = b.filter(b.column("blob").is_null())
            if not len(b):
                continue
            if blobs and shard is None:
                shard = _Shard(blobs)
            t = word_table(b.column("text"))
            gone = shard.repeated(t, b.column("k").to_numpy(), b.column("t").to_numpy()) if shard else np.zeros(len(t.hash), bool)
            lost = np.diff(np.append(0, np.cumsum(gone))[t.first])
            out = []
            for d, (doc_id, text) in enumerate(zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True)):
                a, z = int(t.first[d]), int(t.first[d + 1])
                # bytes.split() parts words at the same six characters
                words = (text or "").encode().split()
                kept = b" ".join(compress(words, ~gone[a:z]) if lost[d] else words)
                out.append((doc_id, z - a, int(lost[d]), sha256(kept).hexdigest(), kept.decode() if keep_text else None))
            yield _rows(out, ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])

    return run


def remove_repeats(docs: DataFrame, *, keep_text: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept_text of every row of docs (doc_id, text).

    Defined cases: null text has no words; texts under 20 words lose nothing;
    kept_text is null unless ``keep_text``; null ids come before all others; of
    different texts under one doc_id that of the smaller 32-bit hash is the
    earlier document; a row repeated with id and text is the same document, so
    all its copies lose the same words; an empty table gives an empty result;
    extra columns are ignored.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(F.octet_length("text") >= _LEAST_BYTES, F.lit(False)).alias("able"))
    able = rows.where("able").select("doc_id", F.coalesce("doc_id", F.lit(_FIRST)).alias("k"), F.hash("text").alias("t"), "text")
    n = ceil((able.agg(F.sum(F.octet_length("text"))).first()[0] or 1) / SHARD_BYTES)
    dealt = able.withColumn("shard", F.pmod(F.xxhash64("k", "t"), F.lit(n)).cast("int"))

    buckets = ceil(n / SHARDS_PER_BUCKET)

    def by_bucket(sent: DataFrame, work: Callable, schema: str) -> DataFrame:
        return sent.repartitionById(buckets, "bucket").mapInArrow(work, schema)

    def by_shard(sent: DataFrame | None, work: Callable, schema: str) -> DataFrame:
        """``work`` on each shard: what was sent to it, then its documents."""
        if sent is None:
            return dealt.repartitionById(n, "shard").mapInArrow(work, schema)
        both = dealt.withColumn("sent", F.lit(False)).unionByName(sent.withColumn("sent", F.lit(True)), allowMissingColumns=True)
        return both.repartitionById(n, "shard").sortWithinPartitions(F.desc("sent")).mapInArrow(work, schema)

    to_bucket, to_shard, packed = "bucket int, shard int, blob binary", "shard int, blob binary", "shard int, blob binary, more binary"
    names = save(by_bucket(by_shard(None, _shard_names(buckets), to_bucket), _recurring_names, to_shard))
    release(docs.sparkSession)
    windows = save(by_bucket(by_shard(names, _shard_windows(buckets), to_bucket), _recurring_windows, packed))
    drop(names)
    release(docs.sparkSession)
    passages = save(by_shard(windows, _passages, packed))
    drop(windows)
    release(docs.sparkSession)
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"
    short = rows.where("not able").select("doc_id", "text").mapInArrow(_cut(keep_text), schema)
    return by_shard(passages, _cut(keep_text), schema).unionByName(short)


OP6_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), s AS (
  SELECT doc_id, unnest(range(1, len(words) - 18)) AS p, words FROM w WHERE len(words) >= 20
), g AS (
  SELECT doc_id, p, array_to_string(words[p:p + 19], ' ') AS passage FROM s
), r AS (
  SELECT doc_id, p, row_number() OVER (PARTITION BY passage ORDER BY doc_id, p) AS nth FROM g
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS q FROM r WHERE nth > 1
), lost AS (SELECT doc_id, list(q) AS qs FROM gone GROUP BY doc_id),
k AS (
  SELECT w.doc_id, words, len(words) AS n_words, coalesce(len(qs), 0) AS n_removed,
    list_filter(words, lambda x, i: NOT list_contains(coalesce(qs, CAST([] AS BIGINT[])), i)) AS kept
  FROM w LEFT JOIN lost USING (doc_id)
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(n_removed AS BIGINT) AS n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM k
"""
