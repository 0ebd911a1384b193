"""MinHash near-duplicates by an inverted join over signature coordinates.

Every distinct shingle set gets ``K`` minima. A (coordinate, minimum) pair is a
posting key. Sets that are alike share at least ``T`` of their ``K`` keys, so

* prefix: a set posts only under its ``K - T + 1`` rarest keys (keys that occur
  once take the first places and need no posting); two sets sharing ``T`` keys
  always meet under one of these;
* skip: the other, more frequent keys are never merged as lists, they are only
  counted for pairs that the prefix brought together;
* pairs with ``T`` or more collisions are confirmed on the full shingle sets.

First each key's members are compared with ``HEADS`` of them, then, round after
round, the members outside a key's largest component with further ``HEADS`` of
that component: rows stay in proportion to the members, and nearly all of a
group is one component soon. Only what no round could join is compared with
all others of its key, in blocks and across components only. No link between
two components is skipped, and links inside one component are never listed.

With K = 64 and T = 32 a pair of similarity exactly 0.75 is missed with
probability below 1e-4, one of 0.8 with probability below 1e-7.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pelagia.llm.components import components
from pelagia.llm.scratch import drop, release, save
from pelagia.llm.words import WordTable, gram_hashes, mix, small_batches, stream, word_table

K, T = 64, 32
SHINGLE = 5
#: Members of a key that its other members are compared with in one round.
HEADS = 4
#: Pairs with one head that meet in one task; a head with more is sent to several.
SPREAD = 256
BLOCK = 1024
#: Bits of the bitmap that rules pairs out before their full sets are sent.
BITS = 2048
_MULT = stream(K, 11)[:, None]
_COORD = (np.arange(K, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
_PLACE = np.arange(K, dtype=np.uint64)


def shingle_sets(table: WordTable, n: int = SHINGLE) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of every text; a shorter text is one shingle."""
    grams = gram_hashes(table.hash, n)
    for a, z in zip(table.first[:-1], table.first[1:], strict=True):
        if z - a >= n:
            yield np.unique(grams[a : z - n + 1])
        elif z > a:
            yield gram_hashes(table.hash[a:z], int(z - a), seed=100 + int(z - a))
        else:
            yield np.zeros(0, np.uint64)


def _tokens(least: np.ndarray) -> np.ndarray:
    """Coordinate-value pairs as numbers; the low six bits are the coordinate."""
    return ((mix(least + _COORD) & ~np.uint64(K - 1)) | _PLACE).view(np.int64)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sizes, keys, tokens = [], [], []
        for s in shingle_sets(word_table(b.column("text"), lower=True)):
            sizes.append(len(s))
            keys.append(blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
            # a column at a time keeps the working set of one text small
            tokens.append(_tokens((s * _MULT).min(1)) if len(s) else None)
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id").cast(pa.int64()), b.column("text_hash"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(tokens, pa.list_(pa.int64()))],
            ["doc_id", "text_hash", "n_shingles", "set_key", "tokens"],
        )


def _sketches(flat: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A bitmap of BITS bits of each set; bitmaps differ in no more places than their sets differ in members."""
    seen = np.zeros((len(first) - 1, BITS), bool)
    seen[np.repeat(np.arange(len(first) - 1), np.diff(first)), flat % np.uint64(BITS)] = True
    return np.packbits(seen, axis=1)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        own = list(shingle_sets(word_table(b.column("text"), lower=True)))
        size = np.array([len(s) for s in own], np.int64)
        sketch = _sketches(np.concatenate(own), np.append(0, np.cumsum(size))) if own else []
        mask = [int(np.bitwise_or.reduce(np.int64(1) << (p.values.to_numpy() & (K - 1)))) for p in b.column("prefix")]
        yield pa.RecordBatch.from_arrays(
            [b.column("node"), b.column("prefix"), pa.array(mask, pa.int64()), b.column("tokens"), pa.array(size), pa.array([s.tobytes() for s in sketch], pa.binary()), pa.array([s.tobytes() for s in own], pa.binary())],
            ["node", "prefix", "mask", "tokens", "size", "sketch", "own"],
        )


def linked(x: np.ndarray, y: np.ndarray) -> bool:
    """100 * intersection >= 75 * union, for sorted distinct hashes."""
    least, most = sorted((len(x), len(y)))
    if 100 * least < 75 * most:
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= 75 * (len(x) + len(y) - both)


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        x, y = b.column("x").to_pylist(), b.column("y").to_pylist()
        keep = [linked(np.frombuffer(i, np.uint64), np.frombuffer(j, np.uint64)) for i, j in zip(x, y, strict=True)]
        yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _near(table: pa.Table, edge: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(start of the block, asker, rows of other components that may be linked to it).

    A pair is given under the smallest key that both post under only, with T or
    more collisions, and if its bitmaps allow a link.
    """
    comp, key, ask, size = (table.column(c).to_numpy() for c in ("component", "token", "ask", "size"))
    lists = table.column("tokens").combine_chunks()
    tokens = np.zeros((len(table), K), np.int64)
    value = lists.flatten().to_numpy()
    tokens[np.repeat(np.arange(len(table)), lists.value_lengths().to_numpy()), value & (K - 1)] = value
    posted = (table.column("mask").to_numpy()[:, None] >> _PLACE.astype(np.int64)) & 1 > 0
    sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint64).reshape(len(table), -1)
    top = np.iinfo(np.int64).max
    for a, z in zip(edge[:-1], edge[1:], strict=True):
        rows = np.arange(a, z)
        right = rows[~ask[a:z]]
        others, other_comp = tokens[right], comp[right]
        for i in rows[ask[a:z]]:
            same = (others == tokens[i]) & (tokens[i] != 0)
            alike = np.flatnonzero((same.sum(1) >= T) & (other_comp != comp[i]))
            near = right[alike]
            # 75 of 100 in common: at most a seventh of all members may differ
            fit = 7 * np.bitwise_count(sketch[near] ^ sketch[i]).sum(1).astype(np.int64) <= size[near] + size[i]
            alike, near = alike[fit], near[fit]
            least = np.where(same[alike] & posted[near] & posted[i], tokens[i], top).min(1)
            if (least == key[i]).any():
                yield a, i, near[least == key[i]]


def _alive(table: pa.Table, edge: np.ndarray) -> pa.Table:
    """The rows that may be linked to another row of their block."""
    stay = np.zeros(len(table), bool)
    for _, i, near in _near(table, edge):
        stay[i] = True
        stay[near] = True
    return table.select(["token", "i", "j", "node", "component", "ask"]).filter(pa.array(stay)).combine_chunks()


def _compare(table: pa.Table, edge: np.ndarray) -> pa.Table:
    """One link between each two components that askers and others of one block connect."""
    comp, own, found, done = table.column("component").to_numpy(), table.column("own"), [], (None, set())
    for block, i, near in _near(table, edge):
        if block != done[0]:
            done = (block, set())
        x = np.frombuffer(own[int(i)].as_py(), np.uint64)
        for j in near:
            pair = (comp[i], comp[j])
            if pair not in done[1] and linked(x, np.frombuffer(own[int(j)].as_py(), np.uint64)):
                found.append(pair)
                done[1].add(pair)
    return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})


def _by_block(work: Callable[[pa.Table, np.ndarray], pa.Table]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``work`` on block after block of rows sorted by block; only the open block is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            table = pa.Table.from_batches([b])
            held = table if held is None else pa.concat_tables([held, table])
            new = np.zeros(len(held), bool)
            for c in ("token", "i", "j"):
                v = held.column(c).to_numpy()
                new[1:] |= v[1:] != v[:-1]
            edge = np.flatnonzero(new)
            if len(edge):
                yield from work(held.slice(0, edge[-1]), np.concatenate(([0], edge))).to_batches()
                held = held.slice(edge[-1])
        if held is not None and len(held):
            yield from work(held, np.array([0, len(held)])).to_batches()

    return run


def _linked_pairs(pairs: DataFrame, cand: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes that are links. ``a`` may be in very many pairs: it goes to as many tasks as they need."""
    fan = pairs.groupBy("a").agg(F.ceil(F.count("*") / SPREAD).cast("long").alias("n"))
    pairs = pairs.join(fan, "a").select("a", "b", F.pmod(F.xxhash64("b"), "n").alias("part"))
    spread = cand.join(fan, F.col("node") == F.col("a")).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))

    def beside(rows: DataFrame, column: str) -> DataFrame:
        x = spread.select("a", "part", F.col(column).alias("x"))
        return rows.join(x, ["a", "part"]).join(cand.select(F.col("node").alias("b"), F.col(column).alias("y")), "b")

    # full sets go only to pairs with enough collisions
    alike = beside(pairs, "tokens").where(F.expr(f"size(array_intersect(x, y)) >= {T}")).select("a", "b", "part")
    return beside(alike, "own").select("a", "b", "x", "y").mapInArrow(_confirm, "a long, b long")


def _heads(where: Column, turn: int) -> Column:
    """``HEADS`` nodes of a group, others each turn; every key of one group of copies picks nearly the same."""
    return F.array_compact(F.array(*(F.min_by(F.when(where, F.col("node")), F.when(where, F.xxhash64("node", F.lit(turn * HEADS + k)))) for k in range(HEADS))))


def _at(post: DataFrame, label: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Posts with their component, and the keys whose posts are of several: (token, main component, size, n_ask outside it)."""
    at = post.join(label, "node", "left").withColumn("component", F.coalesce("component", "node"))
    sizes = at.groupBy("token", "component").agg(F.count("*").alias("n"))
    main = sizes.groupBy("token").agg(
        F.max_by("component", F.struct("n", -F.col("component"))).alias("main"), F.sum("n").alias("size"), (F.sum("n") - F.max("n")).alias("n_ask")
    ).where("n_ask > 0")
    return at, main


def _merged(label: DataFrame, links: DataFrame) -> DataFrame:
    """``label`` after its components are joined by ``links`` between components."""
    above = components(links).select(F.col("node").alias("component"), F.col("component").alias("above"))
    known = label.join(above, "component", "left").select("node", F.coalesce("above", "component").alias("component"))
    # a node alone until now has no label yet
    return known.union(above.select("component", "above")).groupBy("node").agg(F.min("component").alias("component"))


def _contracted(post: DataFrame, label: DataFrame, cand: DataFrame) -> DataFrame:
    """``label`` after rounds of comparing the members outside a key's main component with heads inside it.

    Asked are the keys of more than ``BLOCK`` members; others fit one block.
    Ends when a round joins less than an eighth of the components that asked.
    """
    spark = post.sparkSession
    turn, asked, joined = 1, 1, 1
    while 8 * joined >= asked:
        at, main = _at(post, label)
        large = save(main.where(F.col("size") > BLOCK).select("token", "main"))
        if large.isEmpty():
            break
        at = at.join(large, "token")
        picked = at.groupBy("token").agg(_heads(F.col("component") == F.col("main"), turn).alias("heads"))
        pairs = at.where("component <> main").join(picked, "token").select(F.explode("heads").alias("a"), F.col("node").alias("b")).distinct()
        pairs = save(pairs)
        links = save(_linked_pairs(pairs, cand))
        ends = label.select(F.col("node").alias("a"), F.col("component").alias("x")), label.select(F.col("node").alias("b"), F.col("component").alias("y"))
        joint = links.join(ends[0], "a", "left").join(ends[1], "b", "left").select(F.coalesce("x", "a").alias("a"), F.coalesce("y", "b").alias("b"))
        asked = pairs.join(ends[1], "b", "left").agg(F.count_distinct(F.coalesce("y", "b"))).first()[0]
        joined = joint.agg(F.count_distinct("b")).first()[0]
        if joined:
            label = save(_merged(label, joint))
        for spent in (pairs, links, large):
            drop(spent)
        release(spark)
        turn += 1
    return label


def _across(post: DataFrame, label: DataFrame, cand: DataFrame) -> DataFrame:
    """Links between components, for confirmed links of their members that meet under one key."""
    at, main = _at(post, label)
    # a block holds the askers of one part and the members of another: about 2 * BLOCK rows
    tall, wide = (F.ceil(F.col(c) / BLOCK).cast("long") for c in ("n_ask", "size"))
    upto = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    own = lambda n, k: F.pmod(F.xxhash64("node", F.lit(k)), n)
    place = lambda i, j, ask: F.struct(i.alias("i"), j.alias("j"), F.lit(ask).alias("ask"))
    asks = F.when(F.col("component") != F.col("main"), F.transform(upto(wide), lambda j: place(own(tall, 1), j, True)))
    told = F.transform(upto(tall), lambda i: place(i, own(wide, 2), False))
    rows = at.join(main, "token").select("token", "node", "component", F.explode(F.concat(F.coalesce(asks, F.slice(told, 1, 0)), told)).alias("at"))
    rows = rows.select("token", "node", "component", "at.*")
    blocks = lambda r, work, schema: r.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j").mapInArrow(_by_block(work), schema)
    brief = cand.select("node", "mask", "tokens", "size", "sketch")
    # full sets go only where the short forms leave a possible link
    alive = save(blocks(rows.join(brief, "node"), _alive, "token long, i long, j long, node long, component long, ask boolean"))
    release(post.sparkSession)
    links = save(blocks(alive.join(cand.drop("prefix"), "node"), _compare, "a long, b long"))
    drop(alive)
    return links


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Near-duplicate components of ``docs`` (doc_id, text).

    Returns doc_id, n_shingles, component_id, kept and class_id (smallest doc_id
    with the same shingle set). Defined cases: null or wordless text has no
    shingles, links with nothing and is kept; a null doc_id takes no part and
    gets a null component; rows that share a doc_id are judged each by its own
    text, so equal ones share a component and others may not; an empty table
    gives an empty result; further columns are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    signed = save(docs.mapInArrow(_sign, "doc_id long, text_hash long, n_shingles long, set_key binary, tokens array<bigint>"))
    # equal sets are one node, read from the text of its smallest doc_id
    whole = signed.where("set_key is not null and doc_id is not null").groupBy(F.xxhash64("set_key").alias("node"))
    least = F.min(F.struct("doc_id", "text_hash"))
    node = whole.agg(F.min("doc_id").alias("class_id"))
    token = save(whole.agg(F.first("tokens").alias("tokens")).select("node", F.explode("tokens").alias("token")))
    release(spark)
    often = token.groupBy("token").agg(F.count("*").alias("n")).where("n > 1")
    shared = token.join(often, "token").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("keys")).where(F.size("keys") >= T)
    # keys of one set alone collide with nothing: the shared ones are the signature from here on
    posts = shared.select("node", F.expr(f"transform(slice(keys, 1, size(keys) - {T} + 1), k -> k.token)").alias("prefix"), F.col("keys.token").alias("tokens"))
    posts = save(posts.join(whole.agg(least.alias("least")), "node").select("node", "prefix", "tokens", "least.*"))
    drop(token)
    release(spark)
    held = docs.join(posts, ["doc_id", "text_hash"]).dropDuplicates(["doc_id", "text_hash"]).select("node", "prefix", "tokens", "text")
    cand = save(held.mapInArrow(_sets, "node long, prefix array<bigint>, mask long, tokens array<bigint>, size long, sketch binary, own binary"))
    drop(posts)
    release(spark)
    post = cand.select("node", F.explode("prefix").alias("token"))
    met = post.groupBy("token").agg(_heads(F.lit(True), 0).alias("heads"), F.count("*").alias("n")).where("n > 1")
    star = save(post.join(met, "token").select(F.explode("heads").alias("a"), F.col("node").alias("b")).where("a <> b").distinct())
    post = save(post.join(met.select("token"), "token").select("token", "node"))
    release(spark)
    label = save(components(_linked_pairs(star, cand)))
    drop(star)
    release(spark)
    label = _contracted(post, label, cand)
    release(spark)
    more = _across(post, label, cand)
    drop(post)
    drop(cand)
    if not more.isEmpty():
        label = save(_merged(label, more))
    release(spark)
    grouped = label.join(node, "node")
    lowest = grouped.groupBy("component").agg(F.min("class_id").alias("component_id"))
    named = node.join(grouped.join(lowest, "component").select("node", "component_id"), "node", "left")
    out = signed.select("doc_id", "n_shingles", F.xxhash64("set_key").alias("node"), F.col("set_key").isNotNull().alias("some"))
    out = out.join(named, (out["node"] == named["node"]) & F.col("some"), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "class_id", "doc_id"))
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id")).alias("class_id"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """All columns of one document of each near-duplicate group: the smallest doc_id.

    Repeated rows of one doc_id stay one row; rows without a doc_id stay.
    """
    kept = near_duplicates(docs).where("kept and doc_id is not null").select("doc_id").distinct()
    named = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    return named.join(kept, "doc_id", "left_semi").select(docs.columns).unionByName(docs.where("doc_id is null"))


OP4_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN CAST([] AS VARCHAR[])
    WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS shingle
  FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY 1, 2
), l AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)
), r AS (
  SELECT doc_id AS node, doc_id AS seen FROM documents
  UNION
  SELECT r.node, l.b FROM r JOIN l ON l.a = r.seen
), c AS (SELECT node, min(seen) AS component_id FROM r GROUP BY node)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept, t.class_id
FROM documents d JOIN c ON c.node = d.doc_id LEFT JOIN n USING (doc_id)
JOIN (SELECT doc_id, CASE WHEN k IS NULL THEN doc_id ELSE min(doc_id) OVER (PARTITION BY k) END AS class_id
      FROM (SELECT w.doc_id, (SELECT string_agg(shingle, chr(10) ORDER BY shingle) FROM s WHERE s.doc_id = w.doc_id) AS k FROM w)) t USING (doc_id)
"""
