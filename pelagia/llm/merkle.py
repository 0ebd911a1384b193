"""Merkle manifest of a dataset: a tree of every source's rows, a tree of the sources, and a proof a row.

The node store is external: leaves are sorted once into runs, which stream to
Parquet with the number of each row within its run; with the runs' sizes that
gives every leaf its coordinate (group, index). The tree climbs ``RISE`` levels
a pass: nodes are dealt by block, the ``FAN ** RISE`` nodes below one node that
many levels higher, and each block streams through a task that writes the nodes
of its levels; a pass reads what the last one wrote of its highest level.
Proofs come top-down by a merge-scan of the same coordinates: a block's rows
follow the siblings above it. A task holds one block at a time, however large a
source is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from hashlib import sha256

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pelagia.llm.scratch import save, scratch_path
from pelagia.llm.words import small_batches

FAN = 3
RISE = 7
HEX = 64
#: Sorted rows of one run.
RUN_ROWS = 50_000
_LEAF_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_NODE = "grp string, level int, idx long, n long, hash string"


def _digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def leaf(**fields: Column) -> Column:
    """Digest of a row: each field as ``-`` or its UTF-8 size, a colon and its value."""
    parts = [F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c)) for c in (fields[f].cast("string") for f in _LEAF_FIELDS)]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def tampered(doc_id: Column, text: Column) -> Column:
    """The text without its line ends where 2 divides the CRC-32 of the decimal id."""
    return F.when(F.crc32(doc_id.cast("string").cast("binary")) % 2 == 0, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)


def sizes(n: int) -> Iterator[int]:
    """Nodes of each level of a tree of n leaves, down to one."""
    while n > 1:
        yield n
        n = -(-n // FAN)


def fold(node: str, idx: int, n: int, path: str) -> tuple[str, str]:
    """The top that a node at ``idx`` of ``n`` leads to beside the siblings in ``path``, and the rest of the path."""
    for size in sizes(n):
        at = idx % FAN
        k = HEX * (min(FAN, size - (idx - at)) - 1)
        node = _digest(path[: HEX * at] + node + path[HEX * at : k])
        path, idx = path[k:], idx // FAN
    return node, path


def climb(nodes: list[str], levels: int) -> list[list[str]]:
    """The ``levels`` levels above ``nodes``, each the digests of every ``FAN`` consecutive nodes of the one below."""
    out = []
    for _ in range(levels):
        nodes = [_digest("".join(nodes[i : i + FAN])) for i in range(0, len(nodes), FAN)]
        out.append(nodes)
    return out


def _levels(n: int, rise: int) -> int:
    """Levels above a block of a group that has ``n`` nodes on its level: up to the top, or ``rise``."""
    return sum(1 for _ in sizes(n)) if n <= FAN**rise else rise


def siblings(nodes: list[str], levels: int) -> list[str]:
    """The siblings of every node of a block, level by level and left to right."""
    every = [nodes, *climb(nodes, levels)]
    above = [""] * len(every[levels])
    for row in every[:levels][::-1]:
        first = [i - i % FAN for i in range(len(row))]
        above = ["".join(row[a:i]) + "".join(row[i + 1 : a + FAN]) + above[a // FAN] for i, a in enumerate(first)]
    return above


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each (grp, block) of sorted batches, one block at a time."""
    held: list[pa.Table] = []
    key = None
    for b in batches:
        keys = list(zip(b.column("grp").to_pylist(), b.column("block").to_pylist(), strict=True))
        a = 0
        while a < len(keys):
            z = a + 1
            while z < len(keys) and keys[z] == keys[a]:
                z += 1
            if held and keys[a] != key:
                yield pa.concat_tables(held)
                held = []
            held.append(pa.Table.from_batches([b.slice(a, z - a)]))
            key, a = keys[a], z
    if held:
        yield pa.concat_tables(held)


def _climbing(rise: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes above every block."""
    for t in _blocks(batches):
        grp, level, block, n = (t.column(c)[0].as_py() for c in ("grp", "level", "block", "n"))
        first = block * FAN**rise
        for nodes in climb(t.column("hash").to_pylist(), _levels(n, rise)):
            level, n, first, k = level + 1, -(-n // FAN), first // FAN, len(nodes)
            places = [pa.array([grp] * k, pa.string()), pa.array([level] * k, pa.int32()), pa.array(range(first, first + k), pa.int64()), pa.array([n] * k, pa.int64())]
            yield pa.RecordBatch.from_arrays([*places, pa.array(nodes, pa.string())], ["grp", "level", "idx", "n", "hash"])


def _descending(rise: int, carried: tuple[str, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every node of a block with its whole path: a block's first row has the path above it, and the columns ``carried`` for all."""
    for t in _blocks(batches):
        lead, nodes = t.slice(0, 1).to_pylist()[0], t.slice(1)
        own = siblings(nodes.column("hash").to_pylist(), _levels(nodes.column("n")[0].as_py(), rise)) if len(nodes) else []
        nodes = nodes.set_column(nodes.schema.get_field_index("path"), "path", pa.array([x + lead["path"] for x in own], pa.string()))
        for c in carried:
            k = nodes.schema.get_field_index(c)
            nodes = nodes.set_column(k, c, pa.array([lead[c]] * len(nodes), t.schema.field(c).type))
        yield from nodes.combine_chunks().to_batches()


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the run, and the number of rows before each within its run and group."""
    run, last, count = TaskContext.get().partitionId(), None, 0
    for b in batches:
        at = []
        for g, times in zip(b.column("grp").to_pylist(), b.column("times").to_pylist(), strict=True):
            if g != last:
                last, count = g, 0
            at.append(count)
            count += times
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array([run] * len(b), pa.int32()), pa.array(at, pa.int64())], [*b.schema.names, "run", "at"])


def _schema(rows: DataFrame, *more: str) -> str:
    return ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema), *more])


def coordinates(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (grp, times, ...), a written table, with idx, their place in the group by ``order``, and n, the group's size.

    A row with ``times`` over 1 becomes as many. Rows are sorted by range, so a
    group of any size spreads over many runs; only a count for each run and
    group is summed by group.
    """
    cut = [F.col(c) for c in ("grp", *order)]
    dealt = rows.repartitionByRange(max(1, -(-rows.count() // RUN_ROWS)), *cut).sortWithinPartitions(*cut)
    runs = save(dealt.mapInArrow(_numbered, _schema(rows, "run int", "at long")))
    held = runs.groupBy("grp", "run").agg(F.sum("times").alias("held"))
    so_far, whole = (F.sum("held").over(w) for w in (Window.partitionBy("grp").orderBy("run"), Window.partitionBy("grp")))
    held = held.select("grp", "run", (so_far - F.col("held")).alias("before"), whole.alias("n"))
    placed = runs.join(held, ["grp", "run"]).withColumn("again", F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1)))
    return placed.withColumn("idx", F.col("before") + F.col("at") + F.col("again")).drop("times", "run", "at", "before", "again")


@dataclass
class Tree:
    """The trees of all groups: every node below ``path``, a folder a level, made in ``passes`` of ``rise`` levels."""

    spark: SparkSession
    path: str
    rise: int
    passes: int = 0

    def nodes(self) -> DataFrame:
        """(grp, level, idx, n, hash); n is how many nodes the group has on the level."""
        return self.spark.read.schema(_NODE).parquet(self.path).select("grp", "level", "idx", "n", "hash")

    def level(self, k: int) -> DataFrame:
        return self.nodes().where(F.col("level") == k)

    def tops(self) -> DataFrame:
        """(grp, hash): the top node of each group."""
        return self.nodes().where("n = 1").select("grp", "hash")

    def blocks(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("block", F.expr(f"idx div {FAN**self.rise}"))

    def paths(self, leaves: DataFrame, tops: DataFrame, carried: tuple[str, ...] = ()) -> DataFrame:
        """``leaves`` (grp, idx, n, hash, ...) with path, the siblings from each up to its top and what ``tops`` (grp, path) puts after them.

        The columns ``carried`` of ``tops`` come with them.
        """
        tops = tops.join(leaves.where("idx = 0").select("grp", "n"), "grp").select("grp", F.lit(0).cast("long").alias("block"), "n", "path", *carried)
        above = None
        for k in range(self.passes - 1, -1, -1):
            span = FAN ** (self.rise * k)
            own = tops.where((F.col("n") > (span if k else 0)) & (F.col("n") <= span * FAN**self.rise)).drop("n")
            above = own if above is None else own.unionByName(above)
            rows = self.blocks(leaves if k == 0 else self.level(k * self.rise).where("n > 1").drop("level"))
            lead = above.withColumns({"lead": F.lit(0)})
            both = lead.unionByName(rows.withColumn("lead", F.lit(1)), allowMissingColumns=True)
            dealt = both.repartition("grp", "block").sortWithinPartitions("grp", "block", "lead", "idx")
            made = dealt.mapInArrow(partial(_descending, self.rise, carried), _schema(both))
            if k == 0:
                return made.drop("lead", "block")
            above = save(made.select("grp", F.col("idx").alias("block"), "path", *carried))
        return leaves.limit(0).withColumn("path", F.lit(""))


def grow(leaves: DataFrame, rise: int = RISE) -> Tree:
    """The node store over leaves (grp, idx, n, hash), its level 0."""
    tree = Tree(leaves.sparkSession, scratch_path(leaves.sparkSession), rise)
    put = lambda nodes: nodes.select("grp", "idx", "n", "hash", "level").write.mode("append").partitionBy("level").parquet(tree.path)
    put(leaves.withColumn("level", F.lit(0)))
    while True:
        below = tree.blocks(tree.level(tree.passes * rise).where("n > 1"))
        most = below.agg(F.max("n")).first()[0] or 0
        tree.passes += 1
        if most:
            dealt = below.repartition("grp", "block").sortWithinPartitions("grp", "block", "idx")
            put(dealt.mapInArrow(partial(_climbing, rise), _NODE))
        if most <= FAN**rise:
            return tree


@dataclass
class Manifest:
    """``leaves`` (grp, doc_id, hash, other, idx, n), their trees, the tree of the sources and its ``sources`` (grp, idx, n, hash)."""

    leaves: DataFrame
    tree: Tree
    sources: DataFrame
    source_tree: Tree
    root: str | None


def build(docs: DataFrame, rise: int = RISE) -> Manifest:
    """The manifest of docs (doc_id, source, lang, n_chars, text).

    Every source is a group, the null one first. Leaves ascend by doc_id, null
    first, those of one doc_id by digest; repeated rows are leaves of their own.
    """
    small_batches(docs.sparkSession)
    fields = {f: F.col(f) for f in _LEAF_FIELDS}
    own = leaf(**fields)
    # a text without line ends keeps its leaf
    other = F.when(F.col("text").contains("\n"), leaf(**(fields | {"text": tampered(F.col("doc_id"), F.col("text"))})))
    grp = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    rows = docs.select(grp.alias("grp"), F.col("doc_id").cast("long").alias("doc_id"), own.alias("hash"), other.alias("other"))
    rows = save(rows.groupBy("grp", "doc_id", "hash", "other").agg(F.count("*").alias("times")))
    leaves = coordinates(rows, ["doc_id", "hash", "other"])
    tree = grow(leaves, rise)
    tops = save(tree.tops().select(F.lit("").alias("grp"), F.col("grp").alias("source"), "hash", F.lit(1).cast("long").alias("times")))
    sources = coordinates(tops, ["source"])
    source_tree = grow(sources.select("grp", "idx", "n", "hash"), rise)
    root = source_tree.tops().first()  # one digest by definition
    return Manifest(leaves, tree, sources, source_tree, root and root.hash)


def proofs(made: Manifest) -> DataFrame:
    """Every leaf (doc_id, hash, other, idx, n) with path, its siblings up to the root, and source_idx, n_sources, subroot, root."""
    above = made.source_tree.paths(made.sources, made.sources.where("idx = 0").select("grp", F.lit("").alias("path")))
    tops = above.select(F.col("source").alias("grp"), "path", F.col("idx").alias("source_idx"), F.col("n").alias("n_sources"), F.col("hash").alias("subroot"))
    return made.tree.paths(made.leaves, tops, ("source_idx", "n_sources", "subroot")).withColumn("root", F.lit(made.root))


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of every proof, and the root that the leaf as found leads to."""
    for b in batches:
        digests, roots = [], []
        for node, other, idx, n, at, of, path in zip(*(b.column(c).to_pylist() for c in ("hash", "other", "idx", "n", "source_idx", "n_sources", "path")), strict=True):
            digests.append(_digest(path))
            top, rest = fold(other or node, idx, n, path)
            roots.append(fold(top, at, of, rest)[0])
        yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc_id", "hash", "subroot", "root")), pa.array(digests, pa.string()), pa.array(roots, pa.string())], ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root"])


def verify(made: Manifest) -> DataFrame:
    """Every row's proof, and whether its leaf as found (``other``, else the original one) still leads to the root.

    Defined cases: null fields are written ``-``; an empty text is no null; a
    dataset of one row is its own root, with the proof of no siblings; an empty
    table gives no row; columns outside the leaf are ignored.
    """
    found = proofs(made).mapInArrow(_folded, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string")
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


_BITS = "list_reduce([xor(a, b)] || [CAST(x AS BIGINT) FOR x IN range(8)], lambda c, _: xor(c >> 1, 3988292384 * (c & 1)))"
_CRC = f"xor(list_reduce([4294967295::BIGINT] || [CAST(ascii(c) AS BIGINT) FOR c IN string_split(CAST(doc_id AS VARCHAR), '')], lambda a, b: {_BITS}), 4294967295)"
_LEAF_SQL = "sha256(" + " || ".join(f"coalesce(strlen(CAST({f} AS VARCHAR)) || ':' || {f}, '-')" for f in _LEAF_FIELDS) + ")"
_UP = "SELECT g, level + 1, idx // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY idx)) FROM {0} WHERE n > 1 GROUP BY g, level, idx // 3, n"
_WALK = """SELECT w.k, w.g, w.level + 1, w.idx // 3, (w.n + 2) // 3, w.path || array_to_string(r.m[1:w.idx % 3], '') || array_to_string(r.m[w.idx % 3 + 2:], ''),
 sha256(array_to_string(r.m[1:w.idx % 3], '') || w.f || array_to_string(r.m[w.idx % 3 + 2:], '')) FROM {0} w JOIN runs r ON r.g = w.g AND r.level = w.level AND r.run = w.idx // 3 WHERE w.n > 1"""
#: The same from the definition: both trees level by level, and a walk from every leaf to the root.
OP13_SQL = f"""
WITH RECURSIVE own AS (SELECT doc_id, coalesce('=' || source, '') AS g, {_LEAF_SQL} AS leaf, CASE WHEN {_CRC} % 2 = 0 THEN {_LEAF_SQL.replace("text", "replace(text, chr(10), '')")} END AS other FROM documents),
leaves AS (SELECT *, row_number() OVER () AS k, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY g) AS n FROM own),
up(g, level, idx, n, h) AS (SELECT g, 0, idx, n, leaf FROM leaves UNION ALL {_UP.format("up")}),
tops AS (SELECT g AS source, h AS subroot, row_number() OVER (ORDER BY g) - 1 AS idx, count(*) OVER () AS n FROM up WHERE n = 1),
over_all(g, level, idx, n, h) AS (SELECT 'all', 0, idx, n, subroot FROM tops UNION ALL {_UP.format("over_all")}),
runs AS (SELECT g, level, idx // 3 AS run, list(h ORDER BY idx) AS m FROM (SELECT * FROM up UNION ALL SELECT * FROM over_all) GROUP BY g, level, idx // 3),
walk(k, g, level, idx, n, path, f) AS (SELECT k, g, 0, idx, n, '', coalesce(other, leaf) FROM leaves UNION ALL {_WALK.format("walk")}),
last(k, g, level, idx, n, path, f) AS (SELECT k, 'all', 0, t.idx, t.n, path, f FROM walk w JOIN tops t ON t.source = w.g WHERE w.n = 1 UNION ALL {_WALK.format("last")})
SELECT doc_id, leaf, subroot, o.h AS root, sha256(path) AS proof_sha256, f AS folded_root, f = o.h AS verified
FROM leaves JOIN tops ON source = leaves.g JOIN last ON last.k = leaves.k AND last.n = 1 JOIN over_all o ON o.n = 1
"""
