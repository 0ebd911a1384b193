"""MER files as a Spark data source: ``spark.read.format("mer").load(path)``.

The source plans its partitions by the sizes of the files and frames each file
where it is read, so no row holds a whole file. A row is a block: the body of a
section, an event, or ``none`` for a file without either.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from pelagia.operators import mer

SCHEMA = "source_path string, block string, block_pos long, body string, info_line string, format_line string, payload binary, error string"
BLOCKS = ("environment", "parameter", "event", "none")
#: Bytes of the files of a partition; a larger file is one of its own.
PARTITION_BYTES = 128 << 20
#: Bytes of bodies and payloads of a batch; a larger block is one of its own.
BATCH_BYTES = 16 << 20
_SECTIONS = tuple((name, re.compile(rb"(?s)<%s>(.*?)</%s>" % (tag, tag))) for name, tag in (("environment", b"ENVIRONMENT"), ("parameter", b"PARAMETERS")))
_ARROW = pa.schema([(n, {"long": pa.int64(), "binary": pa.binary()}.get(k, pa.string())) for n, k in (c.split() for c in SCHEMA.split(", "))])


def blocks(data: bytes) -> Iterator[tuple]:
    """(block, block_pos, body, info_line, format_line, payload, error) of every block of a file."""
    empty = True
    for name, pattern in _SECTIONS:
        for pos, found in enumerate(pattern.finditer(data)):
            empty = False
            yield name, pos, found[1].decode("latin-1"), None, None, None, None
    for pos, info, form, payload, error in mer.frame_events(data):
        empty = False
        yield "event", pos, None, info, form, payload, error
    if empty:
        yield "none", 0, None, None, None, None, mer.NOTHING


@dataclass
class _Files(InputPartition):
    """(path, size) of the files of one task."""

    files: list[tuple[str, int]]


def _file_system(root: str):
    """The file system of a path, the path in it, and what stands before such paths in Spark's names."""
    from pyarrow import fs

    scheme, host = urlsplit(root)[:2] if re.match(r"[A-Za-z][A-Za-z0-9+.-]+:/", root) else ("", "")
    if scheme in ("", "file"):
        return fs.LocalFileSystem(), os.path.abspath(re.sub("^file:/*", "/", root)), "file:"
    system, path = fs.FileSystem.from_uri(root)
    return system, path, f"{scheme}://{host if path.startswith('/') else ''}"


class MerReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        if not options.get("path"):
            raise ValueError("the mer source needs a path")
        self.root, self.strict = options["path"], options.get("mode", "recoverable").lower()
        if self.strict not in ("strict", "recoverable"):
            raise ValueError(f"mode is strict or recoverable, not {self.strict}")
        self.wanted = tuple(x.strip() for x in options.get("blocks", ",".join(BLOCKS)).split(","))
        if set(self.wanted) - set(BLOCKS):
            raise ValueError(f"blocks are of {', '.join(BLOCKS)}")
        self.bytes = int(options.get("partitionbytes", PARTITION_BYTES))

    def partitions(self) -> list[_Files]:
        from pyarrow import fs

        system, path, _ = _file_system(self.root)
        info = system.get_file_info(path)
        if info.type == fs.FileType.NotFound:
            raise ValueError(f"no such path: {self.root}")
        found = [info] if info.is_file else system.get_file_info(fs.FileSelector(path, recursive=True))
        parts, held = [], 0
        for f in sorted((f for f in found if f.is_file and f.path.lower().endswith(".mer") and f.size), key=lambda f: (-f.size, f.path)):
            if not parts or held + f.size > self.bytes:
                parts.append(_Files([]))
                held = 0
            parts[-1].files.append((f.path, f.size))
            held += f.size
        return parts or [_Files([])]

    def read(self, partition: _Files) -> Iterator[pa.RecordBatch]:
        system, _, before = _file_system(self.root)
        rows, held = [], 0
        for path, size in partition.files:
            with system.open_input_stream(path) as f:
                data = f.read()
            if len(data) != size:  # a task that is run again must give the same rows
                raise RuntimeError(f"{before}{path} has changed since the read was planned")
            for block in blocks(data):
                if block[-1] is not None and self.strict == "strict":
                    raise ValueError(f"malformed MER block in {before}{path}: {block[-1]}")
                if block[0] not in self.wanted:
                    continue
                rows.append((before + path, *block))
                held += len(block[2] or "") + len(block[5] or b"")
                if held >= BATCH_BYTES:
                    yield self._batch(rows)
                    rows, held = [], 0
        if rows:
            yield self._batch(rows)

    def _batch(self, rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _ARROW.types, strict=True)], schema=_ARROW)


class MerDataSource(DataSource):
    """Options: ``path`` (a file or a folder, searched whole), ``mode`` (recoverable: the error stands
    in the row; strict: the job ends at the first one), ``blocks`` (names with commas; others are not sent
    to Spark), ``partitionBytes``."""

    @classmethod
    def name(cls) -> str:
        return "mer"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> MerReader:
        return MerReader({k.lower(): v for k, v in self.options.items()})


def register(spark: SparkSession) -> None:
    """Make the format known to a session; doing so again changes nothing."""
    spark.dataSource.register(MerDataSource)


def framed(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(metadata lines, events, files without either) below ``root``, as ``mer.sections``, ``mer.events`` and ``mer.hopeless`` give them."""
    register(spark)

    def read(names: str) -> DataFrame:
        return spark.read.format("mer").option("blocks", names).load(root)

    lines = mer.section_lines(read("environment,parameter").select("source_path", F.col("block").alias("section"), F.col("block_pos").cast("int").alias("body_pos"), "body"))
    events = read("event").select("source_path", F.col("block_pos").alias("event_pos"), "info_line", "format_line", "payload", "error")
    return lines, events, read("none").select("source_path", "error")
