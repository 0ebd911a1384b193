"""Raw artifact scan, identity and source precedence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KINDS = ("bin", "log", "mer")
NAME = r"^(\d+\.\d+)-([A-Z]+)-(\d+)$"


def _exists(spark: SparkSession, root: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return files.exists(path) and files.getFileStatus(path).isDirectory()


def _glob(suffixes: tuple[str, ...]) -> str:
    """A name pattern for the suffixes in any case."""
    return "*.{" + ",".join("".join(f"[{c.lower()}{c.upper()}]" for c in x) for x in suffixes) + "}"


def parse_inputs(values: list[str]) -> list[str]:
    """File paths given one a value, or several with commas or blanks between; each once, in order."""
    return list(dict.fromkeys(x for v in values for x in v.replace(",", " ").split()))


#: Paths that are read one by one; for more, all files of their span of times are read.
FEW_PATHS = 10_000
_GLOB_SIGNS = set("[]{}*?\\")
SERIAL_LINE = r"\](?:buoy|board) (\d+\.\d+-[A-Z]+-\d+)"


def _reader(spark: SparkSession, root: str | list[str], kinds: tuple[str, ...]) -> DataFrame:
    reader = spark.read.format("binaryFile")
    if isinstance(root, str):
        if not _exists(spark, root):
            raise ValueError(f"input root is not a folder: {root}")
        reader = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", _glob(kinds))
    else:
        odd = [f for f in root if f.rpartition(".")[2].lower() not in kinds]
        if odd:
            raise ValueError(f"not a {', '.join(k.upper() for k in kinds)} file: {', '.join(odd)}")
    return reader.load(root)


def listing(spark: SparkSession, root: str | list[str], kinds: tuple[str, ...] = KINDS) -> DataFrame:
    """``discover`` without reading any file: path, size, modified_at and what the name says."""
    return named(_reader(spark, root, kinds).select(F.col("path").alias("source_path"), F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified_at")))


def contents(spark: SparkSession, root: str | list[str], wanted: DataFrame) -> DataFrame:
    """source_path, source_sha256, named_serial and content of the ``wanted`` files (source_path, modified_at) below ``root``.

    Few files are read by their paths, exactly. For many the folder is read
    within their span of modification times, which Spark applies before it opens
    a file; the result may then hold other files too.
    """
    few = [r.source_path for r in wanted.select("source_path").limit(FEW_PATHS + 1).collect()]
    if len(few) <= FEW_PATHS and not any(_GLOB_SIGNS & set(p) for p in few):
        files = spark.read.format("binaryFile").load(few) if few else spark.createDataFrame([], "path string, content binary")
    else:
        span = wanted.agg(F.unix_millis(F.min("modified_at")).alias("a"), F.unix_millis(F.max("modified_at")).alias("z")).first()
        files = _reader(spark, root, KINDS).where(F.col("modificationTime").between(F.timestamp_millis(F.lit(span.a)), F.timestamp_millis(F.lit(span.z))))
    is_log = F.lower(F.substring("path", -4, 4)) == ".log"
    return files.select(F.col("path").alias("source_path"), F.sha2(F.col("content").cast("binary"), 256).alias("source_sha256"), F.when(is_log, head_serial(F.col("content"))).alias("named_serial"), "content")


def head_serial(content: Column) -> Column:
    """The serial that a buoy or board line names among the first 32 lines, which alone are split off."""
    lines = F.slice(F.split(F.make_valid_utf8(content.cast("string")), r"\r\n|\r|\n", 33), 1, 32)
    return F.try_element_at(F.transform(F.filter(lines, lambda x: x.rlike(SERIAL_LINE)), lambda x: F.regexp_extract(x, SERIAL_LINE, 1)), F.lit(1))


def discover(spark: SparkSession, root: str | list[str], kinds: tuple[str, ...] = KINDS) -> DataFrame:
    """Every artifact below the folder ``root`` (or each listed file): path, kind, size, hash, content. Suffixes match in any case; files of no bytes hold nothing and are not listed."""
    return with_provenance(_reader(spark, root, kinds).select(F.col("path").alias("source_path"), F.col("length").alias("size_bytes"), "content"))


def count_kinds(files: DataFrame) -> DataFrame:
    """source_kind, n_files, n_bytes."""
    return files.groupBy("source_kind").agg(F.count("*").alias("n_files"), F.sum("size_bytes").alias("n_bytes"))


def vit_names(spark: SparkSession, root: str) -> DataFrame:
    """(prefix, serial) by the .vit files of the folder ``root`` itself; of two names for one prefix the last by path counts."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", _glob(("vit",))).load(root).select("path")
    name = instrument(F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.[^.]+$", ""))
    return rows.withColumn("i", name).where("i is not null").groupBy(F.col("i.number").alias("prefix")).agg(F.max_by("i.serial", "path").alias("serial"))


def named(files: DataFrame) -> DataFrame:
    """Adds what the path of ``files`` (source_path) says: source_file, source_kind, prefix, stem."""
    name = F.element_at(F.split("source_path", "/"), -1)
    return files.withColumns({"source_file": name, "source_kind": F.lower(F.regexp_extract(name, r"\.([^.]+)$", 1)), "prefix": F.split_part(name, F.lit("_"), F.lit(1)), "stem": F.lower(F.regexp_replace(name, r"\.[^.]+$", ""))})


def with_provenance(files: DataFrame) -> DataFrame:
    """``named`` with source_sha256 and source_id of the content."""
    digest = F.sha2(F.col("content").cast("binary"), 256)
    return named(files).withColumns({"source_sha256": digest, "source_id": F.concat(F.lit("sha256:"), digest)})


def authoritative(files: DataFrame) -> DataFrame:
    """A BIN shadows the LOG of the same prefix and stem."""
    bins = files.where("source_kind = 'bin'").select("prefix", "stem").distinct()
    logs = files.where("source_kind = 'log'").join(bins, ["prefix", "stem"], "left_anti")
    return files.where("source_kind <> 'log'").unionByName(logs.select(files.columns))


def decoded_owner(decoded: DataFrame, bins: DataFrame) -> DataFrame:
    """``decoded`` LOG files (prefix, stem, ...) with bin_path: the one BIN of the same prefix and stem, else the
    prefix's only BIN; anything else fails the job."""
    same = bins.groupBy("prefix", "stem").agg(F.count("*").alias("_n"), F.min("source_path").alias("_same"))
    sole = bins.groupBy("prefix").agg(F.count("*").alias("_all"), F.min("source_path").alias("_sole"))
    rows = decoded.join(same, ["prefix", "stem"], "left").join(sole, "prefix", "left")
    owner = F.when(F.col("_n") == 1, F.col("_same")).when(F.col("_n").isNull() & (F.col("_all") == 1), F.col("_sole"))
    fail = F.raise_error(F.concat(F.lit("no single BIN owns decoded LOG "), F.col("stem"))).cast("string")
    return rows.withColumn("bin_path", F.coalesce(owner, fail)).drop("_n", "_same", "_all", "_sole")


def instrument(name: Column) -> Column:
    """Struct (serial, instrument_id, code, number) of a name such as 452.020-P-06, else null.

    The id pads the number to what makes five characters with the code.
    """
    code, number = F.regexp_extract(name, NAME, 2), F.regexp_extract(name, NAME, 3)
    width = 5 - F.length(code)
    padded = F.when(F.length(number) < width, F.lpad(number, width, F.lit("0"))).otherwise(number)
    return F.when(name.rlike(NAME), F.struct(name.alias("serial"), F.concat(code, padded).alias("instrument_id"), code.alias("code"), number.alias("number")))


def identify(files: DataFrame, names: DataFrame | None = None, root: str = "", previous: DataFrame | None = None, sniffed: DataFrame | None = None) -> DataFrame:
    """Adds instrument_serial, one for all files of a prefix that name no other themselves.

    In this order: the name list by prefix, the root folder's own name if it has
    the prefix, the serial of the previous run, a folder on the file's path, the
    serial named in the first lines of a LOG of the prefix, the prefix itself.
    ``names`` and ``previous`` (prefix, serial) have one row an instrument,
    ``sniffed`` is (source_path, serial).
    """
    own = F.try_element_at(F.filter(F.split("source_path", "/"), lambda p: p.rlike(NAME)), F.lit(-1))
    base = root.rstrip("/").rpartition("/")[2]
    top = instrument(F.lit(base))
    rows = files.withColumns({"_part": own, "_root": F.when(top["number"] == F.col("prefix"), F.lit(base))})
    for given, column in ((names, "_vit"), (previous, "_old")):
        rows = rows.join(given.select("prefix", F.col("serial").alias(column)), "prefix", "left") if given is not None else rows.withColumn(column, F.lit(None).cast("string"))
    rows = rows.join(sniffed.select("source_path", F.col("serial").alias("_log")), "source_path", "left") if sniffed is not None else rows.withColumn("_log", F.lit(None).cast("string"))
    # folders and LOGs speak for all files of their prefix: the first by path
    group = rows.groupBy("prefix").agg(F.min_by("_part", F.when(F.col("_part").isNotNull(), F.col("source_path"))).alias("_parts"), F.min_by("_log", F.when(F.col("_log").isNotNull(), F.col("source_path"))).alias("_logs"))
    rows = rows.join(group, "prefix", "left")
    serial = F.coalesce("_vit", "_root", "_part", F.when(F.col("_old").rlike(NAME), F.col("_old")), "_parts", "_log", "_logs", "_old", "prefix")
    return rows.withColumn("instrument_serial", serial).select(*files.columns, "instrument_serial")


def belonging_to(files: DataFrame, serial: str) -> DataFrame:
    """The identified files of one instrument, asked for by its full serial."""
    return files.where(F.col("instrument_serial") == serial)


def serial_from_log(lines: DataFrame) -> DataFrame:
    """(source_path, serial) named by a buoy or board line among the first 32 lines."""
    found = F.regexp_extract("raw_line", SERIAL_LINE, 1)
    return lines.where("line_number <= 32").withColumn("serial", found).where("serial <> ''").groupBy("source_path").agg(F.min_by("serial", "line_number").alias("serial"))
