"""Files in and out: documents with fingerprints, gzip, JSON lines, snapshots, manifests, idempotent writes."""

from __future__ import annotations

import gzip
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import is_blank
from . import logs

FORMATS = ("pdf", "html", "htm")
#: Stage, kind and id in the name of a snapshot.
SNAPSHOT_NAME = r"^([A-D]\d{0,2}(?:\.\d)?)-([a-z-]+)-([0-9a-f-]+)\.json$"


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """Files under a path with format, SHA-256 and why a file is not accepted (null: it is). Spark's readers leave empty files
    out, so these come from the list of files."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    empty = [(name, 0, b"") for name, size in logs.file_sizes(path).items() if not size]
    if empty:
        none = spark.createDataFrame(empty, "path string, length long, content binary").withColumn("modificationTime", F.lit(None).cast("timestamp"))
        raw = raw.unionByName(none)
    form = F.lower(F.element_at(F.split("path", r"\."), -1))
    problem = F.when(~form.isin(*FORMATS), "unknown format").when(F.col("length") == 0, "empty")
    return raw.select("path", "length", "modificationTime", "content", form.alias("format"), F.sha2("content", 256).alias("sha"), problem.alias("problem"))


def list_files(spark: SparkSession, path: str, pattern: str = "*.pdf") -> DataFrame:
    """Names and sizes; contents are not read."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return raw.select(F.element_at(F.split("path", "/"), -1).alias("name"), "length")


def is_gzip(content) -> F.Column:
    return F.substring(content, 1, 2) == F.unhex(F.lit("1F8B"))


def unzipped(files: DataFrame) -> DataFrame:
    """Files with gzip-wrapped HTML unwrapped; what cannot be is a problem, not an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            contents, problems = batch.column("content").to_pylist(), batch.column("problem").to_pylist()
            for k, (c, form) in enumerate(zip(contents, batch.column("format").to_pylist(), strict=True)):
                if c and c[:2] == b"\x1f\x8b" and form in ("html", "htm"):
                    try:
                        contents[k] = gzip.decompress(c)
                    except (OSError, EOFError, zlib.error):
                        problems[k] = "corrupt gzip"
            put = {"content": pa.array(contents, pa.binary()), "problem": pa.array(problems, pa.string())}
            yield pa.RecordBatch.from_arrays([put.get(n, batch.column(n)) for n in batch.schema.names], names=batch.schema.names)

    return files.mapInArrow(run, files.schema)


def json_lines(texts: DataFrame) -> DataFrame:
    """Lines of whole log files (path, value): path, line_no, line, is_valid, is_tail. Blank lines are left out; a last
    line without an end that does not parse is a tail still being written, any other is corrupt."""
    lines = F.split("value", "\n")
    exploded = texts.select("path", F.size(lines).alias("n"), F.posexplode(lines).alias("line_no", "line"))
    parsed = F.try_parse_json("line")
    valid = parsed.isNotNull() & F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT"), F.lit(False))
    return exploded.where(~is_blank(F.col("line"))).select("path", "line_no", "line", valid.alias("is_valid"), ((F.col("line_no") == F.col("n") - 1) & ~valid).alias("is_tail"))


def read_events(spark: SparkSession, path: str, strict: bool = False, split: int = logs.SPLIT) -> DataFrame:
    """Valid lines of JSON-lines files, as path, line_no and a variant. A corrupt line is an error, and so is a tail if
    `strict`. Files are read in ranges of `split` bytes, whatever their size."""
    lines = logs.read_lines(spark, path, split)
    found = logs.checked(lines)
    broken = ~F.col("is_valid") & (F.lit(strict) | ~F.col("is_tail"))
    told = found.where(F.col("is_valid") | broken).withColumn("value", F.when(broken, F.raise_error(F.concat(F.lit("corrupt line at byte "), "offset", F.lit(" of "), "path")).cast("variant")).otherwise(F.col("value")))
    return logs.numbered(lines, told).select("path", "line_no", F.col("value").alias("event"))


def append_events(events: DataFrame, path: str) -> None:
    """Adds events to a log folder as JSON lines."""
    events.write.mode("append").json(path)


def snapshots(spark: SparkSession, path: str) -> DataFrame:
    """Snapshots of a folder by their names: stage, kind, id, in order of time and name."""
    return snapshot_names(spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("filename"), "modificationTime"))


def snapshot_names(files: DataFrame) -> DataFrame:
    part = lambda k: F.regexp_extract("filename", SNAPSHOT_NAME, k)
    return files.where(F.col("filename").rlike(SNAPSHOT_NAME)).select("filename", "modificationTime", part(1).alias("stage"), part(2).alias("kind"), part(3).alias("id")).orderBy("modificationTime", "filename")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """A tab-separated manifest, every column text."""
    return spark.read.csv(path, sep="\t", header=True, quote="", inferSchema=False)


def write_once(rows: DataFrame, root: str, sha: str, profile: str) -> str:
    """Writes rows for a content hash and profile, and then the row that says so; a second write replaces the first and
    leaves one result. Returns the folder."""
    folder = f"{root}/source_sha256={sha}/profile={profile}"
    rows.write.mode("overwrite").parquet(folder)
    spark = rows.sparkSession
    spark.createDataFrame([("completed",)], "status string").coalesce(1).write.mode("overwrite").parquet(f"{root}/_manifest/sha={sha}/profile={profile}")
    return folder
