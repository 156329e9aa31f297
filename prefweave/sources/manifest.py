"""Prepared rows per input file, kept in step with a growing table.

A table's files are known by path, size and time. Rows that a file gives are
built once and kept in a folder of its own; a small manifest says which files'
folders are complete. When the table is read again, the listing is compared with
the manifest: files known to it cost nothing (their contents are not opened),
new and changed ones are built in one job, and folders of files that are gone
or have changed can be collected.

Every build writes into a folder of its own attempt and is announced after it;
of two attempts at one file the first by name counts, so builders that run at
the same time, or die, never double or lose a row. Removals are announced too,
before the folder goes.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from prefweave.session import shared_root
from prefweave.sources.records import CACHE_VERSION, _missing, fingerprint

FILE = "_file"
ENTRY = "file string, attempt string, rows bigint, gone boolean"


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """``path`` and ``file``, a fingerprint of path, size and time, of every
    data file under a path. No file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    name = F.element_at(F.split("path", "/"), -1)
    state = F.concat_ws("|", "path", "length", F.unix_micros("modificationTime"))
    return files.where(~name.startswith("_") & ~name.startswith(".")).select("path", F.sha2(state, 256).alias("file"))


@dataclass(frozen=True)
class PreparedFiles:
    """One prepared table: ``rows`` of all files, which ``files`` gave them, how
    many of them were ``built`` just now."""
    rows: DataFrame
    state: str
    files: int
    built: int


class FileTable:
    """Rows that ``build`` gives for each file of a table, kept under ``root``.

    ``read`` opens a list of files; ``build`` maps rows one by one (no row may
    depend on another) and keeps their column ``_path``.
    ``params`` names everything but the files that the rows depend on.
    """

    def __init__(self, spark: SparkSession, read: Callable[[list[str]], DataFrame],
                 build: Callable[[DataFrame], DataFrame], name: str, params: Mapping, schema: StructType,
                 root: str | None = None):
        self.spark, self.read, self.build, self.schema = spark, read, build, schema
        base = (root or shared_root(spark)).rstrip("/")
        self.base = f"{base}/prefweave/{name}-{fingerprint({**params, 'cache_version': CACHE_VERSION})}"

    def manifest(self) -> DataFrame:
        """``file, attempt, rows`` of the complete folders that have not gone."""
        try:
            entries = self.spark.read.schema(ENTRY).option("recursiveFileLookup", "true").json(f"{self.base}/manifest")
        except AnalysisException as error:
            if not _missing(error):
                raise
            entries = self.spark.createDataFrame([], ENTRY)
        live = entries.groupBy("file", "attempt").agg(F.max("gone").alias("gone"), F.max("rows").alias("rows"))
        first = live.where(~F.col("gone")).groupBy("file").agg(F.min(F.struct("attempt", "rows")).alias("e"))
        return first.select("file", "e.attempt", "e.rows")

    def _announce(self, entries: DataFrame) -> None:
        entries.select("file", "attempt", "rows", "gone").write.json(f"{self.base}/manifest/{uuid.uuid4().hex}")

    def _folder(self, file: str, attempt: str) -> str:
        return f"{self.base}/{attempt}/{FILE}={file}"

    def _build(self, missing: list) -> None:
        attempt = uuid.uuid4().hex
        paths = {r["path"]: r["file"] for r in missing}
        known = self.spark.createDataFrame(list(paths.items()), "_path string, _known string")
        rows = self.read([literal(p) for p in paths]).withColumn("_path", F.input_file_name())
        # One row per input file, so the names' table is as small as the list of
        # files that the driver hands to the reader anyway.
        known = known.withColumn("_path", _rooted(F.col("_path")))
        named = self.build(rows.withColumn("_path", _rooted(F.url_decode(F.replace(F.col("_path"), F.lit("+"), F.lit("%2B")))))).join(
            F.broadcast(known), "_path")
        named.select(*self.schema.fieldNames(), F.col("_known").alias(FILE)).write.partitionBy(FILE).parquet(
            f"{self.base}/{attempt}")
        written = self.spark.read.schema(StructType([StructField(FILE, StringType())])).parquet(f"{self.base}/{attempt}")
        counts = written.groupBy(FILE).agg(F.count(F.lit(1)).alias("rows")).withColumnRenamed(FILE, "file")
        self._announce(known.select(F.col("_known").alias("file")).join(F.broadcast(counts), "file", "left").select(
            "file", F.lit(attempt).alias("attempt"), F.coalesce("rows", F.lit(0).cast("bigint")).alias("rows"),
            F.lit(False).alias("gone")))

    def refresh(self, path: str) -> PreparedFiles:
        """The rows of the files now under ``path``; only files that the manifest
        does not know are read."""
        listed = list_files(self.spark, path)
        missing = listed.join(self.manifest(), "file", "left_anti").select("path", "file").collect()
        if missing:
            self._build(missing)
        now = (listed.join(self.manifest(), "file").select("file", "attempt", "rows").orderBy("file").collect())
        folders = [self._folder(r["file"], r["attempt"]) for r in now if r["rows"]]
        rows = (self.spark.read.schema(self.schema).parquet(*folders) if folders
                else self.spark.createDataFrame([], self.schema))
        return PreparedFiles(rows, fingerprint({r["file"]: r["attempt"] for r in now}), len(now), len(missing))

    def collect_stale(self, path: str) -> int:
        """Remove the folders of files that are no longer under ``path`` as they
        were, and of attempts that others were ahead of; returns how many. Not
        while readers of an earlier ``refresh`` are at work."""
        listed = list_files(self.spark, path)
        try:
            entries = self.spark.read.schema(ENTRY).option("recursiveFileLookup", "true").json(f"{self.base}/manifest")
        except AnalysisException as error:
            if not _missing(error):
                raise
            return 0
        gone = entries.where("gone").select("file", "attempt")
        used = self.manifest().join(listed.select("file").distinct(), "file").select("file", "attempt")
        stale = (entries.where("not gone").select("file", "attempt").distinct()
                 .join(gone, ["file", "attempt"], "left_anti").join(used, ["file", "attempt"], "left_anti")).collect()
        if stale:
            self._announce(self.spark.createDataFrame([(r["file"], r["attempt"], 0, True) for r in stale], ENTRY))
        for r in stale:
            _delete(self.spark, self._folder(r["file"], r["attempt"]))
        return len(stale)


def _rooted(path: Column) -> Column:
    """A path with one slash after its scheme, as readers differ in that."""
    return F.regexp_replace(path, r"^([A-Za-z]+):/+", "$1:/")


def literal(path: str) -> str:
    """A path for a reader, with its glob characters taken as they are."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def _delete(spark: SparkSession, path: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
