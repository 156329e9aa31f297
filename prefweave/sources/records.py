"""Preference datasets on disk.

S1 ``read_pairs``: a split of a pair dataset from parquet or JSON lines.
S2 ``read_records`` / S3 ``write_records``: JSON-lines record files.
S4 ``materialize``: build once, write, and always read back, so a fresh build
and a cached one behave the same. Unlike fixed file names, the cache path
carries a fingerprint of everything the build depends on, its input included.
"""

from __future__ import annotations

import hashlib
import json
import os
import uuid
from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from prefweave.schemas import PAIR, TRIPLET
from prefweave.session import shared_root

CORRUPT = "_corrupt_record"


def pair_key() -> Column:
    """A bigint key from a pair's content: the first 60 bits of its JSON's md5.
    Equal pairs get equal keys."""
    content = F.to_json(F.struct("chosen", "rejected"), {"ignoreNullFields": "false"})
    return F.conv(F.substring(F.md5(content), 1, 15), 16, 10).cast("bigint")


def read_pairs(spark: SparkSession, path: str, fmt: str = "parquet",
               split: str | None = None) -> DataFrame:
    """Read a pair dataset; ``split`` selects a sub-directory (``path/split``).
    Rows without ``pair_id`` (plain chosen/rejected files) get ``pair_key()``."""
    full = f"{path.rstrip('/')}/{split}" if split else path
    if fmt == "json":
        rows = read_records(spark, full, PAIR)
    else:
        rows = spark.read.schema(PAIR).format(fmt).load(full)
    return rows.withColumn("pair_id", F.coalesce("pair_id", pair_key()))


def read_records(spark: SparkSession, path: str | list[str], schema: StructType = TRIPLET) -> DataFrame:
    """JSON-lines records; a line that does not parse fails the job, named in
    the error. ``read_lines`` keeps such lines instead."""
    rows = read_lines(spark, path, schema)
    # Spark refuses to read the bad lines' column alone, as a bare count would;
    # naming what was parsed of the line keeps a second column in the scan.
    parsed = F.to_json(F.struct(F.col(f"`{schema.fields[0].name}`")))
    message = F.concat(F.lit("bad record: "), F.col(CORRUPT), F.lit("; parsed: "), parsed)
    ok = F.when(F.col(CORRUPT).isNotNull(), F.raise_error(message).cast("boolean"))
    return rows.where(F.coalesce(ok, F.lit(True))).drop(CORRUPT)


def read_lines(spark: SparkSession, path: str | list[str], schema: StructType = TRIPLET) -> DataFrame:
    """The records with ``_corrupt_record``: null, or the text of a bad line."""
    return (spark.read.schema(StructType([*schema.fields, StructField(CORRUPT, StringType())]))
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).json(path))


def write_records(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).json(path)


def fingerprint(params: Mapping) -> str:
    blob = json.dumps(params, sort_keys=True, default=str).encode()
    return hashlib.sha256(blob).hexdigest()[:16]


def content_state(df: DataFrame) -> str:
    """Row count and a sum of row hashes: changes with any row, not with order
    or partitioning. One pass with map-side partials."""
    row = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("decimal(38,0)")
    n, total = df.agg(F.count(F.lit(1)), F.sum(row)).first()
    return f"{n}:{total}"


def file_state(spark: SparkSession, path: str) -> str:
    """State of the files under a path: names, sizes and modification times; no
    file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return content_state(files.select("path", "length", "modificationTime"))


def _missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or directory exists, through the public reader API (a
    missing path fails analysis; no job runs)."""
    try:
        spark.read.format("text").load(path).columns
        return True
    except AnalysisException as error:
        if not _missing(error):
            raise
        return False


# Bump when the meaning of a cached output changes, so old caches are never served.
CACHE_VERSION = "5"


def _built(spark: SparkSession, base: str, write: Callable[[str], dict | None]) -> tuple[str, dict]:
    """The folder of a complete write under ``base``, written now if there is
    none, and what ``write`` returned then. Every attempt has its own folder and
    is announced last, by a small file of its own, so concurrent builders and
    failed ones never meet."""
    def announced() -> dict | None:
        try:
            done = spark.read.option("recursiveFileLookup", "true").text(f"{base}/announced")
        except AnalysisException as error:
            if not _missing(error):
                raise
            return None
        first = done.agg(F.min("value")).first()[0]
        return None if first is None else json.loads(first)

    entry = announced()
    if entry is None:
        attempt = uuid.uuid4().hex
        entry = {"attempt": attempt, "about": write(f"{base}/{attempt}") or {}}
        line = json.dumps(entry, sort_keys=False)
        spark.range(1).select(F.lit(line).alias("value")).write.text(f"{base}/announced/{attempt}")
    return f"{base}/{entry['attempt']}", entry["about"]


def _base(spark: SparkSession, name: str, params: Mapping, root: str | None, fmt: str) -> str:
    tag = {"cache_version": CACHE_VERSION, "fmt": fmt,
           "run_tag": os.environ.get("PREFWEAVE_RUN_TAG", "")}
    return f"{(root or shared_root(spark)).rstrip('/')}/prefweave/{name}-{fingerprint({**params, **tag})}"


def materialize(spark: SparkSession, build: Callable[[], DataFrame],
                name: str, params: Mapping, schema: StructType = TRIPLET,
                splits: tuple[str, ...] = ("train", "test"), split_col: str = "split",
                root: str | None = None, fmt: str = "json",
                count: tuple[str, ...] = ()) -> "Materialized":
    """The splits read from ``root/name-<fingerprint>``.

    ``build`` returns one DataFrame with a ``split_col`` column; it is written in
    a single job partitioned by it (so the plan behind it runs once), unless a
    complete earlier write with the same fingerprint exists. ``params`` must
    name everything that the rows depend on, the input's state included. Splits
    are always read back with the explicit schema. ``fmt`` is ``json`` (record
    files, as the reference writes them) or ``parquet`` (columnar, faster to
    scan at scale). The rows of each value in ``count`` are counted by the write
    itself, and the counts kept with it.
    """
    if fmt not in ("json", "parquet"):
        raise ValueError(f"unsupported format {fmt!r}")

    def write(path: str) -> dict:
        df, seen = build(), Observation()
        if count:
            df = df.observe(seen, *[F.count(F.when(F.col(split_col) == v, 1)).alias(v) for v in count])
        df.write.partitionBy(split_col).format(fmt).save(path)
        return {v: int(n or 0) for v, n in seen.get.items()} if count else {}

    path, counts = _built(spark, _base(spark, name, params, root, fmt), write)
    return Materialized(spark, path, schema, split_col, fmt, splits, counts)


class Materialized(dict):
    """``{split: DataFrame}`` of one written folder. ``counts``: rows by value of
    the split column, if asked for; ``state``: names the written rows, so that
    later steps need not look at them to know them; ``others``: the rows of every
    other value."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, split_col: str, fmt: str,
                 splits: tuple[str, ...], counts: dict[str, int]):
        self.spark, self.path, self.state, self.counts = spark, path, path, counts
        self.schema, self.split_col, self.fmt, self.splits = schema, split_col, fmt, splits
        super().__init__({s: self._split(s) for s in splits})

    def _split(self, name: str) -> DataFrame:
        try:                     # one listing; a split without rows has no folder
            return self.spark.read.schema(self.schema).format(self.fmt).load(f"{self.path}/{self.split_col}={name}")
        except AnalysisException as error:
            if not _missing(error):
                raise
            return self.spark.createDataFrame([], self.schema)

    def others(self, *columns: str) -> DataFrame:
        """``columns`` and the split column of the rows outside ``splits``; only
        their folders are read."""
        kept = [f for f in self.schema.fields if f.name in columns]
        rows = self.spark.read.schema(StructType([*kept, StructField(self.split_col, StringType())]))
        return rows.format(self.fmt).load(self.path).where(~F.col(self.split_col).isin(*self.splits))


def materialize_table(spark: SparkSession, build: Callable[[], DataFrame], name: str,
                      params: Mapping, schema: StructType, root: str | None = None,
                      fmt: str = "parquet") -> DataFrame:
    """Write an expensive derived table once (per fingerprint) to the shared
    folder and read it back with its explicit schema. Cuts the lineage, so
    every later job starts from plain files instead of recomputing."""
    path, _ = _built(spark, _base(spark, name, params, root, fmt),
                     lambda p: build().write.format(fmt).save(p))
    return spark.read.schema(schema).format(fmt).load(path)
