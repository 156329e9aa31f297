"""The training metric log (M3) as a Structured Streaming query.

A trainer appends log-probability files while it runs; this query keeps the
per-interval means up to date. The running aggregate lives in the state store
(on executors, checkpointed to the shared folder), and a restart resumes from the
checkpoint. Steps are a counter, not event time, so there is no watermark: the
result table has one row per logging interval.

Each micro-batch publishes only the blocks that it changed: into a folder of its
own attempt, announced afterwards in a file named by the epoch. So a block stands
in the epochs that had rows of it, and after its last step, once closed, in none
that follow (unless late rows come, which are never dropped: the corrected block is
published again). Readers take each block from its last announced epoch, so they
see neither a batch in the middle of its write nor one that is tried again; an
epoch that is written twice counts once. Every ``COMPACT_EVERY`` epochs the table
is published whole, and readers begin there.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from prefweave import constants as C
from prefweave.operators.metrics import metric_log, preference_metrics
from prefweave.schemas import TABLES
from prefweave.session import scratch_path
from prefweave.sources.fixtures import logprobs_from_embeddings
from prefweave.sources.records import path_exists


def metric_log_stream(logprobs: DataFrame, every: int = C.LOGGING_STEPS, beta: float = C.BETA) -> DataFrame:
    """Streaming DataFrame of interval means; same columns as ``metric_log``."""
    return metric_log(preference_metrics(logprobs, beta), every)


ANNOUNCED = "epoch bigint, folder string, whole boolean"
COMPACT_EVERY = 50             # epochs between two whole tables
BLOCK = "log_step"


def publish(batch: DataFrame, epoch: int, out: str, compact_every: int = COMPACT_EVERY) -> None:
    """Write the changed blocks and announce them as those of ``epoch``; with
    those of the epochs before it where the table is due to be written whole."""
    spark, whole = batch.sparkSession, (epoch + 1) % compact_every == 0
    folder = f"epoch-{epoch:09d}-{uuid.uuid4().hex[:12]}"
    if whole:
        before = read_published(spark, out, batch.schema, before=epoch)
        batch = batch.persist()                 # the merge reads it twice
        rest = before.join(batch.select(BLOCK), BLOCK, "left_anti").select(*batch.columns)
        rest.unionByName(batch).write.parquet(f"{out}/tables/{folder}")
        batch.unpersist()
    else:
        batch.write.parquet(f"{out}/tables/{folder}")
    entry = spark.createDataFrame([(epoch, folder, whole)], ANNOUNCED)
    entry.coalesce(1).write.json(f"{out}/announced/{folder}")


def announced(spark: SparkSession, out: str) -> list[tuple[int, str, bool]]:
    """(epoch, folder, whether it holds the whole table) of every announced
    epoch, in order. Of an epoch written twice the first by name counts."""
    if not path_exists(spark, f"{out}/announced"):
        return []
    rows = spark.read.schema(ANNOUNCED).option("recursiveFileLookup", "true").json(f"{out}/announced")
    first = {r["epoch"]: (r["epoch"], r["folder"], r["whole"])
             for r in sorted(rows.collect(), key=lambda r: r["folder"], reverse=True)}
    return [first[e] for e in sorted(first)]


def published_epochs(spark: SparkSession, out: str, schema: StructType, before: int | None = None) -> DataFrame:
    """The published blocks with the ``epoch`` of each, from the last whole table
    on (of the epochs before ``before``)."""
    known = [k for k in announced(spark, out) if before is None or k[0] < before]
    start = max((e for e, _, whole in known if whole), default=-1)
    paths = [f"{out}/tables/{folder}" for e, folder, _ in known if e >= start]
    if not paths:
        return spark.createDataFrame([], schema).withColumn("epoch", F.lit(0).cast("bigint"))
    epoch = F.regexp_extract("_metadata.file_path", r"/epoch-([0-9]+)-[0-9a-f]+/[^/]*$", 1).cast("bigint")
    return spark.read.schema(schema).parquet(*paths).withColumn("epoch", epoch)


def read_published(spark: SparkSession, out: str, schema: StructType, before: int | None = None) -> DataFrame:
    """The log as announced by now: of each block the row of its last epoch;
    empty, with its columns, before the first."""
    rows = published_epochs(spark, out, schema, before)
    last = rows.groupBy(BLOCK).agg(F.max_by(F.struct(*schema.names), "epoch").alias("row"))
    return last.select("row.*")


def closed_blocks(spark: SparkSession, out: str, schema: StructType) -> DataFrame:
    """The blocks whose last step has arrived, each once."""
    return read_published(spark, out, schema).where("complete")


def run_metric_log_stream(spark: SparkSession, directory: str, file_glob: str = "*.parquet",
                          every: int = C.LOGGING_STEPS, beta: float = C.BETA,
                          out: str | None = None, checkpoint: str | None = None,
                          max_files_per_trigger: int = 100, compact_every: int = COMPACT_EVERY) -> DataFrame:
    """Drain the files in ``directory`` matching ``file_glob`` (embeddings
    layout) once and return the published table.

    Uses ``trigger(availableNow=True)``: every file present is processed in
    micro-batches of at most ``max_files_per_trigger`` files (bounded memory
    per batch, without paying per-batch overhead for every file), then the
    query stops.
    """
    out = out or scratch_path(spark, "metric-log")
    checkpoint = checkpoint or f"{out}-checkpoint"
    src = (spark.readStream.schema(TABLES["embeddings"])
           .option("maxFilesPerTrigger", max_files_per_trigger)
           .option("pathGlobFilter", file_glob).parquet(directory))
    agg = metric_log_stream(logprobs_from_embeddings(src), every, beta)
    q = (agg.writeStream.outputMode("update")
         .foreachBatch(lambda batch, epoch: publish(batch, epoch, out, compact_every))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return read_published(spark, out, agg.schema)
