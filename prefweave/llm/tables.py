"""Shared-folder tables and column checks used by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from prefweave.session import scratch_path


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def need(df: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns (an operator ignores any others)."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.select(*[F.col(f"`{c}`") for c in columns])


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: later steps start
    from files that survive a lost executor instead of recomputing."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def split_crc(doc_id: str = "doc_id"):
    """crc32 of the id's text, modulo 5; 0 marks the held-out rows."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5
