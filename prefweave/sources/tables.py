"""Read the driver-provided parquet tables with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from prefweave.schemas import TABLES
from prefweave.session import scratch_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: it is built once
    however often it is used, and survives a lost executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
