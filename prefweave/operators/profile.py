"""Dataset preview and size per split."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def profile(splits: Mapping[str, DataFrame], key: str = "pair_id") -> DataFrame:
    """Row count, character-length range per field and the first row by key.

    DataFrames have no "row 0"; the preview is the row with the smallest key.
    """
    parts = []
    for name, df in splits.items():
        aggs = [F.count(F.lit(1)).alias("n_rows")]
        for c in ("prompt", "chosen", "rejected"):
            aggs += [F.min(F.length(c)).cast("bigint").alias(f"min_{c}_chars"),
                     F.max(F.length(c)).cast("bigint").alias(f"max_{c}_chars")]
        aggs += [F.min(key).alias(f"first_{key}")]
        aggs += [F.min_by(c, key).alias(f"first_{c}") for c in ("prompt", "chosen", "rejected")]
        parts.append(df.agg(*aggs).select(F.lit(name).alias("split"), "*"))
    return reduce(DataFrame.unionByName, parts)
