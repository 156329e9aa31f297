"""Joins of rows to a table with one row per key, whatever the keys' sizes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

HOT_KEYS = 1000


def join_by_key(rows: DataFrame, per_key: DataFrame, keys: list[str], count: str) -> DataFrame:
    """``rows`` with the columns of ``per_key`` (inner; null keys meet), which
    has one row per key and in ``count`` how many rows have it.

    The keys of more than one in ``HOT_KEYS`` rows are fewer than ``HOT_KEYS``,
    whatever the input: those few are broadcast and their rows stay where they
    are; all other rows meet their key by a shuffle, at most that share of them
    on one key.
    """
    total = per_key.agg(F.sum(count)).first()[0] or 0
    names = {k: f"_key_{k}" for k in keys}
    right = per_key.withColumnsRenamed(names)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()])
    often = F.col(count) * HOT_KEYS > total
    hot = right.where(often)
    met = rows.join(F.broadcast(hot), same)
    rest = rows.join(F.broadcast(hot.select(*names.values())), same, "left_anti").join(right.where(~often), same)
    return met.unionByName(rest).drop(count, *names.values())
