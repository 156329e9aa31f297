"""The random permutation of a dataset as a function of position (L1).

A row at position ``pos`` of 0..n-1 goes to place ``permutation(pos)``: a Feistel
network over the numbers below a * b, for a and b near the root of n. Each
round adds a keyed hash of one half to the other, so every round, and the whole,
is one to one. Numbers from n on, fewer than the root of n, are not places: a
position that lands on one walks on until it meets a place. Where each of them
ends is a small table made beforehand, so a row needs no loop.

A place is computed from its position alone: no sort, no exchange, and the same
in any engine with 64-bit integers.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

ROUNDS = 8
PRIME = (1 << 31) - 1


def sides(n: int) -> tuple[int, int]:
    """a and b with a * b >= n > a * b - a, for n of at least 1."""
    a = math.isqrt(n - 1) + 1
    return a, -(-n // a)


def round_keys(seed: int, rounds: int = ROUNDS) -> list[tuple[int, int, int]]:
    """Three keys below the prime for each round."""
    out = []
    for r in range(rounds):
        d = hashlib.md5(f"{seed}:{r}".encode()).digest()
        out.append(tuple(1 + int.from_bytes(d[i:i + 4], "big") % (PRIME - 1) for i in (0, 4, 8)))
    return out


def _hash(x, key: tuple[int, int, int]):
    """Below the prime; of integers, arrays of them, or Columns."""
    k, m, c = key
    t = (x + k) % PRIME
    return (t * t % PRIME * m + c) % PRIME


def network(left, right, a: int, b: int, keys: list[tuple[int, int, int]]):
    for r, key in enumerate(keys):
        if r % 2 == 0:
            left = (left + _hash(right, key)) % a
        else:
            right = (right + _hash(left, key)) % b
    return left, right


def ends_of_walks(n: int, seed: int, rounds: int = ROUNDS) -> np.ndarray:
    """For each number from n to a * b - 1 the place that its walk ends at."""
    a, b = sides(n)
    keys, ends = round_keys(seed, rounds), np.arange(n, a * b, dtype=np.int64)
    while len(walking := np.flatnonzero(ends >= n)):
        left, right = network(ends[walking] // b, ends[walking] % b, a, b, keys)
        ends[walking] = left * b + right
    return ends


def shuffled_positions(df: DataFrame, n: int, seed: int = 42, pos: str = "pos", place: str = "place",
                       rounds: int = ROUNDS) -> DataFrame:
    """``df`` with ``place``, where a row goes when rows at ``pos`` 0..n-1 are
    shuffled; null for a position outside of that. The first rows of the
    shuffled table are those with small places. n is below 2^60."""
    if not 0 <= n < 1 << 60:
        raise ValueError("n must be from 0 to 2^60 - 1")
    inside = F.col(pos).between(0, n - 1)
    if n == 0:
        return df.withColumn(place, F.lit(None).cast("bigint"))
    a, b = sides(n)
    # Each round is a column of its own, so that no expression is repeated
    # inside the next one.
    out = df.withColumn("_number", F.when(inside, F.col(pos).cast("bigint"))).withColumns(
        {"_left": F.expr(f"_number div {b}"), "_right": F.expr(f"_number % {b}")})
    for r, key in enumerate(round_keys(seed, rounds)):
        left, right = F.col("_left"), F.col("_right")
        out = (out.withColumn("_left", (left + _hash(right, key)) % a) if r % 2 == 0
               else out.withColumn("_right", (right + _hash(left, key)) % b))
    number = (F.col("_left") * b + F.col("_right")).cast("bigint")
    ends = ends_of_walks(n, seed, rounds)
    out = out.withColumn("_number", number).drop("_left", "_right")
    if not len(ends):
        return out.withColumnRenamed("_number", place)
    # Fewer rows than the root of n.
    table = df.sparkSession.createDataFrame([(n + i, int(e)) for i, e in enumerate(ends)], "_from bigint, _end bigint")
    return (out.join(F.broadcast(table), F.col("_number") == F.col("_from"), "left")
            .withColumn(place, F.coalesce("_end", "_number")).drop("_number", "_from", "_end"))
