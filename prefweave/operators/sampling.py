"""Seeded, reproducible sampling and exact-size splits.

A row's place in the random order is ``md5("<seed>:<key>")``, then the md5 of
its whole content: the same rows come out for any partition count, after a lost
executor is recomputed, and in any engine with md5. A null key has its own
place in the order like any other value; rows with equal keys are told apart by
content, and rows equal in everything are interchangeable. The cutoff is found
by counting rows by hash prefix, one aggregation for each step, whatever the
input's size; the driver sees at most 16**3 counts a step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

_PREFIX_CHARS = 3
_HASH_CHARS = 32
_NULL_KEY = "\x00null"


def order_hash(key, seed) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(k.cast("string"), F.lit(_NULL_KEY))))


def content_hash(df: DataFrame) -> Column:
    columns = [F.col(f"`{c}`") for c in sorted(df.columns)]
    return F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))


def cutoff(df: DataFrame, h: str, k: int | None = None,
           fraction: float | None = None) -> tuple[str, int, int, int, int]:
    """Where the first ``k`` rows by ``h`` end, without gathering rows.

    Give ``k``, or ``fraction`` for ``k = int(fraction * count)``. Returns
    (prefix, rows wanted at that prefix, rows there, k, count): the first k rows
    are those below the prefix and that many at it; unless the prefix is a whole
    hash, all rows at it are wanted.
    """
    def counts(prefix: str) -> list[tuple[str, int]]:
        at = df.where(F.substring(h, 1, len(prefix)) == prefix) if prefix else df
        part = F.substring(h, len(prefix) + 1, _PREFIX_CHARS)
        return sorted((r["p"], r["count"]) for r in at.groupBy(part.alias("p")).count().collect())

    found = counts("")
    total = sum(c for _, c in found)
    if k is None:
        k = int(fraction * total)
    prefix, want, size = "", k, total
    while 0 < want < size and len(prefix) < _HASH_CHARS:
        for p, c in found:
            if want <= c:
                prefix, size = prefix + p, c
                break
            want -= c
        if want < size:
            found = counts(prefix)
    return prefix, want, size, k, total


def sample_n(df: DataFrame, n: int, seed: int = 42, key: str = "pair_id",
             allow_fewer: bool = False) -> DataFrame:
    """The first ``n`` rows of a seeded random order (L1 + L2): exactly ``n``,
    also with null or repeated keys."""
    marked = split_column(df, test_size=n, seed=seed, key=key, column="_first", chosen=True, rest=False,
                          allow_fewer=allow_fewer)
    return marked.where("_first").drop("_first")


def split_column(df: DataFrame, test_size: int | None = None, test_fraction: float = 0.2,
                 seed: int = 7, key: str = "pair_id", column: str = "split", chosen="test", rest="train",
                 allow_fewer: bool = False, among: Column | None = None) -> DataFrame:
    """Add ``split`` = 'test' for exactly ``test_size`` rows, else 'train' (L3).
    With ``among`` only the rows it holds for are counted and split; the others
    stay, with a null split.

    Default size is ``int(test_fraction * count)``, the reference's rule; the
    count (G5) comes from the same job as the first step of the search. Use a
    seed different from the sampling seed, or the test split is the head of the
    sample.
    """
    h, c = "_order", "_content"
    counted = F.lit(True) if among is None else among
    keyed = df.withColumn(h, F.when(counted, order_hash(key, seed)))
    prefix, want, size, k, total = cutoff(keyed.select(h).where(F.col(h).isNotNull()), h, test_size,
                                          None if test_size is not None else test_fraction)
    if k > total and not allow_fewer:
        raise ValueError(f"{total} rows in the input, fewer than the {k} asked for")
    if k <= 0 or k >= total:
        return df.withColumn(column, F.when(counted, F.lit(rest if k <= 0 else chosen)))

    def mark(rows: DataFrame, by: str, upto: str) -> DataFrame:
        at = F.substring(by, 1, len(upto))
        return rows.withColumn(column, F.when(at <= upto, F.lit(chosen)).when(at > upto, F.lit(rest)))

    if want == size:
        return mark(keyed, h, prefix).drop(h)
    # Rows of one key at the cutoff: in order of their content.
    tied = keyed.where(F.col(h) == prefix).withColumn(c, content_hash(df))
    upto, want, size, _, _ = cutoff(tied.select(c), c, want)
    marked = mark(keyed.where(F.col(h).isNull() | (F.col(h) != prefix)), h, prefix).drop(h)
    if want == size:
        return marked.unionByName(mark(tied, c, upto).drop(h, c))
    # Rows equal in everything: any ``want`` of them, the others stay behind.
    numbered = tied.where(F.col(c) == upto).limit(1).withColumn("_i", F.explode(F.sequence(F.lit(1), F.lit(size))))
    equal = numbered.withColumn(column, F.when(F.col("_i") <= want, F.lit(chosen)).otherwise(F.lit(rest)))
    return (marked.unionByName(mark(tied.where(F.col(c) != upto), c, upto).drop(h, c))
            .unionByName(equal.drop(h, c, "_i")))


def train_test_split(df: DataFrame, test_size: int | None = None, test_fraction: float = 0.2,
                     seed: int = 7, key: str = "pair_id") -> dict[str, DataFrame]:
    marked = split_column(df, test_size, test_fraction, seed, key)
    return {s: marked.where(F.col("split") == s).drop("split") for s in ("train", "test")}
