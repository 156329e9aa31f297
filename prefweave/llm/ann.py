"""Nearest neighbours by a hash-prefix forest (operator 3).

Every tree gives a vector a string of ``BITS`` sign bits of random projections
and keeps the strings in a sorted array. A query descends each tree to the
vectors with the longest common prefix, then ascends all trees together, one
bit at a time, until the prefixes of the current length hold enough candidates
(``share`` of the vectors plus ``least``, counted over all trees). Candidates
are compared by exact inner products in double precision.

So that the largest inner product is also the smallest angle, indexed vectors
get one more component, ``sqrt(m^2 - |x|^2)`` with m the largest norm, and
queries a zero there. Hash strings and the first comparison use single precision, on
vectors divided by the largest component of all, so that large finite vectors do not
overflow there; scores come from the original vectors.

Vectors are dealt by hash into shards of about ``shard_rows`` and queries into
blocks of about ``query_rows``; a task indexes one shard and answers one block,
so its memory is bounded by ``shard_rows`` vectors of the input's dimension, and no
vector is left unindexed.
A query's best of all shards are merged at the end. The projections come from a
fixed seed; nothing is fitted.

Edge cases: rows with a null id, and vectors that are null, empty, zero or hold
null or non-finite components, take no part; every row counts, also where ids repeat:
a query's own row is one row with its id and vector, further copies of that row are
candidates like any other, and fill a rank each. Rows of one id with different vectors
ask one query each, equal rows the same one. Vectors of different lengths are not compared; with fewer
candidates than ``k`` a query gets all; ties go to the smaller id, also among
products beyond the range of doubles (infinite); an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from prefweave.llm.tables import need, stored

TREES = 128
BITS = 24
SHARD_ROWS = 20_000
QUERY_ROWS = 2_048
SHARE, LEAST = 0.5, 1024

RESULT = "qid bigint, query_id bigint, vec_id bigint, score double, copies bigint"


def valid_vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id, v (array of doubles), copies (equal rows) of the rows that take part."""
    v = need(embeddings, "vec_id", "embedding").select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    v = v.where(F.col("vec_id").isNotNull() & (F.size("v") > 0) & finite & F.exists("v", lambda x: x != 0))
    return v.groupBy("vec_id", "v").agg(F.count("*").alias("copies"))


class Forest:
    """Sorted hash strings of one shard, per tree."""

    def __init__(self, x: np.ndarray, unit: float, longest: float, trees: int, bits: int):
        """``unit``: largest component of all vectors; ``longest``: largest norm in that unit."""
        self.x, self.bits, self.longest, self.largest = x, bits, longest, unit
        d = x.shape[1] + 1
        rng = np.random.default_rng(97)
        self.planes = rng.standard_normal((trees, d, bits)).astype(np.float32)
        small = x / unit
        extra = np.sqrt(np.maximum(longest ** 2 - (small * small).sum(axis=1), 0))
        wide = np.hstack([small, extra[:, None]]).astype(np.float32)
        self.near = small.astype(np.float32)
        self.order, self.strings = [], []
        for plane in self.planes:
            s = self._strings(wide, plane)
            order = np.argsort(s, kind="stable")
            self.order.append(order.astype(np.int32))
            self.strings.append(s[order])

    def _strings(self, wide: np.ndarray, plane: np.ndarray) -> np.ndarray:
        weights = (np.int64(1) << np.arange(self.bits - 1, -1, -1)).astype(np.float64)
        return ((wide @ plane > 0) @ weights).astype(np.int64)

    @staticmethod
    def _small(queries: np.ndarray) -> np.ndarray:
        return queries / np.abs(queries).max(axis=1, keepdims=True)

    def _bounds(self, t: int, q: np.ndarray, drop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Range of each query's vectors whose strings agree but for the last
        ``drop`` bits."""
        low = (q >> drop) << drop
        s = self.strings[t]
        return np.searchsorted(s, low), np.searchsorted(s, low + (np.int64(1) << drop))

    def candidates(self, queries: np.ndarray, enough: int):
        """Candidate rows of each query, in turn."""
        wide = np.hstack([self._small(queries), np.zeros((len(queries), 1))]).astype(np.float32)
        strings = [self._strings(wide, plane) for plane in self.planes]
        # The longest prefix length with enough candidates: fewest dropped bits.
        low, high = np.zeros(len(queries), np.int64), np.full(len(queries), self.bits, np.int64)
        while (low < high).any():
            drop = (low + high) // 2
            count = np.zeros(len(queries), np.int64)
            for t, q in enumerate(strings):
                a, b = self._bounds(t, q, drop)
                count += b - a
            good = count >= enough
            high, low = np.where(good, drop, high), np.where(good, low, np.minimum(drop + 1, high))
        bounds = [self._bounds(t, q, low) for t, q in enumerate(strings)]
        mask = np.zeros(len(self.x), dtype=bool)
        for i in range(len(queries)):
            for order, (a, b) in zip(self.order, bounds):
                mask[order[a[i]:b[i]]] = True
            found = np.flatnonzero(mask)
            mask[found] = False
            yield found

    def nearest(self, queries: np.ndarray, query_ids: np.ndarray, ids: np.ndarray, copies: np.ndarray, k: int,
                enough: int):
        """(query place, row, score, copies without the query's own) of the k best
        candidates of each query."""
        out = []
        small = self._small(queries)
        for i, found in enumerate(self.candidates(queries, enough)):
            same = found[ids[found] == query_ids[i]]
            own = same[(self.x[same] == queries[i]).all(axis=1)]         # at most one: rows are distinct
            found = np.setdiff1d(found, own[copies[own] == 1], assume_unique=True)
            size = float(np.linalg.norm(small[i])) * self.longest
            in_range = self._in_range(queries[i])
            if len(found) > 4 * k and in_range:
                # Single precision sorts out what can't be among the best.
                rough = self.near[found] @ small[i].astype(np.float32)
                cut = np.partition(rough, len(rough) - k)[len(rough) - k]
                found = found[rough >= cut - 1e-4 * (np.abs(cut) + size)]
            if in_range:
                scores = (self.x[found] * queries[i]).sum(axis=1)
            else:                                  # one factor at a time: infinite, never inf - inf
                with np.errstate(over="ignore", under="ignore"):
                    scores = (self.x[found] / self.largest * small[i]).sum(axis=1) * self.largest * np.abs(queries[i]).max()
            best = np.lexsort((ids[found], -scores))[:k]
            out += [(i, found[j], scores[j], copies[found[j]] - np.isin(found[j], own)) for j in best]
        return out

    def _in_range(self, query: np.ndarray) -> bool:
        """Whether no product with this query can leave the doubles' range."""
        with np.errstate(over="ignore", under="ignore"):
            return 1e-250 < np.abs(query).max() * self.largest < 1e300


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    whole = column.combine_chunks()
    return whole.flatten().to_numpy(zero_copy_only=False).reshape(len(whole), -1)


def nearest_neighbours(embeddings: DataFrame, queries: DataFrame, k: int = 20, trees: int = TREES, bits: int = BITS,
                       shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS, share: float = SHARE,
                       least: int = LEAST) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of every query
    (``vec_id``, ``embedding``) among ``embeddings``, without its own id."""
    vectors = stored(valid_vectors(embeddings), "vectors")
    asked = stored(valid_vectors(queries).withColumn("qid", F.monotonically_increasing_id()), "queries")
    most = F.array_max(F.transform("v", F.abs))
    stats = vectors.agg(F.count("*").alias("n"), F.max(most).alias("m")).first()
    n, unit, n_queries = stats["n"], float(stats["m"] or 1.0), asked.count()
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + (x / F.lit(unit)) * (x / F.lit(unit))))
    longest = float(vectors.agg(F.max(norm)).first()[0] or 0.0)
    shards, blocks = max(1, math.ceil(n / shard_rows)), max(1, math.ceil(n_queries / query_rows))

    part = F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards)).cast("int")       # an id may have many vectors
    block = F.pmod(F.xxhash64("vec_id", "v", F.lit(1)), F.lit(blocks)).cast("int")
    left = vectors.select("vec_id", "v", "copies", F.size("v").alias("dim"), part.alias("shard"),
                          F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    right = asked.select("qid", "vec_id", "v", F.size("v").alias("dim"), block.alias("block"),
                         F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))

    schema = pa.schema([("qid", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64()),
                        ("copies", pa.int64())])

    def search(rows: pa.Table, block: pa.Table) -> pa.Table:
        if not rows.num_rows or not block.num_rows:
            return pa.Table.from_pylist([], schema)
        ids, query_ids = rows["vec_id"].to_numpy(), block["vec_id"].to_numpy()
        forest = Forest(_matrix(rows["v"]), unit, longest, trees, bits)
        found = forest.nearest(_matrix(block["v"]), query_ids, ids, rows["copies"].to_numpy(), k,
                               min(math.ceil(share * len(ids)) + least, trees * len(ids)))
        asked_as = block["qid"].to_numpy()
        columns = ([asked_as[i] for i, *_ in found], [query_ids[i] for i, *_ in found], [ids[j] for _, j, *_ in found],
                   [s for _, _, s, _ in found], [c for *_, c in found])
        return pa.Table.from_arrays([pa.array(c, t.type) for c, t in zip(columns, schema)], schema=schema)

    keys = ["dim", "shard", "block"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, RESULT)
    # Copies fill a rank each; a query has at most k rows of every shard.
    best = Window.partitionBy("qid").orderBy(F.desc("score"), "vec_id").rowsBetween(Window.unboundedPreceding, -1)
    ranked = found.withColumn("before", F.coalesce(F.sum("copies").over(best), F.lit(0))).where(F.col("before") < k)
    last = F.least(F.col("before") + F.col("copies"), F.lit(k))
    ranks = F.sequence((F.col("before") + 1).cast("int"), last.cast("int"))
    return ranked.select("query_id", F.explode(ranks).alias("rank"), "vec_id", "score")
