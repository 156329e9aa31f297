"""Embedding whitening by a weighted multiplicity covariance (operator 13).

Components become integers, equal integer vectors are grouped, and a group's
weight in the fit is its row count or one. Sums are exact; the covariance is a
weighted centred matrix product of each block of distinct vectors, added up by
Spark entry by entry. Every distinct vector is projected once, and the result
is joined back to the rows.

The driver sees one covariance (the square of the vector length) and the sums.

Edge cases: rows whose vector is null or holds null or non-finite components
give no rows, nor do empty vectors; null and repeated ids stay, a result for
each row; vectors of different lengths are fitted apart, each length with its
own n; a component without variance (at most 1e-12 of the trace) has a null
``whitened`` and ``explained`` 0 and no part in ``identity_error``; a deviation
beyond the long range is null; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from prefweave.llm.tables import stored
from prefweave.llm.vectors import by_width, floored, ints, joined_back

SCALE = 256
COMPONENTS = 4
NO_VARIANCE = 1e-12
LONG_MAX = (1 << 63) - 1


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact weighted sums of a partition, by vector length and place."""
    totals: dict[int, tuple[int, list[int]]] = {}
    for b in batches:
        weight = b["weight"].to_numpy()
        for width, rows, x in by_width(b["x"]):
            w = weight[rows][:, None]
            x, w = ints(x, w, bound=lambda m: m * m * len(rows))
            n, s = totals.get(width, (0, [0] * width))
            totals[width] = n + int(w.sum()), [a + int(v) for a, v in zip(s, (x * w).sum(axis=0))]
    for width, (n, s) in totals.items():
        yield pa.RecordBatch.from_pydict({"width": pa.array([width] * width, pa.int32()),
                                          "place": pa.array(range(width), pa.int32()),
                                          "n": pa.array([n] * width, pa.int64()),
                                          "s": pa.array([str(v) for v in s], pa.string())})


def _offset(x: np.ndarray, n: int, s: np.ndarray) -> np.ndarray:
    """n * x - S, exact."""
    x, s = ints(x, s, bound=lambda m: 2 * m * n)
    return x * n - s


def _products(fits: dict[int, tuple[int, np.ndarray]]):
    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for b in batches:
            weight = b["weight"].to_numpy()
            for width, rows, x in by_width(b["x"]):
                n, s = fits[width]
                centred = (_offset(x, n, s) / n).astype(np.float64)
                part = (centred * weight[rows][:, None]).T @ centred
                totals[width] = totals[width] + part if width in totals else part
        for width, total in totals.items():
            for i in range(width):
                yield pa.RecordBatch.from_pydict({
                    "width": pa.array([width] * (width - i), pa.int32()), "i": pa.array([i] * (width - i), pa.int32()),
                    "j": pa.array(range(i, width), pa.int32()), "v": pa.array(total[i, i:], pa.float64())})
    return products


class Fit:
    """The leading components of one vector length."""

    def __init__(self, n: int, s: np.ndarray, covariance: np.ndarray, components: int):
        self.n, self.s = n, s
        values, vectors = np.linalg.eigh(covariance)
        order = np.argsort(-values, kind="stable")[:components]
        self.vectors, trace = vectors[:, order], float(np.trace(covariance))
        self.explained = [float(v / trace) if trace > 0 and v > NO_VARIANCE * trace else 0.0 for v in values[order]]
        self.scale = [float(np.sqrt(v)) if share else 0.0 for v, share in zip(values[order], self.explained)]

    def whiten(self, x: np.ndarray) -> tuple[list[int | None], list[list[float | None]]]:
        off = _offset(x, self.n, self.s)
        off, = ints(off, bound=lambda m: m * m * len(self.s))
        deviation = [int(v) if v <= LONG_MAX else None for v in (off * off).sum(axis=1)]
        projected = (off / self.n).astype(np.float64) @ self.vectors
        return deviation, [[v / e if e else None for v, e in zip(row, self.scale)] for row in projected.tolist()]


def _fits(distinct: DataFrame, components: int) -> dict[int, Fit]:
    sums: dict[int, tuple[int, list[int]]] = {}
    total = (distinct.mapInArrow(_sums, "width int, place int, n bigint, s string")
             .groupBy("width", "place").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")))
    for r in total.orderBy("width", "place").collect():
        sums.setdefault(r["width"], (r["n"], []))[1].append(int(r["s"]))
    centres = {}
    for width, (n, s) in sums.items():
        exact = np.array(s, dtype=object)
        centres[width] = n, exact if max(map(abs, s)) > LONG_MAX else exact.astype(np.int64)
    covariances = {w: np.zeros((w, w)) for w in centres}
    for r in (distinct.mapInArrow(_products(centres), "width int, i int, j int, v double")
              .groupBy("width", "i", "j").agg(F.sum("v").alias("v")).collect()):
        covariances[r["width"]][r["i"], r["j"]] = covariances[r["width"]][r["j"], r["i"]] = r["v"] / centres[r["width"]][0]
    return {w: Fit(n, s, covariances[w], components) for w, (n, s) in centres.items()}


def _identity_errors(white: DataFrame, fits: dict[int, Fit], components: int) -> dict[int, float]:
    """Largest entry of the covariance of the whitened distinct vectors minus
    the identity, measured on the written values, centred before multiplying."""
    w, places = F.col("weight").cast("double"), range(components)
    means = {r["width"]: [r[f"m{i}"] for i in places] for r in white.groupBy("width").agg(
        *[(F.sum(w * F.get("whitened", i)) / F.sum(w)).alias(f"m{i}") for i in places]).collect()}
    centred = [F.create_map(*[F.lit(v) for width, m in means.items() for v in (width, m[i] or 0.0)])[F.col("width")]
               if means else F.lit(0.0) for i in places]
    centred = [F.get("whitened", i) - c for i, c in enumerate(centred)]
    out = {}
    for r in white.groupBy("width").agg(*[(F.sum(w * centred[i] * centred[j]) / F.sum(w)).alias(f"c{i}_{j}")
                                          for i in places for j in range(i, components)]).collect():
        used = [i for i in places if i < len(fits[r["width"]].scale) and fits[r["width"]].scale[i]]
        out[r["width"]] = max((abs(r[f"c{i}_{j}"] - (i == j)) for i in used for j in used if i <= j), default=0.0)
    return out


def whiten(embeddings: DataFrame, scale: int = SCALE, components: int = COMPONENTS,
           weights: str = "one") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error and
    multiplicity (rows with the same integer vector) for each row that takes
    part. ``weights``: ``one`` fits every distinct vector once, ``count`` as
    often as rows have it."""
    if weights not in ("one", "count"):
        raise ValueError(f"unknown weights {weights!r}")
    spark = embeddings.sparkSession
    keyed = floored(embeddings, scale, "vec_id").where(F.size("x") > 0).withColumn(
        "key", F.unhex(F.sha2(F.col("x").cast("string").cast("binary"), 256)))
    distinct = stored(keyed.groupBy("key", "x").agg(F.count(F.lit(1)).alias("multiplicity")).withColumn(
        "weight", F.lit(1).cast("bigint") if weights == "one" else F.col("multiplicity")), "distinct-vectors")
    fits = _fits(distinct.select("x", "weight"), components)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            deviation, whitened = [None] * len(b), [None] * len(b)
            sizes = [0] * len(b)
            for width, rows, x in by_width(b["x"]):
                for i, d, w in zip(rows, *fits[width].whiten(x)):
                    sizes[i], deviation[i], whitened[i] = width, d, w
            yield pa.RecordBatch.from_arrays(
                [b["key"], b["multiplicity"], b["weight"], pa.array(sizes, pa.int32()), pa.array(deviation, pa.int64()),
                 pa.array(whitened, pa.list_(pa.float64()))],
                ["key", "multiplicity", "weight", "width", "deviation", "whitened"])

    white = stored(distinct.mapInArrow(
        project, "key binary, multiplicity bigint, weight bigint, width int, deviation bigint, whitened array<double>"),
        "whitened")
    errors = _identity_errors(white, fits, components)
    about = spark.createDataFrame(
        [(w, i + 1, f.n, e, errors[w]) for w, f in fits.items() for i, e in enumerate(f.explained)],
        T.StructType.fromDDL("width int, component int, n bigint, explained double, identity_error double"))
    back = joined_back(keyed.select("vec_id", "key"),
                       white.drop("weight").withColumn("n_rows", F.col("multiplicity")), "key", "n_rows")
    flat = back.select("vec_id", "width", "deviation", "multiplicity", F.posexplode("whitened").alias("p", "whitened"))
    return (flat.withColumn("component", F.col("p") + 1)
            .join(F.broadcast(about), ["width", "component"])
            .select("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "multiplicity"))
