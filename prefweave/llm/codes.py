"""Vector code compression by ball k-means (operator 12).

Vectors become integers and are cut into equal consecutive parts; each part
position has a codebook of its own. A codebook entry and the parts assigned to
it form a ball. In a round, the entries near enough to a ball to take a part
from it are its neighbours: those within twice its radius. Parts of its stable
core, nearer to their entry than half the way to any neighbour, keep it without
a comparison. The others lie in rings: a part is compared with just those
neighbours, nearest first, that lie within twice its own distance. All of it is
integer arithmetic on squared distances, ties included, so the result equals
that of comparing every entry.

Each round reads the rows with their present codes, and writes them with their
new ones and the sums of every partition; the driver sees only the codebooks.

Edge cases: rows whose vector is null, or holds null or non-finite components,
or does not divide into the parts, take no part; null ids come last where the
smallest ids are asked for, equal ids by their vectors; with fewer rows than
entries a codebook has one entry a row; vectors of different lengths have
codebooks of their own; an error beyond the long range is null; an empty table
gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from prefweave.llm.tables import stored
from prefweave.llm.vectors import by_width, floored, ints, joined_back

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
LONG_MAX = (1 << 63) - 1

Books = dict[int, list[list[list[int]]]]       # by vector length: part, entry, component


def _squared(difference: np.ndarray) -> np.ndarray:
    return (difference * difference).sum(axis=1)


def assign(x: np.ndarray, book: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest entry of each row of ``x`` (ties to the lower index), its squared
    distance, and how many entries were compared beside the present ones.
    ``start``: the present entry of each row; any will do."""
    x, book = ints(x, book, bound=lambda m: 16 * x.shape[1] * m * m)
    own = _squared(x - book[start])
    entry, distance, compared = start.copy(), own.copy(), 0
    for i in range(len(book)):
        ball = np.flatnonzero(start == i)
        if not len(ball):
            continue
        reach, away = 4 * own[ball], _squared(book - book[i])
        near = [j for j in np.argsort(away, kind="stable") if j != i and away[j] <= reach.max()]
        rings = np.searchsorted(away[near], reach, side="right")
        for place, j in enumerate(near):
            ring = ball[rings > place]
            if not len(ring):
                break
            d = _squared(x[ring] - book[j])
            compared += len(ring)
            better = ((d < distance[ring]) | ((d == distance[ring]) & (j < entry[ring]))).astype(bool)
            entry[ring[better]], distance[ring[better]] = j, d[better]
    return entry, distance, compared


def _arrays(books: Books) -> dict[int, list[np.ndarray]]:
    out = {}
    for width, parts in books.items():
        wide = max((abs(v) for part in parts for entry in part for v in entry), default=0) > LONG_MAX
        out[width] = [np.array(part, dtype=object if wide else np.int64) for part in parts]
    return out


def _assigned(batch: pa.RecordBatch, books: dict[int, list[np.ndarray]], parts: int):
    """(rows, vectors cut in parts, entries, distances) by vector length."""
    codes = np.frombuffer(b"".join(batch["code"].to_pylist()), np.uint8).reshape(len(batch), parts)
    for width, rows, x in by_width(batch["x"]):
        cut = x.reshape(len(rows), parts, -1)
        found = [assign(cut[:, p], books[width][p], codes[rows, p].astype(np.int64)) for p in range(parts)]
        yield (width, rows, cut, np.stack([e for e, _, _ in found], axis=1),
               np.stack([d for _, d, _ in found], axis=1))


def _round(books: Books, parts: int):
    """Rows with new codes, then the partition's sums by part, entry and place."""
    arrays = _arrays(books)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int, int], tuple[int, list[int]]] = {}
        empty = None
        for b in batches:
            codes: list[bytes] = [b""] * len(b)
            for width, rows, cut, entry, _ in _assigned(b, arrays, parts):
                for i, code in zip(rows, entry.astype(np.uint8)):
                    codes[i] = code.tobytes()
                cut, = ints(cut, bound=lambda m: m * len(rows))
                for p in range(parts):
                    for e in np.unique(entry[:, p]):
                        mine = cut[entry[:, p] == e, p]
                        n, s = sums.get((width, p, int(e)), (0, [0] * mine.shape[1]))
                        sums[width, p, int(e)] = n + len(mine), [a + int(v) for a, v in zip(s, mine.sum(axis=0))]
            none = pa.nulls(len(b), pa.int32())
            empty = b.slice(0, 0)
            yield pa.RecordBatch.from_arrays(
                [b["vec_id"], b["label"], b["x"], pa.array(codes, pa.binary()), none, none, none, none,
                 pa.nulls(len(b), pa.int64()), pa.nulls(len(b), pa.string())], STATE)
        if sums:
            flat = [(w, p, e, place, n, str(v)) for (w, p, e), (n, s) in sums.items() for place, v in enumerate(s)]
            columns = list(zip(*flat))
            kinds = [pa.int32()] * 4 + [pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(flat), empty[c].type) for c in ("vec_id", "label", "x", "code")]
                + [pa.array(c, k) for c, k in zip(columns, kinds)], STATE)

    return step


STATE = ["vec_id", "label", "x", "code", "width", "part", "entry", "place", "n", "s"]
SUMS = "width int, part int, entry int, place int, n bigint, s string"


def first_books(rows: DataFrame, parts: int, entries: int) -> Books:
    """The parts of the ``entries`` smallest ids of each vector length."""
    books: Books = {}
    for width in sorted(r["w"] for r in rows.select(F.size("x").alias("w")).distinct().collect()):
        first = rows.where(F.size("x") == width).orderBy(F.asc_nulls_last("vec_id"), "x").limit(entries).collect()
        step = width // parts
        books[width] = [[list(r["x"][p * step:(p + 1) * step]) for r in first] for p in range(parts)]
    return books


def train(rows: DataFrame, books: Books, parts: int, rounds: int) -> tuple[DataFrame, Books]:
    """The rows (vec_id, label, x, code) with their codes after ``rounds``
    rounds, and the codebooks that those rounds end with."""
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    schema = T.StructType([T.StructField(c, kinds[c]) for c in STATE[:4]] + T.StructType.fromDDL(SUMS).fields)
    for number in range(rounds):
        written = stored(rows.mapInArrow(_round(books, parts), schema), f"codes-{number + 1}")
        sums = (written.where("part is not null").groupBy("width", "part", "entry", "place")
                .agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")))
        books = {w: [[list(e) for e in part] for part in b] for w, b in books.items()}
        for r in sums.collect():
            books[r["width"]][r["part"]][r["entry"]][r["place"]] = int(r["s"]) // r["n"]
        rows = written.where("part is null").select(*STATE[:4])
    return rows, books


def digest(book: list[list[list[int]]]) -> str:
    return hashlib.sha256(",".join(str(v) for part in book for entry in part for v in entry).encode()).hexdigest()


def compress(embeddings: DataFrame, scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES,
             rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code (hex, two digits a part), error, label_error and
    codebooks_sha256 of every row that takes part; ``label`` groups errors."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has one byte: 1 to 256 entries")
    rows = (floored(embeddings, scale, "vec_id", "label").where((F.size("x") > 0) & (F.size("x") % parts == 0))
            .withColumn("code", F.lit(bytes(parts))))
    books = first_books(rows, parts, entries)
    rows, books = train(rows, books, parts, rounds)
    arrays, digests = _arrays(books), {w: digest(b) for w, b in books.items()}

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            code, error, sha = [""] * len(b), [None] * len(b), [""] * len(b)
            for width, at, _, entry, distance in _assigned(b, arrays, parts):
                distance, = ints(distance, bound=lambda m: m * parts)
                total = distance.sum(axis=1)
                for i, e, d in zip(at, entry.astype(np.uint8), total):
                    code[i], error[i], sha[i] = e.tobytes().hex(), int(d) if d <= LONG_MAX else None, digests[width]
            yield pa.RecordBatch.from_arrays(
                [b["vec_id"], b["label"], pa.array(code, pa.string()), pa.array(error, pa.int64()),
                 pa.array(sha, pa.string())], ["vec_id", "label", "code", "error", "codebooks_sha256"])

    kinds = {f.name: f.dataType for f in rows.schema.fields}
    coded = stored(rows.select("vec_id", "label", "x", "code").mapInArrow(final, T.StructType(
        [T.StructField("vec_id", kinds["vec_id"]), T.StructField("label", kinds["label"]),
         *T.StructType.fromDDL("code string, error bigint, codebooks_sha256 string").fields])), "coded")
    # A null label is a group of its own, so the key of the join is never null.
    keyed = coded.withColumn("key", F.concat(F.when(F.col("label").isNull(), "-").otherwise("="),
                                             F.coalesce(F.col("label").cast("string"), F.lit(""))))
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    per_label = keyed.groupBy("key").agg(
        F.when(total <= LONG_MAX, total).cast("bigint").alias("label_error"), F.count(F.lit(1)).alias("n_rows"))
    return joined_back(keyed, per_label, "key", "n_rows").select(
        "vec_id", "code", "error", "label_error", "codebooks_sha256")
