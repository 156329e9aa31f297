"""Vector codes and whitening against plain loops."""

import hashlib
import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

from prefweave.llm import codes, queries, whitening
from prefweave.llm.codes import assign
from tests.conftest import SF01
from tests.oracle_compare import compare

NAN, INF = float("nan"), float("inf")


@pytest.fixture(scope="session")
def vectors(spark):
    """Rows as an embeddings table with extra columns of clashing names."""
    extra = ("x", "code", "key", "part", "weight", "width", "n")
    schema = T.StructType([T.StructField("vec_id", T.LongType()),
                           T.StructField("embedding", T.ArrayType(T.FloatType())),
                           T.StructField("label", T.IntegerType())] + [T.StructField(c, T.StringType()) for c in extra])
    return lambda rows: spark.createDataFrame([(*r, *("y" for _ in extra)) for r in rows], schema)


def kept(rows, scale):
    good = [(i, [math.floor(scale * float(np.float32(c))) for c in v], label) for i, v, label in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    return sorted(good, key=lambda r: (r[0] is None, r[0], r[1]))


def brute_codes(rows, parts=8, entries=16, rounds=6):
    rows = [r for r in kept(rows, 4096) if r[1] and len(r[1]) % parts == 0]
    w = len(rows[0][1]) // parts
    books = [[r[1][p * w:(p + 1) * w] for r in rows[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            mine = {}
            for _, x, _ in rows:
                mine.setdefault(nearest(x[p * w:(p + 1) * w], books[p])[1], []).append(x[p * w:(p + 1) * w])
            for e, xs in mine.items():
                books[p][e] = [sum(c) // len(xs) for c in zip(*xs)]
    sha = hashlib.sha256(",".join(str(v) for b in books for c in b for v in c).encode()).hexdigest()
    out, per_label = [], {}
    for i, x, label in rows:
        found = [nearest(x[p * w:(p + 1) * w], books[p]) for p in range(parts)]
        error = sum(d for d, _ in found)
        per_label[label] = per_label.get(label, 0) + error
        out.append((i, "".join(f"{e:02x}" for _, e in found), error, label))
    return sorted((i, c, e, per_label[label], sha) for i, c, e, label in out)


def some_rows(n, width, seed=3):
    rng = np.random.default_rng(seed)
    rows = [(int(i), [float(c) for c in np.round(rng.standard_normal(width) / 4, 3)], int(i) % 3 or None) for i in range(n)]
    rows += rows[:7]                                              # repeated rows
    rows += [(n + i, rows[5][1], 4) for i in range(40)]           # a large group of copies
    return rows + [(n + 50, None, 1), (n + 51, [None] + [0.0] * (width - 1), 1), (n + 52, [NAN] * width, 1),
                   (n + 53, [INF] + [0.0] * (width - 1), 2), (n + 54, [0.0] * width, 2), (n + 55, [-1e-9] * width, 2)]


def test_codes_equal_plain_loops(vectors):
    rows = some_rows(150, 16)
    got = sorted(tuple(r) for r in codes.compress(vectors(rows).repartition(5)).collect())
    assert got == brute_codes(rows)


def test_codes_with_few_rows_equal_entries_and_odd_lengths(vectors):
    rows = [(1, [0.5] * 8, None), (2, [0.5] * 8, None), (2, [0.25] * 8, 7), (3, [], 1), (4, [1.0] * 7, 1)]
    got = sorted(tuple(r) for r in codes.compress(vectors(rows)).collect())
    assert got == brute_codes(rows[:3]) and len(got) == 3
    assert [r[1] for r in got] == ["00" * 8, "00" * 8, "02" * 8] or {r[1] for r in got} == {"00" * 8, "01" * 8}


def test_codes_of_two_lengths_null_ids_and_huge_components(vectors):
    rows = [(1, [0.5] * 8, 1), (None, [0.25] * 8, 1), (2, [3e38] * 8, 1), (4, [-3e38] * 8, 1), (3, [0.5] * 16, 2)]
    got = {r.vec_id: r for r in codes.compress(vectors(rows), entries=2).collect()}
    assert set(got) == {1, None, 2, 3, 4} and got[1].codebooks_sha256 != got[3].codebooks_sha256
    assert got[3].error == 0 and got[3].label_error == 0


def test_codes_of_an_empty_table(vectors):
    assert codes.compress(vectors([])).collect() == []


def test_codes_match_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF01}/embeddings.parquet'")
    assert not compare(queries.op12_vector_codes(spark, SF01), con, queries.ORACLE_SQL["op12_vector_codes"])


@pytest.mark.parametrize("seed", range(12))
def test_balls_and_rings_find_what_all_comparisons_find(seed):
    rng = np.random.default_rng(seed)
    spread, k = int(rng.integers(2, 400)), int(rng.integers(1, 17))
    x, book = rng.integers(-spread, spread, (300, 3)), rng.integers(-spread, spread, (k, 3))
    book[k // 2] = book[0]                                        # equal entries: the lower one wins
    if seed % 4 == 3:
        x, book = x * (1 << 40), book * (1 << 40)                 # beyond 64-bit squares
    all_pairs = ((x.astype(object)[:, None] - book.astype(object)[None]) ** 2).sum(axis=2)
    want = np.array([min(range(k), key=lambda e: (row[e], e)) for row in all_pairs])
    entry, distance, _ = assign(x, book, rng.integers(0, k, len(x)))
    assert (entry == want).all() and (distance == all_pairs[np.arange(len(x)), want]).all()


def test_stable_cores_skip_comparisons():
    rng = np.random.default_rng(1)
    book = rng.integers(-9000, 9000, (16, 4))
    start = rng.integers(0, 16, 2000)
    entry, _, compared = assign(book[start] + rng.integers(-20, 20, (2000, 4)), book, start)
    assert (entry == start).all() and compared < 200              # of 30,000


def brute_white(rows, weights="one", k=4):
    rows = [r for r in kept(rows, 256) if r[1]]
    xs = [tuple(r[1]) for r in rows]
    fit = sorted(set(xs)) if weights == "one" else sorted(xs)
    n, s = len(fit), [sum(c) for c in zip(*fit)]
    m = np.array(fit, float) - np.array(s) / n
    v = m.T @ m / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    return rows, n, s, e, u, v


@pytest.mark.parametrize("weights", ["one", "count"])
def test_whitening_equals_plain_numpy(vectors, weights):
    rows = some_rows(200, 6)
    got = whitening.whiten(vectors(rows).repartition(7), weights=weights).collect()
    rows, n, s, e, u, v = brute_white(rows, weights)
    assert len(got) == 4 * len(rows)
    by = {}
    for r in got:
        by.setdefault((r.vec_id, r.component), []).append(r)
    signs = {}
    for i, x, _ in rows:
        copies = sum(1 for _, y, _ in rows if y == x)
        for c in range(4):
            want = float((np.array(x, float) - np.array(s) / n) @ u[:, c]) / math.sqrt(e[c])
            for r in by[i, c + 1]:
                sign = signs.setdefault(c, 1 if r.whitened * want >= 0 else -1)
                assert r.whitened == pytest.approx(sign * want, abs=1e-9)
                assert (r.n, r.deviation) == (n, sum((n * a - b) ** 2 for a, b in zip(x, s)))
                assert r.explained == pytest.approx(e[c] / np.trace(v)) and r.identity_error < 1e-9
                assert r.multiplicity == copies


def test_whitening_of_degenerate_and_huge_vectors(vectors):
    same = whitening.whiten(vectors([(1, [0.5, 0.5], 1), (1, [0.5, 0.5], 1), (None, [0.5, 0.5], 1)])).collect()
    assert len(same) == 6 and {(r.n, r.deviation, r.whitened, r.explained, r.identity_error, r.multiplicity)
                               for r in same} == {(1, 0, None, 0.0, 0.0, 3)}
    line = whitening.whiten(vectors([(i, [i / 4, i / 2, 0.0], 1) for i in range(9)] + [(9, [], 1), (10, [1.0], 1)])).collect()
    assert {r.component for r in line if r.whitened is not None} == {1}
    assert all(r.identity_error < 1e-9 for r in line if r.n == 9)
    huge = whitening.whiten(vectors([(1, [3e38, 0.0], 1), (2, [-3e38, 1.0], 1), (3, [0.0, 1.0], 1)])).collect()
    assert {r.vec_id for r in huge} == {1, 2, 3} and {r.deviation for r in huge if r.vec_id != 3} == {None}
    assert whitening.whiten(vectors([])).collect() == []


def test_registered_whitening_covers_every_row(spark):
    got = queries.op13_embedding_whitening(spark, SF01)
    assert got.count() == 4 * spark.read.parquet(f"{SF01}/embeddings.parquet").count()
    assert got.agg(F.max("identity_error")).first()[0] < 1e-9
