"""The computed permutation: one to one, even, and the same for arrays and Columns."""

import contextlib
import io

import numpy as np
import pytest
from pyspark.sql import functions as F

from prefweave.operators.permutation import ends_of_walks, network, round_keys, shuffled_positions, sides


def plain(n, seed):
    a, b = sides(n)
    out = []
    for p in range(n):
        while True:
            left, right = network(p // b, p % b, a, b, round_keys(seed))
            p = left * b + right
            if p < n:
                break
        out.append(p)
    return out


@pytest.mark.parametrize("n", [1, 2, 3, 5, 7, 16, 97, 1000, 1023, 4099])
def test_each_place_is_taken_once(spark, n):
    got = [r.place for r in shuffled_positions(spark.range(n).withColumnRenamed("id", "pos"), n, seed=n).orderBy("pos").collect()]
    assert sorted(got) == list(range(n)) and got == plain(n, n)
    assert len(ends_of_walks(n, n)) < sides(n)[0]


def test_large_sizes_and_positions_outside(spark):
    n = (1 << 40) + 12345
    pos = [0, 1, 2, n // 2, n - 1, n, -1, None]
    rows = shuffled_positions(spark.createDataFrame([(p,) for p in pos], "pos bigint"), n).collect()
    got = {r.pos: r.place for r in rows}
    assert got[n] is got[-1] is got[None] is None
    places = [got[p] for p in pos[:5]]
    assert len(set(places)) == 5 and all(0 <= p < n for p in places)
    assert shuffled_positions(spark.createDataFrame([(0,)], "pos bigint"), 0).first().place is None


def test_the_permutation_is_even_and_seeded():
    n = 20_000
    a, b = sides(n)
    p = np.arange(n)
    left, right = network(p // b, p % b, a, b, round_keys(3))
    image = left * b + right
    # Tenths of the table land in tenths alike, and neighbours do not stay together.
    table, _, _ = np.histogram2d(p, image, bins=10)
    assert abs(table - n / 100).max() < 70
    assert abs(np.corrcoef(image[:-1], image[1:])[0, 1]) < 0.03
    other = network(p // b, p % b, a, b, round_keys(4))
    assert (other[0] * b + other[1] != image).mean() > 0.99


def test_no_exchange_and_no_sort(spark):
    df = shuffled_positions(spark.range(5000).select(F.col("id").alias("pos")), 5000)
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    plan = out.getvalue()
    assert "Sort" not in plan and "hashpartitioning" not in plan and "rangepartitioning" not in plan
