import hashlib

import pytest
from pyspark.sql import functions as F

from prefweave.operators import sampling
from prefweave.operators.sampling import sample_n, split_column, train_test_split


def brute_order(keys, seed):
    return sorted(keys, key=lambda k: (hashlib.md5(f"{seed}:{k}".encode()).hexdigest(), k))


@pytest.fixture(scope="module")
def keys_df(spark):
    return spark.range(0, 1000).withColumnRenamed("id", "pair_id")


def test_sample_matches_brute_force(keys_df):
    got = sorted(r.pair_id for r in sample_n(keys_df, 137, seed=42).collect())
    assert got == sorted(brute_order(range(1000), 42)[:137])


def test_sample_same_for_any_partitioning(keys_df):
    a = {r.pair_id for r in sample_n(keys_df.repartition(1), 50, seed=3).collect()}
    b = {r.pair_id for r in sample_n(keys_df.repartition(16), 50, seed=3).collect()}
    assert a == b and len(a) == 50


def test_sample_fewer_rows(keys_df):
    with pytest.raises(ValueError):
        sample_n(keys_df, 5000)
    assert sample_n(keys_df, 5000, allow_fewer=True).count() == 1000


def test_null_and_repeated_keys_stay_exact(spark):
    rows = [(None, i) for i in range(20)] + [(1, i) for i in range(20)] + [(2, 7)] * 30
    df = spark.createDataFrame(rows, "pair_id long, v long")
    for n in (1, 3, 10, 25, 40, 55, 69):
        got = sorted((str(r.pair_id), r.v) for r in sample_n(df, n).collect())
        assert len(got) == n
        assert got == sorted((str(r.pair_id), r.v) for r in sample_n(df.repartition(5), n).collect())
        parts = dict(split_column(df, test_size=n).groupBy("split").count().collect())
        assert parts == {"test": n, "train": 70 - n}
    whole = sorted((str(r.pair_id), r.v) for r in split_column(df, test_size=45).collect())
    assert whole == sorted((str(k), v) for k, v in rows)


def test_all_null_keys(spark):
    df = spark.range(50).selectExpr("cast(null as bigint) pair_id", "id v")
    assert sample_n(df, 10).count() == 10


def test_split_exact_disjoint_complete(keys_df):
    parts = train_test_split(keys_df, test_fraction=0.2, seed=7)
    tr = {r.pair_id for r in parts["train"].collect()}
    te = {r.pair_id for r in parts["test"].collect()}
    assert len(te) == 200 and len(tr) == 800
    assert tr | te == set(range(1000)) and not (tr & te)
    assert te == set(brute_order(range(1000), 7)[:200])


def test_split_partition_independent(keys_df):
    a = {r.pair_id for r in split_column(keys_df.repartition(1)).where("split = 'test'").collect()}
    b = {r.pair_id for r in split_column(keys_df.repartition(5)).where("split = 'test'").collect()}
    assert a == b


def test_split_of_100_is_20_80(spark):
    df = spark.range(100).withColumnRenamed("id", "pair_id")
    counts = dict(split_column(df).groupBy("split").count().collect())
    assert counts == {"test": 20, "train": 80}


def test_sample_plan_keeps_input_partitioning(keys_df):
    # Selection is a filter on a scalar cutoff: no global sort of the rows.
    plan = sample_n(keys_df, 10)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" not in plan and "Sort" not in plan


@pytest.mark.parametrize("k", [1, 16, 63, 299, 999, 1000])
def test_prefix_search_exact_for_any_k(keys_df, monkeypatch, k):
    monkeypatch.setattr(sampling, "_PREFIX_CHARS", 1)
    keys = keys_df.select(sampling.order_hash("pair_id", 5).alias("h"), "pair_id")
    prefix, want, size, _, total = sampling.cutoff(keys, "h", k)
    assert total == 1000 and want == size
    assert keys.where(F.substring("h", 1, len(prefix)) <= prefix).count() == k


def test_split_larger_than_input_fails(keys_df):
    with pytest.raises(ValueError):
        split_column(keys_df, test_size=1001)
    assert split_column(keys_df, test_size=1000).where("split = 'test'").count() == 1000
