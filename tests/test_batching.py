from prefweave.operators.batching import assign_batches, collect_batches, pad_batches


def test_batches_and_left_padding(spark):
    df = spark.createDataFrame([(i, ["t"] * (i + 1)) for i in range(5)], "pos long, tokens array<string>")
    b = assign_batches(df, 2)
    groups = {r.batch_id: list(r.positions) for r in collect_batches(b, value="tokens").collect()}
    assert groups == {0: [0, 1], 1: [2, 3], 2: [4]}
    rows = {r.pos: r for r in pad_batches(b, "tokens", pad="<p>").collect()}
    assert rows[0].input_tokens == ["<p>", "t"] and rows[0].attention_mask == [0, 1]
    assert rows[1].input_tokens == ["t", "t"] and rows[1].attention_mask == [1, 1]
    assert rows[4].width == 5 and rows[4].attention_mask == [1] * 5


def test_with_positions_dense_for_any_partitioning(spark):
    from prefweave.operators.batching import with_positions
    ids = [i * 3 + (i % 2) for i in range(500)]          # gaps, unsorted input below
    df = spark.createDataFrame([(k, f"t{k}") for k in reversed(ids)], "k long, v string").repartition(7)
    got = {r.k: r.pos for r in with_positions(df, ["k"]).collect()}
    assert got == {k: i for i, k in enumerate(sorted(ids))}


def test_with_positions_empty(spark):
    from prefweave.operators.batching import with_positions
    df = spark.createDataFrame([], "k long")
    assert with_positions(df, ["k"]).count() == 0


def test_constant_width_padding_is_narrow_and_never_cuts(spark):
    import pytest
    df = spark.createDataFrame([(0, ["a"]), (1, ["a", "b", "c"])], "pos long, tokens array<string>")
    out = pad_batches(assign_batches(df, 2), "tokens", pad="<p>", width=3)
    rows = {r.pos: r for r in out.collect()}
    assert rows[0].input_tokens == ["<p>", "<p>", "a"] and rows[0].attention_mask == [0, 0, 1]
    assert rows[1].input_tokens == ["a", "b", "c"] and rows[1].attention_mask == [1, 1, 1]
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(Exception, match="longer than the width"):
        pad_batches(assign_batches(df, 2), "tokens", pad="<p>", width=2).collect()


def test_batch_ids_are_exact_for_large_positions(spark):
    df = spark.createDataFrame([(9007199254740993,)], "pos long")
    assert assign_batches(df, 1).first().batch_id == 9007199254740993
