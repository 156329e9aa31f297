import pytest
from pyspark.sql import functions as F

from prefweave.plans import catalog
from prefweave.plans.prepare import prepare_preference_data
from prefweave.session import scratch_path
from prefweave.streaming.metric_log import run_metric_log_stream
from tests.conftest import SF001, SF01


def test_prepare_writes_reads_back_and_caches(spark):
    root = scratch_path(spark, "test-prepare")
    pairs = catalog.pairs(spark, SF01)
    first = prepare_preference_data(spark, pairs, source="t", n_samples=80, root=root)
    tr = {r.pair_id for r in first["train"].collect()}
    te = {r.pair_id for r in first["test"].collect()}
    assert not (tr & te)
    assert len(te) == int(0.2 * (len(tr) + len(te)))
    assert set(first["train"].columns) == {"pair_id", "prompt", "chosen", "rejected"}
    bad = {r.pair_id for r in first["quarantine"].collect()}
    assert len(tr) + len(te) + len(bad) == 80 and not bad & (tr | te)
    # The same rows in another order come from the same files; other rows do not.
    same = prepare_preference_data(spark, pairs.repartition(3), source="t", n_samples=80, root=root)
    assert sorted(same["test"].inputFiles()) == sorted(first["test"].inputFiles())
    fewer = prepare_preference_data(spark, pairs.where("pair_id < 90"), source="t", n_samples=80, root=root)
    ids = {r.pair_id for s in fewer.values() for r in s.collect()}
    assert len(ids) == 80 and max(ids) < 90
    import pytest
    prepare_preference_data(spark, pairs, source="t", n_samples=10_000, allow_fewer=True, root=root)
    with pytest.raises(ValueError):
        prepare_preference_data(spark, pairs, source="t", n_samples=10_000, root=root)


def test_pairs_follow_the_table(spark):
    src = scratch_path(spark, "test-growing")
    conversations = catalog.conversations(spark, SF001)
    conversations.where("conv_id < 10").write.parquet(f"{src}/conversations.parquet")
    assert catalog.q_pair_status(spark, src).count() == 10
    conversations.where("conv_id between 10 and 17").write.mode("append").parquet(f"{src}/conversations.parquet")
    assert catalog.q_pair_status(spark, src).count() == 18


def test_token_lengths_follow_the_splits(spark):
    import pytest
    from prefweave.plans.prepare import token_length_table
    root = scratch_path(spark, "test-lengths")
    row = spark.createDataFrame([(1, "a b", " c", " d e")], "pair_id long, prompt string, chosen string, rejected string")
    one = token_length_table(spark, {"train": row}, source="s", root=root)
    two = token_length_table(spark, {"train": row.withColumn("prompt", F.lit("a b x y"))}, source="s", root=root)
    assert (one.first().prompt_len, two.first().prompt_len) == (2, 4)
    with pytest.raises(ValueError):
        token_length_table(spark, {"train": row}, source="s", root=root, tokenizer=str.split)


def test_bad_lines_show(spark):
    import pytest
    from pyspark.errors import PySparkException
    from prefweave.sources.records import read_lines, read_pairs
    path = scratch_path(spark, "test-bad-lines")
    lines = ['{"chosen":[{"role":"user","content":"q"}],"rejected":null}', '{"chosen":[{"role":"us']
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(path)
    from prefweave.schemas import PAIR
    assert [r._corrupt_record for r in read_lines(spark, path, PAIR).collect() if r._corrupt_record] == [lines[1]]
    with pytest.raises(PySparkException):
        read_pairs(spark, path, fmt="json").collect()


def test_pairs_without_keys(spark):
    from prefweave.operators.sampling import sample_n, split_column
    from prefweave.sources.records import read_pairs, write_records
    path = scratch_path(spark, "test-keyless")
    pairs = catalog.pairs(spark, SF01).drop("pair_id")
    write_records(pairs.unionByName(pairs), path)
    back = read_pairs(spark, path, fmt="json")
    assert back.where("pair_id is null").count() == 0 and back.count() == 2 * pairs.count()
    assert sample_n(back, 33).count() == 33
    assert split_column(back, test_size=33).where("split = 'test'").count() == 33


def test_stream_equals_batch(spark):
    out = scratch_path(spark, "test-stream")
    s = run_metric_log_stream(spark, SF001, "embeddings.parquet", out=out)
    b = catalog.q_preference_metric_log(spark, SF001)
    cols = ["log_step", "n_pairs", "loss", "margin", "accuracy"]
    rs = sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r)
                for r in s.select(*cols).collect())
    rb = sorted(tuple(r) for r in b.select(*cols).collect())
    assert rs == rb


def test_prepare_parquet_equals_json(spark):
    pairs = catalog.pairs(spark, SF001)
    root = scratch_path(spark, "test-fmt")
    j = prepare_preference_data(spark, pairs, source="f", n_samples=None, root=root)
    p = prepare_preference_data(spark, pairs, source="f", n_samples=None, root=root, fmt="parquet")
    for s in ("train", "test"):
        assert sorted(map(tuple, j[s].collect())) == sorted(map(tuple, p[s].collect()))


def test_read_pairs_json_keeps_nested_schema(spark):
    from prefweave.schemas import PAIR
    from prefweave.sources.records import read_pairs, write_records
    path = scratch_path(spark, "test-pairs")
    pairs = catalog.pairs(spark, SF001)
    write_records(pairs, path)
    back = read_pairs(spark, path, fmt="json")
    assert back.schema == PAIR
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, pairs.collect()))


def test_stream_resumes_from_checkpoint(spark):
    """Files that arrive after a run are folded into the state the checkpoint
    kept; step 63 has rows in both drops, so its group must merge across runs."""
    from prefweave.sources.tables import read_table
    src = scratch_path(spark, "test-stream-src")
    out = scratch_path(spark, "test-stream-out")
    ckpt = out + "-checkpoint"
    emb = read_table(spark, SF001, "embeddings")
    emb.where("vec_id < 250").coalesce(1).write.parquet(src)
    first = run_metric_log_stream(spark, src, out=out, checkpoint=ckpt)
    assert first.agg(F.sum("n_pairs")).first()[0] == 250
    emb.where("vec_id >= 250").coalesce(1).write.mode("append").parquet(src)
    again = run_metric_log_stream(spark, src, out=out, checkpoint=ckpt)
    b = catalog.q_preference_metric_log(spark, SF001)
    cols = ["log_step", "n_pairs", "loss", "margin", "accuracy"]
    rs = sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r)
                for r in again.select(*cols).collect())
    assert rs == sorted(tuple(r) for r in b.select(*cols).collect())


def test_prepare_writes_quarantine_and_strict_fails(spark):
    import pytest
    from pyspark.errors import PySparkException
    from py4j.protocol import Py4JJavaError
    from prefweave.schemas import PAIR
    from prefweave.sources.records import read_records
    from pyspark.sql import types as T

    good = [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]
    rows = [(1, good, good), (2, [{"role": "user", "content": "q"}], good)]
    pairs = spark.createDataFrame(rows, PAIR)
    qpath = scratch_path(spark, "test-quarantine")
    out = prepare_preference_data(spark, pairs, source="q", n_samples=None, quarantine_path=qpath,
                                  root=scratch_path(spark, "test-q-root"))
    assert out["train"].count() + out["test"].count() == 1
    bad = read_records(spark, qpath, T.StructType([T.StructField("pair_id", T.LongType()),
                                                   T.StructField("status", T.StringType())]))
    assert [tuple(r) for r in bad.collect()] == [(2, "no_assistant")]
    with pytest.raises((PySparkException, Py4JJavaError)):
        prepare_preference_data(spark, pairs, source="q", n_samples=None, mode="strict",
                                root=scratch_path(spark, "test-strict-root"))


def test_read_pairs_selects_split_subdirectory(spark):
    from prefweave.sources.records import read_pairs, write_records
    base = scratch_path(spark, "test-pair-splits")
    pairs = catalog.pairs(spark, SF001)
    write_records(pairs.where("pair_id < 5"), base + "/train")
    write_records(pairs.where("pair_id >= 5"), base + "/test")
    got = read_pairs(spark, base, fmt="json", split="train")
    assert sorted(r.pair_id for r in got.collect()) == [0, 1, 2, 3, 4]


def test_prepare_is_independent_of_partitioning(spark):
    pairs = catalog.pairs(spark, SF01)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    try:
        for n in ("3", "13"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            out = prepare_preference_data(spark, pairs.repartition(int(n)), source="parts", n_samples=60,
                                          root=scratch_path(spark, f"test-parts-{n}"))
            results.append({s: sorted(map(tuple, out[s].collect())) for s in ("train", "test")})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1]
    assert len(results[0]["test"]) == int(0.2 * (len(results[0]["train"]) + len(results[0]["test"])))


def test_stream_readers_see_whole_tables(spark):
    """Between epochs, after a batch that died before its announcement, and
    after one that was written twice; an empty source gives an empty table."""
    from prefweave.schemas import TABLES
    from prefweave.sources.tables import read_table
    from prefweave.streaming.metric_log import announced, publish, read_published
    src, out = scratch_path(spark, "test-pub-src"), scratch_path(spark, "test-pub-out")
    spark.createDataFrame([], TABLES["embeddings"]).write.parquet(src)
    empty = run_metric_log_stream(spark, src, out=out)
    assert empty.count() == 0 and "loss" in empty.columns and empty.schema["n_pairs"].dataType.typeName() == "long"
    emb, seen = read_table(spark, SF001, "embeddings"), []
    for k in range(3):
        emb.where(F.col("vec_id") % 3 == k).coalesce(1).write.mode("append").parquet(src)
        seen.append(run_metric_log_stream(spark, src, out=out, checkpoint=out + "-checkpoint"))
    # Readers of the earlier tables still read theirs, whole.
    total = emb.count()
    counts = [t.agg(F.sum("n_pairs")).first()[0] for t in seen]
    assert counts[0] < counts[1] < counts[2] == total
    # A batch that is written and not announced does not show; one announced twice counts once.
    schema, last = seen[-1].schema, announced(spark, out)[-1][0]
    seen[-1].limit(1).write.parquet(f"{out}/tables/epoch-{last + 1:09d}-dead")      # its writer died
    assert read_published(spark, out, schema).agg(F.sum("n_pairs")).first()[0] == total
    for _ in range(2):
        publish(seen[-1], last + 1, out)
    now = [read_published(spark, out, schema).inputFiles() for _ in range(2)]
    assert now[0] == now[1] and read_published(spark, out, schema).count() == seen[-1].count()


@pytest.mark.parametrize("compact_every", [50, 2])
def test_stream_publishes_a_closed_block_once(spark, compact_every):
    """Steps in order over five drops: an epoch holds the blocks it changed, a
    closed block stands in one epoch, and the log is the batch's after each drop;
    late rows of a closed block correct it. The same with whole tables between."""
    from prefweave.operators.metrics import metric_log, preference_metrics
    from prefweave.sources.fixtures import logprobs_from_embeddings
    from prefweave.sources.tables import read_table
    from prefweave.streaming.metric_log import announced, closed_blocks, published_epochs
    src, out, every = scratch_path(spark, "test-closed-src"), scratch_path(spark, "test-closed-out"), 10
    emb = read_table(spark, SF001, "embeddings")
    step = logprobs_from_embeddings(emb).select("pair_id", "step")
    steps = {r["pair_id"]: r["step"] for r in step.collect()}
    last = max(steps.values())
    late = sorted(k for k, v in steps.items() if v == 3)[0]
    bounds = [0, last // 4, last // 2, 3 * last // 4, last]
    drops = [[k for k, v in steps.items() if lo < v <= hi and k != late] for lo, hi in zip(bounds, bounds[1:])] + [[late]]
    written, so_far = [], []
    for drop in drops:
        emb.where(F.col("vec_id").isin(drop)).coalesce(1).write.mode("append").parquet(src)
        so_far += drop
        log = run_metric_log_stream(spark, src, every=every, out=out, checkpoint=out + "-c", compact_every=compact_every)
        batch = metric_log(preference_metrics(logprobs_from_embeddings(emb.where(F.col("vec_id").isin(so_far)))), every)
        cols = ["log_step", "last_step", "n_pairs", "complete", F.round("loss", 9).alias("loss")]
        assert sorted(log.select(*cols).collect()) == sorted(batch.select(*cols).collect())
        assert sorted(closed_blocks(spark, out, log.schema).select(*cols).collect()) == sorted(
            batch.where("complete").select(*cols).collect())
        written.append({(r["epoch"], r["log_step"]) for r in
                        published_epochs(spark, out, log.schema).where("complete").select("epoch", "log_step").collect()})
    assert [whole for _, _, whole in announced(spark, out)] == [(e + 1) % compact_every == 0 for e in range(5)]
    if compact_every == 50:
        before, after = [b for _, b in written[-2]], [b for _, b in written[-1]]
        assert len(before) == len(set(before)) and sorted(after) == sorted(before + [every])
