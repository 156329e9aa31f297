import numpy as np
from pyspark.sql import functions as F

from prefweave.functions.tokens import left_truncate, round_up_even, token_count, tokens
from prefweave.operators.batching import truncate_left
from prefweave.operators.lengths import filter_by_length, length_limits, with_token_lengths


def test_token_count(spark):
    df = spark.createDataFrame([("Hello, world! it's 42",), ("",), ("é x\x0by",)], "t string")
    got = [r.n for r in df.select(token_count("t").alias("n")).collect()]
    assert got == [8, 0, 3]


def test_round_up_even(spark):
    df = spark.createDataFrame([(931,), (932,), (1,)], "n long")
    assert [r.e for r in df.select(round_up_even("n").alias("e")).collect()] == [932, 932, 2]


def test_left_truncate_is_suffix_and_bounded(spark):
    df = spark.createDataFrame([([str(i) for i in range(k)],) for k in (0, 3, 10)], "a array<string>")
    rows = df.select("a", left_truncate("a", 5).alias("t")).collect()
    for r in rows:
        assert len(r.t) == min(5, len(r.a))
        assert r.t == r.a[len(r.a) - len(r.t):]


def test_percentile_limits_match_numpy(spark):
    vals = [int(x) for x in np.random.default_rng(0).integers(1, 500, 333)]
    df = spark.createDataFrame([(v, v + 3, v + 7) for v in vals],
                               "prompt_len long, prompt_chosen_len long, prompt_rejected_len long")
    r = length_limits(df).first()
    assert r.prompt_length == int(np.percentile(vals, 97))
    assert r.max_seq_length == int(np.percentile([v + 7 for v in vals], 97))
    assert r.max_seq_length_even % 2 == 0 and r.max_seq_length_even - r.max_seq_length in (0, 1)


def test_filter_uses_chosen_side_only_by_default(spark):
    df = spark.createDataFrame([(1, 5, 50), (2, 50, 5)], "pair_id long, prompt_chosen_len long, prompt_rejected_len long")
    assert {r.pair_id for r in filter_by_length(df, 10).collect()} == {1}
    assert filter_by_length(df, 10, both=True).count() == 0


def test_truncate_left_keeps_response_end(spark):
    df = spark.createDataFrame([("a b c d e f", "x y z")], "prompt string, chosen string")
    r = truncate_left(df, 4, 5).first()
    assert r.prompt_tokens == ["c", "d", "e", "f"]
    assert r.sequence_tokens == ["e", "f", "x", "y", "z"]


def test_user_tokenizer_hook(spark):
    df = spark.createDataFrame([("a b c",), (None,)], "t string")
    got = [r.n for r in df.select(token_count("t", tokenizer=lambda s: s.split()).alias("n")).collect()]
    assert got == [3, None]


def test_approximate_percentile_is_close(spark):
    vals = list(range(1, 10001))
    df = spark.createDataFrame([(v, v, v) for v in vals],
                               "prompt_len long, prompt_chosen_len long, prompt_rejected_len long")
    exact = length_limits(df).first().prompt_length
    approx = length_limits(df, approx_accuracy=10000).first().prompt_length
    assert exact == int(np.percentile(vals, 97))
    assert abs(approx - exact) <= 10


def test_batched_tokenizer_hook(spark):
    df = spark.createDataFrame([("a b c",), (None,), ("d e",)], "t string")

    def encode_batch(texts):
        return [t.split() for t in texts]

    got = [r.n for r in df.select(token_count("t", tokenizer=encode_batch, batched=True).alias("n")).collect()]
    assert got == [3, None, 2]


def test_lengths_count_the_concatenated_text(spark):
    # "ab" + "cd" is one token, as in the reference, which tokenises prompt + response.
    df = spark.createDataFrame([("ab", "cd", " x")], "prompt string, chosen string, rejected string")
    r = with_token_lengths(df).first()
    assert (r.prompt_len, r.prompt_chosen_len, r.prompt_rejected_len) == (1, 1, 2)


def test_vocabulary_file_reaches_the_workers(spark):
    from prefweave.functions import vocabulary
    from prefweave.functions.tokens import token_count
    words = spark.createDataFrame([("the",), ("cat",), ("l\u00e0",)], "word string")
    counter = vocabulary.send(spark, words)
    df = spark.createDataFrame([("the cat",), ("the\x0bcats  l\u00e0",), ("",), (None,), ("\u00a0the",)], "t string").repartition(3)
    got = {r.t: r.n for r in df.select("t", token_count("t", counter, batched=True).alias("n")).collect()}
    assert got == {"the cat": 2, "the\x0bcats  l\u00e0": 6, "": 0, None: None, "\u00a0the": 4}
    assert vocabulary.tokenize("the dog", frozenset({"the"})) == ["the", "d", "o", "g"]


def test_vocabulary_is_sent_as_files(spark):
    # A cluster takes no folder from a local disk, local mode does.
    import os
    from urllib.parse import urlparse
    from prefweave.functions import vocabulary
    before = set(spark.sparkContext.listFiles)
    vocabulary.send(spark, spark.createDataFrame([("the",)], "word string"))
    sent = [urlparse(f).path for f in set(spark.sparkContext.listFiles) - before]
    assert len(sent) == 1 and os.path.isfile(sent[0])


def test_empty_vocabulary(spark):
    from prefweave.functions import vocabulary
    counter = vocabulary.send(spark, spark.createDataFrame([], "word string"))
    df = spark.createDataFrame([("the cat",)], "t string")
    assert df.select(token_count("t", counter, batched=True)).first()[0] == 6
