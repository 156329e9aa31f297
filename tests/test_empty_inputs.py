"""Operators on empty inputs return empty (or zero-count) results, never errors."""

from prefweave.operators import judge
from prefweave.operators.lengths import length_limits
from prefweave.operators.sampling import sample_n, split_column
from prefweave.plans.prepare import prepare_preference_data
from prefweave.schemas import ANSWER, JUDGEMENT, PAIR
from prefweave.session import scratch_path


def test_empty_pairs_flow(spark):
    pairs = spark.createDataFrame([], PAIR)
    assert sample_n(pairs, 10, allow_fewer=True).count() == 0
    assert split_column(pairs).count() == 0
    out = prepare_preference_data(spark, pairs, source="empty", allow_fewer=True,
                                  root=scratch_path(spark, "test-empty"))
    import pytest
    with pytest.raises(ValueError):
        prepare_preference_data(spark, pairs, source="empty", root=scratch_path(spark, "test-empty2"))
    assert out["train"].count() == 0 and out["test"].count() == 0


def test_empty_judge_and_lengths(spark):
    assert judge.pairwise_matchups(spark.createDataFrame([], ANSWER)).count() == 0
    assert judge.win_rates(spark.createDataFrame([], JUDGEMENT)).count() == 0
    lens = spark.createDataFrame([], "prompt_len long, prompt_chosen_len long, prompt_rejected_len long")
    r = length_limits(lens).first()
    assert r.prompt_length is None and r.max_seq_length is None
