import math

import pytest
from pyspark.sql import functions as F

from prefweave.operators import judge, metrics
from prefweave.plans import catalog
from tests.conftest import SF01


def test_loss_is_stable_and_correct(spark):
    df = spark.createDataFrame([(1, 1, 0.0, 0.0, 0.0, 0.0), (1, 2, 9000.0, 0.0, 0.0, 0.0),
                                (1, 3, 0.0, 9000.0, 0.0, 0.0)],
                               "step long, pair_id long, pol_c double, pol_r double, ref_c double, ref_r double")
    rows = {r.pair_id: r for r in metrics.preference_metrics(df, 0.1).collect()}
    assert rows[1].loss == pytest.approx(math.log(2))
    assert rows[2].loss == pytest.approx(0.0, abs=1e-12)
    assert rows[3].loss == pytest.approx(900.0)
    assert (rows[1].correct, rows[2].correct, rows[3].correct) == (False, True, False)


def test_fixture_summary_values(spark):
    # The same from plain numpy: sums of each vector's quarters, beta 0.1.
    import numpy as np
    vectors = np.array([r.embedding for r in spark.read.parquet(f"{SF01}/embeddings.parquet").collect()], float)
    pol_c, pol_r, ref_c, ref_r = (vectors.reshape(len(vectors), 4, -1).sum(axis=2) * 100).T
    margin = 0.1 * (pol_c - ref_c) - 0.1 * (pol_r - ref_r)
    r = catalog.q_preference_summary(spark, SF01).first()
    assert (r.loss, r.margin, r.accuracy) == pytest.approx(
        (np.logaddexp(0, -margin).mean(), margin.mean(), (margin > 0).mean()), abs=1e-6)


def test_eval_points_carry_the_last_step_reached(spark):
    # Steps 1-3, 12 and 31-41: points 10 (step 3), 20 and 30 (step 12, none in between), 40; 50 is not reached.
    steps = [1, 2, 3, 12, *range(31, 42), 0, None]
    rows = spark.createDataFrame([(s, float(s or 0), k) for s in steps for k in (0, 1)], "step long, pol_c double, pair_id long")
    logged = rows.select("step", "pair_id", "pol_c", *[F.lit(0.0).alias(c) for c in ("pol_r", "ref_c", "ref_r")])
    got = metrics.eval_points(metrics.preference_metrics(logged, 1.0), 10).orderBy("eval_step").collect()
    assert [(r.eval_step, r.last_step, r.n_pairs, r.margin) for r in got] == [
        (10, 3, 2, 3.0), (20, 12, 2, 12.0), (30, 12, 2, 12.0), (40, 40, 2, 40.0)]
    assert metrics.eval_points(metrics.preference_metrics(logged.where("step < 0"), 1.0), 10).count() == 0


def test_metric_log_buckets(spark):
    df = spark.createDataFrame([(s, s, 0.0, 0.0, 0.0, 0.0) for s in range(1, 61)],
                               "step long, pair_id long, pol_c double, pol_r double, ref_c double, ref_r double")
    log = metrics.metric_log(metrics.preference_metrics(df), 25).collect()
    assert {r.log_step: r.n_pairs for r in log} == {25: 25, 50: 25, 75: 10}
    assert {r.log_step: (r.last_step, r.complete) for r in log} == {25: (25, True), 50: (50, True), 75: (60, False)}


def test_turns_do_not_mix(spark):
    ans = spark.createDataFrame([(1, t, m, 10 * t) for t in (1, 2) for m in ("m1", "m2")],
                                "question_id long, turn int, model string, n_chars long")
    assert sorted((r.turn, r.n_chars_a, r.n_chars_b) for r in judge.pairwise_matchups(ans).collect()) == \
        [(1, 10, 10), (2, 20, 20)]
    assert sorted((r.turn, r.n_chars) for r in judge.baseline_matchups(ans, "m1").collect()) == [(1, 10), (2, 20)]


def test_published_judge_rows_golden(spark):
    # 61 wins, 20 losses, 79 ties for the tuned model over 160 judgements.
    rows = [(i, "tuned", "base", "a") for i in range(61)] + \
           [(100 + i, "tuned", "base", "b") for i in range(20)] + \
           [(200 + i, "base", "tuned", "tie") for i in range(79)]
    j = spark.createDataFrame(rows, "question_id long, model_a string, model_b string, winner string")
    board = judge.leaderboard(judge.win_rates(j)).collect()
    assert [r.model for r in board] == ["tuned", "base"]
    got = {r.model: r for r in board}
    t, b = got["tuned"], got["base"]
    assert (t.win, t.loss, t.tie) == (61, 20, 79)
    assert (t.win_rate, t.loss_rate, t.win_rate_adjusted) == pytest.approx((0.38125, 0.125, 0.628125))
    assert (b.win_rate, b.loss_rate, b.win_rate_adjusted) == pytest.approx((0.125, 0.38125, 0.371875))


def test_wins_equal_losses_and_top_model(spark):
    w = catalog.q_pairwise_win_rates(spark, SF01)
    tot = w.agg(F.sum("win").alias("w"), F.sum("loss").alias("l")).first()
    assert tot.w == tot.l
    top = w.orderBy(F.desc("win_rate_adjusted"), "model").first()
    assert (top.model, top.win, top.loss, top.tie) == ("src0", 526, 359, 65)
    assert (top.win_rate, top.win_rate_adjusted) == (0.553684, 0.587895)


def test_matchups_match_brute_force(spark):
    ans = spark.createDataFrame([(1, "m1", 10), (1, "m2", 20), (1, "m3", 30), (2, "m1", 5), (2, "m3", 6),
                                 (2, "Zed", 1), (2, "éa", 2), (2, None, 3), (3, "éa", 4), (3, "e", 5)],
                                "question_id long, model string, n_chars long")
    got = sorted((r.question_id, r.model_a, r.model_b) for r in judge.pairwise_matchups(ans).collect())
    rows = ans.collect()
    want = sorted((a.question_id, a.model, b.model) for a in rows for b in rows
                  if a.question_id == b.question_id and a.model is not None and b.model is not None
                  and a.model.encode() < b.model.encode())
    assert got == want
    assert judge.pairwise_matchups(ans.where("model IS NULL")).count() == 0


def test_any_number_of_models(spark):
    ans = spark.range(1500).selectExpr("id div 500 question_id", "concat('m', id) model", "1L n_chars")
    assert judge.pairwise_matchups(ans).count() == 3 * 500 * 499 // 2


def test_unknown_verdicts_do_not_fail(spark):
    j = spark.createDataFrame([(1, "x", "y", "a"), (2, "x", "y", None), (3, "z", "z2", "error")],
                              "question_id long, model_a string, model_b string, winner string")
    got = {r.model: r for r in judge.win_rates(j).collect()}
    assert (got["x"].win, got["x"].unknown, got["x"].win_rate) == (1, 1, 1.0)
    assert (got["z"].win, got["z"].unknown, got["z"].win_rate) == (0, 1, None)


def test_baseline_win_rates_balance(spark):
    rows = {r.model: r for r in catalog.q_baseline_win_rates(spark, SF01).collect()}
    base = rows.pop(catalog.BASELINE_MODEL)
    assert base.win == sum(r.loss for r in rows.values())
    assert base.loss == sum(r.win for r in rows.values())
    assert base.tie == sum(r.tie for r in rows.values())
