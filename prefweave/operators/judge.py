"""Judge evaluation over answer and judgement tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Shares one question's answers are dealt into, by a hash of the model.
SPREAD = 8


def pairwise_matchups(answers: DataFrame, spread: int = SPREAD) -> DataFrame:
    """Every unordered pair of models that answered the same question (J1), in
    the same turn of it where the answers have a ``turn``.

    An equi-join on the question with ``model_a < model_b``. So that a question
    with very many answers is not one join key, side b is dealt into ``spread``
    shares by a hash of its model and side a is copied into each: the copies do
    not depend on how many models there are.
    """
    key = _question(answers)
    share = F.pmod(F.xxhash64("model"), F.lit(spread)).cast("int")
    a = answers.select(*key, F.col("model").alias("model_a"), F.col("n_chars").alias("n_chars_a"),
                       F.explode(F.sequence(F.lit(0), F.lit(spread - 1))).alias("share"))
    b = answers.select(*key, F.col("model").alias("model_b"), F.col("n_chars").alias("n_chars_b"),
                       share.alias("share"))
    return (a.join(b, [*key, "share"]).where("model_a < model_b")
            .select(*key, "model_a", "model_b", "n_chars_a", "n_chars_b"))


def _question(answers: DataFrame) -> list[str]:
    return ["question_id", *(c for c in ("turn",) if c in answers.columns)]


def baseline_matchups(answers: DataFrame, baseline: str) -> DataFrame:
    """Every non-baseline answer against the baseline's answer to the same
    question (J2), and turn. The baseline side has one row per question and
    turn, so a hot question only lengthens the streamed side; AQE picks
    broadcast from the measured size when it is small."""
    key = _question(answers)
    base = answers.where(F.col("model") == baseline).select(
        *key, F.col("n_chars").alias("baseline_n_chars"))
    return (answers.where(F.col("model") != baseline)
            .join(base, key)
            .select(*key, "model", F.lit(baseline).alias("baseline"),
                    "n_chars", "baseline_n_chars"))


def baseline_judgement_frame(matchups: DataFrame) -> DataFrame:
    """Baseline match-ups in the pairwise judgement layout: the model under
    test is side a, the baseline side b (``n_chars_a`` / ``n_chars_b``)."""
    return matchups.select("question_id", F.col("model").alias("model_a"),
                           F.col("baseline").alias("model_b"),
                           F.col("n_chars").alias("n_chars_a"),
                           F.col("baseline_n_chars").alias("n_chars_b"))


def win_rates(judgements: DataFrame) -> DataFrame:
    """Win/loss/tie per model, each judgement counted from both sides.

    One scan: every judgement becomes two perspective rows by ``explode``,
    then a partial + final aggregation by model. Other verdicts (null included)
    are counted in ``unknown`` and take no part in the rates, which are null for
    a model without a known verdict.
    """
    w = F.col("winner")

    def side(model: str, won: str, lost: str):
        return F.struct(F.col(model).alias("model"), (w == won).cast("bigint").alias("win"),
                        (w == lost).cast("bigint").alias("loss"),
                        (w == "tie").cast("bigint").alias("tie"),
                        (~F.coalesce(w.isin("a", "b", "tie"), F.lit(False))).cast("bigint").alias("unknown"))

    per_side = judgements.select(F.explode(F.array(side("model_a", "a", "b"),
                                                   side("model_b", "b", "a"))).alias("s")).select("s.*")
    counts = per_side.groupBy("model").agg(F.sum("win").alias("win"), F.sum("loss").alias("loss"),
                                            F.sum("tie").alias("tie"), F.sum("unknown").alias("unknown"))
    counts = counts.fillna(0, ["win", "loss", "tie"])
    n = F.col("win") + F.col("loss") + F.col("tie")
    return counts.withColumns({
        "win_rate": F.try_divide(F.col("win"), n),
        "loss_rate": F.try_divide(F.col("loss"), n),
        "win_rate_adjusted": F.try_divide(F.col("win") + 0.5 * F.col("tie"), n),
    })


def leaderboard(rates: DataFrame) -> DataFrame:
    """Win rates in published order: best adjusted win rate first, then model
    name (J4). One row per model, so the global sort is small."""
    return rates.orderBy(F.desc("win_rate_adjusted"), F.asc("model"))


def score_summary(scores: DataFrame) -> DataFrame:
    """Single-answer grading: mean score per model and turn."""
    return scores.groupBy("model", "turn").agg(F.count(F.lit(1)).alias("n_scores"),
                                              F.avg("score").alias("avg_score"))
