"""Preference metrics from logged log-probabilities (M1-M3).

Input rows ``(step, pair_id, pol_c, pol_r, ref_c, ref_r)``: policy and
reference log-probabilities of the chosen and rejected responses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from prefweave import constants as C
from prefweave.functions.metrics import neg_log_sigmoid

DEFAULT_BETA = C.BETA


def preference_metrics(logprobs: DataFrame, beta: float = DEFAULT_BETA) -> DataFrame:
    """Per-pair implicit rewards, margin, sigmoid loss and correctness (M1)."""
    b = F.lit(float(beta))
    return (logprobs
            .withColumn("reward_chosen", b * (F.col("pol_c") - F.col("ref_c")))
            .withColumn("reward_rejected", b * (F.col("pol_r") - F.col("ref_r")))
            .withColumn("margin", F.col("reward_chosen") - F.col("reward_rejected"))
            .withColumn("loss", neg_log_sigmoid(F.col("margin")))
            .withColumn("correct", F.col("margin") > 0))


def _aggs():
    return [
        F.count(F.lit(1)).alias("n_pairs"),
        F.avg("loss").alias("loss"),
        F.avg("margin").alias("margin"),
        F.avg(F.col("correct").cast("double")).alias("accuracy"),
        F.avg("reward_chosen").alias("reward_chosen"),
        F.avg("reward_rejected").alias("reward_rejected"),
    ]


def summarize(rows: DataFrame) -> DataFrame:
    """Dataset-level means (M2). Global aggregate with map-side partials."""
    return rows.agg(*_aggs())


def metric_log(rows: DataFrame, every: int = C.LOGGING_STEPS) -> DataFrame:
    """Means over consecutive blocks of ``every`` steps (M3): the trainer's
    logging (25) or evaluation (700) interval. ``log_step`` names the block by
    its last step; ``last_step`` is the last step seen in it, and ``complete``
    says whether that is the block's end."""
    log_step = F.expr(f"((step - 1) div {int(every)} + 1) * {int(every)}")
    log = rows.groupBy(log_step.alias("log_step")).agg(F.max("step").alias("last_step"), *_aggs())
    return log.withColumn("complete", F.col("last_step") == F.col("log_step"))


def eval_points(rows: DataFrame, every: int = C.EVAL_STEPS) -> DataFrame:
    """The metrics at each evaluation point that was reached (M3): at every
    multiple of ``every`` up to the last step, those of the last step logged by
    then, ``last_step``. A point without a step of its own since the point before
    repeats that one. Steps are averaged first, with map-side partials; then one
    row a point is left to carry forward."""
    values = [c for c in ("n_pairs", "loss", "margin", "accuracy", "reward_chosen", "reward_rejected")]
    per_step = rows.where("step >= 1").groupBy("step").agg(*_aggs())
    point = F.expr(f"((step - 1) div {int(every)} + 1) * {int(every)}")
    at = per_step.groupBy(point.alias("eval_step")).agg(
        F.max_by(F.struct("step", *values), "step").alias("m"), F.max("step").alias("reached"))
    # A point holds until the next one that has steps of its own; the last holds
    # as far as steps go.
    order = Window.orderBy("eval_step")
    until = F.coalesce(F.lead("eval_step").over(order) - every, F.col("reached"))
    points = at.withColumn("until", until).where("until >= eval_step").select(
        F.explode(F.sequence("eval_step", "until", F.lit(int(every)).cast("bigint"))).alias("eval_step"), "m")
    return points.select("eval_step", F.col("m.step").alias("last_step"), *[F.col(f"m.{v}").alias(v) for v in values])
