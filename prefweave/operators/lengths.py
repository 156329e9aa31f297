"""Token-length statistics and the length filter."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from prefweave import constants as C
from prefweave.functions.tokens import round_up_even, token_count


def with_token_lengths(triplets: DataFrame, tokenizer: Callable | None = None,
                       batched: bool = False) -> DataFrame:
    """Token counts of prompt, prompt+chosen and prompt+rejected.

    Counted on the concatenated text, as the reference does: a token may span
    the boundary. Computed once here and reused by statistics and filter.
    """
    p, c, r = F.col("prompt"), F.col("chosen"), F.col("rejected")
    return triplets.withColumns({
        "prompt_len": token_count(p, tokenizer, batched),
        "prompt_chosen_len": token_count(F.concat(p, c), tokenizer, batched),
        "prompt_rejected_len": token_count(F.concat(p, r), tokenizer, batched),
    })


def length_limits(lengths: DataFrame, target_percentile: float = C.TARGET_PERCENTILE,
                  approx_accuracy: int | None = None) -> DataFrame:
    """One row of limits from the lengths of one split.

    Exact ``percentile`` with linear interpolation, truncated to an integer.
    Its aggregation buffer is a map of distinct lengths, merged map-side, so a
    single global group stays small however many rows there are. With
    ``approx_accuracy`` set, ``percentile_approx`` (a mergeable sketch) is used
    instead; it returns an observed value, not an interpolated one.
    """
    q = target_percentile / 100.0

    def pct(c: str) -> Column:
        if approx_accuracy is not None:
            return F.percentile_approx(F.col(c), q, approx_accuracy).cast("bigint")
        return F.floor(F.percentile(F.col(c), q)).cast("bigint")

    return (lengths.agg(pct("prompt_len").alias("prompt_length"),
                        pct("prompt_chosen_len").alias("max_seq_length_chosen"),
                        pct("prompt_rejected_len").alias("max_seq_length_rejected"))
            .withColumn("max_seq_length",
                        F.greatest("max_seq_length_chosen", "max_seq_length_rejected"))
            .withColumns({
                "prompt_length_even": round_up_even("prompt_length"),
                "max_seq_length_even": round_up_even("max_seq_length"),
            }))


def filter_by_length(lengths: DataFrame, max_seq_length, both: bool = False) -> DataFrame:
    """Keep rows whose prompt+chosen fits (P4). The reference tests only the
    chosen side even though the limit comes from both; ``both=True`` also
    tests prompt+rejected. ``max_seq_length`` is an int or a scalar Column,
    e.g. ``length_limits(train).select("max_seq_length").scalar()``, which
    Spark evaluates once as a subquery."""
    lim = F.lit(max_seq_length) if isinstance(max_seq_length, int) else max_seq_length
    cond = F.col("prompt_chosen_len") <= lim
    if both:
        cond = cond & (F.col("prompt_rejected_len") <= lim)
    return lengths.where(cond)
