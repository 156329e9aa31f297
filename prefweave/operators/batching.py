"""Token truncation, padding and prompt batching."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from prefweave import constants as C
from prefweave.functions import templates as tpl
from prefweave.functions.tokens import attention_mask, left_pad, left_truncate, tokens


def truncate_left(triplets: DataFrame, max_prompt_length: int = C.MAX_PROMPT_LENGTH,
                  max_length: int = C.MAX_LENGTH, response: str = "chosen") -> DataFrame:
    """Keep the end of prompt and sequence so responses survive (K1, K2).

    prompt tokens -> last ``max_prompt_length``; then prompt + response tokens
    -> last ``max_length``.
    """
    pt = left_truncate(tokens("prompt"), max_prompt_length)
    return (triplets.withColumn("prompt_tokens", pt)
            .withColumn("sequence_tokens",
                        left_truncate(F.concat("prompt_tokens", tokens(response)), max_length)))


def template_prompts(prompts: DataFrame, template: tpl.ChatTemplate = tpl.ALTERNATING) -> DataFrame:
    """Render each plain prompt as a one-turn conversation."""
    return prompts.withColumn("templated", template.render_message(tpl.user_message("prompt")))


_ROW_BITS = 33          # monotonically_increasing_id: partition id above, row number below


def with_positions(df: DataFrame, order_by: list[str], pos: str = "pos",
                   then_by: list[str] | None = None) -> DataFrame:
    """Dense 0-based positions in ``order_by`` order (unique keys), for inputs
    without a list index (K4). ``then_by`` orders rows with equal keys, which
    meet in one partition.

    No global window (it would pull every row into one task): rows are range-
    partitioned and sorted, tagged with ``monotonically_increasing_id`` and
    written once to the shared folder, so the tags stay fixed even if an
    executor is lost. A table of one row per partition holds its offset and is
    broadcast (two numbers for each written file, so no row is shuffled again);
    a position is offset + row number within the partition.
    """
    from prefweave.session import scratch_path

    spark = df.sparkSession
    path = scratch_path(spark, "positions")
    (df.repartitionByRange(*order_by).sortWithinPartitions(*order_by, *(then_by or []))
     .withColumn("_mid", F.monotonically_increasing_id())
     .write.parquet(path))
    tagged = spark.read.parquet(path)
    pid = F.shiftright(F.col("_mid"), _ROW_BITS)
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (tagged.groupBy(pid.alias("_p")).count()              # one row per partition
               .select("_p", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before")))
    row = F.col("_mid").bitwiseAND((1 << _ROW_BITS) - 1)
    return (tagged.withColumn("_p", pid).join(F.broadcast(offsets), "_p")
            .withColumn(pos, (F.col("_before") + row).cast("bigint")).drop("_mid", "_p", "_before"))


def assign_batches(prompts: DataFrame, batch_size: int, pos: str = "pos") -> DataFrame:
    """Consecutive batches of ``batch_size`` by 0-based position; the last may
    be short (K4). ``pos`` must be dense, like a list index (see
    ``with_positions`` for inputs that only have an order)."""
    if batch_size <= 0:
        raise ValueError("batch_size must be positive")
    return prompts.withColumn("batch_id", F.expr(f"`{pos}` div {int(batch_size)}"))


def collect_batches(batched: DataFrame, pos: str = "pos", value: str = "prompt") -> DataFrame:
    """One row per batch with its members in order. Groups are bounded by the
    batch size, so collecting them is safe."""
    return (batched.groupBy("batch_id")
            .agg(F.sort_array(F.collect_list(F.struct(pos, value))).alias("members"))
            .select("batch_id", F.size("members").cast("bigint").alias("n_prompts"),
                    F.col("members").getField(pos).alias("positions"),
                    F.col("members").getField(value).alias("prompts")))


def pad_batches(batched: DataFrame, token_col: str = "tokens", pad: str = tpl.EOS,
                width: int | None = None) -> DataFrame:
    """Left-pad every sequence to the longest in its batch, with a mask (K3).

    The batch width is a window max partitioned by batch: one exchange, and a
    partition holds at most ``batch_size`` rows. With a constant ``width`` the
    step is narrow (no exchange). Padding never cuts: a sequence longer than the
    constant width fails the job (cut it first, ``left_truncate``).
    """
    if width is not None:
        if width <= 0:
            raise ValueError("width must be positive")
        fits = F.when(F.size(token_col) <= width, F.lit(width)).otherwise(
            F.raise_error(F.lit(f"a sequence is longer than the width {width}")).cast("int"))
        return (batched.withColumn("width", fits.cast("bigint"))
                .withColumn("input_tokens", left_pad(token_col, "width", pad))
                .withColumn("attention_mask", attention_mask(token_col, "width")))
    w = F.max(F.size(token_col)).over(Window.partitionBy("batch_id"))
    return (batched.withColumn("width", w.cast("bigint"))
            .withColumn("input_tokens", left_pad(token_col, "width", pad))
            .withColumn("attention_mask", attention_mask(token_col, "width")))
