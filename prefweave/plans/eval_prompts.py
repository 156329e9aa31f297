"""Evaluation prompts: template -> tokens -> batches -> left padding.

The generation loop itself is GPU work and not built; this produces the padded
batches it consumes, in parallel rather than batch after batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from prefweave.functions import templates as tpl
from prefweave.functions.tokens import left_truncate, tokens
from prefweave.operators.batching import assign_batches, pad_batches, template_prompts


def padded_prompt_batches(prompts: DataFrame, batch_size: int,
                          template: tpl.ChatTemplate = tpl.ALTERNATING,
                          pad: str = tpl.EOS, width: int | None = None) -> DataFrame:
    """Batch width = longest prompt in the batch, or a constant ``width``
    to which longer prompts are cut from the left first (K1)."""
    t = template_prompts(prompts, template).withColumn("tokens", tokens("templated"))
    if width is not None:
        t = t.withColumn("tokens", left_truncate("tokens", width))
    return pad_batches(assign_batches(t, batch_size), "tokens", pad, width)
