"""Conversation-level operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from prefweave.functions.conversation import (
    final_assistant_index, final_assistant_message, message_at, messages_before)


def turns_to_messages(turns: DataFrame, key: str = "conv_id", order: str = "turn",
                      role: str = "role", text: str = "text",
                      chunk_turns: int | None = None) -> DataFrame:
    """Fold flat turns into one ordered message array per conversation.

    One hash exchange on ``key``; collect_list is partially aggregated map-side.
    A row of the output is one conversation, the unit of the pair data model.

    ``chunk_turns`` folds in two levels for inputs with very long
    conversations: first by ``(key, order div chunk_turns)``, so one huge
    conversation's turns are collected and sorted by many tasks, then by
    ``key``, which only concatenates pre-sorted chunks. It costs a second
    shuffle, so the default is one level.
    """
    msg = F.struct(F.col(order).alias("o"), F.col(role).alias("role"), F.col(text).alias("content"))
    if chunk_turns is None:
        folded = turns.groupBy(key).agg(F.sort_array(F.collect_list(msg)).alias("t"))
    else:
        if chunk_turns <= 0:
            raise ValueError("chunk_turns must be positive")
        chunks = turns.groupBy(key, F.floor(F.col(order) / chunk_turns).alias("_c")).agg(
            F.sort_array(F.collect_list(msg)).alias("part"))
        folded = (chunks.groupBy(key)
                  .agg(F.sort_array(F.collect_list(F.struct("_c", "part"))).alias("parts"))
                  .select(key, F.flatten(F.col("parts").getField("part")).alias("t")))
    # Drop the ordering field without a per-element lambda: zipping the two
    # extracted field arrays yields struct<role, content> directly.
    return folded.select(key, F.arrays_zip(F.col("t.role"), F.col("t.content")).alias("messages"))


def final_assistant(convs: DataFrame, messages: str = "messages") -> DataFrame:
    """Index (0-based, NULL when none) and content of the last assistant turn (A1, A2)."""
    return convs.withColumns({
        "final_idx": final_assistant_index(messages).cast("bigint"),
        "final_content": final_assistant_message(messages).content,
    })


def prompt_and_response(convs: DataFrame, messages: str = "messages") -> DataFrame:
    """Split each conversation at its last assistant turn (A3, A4).

    Turns after that assistant message are dropped, as in the reference.
    Conversations without an assistant turn get NULL prompt and response.
    """
    idx = final_assistant_index(messages)
    return (convs.withColumn("_fi", idx)
            .withColumns({"prompt_messages": messages_before(messages, "_fi"),
                          "response": message_at(messages, "_fi")})
            .drop("_fi"))
