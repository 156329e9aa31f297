"""Pair -> (prompt, chosen, rejected) triplets with a data-quality status.

All of it is one narrow projection: no UDF, no shuffle. The status follows the
order in which the reference would raise:

  null_conversation, no_assistant, prefix_mismatch, empty_prompt,
  system_not_supported, first unrenderable prompt message
  (roles_not_alternating / unsupported_role / null_content),
  NULL content in a response, else ok.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from prefweave.functions import templates as tpl
from prefweave.functions.conversation import (
    final_assistant_index, first_is_system, message_at, messages_before, same_prefix,
    with_system_message)

OK = "ok"
NULL_CONVERSATION = "null_conversation"
NO_ASSISTANT = "no_assistant"
PREFIX_MISMATCH = "prefix_mismatch"
EMPTY_PROMPT = "empty_prompt"
SYSTEM_NOT_SUPPORTED = "system_not_supported"


def _render_one(template: tpl.ChatTemplate, msg: Column) -> Column:
    return template.render_message(msg)


def _status_frame(pairs: DataFrame, template: tpl.ChatTemplate,
                  final_turn: tpl.ChatTemplate | None, system_message: str) -> tuple[DataFrame, tpl.ChatTemplate]:
    final_turn = tpl.resolve_final_turn(template, final_turn)
    keep = [c for c in pairs.columns if c not in ("chosen", "rejected")]

    # Stage 1: the last-assistant indices, computed once and reused below.
    s1 = pairs.select(*keep, "chosen", "rejected",
                      final_assistant_index("chosen").alias("_ci"),
                      final_assistant_index("rejected").alias("_ri"))
    # Stage 2: split into prompt and responses.
    prompt_raw = messages_before("chosen", "_ci")
    s2 = s1.select(
        *keep,
        (F.col("chosen").isNull() | F.col("rejected").isNull()).alias("_null_conv"),
        (F.col("_ci").isNull() | F.col("_ri").isNull()).alias("_no_asst"),
        same_prefix("chosen", "_ci", "rejected", "_ri").alias("_same"),
        (F.col("_ci") == 0).alias("_empty"),
        first_is_system(prompt_raw).alias("_sys_first"),
        (with_system_message(prompt_raw, system_message) if template.supports_system
         else prompt_raw).alias("_prompt"),
        message_at("chosen", "_ci").alias("_resp_c"),
        message_at("rejected", "_ri").alias("_resp_r"))
    status = (
        F.when(F.col("_null_conv"), F.lit(NULL_CONVERSATION))
        .when(F.col("_no_asst"), F.lit(NO_ASSISTANT))
        .when(~F.col("_same"), F.lit(PREFIX_MISMATCH))
        .when(F.col("_empty"), F.lit(EMPTY_PROMPT))
        .when(F.col("_sys_first") & F.lit(not template.supports_system), F.lit(SYSTEM_NOT_SUPPORTED))
        .otherwise(F.coalesce(
            template.violation("_prompt"),
            final_turn.message_violation("_resp_c"),
            final_turn.message_violation("_resp_r"),
            F.lit(OK))))
    return s2.select(*keep, status.alias("status"), "_prompt", "_resp_c", "_resp_r"), final_turn


def _rendered(template: tpl.ChatTemplate, final_turn: tpl.ChatTemplate) -> dict[str, Column]:
    return {"prompt": template.render("_prompt"),
            "chosen": _render_one(final_turn, F.col("_resp_c")),
            "rejected": _render_one(final_turn, F.col("_resp_r"))}


def with_status(pairs: DataFrame, template: tpl.ChatTemplate = tpl.ALTERNATING,
                final_turn: tpl.ChatTemplate | None = tpl.FINAL_TURN,
                system_message: str = tpl.DEFAULT_SYSTEM_MESSAGE) -> DataFrame:
    """Add ``status`` and the three rendered strings (NULL unless status is ok)."""
    s3, final_turn = _status_frame(pairs, template, final_turn, system_message)
    keep = [c for c in s3.columns if c not in ("status", "_prompt", "_resp_c", "_resp_r")]
    ok = F.col("status") == OK
    return s3.select(*keep, "status",
                     *[F.when(ok, c).alias(n) for n, c in _rendered(template, final_turn).items()])


def create_triplets(pairs: DataFrame, template: tpl.ChatTemplate = tpl.ALTERNATING,
                    final_turn: tpl.ChatTemplate | None = tpl.FINAL_TURN,
                    system_message: str = tpl.DEFAULT_SYSTEM_MESSAGE,
                    mode: str = "quarantine", key: str = "pair_id"):
    """Map pairs to triplets, replacing the schema.

    ``mode="quarantine"`` returns ``(good, bad)``: good has ``key, prompt,
    chosen, rejected``; bad has ``key, status``. ``mode="strict"`` returns one
    DataFrame whose first malformed row fails the job, like the reference.
    """
    if mode not in ("strict", "quarantine"):
        raise ValueError(f"unknown mode {mode!r}")
    s3, final_turn = _status_frame(pairs, template, final_turn, system_message)
    if mode == "quarantine":
        # Catalyst evaluates the status filter below the projection; rendering
        # happens only above it and only for good rows.
        good = s3.where(F.col("status") == OK).select(
            key, *[c.alias(n) for n, c in _rendered(template, final_turn).items()])
        bad = s3.where(F.col("status") != OK).select(key, "status")
        return good, bad
    # Strict: the check is a filter predicate, which column pruning never
    # removes, so the first malformed pair fails any action on the result.
    fail = F.raise_error(F.concat(F.lit("malformed pair "), F.col(key).cast("string"),
                                  F.lit(": "), F.col("status")))
    checked = s3.where(F.coalesce(F.when(F.col("status") != OK, fail), F.lit(True)))
    return checked.select(key, *[c.alias(n) for n, c in _rendered(template, final_turn).items()])
