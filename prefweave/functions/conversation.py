"""Expressions over a conversation column, ``array<struct<role, content>>``.

Indices returned here are 0-based like the reference's; ``slice``/``element_at``
are 1-based, ``get`` is 0-based and returns NULL out of range.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

ASSISTANT = "assistant"
SYSTEM = "system"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def final_assistant_index(messages) -> Column:
    """0-based index of the last assistant message; NULL if there is none (A2).

    Position of the first 'assistant' in the reversed role array: built-in
    array functions only, no per-element lambda.
    """
    m = _col(messages)
    pos = F.array_position(F.reverse(m.getField("role")), ASSISTANT)
    return F.when(pos > 0, (F.size(m) - pos).cast("int"))


def final_assistant_message(messages) -> Column:
    """The last assistant message itself; NULL if there is none (A1)."""
    return message_at(messages, final_assistant_index(messages))


def messages_before(messages, idx0) -> Column:
    """Messages strictly before a 0-based index; later turns are dropped (A3)."""
    return F.slice(_col(messages), 1, _col(idx0))


def message_at(messages, idx0) -> Column:
    """The message at a 0-based index (A4)."""
    return F.get(_col(messages), _col(idx0))


def first_is_system(messages) -> Column:
    """NULL-safe: false for empty arrays and NULL roles (P5)."""
    return F.coalesce(F.get(_col(messages), 0).role == SYSTEM, F.lit(False))


def same_prefix(chosen, chosen_idx0, rejected, rejected_idx0) -> Column:
    """Deep equality of the two prompts, NULL contents compare equal."""
    return messages_before(chosen, chosen_idx0).eqNullSafe(
        messages_before(rejected, rejected_idx0))


def with_system_message(messages, content: str) -> Column:
    """Prepend a system message unless the first message already is one (A5 b/c)."""
    m = _col(messages)
    sys_msg = F.struct(F.lit(SYSTEM).alias("role"), F.lit(content).alias("content"))
    return F.when(first_is_system(m), m).otherwise(F.concat(F.array(sys_msg), m))
