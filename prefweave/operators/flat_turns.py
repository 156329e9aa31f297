"""Conversations as flat turns, without an array per conversation.

The array form holds a conversation in one row, and so in one task. Here a
conversation stays rows ``(key, turn, role, text)``. Rows are dealt by ranges of
(key, turn), so that a long conversation spans many tasks, and numbered once
over all of them (``with_positions``); a conversation is then an interval of
numbers. What the array form reads from an array are aggregates that merge: the
first number, the count and the last number of an assistant turn. They meet the
rows by ``join_by_key``, which moves no rows of a hot conversation.

Turns with equal keys and turn numbers follow each other by role and text, nulls
first, as in the array form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from prefweave.functions import templates as tpl
from prefweave.functions.conversation import ASSISTANT, SYSTEM
from prefweave.operators import triplets as tri
from prefweave.operators.batching import with_positions
from prefweave.operators.keyed import join_by_key
from prefweave.sources.tables import stored

AT = "_at"
SIDES = ("chosen", "rejected")
PAIR_KEYS = ["pair_id", "side"]


def number_turns(turns: DataFrame, keys: list[str], order: str = "turn") -> DataFrame:
    """The turns with their number over all conversations, written once."""
    return with_positions(turns, [*keys, order], pos=AT, then_by=["role", "text"])


def conversation_bounds(numbered: DataFrame, keys: list[str]) -> DataFrame:
    """One narrow row per conversation: first number, turns, number of the last
    assistant turn (null without one)."""
    return numbered.groupBy(*keys).agg(
        F.min(AT).alias("_first"), F.count(F.lit(1)).alias("n_turns"),
        F.max(F.when(F.col("role") == ASSISTANT, F.col(AT))).alias("_last"))


def place_turns(numbered: DataFrame, keys: list[str]) -> DataFrame:
    """Every turn with ``idx``, its 0-based place in the conversation, and
    ``final_idx``, that of the last assistant turn (A2)."""
    placed = join_by_key(numbered, stored(conversation_bounds(numbered, keys), "bounds"), keys, "n_turns")
    return (placed.withColumn("idx", F.col(AT) - F.col("_first"))
            .withColumn("final_idx", F.col("_last") - F.col("_first")).drop("_first", "_last"))


def final_assistant_turns(numbered: DataFrame, keys: list[str]) -> DataFrame:
    """Per conversation: ``n_turns``, index and text of the last assistant turn,
    null without one (A1, A2). The text is fetched by the turn's own number."""
    bounds = conversation_bounds(numbered, keys)
    last = numbered.where(F.col("role") == ASSISTANT).select(F.col(AT).alias("_last"), F.col("text").alias("final_content"))
    return bounds.join(last, "_last", "left").select(
        *keys, "n_turns", (F.col("_last") - F.col("_first")).alias("final_idx"), "final_content")


def prompt_and_response_turns(numbered: DataFrame, keys: list[str]) -> DataFrame:
    """The turns of prompt and response with ``idx`` and ``part`` (A3, A4):
    turns after the last assistant turn, and conversations without one, are
    left out."""
    part = F.when(F.col("idx") < F.col("final_idx"), "prompt").when(F.col("idx") == F.col("final_idx"), "response")
    return place_turns(numbered, keys).withColumn("part", part).where("part is not null").drop(AT, "final_idx")


def flatten_pairs(pairs: DataFrame) -> DataFrame:
    """Pairs as flat turns ``pair_id, side, turn, role, text``. A side without
    turns is one row with a null turn; its text is null if the conversation is
    null, and empty if it is empty."""
    def side(name: str) -> DataFrame:
        return pairs.select("pair_id", F.lit(name).alias("side"), F.col(name).isNull().alias("_null"),
                            F.posexplode_outer(name).alias("turn", "m")).select(
            "pair_id", "side", F.col("turn").cast("bigint").alias("turn"), F.col("m.role").alias("role"),
            F.when(F.col("turn").isNull() & ~F.col("_null"), "").otherwise(F.col("m.content")).alias("text"))
    return side("chosen").unionByName(side("rejected"))


def message_hash(seed: int, *values) -> Column:
    """A hash of values, nulls told apart from any value."""
    return F.xxhash64(F.lit(seed), *[F.coalesce(v, v.isNull().cast(t)) for v, t in values], *[v.isNull() for v, _ in values])


def sequence_sums(where: Column) -> list[Column]:
    """Two sums over the turns ``where`` holds for, of hashes of place, role and
    text: equal sequences have equal sums in whatever order and tasks their rows
    come, and sums of parts add up, so a long sequence is spread over many tasks."""
    at = [(F.col("idx"), "bigint"), (F.col("role"), "string"), (F.col("text"), "string")]
    return [F.sum(F.when(where, message_hash(seed, *at)).cast("decimal(38,0)")) for seed in (0, 1)]


def _differing(rows: DataFrame, prompt: Column) -> DataFrame:
    """Keys of the pairs whose prompts differ at a place that both have."""
    def side(name: str) -> DataFrame:
        return rows.where((F.col("side") == name) & prompt).select(
            *[F.col(c).alias(f"{name}_{c}") for c in ("pair_id", "idx", "role", "text")])
    def same(c: str) -> Column:
        return F.col(f"chosen_{c}").eqNullSafe(F.col(f"rejected_{c}"))
    return (side("chosen").join(side("rejected"), same("pair_id") & (F.col("chosen_idx") == F.col("rejected_idx")))
            .where(~(same("role") & same("text"))).select(F.col("chosen_pair_id").alias("_differs")).distinct())


def pair_status(turns: DataFrame, template: tpl.ChatTemplate = tpl.ALTERNATING,
                final_turn: tpl.ChatTemplate | None = tpl.FINAL_TURN,
                system_message: str = tpl.DEFAULT_SYSTEM_MESSAGE) -> DataFrame:
    """``pair_id, status`` of flat pairs (``flatten_pairs``): the status that the
    array form gives, for unique pair keys. A side without any row counts as null.

    Prefixes are compared as two sums a side (P6). Pairs whose sums agree are
    then compared turn by turn, by an equi-join on pair and place, so that no
    chance collision decides. The first turn that can't be rendered is a minimum.
    """
    final_turn = tpl.resolve_final_turn(template, final_turn)
    statuses = [tpl.ROLES_NOT_ALTERNATING, tpl.UNSUPPORTED_ROLE, tpl.NULL_CONTENT]
    rows = place_turns(number_turns(turns, PAIR_KEYS), PAIR_KEYS)
    is_turn, prompt = F.col("turn").isNotNull(), F.col("idx") < F.col("final_idx")
    response = F.col("idx") == F.col("final_idx")
    message = F.struct("role", F.col("text").alias("content"))

    def code(check: Column) -> Column:
        out = F.lit(None).cast("bigint")
        for i, s in enumerate(statuses):
            out = F.when(check == s, F.lit(i).cast("bigint")).otherwise(out)
        return out

    def first_bad(shift: int) -> Column:
        check = code(template._check(message, F.col("idx") + shift))
        return F.min(F.when((F.col("side") == "chosen") & prompt, F.col("idx") * len(statuses) + check))

    def of_side(name: str) -> list[Column]:
        mine = F.col("side") == name
        return [F.max(F.when(mine, ~is_turn & F.col("text").isNull())).alias(f"{name}_null"),
                F.max(F.when(mine, F.col("final_idx"))).alias(f"{name}_idx"),
                F.min(F.when(mine & response, code(final_turn._check(message, 0)))).alias(f"{name}_bad"),
                *[s.alias(f"{name}_sum{i}") for i, s in enumerate(sequence_sums(mine & prompt))]]

    # A template that takes a system message puts the default one in front of a
    # prompt without one, and moves its places by one. Which holds is known only
    # after the aggregation, so both are aggregated.
    first = (F.col("side") == "chosen") & prompt & (F.col("idx") == 0)
    per_pair = rows.groupBy("pair_id").agg(
        *of_side("chosen"), *of_side("rejected"), first_bad(0).alias("bad_as_is"), first_bad(1).alias("bad_moved"),
        F.max(F.when(first, F.coalesce(F.col("role") == SYSTEM, F.lit(False)))).alias("system_first"))
    return _decided(per_pair, _differing(rows, prompt), template, system_message, statuses)


def _decided(per_pair: DataFrame, differs: DataFrame, template: tpl.ChatTemplate, system_message: str,
             statuses: list[str]) -> DataFrame:
    def both(c: str) -> Column:
        return F.col(f"chosen_{c}").eqNullSafe(F.col(f"rejected_{c}"))

    def named(c: str) -> Column:
        return F.get(F.array(*map(F.lit, statuses)), (F.col(c) % len(statuses)).cast("int"))

    missing = [F.coalesce(f"{s}_null", F.lit(True)) for s in SIDES]
    marked = per_pair.join(differs.withColumn("_found", F.lit(True)),
                           F.col("pair_id").eqNullSafe(F.col("_differs")), "left")
    prompt_bad = named("bad_as_is")
    if template.supports_system:
        inserted = F.struct(F.lit(SYSTEM).alias("role"), F.lit(system_message).alias("content"))
        prompt_bad = F.when(F.col("system_first"), prompt_bad).otherwise(
            F.coalesce(template._check(inserted, 0), named("bad_moved")))
    status = (F.when(missing[0] | missing[1], tri.NULL_CONVERSATION)
              .when(F.col("chosen_idx").isNull() | F.col("rejected_idx").isNull(), tri.NO_ASSISTANT)
              .when(~(both("idx") & both("sum0") & both("sum1")) | F.coalesce("_found", F.lit(False)), tri.PREFIX_MISMATCH)
              .when(F.col("chosen_idx") == 0, tri.EMPTY_PROMPT)
              .when(F.col("system_first") & F.lit(not template.supports_system), tri.SYSTEM_NOT_SUPPORTED)
              .otherwise(F.coalesce(prompt_bad, named("chosen_bad"), named("rejected_bad"), F.lit(tri.OK))))
    return marked.select("pair_id", status.alias("status"))
