"""The flat form of conversations against the array form and plain loops."""

import contextlib
import io
import random

import pytest
from pyspark.sql import functions as F, types as T

from prefweave.functions import templates as tpl
from prefweave.operators.conversations import final_assistant, turns_to_messages
from prefweave.operators.flat_turns import (
    final_assistant_turns, flatten_pairs, number_turns, pair_status, place_turns, prompt_and_response_turns)
from prefweave.operators.triplets import with_status
from prefweave.schemas import PAIR

TURNS = "conv_id bigint, turn bigint, role string, text string"
ROLES = ["user", "assistant", "system", "tool", None]
TEXTS = ["a", "b", "", None]


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("extended")
    return out.getvalue()


def test_flat_form_equals_array_form_on_generated_turns(spark):
    rng = random.Random(5)
    rows = []
    for conv in [None, *range(60)]:
        for _ in range(rng.randrange(1, 9)):          # gaps, repeated and null turn numbers
            rows.append((conv, rng.choice([None, *range(0, 12, 2)]), rng.choice(ROLES), rng.choice(TEXTS)))
    turns = spark.createDataFrame(rows, TURNS).repartition(5)
    numbered = number_turns(turns, ["conv_id"])
    flat = sorted((tuple(r) for r in final_assistant_turns(numbered, ["conv_id"])
                   .select("conv_id", "final_idx", "final_content").collect()), key=str)
    arrays = turns_to_messages(turns)
    assert flat == sorted((tuple(r) for r in final_assistant(arrays).select(
        "conv_id", "final_idx", "final_content").collect()), key=str)
    placed = {}
    for r in prompt_and_response_turns(numbered, ["conv_id"]).collect():
        placed.setdefault(r.conv_id, []).append((r.idx, r.part, r.role, r.text))
    for r in final_assistant(arrays).collect():
        want = [] if r.final_idx is None else [
            (i, "response" if i == r.final_idx else "prompt", x.role, x.content)
            for i, x in enumerate(r.messages[:r.final_idx + 1])]
        assert sorted(placed.get(r.conv_id, []), key=lambda t: t[0]) == want


@pytest.fixture
def small_partitions(spark):
    """Partitions of some MB, so that the test's table spans many tasks."""
    names = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes")
    before = {n: spark.conf.get(n) for n in names}
    for n in names:
        spark.conf.set(n, "8m")
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def test_a_conversation_of_five_million_turns(spark, small_partitions):
    n, last = 5_000_000, 4_999_990
    i = F.col("id")
    long = spark.range(n).select(F.lit(1).cast("bigint").alias("conv_id"), i.alias("turn"), F.when(
        (i % 2 == 1) & (i <= last), "assistant").otherwise("user").alias("role"), F.concat(F.lit("t"), i).alias("text"))
    short = spark.range(900).select((i + 10).alias("conv_id"), F.lit(0).cast("bigint").alias("turn"),
                                    F.lit("assistant").alias("role"), F.lit("s").alias("text"))
    numbered = number_turns(long.unionByName(short), ["conv_id"])
    assert numbered.groupBy(F.spark_partition_id()).count().count() > 1
    answers = final_assistant_turns(numbered, ["conv_id"])
    got = answers.where("conv_id = 1").first()
    assert (got.n_turns, got.final_idx, got.final_content) == (n, last - 1, f"t{last - 1}")
    parts = prompt_and_response_turns(numbered, ["conv_id"])
    counts = {tuple(r)[:2]: r["count"] for r in parts.groupBy(
        F.col("conv_id").isin(1).alias("long"), "part").count().collect()}
    assert counts == {(True, "prompt"): last - 1, (True, "response"): 1, (False, "response"): 900}
    for df in (answers, parts):
        assert "collect_list" not in plan(df) and "collect_set" not in plan(df)
    # The long conversation's rows stay where they were read: they are joined by
    # broadcast of the few conversations that hold more than a thousandth of all.
    placed = place_turns(numbered, ["conv_id"])
    widths = [r["count"] for r in placed.groupBy(F.spark_partition_id()).count().collect()]
    assert max(widths) < n


def drawn_pairs(rng, n):
    def message():
        return {"role": rng.choice(["user", "assistant", "user", "assistant", *ROLES]), "content": rng.choice([*TEXTS, "c", "d"])}

    def proper(k):
        return [{"role": ("user", "assistant")[i % 2], "content": rng.choice("xyz")} for i in range(k)]

    rows = []
    for i in range(n):
        kind = rng.randrange(8)
        chosen = proper(2 * rng.randrange(1, 4)) if kind < 5 else [message() for _ in range(rng.randrange(0, 6))]
        rejected = [dict(x) for x in chosen]
        if rejected and rng.random() < 0.3:
            rejected[-1]["content"] = rng.choice(["other", None])
        if len(rejected) > 2 and rng.random() < 0.2:            # two turns change places
            rejected[0], rejected[1] = rejected[1], rejected[0]
        if rejected and rng.random() < 0.1:
            rejected[0]["content"] = rng.choice([None, ""])
        if rng.random() < 0.1:
            chosen.insert(0, {"role": "system", "content": "s"})
            rejected.insert(0, {"role": "system", "content": "s"})
        if rng.random() < 0.1:                                  # the last answer turns null
            for side in (chosen, rejected)[:rng.randrange(3)]:
                side and side[-1].update(content=None)
        rows.append((i, None if rng.random() < 0.04 else chosen, None if rng.random() < 0.04 else rejected))
    return rows + [(n, [], [{"role": "assistant", "content": "a"}]), (n + 1, [], []), (n + 2, None, [])]


SYSTEM_ALTERNATING = tpl.ChatTemplate(name="s", wrappers=(("user", "", ""), ("assistant", "", ""), ("system", "", "")),
                                      alternating=True, supports_system=True)


@pytest.mark.parametrize("template, final", [(tpl.ALTERNATING, tpl.FINAL_TURN), (tpl.CHATML, None),
                                             (SYSTEM_ALTERNATING, tpl.FINAL_TURN)])
def test_status_of_flat_pairs_equals_the_array_form(spark, template, final):
    pairs = spark.createDataFrame(drawn_pairs(random.Random(9), 400), PAIR).repartition(4)
    want = dict(with_status(pairs, template, final).select("pair_id", "status").collect())
    flat = pair_status(flatten_pairs(pairs).repartition(7), template, final)
    got = [tuple(r) for r in flat.collect()]
    assert len(got) == len(want) and dict(got) == want
    assert "collect_list" not in plan(flat)
    if template is tpl.ALTERNATING:
        assert set(want.values()) == {"ok", "null_conversation", "no_assistant", "prefix_mismatch", "empty_prompt",
                                      "system_not_supported", "roles_not_alternating", "unsupported_role", "null_content"}


def test_empty_turns(spark):
    numbered = number_turns(spark.createDataFrame([], TURNS), ["conv_id"])
    assert final_assistant_turns(numbered, ["conv_id"]).count() == 0
    assert prompt_and_response_turns(numbered, ["conv_id"]).count() == 0
    empty = T.StructType.fromDDL("pair_id bigint, side string, turn bigint, role string, text string")
    assert pair_status(spark.createDataFrame([], empty)).count() == 0
