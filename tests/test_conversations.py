import random

import pytest
from pyspark.sql import types as T

from prefweave.functions.conversation import final_assistant_index
from prefweave.operators.conversations import final_assistant, prompt_and_response, turns_to_messages
from prefweave.schemas import CONVERSATION


def _convs(spark, rows):
    schema = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("messages", CONVERSATION)])
    return spark.createDataFrame(rows, schema)


def m(role, content="x"):
    return {"role": role, "content": content}


def last_place(roles, wanted="assistant"):
    """A plain loop from the front."""
    found = None
    for place, role in enumerate(roles):
        if role == wanted:
            found = place
    return found


@pytest.mark.parametrize("seed", [11, 12, 13])
def test_last_assistant_place_of_generated_conversations(spark, seed):
    """Role sequences drawn at random: null and unknown roles, none at all, no
    assistant turn, a single assistant turn at either end, some thousand turns."""
    rng = random.Random(seed)
    kinds = ["assistant", "user", "system", "tool", "Assistant", "", None]
    drawn = [[rng.choice(kinds) for _ in range(rng.randrange(0, 9))] for _ in range(300)]
    drawn += [[rng.choice(kinds[1:]) for _ in range(n)] for n in (1, 2, 7, 2500)]
    drawn += [["assistant"] + ["user"] * 3000, [None] * 40 + ["assistant"]]
    df = _convs(spark, [(i, [m(r, f"{i}/{k}") for k, r in enumerate(roles)]) for i, roles in enumerate(drawn)] + [(-1, None)])
    got = {r.conv_id: r for r in final_assistant(df).select("conv_id", "final_idx", "final_content").collect()}
    assert got[-1].final_idx is None and len(got) == len(drawn) + 1
    for i, roles in enumerate(drawn):
        place = last_place(roles)
        assert (got[i].final_idx, got[i].final_content) == (place, None if place is None else f"{i}/{place}"), roles[:12]


def test_final_assistant_and_split(spark):
    df = _convs(spark, [(1, [m("user", "a"), m("assistant", "b"), m("user", "c")]),
                        (2, [m("user", "a")])])
    assert df.select(final_assistant_index("messages").alias("i")).schema["i"].dataType == T.IntegerType()
    pr = {r.conv_id: r for r in prompt_and_response(df).collect()}
    assert [x.role for x in pr[1].prompt_messages] == ["user"]
    assert pr[1].response.content == "b"
    assert pr[2].prompt_messages is None and pr[2].response is None


def test_turns_to_messages_orders_by_turn(spark):
    turns = spark.createDataFrame(
        [(7, 2, "user", "c"), (7, 0, "user", "a"), (7, 1, "assistant", "b"), (8, 0, "user", "z")],
        "conv_id bigint, turn bigint, role string, text string")
    got = {r.conv_id: [(x.role, x.content) for x in r.messages]
           for r in turns_to_messages(turns.repartition(3)).collect()}
    assert got == {7: [("user", "a"), ("assistant", "b"), ("user", "c")], 8: [("user", "z")]}


def test_chunked_fold_equals_single_level(spark):
    from tests.conftest import SF01
    from prefweave.sources.tables import read_table
    turns = read_table(spark, SF01, "conversations")
    one = {r.conv_id: r.messages for r in turns_to_messages(turns).collect()}
    for chunk in (1, 2, 3):
        two = {r.conv_id: r.messages for r in turns_to_messages(turns, chunk_turns=chunk).collect()}
        assert two == one
