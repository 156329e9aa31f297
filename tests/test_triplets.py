import pytest
from pyspark.sql import types as T

from prefweave.functions import templates as tpl
from prefweave.operators.triplets import create_triplets, with_status
from prefweave.schemas import PAIR


def m(role, content="x"):
    return {"role": role, "content": content}


U, A = "user", "assistant"

# (pair_id, chosen, rejected, expected alternating status, expected ChatML status)
CASES = [
    (1, None, [m(U), m(A)], "null_conversation", "null_conversation"),
    (2, [m(A, "a")], [m(A, "b")], "empty_prompt", "empty_prompt"),
    (3, [m(U, "q"), m(A, "a"), m(U, "q2"), m(A, "c")], [m(U, "q"), m(A, "DIFF"), m(U, "q2"), m(A, "r")],
     "prefix_mismatch", "prefix_mismatch"),
    (4, [m("system", "s"), m(U), m(A, "c")], [m("system", "s"), m(U), m(A, "r")],
     "system_not_supported", "ok"),
    (5, [m(U), m(U), m(A, "c")], [m(U), m(U), m(A, "r")], "roles_not_alternating", "ok"),
    (6, [m(U), m("tool"), m(A, "c")], [m(U), m("tool"), m(A, "r")], "unsupported_role", "ok"),
    (7, [m(U), {"role": None, "content": "x"}, m(A, "c")], [m(U), {"role": None, "content": "x"}, m(A, "r")],
     "unsupported_role", "unsupported_role"),
    (8, [{"role": None, "content": "x"}, m(A, "c")], [{"role": None, "content": "x"}, m(A, "r")],
     "roles_not_alternating", "unsupported_role"),
    (9, [{"role": U, "content": None}, m(U), m(A, "c")], [{"role": U, "content": None}, m(U), m(A, "r")],
     "null_content", "null_content"),
    (10, [{"role": U, "content": None}, m(A, "c")], [{"role": U, "content": None}, m(A, "r")],
     "null_content", "null_content"),
    (11, [m(U), {"role": A, "content": None}], [m(U), m(A, "r")], "null_content", "null_content"),
    (12, [m(U, "q"), m(A, "a1"), m(A, "c")], [m(U, "q"), m(A, "a1"), m(A, "r")], "ok", "ok"),
    (13, [m(U, "q"), m(A, "same")], [m(U, "q"), m(A, "same")], "ok", "ok"),
    (14, [m(U), m(A)], [m(U)], "no_assistant", "no_assistant"),
    (15, [], [], "no_assistant", "no_assistant"),
    (16, [m(U, "q"), m(A, "c"), m(U, "later")], [m(U, "q"), m(A, "r")], "ok", "ok"),
]


@pytest.fixture(scope="module")
def pairs(spark):
    return spark.createDataFrame([c[:3] for c in CASES], PAIR)


def test_status_alternating(pairs):
    got = dict(with_status(pairs).select("pair_id", "status").collect())
    assert got == {c[0]: c[3] for c in CASES}


def test_status_chatml(pairs):
    got = dict(with_status(pairs, tpl.CHATML, None).select("pair_id", "status").collect())
    assert got == {c[0]: c[4] for c in CASES}


def test_template_literals(spark):
    df = spark.createDataFrame(
        [(1, [m(U, "a"), m(A, "b"), m(U, "c"), m(A, "d")], [m(U, "a"), m(A, "b"), m(U, "c"), m(A, "e")])], PAIR)
    good, bad = create_triplets(df)
    r = good.first()
    assert r.prompt == "[INST] a [/INST] b</s>[INST] c [/INST]"
    assert (r.chosen, r.rejected) == ("d</s>", "e</s>")
    assert bad.count() == 0


def test_chatml_inserts_default_system_message(spark):
    df = spark.createDataFrame([(1, [m(U, "hi"), m(A, "yo")], [m(U, "hi"), m(A, "no")])], PAIR)
    good, _ = create_triplets(df, tpl.CHATML, None)
    r = good.first()
    assert r.prompt == ("<|im_start|>system\nYou are a helpful assistant.\n<|im_end|>\n"
                        "<|im_start|>user\nhi\n<|im_end|>\n")
    assert r.chosen == "<|im_start|>assistant\nyo\n<|im_end|>\n"


def test_prompt_keeps_trailing_assistant_turn(pairs):
    good, _ = create_triplets(pairs)
    r = {x.pair_id: x for x in good.collect()}[12]
    assert r.prompt == "[INST] q [/INST] a1</s>"
    assert r.chosen == "c</s>"


def test_upstream_template_has_bos_and_no_space(spark):
    df = spark.createDataFrame([(1, [m(U, "a"), m(A, "b")], [m(U, "a"), m(A, "b")])], PAIR)
    r = df.select(tpl.UPSTREAM_ALTERNATING.render("chosen").alias("t")).first()
    assert r.t == "<s>[INST] a [/INST]b</s>"


def test_strict_mode_fails_on_first_bad_row(pairs):
    from pyspark.errors import PySparkException
    from py4j.protocol import Py4JJavaError
    strict = create_triplets(pairs, mode="strict")
    with pytest.raises((PySparkException, Py4JJavaError)):
        strict.collect()
    with pytest.raises((PySparkException, Py4JJavaError)):
        strict.select("pair_id").collect()          # pruning must not skip the check
    good_only = pairs.where("pair_id IN (12, 13, 16)")
    assert create_triplets(good_only, mode="strict").count() == 3


def test_alternating_template_cannot_be_its_own_final_turn(pairs):
    with pytest.raises(ValueError):
        with_status(pairs, tpl.ALTERNATING, None)


def test_user_defined_template(spark):
    custom = tpl.ChatTemplate(name="tags", wrappers=(("user", "<u>", "</u>"), ("assistant", "<a>", "</a>")),
                              bos="<bos>")
    df = spark.createDataFrame(
        [(1, [m(U, "q"), m(A, "x"), m(U, "q2"), m(A, "c")], [m(U, "q"), m(A, "x"), m(U, "q2"), m(A, "r")]),
         (2, [m(U, "q"), m("tool", "t"), m(A, "c")], [m(U, "q"), m("tool", "t"), m(A, "r")])], PAIR)
    got = {r.pair_id: r for r in with_status(df, custom, custom).collect()}
    assert got[1].status == "ok"
    assert got[1].prompt == "<bos><u>q</u><a>x</a><u>q2</u>"
    assert got[1].chosen == "<bos><a>c</a>"
    assert got[2].status == "unsupported_role"
