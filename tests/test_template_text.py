"""Templates given as text against the built-in ones and a plain loop."""

import random

import pytest

from prefweave.functions import templates as tpl
from prefweave.functions.template_text import compile_template, parse
from prefweave.plans.catalog import FINAL_TEXT, RAISED, TURNS_TEXT
from prefweave.schemas import MESSAGE

CHATML_TEXT = ("{% for message in messages %}{{'<|im_start|>' + message['role'] + '\\n' + message['content'] + '\\n<|im_end|>' "
               "+ '\\n'}}{% endfor %}{% if add_generation_prompt %}{{ 'system' }}{% endif %}")


@pytest.fixture(scope="module")
def talks(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(300):
        n = rnd.randint(0, 5)
        roles = ["user" if k % 2 == 0 else "assistant" for k in range(n)]
        if n and rnd.random() < 0.5:
            roles[rnd.randrange(n)] = rnd.choice(["user", "assistant", "system", "tool", "", None])
        rows.append((i, [(r, rnd.choice([None, "", "a {b} %}", "é\n"]) if rnd.random() < 0.3 else f"t{k}")
                         for k, r in enumerate(roles)]))
    return spark.createDataFrame(rows, f"id long, m array<{MESSAGE.simpleString()}>").cache()


@pytest.mark.parametrize("built_in, text, constants", [
    (tpl.ALTERNATING, TURNS_TEXT, {"between": " "}), (tpl.FINAL_TURN, FINAL_TEXT, {}),
    (tpl.UPSTREAM_ALTERNATING, "{{ bos_token }}" + TURNS_TEXT, {"between": ""}), (tpl.CHATML, CHATML_TEXT, {})])
def test_text_equals_the_built_in_template(talks, built_in, text, constants):
    t = compile_template(text, statuses=RAISED, **constants)
    got = talks.select("id", t.violation("m").alias("v"), built_in.violation("m").alias("w"), t.render("m").alias("a"),
                       built_in.render("m").alias("b")).collect()
    assert [r for r in got if r.v != r.w] == []
    assert [r for r in got if r.w is None and r.a != r.b] == [] and any(r.w is None for r in got)
    one = talks.where("size(m) > 0").selectExpr("m[0] x").select(
        t.message_violation("x").alias("v"), built_in.message_violation("x").alias("w"), t.render_message("x").alias("a"),
        built_in.render_message("x").alias("b")).collect()
    assert all(r.v == r.w and (r.w or r.a == r.b) for r in one)
    assert t.alternating == built_in.alternating and t.supports_system == built_in.supports_system


def test_white_space_rules_and_messages_as_status(spark):
    rows = spark.createDataFrame([([("user", "u"), ("tool", "x")],), ([("user", "u")],)], f"m array<{MESSAGE.simpleString()}>")
    t = compile_template("<\n{% for x in messages %}\n  {% if not x.role == 'tool' %}\n [{{ x['content'] }}]\n  {% else %}"
                         "{{ raise_exception('no tools') }}{% endif %}\n{%- endfor %}\n>\n")
    got = rows.select(t.violation("m").alias("v"), t.render("m").alias("a")).collect()
    assert got[0].v == "no tools" and (got[1].v, got[1].a) == (None, "<\n [u]\n>")


@pytest.mark.parametrize("text", [
    "{% for message in messages %}{{ message.name }}{% endfor %}", "{% for x in tools %}{% endfor %}", "no loop",
    "{% set a = 1 %}{% for x in messages %}{% endfor %}", "{% for x in messages %}{{ x.content | trim }}{% endfor %}",
    "{% for x in messages %}{% if x.role %}{% endif %}{% endfor %}", "{% for x in messages %}", "{% for x in messages %}{% endif %}",
    "{% for x in messages %}{{ loop.index0 }}{% endfor %}", "{% for x in messages %}{{ unknown }}{% endfor %}",
    "{% for x in messages %}{{ x.content + 1 }}{% endfor %}", "{% for x in messages %}{% endfor %}{{ x.content",
    "{% for x in messages %}{% if a == 'b' == 'c' %}{% endif %}{% endfor %}", "{% for x in messages %}{{ x.content( }}{% endfor %}"])
def test_unknown_constructs_are_refused_while_planning(spark, text):
    with pytest.raises(ValueError):
        compile_template(text)


def test_branches_nest():
    node = parse("{% if 1 == 1 %}a{% if 1 == 2 %}b{% endif %}{% elif 2 == 2 %}c{% else %}d{% endif %}")[0]
    assert [len(body) for _, body in node.branches] == [2, 1, 1]
