"""Random pairs built to have a known status.

Every case starts from a well-formed dialogue made of parts whose rendering is
written down as they are made; a fault, where one is wanted, is then put in at
one place. The expected status and texts come from how the pair was built.
"""

import random

import pytest

from prefweave.functions import templates as tpl
from prefweave.operators.triplets import with_status
from prefweave.schemas import PAIR

SYSTEM = "You are a helpful assistant."


def said(role, text):
    return {"role": role, "content": text}


class Dialogue:
    """Question and answer rounds, a last question, and the two responses."""

    def __init__(self, rnd, chatml):
        self.rounds = [(f"q{rnd.random():.3f}", f"r{rnd.random():.3f}") for _ in range(rnd.randint(0, 3))]
        self.question = f"last{rnd.random():.3f}"
        self.good, self.bad = f"good{rnd.random():.3f}", rnd.choice([f"bad{rnd.random():.3f}", "same"])
        self.tail = rnd.choice([[], [said("user", "thanks")]])       # turns after the final answer are not used
        self.chatml = chatml
        self.prompt = [said(role, text) for pair in self.rounds for role, text in zip(("user", "assistant"), pair)]
        self.prompt.append(said("user", self.question))

    def sides(self):
        return (self.prompt + [said("assistant", self.good)] + self.tail,
                [dict(x) for x in self.prompt] + [said("assistant", self.bad)])

    def texts(self):
        if self.chatml:
            turns = [("system", SYSTEM)] + [t for q, r in self.rounds for t in (("user", q), ("assistant", r))]
            turn = "<|im_start|>{}\n{}\n<|im_end|>\n".format
            return ("".join(turn(*t) for t in turns + [("user", self.question)]),
                    turn("assistant", self.good), turn("assistant", self.bad))
        rounds = "".join(f"[INST] {q} [/INST] {r}</s>" for q, r in self.rounds)
        return f"{rounds}[INST] {self.question} [/INST]", f"{self.good}</s>", f"{self.bad}</s>"


def faulty(d, fault, rnd):
    """The dialogue's sides with one fault."""
    chosen, rejected = d.sides()
    spot = rnd.randrange(len(d.prompt))
    if fault == "null_conversation":
        return rnd.choice([(None, rejected), (chosen, None), (None, None)])
    if fault == "no_assistant":
        users = [said("user", "u")] * rnd.randint(0, 2)
        return rnd.choice([(users, rejected), (chosen, users)])
    if fault == "prefix_mismatch":
        rejected[spot] = said(rejected[spot]["role"], "edited")
        return chosen, rejected
    if fault == "empty_prompt":
        return [said("assistant", d.good)], [said("assistant", d.bad)]
    if fault == "system_not_supported":
        head = [said("system", "be brief")]
        return head + chosen, head + rejected
    if fault == "roles_not_alternating":
        twice = d.prompt[:spot + 1] + d.prompt[spot:]
        return twice + [said("assistant", d.good)], twice + [said("assistant", d.bad)]
    if fault == "unsupported_role":
        # In an answer's place, so that the alternation still holds.
        odd = d.prompt + [said(None if d.chatml else "tool", "x"), said("user", "again")]
        return odd + [said("assistant", d.good)], odd + [said("assistant", d.bad)]
    if rnd.random() < 0.5:                                               # null_content, in the prompt
        blank = [dict(x) for x in d.prompt]
        blank[spot]["content"] = None
        return blank + [said("assistant", d.good)], blank + [said("assistant", d.bad)]
    responses = rnd.choice([(None, d.bad), (d.good, None), (None, None)])  # or in a response
    return tuple(d.prompt + [said("assistant", r)] for r in responses)


FAULTS = ["null_conversation", "no_assistant", "prefix_mismatch", "empty_prompt", "unsupported_role", "null_content"]


@pytest.mark.parametrize("chatml", [False, True])
def test_built_pairs_get_the_status_they_were_built_for(spark, chatml):
    rnd = random.Random(1234 + chatml)
    faults = FAULTS + ([] if chatml else ["system_not_supported", "roles_not_alternating"])
    rows, want = [], {}
    for pid in range(500):
        d = Dialogue(rnd, chatml)
        fault = rnd.choice([None] * 4 + faults)
        sides = faulty(d, fault, rnd) if fault else d.sides()
        rows.append((pid, *sides))
        want[pid] = (fault, None, None, None) if fault else ("ok", *d.texts())
    template = (tpl.CHATML, None) if chatml else (tpl.ALTERNATING, tpl.FINAL_TURN)
    got = {r.pair_id: (r.status, r.prompt, r.chosen, r.rejected)
           for r in with_status(spark.createDataFrame(rows, PAIR), *template).collect()}
    bad = [(rows[pid], got[pid], want[pid]) for pid in want if got[pid] != want[pid]]
    assert not bad, bad[:3]
    assert {v[0] for v in want.values()} == {"ok", *faults}
