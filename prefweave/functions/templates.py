"""Chat templates compiled to Column expressions (no template engine at run time).

A template is a plain value object; ``render`` turns a conversation column into
one string with ``array_join(transform(...))`` and ``violation`` returns the
status of the first message the template cannot render (T6), or NULL.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical output text.
#   Instruction wrapper for user turns:   "[INST] " + content + " [/INST]"
#   Assistant turn in the alternating template: " " + content + eos
#   Assistant turn in the final-turn template:  content + eos
#   Upstream alternating template: starts with bos, assistant turn content + eos
#   ChatML message: "<|im_start|>" + role + "\n" + content + "\n<|im_end|>\n"
#   bos "<s>", eos "</s>"
#   Default system message: "You are a helpful assistant."
# ---------------------------------------------------------------------------
BOS = "<s>"
EOS = "</s>"
INST_OPEN = "[INST] "
INST_CLOSE = " [/INST]"
CHATML_START = "<|im_start|>"
CHATML_END = "<|im_end|>"
DEFAULT_SYSTEM_MESSAGE = "You are a helpful assistant."

# Status strings reported for messages a template cannot render.
ROLES_NOT_ALTERNATING = "roles_not_alternating"
UNSUPPORTED_ROLE = "unsupported_role"
NULL_CONTENT = "null_content"


@dataclass(frozen=True)
class ChatTemplate:
    """How each message becomes text.

    ``wrappers`` maps a role to the (prefix, suffix) around its content; roles
    not in it cannot be rendered. With ``chatml=True`` any non-NULL role is
    written into the header instead.
    """

    name: str
    wrappers: tuple[tuple[str, str, str], ...] = ()
    bos: str = ""
    alternating: bool = False
    supports_system: bool = False
    chatml: bool = False

    @property
    def roles(self) -> tuple[str, ...] | None:
        return None if self.chatml else tuple(r for r, _, _ in self.wrappers)

    def _piece(self, x: Column) -> Column:
        if self.chatml:
            return F.concat(F.lit(CHATML_START), x.role, F.lit("\n"), x.content,
                            F.lit("\n" + CHATML_END + "\n"))
        expr = None
        for role, prefix, suffix in self.wrappers:
            text = F.concat(F.lit(prefix), x.content, F.lit(suffix))
            expr = F.when(x.role == role, text) if expr is None else expr.when(x.role == role, text)
        return expr

    def render(self, messages) -> Column:
        m = F.col(messages) if isinstance(messages, str) else messages
        body = F.array_join(F.transform(m, lambda x: self._piece(x)), "")
        return F.concat(F.lit(self.bos), body) if self.bos else body

    def render_message(self, message) -> Column:
        """One message (a struct column) rendered on its own, without mapping
        over an array."""
        msg = F.col(message) if isinstance(message, str) else message
        piece = self._piece(msg)
        return F.concat(F.lit(self.bos), piece) if self.bos else piece

    def _check(self, x: Column, i) -> Column:
        """Status for message ``x`` at 0-based position ``i`` (a Column or an
        int), or NULL. Within one message: alternation first, then role, then
        NULL content, the order in which the reference's template fails."""
        roles = self.roles
        conds = []
        if self.alternating:
            is_user = F.coalesce(x.role == "user", F.lit(False))
            even = (i % 2 == 0) if isinstance(i, Column) else F.lit(i % 2 == 0)
            conds.append((is_user != even, ROLES_NOT_ALTERNATING))
        if roles is None:
            conds.append((x.role.isNull(), UNSUPPORTED_ROLE))
        else:
            conds.append((~F.coalesce(x.role.isin(*roles), F.lit(False)), UNSUPPORTED_ROLE))
        conds.append((x.content.isNull(), NULL_CONTENT))
        expr = F.when(conds[0][0], F.lit(conds[0][1]))
        for cond, status in conds[1:]:
            expr = expr.when(cond, F.lit(status))
        return expr

    def violation(self, messages) -> Column:
        """Status of the first message that cannot be rendered, else NULL."""
        m = F.col(messages) if isinstance(messages, str) else messages
        return F.get(F.array_compact(F.transform(m, lambda x, i: self._check(x, i))), 0)

    def message_violation(self, message) -> Column:
        """``violation`` of a one-message conversation, without an array."""
        msg = F.col(message) if isinstance(message, str) else message
        return self._check(msg, 0)


# The alternating instruction template used for prompts (no bos, space before
# assistant text so that the closing instruction tag tokenises on its own).
ALTERNATING = ChatTemplate(
    name="alternating",
    wrappers=(("user", INST_OPEN, INST_CLOSE), ("assistant", " ", EOS)),
    alternating=True,
)

# Final-turn template: assistant only, no leading space, no alternation rule.
FINAL_TURN = ChatTemplate(name="final_turn", wrappers=(("assistant", "", EOS),))

# The upstream alternating template: bos first, assistant text without space.
UPSTREAM_ALTERNATING = ChatTemplate(
    name="upstream_alternating",
    wrappers=(("user", INST_OPEN, INST_CLOSE), ("assistant", "", EOS)),
    bos=BOS,
    alternating=True,
)

# T4: ChatML, accepts any role including system.
CHATML = ChatTemplate(name="chatml", supports_system=True, chatml=True)

TEMPLATES = {t.name: t for t in (ALTERNATING, FINAL_TURN, UPSTREAM_ALTERNATING, CHATML)}


def resolve_final_turn(template: ChatTemplate, final_turn: ChatTemplate | None) -> ChatTemplate:
    """T5: with no final-turn template the main one is used, which can never
    render a lone assistant message when it demands alternation. Reject that
    combination while building the plan instead of failing every row."""
    if final_turn is None:
        if template.alternating:
            raise ValueError(
                f"template {template.name!r} requires alternating roles and cannot "
                "render a single final assistant turn; pass a final-turn template")
        return template
    return final_turn


def user_message(text) -> Column:
    """A plain string prompt as one user message (T7 input)."""
    t = F.col(text) if isinstance(text, str) else text
    return F.struct(F.lit("user").alias("role"), t.alias("content"))
