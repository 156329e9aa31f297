"""Chat templates given as text, compiled to Column expressions while planning.

The text is what model files carry: ``{% for message in messages %}`` around
``{% if %}``/``{% elif %}``/``{% else %}`` and ``{{ ... }}``, with strings, ``+``,
comparisons, ``and``/``or``/``not``, ``%``, the message's role and content,
``loop.index0``, ``loop.first``, named constants and ``raise_exception('...')``. As
in those files, ``-`` at a tag strips white space, and a line that holds only a
block tag leaves nothing. Anything else is refused with a ValueError, before any
row is read.

A compiled template has the methods of ``templates.ChatTemplate`` and takes its
place anywhere. What runs are built-in functions only.

A raised message becomes the row's status: ``statuses`` maps the message to one,
else the message itself is the status. A NULL role or content is unequal to every
string; written out it is ``unsupported_role`` or ``null_content``.
"""

from __future__ import annotations

import ast
import re
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, functions as F

from prefweave.functions.templates import BOS, EOS, NULL_CONTENT, UNSUPPORTED_ROLE

TAG = re.compile(r"\{(%|\{)(-?)(.*?)(-?)(?:%|\})\}", re.S)
FOR = re.compile(r"for\s+(\w+)\s+in\s+messages$")
WHEN_NULL = {"role": UNSUPPORTED_ROLE, "content": NULL_CONTENT}


@dataclass
class Node:
    """One piece: literal text, an expression, an if with its branches, or the loop."""

    kind: str                                      # text | write | if | for
    value: object = None                           # text, expression, or the loop's variable
    branches: list[tuple[ast.expr | None, list[Node]]] = field(default_factory=list)
    body: list[Node] = field(default_factory=list)


def _expression(text: str) -> ast.expr:
    try:
        return ast.parse(text.strip(), mode="eval").body
    except SyntaxError as error:
        raise ValueError(f"template expression {text.strip()!r}") from error


def parse(text: str) -> list[Node]:
    """The template's pieces, nested."""
    top: list[Node] = []
    open_nodes: list[tuple[Node, list[Node]]] = []      # node and the list its branch fills
    text = text.removesuffix("\n")
    into, at, strip, after_block = top, 0, False, False

    def literal(end: int, dash: bool, block: bool) -> None:
        """Add the text up to ``end``, less the white space its tags take."""
        own, begins_line = text[at:end], at == 0
        if strip:
            own = own.lstrip()
        elif after_block and own.startswith("\n"):
            own, begins_line = own[1:], True
        if dash:
            own = own.rstrip()
        elif block and ("\n" in own or begins_line and not own.strip(" \t")):
            own = own.rstrip(" \t") if own.rstrip(" \t")[-1:] in ("", "\n") else own
        if own:
            into.append(Node("text", own))

    for m in TAG.finditer(text):
        block = m.group(1) == "%"
        literal(m.start(), bool(m.group(2)), block)
        at, strip, after_block = m.end(), bool(m.group(4)), block
        tag = m.group(3).strip()
        if not block:
            into.append(Node("write", _expression(tag)))
            continue
        word, _, rest = tag.partition(" ")
        if word == "for":
            loop = FOR.match(tag)
            if not loop or open_nodes:
                raise ValueError(f"template loop {tag!r}")
            node = Node("for", loop.group(1))
            into.append(node)
            open_nodes.append((node, into))
            into = node.body
        elif word == "if":
            node = Node("if", branches=[(_expression(rest), [])])
            into.append(node)
            open_nodes.append((node, into))
            into = node.branches[-1][1]
        elif word in ("elif", "else") and open_nodes and open_nodes[-1][0].kind == "if" \
                and open_nodes[-1][0].branches[-1][0] is not None:
            node = open_nodes[-1][0]
            node.branches.append((_expression(rest) if word == "elif" else None, []))
            into = node.branches[-1][1]
        elif word in ("endif", "endfor") and not rest and open_nodes and open_nodes[-1][0].kind == word[3:]:
            into = open_nodes.pop()[1]
        else:
            raise ValueError(f"template tag {tag!r}")
    if open_nodes:
        raise ValueError(f"template without end{open_nodes[-1][0].kind}")
    if "{%" in text[at:] or "{{" in text[at:]:
        raise ValueError("template tag without an end")
    literal(len(text), False, False)
    return top


@dataclass(frozen=True)
class TextTemplate:
    """A parsed template. ``alternating``: it looks at a message's place."""

    name: str
    nodes: tuple[Node, ...]
    constants: Mapping[str, object]
    statuses: Mapping[str, str]
    alternating: bool
    supports_system: bool

    # Each value is (kind, column, errors): errors are statuses in the order met.
    def _value(self, e: ast.expr, x: Column | None, i, var: str) -> tuple[str, Column, list[Column]]:
        def refuse():
            raise ValueError(f"template expression {ast.unparse(e)!r}")

        if isinstance(e, ast.Constant) and type(e.value) in (str, int, bool):
            return type(e.value).__name__, F.lit(e.value), []
        if isinstance(e, ast.Name) and e.id in self.constants:
            return type(self.constants[e.id]).__name__, F.lit(self.constants[e.id]), []
        if isinstance(e, (ast.Attribute, ast.Subscript)) and isinstance(e.value, ast.Name):
            name = e.attr if isinstance(e, ast.Attribute) else e.slice.value if isinstance(e.slice, ast.Constant) else None
            if x is not None and e.value.id == var and name in WHEN_NULL:
                return "str", x[name], [F.when(x[name].isNull(), F.lit(WHEN_NULL[name]))]
            if x is not None and e.value.id == "loop" and name in ("index0", "first"):
                place = i if isinstance(i, Column) else F.lit(i)
                return ("int", place, []) if name == "index0" else ("bool", place == 0, [])
            refuse()
        if isinstance(e, ast.BinOp) and isinstance(e.op, (ast.Add, ast.Mod)):
            (ka, a, ea), (kb, b, eb) = (self._value(p, x, i, var) for p in (e.left, e.right))
            if isinstance(e.op, ast.Add) and ka == kb == "str":
                return "str", F.concat(a, b), ea + eb
            if ka == kb == "int":
                return "int", a + b if isinstance(e.op, ast.Add) else F.pmod(a, b), []
            refuse()
        if isinstance(e, ast.Compare) and len(e.ops) == 1 and isinstance(e.ops[0], (ast.Eq, ast.NotEq)):
            (ka, a, ea), (kb, b, eb) = (self._value(p, x, i, var) for p in (e.left, e.comparators[0]))
            if ka != kb:
                refuse()
            errors = [err for p, err in ((e.left, ea), (e.comparators[0], eb)) if isinstance(p, ast.BinOp) for err in err]
            same = a.eqNullSafe(b)
            return "bool", same if isinstance(e.ops[0], ast.Eq) else ~same, errors
        if isinstance(e, ast.BoolOp) or isinstance(e, ast.UnaryOp) and isinstance(e.op, ast.Not):
            parts = [self._value(p, x, i, var) for p in (e.values if isinstance(e, ast.BoolOp) else [e.operand])]
            if any(k != "bool" or errors for k, _, errors in parts):
                refuse()
            out = parts[0][1]
            for _, c, _ in parts[1:]:
                out = out & c if isinstance(e.op, ast.And) else out | c
            return "bool", ~out if isinstance(e, ast.UnaryOp) else out, []
        if isinstance(e, ast.Call) and isinstance(e.func, ast.Name) and e.func.id == "raise_exception" and len(e.args) == 1 \
                and isinstance(e.args[0], ast.Constant) and isinstance(e.args[0].value, str) and not e.keywords:
            message = e.args[0].value
            return "str", F.lit(""), [F.lit(self.statuses.get(message, message))]
        refuse()

    def _body(self, nodes, x: Column | None, i, var: str) -> tuple[Column, Column]:
        """(text, status of the first error or NULL) of pieces for one message."""
        texts, errors = [F.lit("")], [F.lit(None).cast("string")]
        for node in nodes:
            if node.kind == "text":
                texts.append(F.lit(node.value))
            elif node.kind == "write":
                kind, c, e = self._value(node.value, x, i, var)
                if kind != "str":
                    raise ValueError(f"template writes {ast.unparse(node.value)!r}")
                texts.append(c)
                errors += e
            elif node.kind == "if":
                text = error = None
                last = (F.lit(""), F.lit(None).cast("string"))
                for test, body in node.branches:
                    own = self._body(body, x, i, var)
                    if test is None:
                        last = own
                        continue
                    kind, c, e = self._value(test, x, i, var)
                    if kind != "bool" or e:
                        raise ValueError(f"template test {ast.unparse(test)!r}")
                    text = F.when(c, own[0]) if text is None else text.when(c, own[0])
                    error = F.when(c, own[1]) if error is None else error.when(c, own[1])
                texts.append(text.otherwise(last[0]))
                errors.append(error.otherwise(last[1]))
            else:
                raise ValueError("template loop inside another piece")
        return F.concat(*texts), F.coalesce(*errors)

    def _split(self) -> tuple[tuple[Node, ...], Node, tuple[Node, ...]]:
        at = next(k for k, n in enumerate(self.nodes) if n.kind == "for")
        return self.nodes[:at], self.nodes[at], self.nodes[at + 1:]

    def _around(self, inside: Column) -> Column:
        before, loop, after = self._split()
        return F.concat(self._body(before, None, None, "")[0], inside, self._body(after, None, None, "")[0])

    def render(self, messages) -> Column:
        m = F.col(messages) if isinstance(messages, str) else messages
        loop = self._split()[1]
        return self._around(F.array_join(F.transform(m, lambda x, i: self._body(loop.body, x, i, loop.value)[0]), ""))

    def render_message(self, message) -> Column:
        msg = F.col(message) if isinstance(message, str) else message
        loop = self._split()[1]
        return self._around(self._body(loop.body, msg, 0, loop.value)[0])

    def violation(self, messages) -> Column:
        """Status of the first message that cannot be rendered, else NULL."""
        m = F.col(messages) if isinstance(messages, str) else messages
        loop = self._split()[1]
        return F.get(F.array_compact(F.transform(m, lambda x, i: self._body(loop.body, x, i, loop.value)[1])), 0)

    def message_violation(self, message) -> Column:
        msg = F.col(message) if isinstance(message, str) else message
        loop = self._split()[1]
        return self._body(loop.body, msg, 0, loop.value)[1]


def compile_template(text: str, name: str = "text", bos_token: str = BOS, eos_token: str = EOS,
                     statuses: Mapping[str, str] | None = None, **constants) -> TextTemplate:
    """Parse and check a template; unknown constructs raise ValueError here."""
    nodes = tuple(parse(text))
    if sum(n.kind == "for" for n in nodes) != 1:
        raise ValueError("a template has one loop over messages, outside of any test")

    def expressions(pieces):
        for n in pieces:
            if n.kind == "write":
                yield n.value
            for test, body in n.branches:
                if test is not None:
                    yield test
                yield from expressions(body)
            yield from expressions(n.body)

    parts = [p for e in expressions(nodes) for p in ast.walk(e)]
    template = TextTemplate(
        name, nodes, {"bos_token": bos_token, "eos_token": eos_token, "add_generation_prompt": False, **constants},
        dict(statuses or {}), any(isinstance(p, ast.Name) and p.id == "loop" for p in parts),
        any(isinstance(p, ast.Constant) and p.value == "system" for p in parts))
    template.message_violation("message"), template.render_message("message")      # refuses what it can't compile
    return template
