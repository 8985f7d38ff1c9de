"""A small sandboxed template language, compiled to Python closures.

    {{ expression }}                      writes a value
    {% for x in expression %} {% endfor %}    loop.first, loop.last and loop.index (from 1) inside
    {% if expression %} {% elif expression %} {% else %} {% endif %}
    {% generation %} {% endgeneration %}  marks what is written as generated text
    {# remark #}

Expressions: names, strings, whole numbers, true, false, none; x.key and x['key'] look a key up in a mapping and
nothing else; ==, !=, +, not, and, or, brackets; x | filter. No calls, no attributes of Python objects, no
assignment; an unknown name or filter is an error when the template is compiled.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from typing import Any

Node = tuple
FILTERS: dict[str, Callable[[str], str]] = {"trim": str.strip, "upper": str.upper, "lower": str.lower, "title": str.title}
TAG = re.compile(r"\{\{(.*?)\}\}|\{%-?(.*?)-?%\}|\{#.*?#\}", re.S)
TOKEN = re.compile(r"\s*(?:(\d+)|'((?:\\.|[^'\\])*)'|\"((?:\\.|[^\"\\])*)\"|([A-Za-z_]\w*)|(==|!=|[+.|()\[\]]))")
CONSTANTS = {"true": True, "false": False, "none": None}
ESCAPES = {"n": "\n", "t": "\t"}


class TemplateError(ValueError):
    pass


@dataclass
class Output:
    """What has been written, and where generated text begins and ends (code points, end exclusive)."""
    parts: list[str] = field(default_factory=list)
    size: int = 0
    marks: list[tuple[int, int]] = field(default_factory=list)

    def write(self, text: str) -> None:
        self.parts.append(text)
        self.size += len(text)


class _Expression:
    def __init__(self, source: str, filters: Mapping[str, Callable]):
        self.tokens, self.filters, at = [], filters, 0
        source = source.strip()
        while at < len(source):
            found = TOKEN.match(source, at)
            if not found:
                raise TemplateError(f"can't read {source[at:]!r}")
            number, single, double, name, sign = found.groups()
            if number is not None:
                self.tokens.append(("value", int(number)))
            elif name is not None:
                self.tokens.append(("name", name))
            elif sign is not None:
                self.tokens.append(("sign", sign))
            else:
                text = single if single is not None else double
                self.tokens.append(("value", re.sub(r"\\(.)", lambda m: ESCAPES.get(m[1], m[1]), text, flags=re.S)))
            at = found.end()
        self.at = 0

    def accept(self, *token: str) -> bool:
        if self.at < len(self.tokens) and self.tokens[self.at] == token:
            self.at += 1
            return True
        return False

    def expect(self, *token: str) -> None:
        if not self.accept(*token):
            raise TemplateError(f"{token[1]!r} is missing")

    def take(self, kind: str) -> Any:
        if self.at >= len(self.tokens) or self.tokens[self.at][0] != kind:
            raise TemplateError(f"a {kind} is missing")
        self.at += 1
        return self.tokens[self.at - 1][1]

    def whole(self) -> Node:
        node = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"{self.tokens[self.at][1]!r} is one too many")
        return node

    def either(self) -> Node:
        node = self.both()
        while self.accept("name", "or"):
            node = fold(("or", node, self.both()))
        return node

    def both(self) -> Node:
        node = self.negated()
        while self.accept("name", "and"):
            node = fold(("and", node, self.negated()))
        return node

    def negated(self) -> Node:
        return fold(("not", self.negated())) if self.accept("name", "not") else self.compared()

    def compared(self) -> Node:
        node = self.sum()
        for sign in ("==", "!="):
            if self.accept("sign", sign):
                return fold((sign, node, self.sum()))
        return node

    def sum(self) -> Node:
        node = self.filtered()
        while self.accept("sign", "+"):
            node = fold(("+", node, self.filtered()))
        return node

    def filtered(self) -> Node:
        node = self.place()
        while self.accept("sign", "|"):
            name = self.take("name")
            if name not in self.filters:
                raise TemplateError(f"no filter {name!r}")
            node = fold(("filter", self.filters[name], node))
        return node

    def place(self) -> Node:
        if self.accept("sign", "("):
            node = self.either()
            self.expect("sign", ")")
        elif self.at < len(self.tokens) and self.tokens[self.at][0] == "value":
            node = ("constant", self.take("value"))
        else:
            name = self.take("name")
            node = ("constant", CONSTANTS[name]) if name in CONSTANTS else ("name", name)
        while True:
            if self.accept("sign", "."):
                node = ("key", node, self.take("name"))
            elif self.accept("sign", "["):
                node = ("key", node, self.take("value"))
                self.expect("sign", "]")
            else:
                return node


def _text(value: Any) -> str:
    return "" if value is None else str(value).lower() if isinstance(value, bool) else str(value)


def _look_up(value: Any, key: Any) -> Any:
    if not isinstance(value, Mapping):
        raise TemplateError(f"{key!r} of something that is no mapping")
    return value.get(key)


OPERATIONS: dict[str, Callable] = {
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "+": lambda a, b: _text(a) + _text(b),
}


def fold(node: Node) -> Node:
    """The constant that a node of constants stands for; `and` and `or` with a known left side lose it."""
    kind, *parts = node
    known = [p[1] for p in parts if isinstance(p, tuple) and p[0] == "constant"]
    if kind in OPERATIONS and len(known) == 2:
        return ("constant", OPERATIONS[kind](*known))
    if kind == "not" and known:
        return ("constant", not known[0])
    if kind == "filter" and known:
        return ("constant", parts[0](_text(known[0])))
    if kind in ("and", "or") and parts[0][0] == "constant":
        return parts[1] if bool(parts[0][1]) == (kind == "and") else parts[0]
    return node


def parse(source: str, filters: Mapping[str, Callable] | None = None) -> Node:
    """The syntax tree, constants folded: branches that can't be taken are gone, neighbouring texts are one."""
    filters = {**FILTERS, **(filters or {})}
    pieces: list[tuple[str, str]] = []
    at = 0
    for tag in TAG.finditer(source):
        pieces.append(("text", source[at:tag.start()]))
        if tag[1] is not None:
            pieces.append(("write", tag[1]))
        elif tag[2] is not None:
            pieces.append(("do", tag[2].strip()))
        at = tag.end()
    pieces.append(("text", source[at:]))
    pieces.reverse()

    def block(*ends: str) -> tuple[Node, str]:
        nodes: list[Node] = []
        while pieces:
            kind, text = pieces.pop()
            if kind == "text":
                add(nodes, ("text", text))
            elif kind == "write":
                node = _Expression(text, filters).whole()
                add(nodes, ("text", _text(node[1])) if node[0] == "constant" else ("write", node))
            else:
                word = text.split(None, 1)[0] if text else ""
                if word in ends:
                    return ("block", nodes), text
                add(nodes, statement(word, text[len(word):]))
        if ends:
            raise TemplateError(f"{ends[-1]!r} is missing")
        return ("block", nodes), ""

    def add(nodes: list[Node], node: Node) -> None:
        if node[0] == "block":
            for inner in node[1]:
                add(nodes, inner)
        elif node[0] == "text" and nodes and nodes[-1][0] == "text":
            nodes[-1] = ("text", nodes[-1][1] + node[1])
        elif node != ("text", ""):
            nodes.append(node)

    def statement(word: str, rest: str) -> Node:
        if word == "for":
            found = re.fullmatch(r"\s*([A-Za-z_]\w*)\s+in\s+(.*)", rest, re.S)
            if not found:
                raise TemplateError(f"for{rest}")
            return ("for", found[1], _Expression(found[2], filters).whole(), block("endfor")[0])
        if word == "generation":
            return ("generation", block("endgeneration")[0])
        if word != "if":
            raise TemplateError(f"no statement {word!r}")
        test = _Expression(rest, filters).whole()
        then, end = block("elif", "else", "endif")
        if end.startswith("elif"):
            other = statement("if", end[4:])
        else:
            other = block("endif")[0] if end == "else" else ("block", [])
        if test[0] == "constant":
            return then if test[1] else other
        return ("if", test, then, other)

    return block()[0]


def _value(node: Node, names: set[str]) -> Callable[[dict], Any]:
    kind, *parts = node
    if kind == "constant":
        return lambda scope, value=parts[0]: value
    if kind == "name":
        if parts[0] not in names:
            raise TemplateError(f"no name {parts[0]!r}")
        return lambda scope, name=parts[0]: scope[name]
    if kind == "key":
        of, key = _value(parts[0], names), parts[1]
        return lambda scope: _look_up(of(scope), key)
    if kind == "filter":
        change, of = parts[0], _value(parts[1], names)
        return lambda scope: change(_text(of(scope)))
    if kind == "not":
        of = _value(parts[0], names)
        return lambda scope: not of(scope)
    a, b = (_value(p, names) for p in parts)
    if kind == "and":
        return lambda scope: a(scope) and b(scope)
    if kind == "or":
        return lambda scope: a(scope) or b(scope)
    operation = OPERATIONS[kind]
    return lambda scope: operation(a(scope), b(scope))


def generate(node: Node, names: set[str], marked: bool = False) -> Callable[[dict, Output], None]:
    """A closure that writes what the node stands for."""
    kind, *parts = node
    if kind == "text":
        return lambda scope, out, text=parts[0]: out.write(text)
    if kind == "write":
        of = _value(parts[0], names)
        return lambda scope, out: out.write(_text(of(scope)))
    if kind == "if":
        test, then, other = _value(parts[0], names), generate(parts[1], names, marked), generate(parts[2], names, marked)
        return lambda scope, out: (then if test(scope) else other)(scope, out)
    if kind == "generation":
        if marked:
            raise TemplateError("generation inside generation")
        body = generate(parts[0], names, True)

        def mark(scope: dict, out: Output) -> None:
            start = out.size
            body(scope, out)
            out.marks.append((start, out.size))
        return mark
    if kind == "for":
        name, items, body = parts[0], _value(parts[1], names), generate(parts[2], names | {parts[0], "loop"}, marked)

        def loop(scope: dict, out: Output) -> None:
            values = list(items(scope) or ())
            for i, value in enumerate(values):
                place = {"first": i == 0, "last": i == len(values) - 1, "index": i + 1}
                body({**scope, name: value, "loop": place}, out)
        return loop
    steps = [generate(n, names, marked) for n in parts[0]]

    def run(scope: dict, out: Output) -> None:
        for step in steps:
            step(scope, out)
    return run


def compiled(source: str, names: set[str], filters: Mapping[str, Callable] | None = None) -> Callable[[dict], Output]:
    """A function from values for `names` to what the template writes."""
    write = generate(parse(source, filters), set(names))

    def render(values: dict) -> Output:
        out = Output()
        write(values, out)
        return out

    return render
