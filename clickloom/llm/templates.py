"""A small template language for conversations, compiled to Python closures.

``{{ expression }}`` writes a value, ``{% if %} {% elif %} {% else %} {% endif %}`` chooses, ``{% for x in
xs %} {% endfor %}`` repeats (with ``loop.index0``, ``loop.first``, ``loop.last``), ``{% set x = expression %}``
names a value, ``{% generation %} {% endgeneration %}`` marks what a model is trained on, ``{# #}`` is a
remark. Expressions have strings, integers, ``true``, ``false``, ``none``, names, ``a.b`` and ``a['b']``,
``not and or``, comparisons, ``in``, ``+``, ``~`` (joins as text), parentheses, and filters behind ``|``.

It is sandboxed: a name is one that the caller gives, ``.`` and ``[]`` look into mappings only, and
there are no calls but the listed filters. Nothing of Python can be reached.

Source goes to tokens, to a syntax tree, through constant folding, to closures. Rendering is lazy, so
the messages may be an iterator that never is in memory as a whole.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass
from typing import Any

Piece = tuple[str | None, bool]  # text and whether it is trained on; None: the next message begins
Value = Callable[[dict[str, Any]], Any]


class TemplateError(ValueError):
    pass


# The syntax tree.
@dataclass(frozen=True)
class Const:
    value: Any


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Look:
    of: Any
    key: Any


@dataclass(frozen=True)
class Apply:
    """An operator or a filter by name."""

    what: str
    args: tuple


@dataclass(frozen=True)
class Write:
    value: Any


@dataclass(frozen=True)
class If:
    test: Any
    then: tuple
    other: tuple


@dataclass(frozen=True)
class For:
    name: str
    over: Any
    body: tuple


@dataclass(frozen=True)
class Set:
    name: str
    value: Any


@dataclass(frozen=True)
class Generation:
    body: tuple


def _text(value: Any) -> str:
    return "" if value is None else "true" if value is True else "false" if value is False else str(value)


def _add(a: Any, b: Any) -> Any:
    if type(a) is not type(b) or not isinstance(a, str | int):
        raise TemplateError("+ takes two texts or two integers")
    return a + b


#: Control strings of the chat format; a text that holds one is escaped.
_CONTROL = re.compile(r"(<\\*)(/?s>)|(\[\\*)(/?INST\])")
_ESCAPED = re.compile(r"(<\\*)\\(/?s>)|(\[\\*)\\(/?INST\])")


def escape(text: str) -> str:
    """One more backslash behind the first character of each control string, escaped before or not."""
    return _CONTROL.sub(lambda m: f"{m[1] or m[3]}\\{m[2] or m[4]}", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: f"{m[1] or m[3]}{m[2] or m[4]}", text)


FILTERS: dict[str, Callable[[Any], Any]] = {
    "trim": lambda x: _text(x).strip(),
    "upper": lambda x: _text(x).upper(),
    "lower": lambda x: _text(x).lower(),
    "length": lambda x: len(x) if isinstance(x, str | list | tuple | Mapping) else 0,
    "escape": lambda x: escape(_text(x)),
}
_OPERATORS: dict[str, Callable[..., Any]] = {
    "not": lambda x: not x,
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    ">": lambda a, b: a > b,
    "<=": lambda a, b: a <= b,
    ">=": lambda a, b: a >= b,
    "in": lambda a, b: a in b,
    "+": _add,
    "~": lambda a, b: _text(a) + _text(b),
}

_TAG = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}|\{#.*?#\}", re.S)
_TOKEN = re.compile(r"""\s*(?:(?P<text>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<int>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|<=|>=|[<>|+~().\[\]=]))""", re.S)
_CONSTANTS = {"true": True, "false": False, "none": None}
_WORDS = {"and", "or", "not", "in"}
_UNQUOTED = {"n": "\n", "t": "\t", "r": "\r"}


class _Expression:
    """A recursive-descent parser over the tokens of one tag."""

    def __init__(self, source: str) -> None:
        self.tokens: list[tuple[str, str]] = []
        at, end = 0, len(source.rstrip())
        while at < end:
            found = _TOKEN.match(source, at)
            if not found:
                raise TemplateError(f"cannot read {source[at:]!r}")
            kind = found.lastgroup or ""
            self.tokens.append((kind, found[kind]))
            at = found.end()
        self.at = 0

    def take(self, *wanted: str) -> str | None:
        if self.at < len(self.tokens):
            kind, value = self.tokens[self.at]
            if kind != "text" and value in wanted:
                self.at += 1
                return value
        return None

    def need(self, wanted: str) -> None:
        if not self.take(wanted):
            raise TemplateError(f"{wanted!r} expected")

    def name(self) -> str:
        if self.at < len(self.tokens) and self.tokens[self.at][0] == "name" and self.tokens[self.at][1] not in _WORDS | _CONSTANTS.keys():
            self.at += 1
            return self.tokens[self.at - 1][1]
        raise TemplateError("a name is expected")

    def end(self) -> None:
        if self.at < len(self.tokens):
            raise TemplateError(f"{self.tokens[self.at][1]!r} was not expected")

    def whole(self) -> Any:
        node = self.either()
        self.end()
        return node

    def either(self) -> Any:
        node = self.both()
        while self.take("or"):
            node = Apply("or", (node, self.both()))
        return node

    def both(self) -> Any:
        node = self.negated()
        while self.take("and"):
            node = Apply("and", (node, self.negated()))
        return node

    def negated(self) -> Any:
        return Apply("not", (self.negated(),)) if self.take("not") else self.compared()

    def compared(self) -> Any:
        node = self.joined()
        while op := self.take("==", "!=", "<=", ">=", "<", ">", "in"):
            node = Apply(op, (node, self.joined()))
        return node

    def joined(self) -> Any:
        node = self.filtered()
        while op := self.take("+", "~"):
            node = Apply(op, (node, self.filtered()))
        return node

    def filtered(self) -> Any:
        node = self.looked()
        while self.take("|"):
            name = self.name()
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            node = Apply(f"|{name}", (node,))
        return node

    def looked(self) -> Any:
        node = self.single()
        while op := self.take(".", "["):
            if op == ".":
                node = Look(node, Const(self.name()))
            else:
                node = Look(node, self.either())
                self.need("]")
        return node

    def single(self) -> Any:
        if self.take("("):
            node = self.either()
            self.need(")")
            return node
        if self.at >= len(self.tokens):
            raise TemplateError("a value is expected")
        kind, value = self.tokens[self.at]
        if kind == "name" and value in _CONSTANTS:
            self.at += 1
            return Const(_CONSTANTS[value])
        if kind == "name":
            return Name(self.name())
        self.at += 1
        if kind == "int":
            return Const(int(value))
        if kind == "text":
            return Const(re.sub(r"\\(.)", lambda m: _UNQUOTED.get(m[1], m[1]), value[1:-1], flags=re.S))
        raise TemplateError(f"{value!r} was not expected")


def parse(source: str) -> tuple:
    """The syntax tree of a template."""
    parts: list[tuple[str, str]] = []
    at = 0
    for tag in _TAG.finditer(source):
        parts.append(("text", source[at : tag.start()]))
        if tag[1] is not None:
            parts.append(("value", tag[1]))
        elif tag[2] is not None:
            parts.append(("tag", tag[2].strip()))
        at = tag.end()
    parts.append(("text", source[at:]))
    position = 0

    def block(*ends: str) -> tuple[tuple, str, str]:
        """Nodes up to one of the tags in ``ends``, that tag's word and the rest of the tag."""
        nonlocal position
        nodes: list = []
        while position < len(parts):
            kind, content = parts[position]
            position += 1
            if kind == "text":
                if content:
                    nodes.append(Write(Const(content)))
                continue
            if kind == "value":
                nodes.append(Write(_Expression(content).whole()))
                continue
            word, _, rest = content.partition(" ")
            if word in ends:
                return tuple(nodes), word, rest
            nodes.append(statement(word, rest))
        if ends:
            raise TemplateError(f"{ends[-1]!r} is missing")
        return tuple(nodes), "", ""

    def statement(word: str, rest: str) -> Any:
        if word == "if":
            return branch(rest)
        if word == "for":
            read = _Expression(rest)
            name = read.name()
            read.need("in")
            return For(name, read.whole(), block("endfor")[0])
        if word == "generation":
            return Generation(block("endgeneration")[0])
        if word == "set":
            read = _Expression(rest)
            name = read.name()
            read.need("=")
            return Set(name, read.whole())
        raise TemplateError(f"no tag {word!r}")

    def branch(rest: str) -> If:
        test = _Expression(rest).whole()
        then, word, more = block("elif", "else", "endif")
        if word == "elif":
            return If(test, then, (branch(more),))
        return If(test, then, block("endif")[0] if word == "else" else ())

    return block()[0]


def fold(node: Any) -> Any:
    """The same tree with all that does not depend on the input worked out, and texts side by side joined."""
    if isinstance(node, tuple):
        out: list = []
        for child in map(fold, node):
            for part in child if isinstance(child, tuple) else (child,):
                if isinstance(part, Write) and isinstance(part.value, Const):
                    part = Write(Const(_text(part.value.value)))
                    if out and isinstance(out[-1], Write) and isinstance(out[-1].value, Const):
                        part = Write(Const(out.pop().value.value + part.value.value))
                    if not part.value.value:
                        continue
                out.append(part)
        return tuple(out)
    if isinstance(node, Apply):
        args = tuple(map(fold, node.args))
        if node.what in ("and", "or") and isinstance(args[0], Const):
            return args[1] if bool(args[0].value) == (node.what == "and") else args[0]
        if node.what not in ("and", "or") and all(isinstance(a, Const) for a in args):
            return Const(_function(node.what)(*(a.value for a in args)))
        return Apply(node.what, args)
    if isinstance(node, Look):
        return Look(fold(node.of), fold(node.key))
    if isinstance(node, Write):
        return Write(fold(node.value))
    if isinstance(node, Set):
        return Set(node.name, fold(node.value))
    if isinstance(node, For):
        return For(node.name, fold(node.over), fold(node.body))
    if isinstance(node, Generation):
        return Generation(fold(node.body))
    if isinstance(node, If):
        test = fold(node.test)
        if isinstance(test, Const):
            return fold(node.then if test.value else node.other)
        return If(test, fold(node.then), fold(node.other))
    return node


def _function(what: str) -> Callable[..., Any]:
    return FILTERS[what[1:]] if what.startswith("|") else _OPERATORS[what]


def _value(node: Any) -> Value:
    if isinstance(node, Const):
        constant = node.value
        return lambda env: constant
    if isinstance(node, Name):
        name = node.name
        return lambda env: env.get(name)
    if isinstance(node, Look):
        of, key = _value(node.of), _value(node.key)

        def look(env: dict[str, Any]) -> Any:
            inside = of(env)
            return inside.get(key(env)) if isinstance(inside, Mapping) else None

        return look
    args = [_value(a) for a in node.args]
    if node.what == "and":
        return lambda env: args[0](env) and args[1](env)
    if node.what == "or":
        return lambda env: args[0](env) or args[1](env)
    function = _function(node.what)
    if len(args) == 1:
        one = args[0]
        return lambda env: function(one(env))
    left, right = args
    return lambda env: function(left(env), right(env))


Render = Callable[[dict[str, Any], bool], Iterator[Piece]]


def _block(nodes: tuple, messages: str) -> Render:
    steps = [_step(n, messages) for n in nodes]

    def run(env: dict[str, Any], in_loss: bool) -> Iterator[Piece]:
        for step in steps:
            yield from step(env, in_loss)

    return run


def _step(node: Any, messages: str) -> Render:
    if isinstance(node, Write):
        value = _value(node.value)

        def write(env: dict[str, Any], in_loss: bool) -> Iterator[Piece]:
            yield _text(value(env)), in_loss

        return write
    if isinstance(node, Set):
        name, given = node.name, _value(node.value)

        def assign(env: dict[str, Any], in_loss: bool) -> Iterator[Piece]:
            env[name] = given(env)
            yield from ()

        return assign
    if isinstance(node, Generation):
        marked = _block(node.body, messages)
        return lambda env, in_loss: marked(env, True)
    if isinstance(node, If):
        test, then, other = _value(node.test), _block(node.then, messages), _block(node.other, messages)
        return lambda env, in_loss: (then if test(env) else other)(env, in_loss)
    name, over, body = node.name, _value(node.over), _block(node.body, messages)
    tells = isinstance(node.over, Name) and node.over.name == messages

    def repeat(env: dict[str, Any], in_loss: bool) -> Iterator[Piece]:
        items, none = iter(over(env) or ()), object()
        outer = env.get("loop")
        item, index = next(items, none), 0
        while item is not none:
            if tells:
                yield None, False
            following = next(items, none)
            env[name] = item
            env["loop"] = {"index0": index, "index": index + 1, "first": index == 0, "last": following is none}
            yield from body(env, in_loss)
            item, index = following, index + 1
        env["loop"] = outer

    return repeat


def compiled(source: str, messages: str = "messages") -> Callable[[dict[str, Any]], Iterator[Piece]]:
    """A function from the named values to the pieces of the output; ``messages`` names the conversation."""
    run = _block(fold(parse(source)), messages)
    return lambda values: run(dict(values), False)
