"""A compiler for a sandboxed chat template language, and the formatting of conversations with it.

A template is parsed into a syntax tree, constant parts are folded, and each node becomes a Python closure. Rendering
is a stream: it takes the messages one by one and gives out pieces of text, each marked as inside or outside a
``generation`` block. Templates see only the messages and their own loop variables; there are no calls, no
imports and no access to Python attributes.

    {{ expr }}                          text of a value
    {% for m in messages %} ... {% endfor %}
    {% if a %} ... {% elif b %} ... {% else %} ... {% endif %}
    {% generation %} ... {% endgeneration %}
    {# comment #}; "-" beside a bracket strips white space there

Expressions: strings, whole numbers, true, false, none, names, ``a.b``, ``a['b']``, ``not``, ``and``, ``or``,
``==``, ``!=``, ``in``, ``~`` (joins texts), ``a if c else b``, brackets, and the filters ``escape``, ``trim``, ``upper``, ``lower``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Strings that mean something in the formatted text.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]")
#: The template of the query: every turn between its own marks, what the assistant says under the loss mask.
TEMPLATE = (
    "{% for m in messages %}<s>[INST] {{ m.role | escape }} [/INST] "
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}{% else %}{{ m.text | escape }}{% endif %}"
    "</s>\n{% endfor %}"
)
#: A row of formatted output is given out when it holds this many characters.
CHUNK_CHARS = 1 << 16

_CONTROL = re.compile("|".join(map(re.escape, ("\\", *CONTROLS))))
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    """``text`` without any control string: a backslash goes after the first character of each, and before each backslash."""
    return _CONTROL.sub(lambda m: "\\\\" if m.group() == "\\" else m.group()[0] + "\\" + m.group()[1:], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


FILTERS: dict[str, Callable[[str], str]] = {"escape": escape, "trim": str.strip, "upper": str.upper, "lower": str.lower}


class TemplateError(ValueError):
    pass


# ---- syntax tree


@dataclass(frozen=True)
class Const:
    value: Any


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Item:
    of: Any
    key: Any


@dataclass(frozen=True)
class Call:
    """An operator or a filter with its operands."""

    name: str
    args: tuple


@dataclass(frozen=True)
class Text:
    value: str


@dataclass(frozen=True)
class Output:
    expr: Any


@dataclass(frozen=True)
class For:
    name: str
    of: Any
    body: tuple


@dataclass(frozen=True)
class If:
    cases: tuple  # (condition, body) pairs; the last condition can be Const(True)


@dataclass(frozen=True)
class Generation:
    body: tuple


_PART = re.compile(r"(\{\{-?.*?-?\}\}|\{%-?.*?-?%\}|\{#.*?#\})", re.DOTALL)
_TOKEN = re.compile(r"\s*(?:('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(\d+)|([A-Za-z_]\w*)|(==|!=|[.\[\]()|~]))")
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}


class _Expression:
    """A recursive-descent parser of one expression; operators from loose to tight."""

    def __init__(self, source: str) -> None:
        self.tokens, at = [], 0
        source = source.rstrip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"cannot read {source[at:]!r}")
            kind = ("text", "number", "name", "mark")[m.lastindex - 1]
            self.tokens.append((kind, m.group(m.lastindex)))
            at = m.end()
        self.at = 0

    def take(self, *values: str) -> str | None:
        if self.at < len(self.tokens) and self.tokens[self.at][0] in ("name", "mark") and self.tokens[self.at][1] in values:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def need(self, value: str) -> None:
        if not self.take(value):
            raise TemplateError(f"{value!r} is missing")

    def whole(self) -> Any:
        tree = self.choice()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return tree

    def choice(self) -> Any:
        left = self.either()
        if self.take("if"):
            condition = self.either()
            self.need("else")
            return Call("choose", (condition, left, self.choice()))
        return left

    def either(self) -> Any:
        left = self.both()
        while self.take("or"):
            left = Call("or", (left, self.both()))
        return left

    def both(self) -> Any:
        left = self.negation()
        while self.take("and"):
            left = Call("and", (left, self.negation()))
        return left

    def negation(self) -> Any:
        return Call("not", (self.negation(),)) if self.take("not") else self.comparison()

    def comparison(self) -> Any:
        left = self.joined()
        while op := self.take("==", "!=", "in"):
            left = Call(op, (left, self.joined()))
        return left

    def joined(self) -> Any:
        left = self.filtered()
        while self.take("~"):
            left = Call("~", (left, self.filtered()))
        return left

    def filtered(self) -> Any:
        left = self.access()
        while self.take("|"):
            kind, name = self.tokens[self.at] if self.at < len(self.tokens) else ("", "")
            if kind != "name" or name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            self.at += 1
            left = Call(name, (left,))
        return left

    def access(self) -> Any:
        left = self.atom()
        while mark := self.take(".", "["):
            if mark == ".":
                kind, name = self.tokens[self.at] if self.at < len(self.tokens) else ("", "")
                if kind != "name":
                    raise TemplateError("a name is missing after '.'")
                self.at += 1
                left = Item(left, Const(name))
            else:
                left = Item(left, self.choice())
                self.need("]")
        return left

    def atom(self) -> Any:
        if self.take("("):
            tree = self.choice()
            self.need(")")
            return tree
        if self.at == len(self.tokens):
            raise TemplateError("an expression is missing")
        kind, value = self.tokens[self.at]
        self.at += 1
        if kind == "text":
            return Const(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m.group(1), m.group(1)), value[1:-1], flags=re.DOTALL))
        if kind == "number":
            return Const(int(value))
        if kind == "name":
            constants = {"true": True, "false": False, "none": None}
            return Const(constants[value]) if value in constants else Name(value)
        raise TemplateError(f"unexpected {value!r}")


def parse(source: str) -> tuple:
    """The statements of a template."""
    parts = []
    for i, part in enumerate(_PART.split(source)):
        if i % 2 == 0:
            parts.append(("text", part))
        elif part[1] != "#":
            parts.append((part[1], part[2:-2]))
    for i, (kind, part) in enumerate(parts):
        if kind != "text":
            if part.startswith("-") and i and parts[i - 1][0] == "text":
                parts[i - 1] = ("text", parts[i - 1][1].rstrip())
            if part.endswith("-") and i + 1 < len(parts) and parts[i + 1][0] == "text":
                parts[i + 1] = ("text", parts[i + 1][1].lstrip())
            parts[i] = (kind, part.strip("-").strip())
    rest = iter(parts)
    body, end = _block(rest, ())
    if end:
        raise TemplateError(f"unexpected {end!r}")
    return body


def _block(parts: Iterator[tuple[str, str]], ends: tuple[str, ...]) -> tuple[tuple, str]:
    """Statements up to one of the words in ``ends``, and the tag that ended them."""
    body: list = []
    for kind, part in parts:
        if kind == "text":
            body.append(Text(part))
        elif kind == "{":
            body.append(Output(_Expression(part).whole()))
        else:
            word, _, rest = part.partition(" ")
            if word in ends:
                return tuple(body), part
            if word == "for":
                m = re.fullmatch(r"\s*([A-Za-z_]\w*)\s+in\s+(.+)", rest, re.DOTALL)
                if not m:
                    raise TemplateError(f"cannot read {part!r}")
                body.append(For(m[1], _Expression(m[2]).whole(), _block(parts, ("endfor",))[0]))
            elif word == "if":
                cases, tag = [], part
                while True:
                    condition = Const(True) if tag == "else" else _Expression(tag.partition(" ")[2]).whole()
                    inner, tag_next = _block(parts, ("endif",) if tag == "else" else ("elif", "else", "endif"))
                    cases.append((condition, inner))
                    if tag_next == "endif":
                        break
                    tag = tag_next
                body.append(If(tuple(cases)))
            elif word == "generation":
                body.append(Generation(_block(parts, ("endgeneration",))[0]))
            else:
                raise TemplateError(f"no statement {word!r}")
    if ends:
        raise TemplateError(f"{ends[-1]!r} is missing")
    return tuple(body), ""


# ---- folding and closures


def _text(value: Any) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value).lower() if isinstance(value, bool) else str(value)


_OPERATORS: dict[str, Callable[..., Any]] = {
    "not": lambda a: not a,
    "and": lambda a, b: a and b,
    "or": lambda a, b: a or b,
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "in": lambda a, b: a in b if b is not None else False,
    "~": lambda a, b: _text(a) + _text(b),
    "choose": lambda c, a, b: a if c else b,
} | {name: (lambda a, f=f: f(_text(a))) for name, f in FILTERS.items()}


def fold(node: Any) -> Any:
    """The tree with every part that needs no message worked out."""
    if isinstance(node, tuple):
        out: list = []
        for statement in map(fold, node):
            for one in statement if isinstance(statement, tuple) else (statement,):
                if isinstance(one, Text) and out and isinstance(out[-1], Text):
                    out[-1] = Text(out[-1].value + one.value)
                elif one != Text(""):
                    out.append(one)
        return tuple(out)
    if isinstance(node, Call):
        args = tuple(map(fold, node.args))
        return Const(_OPERATORS[node.name](*(a.value for a in args))) if all(isinstance(a, Const) for a in args) else Call(node.name, args)
    if isinstance(node, Item):
        return Item(fold(node.of), fold(node.key))
    if isinstance(node, Output):
        expr = fold(node.expr)
        return Text(_text(expr.value)) if isinstance(expr, Const) else Output(expr)
    if isinstance(node, For):
        return For(node.name, fold(node.of), fold(node.body))
    if isinstance(node, Generation):
        body = fold(node.body)
        return Generation(body) if body else ()
    if isinstance(node, If):
        cases = []
        for condition, body in node.cases:
            condition = fold(condition)
            if isinstance(condition, Const) and not condition.value:
                continue
            cases.append((condition, fold(body)))
            if isinstance(condition, Const):
                break
        if not cases or isinstance(cases[0][0], Const):
            return cases[0][1] if cases else ()
        return If(tuple(cases))
    return node


Scope = dict[str, Any]
Piece = tuple[str, bool]


def _value(node: Any) -> Callable[[Scope], Any]:
    if isinstance(node, Const):
        return lambda scope, value=node.value: value
    if isinstance(node, Name):
        return lambda scope, name=node.name: scope.get(name)
    if isinstance(node, Item):
        of, key = _value(node.of), _value(node.key)

        def item(scope: Scope) -> Any:
            value = of(scope)
            return value.get(key(scope)) if isinstance(value, dict) else None  # nothing but messages has parts

        return item
    operator, args = _OPERATORS[node.name], tuple(map(_value, node.args))
    if node.name in ("and", "or"):
        left, right = args
        return (lambda scope: left(scope) and right(scope)) if node.name == "and" else (lambda scope: left(scope) or right(scope))
    return lambda scope: operator(*(a(scope) for a in args))


def _body(statements: tuple, inside: bool) -> Callable[[Scope], Iterator[Piece]]:
    steps = [_statement(s, inside) for s in statements]

    def run(scope: Scope) -> Iterator[Piece]:
        for step in steps:
            yield from step(scope)

    return run


def _statement(node: Any, inside: bool) -> Callable[[Scope], Iterator[Piece]]:
    if isinstance(node, Text):
        pieces = ((node.value, inside),)
        return lambda scope: pieces
    if isinstance(node, Output):
        value = _value(node.expr)
        return lambda scope: ((_text(value(scope)), inside),)
    if isinstance(node, Generation):
        return _body(node.body, True)
    if isinstance(node, If):
        cases = [(_value(c), _body(b, inside)) for c, b in node.cases]
        return lambda scope: next((body(scope) for condition, body in cases if condition(scope)), ())
    of, body, name = _value(node.of), _body(node.body, inside), node.name

    def loop(scope: Scope) -> Iterator[Piece]:
        for value in of(scope) or ():
            yield from body({**scope, name: value})

    return loop


def compile_template(source: str) -> Callable[[Iterable[dict]], Iterator[Piece]]:
    """A function from messages to pieces of text with whether each is generated. The messages are read once, in order."""
    run = _body(fold(parse(source)), False)
    return lambda messages: run({"messages": messages})


# ---- conversations


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _batched(rows: Iterator[tuple], schema: pa.Schema, chars: Callable[[tuple], int], limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    held, n = [], 0
    for row in rows:
        held.append(row)
        n += chars(row) + 64
        if n >= limit:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held, n = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def format_conversations(turns: DataFrame, template: str = TEMPLATE, key: str = "conv_id", order: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``key, chunk, formatted, spans``: the formatted text of each conversation in chunks, and what of a chunk is generated.

    Rows follow each other by ``order``, null first, equal ones by role and text; repeated rows are turns of their own. A
    null role or text is empty. Rows without a key are one conversation. Only a buffer of one chunk is held, so the
    length of a conversation is not bounded by memory; as its digest is sequential, one task reads all of it.
    """
    kind = turns.schema[key].dataType.simpleString()
    rows = turns.select(F.col(key).alias("_key"), F.coalesce(role, F.lit("")).alias("_role"), F.coalesce(text, F.lit("")).alias("_text"), F.col(order).alias("_order"))
    ordered = rows.repartition("_key").sortWithinPartitions("_key", "_order", "_role", "_text").drop("_order")
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, first = compile_template(template), next(batches, None)
        if first is None:
            return

        def stream() -> Iterator[pa.RecordBatch]:
            yield first
            yield from batches

        def chunks() -> Iterator[tuple]:
            for conv, own in groupby(_streamed(stream()), key=lambda r: r[0]):
                number, held, n, spans = 0, [], 0, []
                for piece, generated in run({"role": r, "text": t} for _, r, t in own):
                    if generated:
                        spans.append({"start": n, "end": n + len(piece)})
                    held.append(piece)
                    n += len(piece)
                    if n >= CHUNK_CHARS:
                        yield conv, number, "".join(held), spans
                        number, held, n, spans = number + 1, [], 0, []
                if held or not number:
                    yield conv, number, "".join(held), spans

        schema = pa.schema([pa.field(key, first.schema.field(0).type), ("chunk", pa.int64()), ("formatted", pa.string()), ("spans", span)])
        yield from _batched(chunks(), schema, lambda r: len(r[2]))

    return ordered.mapInArrow(render, f"`{key}` {kind}, chunk long, formatted string, spans array<struct<start:bigint,end:bigint>>")


_TURN = re.compile(r"<s>\[INST\] (.*?) \[/INST\] (.*?)</s>\n", re.DOTALL)


def read_back(formatted: DataFrame, key: str = "conv_id") -> DataFrame:
    """From chunks of :data:`TEMPLATE`: number and digest of the turns, length and digest of what the loss sees, length of all.

    The chunks of a conversation must lie in one partition in order, as :func:`format_conversations` leaves them, so nothing
    is shuffled.
    """
    kind = formatted.schema[key].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return

        def stream() -> Iterator[pa.RecordBatch]:
            yield first
            yield from batches

        def digests() -> Iterator[tuple]:
            for conv, chunks in groupby(_streamed(stream()), key=lambda r: r[0]):
                turns, loss, n_turns, loss_chars, chars, rest = hashlib.sha256(), hashlib.sha256(), 0, 0, 0, ""
                for _, _, text, spans in chunks:
                    chars += len(text)
                    for s in spans:
                        said = unescape(text[s["start"] : s["end"]])
                        loss.update(said.encode("utf-8", "surrogatepass"))
                        loss_chars += len(said)
                    rest, at = rest + text, 0
                    while m := _TURN.match(rest, at):
                        turns.update(f"{unescape(m[1])}\n{unescape(m[2])}\n".encode("utf-8", "surrogatepass"))
                        n_turns, at = n_turns + 1, m.end()
                    rest = rest[at:]
                if rest:
                    raise ValueError(f"conversation {conv} does not end with a turn")
                yield conv, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars

        names = [("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
        yield from _batched(digests(), pa.schema([pa.field(key, first.schema.field(0).type), *names]), lambda r: 200)

    return formatted.mapInArrow(read, f"`{key}` {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
