"""Chat formatting with a small compiled template language.

A template is parsed to a syntax tree, constants are folded, and the tree becomes Python closures
that append to the output and note where text is generated (the loss mask). The language is a
sandbox: names come from the conversation alone, attributes are dictionary keys, filters come
from a fixed table, and there are no calls, imports or Python objects to reach.

    {{ expr }}   {% for m in messages %} ... {% endfor %}   {% generation %} ... {% endgeneration %}
    {% if expr %} ... {% elif expr %} ... {% else %} ... {% endif %}

Expressions: strings, integers, names, ``a.b``, ``a['b']``, ``|filter``, ``+``, ``==``, ``!=``,
``not``, ``and``, ``or`` and parentheses.

Control strings inside texts are escaped reversibly: ``\\`` is doubled and ``<|`` becomes
``<\\|``, so no text holds ``<|``; in roles a line feed becomes ``\\n`` as well.

Defined results: null roles and texts are empty; rows of one conversation go by turn, ties by
role, then text; repeated rows are repeated turns; a null conversation id is a conversation of its
own; an empty table gives no rows; only the columns named below return. A conversation is one
string of output, so its rows meet in one task.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHAT_TEMPLATE = (
    "{% for m in messages %}{{ '<|im_' + 'start|>' }}{{ m.role|escape_line }}{{ '\\n' }}"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text|escape }}{% endgeneration %}"
    "{% else %}{{ m.text|escape }}{% endif %}<|im_end|>{{ '\\n' }}{% endfor %}"
)
START, END = "<|im_start|>", "<|im_end|>\n"


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def escape_line(text: str) -> str:
    return escape(text).replace("\n", "\\n")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text, flags=re.S) if "\\" in text else text


FILTERS: dict[str, Callable] = {
    "escape": escape,
    "escape_line": escape_line,
    "trim": str.strip,
    "upper": str.upper,
    "lower": str.lower,
    "length": len,
}


class TemplateError(ValueError):
    pass


# Syntax tree


@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Key:
    of: object
    key: object


@dataclass(frozen=True)
class Apply:
    filter: str
    to: object


@dataclass(frozen=True)
class Op:
    kind: str
    parts: tuple


@dataclass(frozen=True)
class Emit:
    value: object


@dataclass(frozen=True)
class For:
    name: str
    over: object
    body: tuple


@dataclass(frozen=True)
class If:
    branches: tuple  # of (condition, body)


@dataclass(frozen=True)
class Generation:
    body: tuple


# Parsing

_PARTS = re.compile(r"(\{\{.*?\}\}|\{%.*?%\})", re.S)
_TOKENS = re.compile(r"\s*(?:(?P<str>'(?:[^'\\]|\\.)*')|(?P<int>\d+)|(?P<name>\w+)|(?P<op>==|!=|[|+.()\[\]]))")
_UNQUOTE = {"n": "\n", "t": "\t"}


class _Expression:
    """Recursive descent over one expression."""

    def __init__(self, text: str):
        self.tokens: list[tuple[str, str]] = []
        at, text = 0, text.strip()
        while at < len(text):
            found = _TOKENS.match(text, at)
            if not found:
                raise TemplateError(f"cannot read {text[at:]!r}")
            self.tokens.append((found.lastgroup, found[found.lastgroup]))
            at = found.end()
        self.at = 0

    def peek(self) -> tuple[str, str]:
        return self.tokens[self.at] if self.at < len(self.tokens) else ("end", "")

    def take(self, value: str | None = None) -> tuple[str, str]:
        kind, got = self.peek()
        if value is not None and got != value:
            raise TemplateError(f"expected {value!r}, found {got!r}")
        self.at += 1
        return kind, got

    def whole(self):
        node = self.either()
        if self.peek()[0] != "end":
            raise TemplateError(f"unexpected {self.peek()[1]!r}")
        return node

    def chain(self, word: str, below: Callable):
        parts = [below()]
        while self.peek() == ("name" if word.isalpha() else "op", word):
            self.take()
            parts.append(below())
        return parts[0] if len(parts) == 1 else Op(word, tuple(parts))

    def either(self):
        return self.chain("or", self.both)

    def both(self):
        return self.chain("and", self.negated)

    def negated(self):
        if self.peek() == ("name", "not"):
            self.take()
            return Op("not", (self.negated(),))
        return self.compared()

    def compared(self):
        left = self.joined()
        if self.peek()[1] in ("==", "!=") and self.peek()[0] == "op":
            return Op(self.take()[1], (left, self.joined()))
        return left

    def joined(self):
        return self.chain("+", self.filtered)

    def filtered(self):
        node = self.atom()
        while self.peek()[0] == "op" and self.peek()[1] in ("|", ".", "["):
            mark = self.take()[1]
            if mark == "[":
                node = Key(node, self.either())
                self.take("]")
                continue
            kind, name = self.take()
            if kind != "name" or mark == "|" and name not in FILTERS:
                raise TemplateError(f"no such filter or key: {name!r}")
            node = Apply(name, node) if mark == "|" else Key(node, Const(name))
        return node

    def atom(self):
        kind, value = self.take()
        if kind == "str":
            return Const(re.sub(r"\\(.)", lambda m: _UNQUOTE.get(m[1], m[1]), value[1:-1], flags=re.S))
        if kind == "int":
            return Const(int(value))
        if kind == "name" and value in ("true", "false"):
            return Const(value == "true")
        if kind == "name":
            return Name(value)
        if value == "(":
            node = self.either()
            self.take(")")
            return node
        raise TemplateError(f"unexpected {value or 'end'!r}")


def parse(template: str) -> tuple:
    parts = [p for p in _PARTS.split(template) if p]
    at = 0

    def body(*closers: str) -> tuple[tuple, str]:
        nonlocal at
        nodes = []
        while at < len(parts):
            part = parts[at]
            at += 1
            if part.startswith("{{"):
                nodes.append(Emit(_Expression(part[2:-2]).whole()))
            elif part.startswith("{%"):
                word, _, rest = part[2:-2].strip().partition(" ")
                if word in closers:
                    return tuple(nodes), part[2:-2].strip()
                nodes.append(statement(word, rest.strip()))
            else:
                nodes.append(Emit(Const(part)))
        if closers:
            raise TemplateError(f"missing {closers[-1]}")
        return tuple(nodes), ""

    def statement(word: str, rest: str):
        if word == "for" and (found := re.fullmatch(r"(\w+) in (.+)", rest)):
            return For(found[1], _Expression(found[2]).whole(), body("endfor")[0])
        if word == "generation" and not rest:
            return Generation(body("endgeneration")[0])
        if word == "if":
            branches, condition = [], _Expression(rest).whole()
            while True:
                inner, closer = body("elif", "else", "endif")
                branches.append((condition, inner))
                kind, _, rest = closer.partition(" ")
                if kind == "endif":
                    return If(tuple(branches))
                condition = Const(True) if kind == "else" else _Expression(rest).whole()
        raise TemplateError(f"unknown statement {word!r}")

    return body()[0]


# Folding

_OPS: dict[str, Callable] = {
    "+": lambda values: sum(values[1:], start=values[0]) if not isinstance(values[0], str) else "".join(values),
    "==": lambda values: values[0] == values[1],
    "!=": lambda values: values[0] != values[1],
    "not": lambda values: not values[0],
}


def fold(node):
    """The tree with what is constant computed, dead branches gone and neighbouring texts joined."""
    if isinstance(node, tuple):
        out: list = []
        for part in map(fold, node):
            for x in part if isinstance(part, tuple) else (part,):
                if isinstance(x, Emit) and isinstance(x.value, Const):
                    if out and isinstance(out[-1], Emit) and isinstance(out[-1].value, Const):
                        x = Emit(Const(str(out.pop().value.value) + str(x.value.value)))
                out.append(x)
        return tuple(out)
    if isinstance(node, Emit):
        return Emit(fold(node.value))
    if isinstance(node, Key):
        return Key(fold(node.of), fold(node.key))
    if isinstance(node, Apply):
        to = fold(node.to)
        return Const(FILTERS[node.filter](to.value)) if isinstance(to, Const) else Apply(node.filter, to)
    if isinstance(node, Op):
        parts = tuple(map(fold, node.parts))
        if node.kind in _OPS:
            known = all(isinstance(p, Const) for p in parts)
            return Const(_OPS[node.kind]([p.value for p in parts])) if known else Op(node.kind, parts)
        stop = node.kind == "or"  # the value that decides
        kept = []
        for k, part in enumerate(parts):
            if not isinstance(part, Const) or k == len(parts) - 1:
                kept.append(part)
            elif bool(part.value) == stop:
                kept.append(part)
                break
        return kept[0] if len(kept) == 1 else Op(node.kind, tuple(kept))
    if isinstance(node, For):
        return For(node.name, fold(node.over), fold(node.body))
    if isinstance(node, Generation):
        return Generation(fold(node.body))
    if isinstance(node, If):
        branches = []
        for condition, inner in node.branches:
            condition = fold(condition)
            if isinstance(condition, Const) and not condition.value:
                continue
            branches.append((condition, fold(inner)))
            if isinstance(condition, Const):
                break
        if branches and isinstance(branches[0][0], Const):
            return branches[0][1]
        return If(tuple(branches)) if branches else ()
    return node


# Closures


class _Output:
    def __init__(self):
        self.parts: list[str] = []
        self.length = 0
        self.spans: list[tuple[int, int]] = []

    def add(self, text: str) -> None:
        self.parts.append(text)
        self.length += len(text)


def _value(node) -> Callable[[dict], object]:
    if isinstance(node, Const):
        return lambda env, x=node.value: x
    if isinstance(node, Name):
        return lambda env, n=node.name: env[n]
    if isinstance(node, Key):
        of, key = _value(node.of), _value(node.key)

        def look(env):
            found = of(env)
            if not isinstance(found, dict):
                raise TemplateError("only messages have keys")
            return found[key(env)]

        return look
    if isinstance(node, Apply):
        return lambda env, f=FILTERS[node.filter], to=_value(node.to): f(to(env))
    parts = [_value(p) for p in node.parts]
    if node.kind in ("and", "or"):

        def decide(env, stop=node.kind == "or"):
            for part in parts:
                if bool(found := part(env)) == stop:
                    break
            return found

        return decide
    return lambda env, f=_OPS[node.kind]: f([p(env) for p in parts])


def _writer(node) -> Callable[[dict, _Output], None]:
    if isinstance(node, tuple):
        steps = [_writer(n) for n in node]

        def every(env, out):
            for step in steps:
                step(env, out)

        return every
    if isinstance(node, Emit):
        return lambda env, out, value=_value(node.value): out.add(str(value(env)))
    if isinstance(node, For):
        over, inner, name = _value(node.over), _writer(node.body), node.name

        def loop(env, out):
            for item in over(env):
                inner({**env, name: item}, out)

        return loop
    if isinstance(node, Generation):

        def generated(env, out, inner=_writer(node.body)):
            start = out.length
            inner(env, out)
            out.spans.append((start, out.length))

        return generated
    branches = [(_value(c), _writer(b)) for c, b in node.branches]

    def choose(env, out):
        for condition, inner in branches:
            if condition(env):
                return inner(env, out)

    return choose


@lru_cache(maxsize=16)
def compile_template(template: str) -> Callable[[list[dict]], tuple[str, list[tuple[int, int]]]]:
    """A function from messages to the text and the spans of code points that are generated."""
    write = _writer(fold(parse(template)))

    def render(messages: list[dict]) -> tuple[str, list[tuple[int, int]]]:
        out = _Output()
        write({"messages": messages}, out)
        return "".join(out.parts), out.spans

    return render


def read_back(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn that ``CHAT_TEMPLATE`` wrote."""
    turns = []
    for part in formatted.split(END)[:-1]:
        role, _, text = part.removeprefix(START).partition("\n")
        turns.append((unescape(role), unescape(text)))
    return turns


def format_conversations(
    rows: DataFrame,
    template: str = CHAT_TEMPLATE,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """A row for each conversation: its id, ``formatted``, and ``loss_spans`` (start and end, code points)."""
    compile_template(template)  # a faulty template fails here
    said = F.struct(
        F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    groups = rows.groupBy(F.col(f"`{conversation}`").alias("key")).agg(F.array_sort(F.collect_list(said)).alias("turns"))
    kind = groups.schema["key"].dataType.simpleString()
    schema = f"key {kind}, formatted string, loss_spans array<struct<start: int, end: int>>"

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        render = compile_template(template)
        spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            made = [render(turns) for turns in batch.column(1).to_pylist()]
            marks = [[{"start": a, "end": b} for a, b in m[1]] for m in made]
            columns = [batch.column(0), pa.array([m[0] for m in made], pa.string()), pa.array(marks, spans)]
            yield pa.RecordBatch.from_arrays(columns, ["key", "formatted", "loss_spans"])

    return groups.mapInArrow(run, schema).withColumnRenamed("key", conversation)


def digests(formatted: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """What a reader of the output gets back: turns and text under the loss mask, as digests."""
    kind = formatted.schema[conversation].dataType.simpleString()
    schema = (
        f"key {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            rows = []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                turns = read_back(text)
                said = "".join(f"{role}\n{value}\n" for role, value in turns)
                loss = "".join(unescape(text[s["start"] : s["end"]]) for s in spans)
                digest = [sha256(x.encode()).hexdigest() for x in (said, loss)]
                rows.append((len(turns), digest[0], len(loss), digest[1], len(text)))
            columns = list(zip(*rows)) or [()] * 5
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            arrays = [pa.array(list(c), k) for c, k in zip(columns, kinds)]
            names = ["key", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names)

    chosen = formatted.select(F.col(f"`{conversation}`").alias("key"), "formatted", "loss_spans")
    return chosen.mapInArrow(run, schema).withColumnRenamed("key", conversation)
