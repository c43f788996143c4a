"""Chat formatting by a template compiler.

A small sandboxed template language is parsed into a syntax tree, constants are folded, and the tree is
turned into Python closures that render conversations as chunks of (text, is_generation). The language
has text, ``{{ expression }}``, ``{% for x in y %}``, ``{% if %}/{% elif %}/{% else %}``,
``{% generation %}`` (the loss mask) and, in expressions, strings, integers, true/false/none, names,
``x.key``/``x['key']`` on mappings, ``+ ~ == != and or not in``, and ``|filter``. It has no calls, and a
name reaches only what the caller passes, so a template can't touch Python objects.

Rendering is lazy: messages may be any iterable, and ``loop.last`` looks one message ahead. So a
conversation of any length is formatted, read back and hashed as a stream, in bounded memory.

Control strings inside texts are made harmless by a backslash after their first character (a control
string that already has backslashes there gets one more), which :func:`unguard` takes back.

Defined results: null texts and roles are empty; turns are in the order (turn, role, text), nulls first;
repeated rows are turns of their own; null conversation ids form one conversation; an empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded, shuffle_partitions

TURN, END = "<|turn|>", "<|end|>"
CONTROLS = (TURN, END, "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]")
_TAILS = "|".join(re.escape(c[1:]) for c in CONTROLS if "<" not in c[1:])
GUARD = rf"([<\[])(\\*)({_TAILS}|SYS>>|/SYS>>)"
_GUARD = re.compile(GUARD)
_UNGUARD = re.compile(rf"([<\[])\\(\\*)({_TAILS}|SYS>>|/SYS>>)")

TEMPLATE = (
    "{% for m in messages %}" + TURN + "{{ m.role | line }}\n"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | guard }}{% endgeneration %}"
    "{% else %}{{ m.text | guard }}{% endif %}\n" + END + "\n{% endfor %}"
)


def guard(text: str) -> str:
    """The text with one more backslash after the first character of each control string."""
    return _GUARD.sub(r"\1\\\2\3", text)


def unguard(text: str) -> str:
    return _UNGUARD.sub(r"\1\2\3", text)


def line(text: str) -> str:
    """A guarded text on one line."""
    return guard(text).replace("\\", "\\\\").replace("\n", "\\n")


def unline(text: str) -> str:
    return unguard(re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text))


FILTERS: dict[str, Callable[[Any], Any]] = {
    "guard": guard, "line": line, "trim": lambda x: x.strip(), "upper": lambda x: x.upper(), "lower": lambda x: x.lower(), "length": len,
}


class TemplateError(ValueError):
    pass


# -- parsing --
_PART = re.compile(r"\{\{(.*?)\}\}|\{%-?(.*?)-?%\}|\{#.*?#\}", re.S)
_TOKEN = re.compile(r"\s*(?:('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(\d+)|([A-Za-z_]\w*)|(==|!=|[+~|.()\[\]]))")
_ESCAPES = {"n": "\n", "t": "\t", "\\": "\\", "'": "'", '"': '"'}


class _Expressions:
    """Recursive descent; nodes are tuples: ("const", v), ("name", n), ("get", e, e), ("op", o, e, e), ..."""

    def __init__(self, source: str):
        self.tokens: list[tuple[str, str]] = []
        at = 0
        source = source.strip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"can't read {source[at:]!r}")
            kind = ("string", "int", "name", "op")[m.lastindex - 1]
            self.tokens.append((kind, m[m.lastindex]))
            at = m.end()
        self.at = 0

    def peek(self) -> tuple[str, str]:
        return self.tokens[self.at] if self.at < len(self.tokens) else ("end", "")

    def take(self, value: str | None = None) -> tuple[str, str]:
        token = self.peek()
        if value is not None and token[1] != value or token[0] == "end":
            raise TemplateError(f"expected {value or 'more'}, found {token[1]!r}")
        self.at += 1
        return token

    def whole(self) -> tuple:
        node = self.either()
        if self.peek()[0] != "end":
            raise TemplateError(f"unexpected {self.peek()[1]!r}")
        return node

    def chain(self, words: tuple[str, ...], deeper: Callable[[], tuple]) -> tuple:
        node = deeper()
        while self.peek()[0] in ("op", "name") and self.peek()[1] in words:
            node = ("op", self.take()[1], node, deeper())
        return node

    def either(self) -> tuple:
        return self.chain(("or",), self.both)

    def both(self) -> tuple:
        return self.chain(("and",), self.negation)

    def negation(self) -> tuple:
        if self.peek() == ("name", "not"):
            self.take()
            return ("not", self.negation())
        return self.chain(("==", "!=", "in"), self.sum)

    def sum(self) -> tuple:
        return self.chain(("+", "~"), self.piped)

    def piped(self) -> tuple:
        node = self.atom()
        while True:
            if self.peek() == ("op", "|"):
                self.take()
                name = self.take()[1]
                if name not in FILTERS:
                    raise TemplateError(f"no filter {name!r}")
                node = ("filter", name, node)
            elif self.peek() == ("op", "."):
                self.take()
                kind, name = self.take()
                if kind != "name" or name.startswith("_"):
                    raise TemplateError(f"no attribute {name!r}")
                node = ("get", node, ("const", name))
            elif self.peek() == ("op", "["):
                self.take()
                node = ("get", node, self.either())
                self.take("]")
            else:
                return node

    def atom(self) -> tuple:
        kind, value = self.take()
        if kind == "string":
            return ("const", re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), value[1:-1]))
        if kind == "int":
            return ("const", int(value))
        if value == "(":
            node = self.either()
            self.take(")")
            return node
        if kind == "name":
            low = value.lower()
            if low in ("true", "false", "none"):
                return ("const", {"true": True, "false": False, "none": None}[low])
            if value.startswith("_"):
                raise TemplateError(f"no name {value!r}")
            return ("name", value)
        raise TemplateError(f"unexpected {value!r}")


def parse(source: str) -> tuple:
    """The syntax tree: ("block", [nodes])."""
    parts: list[tuple[str, str]] = []
    at = 0
    for m in _PART.finditer(source):
        if m.start() > at:
            parts.append(("text", source[at : m.start()]))
        if m[1] is not None:
            parts.append(("expr", m[1]))
        elif m[2] is not None:
            parts.append(("tag", m[2].strip()))
        at = m.end()
    if at < len(source):
        parts.append(("text", source[at:]))
    position = 0

    def block(*ends: str) -> tuple[tuple, str]:
        nonlocal position
        nodes: list[tuple] = []
        while position < len(parts):
            kind, value = parts[position]
            position += 1
            if kind == "text":
                nodes.append(("out", ("const", value)))
            elif kind == "expr":
                nodes.append(("out", _Expressions(value).whole()))
            else:
                word = value.split()[0] if value else ""
                if word in ends:
                    return ("block", nodes), value
                if word == "for":
                    m = re.fullmatch(r"for\s+([A-Za-z]\w*)\s+in\s+(.+)", value, re.S)
                    if not m:
                        raise TemplateError(value)
                    body, _ = block("endfor")
                    nodes.append(("for", m[1], _Expressions(m[2]).whole(), body))
                elif word == "if":
                    arms, condition = [], value[2:]
                    while True:
                        body, end = block("elif", "else", "endif")
                        arms.append((_Expressions(condition).whole() if condition else ("const", True), body))
                        if end == "endif":
                            break
                        condition = end[4:] if end.startswith("elif") else ""
                    nodes.append(("if", arms))
                elif word == "generation":
                    body, _ = block("endgeneration")
                    nodes.append(("generation", body))
                else:
                    raise TemplateError(f"unknown tag {value!r}")
        if ends:
            raise TemplateError(f"missing {ends[-1]}")
        return ("block", nodes), ""

    return block()[0]


# -- folding --
_OPS: dict[str, Callable[[Any, Any], Any]] = {
    "+": lambda a, b: a + b, "~": lambda a, b: _text(a) + _text(b), "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "in": lambda a, b: a in b,
}


def _text(x: Any) -> str:
    return "" if x is None else str(x)


def fold(node: tuple) -> tuple:
    """The tree with constant expressions evaluated, dead branches dropped and adjacent text joined."""
    kind = node[0]
    if kind in ("const", "name"):
        return node
    if kind == "get":
        return ("get", fold(node[1]), fold(node[2]))
    if kind == "filter":
        inner = fold(node[2])
        return ("const", FILTERS[node[1]](inner[1])) if inner[0] == "const" else ("filter", node[1], inner)
    if kind == "not":
        inner = fold(node[1])
        return ("const", not inner[1]) if inner[0] == "const" else ("not", inner)
    if kind == "op":
        a, b = fold(node[2]), fold(node[3])
        if a[0] == "const" and node[1] in ("and", "or"):
            return (b if a[1] else a) if node[1] == "and" else (a if a[1] else b)
        if a[0] == b[0] == "const" and node[1] in _OPS:
            return ("const", _OPS[node[1]](a[1], b[1]))
        return ("op", node[1], a, b)
    if kind == "out":
        return ("out", fold(node[1]))
    if kind == "for":
        return ("for", node[1], fold(node[2]), fold(node[3]))
    if kind == "generation":
        return ("generation", fold(node[1]))
    if kind == "if":
        arms = []
        for condition, body in node[1]:
            condition, body = fold(condition), fold(body)
            if condition[0] == "const" and not condition[1]:
                continue
            arms.append((condition, body))
            if condition[0] == "const":
                break
        if arms and arms[0][0][0] == "const":
            return arms[0][1]
        return ("if", arms) if arms else ("block", [])
    nodes: list[tuple] = []
    for child in (fold(x) for x in node[1]):
        for x in child[1] if child[0] == "block" else [child]:
            if x[0] == "out" and x[1][0] == "const":
                text = _text(x[1][1])
                if nodes and nodes[-1][0] == "out" and nodes[-1][1][0] == "const":
                    nodes[-1] = ("out", ("const", nodes[-1][1][1] + text))
                    continue
                x = ("out", ("const", text))
                if not text:
                    continue
            nodes.append(x)
    return ("block", nodes)


# -- closures --
Chunk = tuple[str, bool]


def _expression(node: tuple) -> Callable[[dict], Any]:
    kind = node[0]
    if kind == "const":
        value = node[1]
        return lambda env: value
    if kind == "name":
        name = node[1]
        return lambda env: env.get(name)
    if kind == "get":
        of, key = _expression(node[1]), _expression(node[2])

        def get(env: dict) -> Any:
            x, k = of(env), key(env)
            return x.get(k) if isinstance(x, dict) else x[k] if isinstance(x, (list, tuple, str)) and isinstance(k, int) else None

        return get
    if kind == "filter":
        inner, function = _expression(node[2]), FILTERS[node[1]]
        return lambda env: function(inner(env))
    if kind == "not":
        inner = _expression(node[1])
        return lambda env: not inner(env)
    a, b = _expression(node[2]), _expression(node[3])
    if node[1] == "and":
        return lambda env: a(env) and b(env)
    if node[1] == "or":
        return lambda env: a(env) or b(env)
    operator = _OPS[node[1]]
    return lambda env: operator(a(env), b(env))


def _looped(items: Iterable) -> Iterator[tuple[Any, dict]]:
    i, items = 0, iter(items)
    try:
        now = next(items)
    except StopIteration:
        return
    for following in items:
        yield now, {"index0": i, "index": i + 1, "first": i == 0, "last": False}
        now, i = following, i + 1
    yield now, {"index0": i, "index": i + 1, "first": i == 0, "last": True}


def _statement(node: tuple) -> Callable[[dict, bool], Iterator[Chunk]]:
    kind = node[0]
    if kind == "block":
        parts = [_statement(x) for x in node[1]]

        def block(env: dict, masked: bool) -> Iterator[Chunk]:
            for part in parts:
                yield from part(env, masked)

        return block
    if kind == "out":
        value = _expression(node[1])

        def out(env: dict, masked: bool) -> Iterator[Chunk]:
            yield _text(value(env)), masked

        return out
    if kind == "generation":
        body = _statement(node[1])
        return lambda env, masked: body(env, True)
    if kind == "for":
        name, items, body = node[1], _expression(node[2]), _statement(node[3])

        def loop(env: dict, masked: bool) -> Iterator[Chunk]:
            for item, about in _looped(items(env) or ()):
                yield from body({**env, name: item, "loop": about}, masked)

        return loop
    arms = [(_expression(c), _statement(b)) for c, b in node[1]]

    def branch(env: dict, masked: bool) -> Iterator[Chunk]:
        for condition, body in arms:
            if condition(env):
                yield from body(env, masked)
                return

    return branch


class Template:
    """A compiled template; ``render`` gives chunks of (text, is_generation)."""

    def __init__(self, source: str = TEMPLATE):
        self.tree = fold(parse(source))
        self._run = _statement(self.tree)

    def render(self, messages: Iterable[dict[str, str]], **names: Any) -> Iterator[Chunk]:
        return self._run({**names, "messages": messages}, False)


# -- the output, and reading it back --
def output(chunks: Iterable[Chunk], size: int = 1 << 16) -> Iterator[tuple[str, list[tuple[int, int]]]]:
    """The formatted string in pieces of about ``size``, each with the spans of the loss mask in it, counted from the string's start."""
    at = held = 0
    texts: list[str] = []
    spans: list[tuple[int, int]] = []
    for text, masked in chunks:
        if masked and text:
            if spans and spans[-1][1] == at:
                spans[-1] = (spans[-1][0], at + len(text))
            else:
                spans.append((at, at + len(text)))
        at += len(text)
        held += len(text)
        texts.append(text)
        if held >= size:
            yield "".join(texts), spans
            texts, spans, held = [], [], 0
    if texts:
        yield "".join(texts), spans


def read_output(pieces: Iterable[tuple[str, list[tuple[int, int]]]]) -> Iterator[tuple[str, str, str, int]]:
    """(role, text, text under the loss mask, characters) of each turn, from the formatted string and its spans alone."""
    held, base, spans = "", 0, []  # what isn't read yet, where it starts in the whole string, its spans
    for text, marked in pieces:
        seen = max(0, len(held) - len(END))
        held += text
        spans += marked
        start = 0
        while (mark := held.find(END, max(start, seen))) >= 0 and mark + len(END) < len(held):  # a guarded text never has it
            stop = mark + len(END) + 1
            if not held.startswith(TURN, start) or held[stop - 1] != "\n":
                raise ValueError("malformed output")
            role, _, body = held[start + len(TURN) : mark].partition("\n")
            loss = []
            while spans and spans[0][0] < base + stop:
                first, last = spans[0]
                loss.append(held[first - base : min(last - base, stop)])
                if last > base + stop:
                    spans[0] = (base + stop, last)
                    break
                spans.pop(0)
            yield unline(role), unguard(body[:-1]), unguard("".join(loss)), stop - start
            start = stop
        held, base = held[start:], base + start
    if held:
        raise ValueError("output ends within a turn")


def read_formatted(formatted: str, loss: Iterable[tuple[int, int]]) -> Iterator[tuple[str, str, str, int]]:
    """The turns of a row of :func:`format_conversations`."""
    return read_output([(formatted, [tuple(x) for x in loss])])


def read_turns(chunks: Iterable[Chunk]) -> Iterator[tuple[str, str, str, int]]:
    """The turns of what a template renders, read back from its output."""
    return read_output(output(chunks))


def digest(messages: Iterable[dict[str, str]], template: Template) -> tuple[int, str, int, str, int]:
    """n_turns, turns_sha256, loss_chars, loss_sha256 and formatted_chars, read back from the output."""
    n = loss_chars = chars = 0
    turns, loss = hashlib.sha256(), hashlib.sha256()
    for role, text, under, size in read_turns(template.render(messages)):
        n += 1
        turns.update(f"{role}\n{text}\n".encode())
        loss.update(under.encode())
        loss_chars += len(under)
        chars += size
    return n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Any, Iterator[dict[str, str]]]]:
    """Conversations of sorted rows (conv_id, role, text), each as a stream of messages."""
    rows = (
        r for batch in batches for part in bounded(batch)
        for r in zip(*(part.column(i).to_pylist() for i in range(3)))
    )
    row = next(rows, None)
    while row is not None:
        conv = row[0]

        def messages() -> Iterator[dict[str, str]]:
            nonlocal row
            while row is not None and row[0] == conv:
                yield {"role": row[1] or "", "text": row[2] or ""}
                row = next(rows, None)

        stream = messages()
        yield conv, stream
        for _ in stream:  # whatever the consumer left
            pass


def _sorted(conversations: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    rows = conversations.select(F.col(conv).alias("conv_id"), F.col(role).alias("role"), F.col(text).alias("text"), F.col(turn).alias("turn"))
    n = shuffle_partitions(conversations.sparkSession)
    return rows.repartition(n, "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")


def format_conversations(
    conversations: DataFrame, template: str = TEMPLATE, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """conv_id, the formatted text and the spans (start, end) of its loss mask, one row a conversation."""
    kind = conversations.schema[conv].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = Template(template)
        for conv_id, messages in _conversations(batches):
            texts, spans = [], []
            for piece, marked in output(compiled.render(messages)):
                texts.append(piece)
                if spans and marked and spans[-1]["end"] == marked[0][0]:
                    spans[-1]["end"] = marked.pop(0)[1]
                spans += [{"start": a, "end": b} for a, b in marked]
            yield pa.RecordBatch.from_pylist([{"conv_id": conv_id, "formatted": "".join(texts), "loss": spans}], schema)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    out = f"conv_id {kind}, formatted string, loss array<struct<start:long,end:long>>"
    schema = to_arrow_schema(_parse_datatype_string(out))
    return _sorted(conversations, conv, turn, role, text).mapInArrow(run, out)


def digests(
    conversations: DataFrame, template: str = TEMPLATE, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """The digest row of each conversation, streamed: no conversation is held as a whole."""
    kind = conversations.schema[conv].dataType.simpleString()
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = Template(template)
        rows: list[tuple] = []
        for conv_id, messages in _conversations(batches):
            rows.append((conv_id, *digest(messages, compiled)))
            if len(rows) == 1000:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names)

    out = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return _sorted(conversations, conv, turn, role, text).mapInArrow(run, out)
