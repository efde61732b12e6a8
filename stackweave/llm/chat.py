"""Chat formatting by compiled templates, with generation markers and reversible escapes.

A template is parsed into a syntax tree, constants are folded, and the tree becomes nested
Python closures. The language is a sandbox: text, ``{{ expression }}``, ``{# comment #}``, and the
statements for / endfor, if / elif / else / endif, set, and generation / endgeneration, which mark
what a model is trained on. Expressions know literals, names, look-ups of keys and places, ``loop``
(first, last, index, index0), and, or, not, comparisons, in, ``a if c else b``, + - * % of numbers,
~ and + of texts, and a fixed list of filters. There are no calls, no attributes of objects, and
nothing that could grow without end. What is not defined is none; none is written as nothing.

The filter ``escape`` takes control strings out of texts: a backslash is doubled, and after the
first character of every control string a backslash is put in. Nothing else changes, so texts come
back exactly, and a control string in the output is always one that the template wrote.

Conversations are shuffled once, and a task streams its sorted rows through the template. The
output is laid down in pieces of about ``PIECE`` characters, cut between turns, with the spans of
generated text in characters of the piece; so a conversation of any length passes in bounded
memory. As its digests are sequential hashes, one conversation is not split over tasks.

Rows are ordered by turn (nulls first), role and text. Defined cases: a null role or text is
empty. The null conv_id is a conversation of its own; repeated rows are turns of their own. Columns
other than the four take no part. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator, Mapping
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stackweave import session

CONTROLS = ("[INST]", "[/INST]", "<s>", "</s>", "<|", "|>")
TEMPLATE = """
{%- for m in messages -%}
  {%- if m.role == 'user' -%} {{ '[INST] ' ~ (m.text | escape) ~ ' [/INST]' }}
  {%- elif m.role == 'assistant' -%} {% generation %}{{ m.text | escape }}{% endgeneration %}{{ '</s>' }}
  {%- else -%} {{ '<|' ~ (m.role | escape) ~ '|>' ~ (m.text | escape) ~ '<|end|>' }}
  {%- endif -%}
{%- endfor -%}
"""
PIECE = 1 << 20
DEEPEST = 50


class TemplateError(ValueError):
    """A template that the language does not allow, or a value that an operation cannot take."""


# Syntax tree

_PARTS = re.compile(r"\{#.*?#\}|\{\{.*?\}\}|\{%.*?%\}", re.DOTALL)
_TOKENS = re.compile(r"""\s*(?:(\d+)|('(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|([A-Za-z_]\w*)|(==|!=|<=|>=|[-+*%~|.,()\[\]<>=]))""", re.DOTALL)
_ESCAPED = {"n": "\n", "t": "\t", "r": "\r"}
_WORDS = {"true": True, "false": False, "none": None, "True": True, "False": False, "None": None}
_RESERVED = {"and", "or", "not", "in", "if", "else", "is"}


def _tokens(text: str) -> list[tuple[str, object]]:
    out, at = [], 0
    text = text.strip()
    while at < len(text):
        found = _TOKENS.match(text, at)
        if not found:
            raise TemplateError(f"not understood: {text[at:at + 20]!r}")
        number, quoted, name, sign = found.groups()
        if number:
            out.append(("value", int(number)))
        elif quoted:
            out.append(("value", re.sub(r"\\(.)", lambda m: _ESCAPED.get(m[1], m[1]), quoted[1:-1], flags=re.DOTALL)))
        elif name:
            out.append(("value", _WORDS[name]) if name in _WORDS else ("word" if name in _RESERVED else "name", name))
        else:
            out.append(("sign", sign))
        at = found.end()
    return out


class _Expression:
    """Parser of one expression; nodes are tuples that start with their kind."""

    # Operators of one line bind alike; later lines bind tighter.
    LEVELS = (("or",), ("and",), ("==", "!=", "<", ">", "<=", ">=", "in"), ("~",), ("+", "-"), ("*", "%"))

    def __init__(self, text: str):
        self.text, self.tokens, self.at, self.depth = text, _tokens(text), 0, 0

    def whole(self) -> tuple:
        node = self.choice()
        if self.at < len(self.tokens):
            raise TemplateError(f"too much in {self.text!r}")
        return node

    def take(self, *wanted: str) -> str | None:
        if self.at < len(self.tokens):
            kind, value = self.tokens[self.at]
            if kind in ("sign", "word") and value in wanted:
                self.at += 1
                return value
        return None

    def need(self, wanted: str) -> None:
        if not self.take(wanted):
            raise TemplateError(f"{wanted!r} is missing in {self.text!r}")

    def name(self) -> str:
        if self.at < len(self.tokens) and self.tokens[self.at][0] == "name":
            self.at += 1
            return self.tokens[self.at - 1][1]
        raise TemplateError(f"a name is missing in {self.text!r}")

    def choice(self) -> tuple:
        self.depth += 1
        if self.depth > DEEPEST:
            raise TemplateError("nested too deeply")
        node = self.level(0)
        if self.take("if"):
            test = self.level(0)
            other = self.choice() if self.take("else") else ("value", None)
            node = ("choice", test, node, other)
        self.depth -= 1
        return node

    def level(self, number: int) -> tuple:
        if number == len(self.LEVELS):
            return self.unary()
        if number == 2 and self.take("not"):
            return ("not", self.level(2))
        node = self.level(number + 1)
        while True:
            sign = self.take(*self.LEVELS[number])
            if not sign and number == 2 and self.tokens[self.at : self.at + 2] == [("word", "not"), ("word", "in")]:
                self.at += 2
                node = ("not", ("in", node, self.level(number + 1)))
            elif sign:
                node = (sign, node, self.level(number + 1))
            else:
                return node

    def unary(self) -> tuple:
        if self.take("-"):
            return ("-", ("value", 0), self.unary())
        node = self.primary()
        while True:
            if self.take("."):
                node = ("get", node, ("value", self.name()))
            elif self.take("["):
                node = ("get", node, self.choice())
                self.need("]")
            elif self.take("|"):
                name, arguments = self.name(), []
                if name not in FILTERS:
                    raise TemplateError(f"there is no filter {name!r}")
                if self.take("("):
                    while not self.take(")"):
                        arguments.append(self.choice())
                        if not self.take(","):
                            self.need(")")
                            break
                if len(arguments) > FILTERS[name][1]:
                    raise TemplateError(f"too many arguments of {name!r}")
                node = ("filter", name, node, *arguments)
            else:
                return node

    def primary(self) -> tuple:
        if self.take("("):
            node = self.choice()
            self.need(")")
            return node
        kind, value = self.tokens[self.at] if self.at < len(self.tokens) else ("end", None)
        if kind not in ("value", "name"):
            raise TemplateError(f"a value is missing in {self.text!r}")
        self.at += 1
        return (kind, value)


def parse(source: str) -> tuple:
    """Template text -> its syntax tree, a block of statements."""
    # (opening word, what it says, its branches so far); a branch is (its word, what it says, nodes)
    stack: list[list] = [["block", "", [("block", "", [])]]]
    at, strip = 0, False
    for found in [*_PARTS.finditer(source), None]:
        text = source[at : found.start() if found else len(source)]
        at = found.end() if found else at
        text = text.lstrip() if strip else text
        mark = found[0] if found else ""
        if mark[2:3] == "-":
            text = text.rstrip()
        strip = mark[-3:-2] == "-" and len(mark) > 4
        nodes = stack[-1][2][-1][2]
        if text:
            nodes.append(("text", text))
        if not mark or mark.startswith("{#"):
            continue
        inside = mark[2:-2].removeprefix("-").removesuffix("-").strip()
        if mark.startswith("{{"):
            nodes.append(("write", _Expression(inside).whole()))
            continue
        word, _, said = inside.partition(" ")
        if word in ("for", "if", "generation"):
            if len(stack) > DEEPEST:
                raise TemplateError("nested too deeply")
            stack.append([word, said, [(word, said, [])]])
        elif word in ("elif", "else") and stack[-1][0] == "if" and stack[-1][2][-1][0] != "else":
            stack[-1][2].append((word, said, []))
        elif word.startswith("end") and len(stack) > 1 and word[3:] == stack[-1][0]:
            closed = stack.pop()
            stack[-1][2][-1][2].append(_statement(closed))
        elif word == "set":
            name, _, value = said.partition("=")
            if not name.strip().isidentifier():
                raise TemplateError(f"not understood: {inside!r}")
            nodes.append(("set", name.strip(), _Expression(value).whole()))
        else:
            raise TemplateError(f"not understood: {inside!r}")
    if len(stack) > 1:
        raise TemplateError(f"{stack[-1][0]!r} has no end")
    return ("block", *stack[0][2][0][2])


def _statement(closed: list) -> tuple:
    word, said, branches = closed
    if word == "for":
        found = re.fullmatch(r"(\w+)\s+in\s+(.+)", said, re.DOTALL)
        if not found or not found[1].isidentifier():
            raise TemplateError(f"not understood: for {said!r}")
        return ("for", found[1], _Expression(found[2]).whole(), ("block", *branches[0][2]))
    if word == "generation":
        return ("generation", ("block", *branches[0][2]))
    # Chains become nested choices between two blocks.
    node: tuple = ("block",)
    for kind, test, nodes in reversed(branches):
        node = ("block", *nodes) if kind == "else" else ("block", ("when", _Expression(test).whole(), ("block", *nodes), node))
    return node[1]


# Values

def _text(value: object) -> str:
    if value is None:
        return ""
    if isinstance(value, bool) or not isinstance(value, str | int | float):
        if isinstance(value, bool):
            return "true" if value else "false"
        raise TemplateError(f"{type(value).__name__} cannot be written")
    return str(value)


def _numbers(work: Callable) -> Callable:
    def checked(a: object, b: object) -> object:
        if not all(isinstance(x, int | float) and abs(x) < 1 << 60 for x in (a, b)):
            raise TemplateError("a number below 2**60 is needed")
        return work(a, b)

    return checked


def _plus(a: object, b: object) -> object:
    return a + b if isinstance(a, str) and isinstance(b, str) else _numbers(lambda x, y: x + y)(a, b)


def _ordered(work: Callable) -> Callable:
    def checked(a: object, b: object) -> bool:
        if isinstance(a, str) != isinstance(b, str) or not isinstance(a, str | int | float) or not isinstance(b, str | int | float):
            raise TemplateError("values of two kinds have no order")
        return work(a, b)

    return checked


def _get(value: object, key: object) -> object:
    """A key of a mapping or a place of a list or text; nothing else can be reached."""
    if isinstance(value, Mapping):
        return value.get(key)
    if isinstance(value, list | str) and isinstance(key, int):
        return value[key] if -len(value) <= key < len(value) else None
    return None


def _inside(a: object, b: object) -> bool:
    if isinstance(b, str):
        return isinstance(a, str) and a in b
    return a in b if isinstance(b, list | Mapping) else False


_BINARY = {
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "<": _ordered(lambda a, b: a < b), ">": _ordered(lambda a, b: a > b),
    "<=": _ordered(lambda a, b: a <= b), ">=": _ordered(lambda a, b: a >= b), "in": _inside, "~": lambda a, b: _text(a) + _text(b),
    "+": _plus, "-": _numbers(lambda a, b: a - b), "*": _numbers(lambda a, b: a * b),
    "%": _numbers(lambda a, b: a % b if b else None),
}
# name: (what it does, how many arguments at most); escape depends on the control strings.
FILTERS = {
    "escape": (None, 0), "trim": (lambda x: _text(x).strip(), 0), "upper": (lambda x: _text(x).upper(), 0), "lower": (lambda x: _text(x).lower(), 0),
    "length": (lambda x: len(x) if isinstance(x, str | list | Mapping) else 0, 0),
    "default": (lambda x, other="": other if x is None else x, 1), "replace": (lambda x, old="", new="": _text(x).replace(old, new) if old else _text(x), 2),
}


def escaper(controls: Iterable[str] = CONTROLS) -> Callable[[str], str]:
    """A function that takes control strings out of a text."""
    controls = list(controls)
    if any("\\" in c or len(c) < 2 for c in controls):
        raise TemplateError("control strings have two characters or more and no backslash")
    found = re.compile("|".join([r"\\", *(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in controls)]))
    return lambda text: found.sub(lambda m: m[0] + "\\", text)


_HIDDEN = re.compile(r"\\(.)", re.DOTALL)


def unescaped(text: str) -> str:
    return _HIDDEN.sub(r"\1", text) if "\\" in text else text


# Folding

def fold(node: tuple, escape: Callable[[str], str]) -> tuple:
    """The same tree with everything computed that no variable can change."""
    kind = node[0]
    if kind in ("text", "value", "name"):
        return node
    if kind == "set" or kind == "for":
        return (*node[:2], *(fold(child, escape) for child in node[2:]))
    if kind == "filter":
        parts = [fold(child, escape) for child in node[2:]]
        if all(part[0] == "value" for part in parts):
            return ("value", _filter(node[1], escape)(*(part[1] for part in parts)))
        return ("filter", node[1], *parts)
    parts = [fold(child, escape) for child in node[1:]]
    known = [part[0] == "value" for part in parts]
    if kind == "block":
        return ("block", *_joined(parts))
    if kind == "write" and known[0]:
        return ("text", _text(parts[0][1]))
    if kind in ("choice", "when") and known[0]:
        return parts[1] if parts[0][1] else parts[2]
    if kind == "not" and known[0]:
        return ("value", not parts[0][1])
    if kind in ("and", "or") and known[0]:
        return parts[1] if bool(parts[0][1]) == (kind == "and") else parts[0]
    if kind == "get" and all(known):
        return ("value", _get(parts[0][1], parts[1][1]))
    if kind in _BINARY and all(known):
        return ("value", _BINARY[kind](parts[0][1], parts[1][1]))
    return (kind, *parts)


def _joined(nodes: list[tuple]) -> list[tuple]:
    """Blocks in blocks opened, texts next to each other in one; a set stays within its block."""
    flat = []
    for node in nodes:
        opened = node[0] == "block" and not any(child[0] == "set" for child in node[1:])
        flat += node[1:] if opened else [node]
    out = []
    for is_text, group in groupby(flat, key=lambda node: node[0] == "text"):
        texts = list(group)
        text = "".join(node[1] for node in texts) if is_text else ""
        out += ([("text", text)] if text else []) if is_text else texts
    return out


def _filter(name: str, escape: Callable[[str], str]) -> Callable:
    return (lambda x: escape(_text(x))) if name == "escape" else FILTERS[name][0]


# Closures

class Output:
    """What a template has written: text and the spans of generated text."""

    def __init__(self) -> None:
        self.parts: list[str] = []
        self.size, self.starts, self.ends = 0, [], []

    def write(self, text: str) -> None:
        self.parts.append(text)
        self.size += len(text)

    def cut(self) -> tuple[str, list[int], list[int]]:
        """The piece so far; the next one starts from nothing."""
        piece = ("".join(self.parts), self.starts, self.ends)
        self.__init__()
        return piece


Value = Callable[[dict], object]
Step = Callable[[dict, Output], None]


def _value(node: tuple, escape: Callable[[str], str]) -> Value:
    kind = node[0]
    if kind == "value":
        constant = node[1]
        return lambda scope: constant
    if kind == "name":
        name = node[1]
        return lambda scope: scope.get(name)
    if kind == "filter":
        work, parts = _filter(node[1], escape), [_value(child, escape) for child in node[2:]]
        if len(parts) == 1:
            only = parts[0]
            return lambda scope: work(only(scope))
        return lambda scope: work(*(part(scope) for part in parts))
    parts = [_value(child, escape) for child in node[1:]]
    first, second = parts[0], parts[-1]
    if kind == "not":
        return lambda scope: not first(scope)
    if kind == "and":
        return lambda scope: first(scope) and second(scope)
    if kind == "or":
        return lambda scope: first(scope) or second(scope)
    if kind == "choice":
        then = parts[1]
        return lambda scope: then(scope) if first(scope) else second(scope)
    work = _get if kind == "get" else _BINARY[kind]
    return lambda scope: work(first(scope), second(scope))


def _step(node: tuple, escape: Callable[[str], str]) -> Step:
    kind = node[0]
    if kind == "text":
        text = node[1]
        return lambda scope, out: out.write(text)
    if kind == "write":
        value = _value(node[1], escape)
        return lambda scope, out: out.write(_text(value(scope)))
    if kind == "set":
        name, value = node[1], _value(node[2], escape)
        return lambda scope, out: scope.__setitem__(name, value(scope))
    if kind == "when":
        test, then, other = _value(node[1], escape), _step(node[2], escape), _step(node[3], escape)
        return lambda scope, out: then(scope, out) if test(scope) else other(scope, out)
    if kind == "generation":
        body = _step(node[1], escape)

        def generation(scope: dict, out: Output) -> None:
            out.starts.append(out.size)
            body(scope, out)
            out.ends.append(out.size)

        return generation
    if kind == "for":
        turns = _loop(node, escape)

        def loop(scope: dict, out: Output) -> None:
            for _ in turns(scope, out):
                pass

        return loop
    steps = [_step(child, escape) for child in node[1:]]
    scoped = any(child[0] == "set" for child in node[1:])

    def block(scope: dict, out: Output) -> None:
        scope = dict(scope) if scoped else scope
        for step in steps:
            step(scope, out)

    return steps[0] if len(steps) == 1 and not scoped else block


def _loop(node: tuple, escape: Callable[[str], str]) -> Callable[[dict, Output], Iterator[None]]:
    """A loop that hands back control after every turn."""
    name, items, body = node[1], _value(node[2], escape), _step(node[3], escape)

    def loop(scope: dict, out: Output) -> Iterator[None]:
        found = items(scope)
        if isinstance(found, str | Mapping):
            raise TemplateError("a loop needs a list")
        left, index = iter(found or ()), 0
        item = next(left, _END)
        while item is not _END:
            following = next(left, _END)
            about = {"index": index + 1, "index0": index, "first": index == 0, "last": following is _END}
            body({**scope, name: item, "loop": about}, out)
            yield
            item, index = following, index + 1

    return loop


_END = object()


class Template:
    """A compiled template."""

    def __init__(self, source: str = TEMPLATE, controls: Iterable[str] = CONTROLS):
        escape = escaper(controls)
        self.tree = fold(parse(source), escape)
        if any(_holds(node[-1], "generation") for node in _all(self.tree) if node[0] == "generation"):
            raise TemplateError("generated text is marked once")
        self.steps = [(_loop(node, escape), True) if node[0] == "for" else (_step(node, escape), False) for node in self.tree[1:]]

    def pieces(self, messages: Iterable[Mapping], size: int = PIECE, **variables: object) -> Iterator[tuple[str, list[int], list[int]]]:
        """(text, starts, ends of generated text) in pieces of about ``size``; a loop on the top level
        takes its messages one by one."""
        scope, out, count = {**variables, "messages": messages}, Output(), 0
        for step, is_loop in self.steps:
            for _ in step(scope, out) if is_loop else (step(scope, out),):
                if out.size >= size:
                    yield out.cut()
                    count += 1
        if out.size or not count:
            yield out.cut()

    def render(self, messages: list[Mapping], **variables: object) -> tuple[str, list[int], list[int]]:
        out = Output()
        scope = {**variables, "messages": messages}
        for step, is_loop in self.steps:
            for _ in step(scope, out) if is_loop else (step(scope, out),):
                pass
        return out.cut()


def _all(node: tuple) -> Iterator[tuple]:
    yield node
    for child in node[1:]:
        if isinstance(child, tuple):
            yield from _all(child)


def _holds(node: tuple, kind: str) -> bool:
    return any(found[0] == kind for found in _all(node))


# Formatting and reading back

def turns_of(text: str) -> Iterator[tuple[str, str]]:
    """(role, text) of every turn in what the standard template wrote."""
    at = 0
    while at < len(text):
        if text.startswith("[INST] ", at):
            end = text.index(" [/INST]", at + 7)
            role, said, at = "user", text[at + 7 : end], end + 8
        elif text.startswith("<|", at):
            middle = text.index("|>", at + 2)
            end = text.index("<|end|>", middle + 2)
            role, said, at = unescaped(text[at + 2 : middle]), text[middle + 2 : end], end + 7
        else:
            end = text.index("</s>", at)
            role, said, at = "assistant", text[at:end], end + 4
        yield role, unescaped(said)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


def formatted(rows: DataFrame, source: str = TEMPLATE, controls: Iterable[str] = CONTROLS, size: int = PIECE) -> DataFrame:
    """conv_id, turn, role, text -> conv_id, piece, text, starts, ends; the pieces of a conversation
    follow each other in their partition. Messages come to the template one by one: it can loop over
    them once, and knows neither their number nor one by its place."""
    session.prepare(rows.sparkSession)
    Template(source, controls)  # errors of the template show here
    controls = tuple(controls)
    empty = lambda name: F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)
    turns = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), empty("role"), empty("text"))
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text"]
    streamed = turns.repartition("conv_id").sortWithinPartitions(*order)
    names = ["conv_id", "piece", "text", "starts", "ends"]

    def form(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template, out, held = Template(source, controls), [], 0
        for conv_id, turns in groupby(_rows(batches), key=lambda row: row[0]):
            messages = ({"turn": turn, "role": role, "text": text} for _, turn, role, text in turns)
            for number, (text, starts, ends) in enumerate(template.pieces(messages, size)):
                out.append((conv_id, number, text, starts, ends))
                held += len(text)
                if held > PIECE or len(out) >= 1000:
                    yield _pieces(out, names)
                    out, held = [], 0
        if out:
            yield _pieces(out, names)

    return streamed.mapInArrow(form, "conv_id long, piece long, text string, starts array<long>, ends array<long>")


def _pieces(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64())]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def read_back(pieces: DataFrame, in_place: bool = False) -> DataFrame:
    """What ``formatted`` gave by the standard template -> its turns and loss text as digests.

    ``in_place`` reads pieces that still lie as ``formatted`` laid them, without a shuffle.
    """
    if not in_place:
        pieces = pieces.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "piece")
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    names = [field.split()[0] for field in schema.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for conv_id, mine in groupby(_rows(batches), key=lambda row: row[0]):
            turns, loss = hashlib.sha256(), hashlib.sha256()
            n_turns = loss_chars = chars = 0
            for _, text, starts, ends in mine:
                chars += len(text)
                for role, said in turns_of(text):
                    n_turns += 1
                    turns.update(f"{role}\n{said}\n".encode())
                for start, end in zip(starts, ends, strict=True):
                    said = unescaped(text[start:end])
                    loss_chars += len(said)
                    loss.update(said.encode())
            out.append((conv_id, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
            if len(out) >= 1000:
                yield _digests(out, names)
                out = []
        if out:
            yield _digests(out, names)

    return pieces.select("conv_id", "text", "starts", "ends").mapInArrow(read, schema)


def _digests(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.string() if name.endswith("sha256") else pa.int64() for name in names]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
