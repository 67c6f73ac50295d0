"""Chat formatting by a template compiler.

A template is parsed into a syntax tree, constants are folded, and the tree is
turned into Python closures.  The language is a sandbox: texts, ``{{ value }}``,
``{% for x in value %}``, ``{% if %}/{% elif %}/{% else %}``, ``{% set x = value
%}`` and ``{% generation %}`` (marks what a model is to learn), with literals,
names, ``.key``, comparison, ``and or not in``, ``~`` (joining), ``+ -`` and the
filters ``escape trim upper lower length``.  No calls, no Python attributes, no
names but those given, loops over the given lists only.

``escape`` makes the template's control strings impossible in a text: a
backslash goes in after the first character of each, one more where there are
some already; :func:`unescape` takes it out again, so any text survives.

Conversations are formed by one shuffle on ``conv_id`` and a sort by turn; the
rows are then rendered as a stream, and a long conversation leaves in parts, so
a task holds one part whatever a conversation's length.

Defined results: a null role or text is empty; rows of equal turn go by role
and text and all stay; a null turn comes first; a null conv_id is a
conversation of its own; no rows give no rows; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.llm.common import partitions

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
CONTROLS = (START, SEP, END)
CHAT_TEMPLATE = (
    "{% for m in messages %}" + START + "{{ m.role | escape }}" + SEP
    + "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    + "{% else %}{{ m.text | escape }}{% endif %}" + END + "{{ '\\n' }}{% endfor %}")

Segment = tuple[str, bool]


class TemplateError(ValueError):
    """The template, or what it asks of its values, is not allowed."""


# -- escaping -------------------------------------------------------------
def escaper(controls: Iterable[str]) -> tuple[Callable[[str], str], Callable[[str], str]]:
    """(escape, unescape) for these control strings.  The first character of
    any must not occur further on in one of them, nor be a backslash."""
    controls = sorted(set(controls))
    heads = {c[:1] for c in controls}
    if any(len(c) < 2 or "\\" in c or heads & set(c[1:]) for c in controls):
        raise TemplateError("control strings need a first character that occurs nowhere else in them")
    if not controls:
        return str, str
    tails = {h: "|".join(re.escape(c[1:]) for c in controls if c[0] == h) for h in heads}
    put = re.compile("|".join(rf"(?:{re.escape(h)})(?=\\*(?:{t}))" for h, t in sorted(tails.items())))
    cut = re.compile("|".join(rf"(?:{re.escape(h)})\\(?=\\*(?:{t}))" for h, t in sorted(tails.items())))
    return (lambda s: put.sub(lambda m: m[0] + "\\", s)), (lambda s: cut.sub(lambda m: m[0][0], s))


# -- syntax tree ----------------------------------------------------------
@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Item:
    of: object
    key: object


@dataclass(frozen=True)
class Unary:
    op: str
    of: object


@dataclass(frozen=True)
class Binary:
    op: str
    left: object
    right: object


@dataclass(frozen=True)
class Filter:
    name: str
    of: object


@dataclass(frozen=True)
class Text:
    text: str


@dataclass(frozen=True)
class Show:
    value: object


@dataclass(frozen=True)
class For:
    name: str
    over: object
    body: tuple


@dataclass(frozen=True)
class If:
    branches: tuple      # (condition, body) pairs
    otherwise: tuple


@dataclass(frozen=True)
class Set:
    name: str
    value: object


@dataclass(frozen=True)
class Generation:
    body: tuple


_TAGS = re.compile(r"(\{\{.*?\}\}|\{%.*?%\}|\{#.*?#\})", re.S)
_LEX = re.compile(r"\s*(?:(?P<str>'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(?P<int>\d+)|(?P<name>[A-Za-z_]\w*)"
                  r"|(?P<op>==|!=|<=|>=|[<>|~+\-().\[\]=]))")
_WORDS = {"and", "or", "not", "in", "true", "false", "none", "for", "if", "elif", "else", "endif", "endfor",
          "set", "generation", "endgeneration"}
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}


class Parser:
    def __init__(self, source: str):
        self.parts = [p for p in _TAGS.split(source) if p and not p.startswith("{#")]
        self.at = 0
        self.lex: list[tuple[str, str]] = []

    # statements
    def body(self, *ends: str) -> tuple[tuple, str]:
        """Nodes up to one of the tags ``ends`` (or the source's end) and that tag."""
        nodes: list = []
        while self.at < len(self.parts):
            part = self.parts[self.at]
            self.at += 1
            if part.startswith("{{") and part.endswith("}}"):
                self.tokens(part[2:-2])
                nodes.append(Show(self.whole()))
            elif part.startswith("{%") and part.endswith("%}"):
                self.tokens(part[2:-2])
                tag = self.take("name")
                if tag in ends:
                    return tuple(nodes), tag
                nodes.append(self.statement(tag))
            else:
                nodes.append(Text(part))
        if ends:
            raise TemplateError(f"missing {' or '.join(ends)}")
        return tuple(nodes), ""

    def statement(self, tag: str):
        if tag == "for":
            name = self.own_name()
            self.need("in")
            over = self.whole()
            return For(name, over, self.body("endfor")[0])
        if tag == "set":
            name = self.own_name()
            self.need("=")
            return Set(name, self.whole())
        if tag == "generation":
            self.done()
            return Generation(self.body("endgeneration")[0])
        if tag == "if":
            branches, otherwise = [], ()
            test = self.whole()
            while True:
                nodes, end = self.body("elif", "else", "endif")
                branches.append((test, nodes))
                if end == "elif":
                    test = self.whole()
                    continue
                if end == "else":
                    self.done()
                    otherwise = self.body("endif")[0]
                return If(tuple(branches), otherwise)
        raise TemplateError(f"unknown tag {tag!r}")

    # tokens
    def tokens(self, source: str) -> None:
        self.lex, at = [], 0
        source = source.strip()
        while at < len(source):
            m = _LEX.match(source, at)
            if not m or m.end() == at:
                raise TemplateError(f"cannot read {source[at:]!r}")
            self.lex.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.lex.reverse()

    def peek(self) -> str:
        return self.lex[-1][1] if self.lex and self.lex[-1][0] != "str" else ""

    def take(self, kind: str) -> str:
        if not self.lex or self.lex[-1][0] != kind:
            raise TemplateError(f"expected {kind}")
        return self.lex.pop()[1]

    def own_name(self) -> str:
        name = self.take("name")
        if name in _WORDS or name.startswith("_") or name == "loop":
            raise TemplateError(f"{name!r} cannot be set")
        return name

    def accept(self, *words: str) -> str:
        return self.lex.pop()[1] if self.peek() in words and self.lex else ""

    def need(self, word: str) -> None:
        if not self.accept(word):
            raise TemplateError(f"expected {word!r}")

    def done(self) -> None:
        if self.lex:
            raise TemplateError(f"unexpected {self.lex[-1][1]!r}")

    # expressions, loosest first
    def whole(self):
        e = self.either()
        self.done()
        return e

    def either(self):
        e = self.both()
        while self.accept("or"):
            e = Binary("or", e, self.both())
        return e

    def both(self):
        e = self.negated()
        while self.accept("and"):
            e = Binary("and", e, self.negated())
        return e

    def negated(self):
        return Unary("not", self.negated()) if self.accept("not") else self.compared()

    def compared(self):
        e = self.joined()
        while op := self.accept("==", "!=", "<", ">", "<=", ">=", "in"):
            e = Binary(op, e, self.joined())
        return e

    def joined(self):
        e = self.added()
        while self.accept("~"):
            e = Binary("~", e, self.added())
        return e

    def added(self):
        e = self.signed()
        while op := self.accept("+", "-"):
            e = Binary(op, e, self.signed())
        return e

    def signed(self):
        return Unary("-", self.signed()) if self.accept("-") else self.filtered()

    def filtered(self):
        e = self.atom()
        while op := self.accept("|", ".", "["):
            if op == "|":
                e = Filter(self.take("name"), e)
            elif op == ".":
                e = Item(e, Const(self.take("name")))
            else:
                e = Item(e, self.either())
                self.need("]")
        return e

    def atom(self):
        if not self.lex:
            raise TemplateError("a value is missing")
        kind, text = self.lex.pop()
        if kind == "str":
            return Const(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), text[1:-1], flags=re.S))
        if kind == "int":
            return Const(int(text))
        if text == "(":
            e = self.either()
            self.need(")")
            return e
        if text in ("true", "false", "none"):
            return Const({"true": True, "false": False, "none": None}[text])
        if kind != "name" or text in _WORDS or text.startswith("_"):
            raise TemplateError(f"unexpected {text!r}")
        return Name(text)


# -- meaning --------------------------------------------------------------
def _shown(v) -> str:
    if v is None:
        return ""
    if isinstance(v, (str, int, bool)):
        return str(v)
    raise TemplateError("only texts and numbers can be shown")


def _item(of, key):
    if isinstance(of, dict):
        return of.get(key)
    if isinstance(of, (list, tuple)) and isinstance(key, int):
        return of[key] if -len(of) <= key < len(of) else None
    raise TemplateError(f"no key {key!r} there")


_BINARY = {
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "<": lambda a, b: a < b, ">": lambda a, b: a > b,
    "<=": lambda a, b: a <= b, ">=": lambda a, b: a >= b, "in": lambda a, b: a in b,
    "~": lambda a, b: _shown(a) + _shown(b), "+": lambda a, b: a + b, "-": lambda a, b: a - b,
}
_UNARY = {"not": lambda a: not a, "-": lambda a: -a}


class Template:
    """``Template(source, controls).segments(messages=...)`` yields (text,
    under the generation mask) in order, as a lazy stream."""

    def __init__(self, source: str = CHAT_TEMPLATE, controls: Iterable[str] = CONTROLS):
        self.escape, self.unescape = escaper(controls)
        self.filters: dict[str, Callable] = {
            "escape": lambda v: self.escape(_shown(v)), "trim": lambda v: _shown(v).strip(),
            "upper": lambda v: _shown(v).upper(), "lower": lambda v: _shown(v).lower(), "length": len}
        self.tree = self.fold_body(Parser(source).body()[0])
        self.run = self.compile_body(self.tree)

    # constant folding
    def fold(self, e):
        if isinstance(e, Unary):
            of = self.fold(e.of)
            return Const(_UNARY[e.op](of.value)) if isinstance(of, Const) else Unary(e.op, of)
        if isinstance(e, Filter):
            if e.name not in self.filters:
                raise TemplateError(f"unknown filter {e.name!r}")
            of = self.fold(e.of)
            return Const(self.filters[e.name](of.value)) if isinstance(of, Const) else Filter(e.name, of)
        if isinstance(e, Item):
            return Item(self.fold(e.of), self.fold(e.key))
        if isinstance(e, Binary):
            a, b = self.fold(e.left), self.fold(e.right)
            if e.op in ("and", "or"):
                if isinstance(a, Const):
                    return b if bool(a.value) == (e.op == "and") else a
                return Binary(e.op, a, b)
            if isinstance(a, Const) and isinstance(b, Const):
                return Const(_BINARY[e.op](a.value, b.value))
            return Binary(e.op, a, b)
        return e

    def fold_body(self, nodes: tuple) -> tuple:
        out: list = []

        def add(node) -> None:
            if isinstance(node, Text) and out and isinstance(out[-1], Text):
                out[-1] = Text(out[-1].text + node.text)
            elif not (isinstance(node, Text) and not node.text):
                out.append(node)

        for n in nodes:
            if isinstance(n, Show):
                v = self.fold(n.value)
                add(Text(_shown(v.value)) if isinstance(v, Const) else Show(v))
            elif isinstance(n, For):
                add(For(n.name, self.fold(n.over), self.fold_body(n.body)))
            elif isinstance(n, Set):
                add(Set(n.name, self.fold(n.value)))
            elif isinstance(n, Generation):
                add(Generation(self.fold_body(n.body)))
            elif isinstance(n, If):
                live, rest = [], self.fold_body(n.otherwise)
                for test, body in n.branches:
                    test = self.fold(test)
                    if isinstance(test, Const) and not test.value:
                        continue
                    if isinstance(test, Const):
                        rest = self.fold_body(body)
                        break
                    live.append((test, self.fold_body(body)))
                if live:
                    add(If(tuple(live), rest))
                else:
                    for x in rest:
                        add(x)
            else:
                add(n)
        return tuple(out)

    # closures
    def compile(self, e) -> Callable[[dict], object]:
        if isinstance(e, Const):
            return lambda env, v=e.value: v
        if isinstance(e, Name):
            def look(env, name=e.name):
                if name not in env:
                    raise TemplateError(f"unknown name {name!r}")
                return env[name]
            return look
        if isinstance(e, Item):
            of, key = self.compile(e.of), self.compile(e.key)
            return lambda env: _item(of(env), key(env))
        if isinstance(e, Filter):
            f, of = self.filters[e.name], self.compile(e.of)
            return lambda env: f(of(env))
        if isinstance(e, Unary):
            f, of = _UNARY[e.op], self.compile(e.of)
            return lambda env: f(of(env))
        a, b = self.compile(e.left), self.compile(e.right)
        if e.op == "and":
            return lambda env: a(env) and b(env)
        if e.op == "or":
            return lambda env: a(env) or b(env)
        f = _BINARY[e.op]
        return lambda env: f(a(env), b(env))

    def compile_body(self, nodes: tuple) -> Callable[[dict, bool], Iterator[Segment]]:
        steps = [self.compile_node(n) for n in nodes]

        def run(env: dict, masked: bool) -> Iterator[Segment]:
            for s in steps:
                yield from s(env, masked)
        return run

    def compile_node(self, n) -> Callable[[dict, bool], Iterable[Segment]]:
        if isinstance(n, Text):
            return lambda env, masked: ((n.text, masked),)
        if isinstance(n, Show):
            value = self.compile(n.value)
            return lambda env, masked: ((_shown(value(env)), masked),)
        if isinstance(n, Generation):
            body = self.compile_body(n.body)
            return lambda env, masked: body(env, True)
        if isinstance(n, Set):
            value = self.compile(n.value)

            def put(env, masked):
                env[n.name] = value(env)
                return ()
            return put
        if isinstance(n, If):
            tests = [(self.compile(t), self.compile_body(b)) for t, b in n.branches]
            rest = self.compile_body(n.otherwise)

            def choose(env, masked):
                return next((b for t, b in tests if t(env)), rest)(env, masked)
            return choose
        over, body = self.compile(n.over), self.compile_body(n.body)

        def loop(env, masked):
            rows = over(env)
            if isinstance(rows, (str, dict)) or not hasattr(rows, "__iter__"):
                raise TemplateError("only lists can be looped over")
            i, rows, none = 0, iter(rows), object()
            row = next(rows, none)
            while row is not none:       # one row ahead, to know the last
                ahead = next(rows, none)
                i += 1
                inner = env | {n.name: row, "loop": {"index": i, "first": i == 1, "last": ahead is none}}
                yield from body(inner, masked)
                row = ahead
        return loop

    def segments(self, **values) -> Iterator[Segment]:
        return self.run(dict(values), False)

    def render(self, **values) -> tuple[str, list[tuple[int, int]]]:
        """The whole text and the spans under the generation mask."""
        text, spans, at = [], [], 0
        for s, masked in self.segments(**values):
            if masked:
                spans.append((at, at + len(s)))
            text.append(s)
            at += len(s)
        return "".join(text), spans


# -- Spark ----------------------------------------------------------------
def in_order(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text``, every conversation whole and in order in one partition."""
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")))
    return rows.repartition(partitions(rows.sparkSession), "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def format_conversations(conversations: DataFrame, source: str = CHAT_TEMPLATE,
                         controls: tuple[str, ...] = CONTROLS, part_chars: int = 1 << 20) -> DataFrame:
    """``conv_id, part, formatted, loss``: the formatted text, cut into parts of
    about ``part_chars`` (most conversations have one, number 0), and in
    each part the spans under the generation mask."""

    def rows(batches):
        for b in batches:
            for c, role, text in zip(*(b.column(n).to_pylist() for n in ("conv_id", "role", "text"))):
                yield c, {"role": role, "text": text}

    def parts(batches):
        template = Template(source, controls)
        for conv, own in groupby(rows(batches), key=lambda r: r[0]):
            text, spans, at, part = [], [], 0, 0
            for s, masked in template.segments(messages=(m for _, m in own)):
                if at >= part_chars:
                    yield conv, part, "".join(text), spans
                    text, spans, at, part = [], [], 0, part + 1
                if masked:
                    spans.append({"begin": at, "end": at + len(s)})
                text.append(s)
                at += len(s)
            yield conv, part, "".join(text), spans

    def run(batches):
        out, held = [], 0
        for row in parts(batches):
            out.append(row)
            held += len(row[2])
            if len(out) >= 2000 or held > 8 * part_chars:
                yield _batch(out, _PARTS)
                out, held = [], 0
        if out:
            yield _batch(out, _PARTS)

    return in_order(conversations).mapInArrow(
        run, "conv_id long, part int, formatted string, loss array<struct<begin:long,end:long>>")


_PARTS = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("formatted", pa.string()),
                    ("loss", pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])))])
_DIGEST = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                     ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


_TURN = re.compile(f"{re.escape(START)}(.*?){re.escape(SEP)}(.*?){re.escape(END)}\n", re.S)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def read_back(formatted: DataFrame, controls: tuple[str, ...] = CONTROLS) -> DataFrame:
    """Digests of turns and learnt text, parsed from what
    :func:`format_conversations` put out with the default template: its parts
    in order, nothing else."""

    def parsed(batches):
        _, unescape = escaper(controls)
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        for conv, own in groupby(rows, key=lambda r: r[0]):
            turns, loss = hashlib.sha256(), hashlib.sha256()
            n = loss_chars = chars = 0
            rest = ""
            for _, _, text, spans in own:
                chars += len(text)
                for s in spans:
                    piece = unescape(text[s["begin"]:s["end"]])
                    loss_chars += len(piece)
                    loss.update(piece.encode())
                rest, at = rest + text, 0
                while m := _TURN.match(rest, at):
                    turns.update(f"{unescape(m[1])}\n{unescape(m[2])}\n".encode())
                    n, at = n + 1, m.end()
                rest = rest[at:]
            if rest:
                raise TemplateError("a turn does not end with its marker")
            yield conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars

    def run(batches):
        out = []
        for row in parsed(batches):
            out.append(row)
            if len(out) >= 2000:
                yield _batch(out, _DIGEST)
                out = []
        if out:
            yield _batch(out, _DIGEST)

    return formatted.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                     "loss_sha256 string, formatted_chars long")
