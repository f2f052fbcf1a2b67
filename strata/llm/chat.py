"""Operator 9: chat formatting by a template compiler.

A template is parsed into a syntax tree, constants are folded, and the tree becomes
Python closures that yield pieces of output, each with whether it lies under a
generation marker (the loss mask). The language is a sandbox: literals, the names
given, items of mappings, ``loop.first`` / ``loop.last`` / ``loop.index0``, comparison,
``and`` / ``or`` / ``not``, ``+`` and the filters below; nothing else can be called.

    {{ expr }}   {% for x in name %}..{% endfor %}   {% if e %}..{% elif e %}..{% else %}..{% endif %}
    {% generation %}..{% endgeneration %}
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The default template's control strings; inside texts their first character gets a backslash, as backslashes do.
TEMPLATE = (
    "{{ '<s>' }}{% for m in messages %}"
    "{% if m.role == 'user' %}{{ '[' + 'INST]' }}{{ m.text | escape }}[/INST]"
    "{% elif m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}</s>"
    "{% elif m.role == 'system' %}[SYS]{{ m.text | escape }}[/SYS]"
    "{% else %}[TURN]{{ m.role | escape_line }}\n{{ m.text | escape }}[/TURN]{% endif %}{% endfor %}"
)
CONTROL = r"</?s>|\[/?(?:INST|SYS|TURN)\]"
_ESCAPE = re.compile(rf"\\|(?={CONTROL}).", re.S)
_ESCAPE_LINE = re.compile(rf"\\|\n|(?={CONTROL}).", re.S)
_UNESCAPE = re.compile(r"\\(.)", re.S)
_MARK = re.compile(rf"\\.|({CONTROL})", re.S)
PART_CHARS = 1 << 20  # a conversation's output is cut into parts of about this size, between turns

FILTERS: dict[str, Callable[[str], str]] = {
    "escape": lambda s: _ESCAPE.sub(lambda m: "\\" + m[0], s),
    "escape_line": lambda s: _ESCAPE_LINE.sub(lambda m: "\\" + m[0], s),
    "trim": str.strip,
    "upper": str.upper,
    "lower": str.lower,
}


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


class TemplateError(ValueError):
    pass


# ---------------------------------------------------------------- syntax tree: nested tuples
_TAG = re.compile(r"(\{\{.*?\}\}|\{%.*?%\})", re.S)
_LEX = re.compile(r"\s*(?:('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(\d+)|([A-Za-z_]\w*)|(==|!=|[|+.()\[\]]))", re.S)
_WORDS = {"and", "or", "not"}


def _lex(code: str) -> list[tuple[str, str]]:
    out, at, code = [], 0, code.strip()
    while at < len(code):
        m = _LEX.match(code, at)
        if not m:
            raise TemplateError(f"cannot read {code[at:]!r}")
        kind = ("str", "int", "name", "op")[m.lastindex - 1]
        out.append(("op" if m[m.lastindex] in _WORDS else kind, m[m.lastindex]))
        at = m.end()
    return out


class _Expr:
    """Recursive descent over one expression."""

    def __init__(self, code: str):
        self.toks, self.i = _lex(code), 0

    def peek(self) -> tuple[str, str]:
        return self.toks[self.i] if self.i < len(self.toks) else ("end", "")

    def take(self, kind: str, value: str | None = None) -> str | None:
        k, v = self.peek()
        if k == kind and (value is None or v == value):
            self.i += 1
            return v
        return None

    def need(self, kind: str, value: str | None = None) -> str:
        got = self.take(kind, value)
        if got is None:
            raise TemplateError(f"expected {value or kind}, found {self.peek()[1]!r}")
        return got

    def whole(self):
        tree = self.either()
        self.need("end") if self.peek()[0] != "end" else None
        return tree

    def either(self):
        left = self.both()
        while self.take("op", "or"):
            left = ("or", left, self.both())
        return left

    def both(self):
        left = self.negated()
        while self.take("op", "and"):
            left = ("and", left, self.negated())
        return left

    def negated(self):
        return ("not", self.negated()) if self.take("op", "not") else self.compared()

    def compared(self):
        left = self.joined()
        for op in ("==", "!="):
            if self.take("op", op):
                return (op, left, self.joined())
        return left

    def joined(self):
        left = self.filtered()
        while self.take("op", "+"):
            left = ("+", left, self.filtered())
        return left

    def filtered(self):
        left = self.atom()
        while self.take("op", "|"):
            name = self.need("name")
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            left = ("filter", left, name)
        return left

    def atom(self):
        if self.take("op", "("):
            tree = self.either()
            self.need("op", ")")
        elif (text := self.take("str")) is not None:
            tree = ("const", re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), text[1:-1], flags=re.S))
        elif (number := self.take("int")) is not None:
            tree = ("const", int(number))
        else:
            tree = ("name", self.need("name"))
        while True:
            if self.take("op", "."):
                tree = ("item", tree, ("const", self.need("name")))
            elif self.take("op", "["):
                tree = ("item", tree, self.either())
                self.need("op", "]")
            else:
                return tree


def parse(template: str) -> list:
    """Template -> list of nodes: ("text", s), ("out", expr), ("for", name, expr, body), ("if", [(expr, body)], else body), ("gen", body)."""
    pieces = [p for p in _TAG.split(template) if p]
    at = 0

    def body(stops: tuple[str, ...]):
        nonlocal at
        nodes = []
        while at < len(pieces):
            piece = pieces[at]
            at += 1
            if piece.startswith("{{"):
                nodes.append(("out", _Expr(piece[2:-2]).whole()))
            elif piece.startswith("{%"):
                word, _, rest = piece[2:-2].strip().partition(" ")
                if word in stops:
                    return nodes, word, rest
                if word == "for":
                    m = re.fullmatch(r"(\w+)\s+in\s+(.+)", rest.strip(), re.S)
                    if not m:
                        raise TemplateError(f"cannot read for {rest!r}")
                    nodes.append(("for", m[1], _Expr(m[2]).whole(), body(("endfor",))[0]))
                elif word == "if":
                    branches, other, test = [], [], rest
                    while True:
                        inner, stop, more = body(("elif", "else", "endif"))
                        branches.append((_Expr(test).whole(), inner))
                        if stop == "else":
                            other = body(("endif",))[0]
                        if stop != "elif":
                            break
                        test = more
                    nodes.append(("if", branches, other))
                elif word == "generation":
                    nodes.append(("gen", body(("endgeneration",))[0]))
                else:
                    raise TemplateError(f"unexpected {word!r}")
            else:
                nodes.append(("text", piece))
        if stops:
            raise TemplateError(f"missing {' or '.join(stops)}")
        return nodes, "", ""

    return body(())[0]


# ---------------------------------------------------------------- constant folding
def _fold_expr(e):
    if e[0] in ("const", "name"):
        return e
    e = (e[0], *(_fold_expr(x) if isinstance(x, tuple) else x for x in e[1:]))
    if all(x[0] == "const" for x in e[1:] if isinstance(x, tuple)):
        return ("const", _expr(e)({}))
    return e


def fold(nodes: list) -> list:
    """Constant expressions become text, decided branches their body, neighbouring texts one."""
    out: list = []

    def add(node):
        if node[0] == "text" and out and out[-1][0] == "text":
            out[-1] = ("text", out[-1][1] + node[1])
        elif node != ("text", ""):
            out.append(node)

    for node in nodes:
        if node[0] == "out":
            e = _fold_expr(node[1])
            add(("text", _text(e[1])) if e[0] == "const" else ("out", e))
        elif node[0] == "for":
            add(("for", node[1], _fold_expr(node[2]), fold(node[3])))
        elif node[0] == "gen":
            add(("gen", fold(node[1])))
        elif node[0] == "if":
            branches, other = [], fold(node[2])
            for test, inner in node[1]:
                test = _fold_expr(test)
                if test[0] == "const":
                    if test[1]:
                        other = fold(inner)
                        break
                    continue
                branches.append((test, fold(inner)))
            for x in [("if", branches, other)] if branches else other:
                add(x)
        else:
            add(node)
    return out


# ---------------------------------------------------------------- closures
def _text(value) -> str:
    return "" if value is None else str(value)


def _expr(e) -> Callable[[dict], object]:
    kind = e[0]
    if kind == "const":
        return lambda env, v=e[1]: v
    if kind == "name":
        return lambda env, n=e[1]: env.get(n)
    if kind == "filter":
        f, arg = FILTERS[e[2]], _expr(e[1])
        return lambda env: f(_text(arg(env)))
    a = _expr(e[1])
    if kind == "not":
        return lambda env: not a(env)
    b = _expr(e[2])
    if kind == "item":
        return lambda env: x.get(b(env)) if isinstance(x := a(env), dict) else None
    if kind == "+":
        return lambda env: _text(a(env)) + _text(b(env))
    return {"==": lambda env: a(env) == b(env), "!=": lambda env: a(env) != b(env), "and": lambda env: a(env) and b(env), "or": lambda env: a(env) or b(env)}[kind]


Piece = tuple[str, bool]  # text, under the loss mask; ("", None) ends a turn


def _closure(nodes: list, masked: bool = False) -> Callable[[dict], Iterator[Piece]]:
    parts = [_node(n, masked) for n in nodes]

    def run(env: dict) -> Iterator[Piece]:
        for part in parts:
            yield from part(env)

    return run


def _node(node, masked: bool) -> Callable[[dict], Iterable[Piece]]:
    if node[0] == "text":
        fixed = ((node[1], masked),)
        return lambda env: fixed
    if node[0] == "out":
        e = _expr(node[1])
        return lambda env: ((_text(e(env)), masked),)
    if node[0] == "gen":
        return _closure(node[1], True)
    if node[0] == "if":
        branches, other = [(_expr(t), _closure(b, masked)) for t, b in node[1]], _closure(node[2], masked)
        return lambda env: next((b for t, b in branches if t(env)), other)(env)
    name, items, body = node[1], _expr(node[2]), _closure(node[3], masked)

    def loop(env: dict) -> Iterator[Piece]:
        rest, i = iter(items(env) or ()), 0
        item = next(rest, loop)
        while item is not loop:  # one item ahead, for loop.last; the items may come as a stream
            ahead = next(rest, loop)
            yield from body({**env, name: item, "loop": {"first": i == 0, "last": ahead is loop, "index0": i}})
            yield "", None
            item, i = ahead, i + 1

    return loop


def compile_template(template: str = TEMPLATE) -> Callable[[Iterable[dict]], Iterator[Piece]]:
    """Template -> function from a stream of messages (dicts) to a stream of pieces."""
    run = _closure(fold(parse(template)))
    return lambda messages, **names: run({**names, "messages": messages})


# ---------------------------------------------------------------- Spark
def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(b.column(i).to_pylist() for i in range(b.num_columns)), strict=True)


def _groups(rows: Iterator[tuple]) -> Iterator[tuple[object, Iterator[tuple]]]:
    """Runs of rows with one first value, as streams: a run is never held whole."""
    ahead = next(rows, None)

    def run(key):
        nonlocal ahead
        while ahead is not None and ahead[0] == key:
            row, ahead = ahead, next(rows, None)
            yield row

    while ahead is not None:
        key = ahead[0]
        group = run(key)
        yield key, group
        for _ in group:  # what the reader left
            pass


_FORMATTED = "conv_id bigint, part int, text string, spans array<struct<begin:int,end:int>>"


def _batches(rows: Iterator[tuple], names: list[str], types: list[pa.DataType], chars: Callable[[tuple], int]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += chars(row)
        if len(held) >= 4096 or size >= 8 << 20:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names=names)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names=names)


def format_conversations(rows: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """(conv_id, part, text, spans): each conversation's rendering in parts of whole turns; spans (code points of
    the part's text, end exclusive) lie under the loss mask.

    ``rows``: conv_id, turn, role, text; other columns are ignored. Turns are ordered by turn, then role, then text
    (NULLs first), repeated rows count as turns of their own; NULL roles and texts are empty; rows without conv_id
    are one conversation. A conversation passes through its task as a stream, however long it is.
    """
    compile_template(template)  # errors show here, not in a task

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template)

        def parts() -> Iterator[tuple]:
            for key, group in _groups(_rows(batches)):
                part, text, spans, size = 0, [], [], 0
                for piece, masked in render({"role": r[1], "text": r[2]} for r in group):
                    if masked is None:
                        if size >= PART_CHARS:
                            yield key, part, "".join(text), spans
                            part, text, spans, size = part + 1, [], [], 0
                        continue
                    if masked and piece:
                        spans.append({"begin": size, "end": size + len(piece)})
                    text.append(piece)
                    size += len(piece)
                if size or not part:
                    yield key, part, "".join(text), spans

        span = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))
        yield from _batches(parts(), ["conv_id", "part", "text", "spans"], [pa.int64(), pa.int32(), pa.string(), span], lambda r: len(r[2]))

    rows = rows.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return rows.select("conv_id", "role", "text").mapInArrow(run, _FORMATTED)


_ROLE = {"[/INST]": "user", "</s>": "assistant", "[/SYS]": "system"}


def read_turns(parts: Iterable[str]) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn of a conversation in the default template's form; parts end between turns."""
    for text in parts:
        begin = 0
        for m in _MARK.finditer(text):
            mark = m[1]
            if mark is None:
                continue
            if mark in _ROLE:
                yield _ROLE[mark], unescape(text[begin : m.start()])
            elif mark == "[/TURN]":
                role, _, said = _first_line(text[begin : m.start()])
                yield unescape(role), unescape(said)
            begin = m.end()


def _first_line(text: str) -> tuple[str, str, str]:
    for m in re.finditer(r"\\.|(\n)", text, re.S):
        if m[1]:
            return text[: m.start()], "\n", text[m.end() :]
    return text, "", ""


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests from the output alone: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def digests() -> Iterator[tuple]:
            for key, group in _groups(_rows(batches)):
                turns, loss, n, chars, size = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
                for _, _, text, spans in group:
                    size += len(text)
                    for role, said in read_turns([text]):
                        turns.update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
                        n += 1
                    for s in spans:
                        said = unescape(text[s["begin"] : s["end"]])
                        chars += len(said)
                        loss.update(said.encode("utf-8", "surrogatepass"))
                yield key, n, turns.hexdigest(), chars, loss.hexdigest(), size

        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        yield from _batches(digests(), names, [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()], lambda r: 0)

    rows = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return rows.mapInArrow(run, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")
