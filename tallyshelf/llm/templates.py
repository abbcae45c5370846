"""A small sandboxed template language for chat formats.

A template is parsed into a syntax tree, constants are folded, and the tree is
compiled into Python closures. It can print, branch, loop over the conversation
and mark what the model generates; it cannot call, index by underscore names or
reach anything but its own variables.

    {% for m in messages %}<|{{ m.role | line }}|>
    {% if m.role == 'assistant' %}{% generation %}{{ m.text | safe }}{% endgeneration %}
    {% else %}{{ m.text | safe }}{% endif %}<|end|>{% endfor %}

A block with a minus at an end, as in ``{%- if a -%}``, takes the white space there away.

Expressions: strings, numbers, ``true false none``, names, ``a.b``, ``a[b]``,
``not and or == != < <= > >= in + ~``, parentheses, ``a if b else c`` and filters.
``loop`` has ``index index0 first last`` and ``previous``.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Mapping
from typing import Any, NamedTuple

Fragment = tuple[str, bool]
Scope = dict[str, Any]


class TemplateError(ValueError):
    """A fault in a template, or a use that the sandbox refuses."""


# The syntax tree.
class Const(NamedTuple):
    value: Any


class Name(NamedTuple):
    name: str


class Get(NamedTuple):
    of: Any
    key: Any


class Unary(NamedTuple):
    op: str
    of: Any


class Binary(NamedTuple):
    op: str
    left: Any
    right: Any


class Choose(NamedTuple):
    test: Any
    yes: Any
    no: Any


class Filter(NamedTuple):
    of: Any
    name: str


class Text(NamedTuple):
    value: str


class Print(NamedTuple):
    value: Any


class If(NamedTuple):
    test: Any
    yes: tuple
    no: tuple


class For(NamedTuple):
    name: str
    over: Any
    body: tuple


class Set(NamedTuple):
    name: str
    value: Any


class Generation(NamedTuple):
    body: tuple


OPEN = re.compile(r"\{(?:%-?|\{-?|#)")
#: What a block is made of up to its end: strings, which may hold anything, and single characters.
INSIDE = re.compile(r"'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\"|.", re.S)
CLOSE = {"%": re.compile(r"-?%\}"), "{": re.compile(r"-?\}\}")}
TOKEN = re.compile(
    r"\s*(?:(?P<number>\d+)|(?P<string>'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")"
    r"|(?P<name>[A-Za-z_]\w*)|(?P<mark>==|!=|<=|>=|[.\[\]()|+~<>]))"
)
ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
LEVELS = (("or",), ("and",), ("==", "!=", "<", "<=", ">", ">=", "in"), ("+", "~"))


class Parser:
    """Recursive descent over one expression's tokens."""

    def __init__(self, text: str):
        self.tokens: list[tuple[str, str]] = []
        at = 0
        text = text.rstrip()
        while at < len(text):
            match = TOKEN.match(text, at)
            if not match:
                raise TemplateError(f"cannot read {text[at:]!r}")
            self.tokens.append((match.lastgroup, match[match.lastgroup]))
            at = match.end()
        self.at = 0

    def peek(self) -> str | None:
        kind, text = self.tokens[self.at] if self.at < len(self.tokens) else ("end", None)
        return text if kind in ("mark", "name") else None

    def accept(self, *texts: str) -> str | None:
        found = self.peek()
        if found in texts:
            self.at += 1
            return found
        return None

    def expect(self, text: str) -> None:
        if not self.accept(text):
            raise TemplateError(f"{text!r} is missing")

    def name(self) -> str:
        kind, text = self.tokens[self.at] if self.at < len(self.tokens) else ("end", "")
        if kind != "name" or text.startswith("_"):
            raise TemplateError(f"{text!r} is no allowed name")
        self.at += 1
        return text

    def whole(self) -> Any:
        tree = self.choice()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return tree

    def choice(self) -> Any:
        yes = self.level(0)
        if self.accept("if"):
            test = self.level(0)
            self.expect("else")
            return Choose(test, yes, self.choice())
        return yes

    def level(self, n: int) -> Any:
        if n == len(LEVELS):
            return self.filtered()
        if n == 2 and self.accept("not"):
            return Unary("not", self.level(n))
        left = self.level(n + 1)
        while op := self.accept(*LEVELS[n]):
            left = Binary(op, left, self.level(n + 1))
        return left

    def filtered(self) -> Any:
        tree = self.atom()
        while True:
            if self.accept("."):
                tree = Get(tree, Const(self.name()))
            elif self.accept("["):
                tree = Get(tree, self.choice())
                self.expect("]")
            elif self.accept("|"):
                tree = Filter(tree, self.name())
            else:
                return tree

    def atom(self) -> Any:
        if self.accept("("):
            tree = self.choice()
            self.expect(")")
            return tree
        kind, text = self.tokens[self.at] if self.at < len(self.tokens) else ("end", "")
        self.at += 1
        if kind == "number":
            return Const(int(text))
        if kind == "string":
            return Const(re.sub(r"\\(.)", lambda m: ESCAPES.get(m[1], m[1]), text[1:-1], flags=re.S))
        if kind == "name":
            if text in ("true", "false", "none"):
                return Const({"true": True, "false": False, "none": None}[text])
            self.at -= 1
            return Name(self.name())
        raise TemplateError(f"an expression is missing at {text!r}")


def blocks(source: str) -> Iterator[tuple[str, str, str]]:
    """``(text before, kind, inside)`` of each block; the last has the kind end. Comments fall away.

    A block ends at the first closing mark outside its strings.
    """
    at, text = 0, ""
    while match := OPEN.search(source, at):
        text += source[at : match.start()]
        kind = match[0][1]
        if match[0].endswith("-"):
            text = text.rstrip()
        if kind == "#":
            end = source.find("#}", match.end())
            if end < 0:
                raise TemplateError("a comment is not closed")
            at = end + 2
            continue
        end = match.end()
        while not (close := CLOSE[kind].match(source, end)):
            piece = INSIDE.match(source, end)
            if not piece:
                raise TemplateError(f"{source[match.start() : match.start() + 20]!r} is not closed")
            end = piece.end()
        yield text, kind, source[match.end() : end].strip()
        at, text = close.end(), ""
        if close[0].startswith("-"):
            at += len(source[at:]) - len(source[at:].lstrip())
    yield text + source[at:], "end", ""


def parse(source: str) -> tuple:
    """The template's syntax tree."""
    # Each open block: its kind, its head, its finished branches, and the branch being read.
    stack: list[list] = [["", None, [], []]]
    for text, kind, inside in blocks(source):
        _text(stack, text)
        if kind == "{":
            stack[-1][3].append(Print(Parser(inside).whole()))
        elif kind == "%":
            _statement(stack, inside)
    if len(stack) > 1:
        raise TemplateError(f"{stack[-1][0]} is not closed")
    return tuple(stack[0][3])


#: The head of an if's last branch.
ELSE = Const(True)


def _text(stack: list[list], text: str) -> None:
    if text:
        stack[-1][3].append(Text(text))


def _statement(stack: list[list], source: str) -> None:
    word, _, rest = source.partition(" ")
    top = stack[-1]
    if word == "for":
        name, found, over = rest.partition(" in ")
        if not found:
            raise TemplateError("a for needs 'in'")
        stack.append(["for", (Parser(name).name(), Parser(over).whole()), [], []])
    elif word in ("if", "generation"):
        stack.append([word, Parser(rest).whole() if word == "if" else None, [], []])
    elif word in ("elif", "else") and top[0] == "if":
        if top[1] is ELSE:
            raise TemplateError(f"{word!r} after the else of an if")
        top[2].append((top[1], tuple(top[3])))
        top[1], top[3] = (Parser(rest).whole() if word == "elif" else ELSE), []
    elif word == "set":
        name, found, value = rest.partition("=")
        if not found:
            raise TemplateError("a set needs '='")
        top[3].append(Set(Parser(name).name(), Parser(value).whole()))
    elif word == f"end{top[0]}" and top[0]:
        stack.pop()
        stack[-1][3].append(_closed(*top))
    else:
        raise TemplateError(f"unexpected {source!r}")


def _closed(kind: str, head: Any, branches: list, body: list) -> Any:
    if kind == "for":
        return For(*head, tuple(body))
    if kind == "generation":
        return Generation(tuple(body))
    tree: tuple = ()
    for test, found in reversed([*branches, (head, tuple(body))]):
        tree = (If(test, found, tree),)
    return tree[0]


OPERATIONS: dict[str, Callable[[Any, Any], Any]] = {
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "in": lambda a, b: a in b,
    "+": lambda a, b: a + b,
    "~": lambda a, b: f"{_shown(a)}{_shown(b)}",
}


def _shown(value: Any) -> str:
    return "" if value is None else str(value)


def _member(of: Any, key: Any) -> Any:
    """An entry of a mapping or list; never an attribute."""
    if isinstance(of, Mapping):
        return of.get(key)
    if isinstance(of, (list, tuple, str)) and isinstance(key, int) and -len(of) <= key < len(of):
        return of[key]
    return None


def fold(tree: Any, filters: Mapping[str, Callable[[str], str]]) -> Any:
    """The tree with what needs no variable computed, dead branches cut, neighbouring texts joined."""
    if isinstance(tree, tuple) and not hasattr(tree, "_fields"):
        out: list = []
        for node in tree:
            made = fold(node, filters)
            for one in made if isinstance(made, tuple) and not hasattr(made, "_fields") else (made,):
                if isinstance(one, Text) and out and isinstance(out[-1], Text):
                    out[-1] = Text(out[-1].value + one.value)
                elif one != Text(""):
                    out.append(one)
        return tuple(out)
    if not hasattr(tree, "_fields") or isinstance(tree, (Const, Name, Text)):
        return tree
    node = type(tree)(*[fold(part, filters) for part in tree])
    if isinstance(node, Print) and isinstance(node.value, Const):
        return Text(_shown(node.value.value))
    if isinstance(node, (If, Choose)) and isinstance(node.test, Const):
        return node.yes if node.test.value else node.no
    if isinstance(node, Binary) and node.op in ("and", "or") and isinstance(node.left, Const):
        return node.right if bool(node.left.value) == (node.op == "and") else node.left
    parts = [p for p in node if hasattr(p, "_fields")]
    if isinstance(node, (Unary, Binary, Get, Filter)) and all(isinstance(p, Const) for p in parts):
        return Const(expression(node, filters)({}))
    return node


def expression(tree: Any, filters: Mapping[str, Callable[[str], str]]) -> Callable[[Scope], Any]:
    """A closure that computes an expression from the variables."""
    if isinstance(tree, Const):
        return lambda scope, value=tree.value: value
    if isinstance(tree, Name):
        return lambda scope, name=tree.name: scope.get(name)
    parts = [expression(p, filters) for p in tree if hasattr(p, "_fields")]
    if isinstance(tree, Get):
        of, key = parts
        return lambda scope: _member(of(scope), key(scope))
    if isinstance(tree, Unary):
        return lambda scope: not parts[0](scope)
    if isinstance(tree, Choose):
        test, yes, no = parts
        return lambda scope: yes(scope) if test(scope) else no(scope)
    if isinstance(tree, Filter):
        if tree.name not in filters:
            raise TemplateError(f"no filter {tree.name!r}")
        apply, of = filters[tree.name], parts[0]
        return lambda scope: apply(_shown(of(scope)))
    left, right = parts
    if tree.op == "and":
        return lambda scope: left(scope) and right(scope)
    if tree.op == "or":
        return lambda scope: left(scope) or right(scope)
    operation = OPERATIONS[tree.op]

    def operate(scope: Scope) -> Any:
        one, other = left(scope), right(scope)
        try:
            return operation(one, other)
        except TypeError:
            kinds = f"{type(one).__name__} {tree.op} {type(other).__name__}"
            raise TemplateError(f"{kinds} has no meaning") from None

    return operate


Render = Callable[[Scope, bool], Iterator[Fragment]]


def statements(body: tuple, filters: Mapping[str, Callable[[str], str]]) -> Render:
    """A closure that renders statements lazily into ``(text, generated)`` fragments."""
    steps = [_statement_closure(node, filters) for node in body]

    def render(scope: Scope, generated: bool) -> Iterator[Fragment]:
        for step in steps:
            yield from step(scope, generated)

    return render


def _statement_closure(node: Any, filters: Mapping[str, Callable[[str], str]]) -> Render:
    if isinstance(node, Text):
        return lambda scope, generated: iter(((node.value, generated),))
    if isinstance(node, Print):
        value = expression(node.value, filters)
        return lambda scope, generated: iter(((_shown(value(scope)), generated),))
    if isinstance(node, Generation):
        body = statements(node.body, filters)
        return lambda scope, generated: body(scope, True)
    if isinstance(node, If):
        test = expression(node.test, filters)
        yes, no = statements(node.yes, filters), statements(node.no, filters)
        return lambda scope, generated: (yes if test(scope) else no)(scope, generated)
    if isinstance(node, Set):
        assigned = expression(node.value, filters)

        def assign(scope: Scope, generated: bool) -> Iterator[Fragment]:
            scope[node.name] = assigned(scope)
            return iter(())

        return assign
    over, body = expression(node.over, filters), statements(node.body, filters)

    def loop(scope: Scope, generated: bool) -> Iterator[Fragment]:
        items = iter(over(scope) or ())
        end = object()
        previous, item, index = None, next(items, end), 0
        while item is not end:
            following = next(items, end)
            place = {"index": index + 1, "index0": index, "first": not index, "last": following is end}
            inner = dict(scope) | {node.name: item, "loop": place | {"previous": previous}}
            yield from body(inner, generated)
            previous, item, index = item, following, index + 1

    return loop


class Template:
    """A compiled template. Loops read their items one by one, so a conversation can be a stream."""

    def __init__(self, source: str, filters: Mapping[str, Callable[[str], str]] | None = None):
        self.filters = dict(filters or {})
        self.tree = fold(parse(source), self.filters)
        self._render = statements(self.tree, self.filters)

    def render(self, **variables: Any) -> Iterator[Fragment]:
        return self._render(dict(variables), False)

    def text(self, **variables: Any) -> str:
        return "".join(text for text, _ in self.render(**variables))


def generated_spans(fragments: Iterable[Fragment]) -> tuple[str, list[tuple[int, int]]]:
    """The whole text, and start and end of each stretch that is marked as generated."""
    texts, spans, at = [], [], 0
    for text, generated in fragments:
        if generated and text:
            if spans and spans[-1][1] == at:
                spans[-1] = (spans[-1][0], at + len(text))
            else:
                spans.append((at, at + len(text)))
        texts.append(text)
        at += len(text)
    return "".join(texts), spans
