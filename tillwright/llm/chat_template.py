"""A small template language for conversations: parse, fold constants, compile to closures.

    {{ expr }}                                  output
    {% for m in messages %} ... {% endfor %}    loop; loop.first, loop.last, loop.index
    {% if expr %} ... {% elif expr %} ... {% else %} ... {% endif %}
    {% generation %} ... {% endgeneration %}    what is trained on: marks the loss mask
    expr: 'text'  12  true  false  none  name  name.field  (expr)  expr|filter
          not  and  or  ==  !=  in  +

It is a sandbox: fields are looked up in message and loop dictionaries only, filters
come from a fixed list, and there are no calls, imports or unbounded loops.  Names
given as constants are folded away when the template is compiled, as are operations
on constants and branches that can't be reached.  A compiled template yields chunks
while it reads its messages, so a long conversation is never held whole.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

# control strings of the default format, and how texts that hold them are written
OPEN, CLOSE = "<turn>", "</turn>"
_ESCAPED = re.compile(r"\\(.)", re.S)
_PLAIN = {"\\": "\\", "l": "<", "n": "\n"}


def guard(text: str) -> str:
    """Escape backslashes and control strings; ``unguard`` undoes it."""
    return text.replace("\\", "\\\\").replace(CLOSE, "\\l" + CLOSE[1:]).replace(OPEN, "\\l" + OPEN[1:])


def guard_line(text: str) -> str:
    """As ``guard``, on one line."""
    return guard(text).replace("\n", "\\n")


def unguard(text: str) -> str:
    return _ESCAPED.sub(lambda m: _PLAIN.get(m[1], m[1]), text) if "\\" in text else text


FILTERS: dict[str, Callable[[str], str]] = {
    "guard": guard, "guard_line": guard_line, "trim": str.strip, "upper": str.upper, "lower": str.lower,
    "capitalize": str.capitalize,
}

TURNS = """\
{% for m in messages %}{{ open }}{{ m.role|guard_line }}
{% if m.role == 'assistant' %}{% generation %}{{ m.text|guard }}{% endgeneration %}\
{% else %}{{ m.text|guard }}{% endif %}{{ close }}
{% endfor %}"""
TURNS_CONSTANTS = {"open": OPEN, "close": CLOSE}


class TemplateError(ValueError):
    pass


# ---- parsing: trees are tuples whose first member is the kind

_TAGS = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.S)
_TOKENS = re.compile(r"""\s*(?:('(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(\d+)|([A-Za-z_]\w*)|(==|!=|[()|+.]))""", re.S)
_BINARY = ({"or"}, {"and"}, {"==", "!=", "in"}, {"+"})
_CONSTANTS = {"true": True, "false": False, "none": None}


class _Expression:
    def __init__(self, text: str):
        self.items, at, text = [], 0, text.strip()
        while at < len(text):
            m = _TOKENS.match(text, at)
            if not m:
                raise TemplateError(f"unexpected {text[at:]!r}")
            quoted, number, word, sign = m.groups()
            self.items.append(
                ("const", re.sub(r"\\(.)", lambda x: {"n": "\n", "t": "\t"}.get(x[1], x[1]), quoted[1:-1], flags=re.S))
                if quoted else ("const", int(number)) if number else ("word", word) if word else ("sign", sign))
            at = m.end()
        self.at = 0

    def parse(self):
        tree = self._binary(0)
        if self.at < len(self.items):
            raise TemplateError(f"unexpected {self.items[self.at][1]!r}")
        return tree

    def _peek(self, *values: str) -> bool:
        return self.at < len(self.items) and self.items[self.at][0] != "const" and self.items[self.at][1] in values

    def _take(self, kind: str | None = None):
        if self.at >= len(self.items) or kind and self.items[self.at][0] != kind:
            raise TemplateError("expression ends early or has a value in the wrong place")
        self.at += 1
        return self.items[self.at - 1]

    def _binary(self, level: int):
        if level == len(_BINARY):
            return self._filtered()
        if level == 2 and self._peek("not"):
            self._take()
            return ("not", self._binary(2))
        left = self._binary(level + 1)
        while self._peek(*_BINARY[level]):
            left = ("binary", self._take()[1], left, self._binary(level + 1))
        return left

    def _filtered(self):
        tree = self._value()
        while self._peek("|", "."):
            kind, name = self._take()[1], self._take("word")[1]
            if kind == "|" and name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            tree = ("filter", name, tree) if kind == "|" else ("field", name, tree)
        return tree

    def _value(self):
        if self._peek("("):
            self._take()
            tree = self._binary(0)
            if not self._peek(")"):
                raise TemplateError("missing )")
            self._take()
            return tree
        item = self._take()
        if item[0] == "sign":
            raise TemplateError(f"unexpected {item[1]!r}")
        if item[0] == "const":
            return item
        return ("const", _CONSTANTS[item[1]]) if item[1] in _CONSTANTS else ("name", item[1])


def parse(source: str) -> list[tuple]:
    """The syntax tree of a template."""
    pieces, at = [], 0
    for m in _TAGS.finditer(source):
        pieces.append(("text", source[at:m.start()]))
        pieces.append(("out", m[1]) if m[1] is not None else ("tag", m[2].strip()))
        at = m.end()
    pieces.append(("text", source[at:]))
    tree, end = _block(iter(pieces), ())
    return tree


def _block(pieces: Iterator[tuple], ends: tuple[str, ...]) -> tuple[list[tuple], str]:
    body: list[tuple] = []
    for kind, value in pieces:
        if kind == "text":
            if value:
                body.append(("text", value))
        elif kind == "out":
            body.append(("out", _Expression(value).parse()))
        else:
            word, _, rest = value.partition(" ")
            if word in ends:
                return body, value
            if word == "for":
                m = re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+(.+)", rest.strip(), re.S)
                if not m:
                    raise TemplateError(f"bad loop {value!r}")
                body.append(("for", m[1], _Expression(m[2]).parse(), _block(pieces, ("endfor",))[0]))
            elif word == "generation":
                body.append(("generation", _block(pieces, ("endgeneration",))[0]))
            elif word == "if":
                cases, test = [], _Expression(rest).parse()
                while True:
                    inner, end = _block(pieces, ("elif", "else", "endif"))
                    cases.append((test, inner))
                    if end == "endif":
                        break
                    test = ("const", True) if end == "else" else _Expression(end.partition(" ")[2]).parse()
                body.append(("if", cases))
            else:
                raise TemplateError(f"unexpected tag {value!r}")
    if ends:
        raise TemplateError(f"missing {ends[-1]}")
    return body, ""


# ---- folding

def _text(value) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


def _apply(op: str, left, right):
    if op == "==":
        return left == right
    if op == "!=":
        return left != right
    if op == "in":
        return _text(left) in _text(right)
    return left + right if isinstance(left, int) and isinstance(right, int) else _text(left) + _text(right)


def _fold_expression(tree: tuple, known: dict) -> tuple:
    kind = tree[0]
    if kind == "name" and tree[1] in known:
        return ("const", known[tree[1]])
    if kind == "filter":
        inner = _fold_expression(tree[2], known)
        return ("const", FILTERS[tree[1]](_text(inner[1]))) if inner[0] == "const" else ("filter", tree[1], inner)
    if kind == "field":
        return ("field", tree[1], _fold_expression(tree[2], known))
    if kind == "not":
        inner = _fold_expression(tree[1], known)
        return ("const", not inner[1]) if inner[0] == "const" else ("not", inner)
    if kind == "binary":
        op, left, right = tree[1], _fold_expression(tree[2], known), _fold_expression(tree[3], known)
        if op in ("and", "or") and left[0] == "const":
            return right if bool(left[1]) == (op == "and") else left
        if op not in ("and", "or") and left[0] == right[0] == "const":
            return ("const", _apply(op, left[1], right[1]))
        return ("binary", op, left, right)
    return tree


def fold(tree: list[tuple], known: dict) -> list[tuple]:
    """The same template with constants computed, dead branches gone and neighbouring texts joined."""
    out: list[tuple] = []
    for node in tree:
        if node[0] == "out":
            inner = _fold_expression(node[1], known)
            new = [("text", _text(inner[1]))] if inner[0] == "const" else [("out", inner)]
        elif node[0] == "for":
            inside = {k: v for k, v in known.items() if k not in (node[1], "loop")}
            new = [("for", node[1], _fold_expression(node[2], known), fold(node[3], inside))]
        elif node[0] == "generation":
            new = [("generation", fold(node[1], known))]
        elif node[0] == "if":
            cases = []
            for test, body in node[1]:
                test = _fold_expression(test, known)
                if test[0] == "const" and not test[1]:
                    continue
                cases.append((test, fold(body, known)))
                if test[0] == "const":
                    break
            new = cases[0][1] if cases and cases[0][0][0] == "const" else [("if", cases)] if cases else []
        else:
            new = [node]
        for item in new:
            if item[0] == "text" and out and out[-1][0] == "text":
                out[-1] = ("text", out[-1][1] + item[1])
            elif item != ("text", ""):
                out.append(item)
    return out


# ---- closures

def _value_closure(tree: tuple) -> Callable[[dict], object]:
    kind = tree[0]
    if kind == "const":
        return lambda env, value=tree[1]: value
    if kind == "name":
        return lambda env, name=tree[1]: env.get(name)
    if kind == "field":
        inner = _value_closure(tree[2])

        def field(env, name=tree[1]):
            value = inner(env)
            return value.get(name) if isinstance(value, dict) else None
        return field
    if kind == "filter":
        inner, change = _value_closure(tree[2]), FILTERS[tree[1]]
        return lambda env: change(_text(inner(env)))
    if kind == "not":
        inner = _value_closure(tree[1])
        return lambda env: not inner(env)
    op, left, right = tree[1], _value_closure(tree[2]), _value_closure(tree[3])
    if op == "and":
        return lambda env: left(env) and right(env)
    if op == "or":
        return lambda env: left(env) or right(env)
    return lambda env: _apply(op, left(env), right(env))


Chunks = Iterator[tuple[str, bool]]


def _body_closure(tree: list[tuple]) -> Callable[[dict, bool], Chunks]:
    steps = [_step_closure(node) for node in tree]

    def body(env: dict, trained: bool) -> Chunks:
        for step in steps:
            yield from step(env, trained)
    return body


def _step_closure(node: tuple) -> Callable[[dict, bool], Chunks]:
    kind = node[0]
    if kind == "text":
        return lambda env, trained, text=node[1]: ((text, trained),)
    if kind == "out":
        value = _value_closure(node[1])
        return lambda env, trained: ((_text(value(env)), trained),)
    if kind == "generation":
        inner = _body_closure(node[1])
        return lambda env, trained: inner(env, True)
    if kind == "if":
        cases = [(_value_closure(test), _body_closure(body)) for test, body in node[1]]

        def choose(env: dict, trained: bool) -> Chunks:
            for test, body in cases:
                if test(env):
                    return body(env, trained)
            return iter(())
        return choose
    name, items, body = node[1], _value_closure(node[2]), _body_closure(node[3])

    def loop(env: dict, trained: bool) -> Chunks:
        rest, index, missing = iter(items(env) or ()), 0, object()
        item = next(rest, missing)
        while item is not missing:
            following = next(rest, missing)
            inside = {**env, name: item,
                      "loop": {"index": index + 1, "first": index == 0, "last": following is missing}}
            yield from body(inside, trained)
            item, index = following, index + 1
    return loop


def compile_template(source: str, constants: dict | None = None) -> Callable[[Iterable[dict]], Chunks]:
    """``render(messages)`` yields (text, whether it is trained on); messages may be an iterator."""
    body = _body_closure(fold(parse(source), constants or {}))
    return lambda messages: body({"messages": messages}, False)
