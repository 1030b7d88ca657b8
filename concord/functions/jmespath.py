"""JMESPath expressions compiled into Column expressions over VARIANT.

``search(payload, expression)`` gives the value that a JMESPath expression has on a JSON payload, as a VARIANT; JSON null and a missing
value are both null. Fields, indexes, slices, projections, flattening, filters, pipes, multi-selects, comparisons, boolean operators,
literals and the functions of ``FUNCTIONS`` become built-in functions, so nothing leaves the JVM.

What differs from a plain evaluator: members of an object come in the order of their names, numbers compare as doubles, and a value of the
wrong kind gives null where the language has an error. Inside arrays and objects, 1 and 1.0 are different values.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

Node = tuple
TOKEN = re.compile(r"""\s*(?:(?P<name>[A-Za-z_][A-Za-z0-9_]*)|(?P<quoted>"(?:[^"\\]|\\.)*")|(?P<raw>'(?:[^'\\]|\\.)*')|(?P<literal>`(?:[^`\\]|\\.)*`)|(?P<number>-?\d+)
  |(?P<sign>\[\?|\[\]|\|\||&&|==|!=|<=|>=|[\[\]{}().,:|*@!&<>]))""", re.X)
COMPARISONS = ("==", "!=", "<", "<=", ">", ">=")
# How strongly a sign holds what stands left of it.
BINDING = {"|": 1, "||": 2, "&&": 3, **dict.fromkeys(COMPARISONS, 5), "[]": 9, "*": 20, "[?": 21, ".": 40, "!": 45, "{": 50, "[": 55, "(": 60}
PROJECTION_ENDS = 10
SELF: Node = ("self",)


class _Parser:
    def __init__(self, text: str):
        self.tokens: list[tuple[str, Any]] = []
        at = 0
        text = text.rstrip()
        while at < len(text):
            found = TOKEN.match(text, at)
            if not found:
                raise ValueError(f"no JMESPath expression at {text[at:]!r}")
            kind, value, at = found.lastgroup, found[found.lastgroup], found.end()
            if kind in ("quoted", "number"):
                value = json.loads(value)
            elif kind == "raw":
                value = re.sub(r"\\(['\\])", r"\1", value[1:-1])
            elif kind == "literal":
                value = json.loads(value[1:-1].replace("\\`", "`"))
            self.tokens.append((value, None) if kind == "sign" else (kind, value))
        self.tokens.append(("end", None))
        self.at = 0

    def kind(self, ahead: int = 0) -> str:
        return self.tokens[min(self.at + ahead, len(self.tokens) - 1)][0]

    def take(self, *kinds: str) -> Any:
        kind, value = self.tokens[self.at]
        if kinds and kind not in kinds:
            raise ValueError(f"{kinds[0]!r} expected, not {value if value is not None else kind!r}")
        self.at += 1
        return value

    def whole(self) -> Node:
        node = self.expression(0)
        self.take("end")
        return node

    def expression(self, strength: int) -> Node:
        left = self.prefix()
        while strength < BINDING.get(self.kind(), 0):
            left = self.infix(left)
        return left

    def prefix(self) -> Node:
        kind = self.kind()
        if kind in ("name", "quoted"):
            return ("field", self.take())
        if kind in ("raw", "literal"):
            return ("literal", self.take())
        if kind == "*":
            self.take()
            return ("values", SELF, self.projected(BINDING["*"]))
        if kind == "@":
            self.take()
            return SELF
        if kind == "!":
            self.take()
            return ("not", self.expression(BINDING["!"]))
        if kind == "&":
            self.take()
            return ("reference", self.expression(0))
        if kind == "(":
            self.take()
            inner = self.expression(0)
            self.take(")")
            return inner
        if kind == "{":
            return self.members()
        if kind == "[" and self.kind(1) not in ("number", ":") and (self.kind(1), self.kind(2)) != ("*", "]"):
            return self.elements()
        if kind in ("[", "[]", "[?"):
            return self.bracket(SELF)
        raise ValueError(f"a value expected, not {kind!r}")

    def infix(self, left: Node) -> Node:
        kind = self.kind()
        if kind in ("[", "[]", "[?"):
            return self.bracket(left)
        self.take()
        if kind == ".":
            if self.kind() == "*":
                self.take()
                return ("values", left, self.projected(BINDING["*"]))
            return ("sub", left, self.after_dot(BINDING["."]))
        if kind == "(":
            if left[0] != "field":
                raise ValueError("only a name can be called")
            return ("call", left[1], self.arguments())
        if kind in COMPARISONS:
            return ("compare", kind, left, self.expression(BINDING[kind]))
        if kind in ("|", "||", "&&"):
            return ({"|": "sub", "||": "or", "&&": "and"}[kind], left, self.expression(BINDING[kind]))
        raise ValueError(f"{kind!r} can't follow a value")

    def bracket(self, left: Node) -> Node:
        kind = self.kind()
        self.take()
        if kind == "[]":
            return ("project", ("flatten", left), self.projected(BINDING["[]"]))
        if kind == "[?":
            condition = self.expression(0)
            self.take("]")
            return ("project", ("keep", left, condition), SELF if self.kind() == "[]" else self.projected(BINDING["[?"]))
        if self.kind() == "*":
            self.take()
            self.take("]")
            return ("project", left, self.projected(BINDING["*"]))
        parts: list[int | None] = [None]
        while self.kind() in ("number", ":"):
            if self.kind() == ":":
                self.take()
                parts.append(None)
            elif parts[-1] is None:
                parts[-1] = self.take()
            else:
                break
        self.take("]")
        if len(parts) == 1:
            return ("sub", left, ("index", parts[0]))
        if len(parts) > 3 or (len(parts) == 3 and parts[2] == 0):
            raise ValueError("a slice has a start, an end and a step other than 0")
        return ("project", ("slice", left, *[*parts, None][:3]), self.projected(BINDING["*"]))

    def projected(self, strength: int) -> Node:
        """What is done with each item of a projection."""
        kind = self.kind()
        if BINDING.get(kind, 0) < PROJECTION_ENDS:
            return SELF
        if kind in ("[", "[?"):
            return self.expression_from(SELF, strength)
        if kind == ".":
            return self.expression_from(SELF, strength)
        raise ValueError(f"{kind!r} can't follow a projection")

    def expression_from(self, left: Node, strength: int) -> Node:
        while strength < BINDING.get(self.kind(), 0):
            left = self.infix(left)
        return left

    def after_dot(self, strength: int) -> Node:
        if self.kind() in ("name", "quoted", "*"):
            return self.expression(strength)
        if self.kind() == "[":
            return self.elements()
        if self.kind() == "{":
            return self.members()
        raise ValueError("a name, a list or members expected behind '.'")

    def elements(self) -> Node:
        self.take("[")
        nodes = [self.expression(0)]
        while self.kind() == ",":
            self.take()
            nodes.append(self.expression(0))
        self.take("]")
        return ("list", nodes)

    def members(self) -> Node:
        self.take("{")
        nodes = []
        while True:
            name = self.take("name", "quoted")
            self.take(":")
            nodes.append((name, self.expression(0)))
            if self.kind() != ",":
                break
            self.take()
        self.take("}")
        return ("members", nodes)

    def arguments(self) -> list[Node]:
        nodes = []
        while self.kind() != ")":
            nodes.append(self.expression(0))
            if self.kind() != ")":
                self.take(",")
        self.take(")")
        return nodes


def parse(expression: str) -> Node:
    """The expression as nested tuples; a ValueError says where it can't be read."""
    return _Parser(expression).whole()


# values


def variant(value: Column) -> Column:
    return value.cast("variant")


def _nothing() -> Column:
    return F.lit(None).cast("variant")


def known(value: Column) -> Column:
    """JSON null as null."""
    return F.when(~F.is_variant_null(value), value)


def kind_of(value: Column) -> Column:
    """number, string, boolean, array or object; null for null."""
    # the schema walks all of a value, so it is made once
    return _let(F.schema_of_variant(value), lambda name: (
        F.when(F.regexp_like(name, F.lit("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")), "number")
        .when(name == "STRING", "string").when(name == "BOOLEAN", "boolean")
        .when(name.startswith("ARRAY"), "array").when(name.startswith("OBJECT"), "object")
    ))


def items(value: Column) -> Column:
    """The array's elements, null for anything else."""
    return F.try_variant_get(value, "$", "array<variant>")


def number(value: Column) -> Column:
    return F.when(kind_of(value) == "number", F.try_variant_get(value, "$", "double"))


def string(value: Column) -> Column:
    return F.when(kind_of(value) == "string", F.try_variant_get(value, "$", "string"))


def text(value: Column) -> Column:
    """A string as it is, everything else as JSON, null for null."""
    return F.coalesce(string(value), F.to_json(value))


def _number_value(value: Column) -> Column:
    """A double as a whole number where it is one."""
    whole = (value == F.floor(value)) & (F.abs(value) < 2**53)
    return F.when(whole, variant(value.cast("long"))).otherwise(variant(value))


def _array_value(elements: Column) -> Column:
    return _let(elements, lambda e: F.when(e.isNotNull(), F.to_variant_object(e)))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that it uses more than once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def truthy(value: Column) -> Column:
    return F.coalesce(~F.to_json(value).isin("false", '""', "[]", "{}"), F.lit(False))


def _equal(a: Column, b: Column) -> Column:
    return F.when(a.isNull() | b.isNull(), a.isNull() & b.isNull()).otherwise(F.coalesce(number(a) == number(b), F.to_json(a) == F.to_json(b)))


def _member(value: Column, name: str) -> Column:
    if "'" in name and '"' in name:
        return known(F.try_element_at(F.try_variant_get(value, "$", "map<string,variant>"), F.lit(name)))
    mark = '"' if "'" in name else "'"
    return known(F.try_variant_get(value, f"$[{mark}{name}{mark}]", "variant"))


def _sliced(elements: Column, start: int | None, end: int | None, step: int) -> Column:
    """``elements`` must be bound (see ``_let``): their size is asked for at each of them."""
    n = F.size(elements)
    place = lambda k: F.lit(k) if k >= 0 else n + k
    if step > 0:
        low, high = F.greatest(place(start or 0), F.lit(0)), F.least(n if end is None else place(end), n)
        if step == 1:
            return F.slice(elements, low + 1, F.greatest(high - low, F.lit(0)))
        return F.filter(elements, lambda _, i: (i >= low) & (i < high) & ((i - low) % step == 0))
    high = n - 1 if start is None else F.least(place(start), n - 1)
    low = F.lit(-1) if end is None else place(end)
    return F.reverse(F.filter(elements, lambda _, i: (i <= high) & (i > low) & ((high - i) % -step == 0)))


def _ordered(elements: Column, key: Callable[[Column], Column]) -> Column:
    """Elements in the order of numbers or strings."""

    def compare(a, b):
        x, y = key(a), key(b)
        less = F.coalesce(number(x) < number(y), string(x) < string(y), F.lit(False))
        more = F.coalesce(number(x) > number(y), string(x) > string(y), F.lit(False))
        return F.when(less, -1).when(more, 1).otherwise(0)

    return F.array_sort(elements, compare)


def _all_of_a_kind(elements: Column, key: Callable[[Column], Column]) -> Column:
    """The elements if their keys are all numbers or all strings."""
    return F.when(F.forall(elements, lambda e: number(key(e)).isNotNull()) | F.forall(elements, lambda e: string(key(e)).isNotNull()), elements)


def _folded(elements: Column) -> Column:
    """The sum of an array of numbers."""
    return F.when(F.forall(elements, lambda e: number(e).isNotNull()), F.aggregate(elements, F.lit(0.0), lambda s, e: s + number(e)))


def _contains(a: Column, b: Column) -> Column:
    def among(pair):  # bound, as each element is held against it
        x, y = pair["a"], pair["b"]
        return variant(F.when(kind_of(x) == "string", F.contains(string(x), string(y))).otherwise(F.exists(items(x), lambda e: F.coalesce(_equal(known(e), y), F.lit(False)))))

    return _let(F.struct(a.alias("a"), b.alias("b")), among)


def _length(a: Column) -> Column:
    size = F.coalesce(F.length(string(a)), F.size(items(a)), F.size(F.when(kind_of(a) == "object", F.try_variant_get(a, "$", "map<string,variant>"))))
    return variant(F.when(kind_of(a).isin("string", "array", "object"), size))


def _entries(a: Column) -> Column:
    return F.try_variant_get(a, "$", "map<string,variant>")


def _same(e: Column) -> Column:
    return e


def _edge(elements: Column, key: Callable[[Column], Column], last: bool) -> Column:
    return known(F.try_element_at(_ordered(_all_of_a_kind(elements, key), key), F.lit(-1 if last else 1)))


def _merged(*objects: Column) -> Column:
    out = _entries(objects[0])
    for o in map(_entries, objects[1:]):
        out = F.map_zip_with(out, o, lambda _, a, b: F.coalesce(b, a))
    return F.to_json(out)


#: Functions over values. Those with a reference (&expression) take it as a Python function.
FUNCTIONS: dict[str, Callable[..., Column]] = {
    "abs": lambda a: _number_value(F.abs(number(a))),
    "avg": lambda a: _number_value(F.when(F.size(items(a)) > 0, _folded(items(a)) / F.size(items(a)))),
    "ceil": lambda a: variant(F.ceil(number(a))),
    "contains": _contains,
    "ends_with": lambda a, b: variant(F.endswith(string(a), string(b))),
    "floor": lambda a: variant(F.floor(number(a))),
    "join": lambda a, b: variant(F.when(F.forall(items(b), lambda e: string(e).isNotNull()), F.call_function("array_join", F.transform(items(b), string), string(a)))),
    "keys": lambda a: _array_value(F.transform(F.map_keys(_entries(a)), variant)),
    "length": _length,
    "map": lambda f, a: _array_value(F.transform(items(a), lambda e: f(known(e)))),
    "max": lambda a: _edge(items(a), _same, True),
    "max_by": lambda a, f: _edge(items(a), f, True),
    "merge": lambda *a: F.try_parse_json(_merged(*a)),
    "min": lambda a: _edge(items(a), _same, False),
    "min_by": lambda a, f: _edge(items(a), f, False),
    "not_null": lambda *a: F.coalesce(*a),
    "reverse": lambda a: F.when(kind_of(a) == "string", variant(F.reverse(string(a)))).otherwise(_array_value(F.reverse(items(a)))),
    "sort": lambda a: _array_value(_ordered(_all_of_a_kind(items(a), _same), _same)),
    "sort_by": lambda a, f: _array_value(_ordered(_all_of_a_kind(items(a), f), f)),
    "starts_with": lambda a, b: variant(F.startswith(string(a), string(b))),
    "sum": lambda a: _number_value(_folded(items(a))),
    "to_array": lambda a: F.when(kind_of(a) == "array", a).otherwise(F.to_variant_object(F.array(a))),
    "to_number": lambda a: F.when(kind_of(a) == "number", a).otherwise(_number_value(string(a).try_cast("double"))),
    "to_string": lambda a: variant(F.coalesce(text(a), F.lit("null"))),
    "type": lambda a: variant(F.coalesce(kind_of(a), F.lit("null"))),
    "values": lambda a: _array_value(F.map_values(_entries(a))),
}


def build(node: Node, value: Column) -> Column:
    """The node's VARIANT on a VARIANT."""
    kind, *rest = node
    if kind == "self":
        return value
    if kind == "field":
        return _member(value, rest[0])
    if kind == "index":
        at = rest[0]
        return known(F.try_element_at(items(value), F.lit(at + 1 if at >= 0 else at)))
    if kind == "literal":
        return _nothing() if rest[0] is None else F.parse_json(F.lit(json.dumps(rest[0])))
    if kind == "sub":
        left, right = rest
        inner = build(left, value)
        return build(right, inner) if right[0] in ("self", "field", "index") else _let(inner, lambda x: build(right, x))
    if kind == "slice":
        left, start, end, step = rest
        return _let(build(left, value), lambda x: _array_value(_let(items(x), lambda elements: _sliced(elements, start, end, step or 1))))
    if kind == "flatten":
        return _let(build(rest[0], value), lambda x: _array_value(F.flatten(F.transform(items(x), lambda e: F.coalesce(items(e), F.array(e))))))
    if kind == "keep":
        left, condition = rest
        return _let(build(left, value), lambda x: _array_value(F.filter(items(x), lambda e: truthy(build(condition, known(e))))))
    if kind in ("project", "values"):
        left, right = rest
        each = items if kind == "project" else lambda x: F.map_values(_entries(x))
        return _let(build(left, value), lambda x: _array_value(F.filter(F.transform(each(x), lambda e: build(right, known(e))), lambda e: e.isNotNull())))
    if kind == "list":
        return F.when(value.isNotNull(), F.to_variant_object(F.array(*[build(n, value) for n in rest[0]])))
    if kind == "members":
        return F.when(value.isNotNull(), F.to_variant_object(F.struct(*[build(n, value).alias(name) for name, n in rest[0]])))
    if kind == "not":
        return variant(~truthy(build(rest[0], value)))
    if kind in ("or", "and"):
        left, right = (build(n, value) for n in rest)
        return _let(left, lambda x: F.when(truthy(x), x if kind == "or" else right).otherwise(right if kind == "or" else x))
    if kind == "compare":
        sign, left, right = rest
        pair = F.struct(build(left, value).alias("a"), build(right, value).alias("b"))

        def compared(p):
            a, b = p["a"], p["b"]
            if sign in ("==", "!="):
                same = _equal(a, b)
                return variant(same if sign == "==" else ~same)
            x, y = number(a), number(b)
            return variant({"<": x < y, "<=": x <= y, ">": x > y, ">=": x >= y}[sign])

        return _let(pair, compared)
    if kind == "call":
        name, arguments = rest
        if name not in FUNCTIONS:
            raise ValueError(f"no function {name!r}")
        made = [(lambda e, n=n[1]: build(n, known(e))) if n[0] == "reference" else build(n, value) for n in arguments]
        return FUNCTIONS[name](*made)
    raise ValueError(f"{kind!r} can't stand here")


def search(payload: Column, expression: str) -> Column:
    """The VARIANT that the expression has on a JSON text; null where the text is no JSON, or the value is missing or null."""
    node = parse(expression)
    return build(node, known(F.try_parse_json(payload)))


def search_text(payload: Column, expression: str) -> Column:
    """As ``search``; strings as they are, other values as JSON."""
    return _let(search(payload, expression), text)
