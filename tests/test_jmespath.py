"""Compiled JMESPath expressions against written results and a plain evaluator."""

import json
import random
import time

import pytest
from pyspark.sql import functions as F

from concord.functions import jmespath as jp

DOC = {
    "a": {"b": {"c": "deep"}, "b c": 1, "d.e": 2, "q'r": 3, "both'\"": 4},
    "list": [{"n": 1, "s": "x", "t": ["p", "q"]}, {"n": 2, "s": None, "t": []}, {"n": 3, "s": "z"}, None, 7],
    "nested": [[1, 2], [3, [4]], 5, None], "nums": [4, 1, 3.5, 2], "words": ["pear", "fig", "apple"],
    "zero": 0, "empty": "", "none": None, "yes": True, "no": False, "o": {"k1": {"v": 1}, "k2": {"v": 2}, "k3": {"w": 3}},
}

CASES = {
    "a.b.c": "deep", 'a."b c"': 1, 'a."d.e"': 2, "a.\"q'r\"": 3, 'a."both\'\\""': 4, "list[0].n": 1, "list[-1]": 7, "list[9]": None, "missing.x": None,
    "list[*].n": [1, 2, 3], "list[*].s": ["x", "z"], "list[*].t[0]": ["p"], "list[].t[]": ["p", "q"], "list[*].t[]": ["p", "q"], "nested[]": [1, 2, 3, [4], 5], "nested[][]": [1, 2, 3, 4, 5],
    "nums[1:3]": [1, 3.5], "nums[::-1]": [2, 3.5, 1, 4], "nums[-2:]": [3.5, 2], "nums[:-1:2]": [4, 3.5], "nums[10:]": [], "nums[5:0:-2]": [2, 1], "nums[1:3] | [0]": 1,
    "list[?n > `1`].s": ["z"], "list[?s == 'x'].n": [1], "list[?n].n | [1]": 2, "list[?t && n < `2`].n": [1], "list[?!t].n": [2, 3], "words[?contains(@, 'p')]": ["pear", "apple"],
    "o.*.v": [1, 2], "*.k1.v": [1], "o.[k1.v, k2.v]": [1, 2], "o.{x: k1.v, y: nothing}": {"x": 1, "y": None}, "list[*].{i: n, f: t[0]}": [{"i": 1, "f": "p"}, {"i": 2, "f": None}, {"i": 3, "f": None}, {"i": None, "f": None}],
    "none || zero": 0, "empty || 'd'": "d", "yes && zero": 0, "no && zero": False, "!none": True, "!zero": False, "`1` == `1.0`": True, "none == missing": True, "words[0] < `1`": None, "a != o": True,
    "length(words)": 3, "length(a.b)": 1, "length('äb')": 2, "keys(o)": ["k1", "k2", "k3"], "values(o)[*].v": [1, 2], "sort(nums)": [1, 2, 3.5, 4], "sort_by(list[:3], &n)[-1].n": 3,
    "max(nums)": 4, "min(words)": "apple", "max_by(list[:3], &n).n": 3, "sum(nums)": 10.5, "avg(nums[1:2])": 1, "join('-', words)": "pear-fig-apple", "reverse(words)[0]": "apple", "reverse('abc')": "cba",
    "to_string(a.b)": '{"c":"deep"}', "to_number('12')": 12, "type(o)": "object", "type(none)": "null", "not_null(none, missing, zero)": 0, "map(&n, list[:2])": [1, 2], "merge(o.k1, o.k3)": {"v": 1, "w": 3},
    "to_array(zero)": [0], "starts_with(words[0], 'pe')": True, "ends_with(words[0], 'x')": False, "abs(`-2`)": 2, "ceil(`1.2`)": 2, "floor(`1.8`)": 1, "@.zero": 0, "(list)[0].n": 1, "list[0].[n, s] | [1]": "x",
}


def found(spark, docs, expressions):
    table = spark.createDataFrame([(k, json.dumps(d)) for k, d in enumerate(docs)], "k int, p string")
    rows = table.select("k", *[F.to_json(jp.search(F.col("p"), e)).alias(f"c{i}") for i, e in enumerate(expressions)]).orderBy("k").collect()
    return [[None if x is None else json.loads(x) for x in r[1:]] for r in rows]


def test_long_lists_take_time_in_proportion(spark):
    def seconds(n):
        table = spark.range(1).select(F.to_json(F.struct(F.sequence(F.lit(1), F.lit(n)).alias("l"))).alias("p"))
        sliced = [F.size(jp.items(jp.search(F.col("p"), e))) for e in ("l[1:]", "l[:-1]", "l[::-1]")]
        at = time.monotonic()
        assert tuple(table.select(*sliced).first()) == (n - 1, n - 1, n)
        return time.monotonic() - at

    seconds(10)
    assert seconds(12_000) < 5 + 3 * seconds(3_000)


def test_written_results(spark):
    names = list(CASES)
    for part in (names[k : k + 20] for k in range(0, len(names), 20)):
        for name, got in zip(part, found(spark, [DOC], part)[0]):
            assert got == CASES[name], name


def test_scalars_arrays_and_broken_texts(spark):
    table = spark.createDataFrame([("[1,2]",), ("3",), ("{",), (None,), ("null",)], "p string")
    assert [r[0] for r in table.select(jp.search_text(F.col("p"), "[0]")).collect()] == ["1", None, None, None, None]
    assert [r[0] for r in table.select(jp.search_text(F.col("p"), "@")).collect()] == ["[1,2]", "3", None, None, None]


@pytest.mark.parametrize("text", ["", "a.", "a[", "a[?b", "[a", "{a}", "a b", "a[1:2:0]", "a[1 2]", "f(", "a.#", "1(2)", "nothing(@)", "foo.`1`"])
def test_what_is_no_expression_is_refused(spark, text):
    with pytest.raises(ValueError):
        jp.search(F.lit("{}"), text)


def false(v):
    return v is None or v is False or v == "" or v == [] or v == {}


def plain(node, v):
    """The node's value by plain Python."""
    kind, *rest = node
    is_number = lambda x: isinstance(x, (int, float)) and not isinstance(x, bool)
    if kind == "self":
        return v
    if kind == "field":
        return v.get(rest[0]) if isinstance(v, dict) else None
    if kind == "index":
        return v[rest[0]] if isinstance(v, list) and -len(v) <= rest[0] < len(v) else None
    if kind == "literal":
        return rest[0]
    if kind == "sub":
        return plain(rest[1], plain(rest[0], v))
    if kind == "slice":
        x = plain(rest[0], v)
        return x[slice(*rest[1:])] if isinstance(x, list) else None
    if kind == "flatten":
        x = plain(rest[0], v)
        return [y for e in x for y in (e if isinstance(e, list) else [e])] if isinstance(x, list) else None
    if kind == "keep":
        x = plain(rest[0], v)
        return [e for e in x if not false(plain(rest[1], e))] if isinstance(x, list) else None
    if kind in ("project", "values"):
        x = plain(rest[0], v)
        x = [x[k] for k in sorted(x)] if kind == "values" and isinstance(x, dict) else x if kind == "project" else None
        return [y for e in x if (y := plain(rest[1], e)) is not None] if isinstance(x, list) else None
    if kind == "list":
        return None if v is None else [plain(n, v) for n in rest[0]]
    if kind == "members":
        return None if v is None else {k: plain(n, v) for k, n in rest[0]}
    if kind == "not":
        return false(plain(rest[0], v))
    if kind in ("or", "and"):
        x = plain(rest[0], v)
        return x if false(x) == (kind == "and") else plain(rest[1], v)
    if kind == "compare":
        sign, a, b = rest[0], plain(rest[1], v), plain(rest[2], v)
        if sign in ("==", "!="):
            return (a == b and isinstance(a, bool) == isinstance(b, bool)) == (sign == "==")
        return {"<": a < b, "<=": a <= b, ">": a > b, ">=": a >= b}[sign] if is_number(a) and is_number(b) else None
    if kind == "call":
        a = [plain(n, v) for n in rest[1]]
        if rest[0] == "length":
            return len(a[0]) if isinstance(a[0], (str, list, dict)) else None
        if rest[0] == "type":
            return "null" if a[0] is None else "boolean" if isinstance(a[0], bool) else {int: "number", float: "number", str: "string", list: "array", dict: "object"}[type(a[0])]
    raise AssertionError(node)


def made_expression(rnd, depth=3):
    def part(d):
        r = rnd.random()
        if d == 0 or r < 0.25:
            return rnd.choice(["a", "b", "c", '"x y"', "@"])
        if r < 0.45:
            return part(d - 1) + rnd.choice([".a", ".b", '."x y"', "[0]", "[-1]"])
        if r < 0.65:
            return part(d - 1) + rnd.choice(["[*]", "[]", "[1:]", "[::-2]", "[:-1]", ".*"]) + rnd.choice(["", ".a", ".b", "[0]", ".[a, b]", ".{k: c}"])
        if r < 0.78:
            return f"{part(d - 1)}[?{part(d - 1)} {rnd.choice(['==', '!=', '<', '>='])} {rnd.choice(['`1`', '`null`', chr(39) + 's' + chr(39), 'b'])}]" + rnd.choice(["", ".a", " | [0]"])
        if r < 0.9:
            return f"({part(d - 1)} {rnd.choice(['||', '&&', '|', '=='])} {part(d - 1)})"
        return rnd.choice([f"length({part(d - 1)})", f"type({part(d - 1)})", f"!{part(0)}"])

    return part(depth)


def made_doc(rnd, depth=3):
    r = rnd.random()
    if depth == 0 or r < 0.25:
        return rnd.choice([None, True, False, 0, 1, 2, "s", "", "t"])
    if r < 0.6:
        return [made_doc(rnd, depth - 1) for _ in range(rnd.randint(0, 4))]
    return {k: made_doc(rnd, depth - 1) for k in rnd.sample(["a", "b", "c", "x y"], rnd.randint(0, 4))}


def same(a, b):
    if isinstance(a, bool) or isinstance(b, bool):
        return a is b
    if isinstance(a, list) and isinstance(b, list):
        return len(a) == len(b) and all(map(same, a, b))
    if isinstance(a, dict) and isinstance(b, dict):
        return a.keys() == b.keys() and all(same(a[k], b[k]) for k in a)
    return a == b


def test_random_expressions_equal_the_plain_evaluator(spark):
    rnd = random.Random(11)
    docs = [made_doc(rnd, 4) for _ in range(40)] + [DOC]
    checked = 0
    for _ in range(3):
        expressions = [made_expression(rnd) for _ in range(12)]
        for doc, row in zip(docs, found(spark, docs, expressions)):
            for e, got in zip(expressions, row):
                wanted = plain(jp.parse(e), doc)
                assert same(got, wanted), (e, doc, got, wanted)
                checked += wanted is not None
    assert checked > 100
