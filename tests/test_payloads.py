"""Payload rewriting and paths."""

import json
import random

import pytest
from pyspark.sql import functions as F

from concord.functions import records as R
from concord.operators import transform


def pruned(value, gone):
    if isinstance(value, dict):
        return {k: pruned(v, gone) for k, v in value.items() if not gone(k)}
    return value


def made(rnd, depth=4):
    r = rnd.random()
    if depth == 0 or r < 0.3:
        return rnd.choice([1, 2.5, "x", 'q"},{', "a:b", None, True, "", [], {}])
    if r < 0.5:
        return [made(rnd, depth - 1) for _ in range(rnd.randint(0, 3))]
    return {rnd.choice(["secret", "c_1", "name", "a,b", 'k"', "ä"]) : made(rnd, depth - 1) for _ in range(rnd.randint(0, 4))}


def test_exclusion_equals_plain_pruning(spark):
    rnd = random.Random(3)
    docs = [made(rnd) for _ in range(400)]
    table = spark.createDataFrame([(k, json.dumps(d)) for k, d in enumerate(docs)], "k int, p string")
    rows = table.select("k", transform.exclude_in_payload(F.col("p"), ["secret", "c_*", "k?"]).alias("p")).orderBy("k").collect()
    for r in rows:
        assert json.loads(r.p) == pruned(docs[r.k], lambda n: n == "secret" or n.startswith("c_") or (len(n) == 2 and n[0] == "k"))


def test_exclusion_keeps_texts_as_they_are(spark):
    rows = [('{ "a" : 1.50 , "b":12345678901234567890, "s":1 }',), ("no json",), (None,), ("[1]",), ('{"s":' + '{"a":' * 3000 + "1" + "}" * 3001,), ("",)]
    found = [r[0] for r in spark.createDataFrame(rows, "p string").select(transform.exclude_in_payload(F.col("p"), ["s"])).collect()]
    assert found == ['{"a":1.50,"b":12345678901234567890}', "no json", None, "[1]", "{}", ""]
    assert spark.createDataFrame(rows[:1], "p string").select(transform.exclude_in_payload(F.col("p"), [])).first()[0] == '{"a":1.50,"b":12345678901234567890,"s":1}'


def test_paths_with_dots_and_quotes(spark):
    table = spark.createDataFrame([("""{"a.b":{"c":[1,{"it's":"x"}]},"q\\"s":2,"why?":3}""",)], "p string")
    paths = {'"a.b".c[0]': "1", '"a.b".c[1]."it\'s"': "x", '"q\\"s"': "2", "why?": "3", '"a.b".nothing': None, '"a.b".c[1]': '{"it\'s":"x"}', "it's": None}
    row = table.select(*[R.dot_path(F.col("p"), p) for p in paths]).first()
    assert list(row) == list(paths.values())
    for bad in ("", "a.", ".a", "a..b", "a[", "a]b", "a[x]", '"a', "a[0]b"):
        with pytest.raises(ValueError):
            R.path_steps(bad)
