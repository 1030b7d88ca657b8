"""Record transforms, in the order a sync applies them: exclude, map, normalise, key, hash."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import records as R


@dataclass(frozen=True)
class Field:
    """target is filled from the dotted path ``source``, cast to ``kind``, or gets ``default``."""

    target: str
    source: str
    kind: str = "str"
    default: Any = None


def exclude_fields(df: DataFrame, patterns: list[str]) -> DataFrame:
    """Drop the fields whose bare names match a pattern, inside structs too; arrays are not entered."""
    regexes = [re.compile(R.glob_regex(p).replace(r"\z", r"\Z")) for p in patterns]
    gone = lambda name: any(r.match(name) for r in regexes)

    def prune(column: Column, kind: T.DataType) -> Column:
        if not isinstance(kind, T.StructType):
            return column
        return F.struct(*[prune(column[f.name], f.dataType).alias(f.name) for f in kind if not gone(f.name)])

    return df.select(*[prune(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema if not gone(f.name)])


JSON_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"|[{}\[\]:,]|[^\s{}\[\]:,"]+')


def _without(text: str, gone: re.Pattern[str]) -> str:
    """A JSON text without the members whose names match; numbers and strings stay as they are written, blanks go.

    A list is copied whole. The nesting is kept on a stack of its own, so it may be as deep as it likes.
    """
    out: list[str] = []
    open_: list[str] = []
    lists, leaving = 0, None  # lists around the token, and the depth at which a member is left out
    tokens = JSON_TOKEN.findall(text)
    for token, after in zip(tokens, [*tokens[1:], ""]):
        if token in ("}", "]"):
            if leaving == len(open_):
                leaving = None
            lists -= open_.pop() == "["
            if leaving is None:
                if out[-1] == ",":
                    out.pop()
                out.append(token)
        elif leaving == len(open_) and token == ",":
            leaving = None
        elif leaving is None and not lists and after == ":" and gone.match(json.loads(token)):
            leaving = len(open_)
        elif leaving is None:
            out.append(token)
        if token in ("{", "["):
            open_.append(token)
            lists += token == "["
    return "".join(out)


def exclude_in_payload(payload: Column, patterns: list[str]) -> Column:
    """A JSON text without the fields whose bare names match a pattern, at every depth of objects; lists are not entered.

    What is no JSON stays as it is, and so does null.
    """
    gone = re.compile("|".join(R.glob_regex(p).replace(r"\z", r"\Z") for p in patterns) or r"(?!)")

    @F.arrow_udf("string")
    def excluded(texts: pa.Array) -> pa.Array:
        return pa.array([t if t is None or not _is_json(t) else _without(t, gone) for t in texts.to_pylist()], pa.string())

    return excluded(payload)


def _is_json(text: str) -> bool:
    try:
        json.loads(text)
    except RecursionError:  # too deep for the parser, not for the scan
        return True
    except ValueError:
        return False
    return True


def map_fields(df: DataFrame, payload: str, fields: list[Field], strict: bool = True, keep: list[str] = ()) -> DataFrame:
    """Columns made from a JSON payload; if not strict, ``rest`` holds its unmapped top-level fields as JSON, values as they are."""
    made = [R.cast_or_default(R.dot_path(F.col(payload), f.source), f.kind, f.default).alias(f.target) for f in fields]
    if not strict:
        used = [R.path_steps(f.source)[0][0] for f in fields]
        entries = F.from_json(F.col(payload), "map<string,variant>")
        made.append(F.to_json(F.map_filter(entries, lambda k, _: ~k.isin(used))).alias("rest"))
    return df.select(*keep, *made)


def redact(df: DataFrame, fields: list[str], mark: str = "[REDACTED]") -> DataFrame:
    """Listed fields that hold a value show only a mark."""
    return df.withColumns({f: F.when(F.col(f).isNotNull(), F.lit(mark)) for f in fields if f in df.columns})


def rename_fields(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def strip_meta(df: DataFrame, prefix: str = "__") -> DataFrame:
    return df.select(*[c for c in df.columns if not c.startswith(prefix)])


def stamp_lineage(df: DataFrame, run_id: str, at: str, path: str, watermark: str | None, page: Column) -> DataFrame:
    """Where a record came from, as JSON."""
    stamp = F.struct(F.lit(run_id).alias("run"), F.lit(at).alias("at"), F.lit(path).alias("path"), F.lit(watermark).alias("watermark"), page.alias("page"))
    return df.withColumn("_lineage", F.to_json(stamp, {"ignoreNullFields": "false"}))


def payload_of(df: DataFrame) -> DataFrame:
    """The payload column if there is one (missing: an empty object), else the columns that are not bookkeeping."""
    if "data" in df.columns:
        return df.withColumn("data", F.coalesce("data", F.lit("{}")))
    return df.select(*[c for c in df.columns if not c.startswith("_")])


def add_reference(payload: Column, name: str, value: Column) -> Column:
    """A JSON object with one more text field; an earlier field of that name is replaced, other values stay as they are."""
    entries = F.map_filter(F.from_json(payload, "map<string,variant>"), lambda k, _: k != name)
    return F.to_json(F.map_concat(entries, F.create_map(F.lit(name), value.cast("variant"))))


def interpolate(template: str, **values: Column) -> Column:
    out = F.lit(template)
    for name, value in values.items():
        out = F.replace(out, F.lit("${" + name + "}"), F.coalesce(value.cast("string"), F.lit("")))
    return out
