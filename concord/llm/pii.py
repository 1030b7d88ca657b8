"""Personal data: regular expressions propose spans, checksums confirm them, context adjusts the score.

Everything is a Spark expression over one row; no row leaves its partition. A pattern is applied twice, once for
its matches and once for the text between them, and offsets are running sums of the two, kept in blocks
so that a text with very many matches costs time in proportion to them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import text_or_empty

BLOCK = 500
CONTEXT, NEIGHBOURS = 48, 4
KEEP_FROM = 0.5
BONUS = 0.3


@dataclass(frozen=True)
class Kind:
    """pattern proposes; ``base`` kinds stay whatever their score; gate is a cheap test that any match passes."""

    name: str
    pattern: str
    score: float
    words: str
    gate: str
    base: bool = True
    valid: object = field(default=None)


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """True if a string of digits passes Luhn."""
    doubled = F.lit([0, 2, 4, 6, 8, 1, 3, 5, 7, 9])
    each = F.transform(
        F.sequence(F.lit(0), F.length(digits) - 1),
        lambda i: F.when(i % 2 == 0, F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int"))
        .otherwise(F.element_at(doubled, F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int") + 1)),
    )
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(code: Column) -> Column:
    """True if letters (as 10 to 35) and digits, four first characters moved to the end, are 1 modulo 97."""
    turned = F.concat(F.substring(code, F.lit(5), F.length(code)), F.substring(code, 1, 4))
    values = F.transform(
        F.sequence(F.lit(1), F.length(turned)),
        lambda i: F.when(F.substring(turned, i, F.lit(1)).rlike("[0-9]"), F.substring(turned, i, F.lit(1)).cast("int")).otherwise(F.ascii(F.substring(turned, i, F.lit(1))) - 55),
    )
    return F.aggregate(values, F.lit(0), lambda a, x: (a * F.when(x > 9, 100).otherwise(10) + x) % 97) == 1


def _card(m: Column) -> Column:
    d = _digits(m)
    return F.when(F.length(d).between(16, 19), luhn(d)).otherwise(False)


def _iban(m: Column) -> Column:
    code = F.replace(m, F.lit(" "), F.lit(""))
    return F.when(F.length(code).between(15, 34), mod97(code)).otherwise(False)


OCTET = r"0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
# Lookbehind and possessive quantifiers only spare attempts that cannot match; the spans are those of the plain patterns.
KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", 0.9, "mail|contact|write", "@"),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", 0.6, r"\bip\b|address|host|server", "[0-9]\\.[0-9]", valid=lambda m: m.rlike(rf"^{OCTET}(\.{OCTET}){{3}}$")),
    Kind("card", r"[0-9](?:[\x20-]?+[0-9])++", 0.8, "card|visa|credit|payment", "[0-9][0-9 -]{14}", valid=_card),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 0.7, "phone|tel|call|mobile|fax", r"\+[0-9]", valid=lambda m: F.length(_digits(m)).between(8, 15)),
    Kind("iban", r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?", 0.9, "iban|account|bank", "[A-Z]{2}[0-9]{2}", base=False, valid=_iban),
    Kind("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", 0.3, r"\bssn\b|social security|taxpayer", "[0-9]{3}-[0-9]{2}-[0-9]{4}", base=False),
)
SPAN = "struct<kind:string,start:bigint,end:bigint,score:double>"
FOUND = "array<struct<start:bigint,end:bigint,match:string,around:string>>"


def proposals(text: Column, pattern: str) -> Column:
    """Matches of ``pattern``, leftmost and non-overlapping: start, end (code points), match, text around it.

    Around are CONTEXT characters on either side, read through up to NEIGHBOURS other matches.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    n = F.lit(NEIGHBOURS)

    # one-element arrays give results a name, so that they are computed once
    def trimmed(x):
        return F.struct(x["found"].alias("m"), x["gaps"].alias("g"), F.transform(x["gaps"], lambda g: F.right(g, F.lit(CONTEXT))).alias("tails"), F.transform(x["gaps"], lambda g: F.left(g, F.lit(CONTEXT))).alias("heads"))

    def listed_matches(x):
        def around(i):
            first = F.greatest(i - n, F.lit(1))
            before = F.zip_with(F.slice(x["tails"], first, i - first), F.slice(x["m"], first, i - first), lambda t, m: F.concat(t, m))
            after = F.zip_with(F.slice(x["m"], i + 1, n), F.slice(x["heads"], i + 2, n), lambda m, h: F.concat(m, F.coalesce(h, F.lit(""))))
            left = F.right(F.concat(F.array_join(before, ""), F.element_at(x["tails"], i)), F.lit(CONTEXT))
            right = F.left(F.concat(F.element_at(x["heads"], i + 1), F.array_join(after, "")), F.lit(CONTEXT))
            return F.lower(F.concat_ws("\n", left, right))

        def one(m, k):
            return F.struct(F.length(F.get(x["g"], k)).cast("long").alias("gap"), F.length(m).cast("long").alias("len"), m.alias("match"), around(k + 1).alias("around"))

        return F.transform(x["m"], one)

    bound = F.transform(F.array(F.struct(found.alias("found"), gaps.alias("gaps"))), trimmed)
    pairs = F.element_at(F.transform(bound, listed_matches), 1)
    none = F.array().cast(FOUND)

    def step(a, x):
        start = a["at"] + x["gap"]
        return F.struct((start + x["len"]).alias("at"), F.concat(a["out"], F.array(F.struct(start.alias("start"), (start + x["len"]).alias("end"), x["match"].alias("match"), x["around"].alias("around")))).alias("out"))

    def block(p):
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(p) - 1) / BLOCK).cast("int")), lambda b: F.slice(p, b * BLOCK + 1, F.lit(BLOCK)))

    def fold(a, part):
        inner = F.aggregate(part, F.struct(a["at"].alias("at"), none.alias("out")), step)
        # a one-element array gives the inner result a name, so that it is computed once
        return F.element_at(F.transform(F.array(inner), lambda r: F.struct(r["at"].alias("at"), F.concat(a["parts"], F.array(r["out"])).alias("parts"))), 1)

    def spans(p):
        zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{FOUND}>").alias("parts"))
        return F.when(F.size(p) > 0, F.flatten(F.aggregate(block(p), zero, fold)["parts"])).otherwise(none)

    return F.element_at(F.transform(F.array(pairs), spans), 1)


def spans_of(text: Column, kind: Kind) -> Column:
    """Confirmed and scored spans of one kind."""
    gate = F.contains(text, F.lit(kind.gate)) if kind.gate == "@" else text.rlike(kind.gate)
    found = proposals(text, kind.pattern)
    if kind.valid is not None:
        found = F.filter(found, lambda x: kind.valid(x["match"]))
    scored = F.transform(found, lambda x: F.struct(F.lit(kind.name).alias("kind"), x["start"].alias("start"), x["end"].alias("end"), (F.lit(kind.score) + F.when(x["around"].rlike(kind.words), BONUS).otherwise(0.0)).alias("score")))
    scored = F.transform(scored, lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"), F.least(F.round(x["score"], 2), F.lit(1.0)).alias("score")))
    if not kind.base:
        scored = F.filter(scored, lambda x: x["score"] >= KEEP_FROM)
    return F.when(gate, scored).otherwise(F.array().cast(f"array<{SPAN}>"))


def find_personal_data(docs: DataFrame) -> DataFrame:
    """doc_id and one column of spans per kind: array of (kind, start, end, score), in order of start.

    The spans of email, ip, card and phone are those of their patterns and checks alone; iban and ssn are kept
    from a score of 0.5. Null text counts as empty and has no spans. Rows are treated one by one, so
    repeated rows give repeated results; an empty table gives an empty result; other columns are ignored. Texts of any length are
    read whole, in one row each.
    """
    text = docs.select("doc_id", text_or_empty().alias("text"))
    return text.select("doc_id", *[spans_of(F.col("text"), k).alias(k.name) for k in KINDS])


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
