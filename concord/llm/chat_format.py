"""Chat formatting with a grammar round trip.

A turn is an opening mark, a space, the text, a space and the closing mark of its role; turns are joined by \\n. A
mark right after a backslash is ordinary text. The parser cuts the rendered text at its marks, which must
alternate as openings and closings, and takes one backslash from each escaped mark. A turn is first rendered as it
is; if the parser does not give it back, its conflicting content is escaped (one more backslash before each mark)
and it is rendered again. Every conversation is parsed once more as a whole, and a difference raises an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The marks of the template; other roles are named in theirs, URL-encoded.
MARKS = {"user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>"), "system": ("<<SYS>>", "<</SYS>>")}
OTHER_END = "[/ROLE]"
MARK = r"(?:\[/?INST\]|</?s>|<</?SYS>>|\[ROLE [A-Za-z0-9*_.+%-]*\]|\[/ROLE\])"
CUT = rf"(?<!\\){MARK}"
TURNS = "array<struct<role:string,text:string>>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?<!\\)(\\*+{MARK})", r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?<!\\)\\(\\*+{MARK})", "$1")


def _open(role: Column) -> Column:
    mark = F.concat(F.lit("[ROLE "), F.url_encode(role), F.lit("]"))
    for name, (start, _) in MARKS.items():
        mark = F.when(role == name, start).otherwise(mark)
    return mark


def _close(role: Column) -> Column:
    mark = F.lit(OTHER_END)
    for name, (_, end) in MARKS.items():
        mark = F.when(role == name, end).otherwise(mark)
    return mark


def _role(mark: Column) -> Column:
    role = F.when(mark.startswith("[ROLE "), F.url_decode(F.regexp_replace(mark, r"^\[ROLE |\]$", "")))
    for name, (start, _) in MARKS.items():
        role = F.when(mark == start, name).otherwise(role)
    return role


def render(role: Column, text: Column) -> Column:
    return F.concat(_open(role), F.lit(" "), text, F.lit(" "), _close(role))


def parse(formatted: Column) -> Column:
    """The turns of a rendered text; null if its marks don't alternate as the grammar asks."""

    def build(cut):
        marks, pieces = cut["marks"], cut["pieces"]
        turns = F.transform(
            F.sequence(F.lit(1), F.size(marks), F.lit(2)),
            lambda i: F.struct(_role(F.element_at(marks, i)).alias("role"), unescape(F.substring(F.element_at(pieces, i + 1), F.lit(2), F.length(F.element_at(pieces, i + 1)) - 2)).alias("text")),
        )
        closed = F.forall(F.sequence(F.lit(1), F.size(marks), F.lit(2)), lambda i: F.element_at(marks, i + 1) == _close(_role(F.element_at(marks, i))))
        whole = (F.size(marks) % 2 == 0) & (F.size(marks) > 0)
        return F.when(whole, F.when(closed, turns))

    cut = F.struct(F.regexp_extract_all(formatted, F.lit(CUT), F.lit(0)).alias("marks"), F.split(formatted, CUT, -1).alias("pieces"))
    return F.element_at(F.transform(F.array(cut), build), 1)


def loss_spans(formatted: Column) -> Column:
    """Where the loss applies: (start, end) in code points of ``formatted``, the texts of assistant turns as escaped."""
    marks, pieces = F.regexp_extract_all(formatted, F.lit(CUT), F.lit(0)), F.split(formatted, CUT, -1)
    sizes = F.zip_with(marks, F.slice(pieces, F.lit(1), F.size(marks)), lambda m, p: F.struct(m.alias("mark"), F.length(p).alias("gap")))

    def step(a, x):
        at = a["at"] + x["gap"]
        # a closing mark ends the text that began after its opening mark; one space stands at either end
        span = F.when(x["mark"] == MARKS["assistant"][1], F.array(F.struct((a["at"] + 1).alias("start"), (at - 1).alias("end")))).otherwise(F.array().cast("array<struct<start:int,end:int>>"))
        return F.struct((at + F.length(x["mark"])).alias("at"), F.concat(a["out"], span).alias("out"))

    return F.aggregate(sizes, F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out")), step)["out"]


def format_conversations(turns: DataFrame) -> DataFrame:
    """One row per conv_id: conv_id, formatted, and turns and loss_spans as read back from ``formatted``.

    ``turns`` has conv_id, turn, role and text. Rows are ordered by turn, then role, then text (nulls first), so ties
    and repeated rows have one defined order and all stay; a null text or role counts as empty; rows with a
    null conv_id form one conversation. Other columns are ignored. Texts of any length are kept whole, and a conversation is
    one row, so its turns must fit in a task together. Empty in, empty out.
    """
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    plain = render(F.col("role"), F.col("text"))
    same = parse(plain).eqNullSafe(F.array(F.struct(F.col("role").alias("role"), F.col("text").alias("text"))).cast(TURNS))
    rows = rows.withColumn("rendered", F.when(same, plain).otherwise(render(F.col("role"), escape(F.col("text")))))
    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text", "rendered"))).alias("all"))
    source = F.transform("all", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).cast(TURNS)
    whole = grouped.select("conv_id", source.alias("source"), F.array_join(F.transform("all", lambda x: x["rendered"]), "\n").alias("formatted"))
    read = whole.withColumn("turns", parse(F.col("formatted")))
    checked = F.when(F.col("turns").eqNullSafe(F.col("source")), F.col("turns")).otherwise(F.raise_error(F.concat(F.lit("no round trip for conversation "), F.coalesce(F.col("conv_id").cast("string"), F.lit("null")))).cast(TURNS))
    return read.select("conv_id", "formatted", checked.alias("turns"), loss_spans(F.col("formatted")).alias("loss_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what ``format_conversations`` returns, all taken from the formatted text."""
    under_mask = F.transform("loss_spans", lambda s: unescape(F.substring("formatted", s["start"] + 1, s["end"] - s["start"])))
    loss = formatted.withColumn("loss", F.array_join(under_mask, ""))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return loss.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
