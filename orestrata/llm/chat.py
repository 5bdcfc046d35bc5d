"""Chat formatting with typed content parts.

A turn's content is a list of parts of the types text, image, audio and document. A visitor,
one column expression over the list, flattens it: text is escaped, every other part becomes
the placeholder of its type, and placeholders stand in the order of their attachments. The
formatted conversation comes with the references and the expanded token counts of its
attachments and with the spans that a loss is taken over.

Control strings inside texts are escaped reversibly: a backslash goes in after their first
character, one more if there are some already. No control string then stands in a text, and
taking one backslash out of each escaped one gives the text back.

Everything is column expressions.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The marks of the template, and the control strings of widespread templates.
TURN, BODY, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
CONTROLS = (
    r"<(?=\\*(?:\|[A-Za-z0-9_]+\|>|/?s>|/?SYS>|pad>|unk>))",
    r"\[(?=\\*/?(?:INST|SYSTEM_PROMPT|AVAILABLE_TOOLS|TOOL_CALLS|TOOL_RESULTS)\])",
)
_ESCAPED = (
    r"<\\(?=\\*(?:\|[A-Za-z0-9_]+\|>|/?s>|/?SYS>|pad>|unk>))",
    r"\[\\(?=\\*/?(?:INST|SYSTEM_PROMPT|AVAILABLE_TOOLS|TOOL_CALLS|TOOL_RESULTS)\])",
)
PARTS = "array<struct<type:string,text:string,ref:string,tokens:bigint>>"


@dataclass(frozen=True)
class Template:
    """`trained`: the role whose texts the loss is taken over. `tokens`: what an attachment
    counts when its part does not say."""

    trained: str = "assistant"
    tokens: Mapping[str, int] = field(default_factory=lambda: {"image": 256, "audio": 128, "document": 512})


def escape(text: Column) -> Column:
    for control in CONTROLS:
        text = F.regexp_replace(text, control, r"$0\\")
    return text


def unescape(text: Column) -> Column:
    for first, control in zip(("<", "["), _ESCAPED, strict=True):
        text = F.regexp_replace(text, control, first)
    return text


def text_parts(text: Column) -> Column:
    """The parts of a turn that is one text."""
    empty = F.lit(None)
    part = F.struct(F.lit("text").alias("type"), text.alias("text"), empty.alias("ref"), empty.alias("tokens"))
    return F.array(part).cast(PARTS)


def _is_text(part: Column) -> Column:
    return ~F.coalesce(part["type"].isin(*PLACEHOLDERS), F.lit(False))


def _flat(parts: Column) -> Column:
    """Escaped text and placeholders, side by side; a part of another type counts as text.

    Neighbouring texts are put together before they are escaped, as a control string may
    start in one and end in the next.
    """

    def merge(done: Column, part: Column) -> Column:
        kind = F.when(_is_text(part), "text").otherwise(part["type"])
        own = F.when(kind == "text", F.coalesce(part["text"], F.lit(""))).otherwise("")
        last = F.try_element_at(done, F.lit(-1))
        goes_on = (kind == "text") & F.coalesce(last["type"] == "text", F.lit(False))
        longer = F.struct(F.lit("text").alias("type"), F.concat(last["text"], own).alias("text"))
        new = F.struct(kind.alias("type"), own.alias("text"))
        return F.when(goes_on, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer))).otherwise(F.concat(done, F.array(new)))

    def visit(part: Column) -> Column:
        shown = escape(part["text"])
        for kind, mark in PLACEHOLDERS.items():
            shown = F.when(part["type"] == kind, mark).otherwise(shown)
        return shown

    merged = F.aggregate(parts, F.expr("CAST(array() AS array<struct<type:string,text:string>>)"), merge)
    return F.array_join(F.transform(merged, visit), "")


def _attachments(parts: Column, template: Template) -> Column:
    def visit(part: Column) -> Column:
        usual = F.lit(0).cast("bigint")
        for kind, tokens in template.tokens.items():
            usual = F.when(part["type"] == kind, F.lit(tokens).cast("bigint")).otherwise(usual)
        return F.struct(part["type"].alias("type"), part["ref"].alias("ref"), F.coalesce(part["tokens"], usual).alias("tokens"))

    return F.transform(F.filter(parts, lambda part: ~_is_text(part)), visit)


def format_chats(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans, attachments, expanded_tokens.

    `turns` has conv_id, turn, role and `parts` (see `PARTS`). Each turn is written as
    `<|im_start|>role<|im_sep|>content<|im_end|>`. `loss_spans` are (start, end) of the
    trained role's contents in `formatted`, in code points, end exclusive. `attachments` are
    (turn_place, type, ref, tokens) in the order of their placeholders; `expanded_tokens` is
    the words of all texts plus the tokens of all attachments.

    Turns come by `turn`, nulls last; ties, repeated rows among them, by role and content.
    Null role, parts and text count as empty. A null conv_id is a conversation. Other
    columns are ignored. An empty table gives an empty result.

    A conversation ends up as one row, so its turns meet in one task; turns are shuffled
    once.
    """
    parts = F.coalesce("parts", F.expr(f"CAST(array() AS {PARTS})"))
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), parts.alias("parts"))
    words = F.aggregate(
        F.filter("parts", _is_text), F.lit(0).cast("bigint"),
        lambda n, part: n + F.regexp_count(F.coalesce(part["text"], F.lit("")), F.lit(r"\S+")),
    )
    rows = rows.select(
        "conv_id", "turn", "role",
        F.concat(F.lit(TURN), escape(F.col("role")), F.lit(BODY)).alias("head"),
        _flat(F.col("parts")).alias("body"),
        _attachments(F.col("parts"), template).alias("attached"),
        words.alias("words"),
    )
    order = [F.asc_nulls_last("turn"), "role", "body", F.xxhash64("attached")]
    by_turn = Window.partitionBy("conv_id").orderBy(*order)
    ends = F.sum(F.length("head") + F.length("body") + len(END)).over(by_turn.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumns({"place": F.row_number().over(by_turn), "end": ends - len(END)})
    loss = F.struct((F.col("end") - F.length("body")).cast("int").alias("start"), F.col("end").cast("int").alias("end"))
    attached = F.transform(
        "attached",
        lambda a: F.struct(F.col("place").alias("turn_place"), a["type"].alias("type"), a["ref"].alias("ref"), a["tokens"].alias("tokens")),
    )
    turn = F.struct(
        "place", F.concat("head", "body", F.lit(END)).alias("shown"),
        F.when(F.col("role") == template.trained, loss).alias("loss"), attached.alias("attached"),
    )
    tokens = F.col("words") + F.aggregate("attached", F.lit(0).cast("bigint"), lambda n, a: n + a["tokens"])
    chats = rows.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(turn)).alias("turns"), F.sum(tokens).alias("expanded_tokens")
    )
    return chats.select(
        "conv_id",
        F.array_join("turns.shown", "").alias("formatted"),
        F.array_compact("turns.loss").alias("loss_spans"),
        F.flatten("turns.attached").alias("attachments"),
        "expanded_tokens",
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: an array of (role, text), unescaped;
    placeholders stay as they are."""
    pieces = F.split(formatted, END.replace("|", r"\|"), -1)
    turns = F.slice(pieces, 1, F.size(pieces) - 1)

    def parse(turn: Column) -> Column:
        inner = F.substring(turn, F.lit(len(TURN) + 1), F.length(turn))
        head = F.substring_index(inner, BODY, 1)
        body = F.substring(inner, F.length(head) + len(BODY) + 1, F.length(inner))
        return F.struct(unescape(head).alias("role"), unescape(body).alias("text"))

    return F.transform(turns, parse)


def loss_text(formatted: Column, loss_spans: Column) -> Column:
    """The unescaped text under the loss spans, nothing between them."""
    return F.array_join(
        F.transform(loss_spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["end"] - s["start"]))), ""
    )
