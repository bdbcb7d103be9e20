"""Chat formatting by relational expressions.

Rows of turns are collected per conversation, sorted as structs, adjacent turns
of one role merged under one header, and concatenated; all of it with Spark's
array expressions.  The template:

    <|im_start|>role\\n text [<|im_sep|> text ...] <|im_end|>\\n

`<|im_sep|>` parts merged turns, so the original turns can be read back.  In
texts and roles `&` becomes `&amp;` and `<|` becomes `&lt;|`, so no text can hold
a control string; in roles a line feed becomes `&nl;` as well.  `read_back`
undoes it all.

Null text or role: empty.  Equal turn numbers: ordered by role, then text;
repeated rows stay.  Null turn numbers come first.  Null conversation ids form
one conversation.  An empty table gives no rows.  Further columns are ignored.
One conversation becomes one value, so it has to fit one row; conversations
spread over tasks by id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("&nl;"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("&nl;"), F.lit("\n")))


def _merged(turns: Column) -> Column:
    """Blocks (role, texts): adjacent turns of one role together."""
    none = F.array().cast("array<struct<role:string,texts:array<string>>>")

    def step(blocks: Column, turn: Column) -> Column:
        last = F.try_element_at(blocks, F.lit(-1))
        same = last["role"].eqNullSafe(turn["role"])
        more = F.struct(last["role"].alias("role"), F.array_append(last["texts"], turn["text"]).alias("texts"))
        new = F.struct(turn["role"].alias("role"), F.array(turn["text"]).alias("texts"))
        return F.when(same, F.array_append(F.slice(blocks, 1, F.size(blocks) - 1), more)).otherwise(F.array_append(blocks, new))

    return F.aggregate(turns, none, step)


def format_conversations(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", loss_role: str = LOSS_ROLE) -> DataFrame:
    """conversation id, formatted, loss_spans: array of (start, length) in code points of formatted."""
    turn = F.struct(
        F.col(turn_col).alias("turn"),
        escape_role(F.coalesce(F.col(role_col), F.lit(""))).alias("role"),
        escape(F.coalesce(F.col(text_col), F.lit(""))).alias("text"),
    )
    turns = rows.groupBy(F.col(conv_col)).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    blocks = turns.select(conv_col, _merged(F.col("turns")).alias("blocks"))
    body = F.array_join(
        F.transform("blocks", lambda b: F.concat(F.lit(START), b["role"], F.lit("\n"), F.array_join(b["texts"], SEP), F.lit(END))), ""
    )
    nothing = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))

    def over_texts(role: Column):
        def step(acc: Column, text: Column) -> Column:
            span = F.struct(acc["at"].alias("start"), F.length(text).cast("long").alias("length"))
            spans = F.when(role == escape_role(F.lit(loss_role)), F.array_append(acc["spans"], span)).otherwise(acc["spans"])
            return F.struct((acc["at"] + F.length(text) + len(SEP)).alias("at"), spans.alias("spans"))

        return step

    def over_blocks(acc: Column, block: Column) -> Column:
        begin = F.struct((acc["at"] + len(START) + F.length(block["role"]) + 1).alias("at"), acc["spans"].alias("spans"))
        end = F.aggregate(block["texts"], begin, over_texts(block["role"]))
        return F.struct((end["at"] - len(SEP) + len(END)).alias("at"), end["spans"].alias("spans"))

    spans = F.aggregate("blocks", nothing, over_blocks, lambda acc: acc["spans"])
    return blocks.select(conv_col, body.alias("formatted"), spans.alias("loss_spans"))


def read_back(formatted: Column) -> Column:
    """Array of (role, text), the original turns in order, from a formatted conversation."""
    whole = F.filter(F.split(formatted, r"\Q" + START + r"\E", -1), lambda b, i: i > 0)

    def turns(block: Column) -> Column:
        inner = F.substring(block, F.lit(1), F.length(block) - len(END))
        cut = F.locate("\n", inner)
        role = unescape_role(F.substring(inner, F.lit(1), cut - 1))
        texts = F.split(F.substring(inner, cut + 1, F.length(inner)), r"\Q" + SEP + r"\E", -1)
        return F.transform(texts, lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(whole, turns))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    part = lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))
    return F.array_join(F.transform(spans, part), "")
