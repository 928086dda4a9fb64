"""Chat formatting by prefix-target expansion, in DataFrame operations only.

A turn becomes ``### role: text</turn>`` and a line break. Inside texts and roles, ``\\`` is doubled, ``##`` becomes ``#\\#``
and ``</turn>`` becomes ``<\\/turn>`` (in roles also ``:`` becomes ``\\:``), so no text can hold a marker; dropping each backslash
and keeping what follows it gives the text back.

Every assistant turn becomes an example of its own: all turns before it as context, and its text alone under the loss
mask (code points ``loss_start`` to ``loss_end``). Turns behind the last assistant turn, and conversations without one, go
into one more example with an empty mask, so the output holds every turn. Example texts repeat their context, so they
grow with the square of a conversation's turns; ``as_text`` has each conversation once, and every example is the first
``loss_end`` code points of it plus the end mark.

Turns are ordered by (turn, role, text). Null roles and texts are empty; a null conversation id is one conversation. Repeated
rows are turns of their own. A conversation is one row, so its turns meet in one task. An empty table gives no example.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAD, END = "### ", "</turn>\n"


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(doubled, F.lit("##"), F.lit("#\\#")), F.lit("</turn>"), F.lit("<\\/turn>"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(.)", "$1")


def as_text(conversations: DataFrame) -> DataFrame:
    """(conv_id, formatted, turns): the whole text, and per turn its role and where its text begins and ends."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    marked = conversations.select("conv_id", "turn", role.alias("role"), escape(text).alias("body"))
    marked = marked.withColumn("head", F.concat(F.lit(HEAD), F.replace(escape(F.col("role")), F.lit(":"), F.lit("\\:")), F.lit(": ")))
    turns = F.sort_array(F.collect_list(F.struct("turn", "role", "body", "head"))).alias("turns")
    grouped = marked.groupBy("conv_id").agg(turns)
    formatted = F.array_join(F.transform("turns", lambda t: F.concat(t.head, t.body, F.lit(END))), "")
    # one pass over the turns: the length so far, and each turn's place
    empty = F.struct(F.lit(0).alias("length"), F.expr("cast(array() as array<struct<role:string,begin:int,end:int>>)").alias("places"))

    def add(state: Column, t: Column) -> Column:
        begin = state.length + F.length(t.head)
        end = begin + F.length(t.body)
        place = F.struct(t.role.alias("role"), begin.alias("begin"), end.alias("end"))
        return F.struct((end + len(END)).alias("length"), F.concat(state.places, F.array(place)).alias("places"))

    places = F.aggregate("turns", empty, add, lambda state: state.places)
    return grouped.select("conv_id", formatted.alias("formatted"), places.alias("turns"))


def examples(conversations: DataFrame) -> DataFrame:
    """(conv_id, example, text, loss_start, loss_end): one row per assistant turn, and one for what follows the last."""
    whole = as_text(conversations)
    replies = F.filter("turns", lambda t: t.role == "assistant")
    last = F.element_at("turns", -1)
    rest = F.when(
        last.role != "assistant", F.array(F.struct(last.role.alias("role"), last.end.alias("begin"), last.end.alias("end")))
    ).otherwise(F.expr("cast(array() as array<struct<role:string,begin:int,end:int>>)"))
    return (
        whole.select("conv_id", "formatted", F.posexplode(F.concat(replies, rest)).alias("example", "t"))
        .select(
            "conv_id",
            "example",
            F.substring("formatted", F.lit(1), F.col("t.end") + len(END)).alias("text"),
            F.col("t.begin").alias("loss_start"),
            F.col("t.end").alias("loss_end"),
        )
    )


def read_back(written: DataFrame) -> DataFrame:
    """Digests of each conversation from its examples: the turns, the text under the mask, all formatted characters."""
    learned = unescape(F.substring("text", F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start")))
    per = written.groupBy("conv_id").agg(
        F.max_by("text", "example").alias("full"),
        F.sort_array(F.collect_list(F.struct("example", learned.alias("part")))).alias("parts"),
        F.sum(F.length("text")).alias("formatted_chars"),
    )
    lines = F.filter(F.split("full", END), lambda x: x != "")
    head = r"^### ((?:[^\\:]|\\.)*): "
    turn = lambda x: F.concat(
        unescape(F.regexp_extract(x, head, 1)), F.lit("\n"), unescape(F.regexp_replace(x, head, "")), F.lit("\n")
    )
    loss = F.array_join(F.transform("parts", lambda p: p.part), "")
    return per.select(
        "conv_id",
        F.size(lines).cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform(lines, turn), ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"),
    )
