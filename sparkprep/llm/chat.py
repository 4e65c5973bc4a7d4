"""Chat formatting from a declarative template (operator 9): DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ChatTemplate:
    """``head`` and ``tail`` mark a turn; {role} is the escaped role. ``steps``
    maps a state (the last role; "" at the start) to the roles that may
    follow; ``accept`` lists the states a conversation may end in; text of
    the roles in ``learn`` carries the loss. ``escapes``: control character
    -> its two-character code, the escape character first. Escaped text holds
    no control character but the escape itself, so marks can't occur in it."""

    head: str = "### {role}: "
    tail: str = "</turn>\n"
    steps: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})
    accept: tuple[str, ...] = ("assistant",)
    learn: tuple[str, ...] = ("assistant",)
    escapes: tuple[tuple[str, str], ...] = (("\\", "\\b"), ("#", "\\h"), ("<", "\\l"), (":", "\\c"))

    def escape(self, c: Column) -> Column:
        for plain, code in self.escapes:
            c = F.replace(c, F.lit(plain), F.lit(code))
        return c

    def unescape(self, c: Column) -> Column:
        for plain, code in reversed(self.escapes):
            c = F.replace(c, F.lit(code), F.lit(plain))
        return c

    @property
    def head_parts(self) -> tuple[str, str]:
        before, after = self.head.split("{role}")
        return before, after


def chat_turns(turns: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """Numbered turns with the machine's verdict: conv_id, no (from 1, by turn,
    then role and text for ties), role, text (null: empty), step_ok (the role
    may follow the state, the previous role) and ends_ok (set on the last
    turn: the state is accepting). A null role is the unknown role "" and is
    never allowed. Rows with a null conv_id form one conversation."""
    t = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    w = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    t = t.withColumn("no", F.row_number().over(w)).withColumn("state", F.lag("role", 1, "").over(w)).withColumn("after", F.lead("role").over(w))
    allowed = F.lit(False)
    for state, roles in template.steps.items():
        allowed = allowed | ((F.col("state") == state) & F.col("role").isin(*roles) & ((F.col("no") == 1) == F.lit(state == "")))
    ends = F.when(F.col("after").isNull(), F.col("role").isin(*template.accept))
    return t.select("conv_id", "no", "role", "text", allowed.alias("step_ok"), ends.alias("ends_ok"))


def chat_segments(turns: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """The formatted text as segments with loss flags: conv_id, no, part (0
    head, 1 text, 2 tail), segment, loss, step_ok, ends_ok. Concatenating the
    segments by (no, part) gives the formatted conversation. Conversations
    that break the turn order are formatted too, with their flags unset. An
    empty table gives an empty table; other columns are ignored."""
    t = chat_turns(turns, template)
    before, after = template.head_parts
    head = F.concat(F.lit(before), template.escape(F.col("role")), F.lit(after))
    learn = F.col("role").isin(*template.learn)
    part = lambda n, text, loss: F.struct(F.lit(n).alias("part"), text.alias("segment"), loss.alias("loss"))
    parts = F.array(part(0, head, F.lit(False)), part(1, template.escape(F.col("text")), learn), part(2, F.lit(template.tail), F.lit(False)))
    return t.select("conv_id", "no", F.inline(parts), "step_ok", "ends_ok").select(
        "conv_id", "no", "part", "segment", "loss", "step_ok", "ends_ok")


def chat_documents(turns: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """One row per conversation: conv_id, formatted, spans (array of start,
    length in code points of every segment under the loss mask, in order),
    valid (each turn was allowed and the last state accepts) and first_bad
    (number, from 1, of the first turn that was not allowed or, where all
    were, of a last turn whose state does not accept; null if valid)."""
    t = chat_turns(turns, template)
    before, after = template.head_parts
    head = F.concat(F.lit(before), template.escape(F.col("role")), F.lit(after))
    t = t.select("conv_id", "no", F.struct("no", head.alias("head"), template.escape(F.col("text")).alias("body"),
                                           F.col("role").isin(*template.learn).alias("loss")).alias("s"),
                 F.when(~(F.col("step_ok") & F.coalesce("ends_ok", F.lit(True))), F.col("no").cast("long")).alias("bad"))
    g = t.groupBy("conv_id").agg(F.sort_array(F.collect_list("s")).alias("s"), F.min("bad").alias("first_bad"))
    tail = template.tail
    size = lambda x: F.char_length(x["head"]) + F.char_length(x["body"]) + F.lit(len(tail))
    empty = F.expr("named_struct('at', 0, 'spans', cast(array() as array<struct<start:int,length:int>>))")
    walk = F.aggregate("s", empty, lambda acc, x: F.struct(
        (acc["at"] + size(x)).alias("at"),
        F.when(x["loss"], F.concat(acc["spans"], F.array(F.struct((acc["at"] + F.char_length(x["head"])).alias("start"), F.char_length(x["body"]).alias("length")))))
        .otherwise(acc["spans"]).alias("spans")))
    text = F.concat_ws("", F.transform("s", lambda x: F.concat(x["head"], x["body"], F.lit(tail))))
    return g.select("conv_id", text.alias("formatted"), walk["spans"].alias("spans"), F.col("first_bad").isNull().alias("valid"), "first_bad")


def read_back(documents: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """Parse ``chat_documents`` again: conv_id, turns (array of role, text),
    learned (array of the unescaped texts under the mask), formatted, valid, first_bad."""
    before, after = template.head_parts
    chunks = F.filter(F.split("formatted", f"\\Q{template.tail}\\E", -1), lambda c: c != "")
    turn = lambda c: F.struct(
        template.unescape(F.substring(F.substring_index(c, after, 1), F.lit(len(before) + 1), F.char_length(c))).alias("role"),
        template.unescape(F.substring(c, F.char_length(F.substring_index(c, after, 1)) + F.lit(len(after) + 1), F.char_length(c))).alias("text"))
    learned = F.transform("spans", lambda s: template.unescape(F.substring(F.col("formatted"), s["start"] + 1, s["length"])))
    return documents.select("conv_id", F.transform(chunks, turn).alias("turns"), learned.alias("learned"), "formatted", "valid", "first_bad")
