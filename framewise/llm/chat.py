"""Chat formatting with Spark expressions only.

Rows (conversation, turn, role, text) become one string per conversation:

    <|turn|>role<|says|>text<|next|>text<|end|>

Adjacent turns of one role share a ``<|turn|>`` block, their texts parted by
``<|next|>``, so the merge can be undone.  Control strings inside roles and
texts get a backslash after their first character (one more if they have some
already), which ``unescape`` takes away again; other text stays as it is.

The turns of a conversation are collected as structs and sorted; a pass over
the sorted array merges what adjoins with one role, and the parts are joined.
The positions of the texts are running sums over the array, taken in slices of
``SLICE`` turns and then over the slices, so that no array grows turn by turn.
One shuffle serves all; a conversation's string is one row, so one task writes
it.

Defined results.  Null role or text: empty.  Null conversation: its rows are
one conversation.  Ties of turn are ordered by role, then text; null turns
come first.  Repeated rows: repeated turns.  Empty table: empty result.
Further columns are not carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Turns whose lengths are summed in one go.
SLICE = 64
TURN, SAYS, NEXT, END = "<|turn|>", "<|says|>", "<|next|>", "<|end|>"
#: This template's marks and those of a common instruction template.
_REST = r"\|(?:turn|says|next|end)\|>|/?s>|/?INST\]|</?SYS>>"
ESCAPE = (rf"([<\[])(\\*)({_REST})", r"$1\\$2$3")
UNESCAPE = (rf"([<\[])\\(\\*)({_REST})", r"$1$2$3")


def escape(c: Column) -> Column:
    return F.regexp_replace(c, *map(F.lit, ESCAPE))


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, *map(F.lit, UNESCAPE))


def _mark(mark: str) -> str:
    return mark.replace("|", r"\|")


def format_chats(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text", loss_role: str = "assistant") -> DataFrame:
    """(conv_id, formatted, loss_spans): the string, and the [start, stop) in
    code points of the texts that ``loss_role`` says, in order."""
    rows = turns.select(
        F.col(conv).alias("conv_id"), F.col(turn).alias("turn"),
        escape(F.coalesce(F.col(role), F.lit(""))).alias("role"),
        escape(F.coalesce(F.col(text), F.lit(""))).alias("text"),
        F.coalesce(F.col(role) == loss_role, F.lit(False)).alias("loss"))
    turns_ = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(
        F.struct("turn", "role", "text", "loss"))).alias("turns"))
    block = lambda t: F.concat(F.lit(TURN), t["role"], F.lit(SAYS))

    def part(t: Column, i: Column) -> Column:
        head = F.when(i == 0, block(t)).when(F.get("turns", i - 1)["role"] == t["role"], NEXT).otherwise(
            F.concat(F.lit(END), block(t)))
        return F.struct(F.concat(head, t["text"]).alias("said"),
                        F.length(t["text"]).cast("long").alias("size"), t["loss"].alias("loss"))

    parts = turns_.select("conv_id", F.transform("turns", part).alias("parts"))
    return parts.select(
        "conv_id",
        F.concat(F.array_join("parts.said", ""), F.lit(END)).alias("formatted"),
        F.transform(
            F.filter(F.arrays_zip(_stops(F.transform("parts.said", lambda s: F.length(s).cast("long"))).alias("stop"),
                                  F.col("parts.size").alias("size"), F.col("parts.loss").alias("loss")),
                     lambda t: t["loss"]),
            lambda t: F.struct((t["stop"] - t["size"]).cast("int").alias("start"),
                               t["stop"].cast("int").alias("stop"))).alias("loss_spans"))


def _running(sizes: Column) -> Column:
    """Running sums of an array of long."""
    return F.aggregate(
        sizes, F.array().cast("array<long>"),
        lambda sums, n: F.concat(sums, F.array(F.coalesce(F.try_element_at(sums, F.lit(-1)), F.lit(0).cast("long")) + n)))


def _stops(sizes: Column) -> Column:
    """Running sums of a long array: within slices, on top of those before."""
    starts = F.filter(F.sequence(F.lit(0), F.greatest(F.size(sizes) - 1, F.lit(0))), lambda i: i % SLICE == 0)
    slices = F.transform(starts, lambda i: _running(F.slice(sizes, i + 1, F.lit(SLICE))))
    before = lambda s: _running(F.transform(s, lambda x: F.element_at(x, -1)))
    # the one-element array keeps the slices out of the inner lambdas
    return F.flatten(F.transform(F.array(slices), lambda s: F.flatten(F.transform(
        F.arrays_zip(s.alias("sums"), before(s).alias("total")),
        lambda x: F.transform(x["sums"], lambda n: n + x["total"] - F.element_at(x["sums"], -1))))))


def turns_of(formatted: Column) -> Column:
    """The turns (role, text) read back from a formatted string."""
    blocks = F.split(F.substring(formatted, F.lit(len(TURN) + 1), F.length(formatted)),
                     f"{_mark(END)}(?:{_mark(TURN)}|$)")
    blocks = F.filter(blocks, lambda b: b.contains(SAYS))
    return F.flatten(F.transform(blocks, lambda b: F.transform(
        F.split(F.substring_index(b, SAYS, -1), _mark(NEXT)),
        lambda t: F.struct(unescape(F.substring_index(b, SAYS, 1)).alias("role"),
                           unescape(t).alias("text")))))


def under_mask(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(spans, lambda s: unescape(
        F.substring(formatted, s["start"] + 1, s["stop"] - s["start"]))), "")
