"""Preference formatting: one prompt and two masked completions per pair, in DataFrame functions.

A pair has a chosen and a rejected conversation, each an array of (role, text). The longest common
prefix of equal turns is rendered once as the prompt. The turns behind it are the completions, each
rendered with the spans (code points, end exclusive) on which a loss applies: the text and the end
mark of the turns of `trained` roles. A prompt never ends inside a turn.

A conversation is held whole in one row, like a document. Different turns with the same number are
all kept, by role, then text; equal ones count once. Null turn numbers sort first. A row without a
conversation id is a conversation of its own. Null roles and texts are rendered
as empty strings and equal each other. Identical sides give two empty completions and `differs`
false. Conversations without turns render as empty strings. Extra columns of the conversations are
not passed on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, MIDDLE, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"
TRAINED = ("assistant",)


def conversations(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per conversation: its id and `turns`, an array of (role, text) in order."""
    clean = turns.select(
        F.col(conv),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    known = clean.where(F.col(conv).isNotNull()).distinct()
    listed = known.groupBy(conv).agg(
        F.array_sort(F.collect_list(F.struct("turn", F.struct("role", "text").alias("said")))).alias("_all")
    )
    alone = clean.where(F.col(conv).isNull())
    turns_of = listed.select(conv, F.col("_all.said").alias("turns"))
    return turns_of.union(alone.select(conv, F.array(F.struct("role", "text")).alias("turns")))


def common_prefix(chosen: Column, rejected: Column) -> Column:
    """Number of leading turns that are equal."""
    shorter = F.least(F.size(chosen), F.size(rejected))
    places = F.when(shorter > 0, F.sequence(F.lit(1), shorter)).otherwise(F.array().cast("array<int>"))
    differing = F.filter(places, lambda i: F.element_at(chosen, i) != F.element_at(rejected, i))
    return F.coalesce(F.get(differing, 0) - 1, shorter)


def rendered(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn["role"], F.lit(MIDDLE), turn["text"], F.lit(CLOSE))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, rendered), "")


def loss_spans(turns: Column, trained: tuple[str, ...] = TRAINED) -> Column:
    """Spans of the rendered turns to learn from."""
    start = F.struct(
        F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans")
    )

    def step(state: Column, turn: Column) -> Column:
        end = state["at"] + F.length(rendered(turn))
        begin = state["at"] + F.length(F.concat(F.lit(OPEN), turn["role"], F.lit(MIDDLE)))
        span = F.struct(begin.alias("start"), end.alias("end"))
        spans = F.when(turn["role"].isin(*trained), F.array_append(state["spans"], span))
        return F.struct(end.alias("at"), spans.otherwise(state["spans"]).alias("spans"))

    return F.aggregate(turns, start, step, lambda state: state["spans"])


def format_pairs(
    pairs: DataFrame,
    chosen: str = "chosen",
    rejected: str = "rejected",
    trained: tuple[str, ...] = TRAINED,
) -> DataFrame:
    """`pairs` with the two arrays of turns replaced by prompt, completions and their loss spans."""
    own = {"n_prompt_turns", "prompt", "differs", chosen, rejected, "chosen_loss", "rejected_loss"}
    rest = [c for c in pairs.columns if c not in own]
    empty = F.array().cast("array<struct<role:string,text:string>>")
    sides = pairs.select(
        *rest,
        F.coalesce(F.col(chosen), empty).alias("_chosen"),
        F.coalesce(F.col(rejected), empty).alias("_rejected"),
    ).withColumn("n_prompt_turns", common_prefix(F.col("_chosen"), F.col("_rejected")))
    n = F.col("n_prompt_turns")

    def tail(side: str) -> Column:
        return F.slice(F.col(side), n + 1, F.greatest(F.size(side) - n, F.lit(0)))

    cut = sides.select(
        *rest,
        "n_prompt_turns",
        render(F.slice("_chosen", 1, n)).alias("prompt"),
        tail("_chosen").alias("_chosen"),
        tail("_rejected").alias("_rejected"),
    )
    return cut.select(
        *rest,
        "n_prompt_turns",
        "prompt",
        ((F.size("_chosen") > 0) | (F.size("_rejected") > 0)).alias("differs"),
        render(F.col("_chosen")).alias(chosen),
        loss_spans(F.col("_chosen"), trained).alias("chosen_loss"),
        render(F.col("_rejected")).alias(rejected),
        loss_spans(F.col("_rejected"), trained).alias("rejected_loss"),
    )


def swapped_replies(spoken: DataFrame, conv: str = "conv_id", role: str = "assistant") -> DataFrame:
    """Pairs out of conversations: chosen as it is, rejected with a foreign last reply.

    The rejected side ends at the last turn of `role`, whose text is that of the last such turn in
    the conversation with the next id; an empty text if there is none. Conversations without such a
    turn are rejected as they are, so that their sides agree.
    """
    turns = F.col("turns")
    places = F.transform(turns, lambda t, i: F.when(t["role"] == role, i + 1))
    known = spoken.withColumn("_last", F.coalesce(F.array_max(places), F.lit(0)))
    reply = F.when(F.col("_last") > 0, F.element_at(turns, F.col("_last"))["text"])
    donors = known.where(F.col(conv).isNotNull() & (F.col("_last") > 0)).select(
        (F.col(conv) - 1).alias("_next"), reply.alias("_reply")
    )
    foreign = F.struct(F.lit(role).alias("role"), F.coalesce("_reply", F.lit("")).alias("text"))
    joined = known.join(donors, F.col(conv) == F.col("_next"), "left")
    before = F.slice(turns, 1, F.greatest(F.col("_last") - 1, F.lit(0)))
    rejected = F.when(F.col("_last") > 0, F.array_append(before, foreign)).otherwise(turns)
    return joined.select(F.col(conv), turns.alias("chosen"), rejected.alias("rejected"))
