"""Perspective rotation of dialogues: each participant is the assistant once, the others are named users.

Only DataFrame operations.  A conversation is rendered in parts of bounded length, so one with very many
turns is spread over many rows and tasks and loses nothing.
"""

from pyspark.sql import Column, DataFrame, functions as F

from hirelens.llm.common import stage
from hirelens.operators.ids import dense_ids
from hirelens.operators.lookup import fits_broadcast

MAX_TURNS = 256
SYSTEM = "system"
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _turns(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """``(conv, turn, name, text)``: names without white space, empty for null and blank roles."""
    role = conversations[role_col].cast("string")
    name = F.regexp_replace(F.btrim(F.coalesce(role, F.lit("")), F.lit(" \t\n\x0b\f\r")), r"[\x20\x09-\x0D]+", "_")
    return conversations.select(
        conversations[conv_col].alias("conv"), conversations[turn_col].alias("turn"), name.alias("name"),
        F.coalesce(conversations[text_col], F.lit("")).alias("text"),
    )


def _speaks(name: Column) -> Column:
    return (name != SYSTEM) & (name != "")


def _parts(turns: DataFrame, max_turns: int) -> DataFrame:
    """``(conv, part, turns, speaker)``: arrays of at most ``max_turns`` ordered turns, once per participant.

    Sizes are counted first.  Conversations within the bound are gathered whole.  The turns of longer ones are numbered
    by a sort over many tasks, and each stretch of ``max_turns`` is gathered on its own.
    """
    sizes = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > max_turns)
    long = stage(sizes.select("conv"), "long_conversations")
    one = F.struct("turn", "name", "text")
    if long.isEmpty():
        return _by_array(turns, one)
    long = F.broadcast(long) if fits_broadcast(long) else long
    same = turns["conv"].eqNullSafe(long["conv"])
    short = _by_array(turns.join(long, same, "left_anti"), one)
    order = ["conv", "turn", "name", "text"]
    # Equal turns are told apart by nothing, so any order of them is the same.
    numbered = dense_ids(turns.join(long, same, "left_semi"), "at", start=0, order_by=order)
    firsts = numbered.groupBy("conv").agg(F.min("at").alias("first"))
    firsts = stage(firsts, "first_turns").withColumnRenamed("conv", "of")
    placed = numbered.join(F.broadcast(firsts) if fits_broadcast(firsts) else firsts, F.col("conv").eqNullSafe(F.col("of")))
    placed = placed.withColumn("part", F.floor((F.col("at") - F.col("first")) / max_turns).cast("long"))
    gathered = placed.groupBy("conv", "part").agg(F.sort_array(F.collect_list(one)).alias("turns"))
    speakers = placed.filter(_speaks(F.col("name"))).select(F.col("conv").alias("of"), F.col("name").alias("speaker")).distinct()
    spread = gathered.join(speakers, F.col("conv").eqNullSafe(F.col("of"))).select("conv", "part", "turns", "speaker")
    return short.unionByName(spread)


def _by_array(turns: DataFrame, one: Column) -> DataFrame:
    gathered = turns.groupBy("conv").agg(F.sort_array(F.collect_list(one)).alias("turns"))
    names = F.array_distinct(F.filter(F.transform("turns", lambda t: t["name"]), _speaks))
    return gathered.select("conv", F.lit(0).cast("long").alias("part"), "turns", F.explode(names).alias("speaker"))


def perspectives(conversations: DataFrame, max_turns: int = MAX_TURNS, conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``(conv_id, speaker, part, n_turns, rendered, loss_spans, n_loss_chars)``: a row per conversation, participant, part.

    Participants are the distinct roles but ``system``.  A turn is rendered as an opening mark, who speaks, a line
    feed, its text, a closing mark and a line feed; the participant of the row speaks as ``assistant``, others as
    ``user name=...``, the system as ``system``.  ``loss_spans`` are the character ranges (start, end) of the participant's
    texts and closing marks, the only ones to be learnt.

    Turns stand by number, then role, then text (nulls first); repeated turns are kept.  Null texts are empty; turns with a
    null or blank role are of an unnamed ``user`` who is no participant; a conversation without participants gives no
    row; turns without a conversation id are one conversation without id.  Parts are numbered from 0.
    """
    turns = _turns(conversations, conv_col, turn_col, role_col, text_col)
    named = lambda t: F.when(t["name"] == "", F.lit("user")).otherwise(F.concat(F.lit("user name="), t["name"]))
    who = lambda t: F.when(t["name"] == F.col("speaker"), F.lit("assistant")).when(
        t["name"] == SYSTEM, F.lit(SYSTEM)).otherwise(named(t))
    head = lambda t: F.concat(F.lit(OPEN), who(t), F.lit("\n"))
    pieces = _parts(turns, max_turns).select("conv", "speaker", "part", F.transform("turns", lambda t: F.struct(
        F.concat(head(t), t["text"], F.lit(CLOSE + "\n")).alias("piece"), F.length(head(t)).alias("head"),
        (t["name"] == F.col("speaker")).alias("own"))).alias("pieces"))
    lengths = pieces.withColumn("lengths", F.transform("pieces", lambda p: F.length(p["piece"])))

    def span(p: Column, i: Column) -> Column:
        start = F.aggregate(F.slice("lengths", F.lit(1), i), F.lit(0), lambda total, n: total + n)
        # The closing line feed belongs to nobody.
        return F.when(p["own"], F.struct((start + p["head"]).alias("start"), (start + F.length(p["piece"]) - 1).alias("end")))

    spans = F.filter(F.transform("pieces", span), lambda s: s.isNotNull())
    made = lengths.withColumn("loss_spans", spans)
    return made.select(
        F.col("conv").alias(conv_col), "speaker", "part", F.size("pieces").alias("n_turns"),
        F.array_join(F.transform("pieces", lambda p: p["piece"]), "").alias("rendered"), "loss_spans",
        F.aggregate("loss_spans", F.lit(0), lambda total, s: total + s["end"] - s["start"]).alias("n_loss_chars"),
    )
