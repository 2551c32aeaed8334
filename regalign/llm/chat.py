"""Chat formatting: a dialogue seen from every participant (DataFrame operations only).

For each participant the dialogue is rendered with that speaker as the assistant and everybody
else as a named user; the mask lists the characters a model should be trained on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regalign.llm.common import attach, materialize
from regalign.operators.ranking import row_number_global

TURNS = 512            # messages of a part of a dialogue; most dialogues are one part
SYSTEM, UNKNOWN = "system", "unknown"
OPEN, CLOSE, END = "<|", "|>\n", "<|end|>\n"


def safe(text: Column) -> Column:
    """A text that can't be taken for a delimiter: ``<|`` and ``|>`` are opened up by a blank."""
    return F.replace(F.replace(text, F.lit("<|"), F.lit("< |")), F.lit("|>"), F.lit("| >"))


def _parts(rows: DataFrame, turns: int) -> DataFrame:
    """(conv_id, part, opening, turns): the messages of every part in order, and the opening repeated before it."""
    message = F.struct("turn", "role", "text")
    listed = F.sort_array(F.collect_list(message)).alias("turns")
    none = F.array().cast("array<struct<turn:bigint,role:string,text:string>>").alias("opening")
    sizes = rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > turns)
    long = materialize(sizes.select("conv_id", F.lit(True).alias("_long")), "long")
    rows = attach(rows, long, ["conv_id"])
    short = rows.where(F.col("_long").isNull()).groupBy("conv_id").agg(listed)
    short = short.select("conv_id", F.lit(0).cast("long").alias("part"), none, "turns")
    if long.isEmpty():
        return short
    # a long dialogue is numbered over all tasks, so that not even its messages of one turn come into one row
    numbered = row_number_global(rows.where("_long").drop("_long"), ["conv_id", "turn", "role", "text"], "_rn")
    first = materialize(numbered.groupBy("conv_id").agg(
        F.min("_rn").alias("_first"), F.min(F.when(F.col("role") != SYSTEM, F.col("_rn"))).alias("_other")), "first")
    placed = attach(numbered, first, ["conv_id"]).withColumn("_at", F.col("_rn") - F.col("_first"))
    parts = placed.groupBy("conv_id", F.floor(F.col("_at") / turns).alias("part")).agg(listed)
    opening = placed.where((F.col("_rn") < F.col("_other")) & (F.col("_at") < turns)).groupBy("conv_id").agg(
        F.sort_array(F.collect_list(message)).alias("_opening"))  # at most one part's messages
    parts = attach(parts, opening, ["conv_id"])
    later = F.when(F.col("part") > 0, F.col("_opening"))
    return short.unionByName(parts.select("conv_id", "part", F.coalesce(later, none).alias("opening"), "turns"))


def rotate(conversations: DataFrame, turns: int = TURNS) -> DataFrame:
    """(conv_id, part, speaker, n_turns, n_own, rendered, mask) for every participant of every dialogue.

    Reads conv_id, turn, role and text.  A participant is a distinct role but ``system``, which
    stays the system in every view; a null role is ``unknown``, a null text empty.  Messages are
    ordered by turn (null first), role and text, and repeated rows are repeated messages.  A
    dialogue of up to ``turns`` messages is rendered whole.  A longer one is cut into parts of
    ``turns`` messages, so that no row or task holds more, whatever its turn numbers; every
    participant gets every part, and each later part begins with the system messages that open the
    dialogue.  ``n_turns`` and ``n_own`` count a part's own messages.  ``mask`` lists start:stop in
    code points of ``rendered``: the speaker's own texts with their end mark.  Null conversation ids
    are one dialogue.  A dialogue of system messages alone has no participant and no row; an empty
    table gives no rows.
    """
    rows = conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), safe(F.coalesce("role", F.lit(UNKNOWN))).alias("role"),
        safe(F.coalesce("text", F.lit(""))).alias("text"))
    speakers = rows.where(F.col("role") != SYSTEM).select(F.col("conv_id").alias("_c"), F.col("role").alias("speaker")).distinct()
    views = _parts(rows, turns).join(speakers, F.col("conv_id").eqNullSafe(F.col("_c"))).drop("_c")

    def head(m: Column) -> Column:
        own, system = m["role"] == F.col("speaker"), m["role"] == SYSTEM
        return F.concat(F.lit(OPEN), F.when(own, "assistant").when(system, SYSTEM).otherwise(
            F.concat(F.lit("user name="), m["role"])), F.lit(CLOSE))

    counts = [F.size("turns").cast("long").alias("n_turns"),
              F.size(F.filter("turns", lambda m: m["role"] == F.col("speaker"))).cast("long").alias("n_own")]
    shown = F.transform(F.concat("opening", "turns"), lambda m: F.struct(
        (m["role"] == F.col("speaker")).alias("own"), head(m).alias("head"), F.concat(m["text"], F.lit(END)).alias("body")))
    views = views.select("conv_id", "part", "speaker", *counts, shown.alias("shown"))
    spans = F.aggregate(
        "shown", F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("spans")),
        lambda a, m: F.struct(
            (a["at"] + F.length(m["head"]) + F.length(m["body"])).alias("at"),
            F.when(m["own"], F.concat(a["spans"], F.array(F.concat(
                (a["at"] + F.length(m["head"])).cast("string"), F.lit(":"),
                (a["at"] + F.length(m["head"]) + F.length(m["body"])).cast("string"))))).otherwise(a["spans"]).alias("spans")))
    return views.select(
        "conv_id", "part", "speaker", "n_turns", "n_own",
        F.array_join(F.transform("shown", lambda m: F.concat(m["head"], m["body"])), "").alias("rendered"),
        F.array_join(spans["spans"], ",").alias("mask"))
