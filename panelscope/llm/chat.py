"""Chat formatting by perspective rotation, in built-in expressions alone.

For every participant of a conversation the dialogue is rendered with that
speaker as the assistant and all others as named users.  The masks are the
places of the assistant's own words (the targets of training) in the rendered
text.

A dialogue is laid out message by message: the place of a message is the
length of all before it, summed first within blocks of turns and then over the
blocks, so a conversation that holds a third of all rows is laid out by many
tasks.  The rendered text is cut into parts of at most ``part_chars``
characters plus one message; joined in order, the parts are the whole
dialogue.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelscope.llm.common import stage_table

#: Fixed values of the template.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def header(role: Column, perspective: Column) -> Column:
    """What stands before a message's text in the rendering for a participant."""
    return F.when(role == perspective, F.lit(OPEN + "assistant\n")).otherwise(
        F.concat(F.lit(OPEN + "user name="), role, F.lit("\n")))


def lay_out(messages: DataFrame, block: int = 64) -> DataFrame:
    """A row for each message and participant of its conversation: ``conv_id``,
    ``participant``, ``turn``, ``role``, ``segment`` (the rendered message),
    ``nth`` (0, 1, ...), ``start`` (of the segment in the rendered dialogue, in
    characters) and ``is_target``.

    Messages are ordered by turn (null first); messages of one turn by a hash
    of role and text, then by role and text, and equal messages are all
    rendered.  A null role is the participant ``unknown``, a null text an empty
    one, rows of a null conv_id are one conversation; an empty table gives an
    empty result.  Other columns are not read."""
    m = stage_table(messages.select(
        F.to_json(F.struct("conv_id")).alias("_conv"), "conv_id", F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("_turn", F.coalesce("turn", F.lit(-(1 << 62))))
        .withColumn("_block", F.floor(F.col("_turn") / block))
        .withColumn("_tie", F.pmod(F.xxhash64("role", "text"), F.lit(64))), "chat")
    people = m.groupBy("_conv").agg(F.array_sort(F.collect_set("role")).alias("participant"))
    rows = m.join(people.withColumn("participant", F.explode("participant")), "_conv")
    segment = F.concat(header(F.col("role"), F.col("participant")), F.col("text"), F.lit(CLOSE))
    rows = rows.withColumn("segment", segment).withColumn("_size", F.length("segment").cast("long"))

    # running sums of characters and messages: over the blocks of a dialogue,
    # over the turns and ties of a block, over the messages of a tie
    dialogue, fine = ["_conv", "participant"], ["_turn", "_tie"]
    ties = rows.groupBy(*dialogue, "_block", *fine).agg(F.sum("_size").alias("chars"), F.count("*").alias("n"))
    blocks = ties.groupBy(*dialogue, "_block").agg(F.sum("chars").alias("chars"), F.sum("n").alias("n"))

    def before(d: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
        over = Window.partitionBy(*keys).orderBy(*order)
        return d.select(*keys, *order, *[(F.sum(c).over(over) - F.col(c)).alias(f"{name}_{c}") for c in ("chars", "n")])

    places = before(ties, [*dialogue, "_block"], fine, "_t").join(before(blocks, dialogue, ["_block"], "_b"), [*dialogue, "_block"])
    over = Window.partitionBy(*dialogue, "_block", *fine).orderBy("role", "text")
    rows = rows.withColumn("_r_chars", F.sum("_size").over(over.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_size"))
    rows = rows.withColumn("_r_n", F.row_number().over(over) - 1).join(places, [*dialogue, "_block", *fine])
    total = lambda c: (F.col(f"_b_{c}") + F.col(f"_t_{c}") + F.col(f"_r_{c}")).cast("long")
    return rows.select("conv_id", "participant", "turn", "role", "segment", total("n").alias("nth"), total("chars").alias("start"),
                       (F.col("role") == F.col("participant")).alias("is_target"), F.length("text").cast("long").alias("text_chars"))


def rotate(messages: DataFrame, part_chars: int = 65_536, block: int = 64) -> DataFrame:
    """Rendered dialogues: ``conv_id``, ``participant``, ``part`` (0, 1, ...),
    ``n_messages``, ``rendered`` and ``masks`` (array of start and end, in
    characters of ``rendered``, of the assistant's texts)."""
    rows = lay_out(messages, block).withColumn("part", F.floor(F.col("start") / part_chars).cast("int"))
    # length of the text and of the closing mark end the segment
    end = F.length("segment") - len(CLOSE)
    piece = F.struct("nth", "segment", "start", (end - F.col("text_chars")).cast("int").alias("a"), end.cast("int").alias("b"), "is_target")
    parts = rows.groupBy("conv_id", "participant", "part").agg(F.array_sort(F.collect_list(piece)).alias("pieces"))
    first = F.get("pieces", F.lit(0))["start"]
    masks = F.transform(F.filter("pieces", lambda p: p["is_target"]), lambda p: F.struct(
        (p["start"] - first + p["a"]).cast("int").alias("start"), (p["start"] - first + p["b"]).cast("int").alias("end")))
    return parts.select("conv_id", "participant", "part", F.size("pieces").alias("n_messages"),
                        F.array_join(F.transform("pieces", lambda p: p["segment"]), "").alias("rendered"), masks.alias("masks"))
