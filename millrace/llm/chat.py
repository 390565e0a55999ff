"""Chat formatting by perspective: every speaker of a dialogue once plays the assistant.

Only DataFrame functions. A rendered dialogue is one value, so the turns of one
dialogue meet in one task; they are shuffled once, and every later step keeps
that partitioning.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def perspectives(turns, conv="conv_id", turn="turn", role="role", text="text", silent=("system",)):
    """One row per dialogue and speaker: the dialogue with that speaker as ``assistant``.

    Other speakers become ``user name=<speaker>``; ``silent`` roles keep their
    role and never take the assistant's part. Returns ``conv_id, speaker,
    n_turns, n_masked, n_chars, rendered, mask``. ``mask`` lists the code-point
    ranges ``start:end`` (end exclusive) to learn from: the assistant's words
    and their closing marker.

    Turns stand in the order of turn (nulls first), role and text, so ties and
    repeated rows have one result and all are kept. A null role is the speaker
    ``unknown``, a null text is empty. ``<|`` inside a turn or a name is written
    ``< |``, so no text can open or close a turn. A row with a null
    conversation id is a dialogue with the rows equal to it. A dialogue of
    silent roles alone has no perspective. Other columns are not read.
    """
    plain = lambda c: F.replace(c, F.lit("<|"), F.lit("< |"))
    t = turns.select(
        F.col(conv).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("unknown")).alias("role"),
        plain(F.coalesce(F.col(text), F.lit(""))).alias("text"),
    )
    t = t.withColumn("part", F.when(F.col("conv_id").isNull(), F.xxhash64("turn", "role", "text")).otherwise(F.lit(0)))
    everyone = Window.partitionBy("conv_id", "part")
    speaks = F.when(~F.col("role").isin(*silent), F.col("role")) if silent else F.col("role")
    t = t.withColumn("people", F.collect_set(speaks).over(everyone)).withColumn("speaker", F.explode("people")).drop("people")
    own = F.col("role") == F.col("speaker")
    name = (
        F.when(own, F.lit("assistant"))
        .when(F.col("role").isin(*silent) if silent else F.lit(False), F.col("role"))
        .otherwise(F.concat(F.lit("user name="), plain(F.col("role"))))
    )
    t = t.withColumn("head", F.concat(F.lit(OPEN), name, F.lit("\n"))).withColumn("body", F.concat("text", F.lit(CLOSE)))
    t = t.withColumn("segment", F.concat("head", "body", F.lit("\n"))).withColumn("own", own)
    dialogue = Window.partitionBy("conv_id", "part", "speaker").orderBy(F.asc_nulls_first("turn"), "role", "text")
    t = t.withColumn("at", F.row_number().over(dialogue)).withColumn(
        "end", F.sum(F.length("segment")).over(dialogue.rowsBetween(Window.unboundedPreceding, 0))
    )
    t = t.withColumn("to", F.col("end") - 1)
    span = F.concat_ws(":", (F.col("to") - F.length("body")).cast("string"), F.col("to").cast("string"))
    kept = F.array_sort(F.collect_list(F.struct("at", "segment", F.when(F.col("own"), span).alias("span"))))
    out = t.groupBy("conv_id", "part", "speaker").agg(kept.alias("turns"))
    spans = F.filter(F.transform("turns", lambda x: x["span"]), lambda x: x.isNotNull())
    rendered = F.array_join(F.transform("turns", lambda x: x["segment"]), "")
    return out.select(
        "conv_id", "speaker", F.size("turns").cast("long").alias("n_turns"), F.size(spans).cast("long").alias("n_masked"),
        F.length(rendered).cast("long").alias("n_chars"), rendered.alias("rendered"), F.array_join(spans, ",").alias("mask"),
    )
