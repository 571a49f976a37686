"""Chat formatting by perspective rotation: every participant of a dialogue is the assistant once.

A dialogue becomes one row per perspective and turn, with its place in the rendered text and the span to learn, so a dialogue of any length
is rendered in parallel; ``transcripts`` puts rows together into texts of bounded length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.grouping import prefix_sums

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
SYSTEM = "system"
NOBODY = "unknown"


def _rendered(role: Column, speaker: Column, text: Column) -> tuple[Column, Column]:
    """Header and text of a turn as seen by a speaker. Markers inside the text are broken up, so that no text can end its turn."""
    header = (
        F.when(role == SYSTEM, F.lit(f"{OPEN}system\n")).when(role == speaker, F.lit(f"{OPEN}assistant\n"))
        .otherwise(F.concat(F.lit(f"{OPEN}user name="), F.regexp_replace(F.coalesce(role, F.lit(NOBODY)), r"[\s<>|]", "_"), F.lit("\n")))
    )
    return header, F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def rotate(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per dialogue, speaker and turn: conv, speaker, turn, role, rendered, start, learn_start, learn_end, learn.

    Every role but ``system`` is a participant. Its own turns are rendered as assistant with ``learn`` true, the span from learn_start to
    learn_end (in characters of the whole rendered dialogue) being its words and the end mark; elsewhere the span is empty. Others are users by
    name, a null role is a user named ``unknown`` and no participant. A dialogue without participants gives no rows. Null texts are
    empty; turns are ordered by number, null first, ties by role and text, repeated rows stay; a null conv is a dialogue too.
    """
    own = turns.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    speakers = own.filter((F.col("role") != SYSTEM) & F.col("role").isNotNull()).select(
        F.col("conv").alias("of"), F.col("role").alias("speaker")).distinct()
    seen = own.join(speakers, F.col("conv").eqNullSafe(F.col("of")))
    header, body = _rendered(F.col("role"), F.col("speaker"), F.col("text"))
    learn = F.coalesce(F.col("role") == F.col("speaker"), F.lit(False))
    shown = seen.select(
        "conv", "speaker", "turn", "role", F.concat(header, body, F.lit(CLOSE)).alias("rendered"), F.length(header).cast("long").alias("head"),
        learn.alias("learn"), F.coalesce("text", F.lit("")).alias("text")).withColumn("size", F.length("rendered").cast("long"))
    # running lengths over all rows in order; each dialogue and speaker starts at its first row
    order = [F.col(c).asc_nulls_first() for c in ("conv", "speaker", "turn", "role", "text")]
    placed = prefix_sums(shown, order, "size").withColumn("before", F.col("running") - F.col("size"))
    firsts = placed.groupBy(F.col("conv").alias("of"), F.col("speaker").alias("who")).agg(F.min("before").alias("base"))
    joined = placed.join(firsts, F.col("conv").eqNullSafe(F.col("of")) & (F.col("speaker") == F.col("who")))
    start = F.col("before") - F.col("base")
    return joined.select(
        F.col("conv").alias(conv_col), "speaker", F.col("turn").alias(turn_col), F.col("role").alias(role_col), "rendered", start.alias("start"),
        (start + F.col("head")).alias("learn_start"),
        F.when(F.col("learn"), start + F.col("size") - 1).otherwise(start + F.col("head")).alias("learn_end"), "learn")


def transcripts(rows: DataFrame, max_chars: int = 1 << 20, conv_col: str = "conv_id") -> DataFrame:
    """Rendered texts with their learn spans: conv, speaker, part, text, spans (relative to the text).

    A dialogue of up to ``max_chars`` is one text; a longer one is cut between turns, where a multiple of ``max_chars`` begins.
    """
    part = F.expr(f"start div {max_chars}")
    packed = rows.withColumn("part", part).groupBy(conv_col, "speaker", "part").agg(
        F.sort_array(F.collect_list(F.struct("start", "rendered", "learn", "learn_start", "learn_end"))).alias("turns"))
    first = F.get(F.col("turns.start"), F.lit(0))
    return packed.withColumn("first", first).select(
        conv_col, "speaker", "part", F.concat_ws("", F.col("turns.rendered")).alias("text"),
        F.transform(F.filter("turns", lambda t: t.learn),
                    lambda t: F.struct((t.learn_start - F.col("first")).alias("start"), (t.learn_end - F.col("first")).alias("end"))).alias("spans"))
