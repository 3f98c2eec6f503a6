"""Conversations as training windows of bounded size; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A turn is ``<turn:role>text</turn>`` and a line break.
OPEN, END = "<turn:", "</turn>\n"

#: What is written instead of characters of the template, in this order; read back in reverse.
ESCAPES = (("%", "%25"), ("<", "%3C"), (">", "%3E"))


def escaped(text: Column) -> Column:
    for plain, written in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescaped(text: Column) -> Column:
    for plain, written in reversed(ESCAPES):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def approximate_tokens(text: Column) -> Column:
    """About one token for four bytes, and four for the marks of a turn."""
    return (F.ceil(F.octet_length(text) / 4) + 4).cast("long")


def chat_windows(
    turns: DataFrame,
    budget: int = 1024,
    history_turns: int = 2,
    history_tokens: int = 256,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    tokens=approximate_tokens,
) -> DataFrame:
    """Cut conversations into windows of whole turns; a row per window.

    Columns ``conv_id``, ``window`` (0, 1, 2 ...), ``tokens``, ``formatted``, ``n_repeated`` (how
    many turns at its start were in an earlier window) and ``loss``: start and length in
    ``formatted`` of each assistant text that is new in the window.

    Prefix sums of turn tokens choose the spans: their running total is cut at multiples of half
    of what system turn and history leave of the budget, so a span is never over it. A longer
    turn is a span of its own, the only kind that can pass the budget. Each window begins with
    the system turn, if that is the first of the conversation, and the last turns of the span
    before, at most ``history_turns`` of at most ``history_tokens`` together; both are outside
    the loss, so each assistant text is under it once.

    Turns go by number, null first, ties by role and text. Null texts and roles are empty; a null
    conversation is one conversation; empty turns are kept; no rows give no windows.
    """
    in_order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    known = turns.select(
        F.col(conv_id).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).withColumn("tokens", tokens(F.col("text")))
    head = F.first(F.struct("role", "text", "tokens")).over(in_order)
    rows = (
        known.withColumn("nth", F.row_number().over(in_order))
        .withColumn("head", head)
        .withColumn("has_system", F.col("head.role") == "system")
        .withColumn("is_system", F.col("has_system") & (F.col("nth") == 1))
        .withColumn("counted", F.when(F.col("is_system"), 0).otherwise(F.col("tokens")))
        .withColumn(
            "step",
            F.greatest(
                F.floor(
                    (F.lit(budget - history_tokens) - F.when(F.col("has_system"), F.col("head.tokens")).otherwise(0)) / 2
                ),
                F.lit(1),
            ),
        )
        .withColumn("total", F.sum("counted").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("slot", F.floor((F.col("total") - 1) / F.col("step")))
        .withColumn("large", F.col("counted") > F.col("step"))
    )
    previous = F.lag(F.struct("slot", "large", "is_system")).over(in_order)
    starts = ~F.col("is_system") & (
        F.col("previous").isNull()
        | F.col("previous.is_system")
        | F.col("large")
        | F.col("previous.large")
        | (F.col("slot") != F.col("previous.slot"))
    )
    spans = (
        rows.withColumn("previous", previous)
        .withColumn("starts", starts)
        .withColumn(
            "span",
            F.greatest(
                F.sum(F.col("starts").cast("long")).over(in_order.rowsBetween(Window.unboundedPreceding, 0)) - 1,
                F.lit(0),
            ),
        )
        .withColumn("system", F.when(F.col("starts") & F.col("has_system"), F.col("head.text")))
        .withColumn("system_tokens", F.when(F.col("starts") & F.col("has_system"), F.col("head.tokens")))
        .select("conv_id", "span", "nth", "role", "text", "tokens", "is_system", "system", "system_tokens")
    )
    from_end = Window.partitionBy("conv_id", "span").orderBy(F.col("nth").desc())
    carried = (
        ~F.col("is_system")
        & (F.row_number().over(from_end) <= history_turns)
        & (F.sum("tokens").over(from_end.rowsBetween(Window.unboundedPreceding, 0)) <= history_tokens)
    )
    own = F.struct(F.col("span").alias("window"), F.lit(False).alias("repeated"))
    again = F.struct((F.col("span") + 1).alias("window"), F.lit(True).alias("repeated"))
    piece = F.concat(F.lit(OPEN), escaped(F.col("role")), F.lit(">"), escaped(F.col("text")), F.lit(END))
    placed = (
        spans.withColumn("carried", carried)
        .withColumn("to", F.explode(F.when(F.col("carried"), F.array(own, again)).otherwise(F.array(own))))
        .select(
            "conv_id", "to.window", "to.repeated", "nth", "role", "is_system",
            F.when(~F.col("to.repeated"), F.col("system")).alias("system"),
            F.when(~F.col("to.repeated"), F.col("system_tokens")).alias("system_tokens"),
            "tokens",
            piece.alias("piece"),
            F.length(escaped(F.col("text"))).alias("chars"),
        )
    )
    in_window = Window.partitionBy("conv_id", "window").orderBy("nth")
    ends = F.sum(F.length("piece")).over(in_window.rowsBetween(Window.unboundedPreceding, 0))
    part = F.struct("nth", "piece", "repeated", "role", "chars", "ends")
    windows = (
        placed.withColumn("ends", ends)
        .groupBy("conv_id", "window")
        .agg(
            F.array_sort(F.collect_list(part)).alias("parts"),
            F.max("system").alias("system"),
            F.sum("tokens").alias("tokens"),
            F.max("system_tokens").alias("system_tokens"),
            F.count_if("repeated").alias("n_history"),
            F.count_if(~F.col("repeated")).alias("n_own"),
        )
        .where("n_own > 0")
    )
    # The first window has the system turn as its own.
    again_system = F.when(
        (F.col("window") > 0) & F.col("system").isNotNull(),
        F.concat(F.lit(f"{OPEN}system>"), escaped(F.col("system")), F.lit(END)),
    ).otherwise(F.lit(""))
    repeats_system = F.col("again") != ""
    targets = F.filter("parts", lambda p: ~p["repeated"] & (p["role"] == "assistant"))
    return windows.withColumn("again", again_system).select(
        "conv_id",
        "window",
        (F.col("tokens") + F.when(repeats_system, F.col("system_tokens")).otherwise(0)).alias("tokens"),
        F.concat("again", F.array_join(F.transform("parts", lambda p: p["piece"]), "")).alias("formatted"),
        (F.col("n_history") + repeats_system.cast("int")).alias("n_repeated"),
        F.transform(
            targets,
            lambda p: F.struct(
                (F.length("again") + p["ends"] - len(END) - p["chars"]).cast("long").alias("start"),
                p["chars"].cast("long").alias("length"),
            ),
        ).alias("loss"),
    )


def read_back(windows: DataFrame) -> DataFrame:
    """The new turns and the text under the loss mask of each window, unescaped.

    Columns ``conv_id``, ``window``, ``turns`` (role and text) and ``loss_text``.
    """
    parts = F.split(F.col("formatted"), END)
    new = F.slice(parts, F.col("n_repeated") + 1, F.size(parts) - 1 - F.col("n_repeated"))

    def turn(part: Column) -> Column:
        role = F.substring_index(F.substr(part, F.lit(len(OPEN) + 1)), ">", 1)
        body = F.substr(part, F.length(role) + F.lit(len(OPEN) + 2))
        return F.struct(unescaped(role).alias("role"), unescaped(body).alias("text"))

    masked = F.transform("loss", lambda s: F.substr("formatted", s["start"] + 1, s["length"]))
    return windows.select(
        "conv_id",
        "window",
        F.transform(new, turn).alias("turns"),
        unescaped(F.array_join(masked, "")).alias("loss_text"),
    )
