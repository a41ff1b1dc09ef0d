"""Chat formatting in budgeted windows, with DataFrame operations only.

A conversation becomes windows of whole turns. Prefix sums of the turns' tokens lay a
grid of `budget` tokens over it: the turns inside one cell of the grid form a window,
and a turn that crosses a cell's end is a window of its own. So a window's new turns
hold at most `budget` tokens, or are a single longer turn. Every window opens with the
conversation's system turn, then repeats up to `history_turns` turns from before if
they hold at most `history_budget` tokens, then gives its new turns. Loss covers the
texts of new assistant turns only; what is repeated is masked.

Template: `<|im_start|>role\\ntext<|im_end|>\\n`. Inside roles and texts a backslash is put
into every control string, of this template and of common others, behind any backslashes
it already has there; removing one gives the text back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import col, written

BUDGET = 512
HISTORY_TURNS = 2
HISTORY_BUDGET = 256
# Tokens that the template adds to each turn.
TURN_TOKENS = 4
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
# How control strings begin: <|..|>, <s>, </s>, [INST], [/INST], <<SYS>>, <</SYS>>.
CONTROL = r"(\||/?s>|</?SYS>|/?INST\])"
# Rows of one conversation are dealt over blocks of so many turn numbers.
TURNS_PER_BLOCK = 4_096


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)(?=" + CONTROL + ")", r"$1\\$2")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)(?=" + CONTROL + ")", r"$1$2")


def tokens_of(text: Column) -> Column:
    """Words, and the template's own tokens."""
    return F.size(F.array_remove(F.split(text, r"\s+"), "")) + TURN_TOKENS


def _placed(turns: DataFrame) -> DataFrame:
    """Turns with `place` (rank from 0) and `before` (tokens of all turns before).

    Ranks and sums run inside blocks of turn numbers; block totals are put in order
    per conversation. So a long conversation is dealt over many tasks.
    """
    blocked = turns.withColumn("block", F.floor(F.col("turn") / TURNS_PER_BLOCK))
    totals = blocked.groupBy("conv", "block").agg(F.count("*").alias("n"), F.sum("tokens").alias("t"))
    earlier = Window.partitionBy("conv").orderBy(F.col("block").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        F.col("conv").alias("c"),
        F.col("block").alias("b"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first_place"),
        F.coalesce(F.sum("t").over(earlier), F.lit(0)).alias("first_tokens"),
    )
    order = Window.partitionBy("conv", "block").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    inside = order.rowsBetween(Window.unboundedPreceding, -1)
    ranked = blocked.withColumn("rank", F.row_number().over(order) - 1).withColumn(
        "sum", F.coalesce(F.sum("tokens").over(inside), F.lit(0))
    )
    same = F.col("conv").eqNullSafe(F.col("c")) & F.col("block").eqNullSafe(F.col("b"))
    return ranked.join(starts, same).select(
        "conv",
        "role",
        "text",
        "tokens",
        (F.col("first_place") + F.col("rank")).alias("place"),
        (F.col("first_tokens") + F.col("sum")).alias("before"),
    )


def windows(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    budget: int = BUDGET,
    history_turns: int = HISTORY_TURNS,
    history_budget: int = HISTORY_BUDGET,
) -> DataFrame:
    """One row per window: conv, window, n_repeated, formatted, loss.

    window numbers grow along a conversation (with gaps); n_repeated counts the
    leading repeated turns, the system turn included; loss is an array of (start, length)
    in code points of `formatted`. The system turn is the first turn if its role is
    `system`. NULL texts and roles count as empty; NULL conversation ids are one
    conversation; NULL turns come first, and rows with one turn number are ordered by role
    and text, repeated rows kept. An empty table gives no windows.
    """
    source = turns.select(
        col(conv_col).alias("conv"),
        col(turn_col).alias("turn"),
        F.coalesce(col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"),
    ).withColumn("tokens", tokens_of(F.col("text")).cast("long"))
    cell = F.floor(F.col("before") / budget)
    crosses = F.floor((F.col("before") + F.col("tokens") - 1) / budget) > cell
    placed = written(_placed(source).withColumn("window", 2 * cell + crosses.cast("long")))

    same_conv = F.col("conv").eqNullSafe(F.col("of"))
    openings = placed.groupBy("conv", "window").agg(
        F.min(F.struct("place", "before")).alias("first")
    ).select(F.col("conv").alias("of"), F.col("window").alias("into"), "first.place", F.col("first.before").alias("reach"))
    new = placed.select("conv", "window", "place", "role", "text", F.lit(False).alias("repeated"))
    system = placed.filter("place = 0 AND role = 'system'").select("conv", "role", "text")
    opened = system.join(openings.filter("place > 0").drop("place"), same_conv).select(
        "conv", F.col("into").alias("window"), F.lit(-1).cast("long").alias("place"), "role", "text", F.lit(True).alias("repeated")
    )
    back = openings.select(
        "of", "into", "reach", F.explode(F.transform(F.lit(list(range(1, history_turns + 1))), lambda k: F.col("place") - k)).alias("at")
    ).filter("at >= 0")
    repeated = (
        placed.join(back, same_conv & (F.col("place") == F.col("at")))
        .filter(F.col("reach") - F.col("before") <= history_budget)
        .filter("place > 0 OR role <> 'system'")
        .select("conv", F.col("into").alias("window"), "place", "role", "text", F.lit(True).alias("repeated"))
    )

    every = new.unionByName(opened).unionByName(repeated)
    head = F.concat(F.lit(OPEN), escaped(F.col("role")), F.lit("\n"))
    body = escaped(F.col("text"))
    formed = every.select(
        "conv",
        "window",
        F.struct(
            "place",
            F.concat(head, body, F.lit(CLOSE)).alias("piece"),
            F.length(head).alias("lead"),
            F.when(~F.col("repeated") & (F.col("role") == "assistant"), F.length(body)).alias("loss"),
            "repeated",
        ).alias("part"),
    )
    # A window's new turns are bounded by its budget, every turn counting at least TURN_TOKENS.
    gathered = formed.groupBy("conv", "window").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    none = F.array().cast("array<struct<start:int,length:int>>")
    step = F.aggregate(
        "parts",
        F.struct(F.lit(0).alias("at"), none.alias("loss")),
        lambda acc, part: F.struct(
            (acc["at"] + F.length(part["piece"])).alias("at"),
            F.when(part["loss"].isNull(), acc["loss"])
            .otherwise(
                F.concat(
                    acc["loss"],
                    F.array(F.struct((acc["at"] + part["lead"]).alias("start"), part["loss"].alias("length"))),
                )
            )
            .alias("loss"),
        ),
        lambda acc: acc["loss"],
    )
    return gathered.select(
        "conv",
        "window",
        F.size(F.filter("parts", lambda p: p["repeated"])).cast("long").alias("n_repeated"),
        F.array_join(F.transform("parts", lambda p: p["piece"]), "").alias("formatted"),
        step.alias("loss"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted window as structs of role and text."""
    # The text before the first marker is empty.
    pieces = F.filter(F.split(formatted, r"<\|im_start\|>"), lambda piece: piece != "")

    def turn(piece: Column) -> Column:
        cut = F.instr(piece, "\n")
        return F.struct(
            unescaped(F.substring_index(piece, "\n", 1)).alias("role"),
            unescaped(F.substr(piece, cut + 1, F.length(piece) - cut - len(CLOSE))).alias("text"),
        )

    return F.transform(pieces, turn)


def read_back(formatted: DataFrame) -> DataFrame:
    """conv, n_turns, turns_text, loss_text, formatted_chars: conversations restored from windows.

    turns_text gives role, newline, text, newline for each turn; loss_text is all text under
    the loss mask. A conversation is one row here, as long as the conversation is.
    """
    read = formatted.select(
        "conv",
        "window",
        F.length("formatted").cast("long").alias("chars"),
        F.filter(read_turns(F.col("formatted")), lambda turn, i: i >= F.col("n_repeated")).alias("turns"),
        F.array_join(
            F.transform("loss", lambda s: unescaped(F.substr("formatted", s["start"] + 1, s["length"]))), ""
        ).alias("loss"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    parts = read.select(
        "conv",
        "chars",
        F.size("turns").cast("long").alias("n"),
        F.struct("window", F.array_join(lines, "").alias("turns"), "loss").alias("part"),
    )
    whole = parts.groupBy("conv").agg(
        F.sum("n").alias("n_turns"),
        F.sum("chars").alias("formatted_chars"),
        F.array_sort(F.collect_list("part")).alias("parts"),
    )
    return whole.select(
        "conv",
        "n_turns",
        F.array_join(F.transform("parts", lambda p: p["turns"]), "").alias("turns_text"),
        F.array_join(F.transform("parts", lambda p: p["loss"]), "").alias("loss_text"),
        "formatted_chars",
    )
