"""Chat formatting in budgeted windows.

A conversation's rows, ordered by turn, are written as
``<|im_start|>role\\ntext<|im_end|>\\n`` each.  A turn has a token for every
``PIECE`` characters of a word, or part of them, and ``MARKS`` more.  What the
budget leaves beside the system turn that opens the conversation and the history
is the span.  Prefix sums of the turns' tokens cut the conversation at the
multiples of the span: turns that start between two of them are a window, but if
they pass the span together, the last one, which reaches over the multiple, is a
window by itself.  So windows are aligned to turns, no turn is cut, and a window
with its system turn and history keeps the budget; only a single turn that
doesn't fit beside the system turn makes a window larger.

Later windows retain the system turn and repeat the last turns of the window
before, as far as they fit in ``history`` tokens and the budget.  The loss mask
holds the texts of assistant turns; repeated ones are masked out, so each is a
target once.  A window's number is that of its first turn in the conversation.

Escaping: in texts and roles every ``<``, ``!`` repeated k >= 0 times, ``|``
gets one more ``!``; so no ``<|`` remains and reading takes one ``!`` away.
Line ends in roles become ``<|nl|>``.

Nulls: a null text or role is empty, a null turn comes first, rows with a null
conv_id form one conversation.  Rows that tie in turn go by role, then text;
repeated rows are turns of their own.  Empty tables give empty results.  Extra
columns are not returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUDGET = 1024
HISTORY = 128
MARKS = 4  # tokens of a turn's marks and role, where each is a token
OPEN, CLOSE, NEW_LINE = "<|im_start|>", "<|im_end|>", "<|nl|>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(!*)\|", r"<!$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<!(!*)\|", r"<$1|")


def windows(rows: DataFrame, budget: int = BUDGET, history: int = HISTORY, size: str | None = None) -> DataFrame:
    """conv_id, window, formatted, repeated (turns at its head that earlier windows hold), loss (start and length of each target).

    size: the column with the tokens of each turn's text, escaped, and role; null counts as 0.
    """
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    head = F.concat(F.lit(OPEN), F.replace(escape(role), F.lit("\n"), F.lit(NEW_LINE)), F.lit("\n"))
    tokens = F.octet_length(head) + F.octet_length(escape(text)) + len(CLOSE) + 1 if size is None else F.coalesce(F.col(size), F.lit(0)) + MARKS
    turn = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), head.alias("head"), escape(text).alias("body"), tokens.cast("bigint").alias("tokens"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    turn = turn.withColumns({"n": F.row_number().over(order), "sum": F.sum("tokens").over(upto)})
    opens = (F.first("role").over(upto) == "system").cast("bigint") * F.first("tokens").over(upto)
    turn = turn.withColumn("system", opens).withColumn("lead", (F.col("n") == 1) & (F.col("system") > 0))
    # places are counted behind the system turn, which the first window holds
    turn = turn.withColumn("end", F.col("sum") - F.col("system")).withColumn("start", F.when(F.col("lead"), F.lit(0)).otherwise(F.col("end") - F.col("tokens")))
    turn = turn.withColumn("span", F.greatest(F.lit(budget - history) - F.col("system"), F.lit(1))).withColumn("k", F.floor(F.col("start") / F.col("span")))
    stretch = Window.partitionBy("conv_id", "k")
    passes = F.max("end").over(stretch) - F.min("start").over(stretch) > F.col("span")
    turn = turn.withColumn("last", passes & (F.col("end") > (F.col("k") + 1) * F.col("span")) & ~F.col("lead"))
    whole = Window.partitionBy("conv_id", "k", "last")
    turn = turn.withColumns({"window": F.min("n").over(whole), "until": F.max("n").over(whole), "stop": F.max("end").over(whole)})
    turn = turn.withColumn("held", F.col("stop") - F.min("start").over(whole))
    # what the next window holds, as the last turn of this one sees it
    after = Window.partitionBy("conv_id").orderBy("n")
    turn = turn.withColumn("ahead", F.lead("held").over(after))
    turn = turn.withColumn("ahead", F.max(F.when(F.col("n") == F.col("until"), F.col("ahead"))).over(whole))
    room = F.least(F.lit(history), F.lit(budget) - F.col("system") - F.col("ahead"))
    repeat = ~F.col("lead") & F.col("ahead").isNotNull() & (F.col("stop") - F.col("start") <= room)
    turn = turn.select("conv_id", "window", "n", "role", "head", "body", (F.col("until") + 1).alias("next"), "lead", repeat.alias("again"))
    own = turn.select("conv_id", "window", F.lit(False).alias("repeat"), "n", "role", "head", "body")
    again = turn.where("again").select("conv_id", F.col("next").alias("window"), F.lit(True).alias("repeat"), "n", "role", "head", "body")
    later = own.where("n = window and n > 1").select(F.col("conv_id").alias("c"), F.col("window").alias("w"))
    first = turn.where("lead").select("conv_id", "n", "role", "head", "body")
    system = first.join(later, F.col("conv_id").eqNullSafe(F.col("c"))).select("conv_id", F.col("w").alias("window"), F.lit(True).alias("repeat"), "n", "role", "head", "body")
    parts = own.unionByName(again).unionByName(system).withColumn("part", F.concat("head", "body", F.lit(CLOSE + "\n")))
    inside = Window.partitionBy("conv_id", "window").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("at", F.coalesce(F.sum(F.char_length("part")).over(inside), F.lit(0)))
    target = (F.col("role") == "assistant") & ~F.col("repeat")
    span = F.struct((F.col("at") + F.char_length("head")).cast("bigint").alias("start"), F.char_length("body").cast("bigint").alias("length"))
    packed = parts.groupBy("conv_id", "window").agg(
        F.sort_array(F.collect_list(F.struct("n", "part", F.when(target, span).alias("span")))).alias("turns"), F.count_if("repeat").alias("repeated")
    )
    return packed.select(
        "conv_id", "window",
        F.array_join(F.transform("turns", lambda x: x["part"]), "").alias("formatted"),
        "repeated",
        F.filter(F.transform("turns", lambda x: x["span"]), lambda x: x.isNotNull()).alias("loss"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, window, turns (role and text of those that are no repeats) and targets (texts under the loss mask) from windows' output."""
    # after the split at the opening mark, the first piece is the empty string before it
    pieces = F.slice(F.split("formatted", r"<\|im_start\|>"), F.col("repeated").cast("int") + 2, F.size(F.split("formatted", r"<\|im_start\|>")))
    parsed = F.transform(
        pieces,
        lambda x: F.struct(
            unescape(F.replace(F.substring_index(x, "\n", 1), F.lit(NEW_LINE), F.lit("\n"))).alias("role"),
            unescape(F.substr(x, F.instr(x, F.lit("\n")) + 1, F.char_length(x) - F.instr(x, F.lit("\n")) - len(CLOSE) - 1)).alias("text"),
        ),
    )
    targets = F.transform("loss", lambda s: unescape(F.substr("formatted", (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return formatted.select("conv_id", "window", "formatted", parsed.alias("turns"), targets.alias("targets"))
