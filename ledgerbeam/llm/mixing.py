"""Mixing sources to target weights by weighted fair queueing.

Sources, by code point and null last, weigh 5, 2, 1, repeating, and share 150 %
of all words.  A target stops at twice its source's size; the excess goes to
the others by weight, which comes to the water level ``least(2 * size, level *
weight)``, read off one sort of the sources.

Within a source the documents queue in the order of a hash (MD5) of their ids
and texts, and queue a second time after the last.  A copy's virtual finish time
is the words of its source up to its end, divided by the source's target.  All
sources are served at once, each in proportion to its target.  A copy is one
piece, but for the ``TICKS`` ticks of virtual time up to 1: one that is in
service then is split there, so that all sources are even at each tick.  The
pieces are range-sorted by finish time, their running total is taken, and what
lies beyond the total budget, the whole words of all targets, is cut off.  A
copy of which only the first pieces are left keeps its first words.

Prefix sums run in two steps, so that a source with any share of the rows is
spread: sums by (source, slice of the hash), their running totals, then sums
within a slice.

Nulls: a null text has size 0; null sources form one source, null ids count as
ids.  Rows that tie in the hash are equal in id and text and take turns.  Sources without words have target 0.  Empty tables give
empty results.  Extra columns don't matter.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WHITE, cut, n_words, row_key

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_COPIES = 2
TICKS = 16


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, text_hash, size and the queue key of every row, stored."""
    t = F.xxhash64("text")
    return cut(
        docs.select(
            "doc_id", "source", t.alias("text_hash"), n_words(F.col("text")).alias("size"),
            F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("|"), F.md5(F.coalesce("text", F.lit(""))))).alias("queue"),
        )
    )


def targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, copies: int = MOST_COPIES) -> DataFrame:
    """source, source_size and target; one row a source."""
    by = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    by = by.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.pmod(number - 1, len(weights)) + 1).cast("double"))
    by = by.withColumn("most", F.lit(float(copies)) * F.col("source_size")).withColumn("full_at", F.col("most") / F.col("weight"))
    everything = Window.partitionBy()
    order = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)  # whole numbers, so differences are exact
    before = F.sum("most").over(running) - F.col("most")
    weight_from = F.sum("weight").over(everything) - F.sum("weight").over(running) + F.col("weight")
    by = by.withColumn("level", (F.lit(share) * F.sum("source_size").over(everything) - before) / weight_from)
    # the level of the first source that stays below its most; later ones show lower levels
    level = F.max(F.when(F.col("full_at") > F.col("level"), F.col("level"))).over(everything)
    return by.select("source", "source_size", F.least(F.col("most"), F.coalesce(level * F.col("weight"), F.col("most"))).alias("target"))


def queue(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, copies: int = MOST_COPIES) -> DataFrame:
    """sized with source_size, target, before (words of its source ahead of it) and the words taken of each copy."""
    rows = sized.count()
    bits = max(4, math.ceil(math.log2(max(1, min(rows / 500, 2 * math.sqrt(rows))))))
    # the first bits of the hash, out of 48 that are read as a number
    cut_in = sized.withColumn("slice", F.shiftright(F.conv(F.substr("queue", F.lit(1), F.lit(12)), 16, 10).cast("bigint"), 48 - bits).cast("int"))
    parts = cut_in.groupBy("source", "slice").agg(F.sum("size").alias("words"))
    ahead = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("offset", F.coalesce(F.sum("words").over(ahead), F.lit(0)))
    goals = targets(sized, weights, share, copies).withColumnRenamed("source", "s")
    parts = parts.join(goals, F.col("source").eqNullSafe(F.col("s"))).select(
        F.col("source").alias("s"), F.col("slice").alias("k"), "offset", "source_size", "target"
    )
    out = cut_in.join(parts, F.col("source").eqNullSafe(F.col("s")) & (F.col("slice") == F.col("k")))
    own = Window.partitionBy("source", "slice").orderBy("queue").rowsBetween(Window.unboundedPreceding, -1)
    out = out.withColumn("before", F.col("offset") + F.coalesce(F.sum("size").over(own), F.lit(0)))
    return served(out.select("doc_id", "source", "text_hash", "size", "source_size", "target", "before"), goals, copies)


def pieces(rows: DataFrame, copies: int) -> DataFrame:
    """source_key, before, copy, words, finish and at of each piece: copies of rows with words, split at the ticks that they are in service at."""
    copy = rows.where("size > 0 and target > 0").withColumn("copy", F.explode(F.array(*map(F.lit, range(copies)))))
    start = F.col("before") + F.col("source_size") * F.col("copy")
    copy = copy.withColumns({"_a": start, "_b": start + F.col("size")})
    tick = lambda words: F.floor(words * TICKS / F.col("target"))
    first, last = F.least(F.greatest(tick(F.col("_a")) - 1, F.lit(0)), F.lit(TICKS)), F.least(tick(F.col("_b")) + 1, F.lit(TICKS))
    copy = copy.withColumn("_k", F.explode(F.sequence(first, last)))
    edge = lambda k: F.floor(F.col("target") * k / TICKS)
    begin = F.greatest("_a", edge(F.col("_k")))
    # behind the last tick a copy is one piece
    end = F.when(F.col("_k") == TICKS, F.col("_b")).otherwise(F.least("_b", edge(F.col("_k") + 1)))
    cut_up = copy.select("source_key", "before", "copy", "target", begin.alias("at"), end.alias("_to")).where("_to > at")
    return cut_up.select("source_key", "before", "copy", "at", (F.col("_to") - F.col("at")).alias("words"), (F.col("_to") / F.col("target")).alias("finish"))


def truncated(parts: DataFrame, budget: int) -> DataFrame:
    """The first budget words of parts in order of finish, over all sources; the piece on the edge keeps its first words.

    A range exchange sorts; the sums of its partitions tell which of them lie before the edge, and only the one that the edge
    is in needs running totals.
    """
    order = ["finish", "source_key", "at"]
    count = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # stored, as the sums and the rows must come from the same partitions
    ranged = cut(parts.repartitionByRange(count, *order).select("*", F.spark_partition_id().alias("_shard")))
    sums = ranged.groupBy("_shard").agg(F.sum("words").alias("_n"))
    # a row for each partition
    sums = sums.withColumn("_before", F.sum("_n").over(Window.orderBy("_shard")) - F.col("_n"))
    edges = [(r["_shard"], r["_before"]) for r in sums.where((F.col("_before") < budget) & (F.col("_before") + F.col("_n") > budget)).collect()]
    whole = [r["_shard"] for r in sums.where(F.col("_before") + F.col("_n") <= budget).collect()]
    kept = ranged.where(F.col("_shard").isin(whole)) if whole else ranged.where(F.lit(False))
    for shard, before in edges:
        upto = F.sum("words").over(Window.partitionBy("_shard").orderBy(*order)) + before
        last = ranged.where(F.col("_shard") == shard).withColumn("_upto", upto).withColumn("words", F.least("words", F.lit(budget) - F.col("_upto") + F.col("words")))
        kept = kept.unionByName(last.where("words > 0").drop("_upto"))
    return kept.drop("_shard")


def served(rows: DataFrame, goals: DataFrame, copies: int) -> DataFrame:
    """rows with taken_0, taken_1 and so on: the words of each copy that the cut leaves."""
    keyed = rows.withColumn("source_key", F.coalesce(F.concat(F.lit("1"), F.col("source").cast("string")), F.lit("0")))
    budget = goals.agg(F.coalesce(F.sum(F.floor("target")), F.lit(0)).alias("n")).first()["n"]
    kept = truncated(pieces(keyed, copies), budget)
    # words ahead of it tell a row with words from all others of its source
    by = kept.groupBy("source_key", "before").agg(*(F.sum(F.when(F.col("copy") == c, F.col("words")).otherwise(0)).alias(f"taken_{c}") for c in range(copies)))
    full = keyed.where("size > 0").join(by, ["source_key", "before"], "left").select(*rows.columns, *(F.coalesce(f"taken_{c}", F.lit(0)).cast("bigint").alias(f"taken_{c}") for c in range(copies)))
    return full.unionByName(rows.where("size = 0").withColumns({f"taken_{c}": F.lit(0).cast("bigint") for c in range(copies)}))


def plan(docs: DataFrame, copies: int = MOST_COPIES) -> DataFrame:
    """What the mix takes of every row: doc_id, size, source_size, target, taken, and the first copy's virtual finish."""
    q = queue(sizes(docs), copies=copies)
    taken = sum((F.col(f"taken_{c}") for c in range(1, copies)), F.col("taken_0"))
    finish = F.when(F.col("target") > 0, (F.col("before") + F.col("size")) / F.col("target"))
    return q.select("doc_id", "size", "source_size", "target", taken.alias("taken"), finish.alias("virtual_finish"))


def mix(docs: DataFrame, copies: int = MOST_COPIES) -> DataFrame:
    """The mixed documents in order of virtual finish, with the columns of docs.

    A copy that is cut keeps its first words with the white space before them;
    n_chars, if there, is that of the text kept.
    """
    q = queue(sizes(docs), copies=copies)
    served = F.array(*(F.struct(F.col(f"taken_{c}").alias("n"), ((F.col("before") + F.col("source_size") * c + F.col(f"taken_{c}")) / F.col("target")).alias("finish")) for c in range(copies)))
    # rows that are equal in id and text take turns, on either side
    place = Window.partitionBy("null", "num", "hash")
    q = q.where("taken_0 > 0").select(F.col("doc_id").isNull().alias("null"), F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)).alias("num"), F.col("text_hash").alias("hash"), "source", "size", served.alias("served"))
    q = q.withColumn("turn", F.row_number().over(place.orderBy(F.col("source").asc_nulls_last(), F.get("served", F.lit(0))["finish"]))).drop("source")
    rows = docs.select(*(c.alias(name) for c, name in zip(row_key(), ("null", "num", "hash"), strict=True)), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    rows = rows.withColumn("again", F.row_number().over(place.orderBy(F.col("row.source").asc_nulls_last())))
    # the last condition is no key, so the exchange of the window serves the join as well
    keys = [F.col(f"r.{k}") == F.col(f"q.{k}") for k in ("null", "num", "hash")]
    both = rows.alias("r").join(q.alias("q"), keys + [F.col("q.turn") - F.col("r.again") == 0])
    both = both.select("row", "size", F.explode(F.filter("served", lambda x: x["n"] > 0)).alias("part"))
    text = F.when(F.col("part.n") >= F.col("size"), F.col("row.text")).otherwise(
        F.array_join(F.slice(F.regexp_extract_all(F.col("row.text"), F.lit(f"[{WHITE}]*[^{WHITE}]+"), F.lit(0)), F.lit(1), F.col("part.n").cast("int")), "")
    )
    both = both.withColumn("kept_text", text).orderBy("part.finish", "row.doc_id")
    change = {"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast("bigint")}
    return both.select(*((change[c] if c in change else F.col(f"row.`{c}`")).alias(c) for c in docs.columns))
