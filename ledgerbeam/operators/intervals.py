"""Run and block intervals (masks) against tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.verdict import Refused, Verdict


def parse_mask(texts: DataFrame, column: str = "value") -> DataFrame:
    """run, lo, hi (inclusive) from JSON ``{"run": [[first, last], ...]}``."""
    runs = texts.select(F.explode(F.map_entries(F.from_json(column, "map<string, array<array<bigint>>>"))).alias("e"))
    pairs = runs.select(F.col("e.key").cast("bigint").alias("run"), F.explode("e.value").alias("p"))
    return pairs.select("run", F.get("p", F.lit(0)).alias("lo"), F.get("p", F.lit(1)).alias("hi"), F.size("p").alias("parts"))


def checked_mask(mask: DataFrame) -> DataFrame:
    """The mask without its check column; refused (2) unless it has intervals and all are 1 <= lo <= hi."""
    row = mask.agg(F.count("*").alias("n"), F.count_if(~F.coalesce((F.col("parts") == 2) & (F.col("lo") >= 1) & (F.col("lo") <= F.col("hi")), F.lit(False))).alias("bad")).first()
    if not row["n"] or row["bad"]:
        raise Refused(2, f"mask with {row['n']} intervals, {row['bad']} bad ones")
    return mask.drop("parts")


#: Blocks of a stretch are numbered within 2**BITS.
BITS = 10
#: Blocks of a word of bits.
WORD = 6


def words(mask: DataFrame) -> DataFrame:
    """run, word (of 64 blocks) and bits, one for each block that the mask has there.

    Bits come from the ends of intervals, so no block becomes a row.
    """
    valid = mask.where("lo <= hi").select("run", "lo", "hi", F.explode(F.sequence(F.shiftright("lo", WORD), F.shiftright("hi", WORD))).alias("word"))
    start = F.when(F.shiftright("lo", WORD) == F.col("word"), F.col("lo").bitwiseAND(F.lit(63))).otherwise(0).cast("int")
    end = F.when(F.shiftright("hi", WORD) == F.col("word"), F.col("hi").bitwiseAND(F.lit(63))).otherwise(63).cast("int")
    ones = F.lit(-1).cast("bigint")
    bits = F.call_function("shiftleft", ones, start).bitwiseAND(F.call_function("shiftrightunsigned", ones, F.lit(63) - end))
    return valid.groupBy("run", "word").agg(F.bit_or(bits).alias("bits"))


def seen_words(rows: DataFrame) -> DataFrame:
    """run, word and bits of the blocks that rows have."""
    block = F.col("luminosityBlock").cast("bigint")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), block.bitwiseAND(F.lit(63)).cast("int"))
    return rows.groupBy("run", F.shiftright(block, WORD).alias("word")).agg(F.bit_or(bit).alias("bits"))


def _marked(rows: DataFrame, mask: DataFrame) -> DataFrame:
    """rows with _in, by one bit; the join is on run and word, so rows of one run are spread."""
    m = words(mask).select(F.col("run").alias("_run"), F.col("word").alias("_word"), F.col("bits").alias("_bits"))
    block = F.col("luminosityBlock").cast("bigint")
    both = rows.join(m, (F.col("run") == F.col("_run")) & (F.shiftright(block, WORD) == F.col("_word")), "left")
    bit = F.getbit(F.col("_bits"), block.bitwiseAND(F.lit(63)).cast("int")) == 1
    return both.select(*rows.columns, F.coalesce(bit, F.lit(False)).alias("_in"))


def _inside(rows: DataFrame, mask: DataFrame, want: bool) -> DataFrame:
    return _marked(rows, mask).where(F.col("_in") if want else ~F.col("_in")).drop("_in")


def inside(rows: DataFrame, mask: DataFrame) -> DataFrame:
    return _inside(rows, mask, True)


def outside(rows: DataFrame, mask: DataFrame) -> DataFrame:
    return _inside(rows, mask, False)


def blocks(rows: DataFrame, file: str | None = None, file_index: str | None = None) -> DataFrame:
    """Distinct run and block, with rows and the first file that has them."""
    by = rows.groupBy("run", "luminosityBlock")
    return by.agg(F.count("*").alias("rows"), *([F.min_by(file, file_index).alias("first_file")] if file else []))


def coverage(seen: DataFrame, mask: DataFrame) -> DataFrame:
    """One row: mask_lumis (overlapping intervals count twice), seen, inside and outside distinct blocks, and unseen ones.

    Both sides are words of bits, a row for 64 blocks; what they share and don't share is counted in bits.
    """
    both = seen_words(seen).withColumnRenamed("bits", "s").join(words(mask).withColumnRenamed("bits", "m"), ["run", "word"], "full_outer")
    s, m = (F.coalesce(c, F.lit(0).cast("bigint")) for c in ("s", "m"))
    total = lambda bits: F.coalesce(F.sum(F.bit_count(bits)), F.lit(0)).cast("bigint")
    counts = both.agg(total(s).alias("seen"), total(s.bitwiseAND(m)).alias("inside"), total(s.bitwiseAND(F.bitwise_not(m))).alias("outside"), total(m.bitwiseAND(F.bitwise_not(s))).alias("unseen"))
    lumis = mask.agg(F.coalesce(F.sum(F.col("hi") - F.col("lo") + 1), F.lit(0)).alias("mask_lumis"))
    # one row each
    one = lambda df: df.withColumn("_k", F.lit(1))
    return one(lumis).join(one(counts), "_k").select("mask_lumis", "seen", "inside", "outside", "unseen")


def containment(rows: DataFrame, mask: DataFrame, full: bool = False) -> Verdict:
    """1 if a block lies outside, 5 if there are no rows, 4 if the whole mask is wanted and not seen."""
    c = coverage(rows, mask).first().asDict()
    code = 1 if c["outside"] else 5 if not c["seen"] else 4 if full and c["unseen"] else 0
    return Verdict(code, {1: "outside", 5: "seen", 4: "unseen"}.get(code), c)
