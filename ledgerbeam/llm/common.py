"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.store import shared_dir

#: Characters that separate words: space and U+0009 to U+000D.
WHITE = "\\x20\\x09-\\x0D"
BLANKS = " \t\n\x0b\x0c\r"
#: Small rows that are a task's worth.
PIECE = 8192


def cut(df: DataFrame) -> DataFrame:
    """Store df reliably and cut its lineage there."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def pieces(rows: int) -> int:
    """The tasks that so many small rows are worth."""
    return max(1, -(-rows // PIECE))


def counted(df: DataFrame) -> tuple[DataFrame, int]:
    """df, of small rows, stored as cut does, and its number of rows.

    It is read again by a task for each PIECE rows, if it has no fewer partitions: a task leaves some kB in shuffle files and
    in the event log even if it has no rows, which many steps over few rows add up to more than their data.
    """
    seen = Observation()
    out = cut(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    # nothing is observed where Spark knows that df is empty
    rows = seen.get.get("rows", 0)
    return out.coalesce(pieces(rows)), rows


def compact(df: DataFrame) -> DataFrame:
    """counted without the number."""
    return counted(df)[0]


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """rows, which have a column g, with idx, the number from 0 in order within g, and n, the number of rows of g.

    A range exchange sorts by g and order; the sizes of each g's stretch in each partition give the offsets, so a large g
    lies in many partitions.  What is equal in all columns is told apart by where it was read.
    """
    place = F.monotonically_increasing_id()
    count = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = rows.withColumn("_at", place)
    ranged = keyed.repartitionByRange(count, "g", *order, "_at").sortWithinPartitions("g", *order, "_at")
    # stored, as the offsets and the rows must come from the same partitions
    ranged = cut(ranged.drop("_at").withColumns({"_shard": F.shiftright(place, 33), "_k": place.bitwiseAND(F.lit((1 << 33) - 1))}))
    by = ranged.groupBy("g", "_shard").agg(F.count("*").alias("_n"), F.min("_k").alias("_first"))
    # a row for each partition that a g lies in
    upto, whole = Window.partitionBy("g").orderBy("_shard").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("g")
    by = by.withColumns({"_before": F.coalesce(F.sum("_n").over(upto), F.lit(0)), "n": F.sum("_n").over(whole)})
    both = ranged.join(by.select("g", "_shard", "_first", "_before", "n"), ["g", "_shard"])
    return both.withColumn("idx", F.col("_before") + F.col("_k") - F.col("_first")).drop("_shard", "_k", "_first", "_before")


def words(text: Column) -> Column:
    """Words of text as an array; null and blank texts have none."""
    t = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, f"[{WHITE}]+"))


def n_words(text: Column) -> Column:
    """Number of words, without keeping them."""
    t = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(t == "", F.lit(0)).otherwise(F.size(F.split(t, f"[{WHITE}]+"))).cast("bigint")


def row_key() -> tuple:
    """What tells rows of documents from each other, up to equal ones: whether the id is null, the id, the text's hash."""
    return F.col("doc_id").isNull(), F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)), F.xxhash64("text")


def free_name(df: DataFrame, wanted: str) -> str:
    """wanted, or a variant of it that no column of df bears (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
