"""Tables in sorted parts of exact length, lookups that read only the parts they need, and bucketed tables.

A table of parts lies below a folder, ``part=N`` holding rows N * rows to
(N + 1) * rows of the order of the key; a part on the border of two tasks has
two files, each sorted.  Beside it lie ``_index`` (a row for each part) and
``_stretches`` (a row for each part and run, with the blocks it reaches over).
A lookup joins the blocks of its keys with the stretches, by run and stretch of
blocks, so neither side is broadcast unless Spark knows it to be small, and
reads the parts that come out; a part holds whole key ranges, so no other part
can have a match.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import audit, intervals, order
from ..plans.verdict import Refused

KEY = order.KEY


def _beside(out: str, name: str) -> str:
    return f"{out.rstrip('/')}_{name}"


def write_parts(df: DataFrame, out: str, rows: int, key=KEY) -> DataFrame:
    """df in parts of exactly rows rows (the last may have fewer), their index and their stretches; returns the index.

    One exchange sorts; its partitions are cut at the parts' borders and written where they are.
    """
    ranged, starts = order.ranged(df, *key)
    part = F.call_function("div", F.col("_start") + F.col("_k"), F.lit(rows).cast("bigint")).cast("int")
    cut = ranged.join(F.broadcast(starts), "_shard").withColumn("part", part).select(*df.columns, "part")
    cut.sortWithinPartitions("part", *key).write.mode("errorifexists").partitionBy("part").parquet(out)
    spark = df.sparkSession
    k = F.struct(*key)
    back = spark.read.parquet(out).groupBy("part", key[0]).agg(F.count("*").alias("rows"), F.min(k).alias("first"), F.max(k).alias("last"), F.min(key[1]).alias("lo"), F.max(key[1]).alias("hi"))
    back.coalesce(1).write.mode("errorifexists").parquet(_beside(out, "stretches"))
    back = spark.read.schema(back.schema).parquet(_beside(out, "stretches"))
    by = back.groupBy("part").agg(F.sum("rows").alias("rows"), F.min("first").alias("f"), F.max("last").alias("l"))
    by = by.select("part", "rows", *(F.col(f"f.{c}").alias(f"first_{c}") for c in key), *(F.col(f"l.{c}").alias(f"last_{c}") for c in key))
    by.orderBy("part").coalesce(1).write.mode("errorifexists").parquet(_beside(out, "index"))
    index = spark.read.parquet(_beside(out, "index"))
    there, wanted = (x.agg(F.coalesce(F.sum(c), F.lit(0)).alias("n")).first()["n"] for x, c in ((index, "rows"), (starts, "_n")))
    if there != wanted:
        raise Refused(4, f"{there} of {wanted} rows came back from {out}")
    return index


def parts_hit(probe: DataFrame, out: str, key=KEY, exact: bool = False) -> list[int]:
    """The parts whose key range holds any of probe's keys; numbers only, a few for each file that is to be read.

    Blocks find parts first.  Where that leaves out half of the parts or more, or if exact, the keys themselves decide among
    these.
    """
    stretches = probe.sparkSession.read.parquet(_beside(out, "stretches"))
    place = lambda c: F.shiftright(F.col(c).cast("bigint"), intervals.BITS)
    spans = stretches.select(F.col(key[0]).alias("_run"), "part", "first", "last", F.explode(F.sequence(place("lo"), place("hi"))).alias("_stretch"))
    same = (F.col(key[0]) == F.col("_run")) & (place(key[1]) == F.col("_stretch"))
    e = F.col(key[2])
    seen = probe.groupBy(key[0], key[1]).agg(F.min(e).alias("_from"), F.max(e).alias("_to"))
    ends = [F.struct(*key[:2], F.col(c).alias(key[2])) for c in ("_from", "_to")]
    numbers = lambda df: sorted(r["part"] for r in df.select("part").distinct().collect())
    hit = numbers(seen.join(spans, same).where((F.col("last") >= ends[0]) & (F.col("first") <= ends[1])))
    if not exact and 2 * len(hit) > stretches.select("part").distinct().count():
        return hit
    k = F.struct(*key)
    return numbers(probe.select(*key).join(spans.where(F.col("part").isin(hit)), same).where((F.col("last") >= k) & (F.col("first") <= k)))


def read_parts(spark: SparkSession, out: str, parts: list[int]) -> DataFrame:
    """These parts only; none gives an empty table with the parts' columns."""
    if not parts:
        return spark.read.parquet(out).limit(0)
    return spark.read.option("basePath", out).parquet(*(f"{out.rstrip('/')}/part={p}" for p in parts))


def lookup(probe: DataFrame, out: str, key=KEY) -> DataFrame:
    """audit.match of probe with the table of parts, of which only the parts that its keys fall in are read."""
    return audit.match(probe, read_parts(probe.sparkSession, out, parts_hit(probe, out, key)), key)


class Bucketed(NamedTuple):
    """A table dealt to files by key, so joins and aggregations on the key need no exchange of it."""

    path: str
    name: str
    buckets: int


def write_bucketed(df: DataFrame, path: str, name: str, buckets: int, key=KEY) -> Bucketed:
    """df at path, dealt to buckets by key and sorted within; name is what the session's catalogue calls it.

    The rows are dealt before they are written, so each bucket is one file.
    """
    df.repartition(buckets, *key).sortWithinPartitions(*key).write.mode("error").option("path", path).bucketBy(buckets, *key).sortBy(*key).saveAsTable(name)
    return Bucketed(path, name, buckets)


def open_bucketed(spark: SparkSession, table: Bucketed, key=KEY) -> DataFrame:
    """The table, also in a session whose catalogue doesn't know it yet."""
    if not spark.catalog.tableExists(table.name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(table.path).schema)
        keys = ", ".join(key)
        spark.sql(f"CREATE TABLE {table.name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {table.buckets} BUCKETS LOCATION '{table.path}'")
    return spark.table(table.name)
