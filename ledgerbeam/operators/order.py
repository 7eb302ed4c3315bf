"""Order of files, exact sharding, and the global row index behind it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.store import stored

KEY = ("run", "luminosityBlock", "event")


def ranged(df: DataFrame, *order: str) -> tuple[DataFrame, DataFrame]:
    """df sorted by order with _shard and _k, a row's partition and its number there; and for each partition _shard, _n, _start,
    the rows in it and before it.

    A range exchange sorts.  The ranged rows are stored, as both readers must see the same partitions.
    """
    place = F.monotonically_increasing_id()
    count = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.repartitionByRange(count, *order).sortWithinPartitions(*order).select("*", F.shiftright(place, 33).alias("_shard"), place.bitwiseAND(F.lit((1 << 33) - 1)).alias("_k"))
    rows = stored(rows)
    starts = rows.groupBy("_shard").agg(F.count("*").alias("_n"))
    # a row for each partition
    return rows, starts.withColumn("_start", F.sum("_n").over(Window.orderBy("_shard")) - F.col("_n"))


def row_index(df: DataFrame, *order: str, name: str = "row_index") -> DataFrame:
    """df sorted by order with each row's number from 0, without a window over one partition."""
    rows, starts = ranged(df, *order)
    return rows.join(F.broadcast(starts.drop("_n")), "_shard").withColumn(name, F.col("_start") + F.col("_k")).drop("_shard", "_k", "_start")


def first_rows(df: DataFrame, n: int, key=KEY) -> DataFrame:
    """The first n rows in order of key."""
    return df.orderBy(*key).limit(n)


def shards(df: DataFrame, rows: int, key=KEY) -> DataFrame:
    """df with part: exactly rows to each part, but for the last."""
    return row_index(df, *key).withColumn("part", F.call_function("div", F.col("row_index"), F.lit(rows).cast("bigint")))


def shard_index(parts: DataFrame, key=KEY) -> DataFrame:
    """part, rows, first and last key."""
    k = F.struct(*key)
    by = parts.groupBy("part").agg(F.count("*").alias("rows"), F.min(k).alias("f"), F.max(k).alias("l"))
    return by.select("part", "rows", *(F.col(f"f.{c}").alias(f"first_{c}") for c in key), *(F.col(f"l.{c}").alias(f"last_{c}") for c in key))


STRETCH = "file string, lo bigint, hi bigint, n bigint, f array<bigint>, l array<bigint>, min_lumi bigint, max_lumi bigint, sorted boolean"


def stretches(rows: DataFrame, key=KEY, file: str = "file", pos: str = "pos") -> DataFrame:
    """Summaries of rows as they are stored: for each file and batch of rows of a task the first and last position, the number
    of rows, the first and last key by position, the least and largest block, and whether keys never decrease.

    Nothing is exchanged or sorted; a batch whose rows don't come by position is put in order by itself.
    """

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, at = np.array(batch.column("file").to_pylist(), object), batch.column("pos").to_numpy(zero_copy_only=False)
            keys = np.column_stack([batch.column(f"k{i}").to_numpy(zero_copy_only=False) for i in range(len(key))])
            out = []
            for name in dict.fromkeys(names.tolist()):
                mine = np.flatnonzero(names == name)
                mine = mine[np.argsort(at[mine], kind="stable")]
                k, p = keys[mine], at[mine]
                step = k[1:] - k[:-1]
                # the first component that changes tells whether a key is less than the one before it
                moved = step != 0
                first = step[np.arange(len(step)), moved.argmax(axis=1)]
                out.append((name, int(p[0]), int(p[-1]), len(p), k[0].tolist(), k[-1].tolist(), int(k[:, 1].min()), int(k[:, 1].max()), not (first < 0).any()))
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out)) or [()] * 9, kinds)], ["file", "lo", "hi", "n", "f", "l", "min_lumi", "max_lumi", "sorted"])

    plain = rows.select(F.col(file).alias("file"), F.col(pos).cast("bigint").alias("pos"), *(F.col(c).cast("bigint").alias(f"k{i}") for i, c in enumerate(key)))
    return plain.mapInArrow(of, STRETCH)


def folded(parts: DataFrame, key=KEY) -> DataFrame:
    """Stretches that don't overlap, by file: n, first and last key, least and largest block, sorted, and whether any overlapped.

    A file's stretches are one entry for ten thousand rows, gathered in order of position.
    """
    by = parts.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("lo", "hi", "f", "l", "sorted"))).alias("s"), F.sum("n").alias("n"), F.min("min_lumi").alias("min_lumi"), F.max("max_lumi").alias("max_lumi"))
    pairs = F.zip_with(F.slice("s", 1, F.size("s") - 1), F.slice("s", 2, F.size("s")), lambda x, y: F.struct(x.alias("x"), y.alias("y")))
    joined = F.forall(pairs, lambda p: p["x"]["l"] <= p["y"]["f"])
    apart = F.forall(pairs, lambda p: p["x"]["hi"] < p["y"]["lo"])
    first, last = F.col("s")[0]["f"], F.element_at("s", -1)["l"]
    return by.select(
        "file", "n", *(first[i].alias(f"first_{c}") for i, c in enumerate(key)), *(last[i].alias(f"last_{c}") for i, c in enumerate(key)), "min_lumi", "max_lumi",
        (F.forall("s", lambda x: x["sorted"]) & joined).alias("sorted"), apart.alias("apart"),
    )


def _by_position(rows: DataFrame, key=KEY, file: str = "file", pos: str = "pos") -> DataFrame:
    """The same for files whose stretches overlap: each file is put in order of position."""
    k = F.struct(*key)
    before = F.lag(k).over(Window.partitionBy(file).orderBy(pos))
    marked = rows.select(F.col(file).alias("file"), F.col(pos).alias("pos"), k.alias("k"), F.coalesce(before > k, F.lit(False)).alias("down"))
    by = marked.groupBy("file").agg(
        F.count("*").alias("n"), F.min_by("k", "pos").alias("f"), F.max_by("k", "pos").alias("l"),
        F.min(F.col(f"k.{key[1]}")).alias("min_lumi"), F.max(F.col(f"k.{key[1]}")).alias("max_lumi"), (F.count_if("down") == 0).alias("sorted"),
    )
    return by.select("file", "n", *(F.col(f"f.{c}").alias(f"first_{c}") for c in key), *(F.col(f"l.{c}").alias(f"last_{c}") for c in key), "min_lumi", "max_lumi", "sorted")


def file_order(rows: DataFrame, key=KEY, file: str = "file", pos: str = "pos") -> DataFrame:
    """By file: rows, first and last key in stored order, least and largest block, and whether the keys never decrease.

    Summaries of stored stretches are folded.  Files whose rows don't come in order of pos, which none that a scan numbers do,
    are put in order first.
    """
    found = stored(folded(stretches(rows, key, file, pos), key))
    good = found.where("apart").drop("apart")
    rest = found.where("not apart").select(F.col("file").alias(file))
    if not rest.take(1):
        return good
    return good.unionByName(_by_position(rows.join(rest, file, "left_semi"), key, file, pos))


def file_overlap(order: DataFrame, key=KEY) -> DataFrame:
    """file_order's rows, by file, against the file before: out of order, and overlapping in blocks (touching counts).

    One row a file: the window without partitions sees a list of files, not events.
    """
    first, last = F.struct(*(f"first_{c}" for c in key)), F.struct(*(f"last_{c}" for c in key))
    w = Window.orderBy("file")
    return order.where("n > 0").select(
        "file", "sorted", F.coalesce(~(F.lag(last).over(w) <= first), F.lit(False)).alias("out_of_order"),
        F.coalesce(F.lag("max_lumi").over(w) >= F.col("min_lumi"), F.lit(False)).alias("overlaps"),
    )


def order_verdict(overlap: DataFrame) -> DataFrame:
    counts = overlap.agg(F.count_if(~F.col("sorted")).alias("unsorted"), F.count_if("out_of_order").alias("out_of_order"), F.count_if("overlaps").alias("overlaps"))
    return counts.withColumn(
        "verdict", F.when((F.col("unsorted") > 0) | (F.col("out_of_order") > 0), "not strictly ordered").when(F.col("overlaps") > 0, "overlapping").otherwise("ordered")
    )
