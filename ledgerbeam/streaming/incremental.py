"""Incremental audit: a file stream of sidecar rows, counters kept up to date batch by batch.

An addition to the batch operators, which need none of it.  Which keys came
before is keyed state of the stream, kept in RocksDB: one bit for each event,
in rows of ``STRETCH`` bits by run, block and stretch of events.  A batch reads
and writes the bits of its own keys only, whatever came before it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions import codec
from ..functions.store import stored
from ..operators import audit
from ..sources import parts

#: Where Spark keeps the state, and bits of a row of it: 2 KB.
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
BITS = 14
STRETCH = 1 << BITS
#: Files of a batch that write_batch writes.
FILES = 8


def write_batch(rows: DataFrame, path: str) -> None:
    """Rows that are to come as one batch, as FILES files more in path: they are exchanged as they come, so no task makes or holds
    more than it reads and writes.  A batch of few rows may give fewer files; which batch brings a key changes no sum."""
    rows.repartition(FILES).write.mode("append").parquet(path)


def stream(spark: SparkSession, path: str, schema, files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def _mark(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The rows of a stretch with repeat: whether their event was there before, in this batch or in an earlier one."""
    bits = np.unpackbits(np.frombuffer(state.get[0], np.uint8)).astype(bool) if state.exists else np.zeros(STRETCH, bool)
    for rows in chunks:
        # of equal keys in a chunk the least row is the first
        rows = rows.sort_values(list(rows.columns), kind="stable")
        at = (rows[audit.KEY[2]].to_numpy() & (STRETCH - 1)).astype(np.int64)
        repeat = bits[at] | rows.duplicated(audit.KEY[2]).to_numpy()
        bits[at] = True
        yield rows.drop(columns="_stretch").assign(repeat=repeat)
    state.update((np.packbits(bits).tobytes(),))


def marked(rows: DataFrame) -> DataFrame:
    """The stream's rows with repeat."""
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", repeat boolean"
    placed = rows.withColumn("_stretch", F.shiftright(F.col(audit.KEY[2]).cast("bigint"), BITS))
    return placed.groupBy(*audit.KEY[:2], "_stretch").applyInPandasWithState(_mark, out, "bits binary", "append", GroupStateTimeout.NoTimeout)


def incremental_counters(rows: DataFrame, reference: DataFrame | str, out: str, checkpoint: str):
    """A query that writes, for every batch of new rows, below out: the counters of the reference's rows that match its new keys
    (counters), their census by sub-code (census), and the number of rows that repeat a key (repeats).

    A key counts once, in the batch that brings it first; later rows with it are repeats.  What no batch matches is counted
    by totals, once, at the end.  A batch that runs again overwrites its own folders, so sums over them count each row once.
    reference: a table, which every batch joins, or the folder of a table of parts, of which a batch reads the parts that its
    keys fall in.  The session is set to keep the state of streams in RocksDB.
    """

    def one(batch: DataFrame, number: int) -> None:
        at = lambda name: f"{out}/{name}/batch={number}"
        # once: reading the batch advances the state
        batch = stored(batch)
        fresh = batch.where(~F.col("repeat")).drop("repeat")
        known = reference
        if isinstance(reference, str):
            known = parts.read_parts(batch.sparkSession, reference, parts.parts_hit(fresh, reference)).drop("part")
        matched = audit.match(known, fresh).where(F.col("side").isNotNull())
        audit.counters(matched).write.mode("overwrite").parquet(at("counters"))
        fresh.groupBy(codec.sub_code("Expanded_genTtbarId").alias("sub")).agg(F.count("*").alias("n")).write.mode("overwrite").parquet(at("census"))
        batch.agg(F.count_if("repeat").alias("n_dup")).write.mode("overwrite").parquet(at("repeats"))

    rows.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    return marked(rows).writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def totals(spark: SparkSession, out: str, reference: DataFrame) -> DataFrame:
    """One row: the counters of all batches together, as the batch audit of the whole gives them, and n_dup."""
    df = spark.read.parquet(f"{out}/counters")
    sums = df.agg(*(F.sum(c).alias(c) for c in df.columns if c not in ("batch", "nano_entries", "unmatched", "run_not_1", "not_conserved")))
    whole = reference.agg(F.count("*").alias("nano_entries"), F.count_if(F.col("run") != 1).alias("run_not_1"))
    n_dup = spark.read.parquet(f"{out}/repeats").agg(F.sum("n_dup").alias("n_dup"))
    # one row each
    one = lambda x: x.withColumn("_k", F.lit(1))
    all_ = one(sums).join(one(whole), "_k").join(one(n_dup), "_k").drop("_k")
    return all_.withColumns({"unmatched": F.col("nano_entries") - F.col("matched"), "not_conserved": F.abs(F.col("nAddBJets_ge3") - F.col("expanded_sub_in_set"))})


def census(spark: SparkSession, out: str) -> DataFrame:
    """Keys seen so far by sub-code."""
    return spark.read.parquet(f"{out}/census").groupBy("sub").agg(F.sum("n").alias("n"))
