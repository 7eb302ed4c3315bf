"""Outputs: staged tables, shards, metadata, counters, plain text forms."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.order import row_index
from ..plans.verdict import Refused
from .parts import write_parts as write_shards  # noqa: F401


def _store(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm.org.apache.hadoop.fs.Path


def write_staged(tables: dict[str, DataFrame], out: str, replace: bool = False, check=None) -> None:
    """Write several tables below out, all or none: to a folder beside it, renamed when everything is there.

    An existing out is refused (4) unless replace; a failure leaves it untouched and removes the staging folder.
    """
    spark = next(iter(tables.values())).sparkSession
    fs, path, make = _store(spark, out)
    if fs.exists(path) and not replace:
        raise Refused(4, f"{out} exists")
    if path.getParent() is not None and not fs.exists(path.getParent()):
        raise Refused(4, f"no folder {path.getParent()}")
    staging = make(f"{out}.tmp.{uuid.uuid4().hex}")
    try:
        for name, df in tables.items():
            df.write.mode("errorifexists").parquet(f"{staging.toString()}/{name}")
        if check:
            check(spark, staging.toString())
        if fs.exists(path):
            old = make(f"{out}.old.{uuid.uuid4().hex}")
            fs.rename(path, old)
            fs.rename(staging, path)
            fs.delete(old, True)
        else:
            fs.rename(staging, path)
    except BaseException:
        fs.delete(staging, True)
        raise


def write_sidecar(df: DataFrame, out: str) -> None:
    """The sidecar table, sorted by key within files so that statistics prune lookups."""
    df.sortWithinPartitions("run", "luminosityBlock", "event").write.mode("errorifexists").parquet(out)


def lookup_metadata(spark: SparkSession, fmt: int, datasets: list[str], sources: DataFrame) -> dict[str, DataFrame]:
    """Tables to be written beside a lookup table; datasets without a row are listed too."""
    names = [(k, n) for k, n in enumerate(sorted(set(datasets)))]
    return {
        "lookup_format": spark.createDataFrame([(f"tthh-ttnb/{fmt}",)], "lookup_format string"), "nano_datasets": spark.createDataFrame(names, "datasetIdx int, dataset string"), "sources": sources,
    }


def counters_json(counters: DataFrame) -> DataFrame:
    """Counters as JSON texts; written before a verdict is acted on, so failures report too."""
    return counters.select(F.to_json(F.struct("*")).alias("value"))


def order_csv(report: DataFrame, out: str) -> None:
    report.coalesce(1).write.mode("errorifexists").csv(out, header=True)


def task_tsv(rows: DataFrame) -> DataFrame:
    """Rows as tab-separated lines under a # header, in the order they come in; cells with tabs or line ends fail the job.

    A plan or record has a row per task, so one task numbers the lines.
    """
    cells = []
    for c in rows.columns:
        text = F.coalesce(F.col(c).cast("string"), F.lit(""))
        cells.append(F.when(text.rlike("[\t\r\n]"), F.raise_error(F.lit(f"bad cell in {c}"))).otherwise(text))
    head = rows.sparkSession.createDataFrame([(0, "#" + "\t".join(rows.columns))], "k bigint, value string")
    body = rows.coalesce(1).select((F.monotonically_increasing_id() + 1).alias("k"), F.concat_ws("\t", *cells).alias("value"))
    return head.unionByName(body).orderBy("k").select("value")


def write_tsv(rows: DataFrame, out: str) -> None:
    """task_tsv's lines in the one file out, which appears whole or not at all; an existing out is refused (4)."""
    spark = rows.sparkSession
    fs, path, make = _store(spark, out)
    if fs.exists(path):
        raise Refused(4, f"{out} exists")
    staging = make(f"{out}.tmp.{uuid.uuid4().hex}")
    try:
        task_tsv(rows).coalesce(1).write.text(staging.toString())
        part = next(f.getPath() for f in fs.listStatus(staging) if f.getPath().getName().startswith("part-"))
        if not fs.rename(part, path):
            raise Refused(4, f"can't write {out}")
    finally:
        fs.delete(staging, True)


def thousands(n) -> Column:
    """Whole numbers with commas, for reports."""
    return F.format_number(n, 0)


def stamp(seconds) -> Column:
    """Seconds since 1970 as a UTC time for reports, whatever the session's zone."""
    s = (F.col(seconds) if isinstance(seconds, str) else seconds).cast("bigint")
    utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.timestamp_seconds(s).cast("timestamp_ntz"))
    # a pattern writes years of five digits and more with a plus
    return F.ltrim(F.date_format(utc, "yyyy-MM-dd HH:mm:ss 'UTC'"), F.lit("+"))


def _head(df: DataFrame, metadata: dict[str, str] | None) -> list[str]:
    return [f"NAMED {k} {v}" for k, v in sorted((metadata or {}).items())] + [f"LEAF {f.name} {f.dataType.simpleString()}" for f in df.schema]


def dump(df: DataFrame, metadata: dict[str, str] | None = None, most: int = 100_000) -> list[str]:
    """A small table as text: names, columns, rows in order; one with more than most rows is refused (2), dump_lines takes it."""
    rows = df.orderBy(*df.columns).limit(most + 1).collect()
    if len(rows) > most:
        raise Refused(2, f"more than {most} rows")
    return _head(df, metadata) + ["ROW " + " ".join(map(str, r)) for r in rows]


def dump_lines(df: DataFrame, metadata: dict[str, str] | None = None) -> DataFrame:
    """The same of a table of any size: at, the line's number, and line; nothing comes to the driver."""
    head = _head(df, metadata)
    body = row_index(df, *df.columns).select((F.col("row_index") + len(head)).alias("at"), F.concat(F.lit("ROW "), F.concat_ws(" ", *(F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in df.columns))).alias("line"))
    return df.sparkSession.createDataFrame(list(enumerate(head)), "at bigint, line string").unionByName(body)


def maps_json(maps: dict[str, dict[int, int]]) -> str:
    return json.dumps({k: {str(i): n for i, n in sorted(m.items())} for k, m in maps.items()})
