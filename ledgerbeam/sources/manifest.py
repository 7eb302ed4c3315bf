"""Lists of input files, their identity, and checked scans."""

from __future__ import annotations

import os
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.verdict import Refused
from . import probe
from .probe import Opened


def read_manifest(spark: SparkSession, path: str) -> list[str]:
    """Paths of a text file, one a line, trimmed; blank lines and lines from # are skipped.  Refused (3) if unreadable or empty.

    A manifest is a list of files, which the driver needs to plan the scan.
    """
    try:
        lines = [r["value"] for r in spark.read.text(path).select(F.trim("value").alias("value")).where("value <> '' and not startswith(value, '#')").collect()]
    except Exception as e:
        raise Refused(3, f"can't read {path}: {type(e).__name__}") from e
    if not lines:
        raise Refused(3, f"{path} lists no files")
    return lines


def normalise(path: str) -> str:
    """One name for one file: without server address, options, doubled slashes, dots; links followed where the file is local."""
    path = path.partition("?")[0]
    path = re.sub(r"^file:(?://)?(?=/)", "", path)
    if m := re.match(r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/]*(/.*)$", path):
        return os.path.normpath(re.sub("/+", "/", m[1]))
    return os.path.realpath(re.sub("/+", "/", path))


def repeated_files(manifests: dict[str, list[str]]) -> list[str]:
    """Files that occur twice or more over all manifests."""
    seen: dict[str, int] = {}
    for paths in manifests.values():
        for p in paths:
            seen[normalise(p)] = seen.get(normalise(p), 0) + 1
    return sorted(p for p, n in seen.items() if n > 1)


def normal(path: Column) -> Column:
    """normalise for columns; links are not followed."""
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(path, r"\?.*$", ""), r"^file:(//)?(?=/)", ""), r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/]*(?=/)", "")
    none = F.array().cast("array<string>")
    walked = F.aggregate(F.split(bare, "/"), none, lambda a, p: F.when((p == "") | (p == "."), a).when(p == "..", F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0)))).otherwise(F.concat(a, F.array(p))))
    return F.concat(F.lit("/"), F.array_join(walked, "/"))


def repeated(listed: DataFrame) -> DataFrame:
    """Files that a table of lists (path) has twice or more under any of their names, and how often."""
    return listed.groupBy(normal(F.col("path")).alias("file")).agg(F.count("*").alias("times")).where("times > 1")


def check_unique(manifests: dict[str, list[str]]) -> None:
    if twice := repeated_files(manifests):
        raise Refused(2, f"given more than once: {', '.join(twice[:10])}" + (f" … and {len(twice) - 10} more" if len(twice) > 10 else ""))


def scan(spark: SparkSession, files: list[str], schema=None, max_files: int | None = None, allow_missing: bool = False) -> DataFrame:
    """The files as one table with file and pos (its row number in stored order).  Missing or corrupt files fail the scan (4)."""
    files = files[:max_files] if max_files is not None else files
    reader = spark.read.option("ignoreCorruptFiles", "false").option("ignoreMissingFiles", str(allow_missing).lower())
    try:
        df = (reader.schema(schema) if schema else reader).parquet(*files)
    except Exception as e:
        raise Refused(4, f"can't open: {str(e).splitlines()[0][:200]}") from e
    return df.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("pos")) if "file" not in df.columns else df


def columns_by_file(spark: SparkSession, files: list[str]) -> dict[str, list[str]]:
    """Each file's own columns, for checks that merged schemas would hide; tasks open the files."""
    states = probe.probe_once(probe.table_of(spark, files)).collect()
    if bad := [r["file"] for r in states if r["columns"] is None]:
        raise Refused(5, f"can't read {', '.join(bad[:10])}")
    return {r["file"]: r["columns"] for r in states}


def require_columns(found: dict[str, list[str]], wanted: list[str]) -> None:
    for f, columns in found.items():
        if lost := [c for c in wanted if c not in columns]:
            raise Refused(5, f"{f} lacks {', '.join(lost)}")


def row_counts(spark: SparkSession, files: list[str]) -> DataFrame:
    """Rows of each file; the scan reads no column."""
    return spark.read.parquet(*files).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("rows"))


def open_check(spark: SparkSession, files: list[str], attempts: int = 3, wait: float = 10.0, longest: float = 300.0, budget: float = 1800.0, allow_missing: bool = False) -> Opened:
    """Rows of each file.  One job counts them all; where that fails, tasks open each file, and the lost ones alone are tried
    again, attempts times with doubled waits up to longest and budget seconds in all.  The rest is refused (4), naming ten, or
    left out with allow_missing, which makes the result indicative.
    """
    try:
        counts = row_counts(spark, files)
        return Opened(counts, counts.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n")).first()["n"], [])
    except Exception:
        states = probe.probe(probe.table_of(spark, files), (), attempts, wait, longest, budget)
        return probe.opened(states, files, allow_missing)


def file_statuses(spark: SparkSession, files: list[str], wanted: list[str]) -> DataFrame:
    """file and status: ok, empty, bad_open (not there), no_table (no Parquet), bad_columns (wanted ones are lacking), read_errors."""
    return probe.statuses(probe.probe_once(probe.table_of(spark, files), wanted), wanted)


def looped(df: DataFrame) -> int:
    """The number of rows that a scan gives; one that fails in spite of Spark's retries is refused (10)."""
    try:
        return df.count()
    except Exception as e:
        raise Refused(10, f"read error: {str(e).splitlines()[0][:200]}") from e


def check_complete(looped: int, counted: int) -> None:
    if looped != counted:
        raise Refused(4, f"{looped} rows read, {counted} counted before")


def checked_event(df: DataFrame, column: str = "event") -> DataFrame:
    """Unsigned 64-bit events, which Parquet readers give as decimal(20,0), as bigint; values from 2**63 on fail the job."""
    wide = F.col(column).cast("decimal(20,0)")
    return df.withColumn(column, F.when(wide <= F.lit(2**63 - 1), wide.cast("bigint")).otherwise(F.raise_error(F.concat(F.lit("event out of range: "), wide.cast("string")))))


def walk(spark: SparkSession, top: str, prefixes: tuple[str, ...]) -> DataFrame:
    """path and length of files below top whose names start with one of prefixes."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(top).select("path", "length")
    name = F.element_at(F.split("path", "/"), -1)
    keep = F.lit(False)
    for p in prefixes:
        keep = keep | name.startswith(p)
    return files.where(keep)


def read_rows(spark: SparkSession, path: str, fingerprint: bool = False) -> DataFrame:
    """Space-separated fixture rows of 7 columns, 11 with a fingerprint."""
    schema = "run bigint, luminosityBlock bigint, event bigint, genTtbarId int, Expanded_genTtbarId int, nAddBJets int, nAddBJetsMulti int"
    schema += ", Generator_x1 float, Generator_x2 float, Generator_id1 int, Generator_id2 int" if fingerprint else ""
    return spark.read.csv(path, sep=" ", schema=schema, mode="FAILFAST")


def read_chunks(spark: SparkSession, paths, lines: bool = False) -> DataFrame:
    """Chunk counters, one JSON document a file, or a line; unreadable ones keep their text in corrupt."""
    fields = "label string, sample string, chunk int, exit_code int, job_failed boolean, expanded_sub_counts map<string,bigint>, orig_sub_of_reclassified map<string,bigint>, disagree_by_nano_sub map<string,bigint>, corrupt string"
    for c in ("nano_entries", "nano_entries_postloop", "nano_entries_opencheck", "matched", "unmatched", "agree", "disagree", "nAddBJets_ge3", "expanded_sub_in_set", "viol_ext_but_lt3", "viol_ge3_not_ext", "viol_prefix_changed", "viol_le2_changed"):
        fields += f", {c} bigint"
    return spark.read.schema(fields).option("multiLine", str(not lines).lower()).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "corrupt").json(paths)


def catalogue(spark: SparkSession, text: str) -> DataFrame:
    """The catalogue (era -> datasets) from YAML, or JSON where no YAML reader is installed, a row per entry."""
    try:
        import yaml

        tree = yaml.safe_load(text)
    except ImportError:
        import json

        tree = json.loads(text)
    names = ("name", "dataset", "nano_child", "enabled", "verified", "notes", "units_per_job", "nano_role", "miniaod_version", "lumi_mask", "lumi_mask_md5")
    rows = [(era, *(e.get(n) for n in names)) for era, block in tree.items() for e in block.get("datasets", ())]
    return spark.createDataFrame(rows, "era string, name string, dataset string, nano_child string, enabled boolean, verified boolean, notes string, units_per_job int, nano_role string, miniaod_version string, lumi_mask string, lumi_mask_md5 string")
