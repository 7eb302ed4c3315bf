"""Files opened in tasks: their state, and reading that takes up only what was lost.

``probe`` deals the files to tasks, each of which opens a file's footer (or
those of the files in a folder) and reports what it finds, so a round over any number of files is one Spark job and
a broken file costs its own row only.  Further rounds take the files alone
that could not be opened.  ``read`` deals row groups: a range that fails is
reported in a ledger beside the rows that came, and later rounds read the lost
ranges alone.

Tasks open files through Arrow's file systems, by the path's scheme; a path
without a scheme is local to the tasks, so on a cluster it has to be shared.
Files of a scheme that only Spark knows are opened by Spark's reader instead, a
few jobs at a time; ``read`` doesn't take these, as Spark's scans do.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from multiprocessing.pool import ThreadPool
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.store import scratch, stored
from ..plans.verdict import Refused


class Opened(NamedTuple):
    """What opening all files beforehand gave."""

    counts: DataFrame  # file, rows
    total: int
    bad: list[str]

    @property
    def indicative(self) -> bool:
        """Files are missing, so nothing that is counted stands for the whole sample."""
        return bool(self.bad)


#: States of a file.  Only bad_open is tried again: what a file holds does not change by waiting.
UNKNOWN = "unknown"  # a scheme that Arrow doesn't know; never given out
OK, EMPTY, BAD_OPEN, NO_TABLE, BAD_COLUMNS, READ_ERRORS = "ok", "empty", "bad_open", "no_table", "bad_columns", "read_errors"
STATE = "file string, status string, rows bigint, columns array<string>, members array<struct<path: string, size: bigint, groups: array<bigint>>>, error string"


def _at(path: str):
    """The file system of a path, and its name there."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _open(path: str):
    """A random-access file and its size."""
    system, name = _at(path)
    return system.open_input_file(name), system.get_file_info(name).size


def _members(path: str) -> list[str]:
    """The path itself, or the data files in the folder that it names."""
    from pyarrow import fs

    system, name = _at(path)
    info = system.get_file_info(name)
    if info.type == fs.FileType.File:
        return [path]
    if info.type != fs.FileType.Directory:
        raise FileNotFoundError(path)
    inside = system.get_file_info(fs.FileSelector(name, recursive=True))
    head = path.rstrip("/")
    names = [head + i.path.rstrip("/").removeprefix(name.rstrip("/")) for i in inside if i.type == fs.FileType.File and not i.base_name.startswith(("_", "."))]
    if not names:
        raise FileNotFoundError(f"no files in {path}")
    return sorted(names)


def _state(path: str, wanted: list[str]) -> tuple:
    import pyarrow.parquet as pq

    members, columns = [], None
    try:
        _at(path)
    except Exception as e:  # no such scheme, or its library isn't there
        return path, UNKNOWN, None, None, None, str(e)[:200]
    try:
        for name in _members(path):
            source, size = _open(name)
            with source:
                try:
                    f = pq.ParquetFile(source)
                except Exception as e:
                    return path, NO_TABLE, None, None, None, f"{name}: {type(e).__name__}: {e}"[:200]
                columns = columns or f.schema_arrow.names
                if lost := [c for c in wanted if c not in f.schema_arrow.names]:
                    return path, BAD_COLUMNS, f.metadata.num_rows, f.schema_arrow.names, None, f"{name} lacks {', '.join(lost)}"
                members.append({"path": name, "size": size, "groups": [f.metadata.row_group(k).num_rows for k in range(f.metadata.num_row_groups)]})
    except Exception as e:
        return path, BAD_OPEN, None, None, None, f"{type(e).__name__}: {e}"[:200]
    rows = sum(sum(m["groups"]) for m in members)
    return path, OK if rows else EMPTY, rows, columns, members, None


def _dealt(rows: DataFrame, per_task: int) -> DataFrame:
    """rows in tasks of about per_task rows."""
    n = rows.count()
    return rows.repartition(max(1, -(-n // per_task)))


def _by_spark(spark: SparkSession, path: str, wanted: list[str]) -> tuple:
    """_state by Spark's own reader; the wanted columns are read too."""
    try:
        df = spark.read.parquet(path)
    except Exception as e:
        return path, BAD_OPEN if "PATH_NOT_FOUND" in str(e) else NO_TABLE, None, None, None, str(e)[:200]
    if lost := [c for c in wanted if c not in df.columns]:
        return path, BAD_COLUMNS, None, df.columns, None, f"lacks {', '.join(lost)}"
    try:
        rows = df.agg(F.count("*").alias("n"), *(F.max(c).cast("string").alias(f"_{k}") for k, c in enumerate(wanted))).first()["n"]
        return path, OK if rows else EMPTY, rows, df.columns, None, None
    except Exception as e:
        return path, READ_ERRORS, None, df.columns, None, str(e)[:200]


def probe_once(files: DataFrame, wanted: list[str] = (), per_task: int = 50) -> DataFrame:
    """STATE of each of files (file)."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(zip(*(_state(p, list(wanted)) for p in batch.column("file").to_pylist()))) or [()] * 6
            inner = pa.list_(pa.struct([("path", pa.string()), ("size", pa.int64()), ("groups", pa.list_(pa.int64()))]))
            kinds = (pa.string(), pa.string(), pa.int64(), pa.list_(pa.string()), inner, pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(found, kinds)], ["file", "status", "rows", "columns", "members", "error"])

    states = stored(_dealt(files.select("file"), per_task).mapInArrow(of, STATE))
    others = [r["file"] for r in states.where(F.col("status") == UNKNOWN).select("file").collect()]
    if not others:
        return states
    spark = files.sparkSession
    with ThreadPool(8) as pool:
        rows = pool.map(lambda path: _by_spark(spark, path, list(wanted)), others)
    return states.where(F.col("status") != UNKNOWN).unionByName(spark.createDataFrame(rows, STATE))


def probe(files: DataFrame, wanted: list[str] = (), attempts: int = 3, wait: float = 10.0, longest: float = 300.0, budget: float = 1800.0, per_task: int = 50) -> DataFrame:
    """STATE of each of files (file), and round, the attempt that it is from.

    One job a round; from the second on only the files that didn't open, after doubled waits up to longest and budget seconds
    in all.  A path that is given twice has two rows.
    """
    began, found = time.monotonic(), None
    for k in range(max(1, attempts)):
        now = probe_once(files, wanted, per_task).withColumn("round", F.lit(k))
        found = now if found is None else found.where(F.col("status") != BAD_OPEN).unionByName(now)
        files = now.where(F.col("status") == BAD_OPEN)
        pause = min(wait * 2**k, longest)
        if k + 1 >= attempts or time.monotonic() - began + pause > budget or not files.take(1):
            break
        time.sleep(pause)
    return found


def table_of(spark: SparkSession, files: list[str]) -> DataFrame:
    return spark.createDataFrame([(f,) for f in files], "file string")


def opened(states: DataFrame, files: list[str], allow_missing: bool = False) -> Opened:
    """What manifest.open_check gives, from a probe of files: rows by file; files that don't open or are no tables are refused
    (4), naming the first ten, or left out with allow_missing."""
    lost = F.col("status").isin(BAD_OPEN, NO_TABLE)
    names = {r["file"] for r in states.where(lost).select("file").collect()}
    bad = [f for f in files if f in names]
    if bad and (not allow_missing or len(bad) == len(files)):
        raise Refused(4, f"can't open {', '.join(bad[:10])}" + (f" … and {len(bad) - 10} more" if len(bad) > 10 else ""))
    counts = states.where(~lost).select("file", "rows")
    return Opened(counts, counts.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n")).first()["n"], bad)


def bad_files(states: DataFrame, most: int = 10) -> DataFrame:
    """The first files, by name, that can't be used, with what is wrong; and how many there are in all."""
    bad = states.where(~F.col("status").isin(OK, EMPTY))
    n = bad.count()
    return bad.orderBy("file", "status").limit(most).select("file", "status", "error", F.lit(n).alias("bad_files"))


def _ranges(states: DataFrame) -> DataFrame:
    """file, path, size, group, expected: a row for each row group of the files that are tables with rows."""
    good = states.where((F.col("status") == OK) & F.col("members").isNotNull()).dropDuplicates(["file"]).select("file", F.explode("members").alias("m"))
    return good.select("file", "m.path", "m.size", F.posexplode("m.groups").alias("group", "expected"))


LEDGER = "file string, path string, `group` int, read bigint, error string"


def _read_range(r: dict, columns: list[str], reader: Callable | None):
    """The rows of one range, or None and what is wrong.  A range counts as a whole or not at all."""
    import pyarrow.parquet as pq

    try:
        source, size = (reader or _open)(r["path"])
        with source, pq.ParquetFile(source) as f:
            if size != r["size"]:
                raise OSError(f"size is {size}, was {r['size']}")
            got = f.read_row_group(r["group"], columns=columns)
            if got.num_rows != r["expected"]:
                raise OSError(f"{got.num_rows} rows of {r['expected']}")
            return got, None
    except Exception as e:
        return None, f"{type(e).__name__}: {e}"[:200]


def check_once(ranges: DataFrame, columns: list[str], per_task: int = 8, reader: Callable | None = None) -> DataFrame:
    """The ledger of ranges that are read and not given on: read is null where one failed."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                got, error = _read_range(r, columns, reader)
                out.append((r["file"], r["path"], r["group"], None if got is None else got.num_rows, error))
            columns_ = zip(list(zip(*out)) or [()] * 5, (pa.string(), pa.string(), pa.int32(), pa.int64(), pa.string()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns_], ["file", "path", "group", "read", "error"])

    return _dealt(ranges, per_task).mapInArrow(of, LEDGER)


def read_once(ranges: DataFrame, schema: T.StructType, folder: str, per_task: int = 8, reader: Callable | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows of the ranges that could be read, written to folder, and the ledger of all.

    reader: what opens a file in place of Arrow's file systems.
    """
    kinds, columns = to_arrow_schema(schema), schema.names
    names = ["_file", "_path", "_group", "_read", "_error", *columns]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                got, error = _read_range(r, columns, reader)
                n = None if got is None else got.num_rows
                head = [pa.array([r["file"]], pa.string()), pa.array([r["path"]], pa.string()), pa.array([r["group"]], pa.int32()), pa.array([n], pa.int64()), pa.array([error], pa.string())]
                yield pa.RecordBatch.from_arrays([*head, *(pa.nulls(1, k.type) for k in kinds)], names)
                if n:
                    whole = pa.table([got.column(c).cast(kinds.field(c).type) for c in columns], names=columns)
                    for part in whole.to_batches(max_chunksize=10_000):
                        m = part.num_rows
                        marks = [pa.repeat(pa.scalar(r["file"]), m), pa.repeat(pa.scalar(r["path"]), m), pa.repeat(pa.scalar(r["group"], pa.int32()), m), pa.repeat(pa.scalar(-1, pa.int64()), m), pa.nulls(m, pa.string())]
                        yield pa.RecordBatch.from_arrays([*marks, *part.columns], names)

    marked = T._parse_datatype_string("_file string, _path string, _group int, _read bigint, _error string")
    both = _dealt(ranges, per_task).mapInArrow(of, T.StructType([*marked.fields, *schema.fields]))
    # written before it is counted: rows and ledger come from the same reading
    both.write.parquet(folder)
    both = ranges.sparkSession.read.parquet(folder)
    rows = both.where("_read = -1").select(*columns, F.col("_path").alias("path"), F.col("_group").alias("group"))
    ledger = both.where("_read is null or _read >= 0").select(F.col("_file").alias("file"), F.col("_path").alias("path"), F.col("_group").alias("group"), F.col("_read").alias("read"), F.col("_error").alias("error"))
    return rows, ledger


def read(states: DataFrame, schema: T.StructType, rounds: int = 3, wait: float = 1.0, per_task: int = 8, reader: Callable | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows of all files that probe calls ok, with path and group, and the ledger with round.

    What was lost is read again, range by range, up to rounds times in all; then the job is refused (10), naming ten files.
    """
    spark = states.sparkSession
    if states.where((F.col("status") == OK) & F.col("members").isNull()).take(1):
        raise ValueError("files of a scheme that only Spark's reader takes have no ranges")
    todo, parts, ledgers = _ranges(states), [], []
    for k in range(rounds):
        rows, ledger = read_once(todo, schema, scratch(spark, f"read-{k}"), per_task, reader)
        parts.append(rows)
        ledgers.append(ledger.withColumn("round", F.lit(k)))
        todo = todo.join(ledger.where("read is null").select("path", "group"), ["path", "group"])
        lost = [r["file"] for r in todo.select("file").distinct().orderBy("file").limit(11).collect()]
        if not lost:
            break
        time.sleep(wait * 2**k if k + 1 < rounds else 0)
    else:
        raise Refused(10, f"read errors in {', '.join(lost[:10])}" + (" and more" if len(lost) > 10 else ""))
    whole, log = parts[0], ledgers[0]
    for more, also in zip(parts[1:], ledgers[1:]):
        whole, log = whole.unionByName(more), log.unionByName(also)
    return whole, log


def statuses(states: DataFrame, columns: list[str] = (), per_task: int = 8, reader: Callable | None = None) -> DataFrame:
    """file and status as audit.files_verdict takes them; columns that are named are read too, in tasks."""
    if not columns:
        return states.select("file", "status")
    ledger = check_once(_ranges(states), list(columns), per_task, reader)
    broken = ledger.where("read is null").select("file").distinct().withColumn("_broken", F.lit(True))
    return states.select("file", "status").join(broken, "file", "left").select("file", F.when(F.col("_broken"), READ_ERRORS).otherwise(F.col("status")).alias("status"))
