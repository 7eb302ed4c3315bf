"""Comparison of wide tables: schemas and values by column."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import codec
from ..plans.verdict import Verdict


def schema_table(df: DataFrame) -> DataFrame:
    rows = [(f.name, f.dataType.simpleString()) for f in df.schema]
    return df.sparkSession.createDataFrame(rows, "name string, type string")


def schema_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """name, left_type, right_type, status: only_left, only_right, type_mismatch, common."""
    a, b = schema_table(left).withColumnRenamed("type", "left_type"), schema_table(right).withColumnRenamed("type", "right_type")
    status = F.when(F.col("right_type").isNull(), "only_left").when(F.col("left_type").isNull(), "only_right").when(F.col("left_type") != F.col("right_type"), "type_mismatch").otherwise("common")
    return a.join(b, "name", "full_outer").withColumn("status", status)


#: What a pair of values is: equal, different, both NaN.
SAME, DIFFERENT, BOTH_NAN = 0, 1, 2


def _floating(kind: T.DataType) -> bool:
    return isinstance(kind, T.FloatType | T.DoubleType)


def _state(kind: T.DataType, a: Column, b: Column) -> Column:
    """SAME, DIFFERENT or BOTH_NAN for two values of one type."""
    both_null = a.isNull() & b.isNull()
    if _floating(kind):
        return F.when(F.isnan(a) & F.isnan(b), F.lit(BOTH_NAN)).when(F.coalesce(codec.agrees(a, b), both_null), F.lit(SAME)).otherwise(F.lit(DIFFERENT))
    if isinstance(kind, T.ArrayType) and _floating(kind.elementType):
        inner = F.zip_with(a, b, lambda x, y: ~F.coalesce(codec.agrees(x, y), x.isNull() & y.isNull()))
        bad = (F.size(a) != F.size(b)) | F.exists(inner, lambda x: x)
        return F.when(F.coalesce(bad, ~both_null), F.lit(DIFFERENT)).otherwise(F.lit(SAME))
    return F.when(a.eqNullSafe(b), F.lit(SAME)).otherwise(F.lit(DIFFERENT))


def _states(kind: T.DataType, a: str, b: str) -> Column:
    return F.zip_with(a, b, lambda x, y: _state(kind, x, y))


#: Types whose values are compared as Arrow arrays; those of others are compared by Spark, column by column.
_PLAIN = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.StringType, T.BooleanType, T.BinaryType, T.DateType)


def _by_arrow(kind: T.DataType) -> bool:
    if isinstance(kind, T.StringType):
        return kind == T.StringType()  # others have a collation
    return isinstance(kind, _PLAIN) or isinstance(kind, T.ArrayType) and _floating(kind.elementType)


def _float_states(a: pa.Array, b: pa.Array) -> np.ndarray:
    """_state of arrays of floating values."""
    gone_a, gone_b = (x.is_null().to_numpy(zero_copy_only=False) for x in (a, b))
    x, y = (v.cast(pa.float64()).fill_null(0.0).to_numpy(zero_copy_only=False) for v in (a, b))
    with np.errstate(invalid="ignore", over="ignore"):
        near = (x == y) | (np.abs(x - y) < codec.TOLERANCE * np.maximum(1.0, np.abs(x)))
    same = np.where(gone_a | gone_b, gone_a & gone_b, near)
    out = np.where(same, SAME, DIFFERENT)
    out[np.isnan(x) & np.isnan(y) & ~gone_a & ~gone_b] = BOTH_NAN
    return out


def _list_states(a: pa.Array, b: pa.Array) -> np.ndarray:
    """_state of arrays of lists of floating values: the lists of equal length are compared together, value by value."""
    n, m = (pc.list_value_length(x) for x in (a, b))
    gone_a, gone_b = (x.is_null().to_numpy(zero_copy_only=False) for x in (n, m))
    n, m = (x.fill_null(-1).to_numpy(zero_copy_only=False) for x in (n, m))
    at = np.flatnonzero(~gone_a & ~gone_b & (n == m))
    whole = len(at) == len(a)
    values = [pc.list_flatten(x if whole else x.take(pa.array(at))) for x in (a, b)]
    bad = np.bincount(np.repeat(at, n[at]), _float_states(*values) == DIFFERENT, len(a)) > 0
    out = np.full(len(a), DIFFERENT)
    out[at] = np.where(bad[at], DIFFERENT, SAME)
    out[gone_a & gone_b] = SAME
    return out


def _equal_states(a: pa.Array, b: pa.Array) -> np.ndarray:
    gone_a, gone_b = (x.is_null().to_numpy(zero_copy_only=False) for x in (a, b))
    same = pc.equal(a, b).fill_null(False).to_numpy(zero_copy_only=False)
    return np.where(same | gone_a & gone_b, SAME, DIFFERENT)


def _counted(both: DataFrame, packs: list[tuple[T.DataType, list[int]]]) -> DataFrame:
    """k, n, mismatches, nan_agree of each task: a row for each column that has any, and one (k is -1) with the number of rows.

    both has arrays _a0, _b0 and so on, one pair for each pack, or their states _s0 where Arrow doesn't compare them.  Those of
    a type are compared together, batch by batch.
    """
    columns = 1 + max(k for _, at in packs for k in at)
    groups: dict[str, list[int]] = {}
    for n, (kind, _) in enumerate(packs):
        groups.setdefault(kind.json(), []).append(n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, found = 0, np.zeros((3, columns), np.int64)
        for batch in batches:
            rows += batch.num_rows
            place = {name: n for n, name in enumerate(batch.schema.names)}
            flat = lambda side, group: pa.concat_arrays([pc.list_flatten(batch.column(place[f"_{side}{n}"])) for n in group])
            for group in groups.values():
                kind = packs[group[0]][0]
                if _by_arrow(kind):
                    compare = _float_states if _floating(kind) else _list_states if isinstance(kind, T.ArrayType) else _equal_states
                    states = compare(flat("a", group), flat("b", group))
                else:
                    states = flat("s", group).to_numpy(zero_copy_only=False)
                for at, part in zip((packs[n][1] for n in group), np.split(states, np.cumsum([batch.num_rows * len(packs[n][1]) for n in group])[:-1])):
                    for state in (DIFFERENT, BOTH_NAN):
                        found[state, at] += (part.reshape(batch.num_rows, len(at)) == state).sum(0)
        some = np.flatnonzero(found.any(0))
        lists = ([-1, *some], [rows, *([0] * len(some))], [0, *found[DIFFERENT, some]], [0, *found[BOTH_NAN, some]])
        yield pa.RecordBatch.from_arrays([pa.array(np.array(x, np.int64)) for x in lists], ["k", "n", "mismatches", "nan_agree"])

    return both.mapInArrow(run, "k bigint, n bigint, mismatches bigint, nan_agree bigint")


#: Least number of arrays that as many columns or more are dealt to.
ARRAYS = 128


def value_mismatches(left: DataFrame, right: DataFrame, key: list[str], columns: list[str] | None = None) -> DataFrame:
    """name, compared, mismatches, nan_agree for every common column, in one join.

    The columns of one type are few arrays, compared position by position, so the plan grows little with the columns.  A task
    compares the joined arrays batch by batch and gives counts only; columns whose types differ are compared as texts.
    """
    spark, kinds, others = left.sparkSession, {f.name: f.dataType for f in left.schema}, {f.name: f.dataType for f in right.schema}
    names = [c for c in columns or left.columns if c in others and c not in key]
    if not names:
        return spark.createDataFrame([], "name string, compared bigint, mismatches bigint, nan_agree bigint")
    by_kind: dict[str, list[int]] = {}
    for k, c in enumerate(names):
        by_kind.setdefault(kinds[c].json() if kinds[c] == others[c] else "", []).append(k)
    # with more than a hundred arrays Spark makes no one method of a whole table, which would take its compiler long and much
    # memory before it is refused as too long
    size = max(1, len(names) // ARRAYS)
    packs = [(kind, at[n : n + size]) for kind, at in by_kind.items() for n in range(0, len(at), size)]
    quoted = lambda c: "`" + c.replace("`", "``") + "`"

    def packed(df: DataFrame, side: str) -> DataFrame:
        # as texts: thousands of Column objects take longer to make than a table to compare
        value = lambda k, kind: quoted(names[k]) if kind else f"CAST({quoted(names[k])} AS string)"
        return df.selectExpr(*map(quoted, key), *(f"array({', '.join(value(k, kind) for k in at)}) AS {side}{n}" for n, (kind, at) in enumerate(packs)))

    # Spark takes arrays for short, however long, and would broadcast wide tables
    both = packed(left, "_a").join(packed(right, "_b").hint("merge"), key)
    typed = [(kinds[names[at[0]]] if kind else T.StringType(), at) for kind, at in packs]
    sides = []
    for n, (kind, _) in enumerate(typed):
        sides += [f"_a{n}", f"_b{n}"] if _by_arrow(kind) else [_states(kind, f"_a{n}", f"_b{n}").alias(f"_s{n}")]
    both = both.select(*sides)
    counts = _counted(both, typed).groupBy("k").agg(*(F.sum(c).alias(c) for c in ("n", "mismatches", "nan_agree")))
    # one row from here on, with an entry for each column that has any, and one for the rows
    one = counts.agg(F.collect_list(F.struct("k", F.struct("n", "mismatches", "nan_agree"))).alias("c")).select(F.map_from_entries("c").alias("c"))
    entry = lambda k, name: F.coalesce(F.try_element_at("c", k.cast("bigint"))[name], F.lit(0))
    listed = one.select("c", F.posexplode(F.from_json(F.lit(json.dumps(names)), "array<string>")).alias("k", "name"))
    return listed.select("name", entry(F.lit(-1), "n").alias("compared"), entry(F.col("k"), "mismatches").alias("mismatches"), entry(F.col("k"), "nan_agree").alias("nan_agree"))


def worst(mismatches: DataFrame, most: int = 20) -> DataFrame:
    return mismatches.where("mismatches > 0").orderBy(F.desc("mismatches"), "name").limit(most)


def judge(mismatches: DataFrame, diff: DataFrame, only_left: set[str] = frozenset(), only_right: set[str] = frozenset(), least_common: int = 0, zero: bool = True, allow: str = "") -> Verdict:
    """0, or 1 where schemas are not as expected, or 4 where values differ in columns that allow does not match."""
    found = {r["name"]: r["status"] for r in diff.collect()}
    bad = mismatches.where((F.col("mismatches") > 0) & (~F.col("name").rlike(allow) if allow else F.lit(True)))
    n = bad.count()
    counters = {"mismatched_columns": n, "common": sum(s == "common" for s in found.values())}
    if {k for k, s in found.items() if s == "only_left"} != set(only_left) or {k for k, s in found.items() if s == "only_right"} != set(only_right) or counters["common"] < least_common:
        return Verdict(1, "schema", counters)
    return Verdict(4, "values", counters) if zero and n else Verdict(0, None, counters)
