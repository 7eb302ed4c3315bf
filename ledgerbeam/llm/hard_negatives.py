"""Hard negatives by one-dimensional distance keys.

The largest inner product is made a smallest distance: each vector x gets one
more component, sqrt(M^2 - |x|^2), M being the largest length, and an anchor q
gets 0, so that |q' - x'|^2 = |q|^2 + M^2 - 2 q.x.  Every vector belongs to its
nearest pivot; the table is stored sorted by (pivot, distance to it) and cut to
blocks of at most ``BLOCK`` rows.  A vector within r of an anchor has a key
within r of the anchor's own distance to that pivot, so an anchor scans the
blocks whose keys lie in these intervals.  The radius grows round by round, and
only the annulus that is new is scanned; as soon as the worst of the k found is
nearer than the radius, nothing that is left can be better, and the result is
certified.  Results are exact.

Two searches run on the same table: first the ``positives`` best rows with the
anchor's label, then, for each of them, the best rows of other labels whose
score lies in a band below the positive's.  Anchors go in slices of the same
order as the table, so a slice's anchors want much the same blocks; a task holds
one block and at most ``SLICES`` slices of ``SLICE`` anchors, however many rows
are alike.  Pivots come from a sample of at most ``SAMPLE`` rows; they decide
how much is scanned, never what is found.

Nulls: rows without label or vector, or with a component that is null or not
finite, take no part.  Shorter vectors count as filled up with zeros.  Rows with
equal ids are rows of their own; a null id is never an anchor and comes last
among equal scores.  Scores beyond 64 bits are set to the largest number of
their sign.  Too few rows give what there is; an empty table gives an empty
result.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, numbered

SAMPLE, PIVOTS = 2048, 32
BLOCK, SLICE, SLICES = 2048, 256, 8
#: Stretches of distance, in parts of M, by which anchors meet blocks.
CELL = 1 / 16
#: Distances are compared with this much room for rounding, relative to M.
ROOM = 1e-9
FOUND = "uid bigint, target int, other bigint, other_id bigint, score bigint"


class Index(NamedTuple):
    """What all tasks know of the vectors: the pivots with their additional component, M, the number of components, the numbers' type."""

    pivots: np.ndarray
    longest: float
    size: int
    kind: str


def _whole(x: Column) -> Column:
    """The floor, as a double; numbers from 2**53 on have no fraction."""
    return F.when(F.abs(x) < 2.0**53, F.floor(x).cast("double")).otherwise(x)


def usable(vectors: DataFrame, id: str = "vec_id", label: str = "label", vector: str = "embedding") -> DataFrame:
    """id, label and v (whole numbers: the floor of 256 times each component) of the rows that take part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    rows = vectors.where(F.col(label).isNotNull() & F.col(vector).isNotNull() & finite)
    whole = F.transform(vector, lambda x: _whole(F.lit(256.0) * x.cast("double")))
    return rows.select(F.col(id).cast("bigint").alias("id"), F.col(label).cast("bigint").alias("label"), whole.alias("v"))


def _raised(x: np.ndarray, longest: float) -> np.ndarray:
    """Vectors with their additional component."""
    return np.column_stack([x, np.sqrt(np.maximum(longest**2 - (x * x).sum(axis=1), 0))])


def fit(rows: DataFrame) -> Index:
    """Pivots: the first is a sampled row, each next one the row of the sample that is farthest from those before; then two rounds of means."""
    squares = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    most = rows.agg(F.max(squares).alias("squares"), F.max(F.size("v")).alias("size"), F.max(F.array_max(F.transform("v", F.abs))).alias("largest")).first()
    size, longest = most["size"] or 0, float(np.sqrt(most["squares"] or 0.0)) * (1 + ROOM)
    sample = rows.select("v", F.xxhash64("id", "v").alias("_h")).orderBy("_h").limit(SAMPLE).collect()
    x = np.zeros((len(sample), size))
    for i, r in enumerate(sample):
        x[i, : len(r["v"])] = r["v"]
    x = _raised(x, longest)
    picked = [0] if len(x) else []
    nearest = np.full(len(x), np.inf)
    while picked and len(picked) < min(PIVOTS, len(x)):
        nearest = np.minimum(nearest, ((x - x[picked[-1]]) ** 2).sum(axis=1))
        if not nearest.max() > 0:
            break
        picked.append(int(nearest.argmax()))
    pivots = x[picked] if picked else np.zeros((1, size + 1))
    for _ in range(2 if picked else 0):
        own = _distances(x, pivots).argmin(axis=1)
        pivots = np.array([x[own == k].mean(axis=0) if (own == k).any() else pivots[k] for k in range(len(pivots))])
    return Index(pivots, longest, size, "<i4" if (most["largest"] or 0) < 2**31 else "<f8")


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.stack([np.sqrt(((x - p) ** 2).sum(axis=1)) for p in pivots], axis=1)


def _matrix(column: pa.Array, index: Index) -> np.ndarray:
    """Packed vectors as rows of doubles."""
    return np.frombuffer(b"".join(column.to_pylist()), index.kind).reshape(-1, index.size).astype(float)


def keyed(rows: DataFrame, index: Index, anchor: Column) -> DataFrame:
    """The table in order of (pivot, distance): uid, id, label, v (packed), pivot, dist, block, anchor, and squares and the distances to
    all pivots for anchors."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v, n = batch.column("v"), batch.num_rows
            flat = np.asarray(v.flatten())
            x = np.zeros((n, index.size))
            lengths = np.diff(np.asarray(v.offsets))
            x[np.repeat(np.arange(n), lengths), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
            d = _distances(_raised(x, index.longest), index.pivots)
            wanted = batch.column("anchor").to_pylist()
            from_anchor = _distances(np.column_stack([x, np.zeros(n)]), index.pivots).tolist()
            own = d.argmin(axis=1)
            columns = [batch.column("id"), batch.column("label"), batch.column("anchor"), pa.array([r.tobytes() for r in x.astype(index.kind)], pa.binary()), pa.array(own, pa.int32()), pa.array(d[np.arange(n), own]),
                       pa.array((x * x).sum(axis=1)), pa.array([t if w else None for t, w in zip(from_anchor, wanted)], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "label", "anchor", "v", "pivot", "dist", "squares", "away"])

    schema = "id bigint, label bigint, anchor boolean, v binary, pivot int, dist double, squares double, away array<double>"
    with_keys = rows.withColumn("anchor", F.coalesce(anchor, F.lit(False))).mapInArrow(of, schema)
    ordered = numbered(with_keys.withColumn("g", F.lpad(F.col("pivot").cast("string"), 4, "0")), ["dist", "id"])
    placed = ordered.withColumns({"uid": F.shiftleft(F.col("pivot").cast("bigint"), 48) + F.col("idx"), "block": F.call_function("div", F.col("idx"), F.lit(BLOCK).cast("bigint"))})
    return cut(placed.drop("g", "idx", "n").sortWithinPartitions("pivot", "dist"))


def _products(a: np.ndarray, b: np.ndarray, index: Index) -> np.ndarray:
    """Exact inner products, as 64-bit numbers."""
    if np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(index.size, 1) < 2**53:
        return (a @ b.T).astype(np.int64)
    whole = [[int(x) for x in r] for r in a], [[int(x) for x in r] for r in b]
    most = 2**63 - 1
    return np.array([[max(-most, min(most, sum(x * y for x, y in zip(r, c)))) for c in whole[1]] for r in whole[0]], np.int64).reshape(len(a), len(b))


def _scan(index: Index, k: int, same: bool):
    """Of a block and the anchors that want it: the best k rows of each of their targets."""

    def of(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if rows.num_rows and anchors.num_rows:
            pivot, dist = rows.column("pivot")[0].as_py(), np.asarray(rows.column("dist"))
            lo, hi = dist.min(), dist.max()
            uid, ids, label, x = np.asarray(rows.column("uid")), rows.column("id").to_pylist(), np.asarray(rows.column("label")), _matrix(rows.column("v"), index)
            # equal scores go by id, null last, then by place
            order = np.lexsort([uid, [i if i is not None else 0 for i in ids], [i is None for i in ids]])
            uid, label, x, ids = uid[order], label[order], x[order], [ids[i] for i in order]
            for part in anchors.to_batches(max_chunksize=SLICE):
                scores = _products(_matrix(part.column("v"), index), x, index)
                for a, (own, of_label, away, targets, row) in enumerate(zip(*(part.column(c).to_pylist() for c in ("uid", "label", "away", "targets")), scores)):
                    fits = (label == of_label if same else label != of_label) & (uid != own)
                    d = away[pivot]
                    least = max(d - hi, lo - d, 0)
                    for t in targets:
                        if least > t["reach"] or t["done"] is not None and least <= t["done"] or d + hi < t["nearest"]:
                            continue
                        good = np.flatnonzero(fits & (row >= t["low"]) & (row <= t["high"]))
                        best = good[np.argsort(-row[good], kind="stable")[:k]]
                        out += [(own, t["target"], int(uid[i]), ids[i], int(row[i])) for i in best]
        columns = list(zip(*out)) or [()] * 5
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))], ["uid", "target", "other", "other_id", "score"])

    return of


def _best(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("uid", "target").orderBy(F.desc("score"), F.asc_nulls_last("other_id"), "other")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def search(table: DataFrame, index: Index, wanted: DataFrame, k: int, same: bool, first: float) -> DataFrame:
    """The best k rows of each target: uid, target, other, other_id, score, rank.

    wanted: uid, label, v, squares, away, slice of anchors with target and its band low to high; same: rows of the anchor's own
    label, or else of others.  first: by how much of M the radius exceeds that of the band's upper end in the first round.
    """
    spark, longest, room = table.sparkSession, index.longest, ROOM * (index.longest + 1)
    radius = lambda score: F.sqrt(F.greatest(F.col("squares") + longest**2 - 2 * score.cast("double"), F.lit(0.0)))
    end = 2 * longest + room
    state = wanted.withColumns({"nearest": radius(F.col("high")) * (1 - ROOM) - room, "end": F.least(radius(F.col("low")) * (1 + ROOM) + room, F.lit(end)), "done": F.lit(None).cast("double")})
    state = cut(state.withColumn("reach", F.least("end", F.greatest("nearest", F.lit(0.0)) + first * longest)))
    blocks = table.groupBy("pivot", "block").agg(F.min("dist").alias("lo"), F.max("dist").alias("hi"))
    width = max(CELL * longest, room)
    cell = lambda x: F.floor(x / width)
    spans = cut(blocks.withColumn("cell", F.explode(F.sequence(cell(F.col("lo")), cell(F.col("hi"))))))
    found = spark.createDataFrame([], FOUND)
    while state.take(1):
        # the intervals of a slice's anchors together, by pivot
        away = state.groupBy("slice", "uid").agg(F.first("away").alias("away"), F.max("reach").alias("reach")).select("slice", "reach", F.posexplode("away").alias("pivot", "d"))
        reach = away.groupBy("slice", "pivot").agg(F.greatest(F.min(F.col("d") - F.col("reach")), F.lit(0.0)).alias("from"), F.max(F.col("d") + F.col("reach")).alias("to"))
        reach = reach.withColumn("cell", F.explode(F.sequence(cell(F.col("from")), cell(F.least("to", F.lit(end))))))
        meet = (F.col("lo") <= F.col("to")) & (F.col("hi") >= F.col("from"))
        pairs = reach.join(spans, ["pivot", "cell"]).where(meet).select("slice", "pivot", "block").distinct()
        pairs = cut(pairs.withColumn("several", F.call_function("div", F.col("slice"), F.lit(SLICES).cast("bigint"))))
        targets = F.collect_list(F.struct("target", "low", "high", "nearest", "done", "reach")).alias("targets")
        asking = state.groupBy("slice", "uid").agg(*(F.first(c).alias(c) for c in ("label", "v", "away")), targets)
        key = ["pivot", "block", "several"]
        rows = table.select("pivot", "block", "dist", "uid", "id", "label", "v").join(pairs.select(*key).distinct(), ["pivot", "block"])
        come = pairs.join(asking, "slice")
        scanned = rows.groupBy(*key).cogroup(come.toDF(*come.columns).groupBy(*key)).applyInArrow(_scan(index, k, same), FOUND)
        found = cut(_best(found.unionByName(scanned), k).drop("rank"))
        kth = found.groupBy("uid", "target").agg(F.count("*").alias("_n"), F.min("score").alias("_worst"))
        state = state.join(kth, ["uid", "target"], "left")
        full = F.col("_n") == k
        state = state.withColumns({
            "done": F.col("reach"), "end": F.when(full, F.least("end", radius(F.col("_worst")) * (1 + ROOM) + room)).otherwise(F.col("end")),
            # what is worse than the kth needn't come back
            "low": F.when(full, F.greatest("low", "_worst")).otherwise(F.col("low")),
        }).drop("_n", "_worst")
        state = cut(state.where(F.col("done") < F.col("end")).withColumn("reach", F.least("end", 2 * F.greatest(F.col("done"), F.lit(first * longest)))))
    return _best(found, k)


def mine(rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 10, least: int = 30, most: int = 90) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    rows: usable's; anchor: which of them are anchors.  Negatives score least to most percent of their positive.
    """
    index = fit(rows)
    table = keyed(rows, index, anchor)
    asking = numbered(table.where("anchor").withColumn("g", F.lit("")), ["pivot", "dist", "uid"])
    asking = cut(asking.select("uid", "id", "label", "v", "squares", "away", F.call_function("div", F.col("idx"), F.lit(SLICE).cast("bigint")).alias("slice")))
    limit = 2**63 - 1
    plain = asking.withColumns({"target": F.lit(1), "low": F.lit(-limit).cast("bigint"), "high": F.lit(limit).cast("bigint")}).drop("id")
    near = cut(search(table, index, plain, positives, True, 0.25))
    percent = lambda p: F.col("score").cast("decimal(20,0)") * p / 100
    bands = near.select("uid", F.col("rank").alias("target"), F.ceil(percent(least)).cast("bigint").alias("low"), F.floor(percent(most)).cast("bigint").alias("high")).where("low <= high")
    far = search(table, index, asking.drop("id").join(bands, "uid"), negatives, False, 0.125)
    named = near.select("uid", F.col("rank").alias("target"), F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score"))
    out = far.join(named, ["uid", "target"]).join(asking.select("uid", F.col("id").alias("anchor_id")), "uid")
    return out.select("anchor_id", "positive_id", "rank", F.col("other_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
