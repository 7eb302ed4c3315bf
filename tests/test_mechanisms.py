"""Plans and sizes of operators whose work has to stay linear."""

import os

import numpy as np
from pyspark.sql import functions as F

from ledgerbeam.functions import codec
from ledgerbeam.operators import extract, hist, intervals, order, wide

RANKED = "rank int, datasetIdx int, run bigint, luminosityBlock bigint, event bigint, Generator_x1 float, Generator_x2 float, x1_bits bigint, x2_bits bigint, Generator_id1 int, Generator_id2 int, Expanded_genTtbarId int"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# Close pairs ------------------------------------------------------------------------------------------------------------


def near(a, b):
    return a == b or np.isfinite(a) and np.isfinite(b) and abs(a - b) <= 2.0**-10 * max(abs(a), abs(b))


def test_close_pairs_against_all_pairs(spark):
    draw = np.random.default_rng(3)
    base = np.float32(10.0) ** draw.uniform(-6, 0, 12).astype(np.float32)
    values = [np.float32(b * (1 + s * 2.0**-10 * m)) for b in base for s in (-1, 1) for m in (0.0, 0.4, 0.99, 1.01)] + [np.float32(x) for x in (0.0, -0.0, np.inf, -np.inf, -0.5, -0.5004, 1e-44, 1.4e-45)]
    rows = []
    for k in range(400):
        x, y = (float(values[i]) for i in draw.integers(0, len(values), 2))
        rows.append((1, 0, 1, k % 2, 1, x, y, k, k, 21, 21 + k % 2, int(draw.choice([53, 61, 71]))))
    df = spark.createDataFrame(rows, RANKED)
    got = sorted((r["a"]["x1_bits"], r["b"]["x1_bits"]) for r in extract.too_close(df).collect())
    pairs = []
    for i, a in enumerate(rows):
        for b in rows[i + 1 :]:
            if a[3] == b[3] and a[10] == b[10] and (a[11] in (61, 71) or b[11] in (61, 71)) and near(a[5], b[5]) and near(a[6], b[6]):
                pairs.append((a, b))
    assert sorted(tuple(sorted(p)) for p in got) == sorted((min(a[7], b[7]), max(a[7], b[7])) for a, b in pairs) and len(got) > 20


def test_spread_events_of_one_key_are_linear(spark):
    """100,000 events of one key, all with extra jets: each looks at a few others only."""
    k = F.col("id")
    draw = lambda salt: (F.pmod(F.xxhash64(k, F.lit(salt)), F.lit(10**6)) / 10**6 * 0.9 + 0.05).cast("float")
    for n in (25_000, 100_000):
        rows = spark.range(n).select(
            F.lit(1).alias("rank"), F.lit(0).alias("datasetIdx"), *(F.lit(1).cast("bigint").alias(c) for c in extract.KEY), draw(1).alias("Generator_x1"), draw(2).alias("Generator_x2"),
            k.alias("x1_bits"), k.alias("x2_bits"), F.lit(21).alias("Generator_id1"), F.lit(21).alias("Generator_id2"), F.lit(61).alias("Expanded_genTtbarId"),
        )
        met = extract.meeting(rows).where(F.col("e") != F.col("f")).count()
        # by chance an event has n x (three cells of 0.1 %) squared x (1 / 0.9) squared neighbours, most of them at large fractions
        assert met < n * n * 2.5e-5 + n, met
    assert extract.meeting(rows).where(F.col("e") == F.col("f")).count() == n


# Masks ------------------------------------------------------------------------------------------------------------------


def test_words_of_bits_hold_the_mask(spark):
    spans = [(1, 1, 1), (1, 60, 70), (1, 63, 64), (1, 128, 191), (1, 190, 400), (2, 64, 64), (2, 127, 127), (3, 1, 1000), (3, 5, 7), (4, 9, 8)]
    mask = spark.createDataFrame(spans, "run bigint, lo bigint, hi bigint")
    want = {(run, b) for run, lo, hi in spans for b in range(lo, hi + 1)}
    words = intervals.words(mask).collect()
    assert {(r["run"], r["word"] * 64 + i) for r in words for i in range(64) if r["bits"] >> i & 1} == want
    rows = spark.range(0, 1100).select(F.explode(F.array(*(F.lit(r).cast("bigint") for r in range(5)))).alias("run"), F.col("id").alias("luminosityBlock"))
    assert {tuple(r) for r in intervals.inside(rows, mask).collect()} == want
    assert intervals.outside(rows, mask).count() == 5500 - len(want)
    c = intervals.coverage(rows.where("luminosityBlock % 2 = 0"), mask).first()
    assert (c["seen"], c["inside"], c["unseen"]) == (2750, sum(b % 2 == 0 for _, b in want), sum(b % 2 for _, b in want))
    assert c["outside"] == c["seen"] - c["inside"] and c["mask_lumis"] == sum(hi - lo + 1 for _, lo, hi in spans)


def test_masks_of_one_side_only(spark):
    mask = spark.createDataFrame([(1, 5, 6)], "run bigint, lo bigint, hi bigint")
    rows = spark.createDataFrame([(2, 5)], "run bigint, luminosityBlock int")
    assert tuple(intervals.coverage(rows, mask).first()) == (2, 1, 0, 1, 2)
    assert tuple(intervals.coverage(rows.limit(0), mask).first()) == (2, 0, 0, 0, 2)
    assert tuple(intervals.coverage(rows, mask.limit(0)).first()) == (0, 1, 0, 1, 0)
    assert "exists" not in plan(intervals.inside(rows, mask)).lower()


# Histograms -------------------------------------------------------------------------------------------------------------


def test_histograms_are_summed_before_they_are_dealt_out(spark):
    df = spark.range(1000).select(*((F.col("id") % m).cast("int").alias(c) for c, m in (("genTtbarId", 3), ("Expanded_genTtbarId", 2), ("nAddBJets", 2), ("nAddBJetsMulti", 1))))
    steps = plan(hist.booked(df))
    assert steps.index("Generate") < steps.rindex("HashAggregate") and steps.count("HashAggregate") == 4
    assert hist.booked(df).agg(F.sum("n")).first()[0] == 6000


# Wide tables ------------------------------------------------------------------------------------------------------------


def test_wide_values_of_all_kinds(spark):
    kinds = "k int, f float, d double, i int, s string, af array<float>, ai array<int>, other string, b boolean"
    nan = float("nan")
    left = [(1, 1.0, nan, 1, "a", [1.0, nan], [1, 2], "1", True), (2, nan, 1.0, None, None, None, None, "2", None), (3, 0.0, 5.0, 3, "c", [], [1], "3", True), (4, 1.0, 1.0, 4, "d", [1.0, None], [1, None], "4", False)]
    right = [(1, 1.0001, nan, 1, "a", [1.0001, nan], [1, 2], 1, True), (2, 1.0, None, None, "x", [1.0], None, 2, None), (3, -0.0, 5.1, 4, "c", [1.0], [2], 9, False), (5, 0.0, 0.0, 0, "", [], [], 0, True)]
    a, b = spark.createDataFrame(left, kinds), spark.createDataFrame(right, kinds.replace("other string", "other int"))
    got = {r["name"]: (r["compared"], r["mismatches"], r["nan_agree"]) for r in wide.value_mismatches(a, b, ["k"]).collect()}
    assert got == {"f": (3, 1, 0), "d": (3, 2, 1), "i": (3, 1, 0), "s": (3, 1, 0), "af": (3, 2, 0), "ai": (3, 1, 0), "other": (3, 1, 0), "b": (3, 1, 0)}
    none = {r["name"]: (r["compared"], r["mismatches"]) for r in wide.value_mismatches(a.limit(0), b, ["k"]).collect()}
    assert set(none.values()) == {(0, 0)} and len(none) == 8


def test_wide_values_are_compared_in_batches(spark):
    rows = spark.range(50).selectExpr("id AS k").repartition(4, "k")
    left, right = (rows.selectExpr("k", *(f"k + {c} AS c{c}" for c in range(20)), *(f"double(if(k % 10 = {c}, {x}, k)) AS d{c}" for c in range(20))) for x in ("k", "-1"))
    found = wide.value_mismatches(left, right, ["k"])
    assert {r["name"]: r["mismatches"] for r in found.where("mismatches > 0").collect()} == {f"d{c}": 5 for c in range(10)}
    steps = plan(found)
    assert "MapInArrow" in steps and "lambda" not in steps and "SortMergeJoin" in steps and "BroadcastHashJoin" not in steps


def test_wide_plans_do_not_grow_by_aggregates(spark):
    few, many = (spark.range(3).selectExpr("id AS k", *(f"id + {c} AS c{c}" for c in range(n))) for n in (3, 60))
    aggregates = [plan(wide.value_mismatches(x, x, ["k"])).count("count_if") for x in (few, many)]
    assert aggregates[0] == aggregates[1]


def test_wide_tables_are_no_single_generated_method(spark):
    """A method that is too long takes the compiler long and much memory before it gives up; here giving up is an error."""
    spark.conf.set("spark.sql.codegen.fallback", "false")
    try:
        rows = spark.range(40).selectExpr("id AS k").repartition(2, "k")
        made = lambda c, x: (f"{x} + {c}", f"double({x} + {c})", f"concat('v', {x})", f"array(float({x} % 7), float({c}))")[c % 4] + f" AS `c.{c}`"
        left = rows.selectExpr("k", *(made(c, "k") for c in range(1000)))
        right = rows.selectExpr("k", *(made(c, f"if(k = {c}, k + 100001, k)") for c in range(1000)))
        found = {r["name"]: (r["compared"], r["mismatches"]) for r in wide.value_mismatches(left, right, ["k"]).collect()}
    finally:
        spark.conf.unset("spark.sql.codegen.fallback")
    assert found == {f"c.{c}": (40, int(c < 40)) for c in range(1000)}
    for n in (128, 129, 300):  # as many arrays or more
        x = left.select("k", *(f"`c.{c}`" for c in range(n)))
        assert "_a127" in plan(wide.value_mismatches(x, x, ["k"]))


def test_near_is_what_the_pairs_use(spark):
    assert spark.range(1).select(codec.near(F.lit(1.0), F.lit(1.0009)), codec.near(F.lit(1.0), F.lit(1.002))).first()[:] == (True, False)


# Order of files ---------------------------------------------------------------------------------------------------------


def both_ways(rows):
    a, b = (sorted(map(tuple, x.select("file", "n", "first_run", "first_luminosityBlock", "first_event", "last_run", "last_luminosityBlock", "last_event", "min_lumi", "max_lumi", "sorted").collect())) for x in (order.file_order(rows), order._by_position(rows)))
    assert a == b
    return {r[0].rsplit("/", 1)[-1]: r for r in a}


def test_stored_files_are_summed_up_without_sorting(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    from ledgerbeam.sources import manifest

    n = 25_000
    for name, change in {"up": None, "one_down": 12_345, "down_at_a_batch": 10_000, "last_down": n - 1}.items():
        event = np.arange(n)
        if change:
            event[change] = event[change - 1] - 1
        pq.write_table(pa.table({"run": np.ones(n, int), "luminosityBlock": np.arange(n) // 100 % 7 if name == "blocks" else np.zeros(n, int), "event": event}), tmp_path / f"{name}.parquet", row_group_size=3000)
    scanned = manifest.scan(spark, [f"{tmp_path}/{f}" for f in os.listdir(tmp_path)])
    got = both_ways(scanned)
    assert {k: r[-1] for k, r in got.items()} == {"up.parquet": True, "one_down.parquet": False, "down_at_a_batch.parquet": False, "last_down.parquet": False}
    steps = plan(order.stretches(scanned))
    assert "Sort" not in steps and "Exchange" not in steps and "Window" not in steps
    assert order.stretches(scanned).count() < 40


def test_rows_out_of_position_are_put_in_order(spark):
    rows = spark.range(9000).select(
        F.concat(F.lit("f"), F.col("id") % 3).alias("file"), F.pmod(F.col("id") * 7919, F.lit(9000)).alias("pos"), F.lit(1).cast("bigint").alias("run"),
        F.call_function("div", F.pmod(F.col("id") * 7919, F.lit(9000)), F.lit(100)).alias("luminosityBlock"), (F.pmod(F.col("id") * 7919, F.lit(9000)) + F.when(F.col("id") == 1, -900).otherwise(0)).alias("event"),
    ).repartition(5)
    got = both_ways(rows)
    assert [r[-1] for r in got.values()].count(False) == 1
    assert order.file_order(rows.limit(0)).count() == 0


# Streams ----------------------------------------------------------------------------------------------------------------


def test_a_batch_reads_the_state_of_its_own_keys(spark, tmp_path):
    from ledgerbeam.operators import audit
    from ledgerbeam.sources import parts
    from ledgerbeam.streaming import incremental

    k = F.col("id")
    side = spark.range(6000).select(
        F.lit(1).cast("bigint").alias("run"), F.call_function("div", k, F.lit(500)).alias("luminosityBlock"), (k % 500 * 40).alias("event"), F.lit(0).alias("genTtbarId"), F.lit(0).alias("Expanded_genTtbarId"),
        F.lit(0).alias("nAddBJets"), F.lit(0).alias("nAddBJetsMulti"),
    )
    for b in range(12):
        side.where(F.col("luminosityBlock") == b).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    # blocks 2 and 3 again, and a row three times in one file
    side.where("luminosityBlock in (2, 3)").unionByName(side.where("luminosityBlock = 5 and event = 0")).unionByName(side.where("luminosityBlock = 5 and event = 0")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    reference = side.select(*audit.KEY, "genTtbarId")
    parts.write_parts(reference, f"{tmp_path}/reference", 700)
    query = incremental.incremental_counters(incremental.stream(spark, f"{tmp_path}/in", side.schema, 1), f"{tmp_path}/reference", f"{tmp_path}/out", f"{tmp_path}/cp")
    query.awaitTermination(300)
    row = incremental.totals(spark, f"{tmp_path}/out", reference).first()
    assert (row["matched"], row["unmatched"], row["agree"], row["n_dup"]) == (6000, 0, 6000, 1002)
    states = [p["stateOperators"][0] for p in query.recentProgress if p["numInputRows"]]
    assert len(states) == 13 and states[-1]["numRowsTotal"] == 24
    assert all(s["numRowsUpdated"] <= 6 for s in states)
