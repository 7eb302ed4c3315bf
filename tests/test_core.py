import math

import pytest
from pyspark.sql import functions as F

from ledgerbeam.functions import codec
from ledgerbeam.operators import audit, campaign, derive, hist, intervals, order, resolve, wide
from ledgerbeam.plans.verdict import AUDIT, SORTED_AUDIT, Refused, decide


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_integer_semantics(spark):
    assert one(spark, codec.prefix(F.lit(-253))) == -2 and one(spark, codec.prefix(F.lit(253))) == 2
    assert one(spark, codec.sub_code(F.lit(-7))) == 93 and one(spark, codec.raw_sub_code(F.lit(-7))) == -7


@pytest.mark.parametrize(("gen", "n", "multi", "want"), [(10254, 3, 1, 10262), (254, 3, 1, 262), (153, 3, 0, 161), (253, 3, 0, 261), (10153, 3, 0, 10161), (54, 4, 0, 71), (54, 5, 2, 72), (55, 2, 2, 55), (0, 0, 0, 0)])
def test_expanded_codes(spark, gen, n, multi, want):
    assert one(spark, codec.expand(F.lit(gen), F.lit(n), F.lit(multi))) == want


def test_nearness(spark):
    near = lambda x, y: one(spark, codec.near(F.lit(x), F.lit(y)))
    assert near(0.5, 0.50048828125) and not near(0.5, 0.5009765625) and near(0.0, -0.0) and not near(math.inf, 1.0) and near(math.inf, math.inf)


def test_float_bits_tell_zeros_and_nans_apart(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,), (float("nan"),), (-1.0,), (0.5,)], "x float").withColumn("b", codec.unsigned(codec.float_bits("x")))
    got = [r["b"] for r in df.collect()]
    assert got[0] == 0 and got[1] == 0x80000000 and got[2] & 0x7F800000 == 0x7F800000 and got[3] == 0xBF800000 and got[4] == 0x3F000000


def test_mantissa_rounding(spark):
    half = 0x3F000000
    assert one(spark, codec.round_mantissa(F.lit(half | 0x100))) == half + 0x200
    assert one(spark, codec.round_mantissa(F.lit(half | 0xFF))) == half
    assert one(spark, codec.round_mantissa(F.lit(half | 0x7FFFFF))) == half | 0x7FFE00


def test_float_agreement(spark):
    agrees = lambda a, b: one(spark, codec.agrees(F.lit(a), F.lit(b)))
    assert agrees(math.nan, math.nan) and not agrees(math.nan, 1.0) and agrees(1.0, 1.00049) and not agrees(0.0, 5e-4) and agrees(1000.0, 1000.4)


EVENTS = [
    # (jets, hadron indexes, from-top flags, n, multi); acceptance is inclusive
    ([(20.0, 2.4), (30.0, -2.4), (19.9, 0.0), (50.0, 2.5)], [0, 1, 2, 3], [False] * 4, 2, 0),
    ([(40.0, 0.0)] * 3, [0, 0, 1, 2, -1, 7], [False, False, False, True, False, False], 2, 1),
    ([(40.0, 0.0)] * 2, [0, 0, 1, 1], [False, True, False, False], 1, 1),
    ([], [], [], 0, 0),
    ([(40.0, 0.0)], [-1], [False], 0, 0),
]


def test_jet_counts_nested_and_exploded(spark):
    rows = [(k, [{"pt": p, "eta": e} for p, e in jets], idx, top) for k, (jets, idx, top, _, _) in enumerate(EVENTS)]
    df = spark.createDataFrame(rows, "ev int, jets array<struct<pt:double,eta:double>>, idx array<int>, top array<boolean>")
    got = df.select("ev", derive.count_nested(F.col("jets"), F.col("idx"), F.col("top")).alias("c")).orderBy("ev").collect()
    assert [(r["c"]["n"], r["c"]["multi"]) for r in got] == [(n, m) for *_, n, m in EVENTS]
    long = df.select("ev", "jets", F.explode(F.arrays_zip("idx", "top")).alias("h"))
    j = F.when((F.col("h.idx") >= 0) & (F.col("h.idx") < F.size("jets")), F.get("jets", F.col("h.idx")))
    hadrons = long.select("ev", F.col("h.idx").alias("jet_idx"), j["pt"].alias("pt"), j["eta"].alias("eta"), F.col("h.top").alias("from_top"))
    events = df.select("ev", F.lit(53).alias("genTtbarId"))
    side = derive.sidecar(events, derive.count_jets(hadrons)).orderBy("ev").collect()
    assert [(r["nAddBJets"], r["nAddBJetsMulti"]) for r in side] == [(n, m) for *_, n, m in EVENTS]


def test_missing_products(spark):
    filled, counts = derive.missing_products(spark.createDataFrame([(1, None), (None, 2)], "a int, b int"), ["a", "b"])
    assert sorted(map(tuple, filled.collect())) == [(0, 2), (1, 0)] and counts.first()["missing_a"] == 1


SIDE = "run bigint, luminosityBlock bigint, event bigint, genTtbarId int, Expanded_genTtbarId int, nAddBJets int, nAddBJetsMulti int"
NANO = "run bigint, luminosityBlock bigint, event bigint, genTtbarId int"
NANO_NAMES = ("run", "luminosityBlock", "event", "genTtbarId")
GOOD = [(1, 1, 1, 53, 61, 3, 0), (1, 1, 2, 54, 72, 4, 1), (1, 1, 3, 0, 0, 0, 0), (1, 1, 4, 153, 153, 2, 1)]


def verdict(spark, side, nano=None, checks=AUDIT):
    nano = [r[:4] for r in side] if nano is None else nano
    return audit.verdict(spark.createDataFrame(nano, NANO), spark.createDataFrame(side, SIDE), checks)


def test_clean_tables_pass(spark):
    v = verdict(spark, GOOD)
    assert v.passed and v.counters["matched"] == v.counters["agree"] == 4 and verdict(spark, GOOD, checks=SORTED_AUDIT).passed


def test_unmatched_rows_alone_are_a_note(spark):
    v = verdict(spark, GOOD[:3], [r[:4] for r in GOOD])
    assert v.passed and v.counters["unmatched"] == 1


@pytest.mark.parametrize(
    ("change", "code"),
    [
        (lambda s: [*s, s[0]], 7),
        (lambda s: [(2, *s[0][1:]), *s[1:]], 9),
        (lambda s: [(*s[0][:3], 54, *s[0][4:]), *s[1:]], 6),
        (lambda s: [(*s[0][:5], 2, 0), *s[1:]], 8),  # extension with two jets
        (lambda s: [(*s[0][:4], 53, 3, 0), *s[1:]], 8),  # three jets without extension
        (lambda s: [(*s[0][:4], 161, 3, 0), *s[1:]], 8),  # other prefix
        (lambda s: [(*s[0][:4], 62, 3, 0), *s[1:]], 8),  # other sub-code
        (lambda s: [*s[:2], (1, 1, 3, 0, 41, 0, 0), s[3]], 8),  # changed without need
        (lambda s: [(2, *s[0][1:]), s[1], s[1], *s[2:]], 9),  # precedence: domain before duplicates
        (lambda s: [(*s[0][:3], 54, 62, 3, 0), s[1], s[1], *s[2:]], 7),  # duplicates before disagreement
    ],
)
def test_each_failure_has_its_code(spark, change, code):
    assert verdict(spark, change(GOOD), [r[:4] for r in GOOD]).code == code


def test_nothing_matched_and_sorted_differences(spark):
    assert verdict(spark, GOOD, [(1, 9, 9, 0)]).code == 5
    assert verdict(spark, [*GOOD, GOOD[0]], [r[:4] for r in GOOD], SORTED_AUDIT).passed  # no duplicate check there
    wrong = [(*GOOD[0][:4], 62, 3, 0), *GOOD[1:]]
    assert verdict(spark, wrong, checks=SORTED_AUDIT).passed and verdict(spark, wrong).code == 8


def test_other_verdicts(spark):
    side = spark.createDataFrame(GOOD, SIDE).withColumn("pos", F.col("event"))
    reference = side.select(*NANO_NAMES)
    assert audit.rule_verdict(side).passed and audit.rule_verdict(side, expect_4b=True).passed
    assert audit.rule_verdict(side.where("event <> 2"), expect_4b=True).code == 3
    assert audit.rule_verdict(side.withColumn("Expanded_genTtbarId", F.lit(161))).code == 2
    spot = lambda r, s: audit.spot_verdict(r, s, "pos")
    assert spot(reference, side).passed and spot(reference.withColumn("event", F.col("event") + 100), side).code == 5
    assert spot(reference.withColumn("genTtbarId", F.when(F.col("event") == 1, 54).otherwise(F.col("genTtbarId"))), side).code == 6
    assert spot(reference, side.withColumn("Expanded_genTtbarId", F.when(F.col("event") == 3, 41).otherwise(F.col("Expanded_genTtbarId")))).code == 7
    newer = side.unionByName(side.where("event = 1").withColumns({"genTtbarId": F.lit(55), "pos": F.lit(99)}))
    assert spot(reference, newer).code == 6 and spot(reference, newer).counters["overwritten"] == 1
    files = audit.by_file(side.withColumn("file", F.lit("a")), spark.createDataFrame([("a",), ("b",)], "file string"))
    lost = spark.createDataFrame([("f", "bad_columns"), ("g", "ok"), ("h", "empty")], "file string, status string")
    assert audit.files_verdict(files).passed and audit.files_verdict(files).counters["empty_files"] == 1 and audit.files_verdict(files, lost).failed == "bad_columns"
    broken = audit.by_file(side.withColumns({"file": F.lit("a"), "run": F.lit(2)}), spark.createDataFrame([("a",)], "file string"))
    assert audit.files_verdict(broken).code == 2 and audit.files_verdict(broken, lost).code == 1


def test_missing_counters_fail():
    assert decide({}, AUDIT).code == 9


def test_order_and_overlap(spark):
    rows = [("a", 0, 1, 1, 1), ("a", 1, 1, 2, 1), ("b", 0, 1, 2, 5), ("b", 1, 1, 2, 4), ("c", 0, 1, 1, 9)]
    df = spark.createDataFrame(rows, "file string, pos int, run bigint, luminosityBlock bigint, event bigint")
    by = order.file_order(df)
    assert {r["file"]: r["sorted"] for r in by.collect()} == {"a": True, "b": False, "c": True}
    over = {r["file"]: (r["out_of_order"], r["overlaps"]) for r in order.file_overlap(by).collect()}
    assert over == {"a": (False, False), "b": (False, True), "c": (True, True)}
    assert order.order_verdict(order.file_overlap(by)).first()["verdict"] == "not strictly ordered"


@pytest.mark.parametrize("n", [0, 1, 250, 999, 1000])
def test_exact_shards(spark, n):
    df = spark.range(n).select(F.lit(1).alias("run"), (F.col("id") % 7).alias("luminosityBlock"), F.col("id").alias("event")).repartition(5)
    got = sorted((r["part"], r["rows"]) for r in order.shard_index(order.shards(df, 250)).collect())
    assert [c for _, c in got] == [250] * (n // 250) + [n % 250] * bool(n % 250) and [p for p, _ in got] == list(range(len(got)))


def test_histogram_edges_and_ratio(spark):
    df = spark.createDataFrame([(-1,), (0,), (99,), (100,)], "x int")
    assert {r["bin"]: r["n"] for r in hist.histogram(df, "x", 100, 0, 100).collect()} == {0: 1, 1: 1, 100: 1, 101: 1}
    a, b = spark.createDataFrame([(1, 4), (2, 2)], "bin int, n int"), spark.createDataFrame([(1, 4), (3, 1)], "bin int, n int")
    got = {r["bin"]: (r["ratio"], r["red"], r["listed"]) for r in hist.ratio(a, b).collect()}
    assert got == {1: (1.0, False, False), 2: (None, False, True), 3: (0.0, True, True)}
    assert hist.ratio(a, b, normalise=True).where("bin = 1").first()["ratio"] == pytest.approx((4 / 6) / (4 / 5))
    names = spark.createDataFrame([("tt_1", 1, 2), ("tt_22", 1, 3), ("tt_x_1", 1, 5)], "name string, bin int, n int")
    assert {r["process"]: r["n"] for r in hist.merge(names).collect()} == {"tt": 5, "tt_x": 5}


def test_wide_judgement(spark):
    left = spark.createDataFrame([(1, 1.0, [1.0, 2.0], "a"), (2, float("nan"), [1.0], "b")], "k int, x double, v array<double>, s string")
    right = spark.createDataFrame([(1, 1.0001, [1.0, 2.0], "a"), (2, float("nan"), [1.0, 2.0], "c")], "k int, x double, v array<double>, s string")
    got = {r["name"]: (r["mismatches"], r["nan_agree"]) for r in wide.value_mismatches(left, right, ["k"]).collect()}
    assert got == {"x": (0, 1), "v": (1, 0), "s": (1, 0)}
    m, d = wide.value_mismatches(left, right, ["k"]), wide.schema_diff(left, right)
    assert wide.judge(m, d).code == 4 and wide.judge(m, d, allow="^(v|s)$").passed and wide.judge(m, d, only_left={"q"}).code == 1 and wide.judge(m, d, zero=False).passed
    assert wide.judge(m, d, least_common=9).code == 1 and [r["name"] for r in wide.worst(m, 1).collect()] == ["s"]


def test_masks(spark):
    parse = lambda t: intervals.checked_mask(intervals.parse_mask(spark.createDataFrame([(t,)], "value string")))
    rows = spark.createDataFrame([(1, 1), (1, 2), (1, 3), (2, 1)], "run bigint, luminosityBlock bigint")
    mask = parse('{"1": [[1, 1], [3, 5]]}')
    assert intervals.inside(rows, mask).count() == 2 and intervals.outside(rows, mask).count() == 2
    assert intervals.containment(rows, mask).code == 1 and intervals.containment(rows.limit(0), mask).code == 5
    assert intervals.containment(intervals.inside(rows, mask), mask).code == 0 and intervals.containment(intervals.inside(rows, mask), mask, full=True).code == 4
    for bad in ('{"1": [[3, 1]]}', '{"1": [[0, 1]]}', '{"1": [[1]]}', "{}", '{"1": []}'):
        with pytest.raises(Refused) as e:
            parse(bad)
        assert e.value.code == 2


def test_resolution(spark):
    lookup = spark.createDataFrame([r for r in GOOD if r[4] in (61, 72)], SIDE)
    got = {r["event"]: (r["hit"], r["resolved"], r["mismatch"]) for r in resolve.resolve(spark.createDataFrame([r[:4] for r in GOOD[:3]] + [(1, 1, 9, 5)], NANO), lookup).collect()}
    assert got == {1: (True, 61, False), 2: (True, 72, False), 3: (False, 0, False), 9: (False, 5, False)}
    resolve.check_lookup(lookup)
    # an empty table is 42; 41 is one that can't be opened
    for bad, code in ((lookup.limit(0), 42), (lookup.unionByName(lookup.withColumn("Expanded_genTtbarId", F.lit(62))), 43)):
        with pytest.raises(Refused) as e:
            resolve.check_lookup(bad)
        assert e.value.code == code


CHUNK = dict(nano_entries=10, nano_entries_postloop=10, nano_entries_opencheck=10, matched=10, unmatched=0, agree=10, disagree=0, nAddBJets_ge3=1, expanded_sub_in_set=1, viol_ext_but_lt3=0, viol_ge3_not_ext=0, viol_prefix_changed=0, viol_le2_changed=0, exit_code=0, job_failed=False)


@pytest.mark.parametrize(
    ("change", "failed"),
    [
        ({}, None), ({"unmatched": 1}, "none_unmatched"), ({"disagree": 1}, "none_disagree"), ({"nAddBJets_ge3": 2}, "conserved"), ({"viol_prefix_changed": 1}, "no_violations"), ({"exit_code": 8}, "exits_zero"),
        ({"job_failed": True}, "no_anomalies"), ({"nano_entries_opencheck": 11}, "no_anomalies"), ({"nano_entries_postloop": None}, "no_anomalies"), ({"chunk": 2}, None),
    ],
)
def test_sample_verdicts(spark, change, failed):
    chunk = {"sample": "s", "chunk": 1} | CHUNK | change
    chunks = spark.createDataFrame([chunk], "sample string, chunk int, exit_code int, job_failed boolean, " + ", ".join(f"{c} bigint" for c in CHUNK if c not in ("exit_code", "job_failed")))
    expected = spark.createDataFrame([("s", 1, 10, False)], "sample string, n_chunks int, n_events bigint, skip boolean")
    row = campaign.sample_verdict(chunks, expected).first().asDict()
    assert row["passed"] == (failed is None) and [k for k, v in row.items() if v is False and k != "passed"] == ([failed] if failed else [])


def test_missing_expectations_fail_and_lost_chunks_show(spark):
    chunks = spark.createDataFrame([{"sample": "s", "chunk": 1} | CHUNK])
    schema = "sample string, n_chunks int, n_events bigint, skip boolean"
    for rows, failed in (([("s", 1, None, False)], "events_expected"), ([("s", 2, 10, False)], "chunks_present"), ([("t", 1, 10, False)], "chunks_present")):
        bad = [r for r in campaign.sample_verdict(chunks, spark.createDataFrame(rows, schema)).collect() if not r[failed]]
        assert bad and not any(r["passed"] for r in bad)
    assert campaign.sample_verdict(chunks, spark.createDataFrame([("s", 1, None, True)], schema)).first()["passed"]


def test_catalogue_updates_are_all_or_nothing(spark):
    a, b, pa, pb = "/A/RunN-1/NANOAODSIM", "/B/RunN-1/NANOAODSIM", "/A/RunM-1/MINIAODSIM", "/B/RunM-1/MINIAODSIM"
    cat = spark.createDataFrame([(a, "", True, False, False), (b, pb, True, False, False)], "child string, parent string, entry boolean, enabled boolean, verified boolean")
    good = spark.createDataFrame([(a, pa), (b, pb)], "child string, parent string")
    new, done = campaign.update_parents(campaign.reconcile(cat, good), cat, "RunM-")
    assert done and {r["child"]: r["parent"] for r in new.collect()} == {a: pa, b: pb}
    for lineage, prefix in ((good.where(F.col("child") == b), "RunM-"), (good, "RunO-"), (good.withColumn("parent", F.replace("parent", F.lit("/A/"), F.lit("/C/"))), "RunM-"), (good.unionByName(good.withColumn("parent", F.lit("/A/RunM-2/MINIAODSIM"))), "RunM-")):
        same, done = campaign.update_parents(campaign.reconcile(cat, lineage), cat, prefix)
        assert not done and same.where("parent = ''").count() == 1
    assert campaign.apply_matches(campaign.reconcile(new, good), new)[0].where("enabled and verified").count() == 2
    assert not campaign.apply_matches(campaign.reconcile(cat, good), cat)[1]
