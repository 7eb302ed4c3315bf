import hashlib
import random

import pytest
from pyspark.sql import functions as F

from ledgerbeam import catalog
from ledgerbeam.functions import codec
from ledgerbeam.operators import audit, campaign, extract, resolve
from ledgerbeam.plans.verdict import Refused
from ledgerbeam.sources import sinks
from tests.conftest import SMALL


def test_mask_identity(spark, tmp_path):
    good, name = b'{"1": [[1, 4]], "3": [[7, 7]]}', "crab_lumimask_2022_{}_v3.json"
    for entry, text in (("a", good), ("b", good), ("c", b'{"1": []}'), ("d", b"[1]")):
        (tmp_path / name.format(entry)).write_bytes(text)
    files = spark.read.format("binaryFile").load(str(tmp_path))
    md5 = lambda x: hashlib.md5(x).hexdigest()
    rows = [("2022", "a", name.format("a"), md5(good).upper()), ("2022", "b", name.format("b"), "0"), ("2022", "c", name.format("c"), md5(b'{"1": []}')), ("2022", "d", name.format("d"), md5(b"[1]"))]
    rows += [("2022", "e", name.format("e"), "0"), ("2022", "f", name.format("a"), "0"), ("2022", "g", "x/y", "0"), ("2022", "h", name.format("h"), None), ("2022", "i", None, None)]
    got = {r["name"]: r["problem"] for r in campaign.mask_identity(files, spark.createDataFrame(rows, "era string, name string, lumi_mask string, lumi_mask_md5 string")).collect()}
    assert got == {
        "a": None, "b": "mask with another checksum", "c": "mask without lumis", "d": "not a mask", "e": "mask file missing", "f": "mask of another entry", "g": "mask is not a bare name", "h": "mask without checksum",
    }


def test_job_states_keep_five_columns(spark):
    states = ["finished", "running", "idle", "transferring", "failed", *campaign.OTHER_STATES, "new1", None]
    jobs = spark.createDataFrame([("t", s) for s in states], "task string, state string")
    for r in campaign.job_states(jobs).collect():
        assert (r["finished"], r["idle"], r["failed"], r["others"], r["total"], r["unknown"]) == (1, 1, 1, 10, 15, ["", "new1"])


def test_parents_that_are_not_one_come_first(spark):
    cat = spark.createDataFrame([("a", "p", True), ("b", "", True), ("c", "q", True)], "child string, parent string, entry boolean")
    lin = spark.createDataFrame([("a", "p"), ("b", "p"), ("b", "q"), ("c", None), ("x", "p"), ("y", "p"), ("y", "q"), ("z", None)], "child string, parent string")
    got = {r["child"]: r["status"] for r in campaign.reconcile(cat, lin).collect()}
    assert got == {"a": "MATCH", "b": "NOT CHECKED", "c": "NOT CHECKED", "x": "ABSENT", "y": "NOT CHECKED", "z": "NOT CHECKED"}


@pytest.mark.parametrize(
    ("names", "want", "best", "version"),
    [
        (["UL18NanoAODv15-150X_v1-v2", "UL18NanoAODv15-BTVNanoV15_150X_v1-v3", "UL18NanoAODv15-20UL18JMENano_150X_v1-v1"], "v15", 0, 2),
        (["UL16NanoAODAPVv9-106X_v17-v1", "UL16NanoAODAPVv9-106X_v17-v2"], "v9", 1, 2),
        (["UL18NanoAODv9-JMENano_v1-v4", "UL18NanoAODv9-PFNano_v1-v9"], "v9", 0, -1),
        (["UL18NanoAODv9-106X_v16_L1v1-v1", "UL18NanoAODv12-106X-v9"], "v9", 0, 1),
        (["UL18NanoAODv9-106X_v16", "UL18NanoAODv9-106X-v12"], "v9", 1, 12),
    ],
)
def test_latest_versions(spark, names, want, best, version):
    rows = [("p", f"/A/{n}/NANOAODSIM", k) for k, n in enumerate(names)]
    r = campaign.latest_version(spark.createDataFrame(rows, "parent string, child string, k int"), want, pos="k").first()
    assert r["child"] == rows[best][1] and r["version"] == version
    assert campaign.latest_version(spark.createDataFrame(rows, "parent string, child string, k int"), "v99").count() == 0


@pytest.mark.parametrize(
    ("text", "error", "status"),
    [
        ("not sent", None, "unclear"), ("Resubmit request sent to the server.", None, "sent"), ("", "Found no jobs to resubmit", "nothing"), ("the task will not proceed with the resubmission", "x", "refused"),
        ("", "boom", "error"), (None, None, "unclear"), ("error, failed", None, "unclear"), ("", "resubmit request sent to the server", "error"),
    ],
)
def test_answers(spark, text, error, status):
    df = spark.createDataFrame([(text, error)], "text string, error string")
    assert campaign.classify_answers(df).first()["status"] == status


ENTRY = dict(era="2022", name="a", miniaod_version="v4", nano_role="main", lumi_mask=None, lumi_mask_md5=None, dataset="/P/Run-v1/M", nano_child="/P/Run-v1/N")
MASK = "crab_lumimask_2022_a_v3.json"


@pytest.mark.parametrize(
    ("change", "problems"),
    [
        ({}, 0), ({"era": "2018", "miniaod_version": None, "nano_role": None}, 0), ({"miniaod_version": None}, 1), ({"nano_role": "ext2"}, 1), ({"era": "2018", "nano_role": None}, 1),
        ({"miniaod_version": "v3"}, 1), ({"miniaod_version": "v3", "lumi_mask": MASK, "lumi_mask_md5": "x"}, 0), ({"miniaod_version": "v3", "lumi_mask": MASK}, 1), ({"lumi_mask": MASK, "lumi_mask_md5": "x"}, 1),
        ({"lumi_mask_md5": "x"}, 1), ({"miniaod_version": "v3", "lumi_mask": "m.json", "lumi_mask_md5": "x"}, 1), ({"dataset": "/P/Run_ext1-v1/M"}, 1),
        ({"nano_role": "ext1", "dataset": "/P/Run_ext1-v1/M"}, 1), ({"nano_role": "ext1", "dataset": "/P/Run_ext1-v1/M", "nano_child": "/P/Run_ext1-v1/N"}, 0),
        ({"miniaod_version": "v3", "nano_role": "ext1", "dataset": "/P/Run_ext1-v1/M", "nano_child": "/P/Run_ext1-v1/N", "lumi_mask": MASK, "lumi_mask_md5": "x"}, 1),
    ],
)
def test_entry_rules(spark, change, problems):
    df = spark.createDataFrame([ENTRY | change], ", ".join(f"{c} string" for c in ENTRY))
    row = campaign.entry_problems(df).first()
    assert (len(row["problems"]) if row else 0) == problems


def test_short_names_and_keys(spark):
    names = spark.createDataFrame([("P0", "4b")], "primary string, short string")
    cat = spark.createDataFrame([("2017", "n0", "/P0/x/M"), ("2018", "n1", "/P0/y/M"), ("2018", "n2", "/P1/y/M")], "era string, name string, dataset string")
    got = campaign.catalogue_keys(spark.createDataFrame([("4b",)], "short string"), names, cat)
    assert sorted((r["era"], r["name"]) for r in got.collect()) == [("2017", "n0"), ("2018", "n1")]


def test_checks_of_hits(spark):
    counts = lambda n: spark.createDataFrame([(5, n)], "hits int, mismatches int")
    assert resolve.check_hits(counts(0))["hits"] == 5 and resolve.check_hits(counts(2), stop=False)["mismatches"] == 2
    with pytest.raises(Refused) as e:
        resolve.check_hits(counts(1))
    assert e.value.code == 44


def test_lookup_fractions_are_rounded(spark):
    """A lookup holds whole fractions, events those with 14 bits."""
    from ledgerbeam.operators.extract import with_bits

    schema = "run bigint, luminosityBlock bigint, event bigint, genTtbarId int, Expanded_genTtbarId int, Generator_x1 float, Generator_x2 float, Generator_id1 int, Generator_id2 int"
    held = with_bits(spark.createDataFrame([(1, 1, 1, 53, 61, 0.123456789, 0.75, 1, 2)], schema))
    bits = held.select(F.lit(7).alias("id"), *(c for c in held.columns if c != "x1_bits"), codec.round_mantissa("x1_bits").alias("x1_bits"))
    assert held.first()["x1_bits"] != bits.first()["x1_bits"]
    assert resolve.resolve_events(bits, held, "id").first()["status"] == "hit"


def test_resolution_shuffles_rows_once(spark):
    schema = "run bigint, luminosityBlock bigint, event bigint, genTtbarId int, Expanded_genTtbarId int, Generator_x1 float, Generator_x2 float, Generator_id1 int, Generator_id2 int, x1_bits bigint, x2_bits bigint"
    df = spark.createDataFrame([], schema)
    plan = resolve.resolve_events(df.withColumn("id", F.lit(1)), df, "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 2


def test_dataset_by_file(spark, tmp_path):
    for k in ("A", "B"):
        spark.range(2).write.parquet(f"{tmp_path}/{k}/data")
    index = spark.createDataFrame([("A", 0), ("B", 1)], "dataset string, datasetIdx int")
    df = resolve.with_dataset(spark.read.parquet(f"{tmp_path}/A/data", f"{tmp_path}/B/data"), r"/([AB])/data/", index)
    assert {(r["dataset"], r["datasetIdx"]) for r in df.collect()} == {("A", 0), ("B", 1)}


@pytest.mark.parametrize(
    ("change", "status"),
    [({}, "hit"), ({"Generator_id1": 5}, "E85"), ({"Generator_x1": 0.75, "Generator_x2": 0.5}, "E85"), ({"Generator_x1": 0.5001}, "E84"), ({"Generator_x1": 0.9}, "other_event"), ({"event": 9}, "miss")],
)
def test_event_resolution(spark, change, status):
    row = dict(run=1, luminosityBlock=1, event=1, genTtbarId=53, Expanded_genTtbarId=61, Generator_x1=0.5, Generator_x2=0.75, Generator_id1=1, Generator_id2=2)
    schema = "run bigint, luminosityBlock bigint, event bigint, genTtbarId int, Expanded_genTtbarId int, Generator_x1 float, Generator_x2 float, Generator_id1 int, Generator_id2 int"
    from ledgerbeam.operators.extract import with_bits

    rows = with_bits(spark.createDataFrame([row], schema)).withColumn("id", F.lit(7))
    held = [row | change] + ([row | change] if status == "E83" else [])
    got = resolve.resolve_events(rows, with_bits(spark.createDataFrame(held, schema)), "id").first()
    assert got["status"] == status and got["resolved"] == (61 if status == "hit" else 53)
    twice = resolve.resolve_events(rows, with_bits(spark.createDataFrame([row, row], schema)), "id").first()
    assert twice["status"] == "E83"


def test_entry_filters(spark):
    cat = spark.createDataFrame([("2017", "tt", "r1", True), ("2018", "tt", "r2", False)], "era string, process string, request string, enabled boolean")
    assert campaign.select_entries(cat, era="2017").count() == 1 and campaign.select_entries(cat, process="tt", enabled=False).first()["request"] == "r2"


def test_census_of_nothing(spark):
    empty = spark.createDataFrame([], "genTtbarId int, Expanded_genTtbarId int")
    assert audit.census(empty, "genTtbarId").count() == 0 and all(r["left_n"] == r["right_n"] == 0 for r in audit.conservation(empty, empty).collect())


def test_a_wrong_chunk_is_no_substitute(spark):
    counters = {c: 0 for c in campaign.SUMS} | {"matched": 5, "nano_entries": 5, "exit_code": 0, "job_failed": False, "nano_entries_opencheck": 5, "nano_entries_postloop": 5}
    chunks = spark.createDataFrame([{"sample": s, "chunk": c} | counters for s, ids in (("a", (0, 1, 7)), ("b", (0, 1, 2)), ("c", (0, 1, 2, 3))) for c in ids])
    plan = spark.createDataFrame([(s, c) for s in "abcd" for c in range(3)], "sample string, chunk int")
    expected = spark.createDataFrame([(s, 15, False) for s in "abc"], "sample string, n_events bigint, skip boolean")
    got = {r["sample"]: r for r in campaign.sample_verdict(chunks, expected, plan).collect()}
    assert {s: r["passed"] for s, r in got.items()} == {"a": False, "b": True, "c": True, "d": False}
    assert not got["a"]["chunks_present"] and not got["a"]["events_expected"] and not got["d"]["chunks_present"]
    # nothing planned: fails
    assert not any(r["passed"] for r in campaign.sample_verdict(chunks, expected, plan.limit(0)).collect())


def test_lineage_keeps_to_the_era_and_the_primary(spark):
    mini = "/TT/RunIISummer20UL18MiniAODv2-x-v2/MINIAODSIM"
    entries = spark.createDataFrame([(e, mini, "v9", r) for e, r in (("a", None), ("b", "/TT/x/N"), ("c", None), ("d", "/TT/RunIISummer20UL18NanoAODv9-b-v1/NANOAODSIM"), ("e", None), ("f", None), ("g", None))], "entry string, parent string, version string, recorded string")
    other = "/TT/RunIISummer20UL18MiniAODv1-x-v1/MINIAODSIM"
    rows = [
        ("a", "/TT/RunIISummer20UL16NanoAODv9-a-v1/NANOAODSIM", other),  # of another era only
        ("b", "/TT/RunIISummer20UL18NanoAODv9-a-v1/NANOAODSIM", other),
        ("c", "/ZZ/RunIISummer20UL18NanoAODv9-a-v1/NANOAODSIM", other),  # another primary
        ("d", "/TT/RunIISummer20UL18NanoAODv9-JMENano_a-v9/NANOAODSIM", mini), ("d", "/TT/RunIISummer20UL18NanoAODv9-b-v1/NANOAODSIM", mini), ("d", "/TT/RunIISummer20UL18NanoAODv9-c-v3/NANOAODSIM", mini),
        ("e", "/TT/RunIISummer20UL18NanoAODv2-mc_v9-v1/NANOAODSIM", mini),  # v9 in another place
        ("f", "/TT/RunIISummer20UL18NanoAODAPVv9-a-v1/NANOAODSIM", other),
    ]
    got = {r["entry"]: tuple(r)[1:] for r in campaign.lineage_verdicts(entries, spark.createDataFrame(rows, "entry string, child string, parent string")).collect()}
    assert {e: r[0] for e, r in got.items()} == {"a": "VERSION_ABSENT", "b": "DIFFERENT_PARENT", "c": "VERSION_ABSENT", "d": "SAME_PARENT", "e": "VERSION_ABSENT", "f": "DIFFERENT_PARENT", "g": "VERSION_ABSENT"}
    assert got["d"][1:] == ("/TT/RunIISummer20UL18NanoAODv9-c-v3/NANOAODSIM", "IN_CHILD_LIST") and got["b"][2] == "NOT_IN_CHILD_LIST" and got["a"][2] is None


def test_specs_of_a_table_are_those_of_texts(spark):
    from ledgerbeam.operators import extract

    texts = [f"{n}{m}" for n in ("/A/B/NANOAODSIM", "/A=/B/NANOAODSIM", "/A/B/C/NANOAODSIM", "A/B/NANOAODSIM", "") for m in ("", "=", "=x", "=x:", "=x:1", "=x:1234567", "=a:b", "=a:b:1", "=:3", "=x=y:09", "= ", "=x:-1")]
    rows = extract.specs(spark.createDataFrame([(t,) for t in [*texts, None]], "text string")).collect()
    for r in rows[:-1]:
        try:
            assert (*extract.parse_spec(r["text"]), 0) == (r["dataset"], r["manifest"], r["priority"], r["code"]), r
        except Refused:
            assert (r["dataset"], r["code"]) == (None, 2), r
    assert rows[-1]["code"] == 2


def test_names_of_one_file(spark):
    from ledgerbeam.sources import manifest

    paths = ["root://a//s/x", "/s//x", "/s/./x?y=1", "file:///s/x", "file:/s/x", "/s/t/../x", "/../s/x", "https://h/s/x/", "/s/y", "/"]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    got = {r["path"]: r["n"] for r in df.select("path", manifest.normal(F.col("path")).alias("n")).collect()}
    assert set(got.values()) == {"/s/x", "/s/y", "/"} and all(got[p] == manifest.normalise(p) for p in paths if not p.endswith("x/"))
    assert [tuple(r) for r in manifest.repeated(df).collect()] == [("/s/x", 8)]


def test_dumps_are_bounded_or_spread(spark):
    from ledgerbeam.sources import sinks

    df = spark.range(30).select(F.col("id"), F.when(F.col("id") % 2 == 0, F.col("id")).alias("x"))
    with pytest.raises(Refused):
        sinks.dump(df, most=29)
    assert [r["line"] for r in sinks.dump_lines(df, {"a": "b"}).orderBy("at").collect()] == sinks.dump(df, {"a": "b"}, most=30)


def test_stamps_of_years_beyond_four_digits(spark):
    seconds = {0: "1970-01-01 00:00:00 UTC", 253_402_300_799: "9999-12-31 23:59:59 UTC", 253_402_300_800: "10000-01-01 00:00:00 UTC", 9_000_000 * 86_399: "26610-11-17 20:00:00 UTC"}
    got = spark.createDataFrame([(s,) for s in seconds], "s bigint").select("s", sinks.stamp("s").alias("utc")).collect()
    assert {r["s"]: r["utc"] for r in got} == seconds


def test_the_near_pair_of_patch_runs_is_one_row(spark, monkeypatch):
    """Where a limit takes another row each time it is computed, the two inputs that are too close still have one key."""
    whole, lot = catalog.A.prioritised, F.udf(lambda k: random.getrandbits(62), "bigint").asNondeterministic()
    monkeypatch.setattr(catalog.A, "prioritised", lambda s, d: whole(s, d).limit(200).withColumn("event", lot("event")))
    got = {r["scenario"]: r["code"] for r in catalog.patch_runs(spark, SMALL).collect()}
    assert got["too close"] == 9 and got["inconsistent"] == 7


def test_runs_store_no_ranked_rows(spark, monkeypatch):
    """What a run stores are the identities that meet others, not a copy of its inputs; later runs of the same inputs find nothing anew."""
    kept, stored, ranked, times = [], extract.stored, extract.ranked, []
    monkeypatch.setattr(extract, "stored", lambda df: kept.append(set(df.columns)) or stored(df))
    monkeypatch.setattr(extract, "ranked", lambda *a: times.append(1) or ranked(*a))
    rows = catalog.A.prioritised(spark, SMALL).drop("dataset", "datasetIdx", "priority", "ord")
    dense = [("/A/B/NANOAODSIM", k, rows.where(F.col("pos.l_suppkey") % 2 == k)) for k in (0, 1)]
    sparse = [("/A/B/NANOAODSIM", k, rows.where(F.expr(x)).dropDuplicates(["luminosityBlock", "event"])) for k, x in enumerate(("true", "luminosityBlock % 50 = 7"))]
    for parts in (dense, sparse):
        del times[:]
        one = extract.Extraction(parts, 2)
        want = extract.conflict_counts(ranked(extract.inputs(parts), 2)).first().asDict()
        for _ in range(3):
            assert {k: v for k, v in one.run(on_conflict="report")[1].items() if k in want} == want
        assert want["shared"] > 0 and len(times) == 2  # for the counters and for the output
    assert kept == [set(extract.identity(2))]


def test_patch_runs_stores_no_copies_of_its_inputs(spark, monkeypatch):
    kept, stored = [], extract.stored
    monkeypatch.setattr(extract, "stored", lambda df: kept.append(set(df.columns)) or stored(df))
    assert {r["scenario"]: r["code"] for r in catalog.patch_runs(spark, SMALL).collect()}["no rows"] == 6
    assert not any("pos" in columns for columns in kept)
