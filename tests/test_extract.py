"""Extraction on small known tables: run lumi event gen exp nAdd nMulti [x1 x2 id1 id2]."""

import pytest
from pyspark.sql import functions as F

from ledgerbeam.operators import extract
from ledgerbeam.plans.verdict import Refused

DA, DB, DC = "/A/main/NANOAODSIM", "/B/ext1/NANOAODSIM", "/C/ext2/NANOAODSIM"
SCHEMA = "run bigint, luminosityBlock bigint, event bigint, genTtbarId int, Expanded_genTtbarId int, nAddBJets int, nAddBJetsMulti int, pos int"
FP = SCHEMA.removesuffix(", pos int") + ", Generator_x1 float, Generator_x2 float, Generator_id1 int, Generator_id2 int, pos int"

T2 = {
    "a4": "1 1 101 53 61 3 3 · 1 1 102 55 55 2 2 · 1 1 103 54 72 4 5 · 1 2 201 0 0 0 0 · 1 2 202 53 62 3 4",
    "a3": "1 1 101 53 61 3 4 · 1 1 102 55 55 2 2 · 1 3 301 54 71 4 4 · 1 3 302 51 51 0 0",
    "b4": "1 2 202 54 71 4 4 · 1 1 101 53 62 3 3 · 1 4 401 0 0 0 0",
    "c4": "1 5 501 0 0 0 0 · 1 5 502 41 41 0 0",
    "a4s": "1 1 101 53 61 3 3 · 1 1 102 55 55 2 2",
    "exp": "1 1 101 53 62 3 3 · 1 3 301 54 71 4 4",
    "gen": "1 1 101 54 61 3 3 · 1 3 301 54 71 4 4",
    "cat": "1 1 102 55 61 3 3 · 1 3 301 54 71 4 4",
    "dup": "1 1 101 53 61 3 3 · 1 1 101 53 61 3 3 · 1 1 105 53 62 3 3",
    "dupx": "1 1 101 53 61 3 3 · 1 1 101 53 62 3 3",
    "dupc": "1 1 101 53 61 3 3 · 1 1 101 53 53 2 2",
    "dupn": "1 1 101 53 53 2 2 · 1 1 101 54 54 2 2",
    "big6": "1 9 901 0 0 0 0 · 1 9 902 0 0 0 0 · 1 9 903 0 0 0 0 · 1 9 904 0 0 0 0 · 1 9 906 0 0 0 0 · 1 9 905 53 61 3 3",
    "bad7": "1 1 101 53 61 2 2 · 1 1 102 55 55 2 2",
    "zero": "",
}
T3 = {
    "v4": "1 1 101 53 61 3 3 .25 .5 21 21 · 1 1 101 53 53 2 2 .375 .0625 2 -2 · 1 1 102 53 62 3 4 .125 .75 1 -1 · 1 2 201 0 0 0 0 .5 .5 21 21 · 1 2 202 54 71 4 4 .0625 .25 21 2 · "
    "1 4 401 53 53 2 2 .5 .5 2 2 · 1 4 401 53 54 2 2 .75 .75 3 3",
    "v3": "1 1 102 53 62 3 5 .125 .75 1 -1 · 1 2 202 54 72 4 5 .75 .125 -1 1 · 1 3 301 54 71 4 4 .5 .25 21 21 · 1 4 401 53 61 3 3 .25 .25 1 1",
    "ext1": "1 1 101 53 62 3 3 .25 .5 21 21 · 1 5 501 0 0 0 0 .5 .5 21 21",
    "v4s": "1 1 101 53 61 3 3 .25 .5 21 21 · 1 1 102 53 62 3 4 .125 .75 1 -1",
    "v3big": "1 1 101 53 53 2 2 .375 .0625 2 -2 · 1 1 102 53 62 3 5 .125 .75 1 -1 · 1 2 202 54 72 4 5 .75 .125 -1 1 · 1 3 301 54 71 4 4 .5 .25 21 21 · 1 6 601 0 0 0 0 .5 .5 21 21",
    "conf": "1 1 102 53 61 3 4 .125 .75 1 -1",
    "gen": "1 1 102 54 62 3 4 .125 .75 1 -1",
    "dupx": "1 1 101 53 61 3 3 .25 .5 21 21 · 1 1 101 53 62 3 3 .25 .5 21 21",
    "two": "1 1 101 53 61 3 3 .25 .5 21 21 · 1 1 101 53 72 4 4 .75 .125 21 21",
    "close": "1 1 101 53 61 3 3 .5 .25 21 21 · 1 1 101 53 53 2 2 .50048828125 .25 21 21",
    "closev4": "1 1 101 53 61 3 3 .5 .25 21 21 · 1 7 701 0 0 0 0 .5 .5 1 1 · 1 7 702 0 0 0 0 .5 .5 1 1",
    "closev3": "1 1 101 53 53 2 2 .50000006 .25 21 21",
    "apart": "1 1 101 53 61 3 3 .5 .25 21 21 · 1 1 101 53 53 2 2 .5009765625 .25 21 21",
    "ids": "1 1 101 53 61 3 3 .5 .25 21 21 · 1 1 101 53 53 2 2 .5 .25 21 1",
    "closenn": "1 1 101 53 53 2 2 .5 .25 21 21 · 1 1 101 53 53 2 2 .50048828125 .25 21 21",
    "close2": "1 1 101 53 61 3 3 .5 .25 21 21 · 1 1 101 53 71 4 4 .50048828125 .25 21 21",
}


def table(spark, name, fmt):
    rows = [r.split() for r in (T3 if fmt == 3 else T2)[name].split("·") if r.strip()]
    made = [tuple(float(v) if 7 <= k < 9 else int(v) for k, v in enumerate(r)) + (i,) for i, r in enumerate(rows)]
    return spark.createDataFrame(made, FP if fmt == 3 else SCHEMA)


def run(spark, fmt, *parts, **more):
    return extract.run([(ds, prio, table(spark, name, fmt)) for ds, name, prio in parts], fmt, **more)


def rows(df):
    return [tuple(r[c] for c in ("datasetIdx", "luminosityBlock", "event", "genTtbarId", "Expanded_genTtbarId", "nAddBJets", "nAddBJetsMulti")) for r in df.collect()]


MAIN2 = [(DA, "a4", 0), (DA, "a3", 1), (DB, "b4", 0), (DC, "c4", 0)]
WANT2 = [(0, 1, 101, 53, 61, 3, 3), (0, 1, 103, 54, 72, 4, 5), (0, 2, 202, 53, 62, 3, 4), (0, 3, 301, 54, 71, 4, 4), (1, 1, 101, 53, 62, 3, 3), (1, 2, 202, 54, 71, 4, 4)]


def test_format_2(spark):
    out, counts = run(spark, 2, *MAIN2, expect={DA: 9, DB: 3})
    assert rows(out) == WANT2
    assert counts == {"conflicts": 0, "other_counts": 1, "repeated": 0, "shared": 2, "entries": 14, "datasets": 3, "inputs": 4}
    large = table(spark, "a4", 2).withColumn("nAddBJets", F.lit(40_000))
    with pytest.raises(Refused) as e:
        extract.run([(DA, 0, large)], 2)
    assert e.value.code == 5
    rank = extract.ranked(extract.inputs([(d, p, table(spark, n, 2)) for d, n, p in MAIN2]), 2)
    by = {(r["dataset"], r["priority"]): (r["entries"], r["superseded"], r["written"]) for r in extract.sources(rank).collect()}
    assert by == {(DA, 0): (5, 0, 3), (DA, 1): (4, 2, 1), (DB, 0): (3, 0, 2), (DC, 0): (2, 0, 0)}
    assert {r["dataset"]: r["n"] for r in extract.summary(extract.lookup(rank)).collect()} == {DA: 4, DB: 2, None: 6}


def test_order_of_inputs_does_not_matter(spark):
    assert rows(run(spark, 2, *MAIN2[::-1])[0]) == WANT2


def test_smaller_first_priority(spark):
    out, _ = run(spark, 2, (DA, "a3", 0), (DA, "a4s", 1))
    assert rows(out) == [(0, 1, 101, 53, 61, 3, 4), (0, 3, 301, 54, 71, 4, 4)]


@pytest.mark.parametrize(("fmt", "parts"), [(2, [(DA, "a4s", 0), (DA, x, 1)]) for x in ("exp", "gen", "cat")] + [(2, [(DA, x, 0)]) for x in ("dupx", "dupc", "dupn")] + [(2, [(DA, x, 0), (DA, "big6", 1)]) for x in ("dupx", "dupc", "dupn")] + [(3, [(DA, "v4", 0), (DA, "conf", 1)]), (3, [(DA, "v4", 0), (DA, "gen", 1)]), (3, [(DA, "dupx", 0)])])
def test_conflicts_stop(spark, fmt, parts):
    with pytest.raises(Refused) as e:
        run(spark, fmt, *parts)
    assert e.value.code == 8


def test_conflicts_reported(spark):
    out, counts = run(spark, 2, (DA, "a4s", 0), (DA, "exp", 1), on_conflict="report")
    assert counts["conflicts"] == 1 and rows(out)[0] == (0, 1, 101, 53, 61, 3, 3)


def test_repeats(spark):
    out, counts = run(spark, 2, (DA, "dup", 0))
    assert [r[2] for r in rows(out)] == [101, 105] and counts["repeated"] == 1
    out, counts = run(spark, 2, (DA, "dup", 0), (DA, "big6", 1))
    assert [r[2] for r in rows(out)] == [101, 105, 905] and counts["repeated"] == 1


@pytest.mark.parametrize(("parts", "expect", "code"), [([(DA, "zero", 0)], None, 6), ([(DA, "a4", 0)], {DA: 6}, 6), ([(DA, "a4", 0)], {DB: 5}, 2), ([(DA, "bad7", 0)], None, 7)])
def test_refusals(spark, parts, expect, code):
    with pytest.raises(Refused) as e:
        run(spark, 2, *parts, expect=expect)
    assert e.value.code == code


def test_format_1_keeps_order_and_repeats(spark):
    assert [r["event"] for r in extract.format1(table(spark, "dup", 2)).collect()] == [101, 101, 105]


MAIN3 = [(DA, "v4", 0), (DA, "v3", 1), (DB, "ext1", 0)]


def test_format_3(spark):
    out, counts = run(spark, 3, *MAIN3)
    got = [(r["datasetIdx"], r["luminosityBlock"], r["event"], r["Expanded_genTtbarId"], r["Generator_x1"]) for r in out.collect()]
    assert got == [(0, 1, 101, 61, 0.25), (0, 1, 102, 62, 0.125), (0, 2, 202, 71, 0.0625), (0, 2, 202, 72, 0.75), (0, 3, 301, 71, 0.5), (0, 4, 401, 61, 0.25), (1, 1, 101, 62, 0.25)]
    assert counts["entries"] == 13 and counts["shared"] == 1 and counts["conflicts"] == 0 and counts["too_close"] == 0
    rank = extract.ranked(extract.with_bits(extract.inputs([(d, p, table(spark, n, 3)) for d, n, p in MAIN3])), 3)
    by = {(r["dataset"], r["priority"]): (r["entries"], r["superseded"], r["written"]) for r in extract.sources(rank).collect()}
    assert by == {(DA, 0): (7, 0, 3), (DA, 1): (4, 1, 3), (DB, 0): (2, 0, 1)}
    keys = {r["dataset"]: (r["multi_event_keys"], r["multi_selected_keys"]) for r in extract.multi_event_keys(rank).collect()}
    assert keys == {DA: (3, 1), DB: (0, 0)}


def test_format_3_roles(spark):
    out, _ = run(spark, 3, (DA, "v4s", 0), (DA, "v3big", 1))
    assert [(r["event"], r["Expanded_genTtbarId"]) for r in out.collect()] == [(101, 61), (102, 62), (202, 72), (301, 71)]
    for parts in ([(DA, "two", 0)], [(DA, "two", 0), (DA, "v3big", 1)]):
        assert [r["Expanded_genTtbarId"] for r in run(spark, 3, *parts)[0].where("event = 101").collect()] == [61, 72]


@pytest.mark.parametrize("parts", [[(DA, "close", 0)], [(DA, "close", 0), (DA, "v3big", 1)], [(DA, "closev4", 0), (DA, "closev3", 1)]])
def test_too_close_stops(spark, parts):
    with pytest.raises(Refused) as e:
        run(spark, 3, *parts)
    assert e.value.code == 9


@pytest.mark.parametrize(("name", "n"), [("apart", 1), ("ids", 1), ("closenn", 0)])
def test_not_too_close(spark, name, n):
    assert run(spark, 3, (DA, name, 0))[0].count() == n


def test_too_close_reported(spark):
    out, counts = run(spark, 3, (DA, "close2", 0), on_close="report")
    assert out.count() == 2 and counts["too_close"] == 1


def test_mixed_schemas_are_refused():
    whole = ["run", *extract.FINGERPRINT]
    assert extract.detect_format({"a": whole, "b": whole}) == 3 and extract.detect_format({"a": ["run"]}) == 2
    for bad in ({"a": whole, "b": ["run"]}, {"a": ["run", "Generator_x1"]}):
        with pytest.raises(Refused) as e:
            extract.detect_format(bad)
        assert e.value.code == 5


def test_specs():
    assert extract.parse_spec(f"{DA}=list.txt") == (DA, "list.txt", 0) and extract.parse_spec(f"{DA}=list.txt:12") == (DA, "list.txt", 12)
    for bad in (DA, f"{DA}=", "/A/B=list", "/A/B/MINIAODSIM=list", f"{DA}=odd:12:1", f"{DA}=list:1234567", f"{DA}=list:x", f"{DA}=:1"):
        with pytest.raises(Refused) as e:
            extract.parse_spec(bad)
        assert e.value.code == 2


def test_bits_keep_zeros_apart(spark):
    df = spark.createDataFrame([(1, 1, 1, 53, 61, 3, 0, 0.0, 0.5, 1, 1, 0), (1, 1, 1, 53, 61, 3, 0, -0.0, 0.5, 1, 1, 1)], FP)
    out = extract.lookup(extract.ranked(extract.with_bits(extract.inputs([(DA, 0, df)])), 3))
    assert sorted(r["x1_bits"] for r in out.select(F.col("x1_bits")).collect()) == [0, 0x80000000]


@pytest.mark.parametrize("fmt", [2, 3])
@pytest.mark.parametrize("most", [0.0, 10.0])
def test_rows_that_are_alone_rank_the_same(spark, fmt, most):
    """Repeats within inputs, between inputs and in blocks that only one has, with and without the way around the window."""
    import random

    rng = random.Random(fmt)
    rows = [(rng.randint(0, 1), 1, rng.randint(0, 12), rng.randint(0, 8), rng.choice([0, 5]), rng.randint(0, 2), k, rng.choice([53, 54]), rng.choice([53, 61]), 3, 1, rng.randint(0, 1), 7, 1, 2) for k in range(400)]
    names = "datasetIdx int, run bigint, luminosityBlock bigint, event bigint, priority int, ord int, pos bigint, genTtbarId int, Expanded_genTtbarId int, nAddBJets int, nAddBJetsMulti int, x1_bits bigint, x2_bits bigint, Generator_id1 int, Generator_id2 int"
    df = spark.createDataFrame(rows, names)
    found = extract.ranked_sparse(df, fmt, most)
    plain = extract.ranked(df, fmt)
    assert sorted(map(tuple, found.select(*plain.columns).collect())) == sorted(map(tuple, plain.collect()))
    assert extract.ranked_sparse(df.limit(0), fmt, most).count() == 0
