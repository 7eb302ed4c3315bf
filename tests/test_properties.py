"""Properties that hold for any table: order and split of the inputs don't matter, losses and copies show."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerbeam.operators import audit, extract, order

SIDE = "run bigint, luminosityBlock bigint, event bigint, genTtbarId int, Expanded_genTtbarId int, nAddBJets int, nAddBJetsMulti int"
DATASET = "/A/B/NANOAODSIM"


def random_rows(rng, n, keys):
    out = []
    for k in range(n):
        jets, multi, gen = rng.randrange(6), rng.randrange(3), rng.choice((53, 54, 55)) + 100 * rng.randrange(3)
        exp = gen if jets <= 2 else gen // 100 * 100 + (61 if jets == 3 else 71) + (multi > 0)
        out.append((1, rng.randrange(3), rng.randrange(keys), gen, exp, jets, multi, k))
    return out


def plain_extract(parts):
    """Rows to write and counters of format 2, row by row."""
    by, shared = {}, {}
    for rank, (priority, rows) in enumerate(parts):
        for r in rows:
            by.setdefault(r[:3], []).append((priority, rank, r[7], r))
            shared.setdefault(r[:3], set()).add(rank)
    first = {k: min(v)[3] for k, v in by.items()}
    conflicts = sum(r[3][3:5] != first[k][3:5] for k, v in by.items() for r in v)
    written = sorted((k[1], k[2], r[4]) for k, r in first.items() if r[4] % 100 in (61, 62, 71, 72))
    return written, conflicts, sum(len(x) > 1 for x in shared.values())


@pytest.mark.parametrize("seed", range(4))
def test_extraction_by_a_plain_version(spark, seed):
    rng = random.Random(seed)
    parts = [(p, random_rows(rng, n, 25)) for p, n in ((0, 30), (1, 50), (1, 20))]
    frames = [(DATASET, p, spark.createDataFrame(rows, SIDE + ", pos int")) for p, rows in parts]
    out, counts = extract.run(frames, 2, on_conflict="report")
    written, conflicts, shared = plain_extract(parts)
    assert [(r["luminosityBlock"], r["event"], r["Expanded_genTtbarId"]) for r in out.collect()] == written
    assert counts["conflicts"] == conflicts and counts["shared"] == shared


def test_counters_add_up_over_any_split(spark):
    rng = random.Random(9)
    side = {r[:3]: r for r in random_rows(rng, 200, 60)}
    s = spark.createDataFrame([r[:7] for r in side.values()], SIDE)
    nano = spark.createDataFrame([(*k, r[3] + rng.choice((0, 0, 0, 1)), rng.randrange(5)) for k, r in side.items()] + [(1, 9, 9, 0, 0)], "run bigint, luminosityBlock bigint, event bigint, genTtbarId int, chunk int")
    whole = audit.counters(audit.match(nano, s)).first().asDict()
    by = audit.counters(audit.match(nano, s), "chunk").collect()
    assert all(sum(r[c] for r in by) == v for c, v in whole.items() if c != "not_conserved")
    assert whole["agree"] + whole["disagree"] == whole["matched"] and whole["matched"] + whole["unmatched"] == whole["nano_entries"]
    again = audit.counters(audit.match(nano.repartition(7), s.orderBy(F.rand(1)))).first().asDict()
    assert again == whole
    lost = audit.counters(audit.match(nano, s.where("event % 2 = 0"))).first()
    assert lost["unmatched"] > whole["unmatched"]


def test_row_index_numbers_all_rows(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x")).repartition(9)
    got = sorted((r["row_index"], r["x"]) for r in order.row_index(df, "x").collect())
    assert got == [(k, k) for k in range(1000)]
