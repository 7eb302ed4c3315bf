import random
import re
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerbeam.llm import near_copies, simhash
from tests.conftest import SMALL
from tests.llm.conftest import DOCS


def plain_set(text):
    w = [x for x in re.split("[ \t-\r]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")) if x]
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_force(rows):
    """The rows that stay: of each component the smallest id, nulls last."""
    sets = [plain_set(t) for _, t in rows]
    label = list(range(len(rows)))
    for a, b in combinations(range(len(rows)), 2):
        x, y = sets[a], sets[b]
        if x == y or 5 * len(x & y) >= 4 * len(x | y):
            old, new = max(label[a], label[b]), min(label[a], label[b])
            label = [new if k == old else k for k in label]
    groups = {}
    for k, (i, t) in zip(label, rows):
        groups.setdefault(k, []).append((i is None, i or 0))
    return sorted(min(g) for g in groups.values())


@pytest.mark.parametrize("chunk", [3, 1024])
def test_near_copies_equal_brute_force(spark, chunk):
    """Random edits around the similarity of 0.8, short texts, case and white space, a dense group, a shared passage."""
    rng = random.Random(4)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    stock, texts = words(40), []
    for n in (3, 5, 6, 20, 60, 90, 200):
        base = words(n)
        texts.append(base)
        for k in range(14):
            new = list(base)
            for _ in range(k // 2):
                new[rng.randrange(n)] = f"x{rng.randrange(10**6)}"
            texts.append(new if k % 3 else new + words(n // 8))
    texts += [stock + words(8 + k) for k in range(20)]
    rows = [(k, " ".join(t)) for k, t in enumerate(texts)]
    rows += [(1000 + k, t.upper().replace(" ", " \n") + "\t") for k, t in rows[:40:3]] + [(2000, None), (2001, " \n"), (2002, "")]
    rng.shuffle(rows)
    kept = near_copies.keep_one(spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS), chunk).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept) == brute_force(rows)


def test_no_pair_is_checked_twice(spark, monkeypatch):
    """Texts that share most groups, a similarity of 0.7 to 0.8 apart: each pair comes out of one group."""
    rng = random.Random(3)
    base = [f"w{k}" for k in range(200)]
    rows = []
    for k in range(60):
        new = list(base)
        for at in rng.sample(range(200), 3):
            new[at] = f"x{k}y{at}"
        rows.append((k, " ".join(new)))
    seen, plain_check = [], near_copies._checked
    monkeypatch.setattr(near_copies, "_checked", lambda pairs, texts: (seen.append(pairs), plain_check(pairs, texts))[1])
    for chunk in (5, 1024):
        kept = near_copies.keep_one(spark.createDataFrame([(*r, "en", "s", 0) for r in rows], DOCS), chunk).collect()
        assert sorted((False, r["doc_id"]) for r in kept) == brute_force(rows)
        across = [(r["u"], r["v"]) for r in seen[-1].collect()]
        assert len(across) > 100 and len(set(across)) == len(across)


def test_dense_groups_are_checked_in_rounds(spark, monkeypatch):
    """Texts around 0.75 with some links: pairs that the likeliest ones have joined aren't checked."""
    rng = random.Random(5)
    base, rows = [f"w{k}" for k in range(200)], []
    for k in range(160):
        new = list(base)
        for at in rng.sample(range(60), 3):
            new[at] = f"x{k}y{at}"
        rows.append((k, " ".join(new)))
    given, checked = [], []
    plain_across, plain_check = near_copies._across, near_copies._checked
    monkeypatch.setattr(near_copies, "_across", lambda *a: (given.append(out := plain_across(*a)), out)[1])
    monkeypatch.setattr(near_copies, "_checked", lambda pairs, texts: (checked.append(pairs), plain_check(pairs, texts))[1])
    kept = near_copies.keep_one(spark.createDataFrame([(*r, "en", "s", 0) for r in rows], DOCS)).collect()
    assert sorted((False, r["doc_id"]) for r in kept) == brute_force(rows)
    pairs, sent = given[0].count(), sum(p.count() for p in checked[1:])
    assert pairs > 32 * 160 and 0 < sent < pairs / 4, (pairs, sent)


def test_sketches_never_lose_a_similar_pair():
    """Sets of all sizes at a similarity of 0.8 and above pass; far ones don't."""
    rng = np.random.default_rng(4)
    lost = far = 0
    for n in (1, 2, 5, 9, 30, 100, 450, 2000, 20_000):
        for _ in range(40):
            x = np.unique(rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + rng.integers(0, 2, n).astype(np.uint64))
            changed = lambda k: np.unique(np.concatenate([x[k:], rng.integers(0, 1 << 63, k, np.uint64)]))  # noqa: B023, E731
            y, z = changed(len(x) // 9), changed(len(x) * 2 // 3)
            words = [np.frombuffer(near_copies.sketch(v), np.uint64)[None] for v in (x, y, z)]
            lost += near_copies.similar(x, y) and not near_copies.possible(words[0], words[1], np.array([len(x) + len(y)]))[0]
            far += n >= 100 and bool(near_copies.possible(words[0], words[2], np.array([len(x) + len(z)]))[0])
    assert lost == 0 and far < 5


def test_pipeline_stage_drops_copies_beyond_four_bits(spark):
    rng = random.Random(8)
    base = [f"w{k}" for k in range(120)]
    edits = []
    while len(edits) < 3:  # Jaccard similarity 0.84 or so, more than four bits apart
        new = list(base)
        for at in (10, 95):
            new[at] = f"x{rng.randrange(10**6)}"
        if bin(simhash.fingerprint(" ".join(base)) ^ simhash.fingerprint(" ".join(new))).count("1") > 4:
            edits.append(new)
    docs = spark.createDataFrame([(k, " ".join(t), "en", "s", 0) for k, t in enumerate([base, *edits])], DOCS)
    assert [r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, "").collect()] == [0]


@pytest.mark.parametrize("keep", [simhash.keep_one, near_copies.keep_one])
def test_one_of_each_group_with_null_and_repeated_ids(spark, keep):
    a, b, c = (" ".join(f"{x}{k}" for k in range(40)) for x in "abc")
    rows = [(None, a), (None, b), (None, b), (None, c), (1, c), (7, a.upper()), (2, " ".join(f"d{k}" for k in range(40))), (2, " ".join(f"e{k}" for k in range(40))), (2, " ".join(f"e{k}" for k in range(40)))]
    kept = keep(spark.createDataFrame([(*r, "en", "s", 0) for r in rows], DOCS)).collect()
    texts = sorted((r["doc_id"] or 0, r["text"][0].lower()) for r in kept)
    assert texts == [(0, "b"), (1, "c"), (2, "d"), (2, "e"), (7, "a")]


def test_odd_and_empty(spark, odd, empty):
    kept = near_copies.keep_one(odd.withColumns({"_node": F.lit(1), "_rank": F.lit(2)}))
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 5, 6, 2**60 + 1]
    assert kept.columns == [*odd.columns, "_node", "_rank"]
    assert near_copies.keep_one(empty).count() == 0


def test_pipeline_chain(spark):
    """The stages one by one give what the whole run gives; the near-duplicate stage equals brute force."""
    frame = spark.read.parquet(f"{SMALL}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before, frame = frame, stage(spark, frame, SMALL).persist()
        if name == "simhash_near_dedup":
            want = brute_force([(r["doc_id"], r["text"]) for r in before.collect()])
            assert sorted((False, r["doc_id"]) for r in frame.collect()) == want and frame.columns == before.columns
    assert corpus_pipeline.run(spark, SMALL).count() == frame.count()


def unlike(rng, n, shared=60, own=60):
    """Texts with a long passage in common that are unlike otherwise, some with a near copy."""
    words = lambda k: [f"w{rng.randrange(10**9)}" for _ in range(k)]
    stock, out = words(shared), []
    while len(out) < n:
        out.append(stock + words(own))
        if len(out) % 40 == 0:
            near = list(out[-1])
            near[shared + rng.randrange(own - 10) + 5] = f"x{rng.randrange(10**9)}"
            out.append(near)
    return [(k, " ".join(t)) for k, t in enumerate(out[:n])]


def test_huge_groups_are_keyed_again(spark, monkeypatch):
    """Groups beyond RAREST chunks of unlike texts: the same copies are found, by the rarest hashes."""
    rng = random.Random(11)
    rows = unlike(rng, 420)
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS)
    used, plain_again = [], near_copies._again
    monkeypatch.setattr(near_copies, "_again", lambda *a: (used.append(out := plain_again(*a)), out)[1])
    kept = near_copies.keep_one(docs, 1).collect()
    assert sorted((False, r["doc_id"]) for r in kept) == brute_force(rows)
    assert used[-1].where("level = 1").count() > 0
    assert used[-1].where("level = 1").groupBy("node").count().agg(F.max("count")).first()[0] <= near_copies.RAREST


def test_rows_of_unlike_nodes_stay_flat(spark):
    """One key whose nodes are unlike: rows each stop rising where the group is huge."""
    rng, each = random.Random(5), {}
    for n in (400, 800, 1600):
        rows = unlike(rng, n, 8, 60)
        texts = spark.createDataFrame(rows, "node bigint, whole string")
        labelled = texts.select(F.lit(7).cast("bigint").alias("key"), "node", F.col("node").alias("label"))
        each[n] = near_copies._dealt(near_copies._again(labelled, texts, 8), 8).count() / n
    assert max(each.values()) <= near_copies.RAREST and each[1600] <= each[400] + 1, each


def test_similar_texts_share_one_of_their_rarest_hashes():
    """Whatever the order of the hashes is, a pair at 0.8 has one in common among the first RAREST of both."""
    rng = random.Random(2)
    lost = 0
    for _ in range(300):
        base = [f"w{rng.randrange(10**9)}" for _ in range(200)]
        other = list(base)
        for at in rng.sample(range(0, 200, 10), 4):
            other[at] = f"x{rng.randrange(10**9)}"
        x, y = (near_copies.elements(near_copies.plain(" ".join(t))) for t in (base, other))
        order = {e: rng.random() for e in {*x, *y}}
        first = lambda e: set(sorted(e, key=order.get)[: near_copies.RAREST])  # noqa: B023, E731
        lost += not first(x) & first(y)
    assert lost == 0


def test_few_rows_take_few_tasks(spark):
    """Steps over few rows aren't all dealt out to a task for each shuffle partition, which would each leave files and lines in the log."""
    many = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in many}
    for k, v in many.items():
        spark.conf.set(k, v)
    spark.sparkContext.setJobGroup("few", "few rows")
    try:
        edges = spark.createDataFrame([(k + 1, k) for k in range(40)], "u bigint, v bigint")
        found = simhash.components(edges.repartition(64, "u"))
        assert sorted(map(tuple, found.collect())) == [(k + 1, 0) for k in range(40)]
        assert found.rdd.getNumPartitions() == 1
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    tracker = spark.sparkContext.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup("few") for s in tracker.getJobInfo(j).stageIds}
    tasks = [info.numTasks for s in stages if (info := tracker.getStageInfo(s)) and info.numCompletedTasks]
    # 64 tasks would be each stage's number
    assert len(tasks) > 10 and sum(t > 4 for t in tasks) < len(tasks) / 2, sorted(tasks)
