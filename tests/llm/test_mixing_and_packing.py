import math
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from ledgerbeam.llm import mixing, packing, quality_rules
from tests.conftest import SMALL
from tests.llm.test_near_copies import brute_force

PATH = public_tokenizers.path("byte_bpe_50k.json")


def water(sizes, weights, total):
    """Targets by repeated sharing of the excess."""
    out, free, left = {}, set(sizes), total
    while free:
        w = sum(weights[s] for s in free)
        over = [s for s in free if left * weights[s] / w > 2 * sizes[s]]
        if not over:
            out |= {s: left * weights[s] / w for s in free}
            break
        out |= {s: 2.0 * sizes[s] for s in over}
        free -= set(over)
        left = total - sum(out.values())
    return out


def test_plan_meets_targets(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = mixing.plan(docs).join(docs.select("doc_id", "source"), "doc_id").collect()
    sizes = {}
    for r in rows:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted(sizes))}
    want = water(sizes, weights, 1.5 * sum(sizes.values()))
    for s in sizes:
        own = [r for r in rows if r["source"] == s]
        assert all(r["source_size"] == sizes[s] and math.isclose(r["target"], want[s]) for r in own)
        assert abs(sum(r["taken"] for r in own) - want[s]) <= 1
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    again = {r["doc_id"]: r["taken"] for r in mixing.plan(docs.repartition(7)).collect()}
    assert again == {r["doc_id"]: r["taken"] for r in rows}


def test_mix_follows_the_plan(spark, odd):
    for docs in (spark.read.parquet(f"{SMALL}/documents.parquet"), odd):
        rows = mixing.mix(docs).collect()
        assert sum(len((r["text"] or "").split()) for r in rows) == mixing.plan(docs).agg(F.sum("taken")).first()[0]
        whole = {r["text"] for r in docs.collect()}
        cut = [r for r in rows if r["text"] not in whole]
        assert all(any(w and w.startswith(r["text"]) for w in whole) for r in cut) and all(r["n_chars"] == len(r["text"]) for r in cut)


def test_very_many_sources(spark):
    """Targets are read off one sort, in linear time; equal ids and null ones are spread by their texts."""
    df = spark.range(60_000).select(F.lit(None).cast("bigint").alias("doc_id"), F.concat(F.lit("w "), F.col("id")).alias("text"), (F.col("id") % 30_000).cast("string").alias("source"))
    began = time.monotonic()
    row = mixing.plan(df).agg(F.sum("taken").alias("t"), F.count_distinct("virtual_finish").alias("n")).first()
    assert time.monotonic() - began < 60 and abs(row["t"] - 180_000) <= 30_000


def test_mixing_edges(spark, odd, empty):
    rows = mixing.plan(odd.withColumns({"size": F.lit(1), "slice": F.lit(2), "target": F.lit("x")})).collect()
    assert len(rows) == 9 and sum(r["taken"] for r in rows) > 0
    assert mixing.plan(empty).count() == 0 and mixing.mix(empty).count() == 0
    plan = mixing.plan(odd)._jdf.queryExecution().toString()
    assert "Python" not in plan


def test_differencing_balances():
    rng = np.random.default_rng(2)
    sizes = rng.integers(1, 257, 600)
    window = packing.balance(sizes)
    fill = np.bincount(window, sizes)
    assert fill.max() <= 1024 and fill.sum() == sizes.sum() and len(fill) <= 1.03 * sizes.sum() / 1024 + 1
    # two-way differencing on the textbook case: 4 5 6 7 8 ends 2 apart
    two = packing.differencing(np.array([4, 5, 6, 7, 8]), 2)
    assert abs(np.diff(np.bincount(two, [4, 5, 6, 7, 8]))[0]) == 2
    assert packing.differencing(np.array([3]), 4).max() < 4


def check_pieces(docs, rows):
    exact = Tokenizer.from_file(PATH)
    texts = {}
    for r in docs.collect():
        texts.setdefault(r["doc_id"], []).append(r["text"] or "")
    ids = {}
    for r in sorted(rows, key=lambda r: r["start"]):
        ids.setdefault(r["doc_id"], []).append(r)
    for doc_id, own in texts.items():
        want = sum((exact.encode(t, add_special_tokens=False).ids + [0] for t in own), [])
        got = np.concatenate([np.frombuffer(r["ids"], "<u4") for r in ids[doc_id]])
        assert sorted(got.tolist()) == sorted(want)
        if len(own) == 1:
            assert got.tolist() == want and all(r["doc_tokens"] == len(want) for r in ids[doc_id])
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append(r)
    for own in by.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0 and len(r["ids"]) == 4 * r["length"]
            at += r["length"]
        assert at <= 1024


def test_pieces_are_the_documents(spark, odd, empty):
    for docs in (odd, spark.read.parquet(f"{SMALL}/documents.parquet")):
        check_pieces(docs, packing.pack(docs, PATH).collect())
    assert packing.pack(empty, PATH).count() == 0


@pytest.mark.parametrize("text", ["<|endoftext|> a", "hello <|endoftext|> world", "x<|endoftext|><|endoftext|>\n<|endoftext", " <|endoftext|> ", "  \n\n x\t\ty  ", "é" * 50, "   z", "a" * 30_000, " " * 5000 + "b", "\U0001f600́", "it's we'll 12345"])
def test_fast_ids_equal_the_library(text):
    exact = Tokenizer.from_file(PATH)
    assert packing.encoder(PATH)(text) == exact.encode(text, add_special_tokens=False).ids


def test_crc_of_ids(spark):
    r = packing.pack(spark.createDataFrame([(1, "a b")], "doc_id int, text string"), PATH).select("ids", F.crc32("ids").alias("c")).first()
    assert r["c"] == zlib.crc32(bytes(r["ids"]))


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "quality_classifier", "simhash_near_dedup", "mixing", "packing"]
    frame, kept = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        before, frame = frame, stage(spark, frame, SMALL).persist()
        kept[name] = frame.count()
        if name != "packing":
            assert frame.columns == docs.columns
        if name == "quality_rules":
            want = {r["doc_id"] for r in quality_rules.judge(before).where("kept").collect()}
            assert {r["doc_id"] for r in frame.collect()} == want
        if name == "simhash_near_dedup":  # one row of each component of similar texts, as test_near_copies has it by brute force
            want = brute_force([(r["doc_id"], r["text"]) for r in before.collect()])
            assert sorted((False, r["doc_id"]) for r in frame.collect()) == want
    assert kept["quality_rules"] > kept["simhash_near_dedup"] > 0
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").where("quality = 1")
    good = labels.join(quality_rules.judge(docs).where("not base_failed"), "doc_id").count()
    stage = corpus_pipeline.classifier(spark, corpus_pipeline.rules(spark, docs, SMALL), SMALL)
    assert stage.join(labels, "doc_id").count() >= 0.99 * good
    assert corpus_pipeline.run(spark, SMALL).count() == kept["packing"]


def test_pipeline_on_an_empty_table(spark, empty):
    frame = empty
    for _, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, SMALL)
        assert frame.count() == 0


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_the_cut_of_the_sort_is_the_closed_form(spark, seed):
    """What the truncated sort leaves of each copy is what the targets give by arithmetic, source by source."""
    import math
    import random

    rng = random.Random(seed)
    rows = [(k, "w " * rng.choice([0, 1, 2, 5, 40, 3000]), rng.choice(["a", "b", "c", "d", None] + ["hot"] * 4)) for k in range(150)] + [(7, "x y z", "a")] * 3
    docs = spark.createDataFrame(rows, "doc_id int, text string, source string")
    got = mixing.queue(mixing.sizes(docs)).collect()
    assert len(got) == len(rows)
    for r in got:
        want = [max(0, min(r["size"], math.floor(r["target"]) - r["source_size"] * c - r["before"])) for c in range(2)]
        assert [r["taken_0"], r["taken_1"]] == want


@pytest.mark.parametrize("budget", [0, 1, 7, 100, 9_999, 10**6])
def test_truncation_at_any_budget(spark, budget):
    """The first words in order of finish, over all partitions."""
    import random

    rng = random.Random(budget)
    rows = sorted((rng.choice([0.25, 0.5, rng.random()]), f"{k % 3}", k, rng.randint(1, 200)) for k in range(300))
    parts = spark.createDataFrame([(s, k, 0, k, n, f) for f, s, k, n in rows], "source_key string, before bigint, copy int, at bigint, words bigint, finish double")
    want, left = {}, budget
    for _, _, k, n in rows:
        if left > 0:
            want[k] = min(n, left)
        left -= n
    assert {r["before"]: r["words"] for r in mixing.truncated(parts, budget).collect()} == want


def test_sources_are_even_at_each_tick(spark):
    """At every tick of virtual time each source has its share of the words so far, up to one."""
    docs = spark.createDataFrame([(k, "w " * (1 + k * 7 % 90), "abc"[k % 3]) for k in range(120)], "doc_id int, text string, source string")
    sized = mixing.sizes(docs)
    goals = {r["source"]: r["target"] for r in mixing.targets(sized).collect()}
    parts = mixing.pieces(mixing.queue(sized).withColumn("source_key", F.concat(F.lit("1"), "source")), 2).collect()
    for k in range(1, mixing.TICKS + 1):
        for source, target in goals.items():
            held = sum(r["words"] for r in parts if r["source_key"] == f"1{source}" and r["finish"] <= k / mixing.TICKS)
            assert abs(held - target * k / mixing.TICKS) <= 1
