"""Byte-level BPE, hard negatives, Merkle manifest: against the library, brute force and a plain tree."""

import hashlib
import os
import subprocess
import sys

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerbeam.llm import byte_bpe, hard_negatives, merkle_manifest, queries
from tests.conftest import SMALL

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.ranks_of(PATH), special_tokens={})


# Byte-level BPE ---------------------------------------------------------------------------------------------------------


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=("Cs",)), max_size=80))
def test_texts_are_cut_and_merged_as_the_library_does(library, text):
    ids = [i for word in byte_bpe.splitter(public_tokenizers.PATTERN)(text) for i in byte_bpe.merger(PATH)(word)]
    assert ids == library.encode_ordinary(text)


def test_characters_that_libraries_see_differently(library):
    """Each character that only newer tables call a letter or number, between letters and between signs."""
    split, merge = byte_bpe.splitter(public_tokenizers.PATTERN), byte_bpe.merger(PATH)
    for c in ("՘", "࢏", "౜", "ₐ", "\U00011de0", "͸", "\x1c", "\x85", " ", "　", "​", "﻿", "\U0010ffff"):
        for text in (f"a{c}b", f"!{c}?", f"1{c}2", f" {c} {c}", c * 5, f"\n{c}\n\n"):
            assert [i for w in split(text) for i in merge(w)] == library.encode_ordinary(text), repr(text)


def ids_of(df):
    return sorted((r["row"]["doc_id"] if r["row"]["doc_id"] is not None else -1, np.frombuffer(r["ids"], "<u4").tolist(), bytes(r["decoded"]) if "decoded" in df.columns else None) for r in df.collect())


def test_odd_texts_and_repeated_rows(spark, library, odd):
    rows = odd.select("doc_id", "lang", "text", F.lit("x").alias("ids"), F.lit(1).alias("block"), F.lit(2).alias("k"))
    found = byte_bpe.decode(byte_bpe.encode(rows, PATH, public_tokenizers.PATTERN), PATH)
    want = sorted((r["doc_id"] if r["doc_id"] is not None else -1, library.encode_ordinary(r["text"] or ""), (r["text"] or "").encode()) for r in odd.collect())
    assert ids_of(found) == want
    assert found.select("row.block", "row.ids").distinct().collect() == [(1, "x")]


def test_small_blocks_give_the_same(spark, library, monkeypatch):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    want = sorted((r["doc_id"], library.encode_ordinary(r["text"] or ""), None) for r in docs.collect())
    for block, words, group in ((2**21, 2**18, 256), (200, 2**18, 256), (2**21, 50, 3), (1, 1, 1)):
        monkeypatch.setattr(byte_bpe, "BLOCK", block)
        monkeypatch.setattr(byte_bpe, "WORDS", words)
        monkeypatch.setattr(byte_bpe, "GROUP", group)
        assert ids_of(byte_bpe.encode(docs, PATH, public_tokenizers.PATTERN)) == want


def test_a_text_that_the_library_cannot_take(spark):
    """A million spaces, and a word of 300,000 letters: ids that decode to the text."""
    docs = spark.createDataFrame([(1, " " * 1_000_000), (2, "ab" * 150_000), (3, None)], "doc_id int, text string")
    found = {r["row"]["doc_id"]: r for r in byte_bpe.decode(byte_bpe.encode(docs, PATH, public_tokenizers.PATTERN), PATH).collect()}
    assert found[1]["decoded"] == b" " * 1_000_000 and found[2]["decoded"] == b"ab" * 150_000 and found[3]["decoded"] == b"" == found[3]["ids"]


def test_each_distinct_word_is_dealt_once_a_block(spark):
    docs = spark.createDataFrame([(k, "the cat and the dog and the cat " * 50) for k in range(40)], "doc_id int, text string").coalesce(1)
    rows = docs.select(F.struct("doc_id").alias("row"), "text")
    dealt = byte_bpe.dictionary(rows, public_tokenizers.PATTERN, 8)
    words = len(set(byte_bpe.splitter(public_tokenizers.PATTERN)("the cat and the dog and the cat " * 50)))
    assert dealt.agg(F.sum("n")).first()[0] == words and dealt.count() <= 8
    assert byte_bpe.encoded_words(dealt, PATH).agg(F.sum("n")).first()[0] == words


def test_ids_that_the_vocabulary_lacks(spark):
    bad = spark.createDataFrame([((1,), np.array([5, 60_000], "<u4").tobytes())], "row struct<doc_id: int>, ids binary")
    with pytest.raises(Exception, match="no such token: 60000"):
        byte_bpe.decode(bad, PATH).collect()


def test_no_documents(spark, empty):
    assert byte_bpe.decode(byte_bpe.encode(empty, PATH, public_tokenizers.PATTERN), PATH).count() == 0


def test_the_query_against_the_library(spark, library):
    found = {r["doc_id"]: r for r in queries.op11_byte_bpe(spark, SMALL).collect()}
    for doc_id, text in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect():
        ids = library.encode_ordinary(text or "")
        assert found[doc_id]["n_tokens"] == len(ids) and found[doc_id]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert found[doc_id]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


# Hard negatives ---------------------------------------------------------------------------------------------------------


def brute(rows, positives=5, negatives=10, least=30, most=90, every=100):
    """rows: (id, label, whole numbers)."""
    out = []
    for a, (own, label, v) in enumerate(rows):
        if own is None or own % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i is None, i or 0, k) for k, (i, _, w) in enumerate(rows) if k != a)
        same = [s for s in scored if rows[s[3]][1] == label][:positives]
        for s in same:
            good = [t for t in scored if rows[t[3]][1] != label and least * -s[0] <= 100 * -t[0] <= most * -s[0]][:negatives]
            out += [(own, rows[s[3]][0], k + 1, rows[t[3]][0], -s[0], -t[0]) for k, t in enumerate(good)]
    return sorted(out, key=repr)


def mined(spark, rows, kind="array<float>", **more):
    df = spark.createDataFrame(rows, f"vec_id bigint, label int, embedding {kind}")
    usable = hard_negatives.usable(df.withColumns({"uid": F.lit(1), "pivot": F.lit("x")}))
    return sorted(map(tuple, hard_negatives.mine(usable, F.col("id") % 100 == 0, **more).collect()), key=repr)


def whole(rows):
    size = max((len(v) for _, _, v in rows), default=0)
    return [(i, label, [int(np.floor(256 * float(np.float32(x)))) for x in v] + [0] * (size - len(v))) for i, label, v in rows]


def test_clusters_ties_and_copies(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK", 16)
    monkeypatch.setattr(hard_negatives, "SLICE", 2)
    monkeypatch.setattr(hard_negatives, "SLICES", 2)
    monkeypatch.setattr(hard_negatives, "PIVOTS", 5)
    draw = np.random.default_rng(7)
    centre = draw.normal(size=(6, 8))
    rows = [(k * 20, int(k % 4), (centre[k % 6] + 0.4 * draw.normal(size=8)).astype(np.float32).tolist()) for k in range(120)]
    rows += [(1000 + k, k % 2, [0.5] * 8) for k in range(60)]  # a third of all rows alike
    rows += [(k * 20, 1, rows[k][2]) for k in range(0, 30, 5)]  # repeated ids
    assert mined(spark, rows) == brute(whole(rows))


def test_odd_vectors(spark):
    inf, nan = float("inf"), float("nan")
    good = [(0, 1, [1.0, 2.0]), (100, 2, [2.0, 1.0]), (1, 1, [1.0, 2.0]), (2, 2, [0.5, 0.5]), (3, 2, [0.6]), (None, 1, [1.0, 1.0]), (200, 1, []), (4, 2, [0.0, 0.0]), (5, 2, [-3.0, -3.0])]
    bad = [(6, None, [1.0, 1.0]), (7, 1, None), (8, 1, [1.0, None]), (9, 1, [nan, 1.0]), (10, 1, [inf, 1.0]), (300, 1, [1.0, -inf])]
    assert mined(spark, good + bad) == brute(whole(good))
    assert mined(spark, [(0, 1, [1.0])]) == [] and mined(spark, []) == []


def test_large_numbers_stay_exact(spark):
    big = [(100 * k, k % 2, [float(2**30 + 7 * k), float(-k), 3.0]) for k in range(12)]
    rows = [(i, label, [int(256 * x) for x in v]) for i, label, v in big]
    top = 2**63 - 1
    cap = [tuple(max(-top, min(top, x)) if k > 3 else x for k, x in enumerate(r)) for r in brute(rows)]
    got = mined(spark, big, "array<double>")
    assert len(got) == len(cap) and {r[4] for r in got} == {r[4] for r in cap}


def test_recall_of_the_query_is_one(spark):
    """The index is exact: every row that brute force gives, on the given table."""
    e = spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
    rows = [(r["vec_id"], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"], r["embedding"]) for r in e if r["label"] is not None and r["embedding"] is not None]
    got = sorted((tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")) for r in queries.op12_hard_negatives(spark, SMALL).collect()), key=repr)
    assert got == brute(whole(rows))


# Merkle manifest --------------------------------------------------------------------------------------------------------


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(nodes):
    """The root and the proof of each node: its siblings' digests, from left to right, level by level."""
    proofs, at, now = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(now) > 1:
        for i, k in enumerate(at):
            run = range(k - k % 3, min(k - k % 3 + 3, len(now)))
            proofs[i] += [now[j] for j in run if j != k]
        now, at = [H(*now[k : k + 3]) for k in range(0, len(now), 3)], [k // 3 for k in at]
    return now[0], proofs


def plain_leaf(row):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain_manifest(rows):
    """rows: doc_id, source, lang, n_chars, text."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, plain_leaf(r)))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = [tree([x[2] for x in sorted(groups[s])]) for s in order]
    root, upper = tree([t[0] for t in trees])
    out = []
    for s, t, up in zip(order, trees, upper):
        out += [(x[1] if x[0] else None, x[2], t[0], root, H(*p, *up)) for x, p in zip(sorted(groups[s]), t[1])]
    return sorted(out, key=repr)


def built(docs):
    rows = merkle_manifest.of_documents(docs).select("doc_id", "leaf", "subroot", "root", merkle_manifest.siblings_digest(F.col("proof")).alias("p"))
    return sorted(map(tuple, rows.collect()), key=repr)


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_trees_of_all_sizes(spark, monkeypatch, levels):
    """One to thirty leaves a source, with buckets of 3, 9 and 729 leaves."""
    monkeypatch.setattr(merkle_manifest, "LEVELS", levels)
    rows = [(100 * s + k, f"s{s}", "en", k, f"text {k}\nline") for s in (1, 2, 3, 4, 8, 9, 10, 27, 28, 30) for k in range(s)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string").withColumn("idx", F.lit(1))
    assert built(docs) == plain_manifest(rows)


def test_odd_documents(spark, odd):
    rows = [(r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"]) for r in odd.collect()]
    assert built(odd) == plain_manifest(rows)


def test_one_document_and_none(spark, odd, empty):
    one = odd.where("doc_id = 6")
    row = merkle_manifest.of_documents(one).first()
    assert row["leaf"] == row["subroot"] == row["root"] and row["proof"] == []
    assert built(empty) == []


def test_tampering_is_seen(spark):
    """Folding a proof from a changed leaf leaves the root; from the true one it doesn't."""
    rows = merkle_manifest.of_documents(spark.read.parquet(f"{SMALL}/documents.parquet"))
    checked = rows.select("doc_id", "leaf", "tampered", "root", merkle_manifest.folded(F.col("leaf"), F.col("proof")).alias("a"), merkle_manifest.folded(F.col("tampered"), F.col("proof")).alias("b")).collect()
    assert all(r["a"] == r["root"] for r in checked)
    changed = [r for r in checked if r["leaf"] != r["tampered"]]
    assert changed and all(r["b"] != r["root"] for r in changed) and all(r["b"] == r["root"] for r in checked if r["leaf"] == r["tampered"])


def test_a_source_spans_many_partitions(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("one").alias("source"), F.lit("en").alias("lang"), F.lit(1).alias("n_chars"), F.lit("same").alias("text"))
    rows = [(k, "one", "en", 1, "same") for k in range(3000)]
    assert built(docs) == plain_manifest(rows)


def test_ids_do_not_depend_on_the_seed_of_hashes():
    """Buckets of words come from checksums, so workers with other seeds deal words alike."""
    code = "from ledgerbeam.llm import byte_bpe as b; print([b._bucket(w, 97) for w in ('a', ' the', 'é')])"
    runs = {subprocess.run([sys.executable, "-c", code], env=os.environ | {"PYTHONHASHSEED": s}, capture_output=True, text=True, check=True).stdout for s in ("0", "1")}
    assert len(runs) == 1
