import collections
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerbeam.functions import store
from ledgerbeam.llm import common, line_crf, quality_rules
from tests.conftest import SMALL


def plain(text):
    w = [x for x in re.split("[ \t-\r]+", text or "") if x]
    n = len(w)
    seen = collections.Counter(tuple(w[i : i + 5]) for i in range(n - 4))
    covered = {i + k for i in range(n - 4) if seen[tuple(w[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if re.search("[^ \t-\r]", x)]
    return n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_measures_equal_a_plain_version(spark, odd):
    for docs in (odd, spark.read.parquet(f"{SMALL}/documents.parquet")):
        for r in quality_rules.judge(docs).collect():
            assert tuple(r[c] for c in NAMES) == plain(r["text"])
            assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
            assert not (r["base_failed"] and r["kept"])


def test_overlapping_windows_and_filters(spark):
    text = " ".join("abcdefg") + " x " + " ".join("abcdefg") + " y z q " + " ".join("bcdef")
    df = quality_rules.judge(spark.createDataFrame([(1, text)], "doc_id int, text string"))
    assert df.first()["n_repeat_words"] == plain(text)[4]
    # a filter on the result is not evaluated with the expressions copied into it
    assert df.where("kept or n_words > 3").count() == 1


def test_clean_texts_of_other_scripts_and_great_length_stay(spark):
    russian = " ".join(f"слово{k} и" for k in range(200))
    rng = np.random.default_rng(2)
    long = " ".join(f"the w{k}" for k in rng.integers(0, 9000, 200_000))
    poor = " ".join(f"the w{k}" for k in rng.integers(0, 300, 20_000))
    odd = " ".join(f"qx{k} 123" for k in range(200))
    df = spark.createDataFrame([(1, russian), (2, long), (3, poor), (4, odd)], "doc_id int, text string")
    assert {r["doc_id"]: r["kept"] for r in quality_rules.judge(df).collect()} == {1: True, 2: True, 3: False, 4: False}


def test_no_python_runs(spark, odd):
    plan = quality_rules.judge(odd)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_clashing_and_extra_columns(spark, odd, empty):
    df = odd.withColumns({"n_words": F.lit("old"), "Kept": F.lit(7), "_w": F.lit(1), "_h": F.lit(1), "_lines": F.lit(1), "_measures": F.lit(1)})
    out = quality_rules.judge(df)
    assert out.columns.count("n_words") == 1 and out.where("doc_id = 1").first()["n_words"] == 12 and out.first()["_w"] == 1
    assert quality_rules.judge(empty).count() == 0


class FarSession:
    """As much of a session on a cluster as shared_dir sees, with spark.checkpoint.dir unset."""

    class conf:
        get = staticmethod(lambda key, default=None: default)

    class sparkContext:
        master, getCheckpointDir = "spark://host:7077", staticmethod(lambda: None)


@pytest.mark.parametrize("shared_dir", [common.shared_dir, store.shared_dir])
@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "local-cluster[3,2,1000]"])
def test_no_local_folder_on_a_cluster(monkeypatch, shared_dir, master):
    monkeypatch.setattr(FarSession.sparkContext, "master", master)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(FarSession)


def test_rules_table():
    rules = (quality_rules.Rule("a", 1, 2, 0), quality_rules.Rule("b", None, 5, 10))
    assert "n_words" in str(quality_rules.compile_rules(rules))


def brute_marginals(emit, trans):
    n, total, good = len(emit), 0.0, np.zeros(len(emit))
    for states in np.ndindex(*[2] * n):
        p = np.exp(sum(emit[i] * s for i, s in enumerate(states)) + sum(trans[a, b] for a, b in zip(states, states[1:])))
        total += p
        good += p * np.array(states)
    return good / total, np.log(total)


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(1)
    counts, trans = np.array([3, 0, 1, 5, 2]), rng.normal(size=(2, 2))
    emit = rng.normal(size=counts.sum())
    good, pairs, norm = line_crf.marginals(emit, counts, trans)
    at = 0
    for k, n in enumerate(counts):
        if n:
            want, z = brute_marginals(emit[at : at + n], trans)
            assert np.allclose(good[at : at + n], want) and np.isclose(norm[k], z)
        at += n
    assert np.isclose(pairs.sum(), sum(max(n - 1, 0) for n in counts))


def test_long_chains_equal_a_plain_loop():
    """Chains of several segments give what one pass from line to line gives."""
    rng = np.random.default_rng(5)
    counts, trans = np.array([1500, 2, 0, line_crf.SEGMENT, line_crf.SEGMENT + 1, 1]), rng.normal(size=(2, 2))
    emit = rng.normal(size=counts.sum())
    good, _, norm = line_crf.marginals(emit, counts, trans)
    at = 0
    for k, n in enumerate(counts):
        e = np.stack([np.zeros(n), emit[at : at + n]], 1)
        a, b = np.zeros((n, 2)), np.zeros((n, 2))
        for t in range(n):
            a[t] = e[t] + (np.logaddexp(a[t - 1, 0] + trans[0], a[t - 1, 1] + trans[1]) if t else 0)
        for t in range(n - 2, -1, -1):
            b[t] = [np.logaddexp(*(trans[s] + e[t + 1] + b[t + 1])) for s in (0, 1)]
        if n:
            z = np.logaddexp(*a[-1])
            assert np.allclose(good[at : at + n], np.exp(a[:, 1] + b[:, 1] - z)) and np.isclose(norm[k], z)
        at += n


def plain_features(line, seen, lines):
    """The features of one line by loops."""
    w, raw = line.split(), line.encode()
    n = len(w)
    hits = lambda chars: sum(c in chars.encode() for c in raw)
    low = min(1, n / 30)
    return [
        hits("#*$%&<>@^~=_{}[]\\/") / n, hits("ABCDEFGHIJKLMNOPQRSTUVWXYZ") / len(raw), hits("0123456789") / len(raw), hits("!") / n, hits("|") / n, len(set(w)) / n * low + 1 - low,
        sum(x == y for x, y in zip(w, w[1:])) / n, float(line in seen), len(set(zip(w, w[1:]))) / max(1, n - 1), np.log1p(len(raw)), np.log1p(lines), min(len(raw) / n, 40),
    ]


def test_scores_by_loops():
    """Features, neighbours, marginals by enumeration, weights by length: the whole score of a text."""
    rng = np.random.default_rng(8)
    wide = 3 * line_crf.OWN
    model = line_crf.Model(rng.normal(size=wide), rng.uniform(1, 3, wide), rng.normal(size=wide + 1), rng.normal(size=(2, 2)), 1.7, -0.3)
    texts = ["One line of text!", "a b c\n\n  \na b c\nÜber 99 | x x", "#!$ %%\nWORDS and words\nwords", None, " \n"]
    for text, got in zip(texts, line_crf.scores(model, texts)):
        lines, seen, own = [x for x in (text or "").split("\n") if x.strip()], set(), []
        for x in lines:
            own.append(plain_features(x, seen, len(lines)))
            seen.add(x)
        if not lines:
            assert got == line_crf.EMPTY_SCORE
            continue
        rows = [own[k] + own[max(0, k - 1)] + own[min(len(own) - 1, k + 1)] for k in range(len(own))]
        emit = ((np.array(rows) - model.mean) / model.sd) @ model.weights[:-1] + model.weights[-1]
        good, _ = brute_marginals(emit, model.trans)
        raw = np.average(good, weights=[len(x.encode()) for x in lines])
        raw = min(max(raw, 1e-4), 1 - 1e-4)
        assert np.isclose(got, 1 / (1 + np.exp(-(model.slope * np.log(raw / (1 - raw)) + model.offset))))


def test_sample_is_bounded_by_lines(spark):
    """Documents come whole or not at all; a null id is in no sample and not held out."""
    docs = spark.createDataFrame([(k, "good words here\n" * (1 + 400 * (k == 3))) for k in range(40)] + [(None, "x")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id bigint, quality int")
    assert line_crf.train(docs, labels, lines=80) is not None and line_crf.train(docs, labels, lines=4) is None
    assert docs.select(line_crf.held_out(F.col("doc_id")).alias("h")).where("h is null").count() == 0


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    out = line_crf.score(docs.select("doc_id", "text"), line_crf.train(docs, labels)).withColumn("held_out", line_crf.held_out(F.col("doc_id")))
    rows = out.join(labels, "doc_id").where("held_out").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert sum(r["predicted"] == r["quality"] for r in rows) / len(rows) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)


def test_classifier_edges(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1, 0), (5, 0, 0), (None, 1, 0), (6, None, 0)], "doc_id bigint, quality int, toxic int")
    model = line_crf.train(odd, labels)
    out = line_crf.score(odd.withColumn("Score", F.lit("x")), model)
    assert out.count() == 9 and out.where("score is null or score < 0 or score > 1").count() == 0
    assert out.where("doc_id in (2, 3, 4) and predicted = 0").count() == 3
    assert line_crf.score(empty, model).count() == 0
    assert line_crf.train(odd, labels.where("false")) is None
    assert line_crf.score(odd, None).where("doc_id = 1").first()["score"] == 0.5
