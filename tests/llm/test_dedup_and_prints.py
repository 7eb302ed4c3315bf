import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerbeam.llm import multiset_hash, queries, simhash
from tests.conftest import SMALL


def plain_print(text):
    t = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
    w = [x for x in re.split("[ \t-\r]+", t) if x]
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i : i + 4]), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, prints):
    label = {}
    todo = set(range(len(ids)))
    while todo:
        group, new = set(), {todo.pop()}
        while new:
            group |= new
            todo -= new
            new = {j for i in new for j in todo if bin(prints[i] ^ prints[j]).count("1") <= 4}
        known = [ids[i] for i in group if ids[i] is not None]
        for i in group:
            label[i] = min(known) if known else None
    return [label[i] for i in range(len(ids))]


def test_near_duplicates_equal_brute_force(spark, odd):
    for docs in (odd, spark.read.parquet(f"{SMALL}/documents.parquet")):
        rows = docs.select("doc_id", "text").collect()
        prints = [plain_print(r["text"]) for r in rows]
        want = sorted(map(str, zip([r["doc_id"] for r in rows], [f"{p:016x}" for p in prints], plain_components([r["doc_id"] for r in rows], prints))))
        got = simhash.near_duplicates(docs).select("doc_id", simhash.as_hex(F.col("fp")), "component_id").collect()
        assert sorted(str(tuple(r)) for r in got) == want


def cluster(rng, n, flips):
    centre = rng.getrandbits(64)
    out = set()
    for _ in range(n):
        x = centre
        for b in rng.sample(range(64), flips):
            x ^= 1 << b
        out.add(x)
    return out


@pytest.mark.parametrize("chunk", [8, 1024])
def test_links_with_hot_groups(spark, chunk):
    """Dense clusters and random fingerprints, with groups dealt out in chunks: same components as all pairs."""
    rng = random.Random(3)
    prints = sorted(cluster(rng, 60, 2) | cluster(rng, 40, 3) | {rng.getrandbits(64) for _ in range(100)} | {0, 2**64 - 1, 2**63})
    signed = [int(np.array(p, np.uint64).view(np.int64)) for p in prints]
    df = spark.createDataFrame([(s,) for s in signed], "fp bigint")
    comps = {r["u"]: r["v"] for r in simhash.components(simhash.links(df, chunk=chunk)).collect()}
    got = [comps.get(s, s) for s in signed]
    want = plain_components(signed, prints)
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_dealt_rows_stay_flat(spark):
    """At a fixed size of groups each fingerprint is dealt out a bounded number of times, however many there are."""
    rng = random.Random(9)
    for n in (1000, 4000, 16_000):
        df = spark.createDataFrame([(rng.getrandbits(64) - (1 << 63),) for _ in range(n)], "fp bigint")
        assert 5 * n <= simhash.deal(df, chunk=1).count() <= 25 * n


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(150)], "u bigint, v bigint")
    assert {r["v"] for r in simhash.components(edges).collect()} == {0}


@pytest.mark.parametrize("pairs", [4, 1 << 18])
def test_trie_links_are_all_pairs(monkeypatch, pairs):
    monkeypatch.setattr(simhash, "PAIRS", pairs)
    rng = random.Random(5)
    keys = np.array(sorted(cluster(rng, 50, 3) | {rng.getrandbits(64) for _ in range(50)}), np.uint64)
    batches = list(simhash.trie_links(keys, np.array([[0, len(keys), 0, len(keys)]])))
    found = [(min(a, b), max(a, b)) for i, j in batches for a, b in zip(i.tolist(), j.tolist())]
    want = {(a, b) for a in range(len(keys)) for b in range(a + 1, len(keys)) if bin(int(keys[a]) ^ int(keys[b])).count("1") <= 4}
    assert set(found) == want and len(found) == len(want)
    half = len(keys) // 2
    across = [(a, b) for i, j in simhash.trie_links(keys, np.array([[0, half, half, len(keys)]])) for a, b in zip(i.tolist(), j.tolist())]
    assert set(across) == {(a, b) for a, b in want if a < half <= b}


def test_forest_merges_batches():
    batches = [(np.array([0, 4]), np.array([1, 5])), (np.array([1]), np.array([2])), (np.array([5, 2]), np.array([6, 0])), (np.array([6]), np.array([2]))]
    u, v = simhash.forest(8, batches)
    assert u.tolist() == [1, 2, 4, 5, 6] and set(v.tolist()) == {0}


def test_keep_one(spark, odd, empty):
    kept = simhash.keep_one(odd.withColumns({"_lead": F.lit(1), "_rank": F.lit(2)}))
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 5, 6, 2**60 + 1]
    assert kept.columns == [*odd.columns, "_lead", "_rank"]
    assert simhash.keep_one(empty).count() == 0 and simhash.near_duplicates(empty).count() == 0


def test_edited_texts(spark, odd):
    docs = odd.dropDuplicates(["doc_id"])
    rows = sorted(docs.collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0))
    texts = [r["text"] or "" for r in rows]
    got = {r["doc_id"]: r for r in multiset_hash.edited(docs).collect()}
    for k, r in enumerate(rows):
        q = len(texts[k]) // 4
        assert got[r["doc_id"]]["edited"] == texts[k][: len(texts[k]) - q] + texts[(k + 1) % len(rows)][:q]


def test_fingerprint_query(spark):
    rows = queries.op7_fingerprints(spark, SMALL).collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    by_print = {}
    for r in rows:
        assert by_print.setdefault(r["fingerprint"], docs[r["doc_id"]]) == docs[r["doc_id"]]
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    order = sorted(docs)
    for r in rows:
        t, following = docs[r["doc_id"]], docs[order[(order.index(r["doc_id"]) + 1) % len(order)]]
        e = t[: len(t) - len(t) // 4] + following[: len(t) // 4]
        assert r["edited_sha256"] == hashlib.sha256(e.encode()).hexdigest()
    assert np.mean([r["near_edited"] for r in rows]) > 0.6 > 0.2 > np.mean([r["near_next"] for r in rows])


def test_multiset_laws(spark):
    df = spark.createDataFrame([("a a\nb\nc", "c\nb\na a", "a a\nc", "b")], "x string, y string, z string, p string")
    fp = multiset_hash.fingerprint
    r = df.select(fp(F.col("x")).alias("x"), fp(F.col("y")).alias("y"), fp(F.col("z")).alias("z"), fp(F.col("p")).alias("p"))
    r = r.select(*"xyzp", multiset_hash.insert(F.col("z"), F.col("p")).alias("i"), multiset_hash.delete(F.col("x"), F.col("p")).alias("d")).first()
    assert r["x"] == r["y"] == r["i"] and r["d"] == r["z"] and r["x"] != r["z"]


def plain_numbers(text):
    """Paragraph count, exact lanes and sketch of a text, by loops; Spark's xxhash64 chains its arguments as seeds."""
    chain = lambda h, raw: xxhash.xxh64_intdigest(raw, h)
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    seeds = [chain(42, j.to_bytes(4, "little")) for j in range(multiset_hash.EXACT)]
    paragraphs = text.split("\n")
    lanes = [sum(chain(s, p.encode()) & multiset_hash.MASK for p in paragraphs) & multiset_hash.MASK for s in seeds]
    before, behind = (re.compile(re.sub(r"\\x\{10FFFF\}", "\U0010ffff", x)) for x in (multiset_hash.BEFORE, multiset_hash.BEHIND))
    cells = [0] * multiset_hash.CELLS
    for p in paragraphs:
        at = 0
        while at < len(p):
            end = at
            while end < len(p) and end - at < multiset_hash.LONGEST and not (end > at and before.match(p[end - 1]) and behind.match(p[end])):
                end += 1
            h = signed(chain(42, p[at:end].encode()))
            cells[h % multiset_hash.CELLS] += 1
            at = end
    return [len(paragraphs), *lanes, *cells]


def likeness(spark, a, b):
    r = spark.createDataFrame([(a, b)], "a string, b string").select(*(multiset_hash.fingerprint(F.col(c)).alias(c) for c in "ab"))
    return r.select("a", "b", multiset_hash.likeness(F.col("a"), F.col("b")).alias("x")).first()


def test_fingerprints_by_loops(spark, odd):
    texts = [r["text"] for r in odd.collect()] + [r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    texts += ["héllo wörld ça va où ça ira", "x" * 1000 + " r", "的是" * 40]
    frame = spark.createDataFrame([(t,) for t in texts], "t string").select("t", multiset_hash.fingerprint(F.col("t")).alias("fp"))
    for r in frame.collect():
        assert r["fp"] == plain_numbers(r["t"] or "")


def test_likeness_by_loops(spark):
    texts = [r["text"] or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").limit(12).collect()]
    pairs = [(t, t[: len(t) // 2] + u[len(u) // 2 :]) for t, u in zip(texts, texts[1:] + texts[:1])]
    fp = multiset_hash.fingerprint
    got = spark.createDataFrame(pairs, "a string, b string").select("a", "b", multiset_hash.likeness(fp(F.col("a")), fp(F.col("b"))).alias("x")).collect()
    for a, b, likeness_ in got:
        x, y = (v - v.mean() for v in (np.array(plain_numbers(t)[1 + multiset_hash.EXACT :], float) for t in (a, b)))
        want = 1.0 if a == b else max(0.0, min(1.0, x @ y / np.sqrt((x @ x) * (y @ y)))) if x.any() and y.any() else 0.0
        assert np.isclose(likeness_, want)


def test_repeats_never_wrap_and_shifts_are_borne(spark):
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.randrange(2, 9))) for _ in range(4000)]
    r = likeness(spark, "a", "a" + "\n" * 16_384)
    assert r["a"] != r["b"]
    r = likeness(spark, "aaaa\n" * 16_384, "bbbb\n" * 16_384)
    assert r["a"] != r["b"] and r["x"] < 0.9
    text = " ".join(words[:450])
    assert likeness(spark, text, "x" + text)["x"] > 0.8 and likeness(spark, text, text[:1000] + "y" + text[1000:])["x"] > 0.8
    same, other = " ".join(words[:2000] * 10), " ".join(words[2000:2900] * 10)
    assert 0.5 < likeness(spark, same + " " + other, same + " " + " ".join(words[3000:3900] * 10))["x"] < 0.9


def test_empty_tables(spark, empty):
    assert multiset_hash.edited(empty).count() == 0


def test_one_document_is_next_to_itself(spark):
    df = spark.createDataFrame([(7, "abcdefgh")], "doc_id bigint, text string")
    assert multiset_hash.edited(df).first()["edited"] == "abcdefab"


def test_repeated_ids_are_edited_row_by_row(spark, odd):
    """Rows of one id all count; the next document of an id is the row of the next larger one whose beginning sorts first."""
    more = odd.unionByName(spark.createDataFrame([(2, "zzzz"), (2, "yyyy")], "doc_id bigint, text string"), allowMissingColumns=True)
    rows = multiset_hash.edited(more).collect()
    assert len(rows) == more.count() == 11
    assert {r["edited"] for r in rows if r["doc_id"] == 1} == {"a b c d e f g h i "}
    assert all(r["fp"] == rows[k]["fp"] for r in rows for k in range(len(rows)) if r["text"] == rows[k]["text"])
