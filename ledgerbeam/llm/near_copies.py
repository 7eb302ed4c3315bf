"""Near copies by SimHash: a trie self-join with a wide budget, each link checked exactly.

Texts are lower-cased in A-Z and split into words; those that are equal then are
one node, keyed by its XXH64 value.  A node's shingles are its runs of five
words; a shorter text is one shingle, a text without words has none.  Two nodes
are linked if the Jaccard similarity of their sets of shingles is 0.8 or more.

Fingerprints of such a pair differ in a share of arccos(8/9) / pi of their bits
at most, 9.7 of 64 with a standard deviation of 2.9.  A budget of ``BUDGET``
bits so misses one pair in a million right at the limit and fewer above.  Blocks
of bits can't group texts for so wide a budget, since groups would be a fixed
share of all texts.  Groups are therefore keyed by the least hashes of the
shingles: ``BANDS`` keys of ``ROWS`` least hashes each, of which a similar pair
shares none with a chance of (1 - 0.8 ** ROWS) ** BANDS, again under one in a
million.  Within a group the tries of the fingerprints are traversed against
each other as in the module ``simhash``.

Large groups.  Each node is first checked against ``HEADS`` members of its
groups, those whose groups are largest, which are the likeliest sources of the
others; the components found so far are labelled.  Then the tries of all groups
that hold several labels are joined, for pairs of different labels only.  A pair
is passed on if a sketch of both sets (of each of ``BINS`` ranges of hashes,
four bits of the least hash there) doesn't tell by five standard deviations that
the similarity is below 0.8, and only from the first group that both are in.  So a dense group of near copies costs about its
size, and no link between components is lost.  Where more than ``DENSE`` pairs a node are passed on, they are checked in
rounds, those with the likest sketches first, and what a round has joined drops out of the next ones.  Pairs that are below 0.8
by less than the sketch tells, and join nothing, are all checked.

A group of more than ``CHUNK`` nodes is dealt out as pairs of chunks: those of
its commonest label and those of other ones.  Chunks of the commonest label
never meet, so a group that the first step has joined costs its size times that
of the rest.

A group of more than ``RAREST`` chunks is not dealt out at all, as its rows would
grow with the square of its size.  Its nodes are keyed again, by single least
hashes: all ``BANDS * ROWS`` of them are a set of which a similar pair shares
``BANDS * ROWS - RAREST + 1``, but for one pair in a million, so it shares one
of the ``RAREST`` rarest of either side.  A node is dealt out that many times,
however large the group is.  What makes unlike texts meet, a passage that many
have, makes common hashes; the rarest ones they don't share.

Nulls: a null text has no words; all texts without words are one node.  Ids play
no part in the links.  Shingles are compared by their 64-bit hashes.  Empty tables give empty results.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import compact, counted, cut, pieces, row_key
from .simhash import CHUNK, GROUP, _ranges, by_groups, components, joined, lead, trie_links, whole

SEED = 42
SHINGLE = 5
BUDGET = 24
BANDS, ROWS = 20, 3
BITS = 9
BINS = 1 << BITS
HEADS = 3
#: Pairs a node that are checked at once; more are checked in rounds, an eighth of that first, then eight times as many each time.
DENSE = 32
#: Least hashes of which two sets of BANDS * ROWS share one if they share all but RAREST - 1.
RAREST = 29
#: Shingles that are hashed on at once.
BLOCK = 8192
#: Small rows that a text counts as.
TEXT = 16
#: Shingles of texts that a checking task holds.
HELD = 8_000_000
#: Odd factors, one for each least hash.
FACTORS = np.random.default_rng(SEED).integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
#: Odd factors, one for each place in a shingle.
PLACES = np.random.default_rng(SEED + 1).integers(0, 1 << 63, SHINGLE, np.uint64) * np.uint64(2) + np.uint64(1)
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


def plain(text: str | None) -> bytes:
    """The text in lower case (A-Z), its words one space apart."""
    return b" ".join((text or "").encode("utf-8", "replace").lower().split())


def shingles(joined: bytes) -> np.ndarray:
    """The hashes of a plain text's shingles, repeats included: sums of the words' hashes, each times the factor of its place, mixed."""
    from xxhash import xxh64_digest

    if not joined:
        return np.zeros(0, np.uint64)
    w = np.frombuffer(b"".join([xxh64_digest(x, SEED) for x in joined.split(b" ")]), ">u8").astype(np.uint64)
    k = min(len(w), SHINGLE)
    n = len(w) - k + 1
    out = np.zeros(n, np.uint64)
    for place in range(k):
        out += w[place : place + n] * PLACES[place]
    out ^= out >> np.uint64(31)
    out *= MIX[0]
    return out ^ (out >> np.uint64(32))


def sketch(h: np.ndarray) -> bytes:
    """Of each range of hashes, half a byte: 1 to 15 by the least of h there, which is sorted, or 0 if there is none."""
    at = (h >> np.uint64(64 - BITS)).astype(np.int64)
    first = np.flatnonzero(np.diff(at, prepend=-1))
    out = np.zeros(BINS, np.uint8)
    out[at[first]] = (h[first] & np.uint64(0xFFFFFFFF)) % np.uint64(15) + np.uint64(1)
    return (out[0::2] << 4 | out[1::2]).astype(np.uint8).tobytes()


def likeness(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
    """What the similarity of pairs can be by their sketches, rows of 64-bit numbers; n: sizes of both sets together."""

    def used(x: np.ndarray) -> np.ndarray:  # a bit for each half byte that isn't 0
        x = x | x >> np.uint64(2)
        return (x | x >> np.uint64(1)) & np.uint64(0x1111111111111111)

    count = lambda x: np.bitwise_count(x).sum(1, dtype=np.int64)
    in_a, in_b = used(a), used(b)
    both = in_a & in_b
    some, shared = count(in_a | in_b), count(both)
    # two different least hashes have equal values once in 15
    equal = (15 * count(both & ~used(a ^ b)) - shared) / 14
    seen = np.maximum(some, 1)
    spread = 0.16 / seen * np.maximum(0, 1 - some * 1.8 / np.maximum(n, 1)) + np.maximum(shared - equal, 0) / 14 / seen**2
    return equal / seen + 5 * np.sqrt(spread) + 0.01


def possible(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Whether pairs of sketches leave a similarity of 0.8 possible."""
    return likeness(a, b, n) >= 0.8


def least_hashes(hashes: np.ndarray) -> np.ndarray:
    """The least value of the shingles' hashes under each of the factors."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), BLOCK):
        least = np.minimum(least, np.multiply.outer(FACTORS, hashes[at : at + BLOCK]).min(1))
    return least


def elements(joined: bytes) -> list[int]:
    """The least hashes of a plain text, each mixed with the number of its factor."""
    mixed = (least_hashes(shingles(joined)) ^ np.arange(BANDS * ROWS, dtype=np.uint64)) * MIX[0]
    return (mixed ^ mixed >> np.uint64(29)).view(np.int64).tolist()


def features(joined: bytes) -> tuple[int, int, list[int], bytes]:
    """The number of distinct shingles of a plain text, its fingerprint as a signed number, its group keys and its sketch."""
    hashes = shingles(joined)
    n = len(hashes)
    if not n:
        return 0, 0, [], sketch(hashes)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, BLOCK):
        counts += np.unpackbits(hashes[at : at + BLOCK].view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.uint16)
    bits = np.packbits(2 * counts > n)
    rows = least_hashes(hashes).reshape(BANDS, ROWS)
    keys = np.arange(BANDS, dtype=np.uint64)
    for k in range(ROWS):
        keys = (keys ^ rows[:, k]) * MIX[k]
        keys ^= keys >> np.uint64(29)
    whole_ = np.unique(hashes)
    return len(whole_), int.from_bytes(bits.tobytes(), "big", signed=True), keys.view(np.int64).tolist(), sketch(whole_)


def distinct(text: str | None) -> np.ndarray:
    """The distinct shingles' hashes of a text, sorted."""
    return np.unique(shingles(plain(text)))


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sets of shingles have Jaccard similarity 0.8 or more."""
    if 5 * min(len(x), len(y)) < 4 * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both > 0 and 5 * both >= 4 * (len(x) + len(y) - both)


ROWS_SCHEMA = "null boolean, num bigint, text bigint, node bigint, n bigint, fp bigint, keys array<bigint>, sketch binary"


def rows_of(docs: DataFrame) -> DataFrame:
    """A row for each of docs, stored: what tells it (see common.row_key), its node and the node's features."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from xxhash import xxh64_intdigest

        for pdf in batches:
            joined = [plain(x if isinstance(x, str) else None) for x in pdf["whole"]]
            n, fp, keys, sketches = zip(*map(features, joined), strict=True) if len(pdf) else ((), (), (), ())
            node = np.array([xxh64_intdigest(x, SEED) for x in joined], np.uint64).view(np.int64)
            yield pd.DataFrame({"null": pdf["null"], "num": pdf["num"], "text": pdf["text"], "node": node, "n": n, "fp": fp, "keys": list(keys), "sketch": sketches})

    key = [c.alias(name) for c, name in zip(row_key(), ("null", "num", "text"), strict=True)]
    return cut(docs.select(*key, F.col("text").alias("whole")).mapInPandas(run, ROWS_SCHEMA))


def _near(a: str, b: str) -> Column:
    """Whether rows a and b can be similar: sizes and fingerprints."""
    x, y = (lambda c: F.col(f"{a}.{c}")), (lambda c: F.col(f"{b}.{c}"))
    return (5 * F.least(x("n"), y("n")) >= 4 * F.greatest(x("n"), y("n"))) & (F.bit_count(x("fp").bitwiseXOR(y("fp"))) <= BUDGET)


def _checked(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs u > v whose texts are similar."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: OrderedDict[int, np.ndarray] = OrderedDict()
        held = 0

        def of(node: int, text: str) -> np.ndarray:
            nonlocal held
            if node in kept:
                kept.move_to_end(node)
                return kept[node]
            kept[node] = out = distinct(text)
            held += len(out)
            while held > HELD and len(kept) > 1:
                held -= len(kept.popitem(last=False)[1])
            return out

        for pdf in batches:
            ok = [similar(of(u, a), of(v, b)) for u, v, a, b in zip(pdf["u"], pdf["v"], pdf["a"], pdf["b"], strict=True)]
            yield pdf.loc[ok, ["u", "v"]]

    full = pairs.join(texts.select(F.col("node").alias("u"), F.col("whole").alias("a")), "u")
    full = full.join(texts.select(F.col("node").alias("v"), F.col("whole").alias("b")), "v").select("u", "v", "a", "b")
    return compact(full.mapInPandas(run, "u bigint, v bigint"))


def _dealt(labelled: DataFrame, chunk: int) -> DataFrame:
    """Rows of labelled (level, key, node, label) with GROUP and side, in which all nodes of a key with different labels meet."""
    zero = F.lit(0).cast("bigint")
    rows = labelled.select("level", zero.alias("path"), F.col("key").alias("v"), "node", "label")
    sizes = rows.groupBy("level", "v", "label").agg(F.count("*").alias("size"))
    # chunks 0 to major - 1 hold the commonest label, the minor ones the others
    by = sizes.groupBy("level", "v").agg(F.max(F.struct("size", "label")).alias("most"), F.sum("size").alias("all")).where(F.col("all") > chunk)
    pieces = lambda n: F.greatest(F.ceil(n / chunk), F.lit(1)).cast("bigint")
    by = compact(by.select("level", "v", F.col("most.label").alias("common"), pieces(F.col("most.size")).alias("major"), pieces(F.col("all") - F.col("most.size")).alias("minor")))
    if by.isEmpty():
        return whole(rows)
    large = rows.join(by, ["level", "v"])
    is_major = F.col("label") == F.col("common")
    place = F.xxhash64("node")
    own = F.when(is_major, F.pmod(place, F.col("major"))).otherwise(F.col("major") + F.pmod(place, F.col("minor")))
    last = F.col("major") + F.col("minor") - 1
    others = F.sequence(F.when(is_major, F.col("major")).otherwise(zero), last)
    large = large.withColumn("own", own).withColumn("other", F.explode(others))
    large = large.withColumns({"ci": F.least("own", "other"), "cj": F.greatest("own", "other"), "side": (F.col("own") > F.col("other")).cast("int")})
    columns = [*rows.columns, "ci", "cj", "side"]
    return whole(rows.join(by, ["level", "v"], "left_anti")).select(columns).unionByName(large.select(columns))


def _mixed(labelled: DataFrame) -> DataFrame:
    """The rows of keys whose nodes have several labels, stored."""
    several = compact(labelled.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("key"))
    return compact(labelled.join(several, "key"))


def _again(labelled: DataFrame, texts: DataFrame, chunk: int) -> DataFrame:
    """labelled (key, node, label) with level: 0, or 1 for the nodes of huge groups, which have their rarest least hashes as keys."""
    plain_ = labelled.withColumn("level", F.lit(0))
    huge = compact(labelled.groupBy("key").agg(F.count("*").alias("size")).where(F.col("size") > RAREST * chunk).select("key"))
    if huge.isEmpty():
        return plain_
    nodes = compact(labelled.join(huge, "key", "left_semi").select("node", "label").distinct())

    @F.pandas_udf("array<bigint>")
    def of(text: pd.Series) -> pd.Series:
        return pd.Series([elements(plain(x)) for x in text])

    # at most BANDS * ROWS small rows a node
    spread = compact(texts.join(nodes, "node").select("node", "label", F.explode(of("whole")).alias("key")))
    counts = compact(spread.groupBy("key").agg(F.count("*").alias("size")))
    rank = F.row_number().over(Window.partitionBy("node").orderBy("size", "key"))
    rare = spread.join(counts, "key").withColumn("rank", rank).where((F.col("rank") <= RAREST) & (F.col("size") > 1))
    found = _mixed(rare.select("key", "node", "label"))
    return plain_.join(huge, "key", "left_anti").select("key", "node", "label", "level").unionByName(found.select("key", "node", "label", F.lit(1).alias("level")))


def _across(labelled: DataFrame, nodes: DataFrame, texts: DataFrame, chunk: int) -> DataFrame:
    """Pairs u > v of nodes of one group that have different labels and can be similar, with their likeness; nodes: node, n, fp, keys and sketch.

    A pair that meets in several groups shows in that of the first key both have, so no pair comes twice.
    """

    def traverse(pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
        order, fp, roots = _ranges(pdf)
        node, n, label, group, level = (pdf[c].to_numpy(np.int64)[order] for c in ("node", "n", "label", "v", "level"))
        keys = np.stack(pdf["keys"].to_numpy())[order]
        words = np.frombuffer(b"".join(pdf["sketch"]), np.uint64).reshape(len(pdf), -1)[order]
        for i, j in joined(trie_links(fp, roots, BUDGET, label)):
            near = 5 * np.minimum(n[i], n[j]) >= 4 * np.maximum(n[i], n[j])
            i, j = i[near], j[near]
            for k in range(0, len(i), BLOCK):
                x, y = i[k : k + BLOCK], j[k : k + BLOCK]
                shared = keys[x] == keys[y]
                # pairs of huge groups may show once for each least hash that they share
                first = (keys[x, shared.argmax(1)] == group[x]) | (level[x] == 1)
                x, y = x[first], y[first]
                like = likeness(words[x], words[y], n[x] + n[y])
                ok = like >= 0.8
                a, b = node[x[ok]], node[y[ok]]
                yield pd.DataFrame({"u": np.maximum(a, b), "v": np.minimum(a, b), "like": like[ok]})

    dealt = _dealt(_again(labelled, texts, chunk), chunk).join(nodes, "node").select("node", "n", "label", "fp", "keys", "sketch", *GROUP, "side")
    return by_groups(dealt, traverse, "u bigint, v bigint, like double").groupBy("u", "v").agg(F.max("like").alias("like"))


def _joined_by(edges: DataFrame, apart: DataFrame, texts: DataFrame) -> DataFrame:
    """edges and similar pairs of apart (u, v and like, stored) that span the same components as edges and all similar ones of apart."""
    size = apart.agg(F.count("*").alias("pairs"), F.count_distinct("u").alias("nodes")).first()
    if size["pairs"] <= DENSE * size["nodes"]:
        return edges.unionByName(_checked(apart.select("u", "v"), texts))
    rank = F.row_number().over(Window.partitionBy("u").orderBy(F.desc("like"), "v"))
    rest, upto = compact(apart.select("u", "v", rank.alias("rank"))), DENSE // 8
    while not rest.isEmpty():
        edges = compact(edges.unionByName(_checked(rest.where(F.col("rank") <= upto).select("u", "v"), texts)))
        found = components(edges)
        of = lambda c: found.select(F.col("u").alias(c), F.col("v").alias(f"{c}_label"))  # noqa: B023, E731
        rest = rest.where(F.col("rank") > upto).join(of("u"), "u", "left").join(of("v"), "v", "left")
        rest = compact(rest.where(F.coalesce("u_label", "u") != F.coalesce("v_label", "v")).select("u", "v", "rank"))
        upto *= 8
    return edges


def labels(rows: DataFrame, docs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """u and the smallest node v of its component, for every u that isn't that smallest; rows: rows_of(docs)."""
    row = F.struct("null", "num", "text")
    sets, n = counted(rows.groupBy("node").agg(F.first("n").alias("n"), F.first("fp").alias("fp"), F.first("keys").alias("keys"), F.first("sketch").alias("sketch"), F.min(row).alias("row")))
    spread = sets.select("node", F.explode("keys").alias("key"))
    sizes = compact(spread.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"))
    members = compact(spread.join(sizes, "key"))
    # each node against some members of its groups
    score = compact(members.groupBy("node").agg(F.sum("size").alias("score")))
    rank = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("score"), F.desc("node")))
    heads = members.select("key", "node").join(score, "node").withColumn("rank", rank).where(F.col("rank") <= HEADS)
    heads = compact(heads.select("key", "rank", F.struct("score", "node").alias("head")))
    best = members.select("key", "node").join(heads, "key").where(F.col("node") != F.col("head.node")).groupBy("node", "rank").agg(F.max("head").alias("head"))
    one = compact(score.join(sets, "node").select("node", "n", "fp", "keys", "sketch", "row"))
    few = pieces(HEADS * n)
    star = compact(best.select("node", F.col("head.node").alias("head"))).distinct().coalesce(few)
    star = star.join(one.select(F.col("node"), "n", "fp"), "node").coalesce(few).alias("a").join(one.select("node", "n", "fp").alias("b"), F.col("a.head") == F.col("b.node")).where(_near("a", "b"))
    star = compact(star.select(F.greatest("a.node", "b.node").alias("u"), F.least("a.node", "b.node").alias("v")).coalesce(few).distinct())
    # the text of one row of each node that any other can be near to
    wanted = one.select(F.col("row.null").alias("null"), F.col("row.num").alias("num"), F.col("row.text").alias("hash"), "node")
    whole_texts = docs.select(*(c.alias(name) for c, name in zip(row_key(), ("null", "num", "hash"), strict=True)), F.col("text").alias("whole"))
    texts = cut(whole_texts.join(wanted, ["null", "num", "hash"]).select("node", "whole").dropDuplicates(["node"]))
    texts = texts.coalesce(pieces(TEXT * n))
    edges = _checked(star, texts)
    found = components(edges).select(F.col("u").alias("node"), F.col("v").alias("label"))
    # all pairs of a group that the stars leave apart
    one = compact(one.join(found, "node", "left").select("node", "n", "fp", "keys", "sketch", F.coalesce("label", "node").alias("label")))
    labelled = compact(members.select("key", "node").join(one.select("node", "label"), "node"))
    apart = compact(_across(_mixed(labelled), one.drop("label"), texts, chunk))
    return components(_joined_by(edges, apart, texts))


def keep_one(docs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """One row of each component: the smallest doc_id, nulls last, then the smallest hash of the text."""
    rows = rows_of(docs)
    return lead(docs, rows, labels(rows, docs, chunk))
