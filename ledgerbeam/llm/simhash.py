"""SimHash near-duplicates by a binary trie self-join.

Fingerprints.  The text is lower-cased in A-Z, split into words and read as
word shingles, repeats included; a bit of the 64 is set if it is set in over
half of the shingles' XXH64 values.  A text shorter than a shingle is one
shingle, a text without words has fingerprint zero.

Links.  Equal fingerprints are merged first, so copies cost nothing later.
Two fingerprints that differ in at most ``budget`` bits agree in at least one
of ``budget + 1`` bit blocks: each distinct fingerprint goes to one group per
block, keyed by the block's value.  Within a group the fingerprints, sorted,
form a binary trie whose nodes are ranges; node pairs are traversed together
from the root, level by level, adding up differing bits, and a pair is pruned
as soon as the budget is exceeded.  Each traversal returns a spanning forest of
its links, not all pairs.

Hot groups.  A group of more than ``CHUNK`` fingerprints is keyed again: its
other bits are cut in ``budget + 1`` blocks too, one of which must agree, so
each of its fingerprints goes to that many smaller groups, and so on for
``LEVELS`` levels.  Rows per fingerprint so grow with the logarithm of the
table.  Groups that are still hot, dense clusters, are dealt out by trie prefix:
a chunk meets only the chunks whose prefix differs in at most ``budget`` bits,
and the prefix gets longer until every chunk fits, so no task holds a group
whole and no link is lost.

Components come from alternating large-star and small-star steps on the
forests' edges, cut by checkpoints.

Nulls: a null text has no words.  Null ids belong to components as any other
row, and a component of null ids only has a null component_id.  Repeated rows
fall in one component.  Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import compact, counted, cut, free_name, pieces, row_key

SEED = 42
SHINGLE = 4
BUDGET = 4
#: Fingerprints of a group that are joined in one piece.
CHUNK = 1024
#: Levels of blocks; an agreeing pair of the last has 38 bits or so in common.
LEVELS = 3
#: Fingerprints whose tries are traversed at once.
FOREST = 16_384
#: Node pairs that advance through the tries at once.
PAIRS = 1 << 18
#: Shingles whose bits are counted at once.
BLOCK = 65_536


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint as an unsigned number."""
    import xxhash

    w = (text or "").encode("utf-8", "replace").lower().split()
    if not w:
        return 0
    joined = b" ".join(w)
    if len(w) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n, counts, digest = len(w) - shingle + 1, np.zeros(64, np.int64), xxhash.xxh64_digest
    first, last = starts[:n].tolist(), ends[shingle - 1 :].tolist()
    for at in range(0, n, BLOCK):
        raw = b"".join([digest(joined[a:b], SEED) for a, b in zip(first[at : at + BLOCK], last[at : at + BLOCK], strict=True)])
        counts += np.unpackbits(np.frombuffer(raw, np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed number, for every row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            fps = np.array([fingerprint(x if isinstance(x, str) else None, shingle) for x in pdf["text"]], np.uint64)
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "fp": fps.view(np.int64)})

    # ids travel as text: pandas would turn numbers with nulls among them to floats
    return docs.select(F.col("doc_id").cast("string"), "text").mapInPandas(run, "doc_id string, fp bigint").withColumn("doc_id", F.col("doc_id").cast("bigint"))


def trie_links(keys: np.ndarray, roots: np.ndarray, budget: int = BUDGET, label: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of the linked pairs, in batches.

    keys: unsigned fingerprints.  roots: rows (a_lo, a_hi, b_lo, b_hi) of ranges in keys, each range sorted; equal
    ranges make a self-join.  At most about ``PAIRS`` node pairs advance at once; the others wait on a stack, no more
    than a few times as many.  With labels only pairs of different ones count, and node pairs of one label are pruned;
    equal keys then give all their pairs, else a star.
    """
    changes = None if label is None else np.concatenate([[0], np.cumsum(label[1:] != label[:-1])])
    before: dict[int, np.ndarray] = {}  # of each bit: how many of the first keys have it clear

    def clear(bit: int) -> np.ndarray:
        if bit not in before:
            before[bit] = np.concatenate([[0], np.cumsum((keys >> np.uint64(bit)) & np.uint64(1) == 0)])
        return before[bit]

    stack = [(63, np.concatenate([roots.astype(np.int64).T, np.zeros((1, len(roots)), np.int64)]))]
    while stack:
        bit, front = stack.pop()
        if front.shape[1] > PAIRS:
            half = front.shape[1] // 2
            stack += [(bit, front[:, :half]), (bit, front[:, half:])]
            continue
        a0, a1, b0, b1, errors = front
        if changes is not None and len(a0):
            mixed = (label[a0] != label[b0]) | (changes[a0] != changes[a1 - 1]) | (changes[b0] != changes[b1 - 1])
            a0, a1, b0, b1, errors = (x[mixed] for x in (a0, a1, b0, b1, errors))
        if bit < 0 and label is not None:
            for p0, p1, q0, q1 in zip(a0, a1, b0, b1, strict=True):
                for p in range(p0, p1):
                    j = np.arange(q0 if p0 != q0 else p + 1, q1)
                    j = j[label[j] != label[p]]
                    yield np.full(len(j), p), j
            continue
        if bit < 0:  # equal keys: the ranges' full product, by a star
            for p0, p1, q0, q1 in zip(a0, a1, b0, b1, strict=True):
                yield np.concatenate([np.arange(p0, p1), np.full(q1 - q0, p0)]), np.concatenate([np.full(p1 - p0, q0), np.arange(q0, q1)])
            continue
        own = (a0 == b0) & (a1 == b1)
        leaf = (a1 - a0 == 1) & (b1 - b0 == 1) & ~own  # pairs of single keys need no further levels
        if leaf.any():
            i, j = a0[leaf], b0[leaf]
            near = np.bitwise_count(keys[i] ^ keys[j]) <= budget
            if label is not None:
                near &= label[i] != label[j]
            yield i[near], j[near]
            a0, a1, b0, b1, errors, own = (x[~leaf] for x in (a0, a1, b0, b1, errors, own))
        if not len(a0):
            continue
        zeros = clear(bit)
        am, bm = a0 + zeros[a1] - zeros[a0], b0 + zeros[b1] - zeros[b0]
        parts = []
        for x0, x1, y0, y1, more, mirror in (
            (a0, am, b0, bm, 0, False),
            (am, a1, bm, b1, 0, False),
            (a0, am, bm, b1, 1, False),
            (am, a1, b0, bm, 1, True),  # in a self-join the mirror of the pair before
        ):
            ok = (x0 < x1) & (y0 < y1) & (errors + more <= budget)
            ok &= ~own if mirror else ~(own & (x1 - x0 < 2)) if not more else True
            parts.append(np.stack([x0[ok], x1[ok], y0[ok], y1[ok], errors[ok] + more]))
        stack.append((bit - 1, np.concatenate(parts, 1)))


def joined(links: Iterable[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The same links in fewer batches."""
    parts, held = [], 0
    for link in links:
        parts.append(link)
        held += len(link[0])
        if held >= PAIRS or len(parts) >= PAIRS:
            yield tuple(np.concatenate(x) for x in zip(*parts, strict=True))
            parts, held = [], 0
    if parts:
        yield tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def forest(n: int, links: Iterable[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the graph on 0..n-1: each position that isn't the first of its component, and that first.

    links come in batches, which are merged to the components one by one and not kept.
    """
    label = np.arange(n)
    for i, j in links:
        i, j = label[i], label[j]
        i, j = i[i != j], j[i != j]
        if not len(i):
            continue
        root = np.arange(n)
        while True:
            old = root.copy()
            np.minimum.at(root, i, root[j])
            np.minimum.at(root, j, root[i])
            root = root[root]
            if np.array_equal(old, root):
                break
        label = root[label]
    moved = np.flatnonzero(label != np.arange(n))
    return moved, label[moved]


#: Of a dealt row: its group, the pair of chunks (ci = cj: one chunk with itself) and which of the two it is in.
GROUP = ["level", "path", "v", "ci", "cj"]


def _ranges(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order of pdf's rows by group, side and fp, the sorted fingerprints, and the roots of the groups' tries."""
    fp = pdf["fp"].to_numpy(np.int64).view(np.uint64)
    side = pdf["side"].to_numpy(np.int64)
    group = np.cumsum(np.concatenate([[0], (np.diff(pdf[GROUP].to_numpy(np.int64), axis=0) != 0).any(1)]))
    order = np.lexsort((fp, side, group))
    fp, side, group = fp[order], side[order], group[order]
    ids = np.arange(group[-1] + 1)
    lo, hi = np.searchsorted(group, ids, "left"), np.searchsorted(group, ids, "right")
    mid = lo + np.bincount(group, side == 0, len(ids)).astype(np.int64)
    pair = pdf["ci"].to_numpy(np.int64)[order][lo] != pdf["cj"].to_numpy(np.int64)[order][lo]
    roots = np.stack([lo, np.where(pair, mid, hi), np.where(pair, mid, lo), hi], 1)
    return order, fp, roots[(roots[:, 0] < roots[:, 1]) & (roots[:, 2] < roots[:, 3])]


def _traverse(pdf: pd.DataFrame, budget: int) -> Iterator[pd.DataFrame]:
    """The forest of all groups in pdf, whose rows lie sorted by group."""
    _, fp, roots = _ranges(pdf)
    u, v = forest(len(fp), trie_links(fp, roots, budget))
    # one link may show in several groups of the batch
    signed = fp.view(np.int64)
    a, b = signed[u], signed[v]
    yield pd.DataFrame({"u": np.maximum(a, b), "v": np.minimum(a, b)}).drop_duplicates()


def by_groups(dealt: DataFrame, traverse, schema: str) -> DataFrame:
    """What traverse yields of dealt rows, some whole groups at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for pdf in batches:
            rest = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            if len(rest) < FOREST:
                continue
            # all but the last group are whole
            last = rest[GROUP].iloc[-1]
            open_ = (rest[GROUP] == last).all(axis=1).to_numpy()
            if not open_.all():
                yield from traverse(rest[~open_].reset_index(drop=True))
                rest = rest[open_].reset_index(drop=True)
        if rest is not None and len(rest):
            yield from traverse(rest)

    # by a stated number, which Spark doesn't lower for small rows that are much work
    tasks = int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(tasks, *GROUP).sortWithinPartitions(*GROUP).mapInPandas(run, schema)


def path_bits(level: int, path: int, width: int) -> tuple[list[int], list[int]]:
    """The bits that agree in the groups of a path, and the other ones from the top; a path lists the block of each level, base width."""
    free, fixed = list(range(63, -1, -1)), []
    for k in range(level, -1, -1):
        b = path // width**k % width
        block = free[len(free) * b // width : len(free) * (b + 1) // width]
        fixed += block
        free = [x for x in free if x not in set(block)]
    return fixed, free


def _signed(bits) -> int:
    n = sum(1 << b for b in bits)
    return n - (1 << 64) if n >> 63 else n


def whole(groups: DataFrame) -> DataFrame:
    """Rows of groups as one chunk each."""
    zero = F.lit(0).cast("bigint")
    return groups.withColumns({"ci": zero, "cj": zero, "side": F.lit(0)})


def by_prefix(hot: DataFrame, bits: dict[int, list[int]], budget: int, chunk: int) -> DataFrame:
    """Rows of hot groups dealt out as pairs of chunks; bits: of each path, those that may differ in its groups.

    The lists of prefixes that are broadcast hold, of each path, the sets of at most budget bits out of d, where d grows
    with the logarithm of the largest group.
    """
    d, most = 0, max(map(len, bits.values()))
    while True:
        d = min(d + 3, most)
        masks = [(p, _signed(b[:d]), [_signed(c) for k in range(min(budget, d) + 1) for c in combinations(b[:d], k)]) for p, b in bits.items()]
        lists = hot.sparkSession.createDataFrame(masks, "path bigint, prefix bigint, masks array<bigint>")
        placed = hot.join(F.broadcast(lists), "path").withColumn("own", F.col("fp").bitwiseAND(F.col("prefix")))
        if d == most or placed.groupBy("level", "path", "v", "own").count().where(F.col("count") > chunk).isEmpty():
            break
    met = placed.withColumn("mask", F.explode("masks")).withColumn("other", F.col("own").bitwiseXOR(F.col("mask")))
    met = met.withColumns({"ci": F.least("own", "other"), "cj": F.greatest("own", "other"), "side": (F.col("own") > F.col("other")).cast("int")})
    return met.drop("own", "other", "mask", "masks", "prefix")


def deal(distinct: DataFrame, budget: int = BUDGET, chunk: int = CHUNK) -> DataFrame:
    """The rows of distinct (fp) with the groups, GROUP and side, in which they meet all fingerprints near them."""
    width = budget + 1
    now, out = distinct.withColumn("path", F.lit(0).cast("bigint")), []
    for level in range(LEVELS):
        masks = F.array(*(F.lit(_signed(path_bits(level, p, width)[0])).cast("bigint") for p in range(width ** (level + 1))))
        now = now.withColumn("path", F.explode(F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda b: F.col("path") * width + b)))
        now = now.select("fp", F.lit(level).alias("level"), "path", F.col("fp").bitwiseAND(F.element_at(masks, (F.col("path") + 1).cast("int"))).alias("v"))
        # stored: joins on it then have plain exchanges on both sides, and Spark splits a hot group
        hot = cut(now.groupBy("path", "v").count().where(F.col("count") > chunk).select("path", "v"))
        if hot.isEmpty():
            return reduce(DataFrame.unionByName, [*out, whole(now)])
        out.append(whole(now.join(hot, ["path", "v"], "left_anti")))
        now = now.join(hot, ["path", "v"], "left_semi").drop("level", "v") if level < LEVELS - 1 else now.join(hot, ["path", "v"], "left_semi")
    free = {p: path_bits(LEVELS - 1, p, width)[1] for p in range(width**LEVELS)}
    columns = ["fp", *GROUP, "side"]
    return reduce(DataFrame.unionByName, [*(x.select(columns) for x in out), by_prefix(cut(now), free, budget, chunk).select(columns)])


def links(distinct: DataFrame, budget: int = BUDGET, chunk: int = CHUNK) -> DataFrame:
    """Edges u > v between the distinct fingerprints of column fp that span the same components as all links."""
    return by_groups(deal(distinct, budget, chunk), lambda pdf: _traverse(pdf, budget), "u bigint, v bigint").distinct()


def components(edges: DataFrame) -> DataFrame:
    """u and the smallest v of its component, for every u that isn't that smallest; edges have u > v."""
    edges, rows = counted(edges)
    state = None
    while True:
        # each step has about as many rows as there are edges
        few = pieces(2 * rows)
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).coalesce(few).distinct().coalesce(few)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u").coalesce(few)
        small = joined.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges, rows = counted(small.select("e.u", "e.v").where("u > v").distinct().coalesce(few))
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            return edges
        state = now


def near_duplicates(docs: DataFrame, budget: int = BUDGET, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fp and component_id (smallest doc_id reachable over links) for every row of docs."""
    fps = cut(fingerprints(docs, shingle))
    nodes = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    comps = components(links(nodes.select("fp"), budget)).select(F.col("u").alias("fp"), F.col("v").alias("label"))
    nodes = nodes.join(comps, "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    # stored, so that both sides of the join on the label are plain exchanges and a large component can be split
    nodes = cut(nodes)
    tops = cut(nodes.groupBy("label").agg(F.min("least").alias("component_id")))
    of_fp = nodes.join(tops, "label").select("fp", "component_id")
    return fps.join(of_fp, "fp", "left").select("doc_id", "fp", "component_id")


def lead(docs: DataFrame, rows: DataFrame, found: DataFrame) -> DataFrame:
    """One row of docs for each component of nodes: the smallest doc_id, nulls last, then the smallest hash of the text.

    rows: null, num, text (row_key) and node of every row of docs.  found: u and the label v of its component, for nodes
    that don't label their own.
    """
    keys = [free_name(docs, x) for x in ("_null", "_num", "_text")]
    rank = free_name(docs, "_rank")
    key = F.struct(*(F.col(c).alias(k) for c, k in zip(("null", "num", "text"), keys, strict=True)))
    best = rows.groupBy(F.col("node").alias("u")).agg(F.min(key).alias("best")).join(found, "u", "left")
    best = compact(best.groupBy(F.coalesce("v", "u").alias("label")).agg(F.min("best").alias("best")).select("best.*"))
    row = docs.withColumns(dict(zip(keys, row_key(), strict=True)))
    # rows that repeat both id and text are the only ones left to choose from
    out = row.join(best, keys, "left_semi").withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(keys[2])))
    return out.where(F.col(rank) == 1).select(*docs.columns)


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of docs that lead their components (see lead)."""

    @F.pandas_udf("bigint")
    def fp(text: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(x if isinstance(x, str) else None) for x in text], np.uint64).view(np.int64))

    rows = cut(docs.select(*(c.alias(name) for c, name in zip(row_key(), ("null", "num", "text"), strict=True)), fp("text").alias("node")))
    return lead(docs, rows, components(links(cut(rows.select(F.col("node").alias("fp")).distinct()))))


def as_hex(fp):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
