"""A Merkle manifest of a dataset: one tree for each source, and a tree of their roots.

A leaf is the hash of a row's fields.  Leaves of a source ascend by id; as long
as a tree has several nodes, every ``FANOUT`` consecutive ones become their
hash.  The tree is reduced by superblocks: nodes whose index agrees but for the
last ``LEVELS`` digits to the base ``FANOUT`` form a bucket, which
``applyInPandas`` collapses by up to ``LEVELS`` levels; the buckets' roots are
the nodes of the next round, in a table FANOUT ** LEVELS times smaller, until
each tree has one node.  On the way back each node's proof inside its bucket is
continued by its bucket's own proof, so no task sees more than one bucket, and
a source that holds a third of all rows is spread like any other.

A proof is an array of steps from the leaf upward: the digests to the left and
to the right of the node in its run, in hex and concatenated.  ``folded`` gives
the root that a leaf and a proof lead to.

Nulls: a null field counts as ``-``; rows without an id come first, rows
without a source form the first tree.  Rows with equal ids are ordered by their
leaves; equal rows are leaves of their own.  Empty texts are fields of length
0.  An empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, numbered

FANOUT = 3
LEVELS = 6
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
STEPS = "array<struct<left: string, right: string>>"


def field(value: Column) -> Column:
    """The UTF-8 byte count of a value's text, a colon and the text; - if null."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(values: list[Column]) -> Column:
    """The hash of a row of values."""
    return F.sha2(F.concat(*map(field, values)), 256)


def group_key(source: Column) -> Column:
    """Sources as texts that are never null and sort null first, then by their bytes."""
    return F.coalesce(F.concat(F.lit("1"), source.cast("string")), F.lit("0"))


def digest(parts) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _collapse(nodes: list[str], n: int) -> tuple[list[list[tuple[str, str]]], str]:
    """The steps of each node of a bucket and the bucket's root; n: nodes of the whole tree at this level."""
    steps, at, now = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    for _ in range(LEVELS):
        if n <= 1:
            break
        for i, k in enumerate(at):
            first = k - k % FANOUT
            steps[i].append(("".join(now[first:k]), "".join(now[k + 1 : first + FANOUT])))
        now = [digest(now[k : k + FANOUT]) for k in range(0, len(now), FANOUT)]
        at = [k // FANOUT for k in at]
        n = -(-n // FANOUT)
    return steps, now[0]


def _bucket() -> Column:
    return F.call_function("div", F.col("idx"), F.lit(FANOUT**LEVELS).cast("bigint")).alias("bucket")


def _root(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("idx")
    root = _collapse(rows["node"].tolist(), int(rows["n"].iloc[0]))[1]
    return pd.DataFrame({"g": [key[0]], "idx": [key[1]], "n": [-(-int(rows["n"].iloc[0]) // FANOUT**LEVELS)], "node": [root]})


def _steps(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("idx").assign(bucket=key[1])
    steps = _collapse(rows["node"].tolist(), int(rows["n"].iloc[0]))[0]
    return rows.assign(proof=[[{"left": a, "right": b} for a, b in s] for s in steps])


def reduced(nodes: DataFrame) -> list[DataFrame]:
    """nodes (g, idx, n, node) and the tables of bucket roots above it; the last has one row for each g."""
    most = nodes.agg(F.max("n").alias("n")).first()["n"] or 0
    rounds = [nodes]
    while most > 1:
        above = rounds[-1].select("g", "idx", "n", "node").groupBy("g", _bucket()).applyInPandas(_root, "g string, idx bigint, n bigint, node string")
        rounds.append(cut(above))
        most = -(-most // FANOUT**LEVELS)
    return rounds


def proven(rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The rows of rounds[0] with proof, and the other columns of tops.

    tops has a row for each g: g, the proof of its root (no steps, or those in a tree above), and what else belongs to g.
    """
    known = tops.withColumn("idx", F.lit(0).cast("bigint"))
    if len(rounds) == 1:
        return rounds[0].join(known, ["g", "idx"])
    for nodes in reversed(rounds[:-1]):
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in nodes.schema) + f", bucket bigint, proof {STEPS}"
        below = nodes.groupBy("g", _bucket()).applyInPandas(_steps, schema)
        above = known.withColumnsRenamed({"idx": "bucket", "proof": "_above"})
        known = below.join(above, ["g", "bucket"]).withColumn("proof", F.concat("proof", "_above")).drop("_above", "bucket")
        if nodes is not rounds[0]:
            known = known.drop("n", "node")
    return known


def folded(start: Column, proof: Column) -> Column:
    """The root that start leads to along proof."""
    return F.aggregate(proof, start, lambda h, step: F.sha2(F.concat(step["left"], h, step["right"]), 256))


def siblings_digest(proof: Column) -> Column:
    """The hash of all digests of a proof, from the leaf upward and from left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda step: F.concat(step["left"], step["right"])), ""), 256)


def manifest(leaves: DataFrame, source: str = "source") -> DataFrame:
    """leaves (id, source, leaf, and what is to come along) with subroot, root and proof.

    id and the columns that come along are given back as texts.
    """
    others = [c for c in leaves.columns if c != source]
    rows = leaves.select(group_key(F.col(source)).alias("g"), *(F.col(c).cast("string").alias(c) if c != "id" else F.col("id") for c in others))
    ordered = numbered(rows.withColumn("_null", F.col("id").isNotNull()), ["_null", "id", "leaf"]).drop("_null")
    trees = reduced(ordered.withColumn("id", F.col("id").cast("string")).withColumnRenamed("leaf", "node"))
    subroots = trees[-1].select(F.lit("").alias("g"), F.col("g").alias("tree"), "node")
    upper = reduced(numbered(subroots, ["tree"]))
    top = upper[-1].select("g", F.array().cast(STEPS).alias("proof"), F.col("node").alias("root"))
    tops = proven(upper, top).select(F.col("tree").alias("g"), "proof", F.col("node").alias("subroot"), "root")
    return proven(trees, tops).drop("g", "idx", "n").withColumnRenamed("node", "leaf")


def of_documents(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root and proof of each row, and tampered: the leaf of the row whose text has lost its line ends
    where the checksum of its id is even, the leaf itself elsewhere."""
    values = [F.col(c) for c in FIELDS]
    changed = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))
    leaves = docs.select(F.col("doc_id").alias("id"), "source", leaf(values).alias("leaf"), leaf([*values[:-1], changed]).alias("tampered"))
    kind = docs.schema["doc_id"].dataType
    return manifest(leaves).withColumn("doc_id", F.col("id").cast(kind)).drop("id")
