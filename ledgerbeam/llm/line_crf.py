"""Quality classifier: a linear-chain conditional random field over lines.

Every line with a visible character gets a state, good or bad.  Emissions are
linear in the line's features and in those of the lines before and after it;
one transition table couples neighbours.  Forward-backward gives each line's
marginal of being good; the marginals, weighted by the lines' lengths, average
to the document's raw quality, and a logistic curve fitted on the training rows
turns that into the score.

Training lines take the label of their document.  The fit uses at most
``MAX_PER_CLASS`` labelled documents of either class, those with the smallest
hash of doc_id, and of these the first that have ``MAX_LINES`` lines together;
one that has more than an eighth of that by itself isn't taken.  These bounds on
the sample of labelled rows are the only sampling here: a document in the sample
is used with all its lines, in one chain, and every document is scored on its
whole text.  Executors turn the sampled texts into features; only these come to
the driver, at most ``2 * MAX_LINES`` lines of ``3 * OWN`` numbers.

Chains are advanced together, line by line; one of more than ``SEGMENT`` lines is
advanced as segments side by side, whose 2 x 2 transfers are then put together,
which gives the same sums.

Nulls: a null text counts as empty.  Texts without a visible line score
``EMPTY_SCORE``.  Label rows with a null id or quality are ignored, rows with an
id that has several labels count with the smallest.  Without labelled rows of
both classes every text with a visible line scores 0.5.  Repeated rows are
scored one by one, empty tables give empty results; extra columns pass through,
and those that bear an output's name are replaced.  A null doc_id is in no
sample and not held out.
"""

from __future__ import annotations

import operator
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_PER_CLASS = 3000
MAX_LINES = 100_000
SEGMENT = 512
EMPTY_SCORE = 0.01
#: Characters of text that are turned into features at once.
CHUNK = 4_000_000

OWN = 12  # features of the line itself


class Model(NamedTuple):
    mean: np.ndarray
    sd: np.ndarray
    weights: np.ndarray  # of good against bad, by feature
    trans: np.ndarray  # 2 x 2
    slope: float
    offset: float


def _classes() -> np.ndarray:
    """For each byte: 1 if symbol, upper-case letter, digit, exclamation mark, or bar."""
    out = np.zeros((5, 256), np.float32)
    out[0, list(b"#*$%&<>@^~=_{}[]\\/")] = 1
    out[1, 65:91] = 1
    out[2, 48:58] = 1
    out[3, list(b"!")] = 1
    out[4, list(b"|")] = 1
    return out


CLASSES = _classes()


def line_features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all visible lines, their lengths in bytes, and the number of lines of each text."""
    counts, rows, sizes, blob = [], [], [], []
    for text in texts:
        seen, before = set(), len(rows)
        for line in (text or "").split("\n"):
            w = line.split()
            if not w:
                continue
            n, distinct = len(w), len(set(w))
            same = sum(map(operator.eq, w, w[1:]))
            raw = line.encode("utf-8", "replace")
            rows.append((n, distinct / n, same / n, line in seen, len({*zip(w, w[1:])}) / max(1, n - 1)))
            seen.add(line)
            sizes.append(len(raw))
            blob.append(raw)
        counts.append(len(rows) - before)
    counts = np.array(counts, np.int64)
    if not rows:
        return np.zeros((0, 3 * OWN)), np.zeros(0), counts
    size, x = np.array(sizes, np.float64), np.array(rows, np.float64)
    data, at = np.frombuffer(b"".join(blob), np.uint8), np.concatenate([[0], np.cumsum(sizes)[:-1]])
    own = np.zeros((len(rows), OWN))
    for k in range(5):
        total = np.add.reduceat(CLASSES[k][data], at)
        own[:, k] = total / (size if k in (1, 2) else x[:, 0])
    own[:, 5] = x[:, 1] * np.minimum(1, x[:, 0] / 30) + (1 - np.minimum(1, x[:, 0] / 30))
    own[:, 6], own[:, 7], own[:, 8] = x[:, 2], x[:, 3], x[:, 4]
    own[:, 9], own[:, 10] = np.log1p(size), np.log1p(np.repeat(counts, counts))
    own[:, 11] = np.minimum(size / x[:, 0], 40)
    first = np.zeros(len(rows), bool)
    first[(np.cumsum(counts) - counts)[counts > 0]] = True
    last = np.roll(first, -1)
    prev, after = np.roll(own, 1, 0), np.roll(own, -1, 0)
    prev[first], after[last] = own[first], own[last]
    return np.hstack([own, prev, after]), size, counts


def forward(emit: np.ndarray, counts: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Of chains laid end to end, by line and state: the log weight of all paths that end there."""
    out = np.zeros((len(emit), 2))
    if not len(emit):
        return out
    parts = -(-counts // SEGMENT)
    size = np.full(int(parts.sum()), SEGMENT)
    ends = np.cumsum(parts)[parts > 0] - 1
    size[ends] = counts[counts > 0] - (parts[counts > 0] - 1) * SEGMENT
    start = np.cumsum(size) - size

    def run(which: np.ndarray, enter: np.ndarray) -> None:
        """Fill out for some segments, entered with log weights by state; segments advance together, longest first."""
        which = which[np.argsort(-size[which], kind="stable")]
        at, n = start[which], size[which]
        for t in range(int(n[0])):
            k = int(np.searchsorted(-n, -t, "left"))  # segments longer than t
            i = at[:k] + t
            out[i] = emit[i] + (enter[which] if t == 0 else np.logaddexp(out[i - 1, :1] + trans[0], out[i - 1, 1:] + trans[1]))

    enter = np.zeros((len(size), 2))
    every, first = np.arange(len(size)), np.zeros(len(size), bool)
    first[np.concatenate([[0], ends[:-1] + 1])] = True
    later = every[~first]
    if len(later):
        last = start + size - 1
        through = np.zeros((2, len(size), 2))  # from a state before the segment to one at its end
        for state in (0, 1):
            enter[later] = trans[state]
            run(later, enter)
            through[state] = out[last]
        enter[:] = 0
        run(every[first], enter)
        for k in every:
            if first[k]:
                done = out[last[k]]
            else:
                enter[k] = np.logaddexp(done[0] + trans[0], done[1] + trans[1])
                done = np.logaddexp(done[0] + through[0, k], done[1] + through[1, k])
    run(every, enter)
    return out


def marginals(emit: np.ndarray, counts: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of chains laid end to end: P(good) by line, expected transitions (2 x 2), log normaliser by chain.

    emit is the score of good against bad.
    """
    e = np.zeros((len(emit), 2))
    e[:, 1] = emit
    a = forward(e, counts, trans)
    b = forward(e[::-1], counts[::-1], trans.T)[::-1] - e  # what follows a line, read backwards
    score = a + b
    z = np.logaddexp(score[:, 0], score[:, 1])
    good = np.exp(score[:, 1] - z)
    start = (np.cumsum(counts) - counts)[counts > 0]
    inner = np.ones(len(emit), bool)
    inner[start] = False
    i = np.flatnonzero(inner)
    pair = a[i - 1][:, :, None] + trans[None] + (e[i] + b[i])[:, None, :] - z[i][:, None, None]
    norm = np.zeros(len(counts))
    norm[counts > 0] = z[start]
    return good, np.exp(pair).sum(0), norm


def _averages(good: np.ndarray, size: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Length-weighted mean by chain; NaN for chains without lines."""
    chain = np.repeat(np.arange(len(counts)), counts)
    total, part = np.bincount(chain, size, len(counts)), np.bincount(chain, size * good, len(counts))
    return np.where(counts > 0, part / np.maximum(total, 1e-9), np.nan)


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def fit(feats: np.ndarray, size: np.ndarray, counts: np.ndarray, labels: np.ndarray, steps: int = 200, rate: float = 0.08, penalty: float = 1e-3) -> Model:
    """Maximum conditional likelihood by Adam over all chains at once."""
    mean, sd = feats.mean(0), feats.std(0) + 1e-3
    x = np.hstack([(feats - mean) / sd, np.ones((len(feats), 1))])
    y = np.repeat(labels.astype(np.float64), counts)
    # a long document weighs as the root of its number of lines
    weight = np.repeat(1 / np.sqrt(np.maximum(counts, 1)), counts)
    weight = weight / weight.mean()
    theta, m, v = np.zeros(x.shape[1] + 4), np.zeros(x.shape[1] + 4), np.zeros(x.shape[1] + 4)
    inner = np.maximum(counts - 1, 0)
    seen = np.array([[inner[labels == 0].sum(), 0], [0, inner[labels == 1].sum()]], np.float64)
    for step in range(1, steps + 1):
        w, trans = theta[:-4], theta[-4:].reshape(2, 2)
        good, pairs, _ = marginals(x @ w, counts, trans)
        slope = np.concatenate([x.T @ ((good - y) * weight), (pairs - seen).ravel()]) / len(x) + penalty * theta
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope**2
        theta = theta - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    w, trans = theta[:-4], theta[-4:].reshape(2, 2)
    good, _, _ = marginals(x @ w, counts, trans)
    have = counts > 0
    z, t = _logit(_averages(good, size, counts)[have]), labels[have].astype(float)
    slope, offset = 1.0, 0.0
    for _ in range(50):  # Newton's method on two parameters, with a weak pull to (1, 0)
        p = 1 / (1 + np.exp(-(slope * z + offset)))
        g = np.array([((p - t) * z).sum() + slope - 1, (p - t).sum() + offset])
        r = p * (1 - p) + 1e-9
        h = np.array([[(r * z * z).sum() + 1, (r * z).sum()], [(r * z).sum(), r.sum() + 1]])
        slope, offset = np.array([slope, offset]) - np.clip(np.linalg.solve(h, g), -2, 2)
    return Model(mean, sd, w, trans, max(float(slope), 0.05), float(offset))


def scores(model: Model | None, texts: list[str | None]) -> np.ndarray:
    out, at = np.empty(len(texts)), 0
    while at < len(texts):
        end, chars = at, 0
        while end < len(texts) and (end == at or chars + len(texts[end] or "") <= CHUNK):
            chars += len(texts[end] or "")
            end += 1
        feats, size, counts = line_features(texts[at:end])
        if model is None:
            out[at:end] = np.where(counts > 0, 0.5, EMPTY_SCORE)
        else:
            emit = ((feats - model.mean) / model.sd) @ model.weights[:-1] + model.weights[-1]
            raw = _averages(marginals(emit, counts, model.trans)[0], size, counts)
            out[at:end] = np.where(counts > 0, 1 / (1 + np.exp(-(model.slope * _logit(np.nan_to_num(raw, nan=0.5)) + model.offset))), EMPTY_SCORE)
        at = end
    return out


def held_out(doc_id):
    """Rows whose labels the fit never sees."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, per_class: int = MAX_PER_CLASS, lines: int = MAX_LINES) -> Model | None:
    """Fit on the labelled rows of docs that are not held out."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    known = known.where(~held_out(F.col("doc_id")))
    pick = [known.where(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for q in (0, 1)]
    # at most 2 * per_class rows of 12 bytes
    some = F.broadcast(pick[0].unionByName(pick[1]))
    rows = docs.select("doc_id", "text").join(some, "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.min("quality").alias("quality"))
    count = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: x.rlike(r"\S")))
    rows = rows.withColumn("lines", count).where(F.col("lines") <= lines // 8)
    # at most per_class rows in a window
    so_far = Window.partitionBy("quality").orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("sum", F.sum("lines").over(so_far)).where(F.col("sum") <= lines)

    def features(batches):
        for pdf in batches:
            for text, quality in zip(pdf["text"], pdf["quality"], strict=True):
                x, size, _ = line_features([text])
                yield type(pdf)({"x": [x.astype(np.float32).tobytes()], "size": [size.astype(np.float32).tobytes()], "quality": [int(quality)]})

    got = rows.mapInPandas(features, "x binary, size binary, quality int").collect()
    if len({r["quality"] for r in got}) < 2:
        return None
    got.sort(key=lambda r: (r["quality"], bytes(r["x"])))
    xs = [np.frombuffer(r["x"], np.float32).reshape(-1, 3 * OWN) for r in got]
    counts = np.array([len(x) for x in xs], np.int64)
    size = np.concatenate([np.frombuffer(r["size"], np.float32) for r in got]).astype(np.float64)
    if not counts.sum():
        return None
    return fit(np.concatenate(xs).astype(np.float64), size, counts, np.array([r["quality"] for r in got]))


def score(df: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """df with score (0 to 1, higher is better) and predicted (1 if score is at least 0.5)."""

    @F.pandas_udf(T.DoubleType())
    def quality(col):
        import pandas as pd

        return pd.Series(scores(model, [None if x is None or x != x else x for x in col]))

    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in ("score", "predicted")]
    out = df.select(*kept, quality(F.col(f"`{text}`")).alias("score"))
    return out.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0).cast("int"))
