"""Packing token sequences by Karmarkar-Karp multiway differencing.

Each task reads its rows once, encodes the texts, and collects them to blocks
of about ``BLOCK`` windows.  A document's full windows are sequences of their
own; what is left of it is cut in pieces of at most ``PIECE`` tokens.  The
pieces of a block start as partitions with one filled window; the two
partitions with the largest imbalance are merged, the fullest windows of one
with the emptiest of the other, until one partition of near-equal windows
remains.  The number of windows starts at the least possible and rises whenever
a window exceeds its capacity.  A task holds one block, never a whole table,
and nothing is shuffled.  Sequence ids join the partition's number and a count,
so a task that runs again gives the same ids.

Ids equal those of the ``tokenizers`` library for the given file, the file's
added tokens in a text included; encoding goes through ``tiktoken`` with the
ranks of that file's vocabulary, which is four times as fast, and falls back to
``tokenizers`` for texts it can't take.

Nulls: a null text is empty, so its document is the closing id alone.  Null ids
are kept.  Repeated rows are packed one by one.  An empty table gives an empty
result.  Other columns of the input are not returned.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITY = 1024
PIECE = 256
#: Windows that are balanced together.
BLOCK = 128
CLOSE = 0
#: Splits text before merging; the pattern of byte-level BPE (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SCHEMA = "doc_id string, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"


def _byte_values() -> dict[str, int]:
    """The bytes that the letters of a byte-level vocabulary stand for: printable ones for themselves, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def encoder(path: str):
    """A function from a text to its ids; loaded once in each Python process."""
    import tiktoken
    from tokenizers import Tokenizer

    loaded = tiktoken.__dict__.setdefault("_ledgerbeam_loaded", {})
    if path not in loaded:
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        added = model.get("added_tokens", ())
        special = {x["content"]: x["id"] for x in added}
        byte = _byte_values()
        ranks = {bytes(byte[c] for c in token): i for token, i in model["model"]["vocab"].items() if token not in special}
        fast = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        exact = Tokenizer.from_file(path)
        # added tokens that take in white space or only stand alone are left to the library
        plain = not any(x[k] for x in added for k in ("single_word", "lstrip", "rstrip"))

        def encode(text: str) -> list[int]:
            try:
                if plain or not any(x in text for x in special):
                    return fast.encode(text, allowed_special="all")
            except BaseException as e:  # the library panics on some extreme texts
                if isinstance(e, KeyboardInterrupt | SystemExit | MemoryError):
                    raise
            return exact.encode(text, add_special_tokens=False).ids

        loaded[path] = encode
    return loaded[path]


def differencing(sizes: np.ndarray, k: int) -> np.ndarray:
    """The window, 0 to k - 1, of each item."""
    n = len(sizes)
    if k == 1:
        return np.zeros(n, np.int64)
    # A partition: its k sums in descending order and, beside each, the node of the items in it.  Node 0 is empty, nodes
    # 1 to n are the items; merging two partitions adds k nodes whose children are the windows put together.
    children, made = [], n + 1
    heap = []
    for i, size in enumerate(sizes.tolist()):
        sums, nodes = np.zeros(k, np.int64), np.zeros(k, np.int64)
        sums[0], nodes[0] = size, i + 1
        heap.append((-size, i, sums, nodes))
    heapq.heapify(heap)
    count = n
    while len(heap) > 1:
        _, _, s1, n1 = heapq.heappop(heap)
        _, _, s2, n2 = heapq.heappop(heap)
        sums, left, right = s1 + s2[::-1], n1, n2[::-1]
        order = np.argsort(-sums, kind="stable")
        sums, left, right = sums[order], left[order], right[order]
        sums = sums - sums[-1]
        children.append((left, right))
        heapq.heappush(heap, (-int(sums[0]), count, sums, np.arange(made, made + k)))
        made += k
        count += 1
    window = np.full(made, -1, np.int64)
    window[heap[0][3]] = np.arange(k)
    at = made
    for left, right in reversed(children):
        at -= k
        w = window[at : at + k]
        window[left[w >= 0]] = w[w >= 0]
        window[right[w >= 0]] = w[w >= 0]
        window[0] = -1
    return window[1 : n + 1]


def balance(sizes: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """The window of each item; no window holds more than the capacity."""
    k = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        window = differencing(sizes, k)
        over = np.maximum(np.bincount(window, sizes, k) - capacity, 0).sum()
        if not over:
            return window
        k += max(1, int(over) // capacity)


class _Block:
    """Documents of one task that are packed together."""

    def __init__(self, first_sequence: int, capacity: int, piece: int):
        self.next, self.capacity, self.piece = first_sequence, capacity, piece
        self.out: list[tuple] = []
        self.rest: list[tuple] = []
        self.held = 0

    def add(self, doc_id, ids: np.ndarray) -> None:
        total = len(ids)
        full = total // self.capacity * self.capacity
        for at in range(0, full, self.capacity):
            self.out.append((doc_id, at, self.capacity, ids[at : at + self.capacity].tobytes(), total, self.next, 0))
            self.next += 1
        for at in range(full, total, self.piece):
            part = ids[at : at + self.piece]
            self.rest.append((doc_id, at, len(part), part.tobytes(), total))
        self.held += total - full

    def pack(self) -> None:
        if self.rest:
            sizes = np.array([x[2] for x in self.rest], np.int64)
            window = balance(sizes, self.capacity)
            used, fill = {}, {}
            for w, x in zip(window.tolist(), self.rest, strict=True):
                sequence = used.setdefault(w, self.next + len(used))
                self.out.append((*x, sequence, fill.get(w, 0)))
                fill[w] = fill.get(w, 0) + x[2]
            self.next += len(used)
        self.rest, self.held = [], 0

    def take(self) -> pd.DataFrame:
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        frame = pd.DataFrame.from_records(self.out, columns=names)
        self.out = []
        return frame


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, piece: int = PIECE, block: int = BLOCK) -> DataFrame:
    """A row per piece: its document and place there, its ids as little-endian unsigned 32-bit numbers, its sequence and place there."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(tokenizer)
        own = _Block(TaskContext.get().partitionId() << 36, capacity, piece)
        for pdf in batches:
            for doc_id, text in zip(pdf["doc_id"], pdf["text"], strict=True):
                ids = np.array([*encode(text), CLOSE] if isinstance(text, str) else [CLOSE], "<u4")
                own.add(doc_id, ids)
                if own.held >= block * capacity:
                    own.pack()
                if len(own.out) >= 4096:
                    yield own.take()
        own.pack()
        if own.out:
            yield own.take()

    # ids travel as text: pandas would turn numbers with nulls among them to floats
    return docs.select(F.col("doc_id").cast("string"), "text").mapInPandas(run, SCHEMA).withColumn("doc_id", F.col("doc_id").cast("bigint"))
