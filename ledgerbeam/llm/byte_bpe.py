"""Byte-level BPE: encoding by a global shuffle of distinct words, decoding by the table of token bytes.

Texts are gathered to blocks of about ``BLOCK`` words.  In a block each
pre-token has a place, and each distinct word counts once, whatever the number
of its places.  The distinct words are dealt by their checksums, a packed row
for each block and bucket; the task of a bucket encodes each of its words once
in the whole table.  The ids go back to the blocks, and each text is put
together from the ids by place.  What is shuffled: the distinct words of each
block, their ids, and the places (about one and a half bytes for each
pre-token); texts stay.  A word of every text is as light as any other.

Words are cut as ``tiktoken`` cuts them: what its pattern engine takes for
letters or numbers is asked from itself, since tables of characters differ
between libraries and their releases.  A word is merged alone, so results equal
``encode_ordinary``, also for texts that the library's own splitter can't take
(it fails on white space of a million characters).

Decoding joins the table of token bytes, which is as large as the vocabulary.
Ids that the vocabulary lacks fail the job.

Nulls: a null text is empty; it has no ids and decodes to no bytes.  Repeated
rows are encoded one by one, null ids are kept.  A text is never cut: one longer
than a block is a block.  An empty table gives an empty result.  Other columns
come along in a struct, so their names can't clash.
"""

from __future__ import annotations

import base64
import functools
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words of a block, and how many of them may differ.
BLOCK, WORDS = 2**21, 2**18
#: Buckets of words, at least; as many as there are shuffle partitions where these are more.
BUCKETS = 128
#: Texts whose places are packed together.
GROUP = 256


@functools.lru_cache(maxsize=4)
def ranks_of(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a file with a base64 token and its rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


@functools.lru_cache(maxsize=4)
def merger(path: str) -> Callable[[str], list[int]]:
    """The ids of one word, which is not split."""
    import tiktoken

    return tiktoken.Encoding("words", pat_str=r"(?s:.+)", mergeable_ranks=ranks_of(path), special_tokens={}).encode_ordinary


def _ranges(points: np.ndarray) -> str:
    """Code points as the inside of a class."""
    if not len(points):
        return ""
    parts = np.split(points, np.flatnonzero(np.diff(points) != 1) + 1)
    return "".join(f"\\U{int(p[0]):08x}-\\U{int(p[-1]):08x}" for p in parts)


def _points(text: str) -> np.ndarray:
    """Which of all code points are in text."""
    found = np.zeros(0x110000, bool)
    found[np.frombuffer(text.encode("utf-32-le"), "<u4")] = True
    return found


@functools.lru_cache(maxsize=4)
def splitter(pattern: str) -> Callable[[str], list[str]]:
    """The words of a text, as tiktoken's engine finds them.

    Character properties of the pattern are compared with that engine's over all code points; texts that have characters
    which the two see differently go by a pattern with the engine's own classes.
    """
    import regex
    import tiktoken

    every = np.r_[0:0xD800, 0xE000:0x110000].astype("<u4").tobytes().decode("utf-32-le")
    exact, odd = pattern, np.zeros(0x110000, bool)
    for name in sorted(set(regex.findall(r"\\p\{\w+\}", pattern))):
        probe = tiktoken.Encoding("probe", pat_str=f"{name}+", mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
        theirs = _points(probe.decode_bytes(probe.encode_ordinary(every)).decode())
        ours = _points("".join(regex.findall(f"{name}+", every)))
        odd |= ours != theirs
        more, less = _ranges(np.flatnonzero(theirs & ~ours)), _ranges(np.flatnonzero(ours & ~theirs))
        if less:
            exact = exact.replace(name, f"[[{name}{more}]--[{less}]]")
        elif more:
            exact = exact.replace(name, f"[{name}{more}]")
    fast = regex.compile(pattern)
    if not odd.any():
        return fast.findall
    strict, least = regex.compile(exact, regex.V1), chr(int(odd.argmax()))

    def words(text: str) -> list[str]:
        seen_differently = not text.isascii() and max(text) >= least and odd[np.frombuffer(text.encode("utf-32-le"), "<u4")].any()
        return (strict if seen_differently else fast).findall(text)

    return words


def _packed(numbers) -> bytes:
    """Numbers below 2**32 in four planes of bytes, compressed."""
    planes = np.asarray(numbers).astype("<u4").view(np.uint8).reshape(-1, 4).T
    return pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes, n: int) -> np.ndarray:
    raw = pa.decompress(data, decompressed_size=4 * n, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, n).T).view("<u4").ravel()


def _blocks(batches: Iterator[pa.RecordBatch], pattern: str, with_places: bool) -> Iterator[tuple[int, dict[str, int], list[tuple[int, pa.Array, list[int], np.ndarray]]]]:
    """Block number, its different words in order of their first places, and its texts in groups (if with_places).

    The same for a task that runs again.  A group has the number of words seen before it, its rows, their numbers of places,
    and the places: 0 for a word's first place in the block, else 1 + the word's number.
    """
    split, number = splitter(pattern), TaskContext.get().partitionId() << 33
    words: dict[str, int] = {}
    groups, size = [], 0
    for batch in batches:
        start, before, lengths, places_ = 0, len(words), [], []

        def closed(end: int) -> tuple:
            k = np.concatenate(places_) if places_ else np.zeros(0, np.uint32)
            # numbers rise with first places, so a number above all before it is new
            seen = np.maximum.accumulate(np.concatenate([[before], k.astype(np.int64) + 1]))[:-1]
            return before, batch.column("row").slice(start, end - start), lengths, np.where(k >= seen, 0, k + 1).astype("<u4")

        for i, text in enumerate(batch.column("text")):
            found = split(text.as_py() or "")
            if with_places:
                add = words.setdefault
                places_.append(np.fromiter((add(w, len(words)) for w in found), np.uint32, len(found)))
            else:
                words.update(dict.fromkeys(found, 0))
            lengths.append(len(found))
            size += len(found) + 1
            full = size >= BLOCK or len(words) >= WORDS
            if with_places and (full or len(lengths) >= GROUP or sum(map(len, places_[-1:])) >= GROUP << 12):
                groups.append(closed(i + 1))
                start, before, lengths, places_ = i + 1, len(words), [], []
            if full:
                yield number, words, groups
                number, words, groups, size, before = number + 1, {}, [], 0, 0
        if lengths and with_places:
            groups.append(closed(batch.num_rows))
    if words or size:
        yield number, words, groups


def _bucket(word: str, buckets: int) -> int:
    return zlib.crc32(word.encode()) % buckets


def dictionary(docs: DataFrame, pattern: str, buckets: int) -> DataFrame:
    """bucket, block, n, k, sizes, words: the different words of each block whose checksums fall in a bucket, and their numbers in
    the block; packed, a row for each block and bucket.  docs has row and text."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, words, _ in _blocks(batches, pattern, False):
            items = list(words)
            bucket = np.fromiter((_bucket(w, buckets) for w in items), np.uint32, len(items))
            order = np.argsort(bucket, kind="stable")
            ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
            out = []
            for i in range(buckets):
                if k := order[ends[i] : ends[i + 1]].tolist():
                    part = [items[j] for j in k]
                    out.append((i, number, len(k), _packed(np.diff(k, prepend=0)), _packed([len(w) for w in part]), pa.compress(data := "".join(part).encode(), codec="zstd", asbytes=True), len(data)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out)) or [()] * 7, (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int64()))], ["bucket", "block", "n", "k", "sizes", "words", "bytes"])

    return docs.mapInArrow(of, "bucket int, block bigint, n int, k binary, sizes binary, words binary, bytes bigint")


def places(docs: DataFrame, pattern: str) -> DataFrame:
    """block and groups of its texts: rows, the numbers of their places, and the places as _blocks has them."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, _, groups in _blocks(batches, pattern, True):
            for before, rows, lengths, codes in groups:
                columns = [pa.array([number], pa.int64()), pa.array([before], pa.int32()), pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows), pa.array([lengths], pa.list_(pa.int32())), pa.array([_packed(codes)], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["block", "before", "rows", "n", "places"])

    return docs.mapInArrow(of, f"block bigint, before int, rows array<{docs.schema['row'].dataType.simpleString()}>, n array<int>, places binary")


def _ends(data: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary array's values, end to end, and where each begins and the last ends."""
    if not len(data):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(data.buffers()[1], np.int32)[data.offset : data.offset + len(data) + 1].astype(np.int64)
    return np.frombuffer(data.buffers()[2] or b"", np.uint8)[: at[-1]], at


def _gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The stretches of flat whose numbers are at, end to end."""
    long = sizes[at]
    return flat[np.repeat(starts[at] - np.cumsum(long) + long, long) + np.arange(long.sum())]


def _assembled(found: pa.Table, texts: pa.Table) -> pa.Table:
    """row and ids of a block's texts."""
    k, sizes, ids = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, "<u4")]
    for row in found.to_pylist():
        k.append(np.cumsum(_unpacked(row["k"], row["n"]).astype(np.int64)))
        sizes.append(_unpacked(row["sizes"], row["n"]).astype(np.int64))
        ids.append(_unpacked(row["ids"], int(sizes[-1].sum())))
    flat, k, long = np.concatenate(ids), np.concatenate(k), np.concatenate(sizes)
    starts, sizes = np.zeros(len(k), np.int64), np.zeros(len(k), np.int64)
    starts[k], sizes[k] = np.cumsum(long) - long, long
    out = []
    for before, n, packed in zip(*(texts.column(c).to_pylist() for c in ("before", "n", "places"))):
        code = _unpacked(packed, sum(n)).astype(np.int64)
        new = code == 0
        at = code - 1
        at[new] = before + np.arange(new.sum())
        ids, ends = _gather(flat, starts, sizes, at), np.concatenate([[0], np.cumsum(sizes[at])]).astype(np.int64)
        stops = ends[np.concatenate([[0], np.cumsum(n)])].tolist()
        out += [ids[a:b].tobytes() for a, b in zip(stops, stops[1:])]
    return pa.table([pa.chunked_array([x.flatten() for x in texts.column("rows").chunks]), pa.array(out, pa.binary())], ["row", "ids"])


def encoded_words(words: DataFrame, path: str) -> DataFrame:
    """block, n, k, sizes, ids: dictionary's words by their ids.

    A bucket's rows meet in one task, which encodes each of the bucket's different words once and holds these alone.
    """

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merge, bucket, known = merger(path), None, {}
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["bucket"] != bucket:
                    bucket, known = row["bucket"], {}
                text, at, ids = pa.decompress(row["words"], decompressed_size=row["bytes"], codec="zstd", asbytes=True).decode(), 0, []
                for size in _unpacked(row["sizes"], row["n"]).tolist():
                    word = text[at : at + size]
                    at += size
                    if (found := known.get(word)) is None:
                        found = known[word] = merge(word)
                    ids.append(found)
                out.append((row["block"], row["n"], row["k"], _packed([len(x) for x in ids]), _packed(np.concatenate(ids))))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out)) or [()] * 5, (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()))], ["block", "n", "k", "sizes", "ids"])

    return words.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(of, "block bigint, n int, k binary, sizes binary, ids binary")


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """row (a struct of docs' columns but for the text) and ids, packed as unsigned 32-bit little-endian numbers.

    path: a file of token bytes and ranks that all tasks can read.
    """
    rows = docs.select(F.struct(*(c for c in docs.columns if c != text)).alias("row"), F.col(text).alias("text"))
    buckets = max(BUCKETS, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    words, where = encoded_words(dictionary(rows, pattern, buckets), path), places(rows, pattern)
    return words.groupBy("block").cogroup(where.groupBy("block")).applyInArrow(_assembled, f"row {rows.schema['row'].dataType.simpleString()}, ids binary")


def n_tokens(ids: Column) -> Column:
    return F.call_function("div", F.octet_length(ids), F.lit(4)).cast("bigint")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """encode's rows with decoded, the bytes of the ids.

    The table of token bytes, bounded by the vocabulary, is held in each task and joined by id where the rows are.
    """
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = ranks_of(path)
        known = np.zeros(max(ranks.values()) + 1, bool)
        tokens: list[bytes] = [b""] * len(known)
        for token, rank in ranks.items():
            tokens[rank], known[rank] = token, True
        flat, ends = _ends(pa.array(tokens, pa.binary()))
        for batch in batches:
            out = []
            for value in batch.column("ids"):
                ids = np.frombuffer(value.as_py(), "<u4").astype(np.int64)
                if len(ids) and (ids.max() >= len(known) or not known[ids].all()):
                    raise ValueError(f"no such token: {next(int(i) for i in ids if i >= len(known) or not known[i])}")
                out.append(_gather(flat, ends[:-1], np.diff(ends), ids).tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], [*batch.schema.names, "decoded"])

    return encoded.mapInArrow(of, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema) + ", decoded binary")
