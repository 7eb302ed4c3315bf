"""Document fingerprints: homomorphic multiset hashes over paragraphs.

A fingerprint is a list of 64-bit numbers.  The first is the number of
paragraphs (the texts between line ends).  The next ``EXACT`` numbers add, for
every paragraph, a wide vector of that many independent 62-bit hashes of the
whole paragraph, each modulo 2**62: equal multisets of paragraphs, in any order,
give equal sums; different ones do so with a chance of 2**-(62 * EXACT).  The
other ``CELLS`` numbers are a sketch of what the paragraphs hold: every stretch
of a paragraph adds 1 to a cell, by its hash.  The cosine of two sketches, less
what even cells would hold, estimates that of the texts' counts of stretches with
a standard error of 1 / sqrt(CELLS).  A stretch ends behind a character of
``BEFORE`` that one of ``BEHIND`` follows, some 20 characters on average, so the
text itself sets the cuts: an insertion changes the stretches it falls in, and
the others stay whatever their place.  Counts are plain numbers of 64 bits and
never wrap.

Cells are counted natively: each stretch's hash names a letter, the letters of a
text are joined to a string, and a cell's count is what the string loses when
its letter is removed.

``insert`` and ``delete`` add and take away the fingerprints of paragraphs
without reading the rest of the text.

Nulls: a null text counts as empty; it has one empty paragraph and no stretch.
Two texts without stretches have likeness 1, one such and another 0.  The next
document is the one with the next larger id, null last and before the first; of
rows that repeat an id it is the one whose beginning sorts first.  Each of these
rows is edited by itself.  A single document is next to itself.  Empty tables
give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

EXACT = 4
#: Cells of the sketch; the letters U+0001 and on stand for them.
CELLS = 120
MASK = (1 << 62) - 1
#: A stretch ends between two such characters: of each class, a share of the letters, digits and frequent signs of other
#: scripts (fixed values).  One without such a place ends after ``LONGEST`` characters.
BEFORE = r"[ \t(08HPXhpx\u3001\u3002\u306E\u306F\u4E00\u4E0D\u662F\u7684]"
BEHIND = r"[0369CFILORUXcfiloruxa\u0080-\x{10FFFF}]"
LONGEST = 256
STRETCH = f"[^\\n]{{0,{LONGEST - 1}}}?{BEFORE}(?={BEHIND})|[^\\n]{{1,{LONGEST}}}"


def _long(x: int) -> Column:
    return F.lit(x).cast("bigint")


def _masked(x: Column) -> Column:
    return x.bitwiseAND(_long(MASK))


def _once(x: Column, use) -> Column:
    """use of x, which is computed once however often use has it."""
    return F.get(F.transform(F.array(x), lambda y: use(y)), F.lit(0))


def fingerprint(text: Column) -> Column:
    """The numbers of one text."""
    t = F.coalesce(text, F.lit(""))

    def lane(paragraphs: Column, seed: int) -> Column:
        # the seed comes first, so each hash reads the paragraph anew
        return F.aggregate(paragraphs, _long(0), lambda acc, p: _masked(acc + _masked(F.xxhash64(F.lit(seed), p))))

    def cells(letters: Column) -> Column:
        size = F.char_length(letters)
        return F.array(*((size - F.char_length(F.replace(letters, F.lit(chr(k + 1)), F.lit("")))).cast("bigint") for k in range(CELLS)))

    exact = _once(F.split(t, "\n"), lambda p: F.array(F.size(p).cast("bigint"), *(lane(p, j) for j in range(EXACT))))
    stretches = F.regexp_extract_all(t, F.lit(STRETCH), F.lit(0))
    letters = F.array_join(F.transform(stretches, lambda x: F.char(F.pmod(F.xxhash64(x), F.lit(CELLS)) + 1)), "")
    sketch = _once(letters, cells)
    return F.concat(exact, sketch)


def _joined(whole: Column, part: Column, sign: int) -> Column:
    exact = F.zip_with(F.slice(whole, 2, EXACT), F.slice(part, 2, EXACT), lambda a, b: _masked(a + b) if sign > 0 else _masked(a - b))
    plain = lambda at, n: F.zip_with(F.slice(whole, at, n), F.slice(part, at, n), lambda a, b: a + sign * b)
    return F.concat(plain(1, 1), exact, plain(EXACT + 2, CELLS))


def insert(whole: Column, part: Column) -> Column:
    """The fingerprint of whole with the paragraphs of part added."""
    return _joined(whole, part, 1)


def delete(whole: Column, part: Column) -> Column:
    """The fingerprint of whole with the paragraphs of part taken away."""
    return _joined(whole, part, -1)


def as_hex(numbers: Column) -> Column:
    return F.lower(F.array_join(F.transform(numbers, lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def _cells(numbers: Column) -> Column:
    """The sketch's counts less their mean."""
    counts = F.slice(numbers, EXACT + 2, CELLS)
    mean = F.aggregate(counts, F.lit(0).cast("bigint"), lambda a, x: a + x) / CELLS
    return _once(mean, lambda m: F.transform(counts, lambda x: x - m))


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: the cosine of two sketches, 1 for equal fingerprints."""
    sums = F.aggregate(
        F.zip_with(_cells(a), _cells(b), lambda x, y: F.struct(x.alias("x"), y.alias("y"))),
        F.struct(F.lit(0.0).alias("xy"), F.lit(0.0).alias("xx"), F.lit(0.0).alias("yy")),
        lambda acc, v: F.struct((acc["xy"] + v["x"] * v["y"]).alias("xy"), (acc["xx"] + v["x"] * v["x"]).alias("xx"), (acc["yy"] + v["y"] * v["y"]).alias("yy")),
        lambda acc: F.when((acc["xx"] > 0) & (acc["yy"] > 0), acc["xy"] / F.sqrt(acc["xx"] * acc["yy"])).otherwise(F.lit(0.0)),
    )
    return F.when(a == b, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), sums)))


def ring(docs: DataFrame) -> DataFrame:
    """doc_id, prev_id, next_id and need (code points of the longest text of prev_id) for every distinct id, stored."""
    ids = docs.groupBy("doc_id").agg(F.max(F.char_length(F.coalesce("text", F.lit("")))).alias("n"))
    place = F.monotonically_increasing_id()
    order = F.col("doc_id").asc_nulls_last()
    shards = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = cut(ids.repartitionByRange(shards, order).sortWithinPartitions(order).select("*", F.shiftright(place, 33).alias("shard"), place.bitwiseAND(_long((1 << 33) - 1)).alias("k")))
    starts = ids.groupBy("shard").agg(F.count("*").alias("rows"))
    # one row per shard, at most as many as there are shuffle partitions
    starts = starts.withColumn("start", F.sum("rows").over(Window.orderBy("shard")) - F.col("rows"))
    total = ids.count()
    placed = ids.join(F.broadcast(starts), "shard").select("doc_id", "n", (F.col("start") + F.col("k")).alias("i"))
    prev = placed.select(F.pmod(F.col("i") + 1, F.lit(max(total, 1))).alias("i"), F.col("doc_id").alias("prev_id"), F.col("n").alias("need"))
    return cut(placed.join(prev, "i").select("doc_id", "prev_id", "need"))


def edited(docs: DataFrame) -> DataFrame:
    """doc_id, text, edited (its last quarter replaced by the next document's beginning), the two fingerprints, and the next document's."""
    links = ring(docs)
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("fp", fingerprint(F.col("text")))
    links = links.withColumnRenamed("doc_id", "id")
    placed = own.join(links, F.col("doc_id").eqNullSafe(F.col("id"))).select("doc_id", "text", "fp", "prev_id", "need")
    beginning = F.substr("text", F.lit(1), F.floor(F.col("need") / 4).cast("int"))
    following = placed.groupBy("prev_id").agg(F.min(F.struct(beginning.alias("beginning"), F.col("fp").alias("next_fp"))).alias("next"))
    both = placed.join(following.withColumnRenamed("prev_id", "of"), F.col("doc_id").eqNullSafe(F.col("of")))
    n = F.char_length("text")
    quarter = F.floor(n / 4).cast("int")
    text = F.concat(F.substr("text", F.lit(1), n - quarter), F.substr("next.beginning", F.lit(1), quarter))
    both = both.select("doc_id", "text", "fp", F.col("next.next_fp").alias("next_fp"), text.alias("edited"))
    return both.withColumn("edited_fp", fingerprint(F.col("edited")))
