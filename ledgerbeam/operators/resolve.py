"""Consumers of the lookup table: overriding codes, stitching, weights."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codec
from ..plans.verdict import Refused

KEY = ("run", "luminosityBlock", "event")


def load_lookup(spark: SparkSession, path: str) -> DataFrame:
    """The lookup table below path; refused (41) if it can't be opened."""
    try:
        return spark.read.parquet(path)
    except Exception as e:
        raise Refused(41, f"can't open {path}: {str(e).splitlines()[0][:200]}") from e


def check_lookup(lookup: DataFrame, key=KEY) -> dict:
    """Refuses an empty lookup table (42) and one with conflicting repeats of a key (43); counts equal repeats and rows whose sub-code and jets differ."""
    values = [c for c in lookup.columns if c not in key]
    odd = codec.is_ttnb("Expanded_genTtbarId") != (F.col("nAddBJets") >= 3) if "nAddBJets" in values else F.lit(False)
    differ = reduce(or_, (F.min(c) != F.max(c) for c in values))
    by = lookup.groupBy(*key).agg(F.count("*").alias("n"), F.coalesce(differ, F.lit(False)).alias("bad"), F.count_if(odd).alias("odd"))
    row = by.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("repeats"), F.count_if("bad").alias("bad"), F.coalesce(F.sum("odd"), F.lit(0)).alias("odd")).first()
    if not row["rows"]:
        raise Refused(42, "empty lookup table")
    if row["bad"]:
        raise Refused(43, f"{row['bad']} keys with conflicting rows")
    return row.asDict()


def check_hits(counts: DataFrame, stop: bool = True) -> dict:
    """Refuses (44) a lookup whose stored own codes differ from those of the rows it hits, unless stop is off; counts: counters' row."""
    row = counts.first().asDict()
    if stop and row["mismatches"]:
        raise Refused(44, f"{row['mismatches']} hits with another own code: not this sample's lookup table")
    return row


def resolve(rows: DataFrame, lookup: DataFrame | None, key=KEY) -> DataFrame:
    """rows with hit, resolved (stored code on a hit, own code otherwise) and mismatch (hit whose stored own code differs).

    Without a lookup table, a sample that has none, every row keeps its own code.
    """
    if lookup is None:
        return rows.withColumns({"hit": F.lit(False), "resolved": F.col("genTtbarId"), "mismatch": F.lit(False)})
    by = lookup.groupBy(*key).agg(F.min("genTtbarId").alias("_gen"), F.min("Expanded_genTtbarId").alias("_exp"))
    stored = by.select(*key, F.struct(F.col("_gen").alias("genTtbarId"), F.col("_exp").alias("Expanded_genTtbarId")).alias("stored"))
    out = rows.join(stored, list(key), "left")
    hit = F.col("stored").isNotNull()
    return out.withColumns({
        "hit": hit, "resolved": F.coalesce("stored.Expanded_genTtbarId", "genTtbarId"), "mismatch": hit & (F.col("stored.genTtbarId") != F.col("genTtbarId")),
    }).drop("stored")


def with_dataset(rows: DataFrame, pattern: str, index: DataFrame) -> DataFrame:
    """rows with datasetIdx by the file they come from; pattern's first group is the dataset's name in index (dataset, datasetIdx)."""
    named = rows.withColumn("dataset", F.regexp_extract(F.col("_metadata.file_path"), pattern, 1))
    return named.join(index, "dataset", "left")


def counters(resolved: DataFrame) -> DataFrame:
    sub = codec.sub_code("resolved")
    return resolved.agg(
        F.count_if("hit").alias("hits"), F.count_if(~F.col("hit")).alias("misses"), F.count_if("mismatch").alias("mismatches"),
        *(F.count_if(F.col("hit") & (sub == s)).alias(f"n{s}") for s in codec.TTNB),
    )


def resolve_events(rows: DataFrame, lookup: DataFrame, event_id: str) -> DataFrame:
    """Resolution by key and fingerprint, for rows with bits x1_bits, x2_bits and ids; the lookup's fractions are rounded to 14 bits here.

    status: hit, other_event (the key is there, no event fits), E83 (several fit), E84 (none fits, but one lies within
    2**-11), E85 (only the ids differ, or the fractions are swapped), miss.  The lookup's rows of a key, few by nature, come
    as one array, so the rows are shuffled once, by their key.
    """
    bits = ("x1_bits", "x2_bits")
    held = lookup.select(*KEY, F.struct(*(codec.round_mantissa(c).alias(c) for c in bits), "Generator_id1", "Generator_id2", "Generator_x1", "Generator_x2", "Expanded_genTtbarId").alias("s"))
    held = held.groupBy(*KEY).agg(F.collect_list("s").alias("held"))
    both = rows.join(held, list(KEY), "left")
    same = lambda s, *pairs: reduce(and_, (F.col(a) == s[b] for a, b in pairs))
    exact = lambda s: same(s, *((c, c) for c in bits))
    swapped = lambda s: same(s, ("x1_bits", "x2_bits"), ("x2_bits", "x1_bits"))
    ids = lambda s: same(s, ("Generator_id1", "Generator_id1"), ("Generator_id2", "Generator_id2"))
    close = lambda s: codec.near("Generator_x1", s["Generator_x1"], 2.0**-11) & codec.near("Generator_x2", s["Generator_x2"], 2.0**-11)
    fit = F.filter("held", lambda s: exact(s) & ids(s))
    both = both.withColumn("fit", fit)
    n = F.coalesce(F.size("fit"), F.lit(0))
    status = (
        F.when(F.col("held").isNull(), "miss").when(n > 1, "E83").when(n == 1, "hit").when(F.exists("held", lambda s: ids(s) & close(s)), "E84")
        .when(F.exists("held", lambda s: exact(s) | swapped(s)), "E85").otherwise("other_event")
    )
    return both.select(event_id, status.alias("status"), F.when(n == 1, F.get("fit", F.lit(0))["Expanded_genTtbarId"]).otherwise(F.col("genTtbarId")).alias("resolved"))


def stitch(rows: DataFrame, sample: str, dedicated: str, code: str) -> DataFrame:
    """rows with keep and the multiplier that goes with it."""
    keep = codec.stitch_keep(F.col(sample) == dedicated, code)
    return rows.withColumns({"keep": keep, "multiplier": F.when(keep, 1.0).otherwise(0.0)})


def weights(rows: DataFrame, code: str, weight: str) -> DataFrame:
    """Sum of weights and rows by sub-code."""
    return rows.groupBy(codec.sub_code(code).alias("sub")).agg(F.sum(weight).alias("sumw"), F.count("*").alias("n"))
