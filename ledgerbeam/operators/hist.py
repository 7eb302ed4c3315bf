"""Histograms as long tables, their sums and ratios."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import codec

#: Histograms of one table: name -> (bins, low, high) (fixed values).
BOOKED = {
    "genTtbarId": (60_000, 0, 60_000), "genTtbarId_sub": (100, 0, 100), "Expanded": (60_000, 0, 60_000), "Expanded_sub": (100, 0, 100),
    "nAddBJets": (16, 0, 16), "nAddBJetsMulti": (16, 0, 16),
}


def histogram(df: DataFrame, value, bins: int, low: float, high: float, weight=None, by: tuple[str, ...] = ()) -> DataFrame:
    """by, bin, n, sumw, sumw2; bin 0 is below low, bins + 1 at high and above."""
    x = value if not isinstance(value, str) else F.col(value)
    w = F.lit(1.0) if weight is None else F.col(weight)
    bin_ = F.when(x < low, 0).when(x >= high, bins + 1).otherwise(F.floor((x - low) * bins / (high - low)) + 1).cast("int")
    return df.groupBy(*by, bin_.alias("bin")).agg(F.count("*").alias("n"), F.sum(w).alias("sumw"), F.sum(w * w).alias("sumw2"))


def booked(df: DataFrame) -> DataFrame:
    """The histograms of a sidecar table in one pass, of one without its columns the first two: hist, bin, n, sumw2 (weights are 1)."""
    values = {"genTtbarId": F.col("genTtbarId"), "genTtbarId_sub": codec.raw_sub_code("genTtbarId")}
    if "Expanded_genTtbarId" in df.columns:
        values |= {"Expanded": F.col("Expanded_genTtbarId"), "Expanded_sub": codec.raw_sub_code("Expanded_genTtbarId"), "nAddBJets": F.col("nAddBJets"), "nAddBJetsMulti": F.col("nAddBJetsMulti")}
    # the joint count first: its rows are as many as there are different codes and counts, not as events
    joint = df.groupBy(*(x.alias(h) for h, x in values.items())).agg(F.count("*").alias("n"))
    entries = F.array(*(
        F.struct(F.lit(h).alias("hist"), F.when(F.col(h) < lo, 0).when(F.col(h) >= hi, n + 1).otherwise(F.floor((F.col(h) - lo) * n / (hi - lo)) + 1).cast("int").alias("bin"))
        for h in values for n, lo, hi in (BOOKED[h],)
    ))
    return joint.select(F.explode(entries).alias("e"), "n").groupBy("e.hist", "e.bin").agg(F.sum("n").alias("n"), F.sum("n").cast("double").alias("sumw2"))


def merge(histograms: DataFrame, prefix: str = "") -> DataFrame:
    """Bin-wise sums by process: the name without its prefix and a last part of digits; names with another prefix are left out."""
    head = f"{prefix}_" if prefix else ""
    process = F.regexp_replace(F.substr("name", F.lit(len(head) + 1)), r"_[0-9]+$", "")
    return histograms.where(F.col("name").startswith(head)).groupBy(process.alias("process"), "bin").agg(F.sum("n").alias("n"))


def ratio(left: DataFrame, right: DataFrame, normalise: bool = False) -> DataFrame:
    """bin, a, b, ratio (null where b is 0), red (off by over 1e-6) and listed (b is 0, or off by over 1e-9)."""
    both = left.select("bin", F.col("n").alias("a")).join(right.select("bin", F.col("n").alias("b")), "bin", "full_outer").fillna(0)
    if normalise:
        area = lambda c: F.sum(c).over(Window.partitionBy())  # noqa: E731  of one row per bin
        both = both.select("bin", F.try_divide("a", area("a")).alias("a"), F.try_divide("b", area("b")).alias("b"))
    r = F.try_divide(F.col("a"), F.col("b"))
    off = F.abs(r - 1)
    return both.select("bin", "a", "b", r.alias("ratio"), F.coalesce(off > 1e-6, F.lit(False)).alias("red"), ((F.col("b") == 0) | (off > 1e-9)).alias("listed"))


def transitions(df: DataFrame) -> DataFrame:
    return df.groupBy((F.col("genTtbarId") % 100).alias("gen_sub"), (F.col("Expanded_genTtbarId") % 100).alias("exp_sub")).agg(F.count("*").alias("n"))


def crosstab(df: DataFrame, most: int = 6) -> DataFrame:
    """gen_sub and one column per number of additional jets, the last for most and more."""
    k = F.least("nAddBJets", F.lit(most))
    return df.groupBy((F.col("genTtbarId") % 100).alias("gen_sub")).agg(*(F.count_if(k == i).alias(f"n{i}") for i in range(most + 1)))
