"""Derivation of the sidecar table: additional b jets per event, and the expanded code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codec

PT_MIN, ETA_MAX = 20.0, 2.4
#: Columns of the sidecar table (fixed names).
SIDECAR = (
    "run", "luminosityBlock", "event", "genTtbarId", "Expanded_genTtbarId", "nAddBJets", "nAddBJetsMulti",
    "Generator_x1", "Generator_x2", "Generator_id1", "Generator_id2",
)


def accepted(pt: Column, eta: Column, pt_min: float = PT_MIN, eta_max: float = ETA_MAX) -> Column:
    """Jet acceptance; both bounds are inclusive."""
    return (pt >= pt_min) & (F.abs(eta) <= eta_max)


def count_jets(hadrons: DataFrame, by: str = "ev", pt_min: float = PT_MIN, eta_max: float = ETA_MAX) -> DataFrame:
    """by, nAddBJets, nAddBJetsMulti from one row per hadron (by, jet_idx, pt, eta, from_top); events without accepted jets have no row."""
    # dealt by event once: both aggregates, and a join on the event after them, find their rows in place
    ok = hadrons.where(accepted(F.col("pt"), F.col("eta"), pt_min, eta_max) & (F.col("jet_idx") >= 0)).repartition(by)
    jets = ok.groupBy(by, "jet_idx")
    jets = jets.agg(F.count_if("from_top").alias("top"), F.count_if(~F.col("from_top")).alias("add"))
    extra = (F.col("add") > 0) & (F.col("top") == 0)
    return jets.groupBy(by).agg(
        F.count_if(extra).cast("int").alias("nAddBJets"), F.count_if(extra & (F.col("add") >= 2)).cast("int").alias("nAddBJetsMulti")
    )


def count_nested(jets: Column, idx: Column, from_top: Column, pt_min: float = PT_MIN, eta_max: float = ETA_MAX) -> Column:
    """struct(n, multi) from an event's nested arrays: jets (pt, eta), and each hadron's jet index and flag, without exploding.

    Indexes below zero or beyond the jets don't count.
    """
    hadrons = F.arrays_zip(idx.alias("i"), from_top.alias("t"))
    ok = F.filter(hadrons, lambda h: (h["i"] >= 0) & (h["i"] < F.size(jets)))
    ok = F.filter(ok, lambda h: accepted(F.get(jets, h["i"])["pt"], F.get(jets, h["i"])["eta"], pt_min, eta_max))
    on_top = F.array_distinct(F.transform(F.filter(ok, lambda h: h["t"]), lambda h: h["i"]))
    extra = F.transform(F.filter(ok, lambda h: ~h["t"] & ~F.array_contains(on_top, h["i"])), lambda h: h["i"])
    twice = F.filter(F.array_distinct(extra), lambda j: F.size(F.filter(extra, lambda k: k == j)) >= 2)
    return F.struct(F.size(F.array_distinct(extra)).alias("n"), F.size(twice).alias("multi"))


def sidecar(events: DataFrame, counts: DataFrame, by: str = "ev") -> DataFrame:
    """Events with their counts (0 where there are none) and the expanded code."""
    out = events.join(counts, by, "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("nAddBJets", "nAddBJetsMulti")})
    return out.withColumn("Expanded_genTtbarId", codec.expand("genTtbarId", "nAddBJets", "nAddBJetsMulti"))


def missing_products(events: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """events with 0 for nulls in columns, and one row of how many there were."""
    filled = events.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in columns})
    return filled, events.agg(*(F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in columns))
