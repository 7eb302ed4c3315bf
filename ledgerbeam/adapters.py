"""Views of the test tables as event tables.

Each view has a Spark form and, in ``SQL``, the same as common table
expressions for the comparison engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import codec
from .operators import derive

#: Events of one luminosity block.
PER_BLOCK = 5000
#: Events of one run; the test tables have one run.
PER_RUN = 10**12
MASK = '{"1": [[1, 1], [4, 7], [9, 9], [20, 24]], "2": [[1, 3]]}'


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hadrons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("ev"), (F.col("l_linenumber") - 1).alias("jet_idx"), F.col("l_quantity").alias("pt"),
        (F.col("l_discount") * 100 - 5).alias("eta"), (F.col("l_returnflag") == "R").alias("from_top"),
    )


def sidecar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sidecar row per order, with its key, chunk and fingerprint."""
    counts = derive.count_jets(hadrons(spark, sf_dir))
    out = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("ev"), F.col("o_custkey").alias("cust")).join(counts, "ev", "left")
    n, multi = F.coalesce("nAddBJets", F.lit(0)), F.coalesce("nAddBJetsMulti", F.lit(0))
    base = (
        F.when(n == 0, F.when(F.col("ev") % 4 == 0, 41).otherwise(0)).when(n == 1, F.when(multi >= 1, 52).otherwise(51))
        .otherwise(F.when(multi >= 2, 55).when(multi == 1, 54).otherwise(53))
    )
    out = out.select(
        "ev", "cust", (codec.idiv("ev", PER_RUN) + 1).alias("run"), codec.idiv("ev", PER_BLOCK).alias("luminosityBlock"), (F.col("ev") % PER_BLOCK).alias("event"),
        (F.col("cust") % 3 * 100 + base).cast("int").alias("genTtbarId"), n.cast("int").alias("nAddBJets"), multi.cast("int").alias("nAddBJetsMulti"),
        ((F.col("cust") % 64) / 64).cast("float").alias("Generator_x1"), ((F.col("ev") % 32) / 32).cast("float").alias("Generator_x2"),
        (F.col("cust") % 5 - 2).cast("int").alias("Generator_id1"), (F.col("ev") % 7 - 3).cast("int").alias("Generator_id2"),
    )
    return out.withColumn("Expanded_genTtbarId", codec.expand("genTtbarId", "nAddBJets", "nAddBJetsMulti"))


def nano(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference table: one order in 37 lost, one code in 997 changed, five rows without a counterpart."""
    lost = sidecar(spark, sf_dir).where(F.col("ev") % 37 != 0)
    own = lost.select("run", "luminosityBlock", "event", (F.col("genTtbarId") + F.when(F.col("ev") % 997 == 0, 1).otherwise(0)).cast("int").alias("genTtbarId"), (F.col("cust") % 20).alias("chunk"))
    extra = spark.range(5).select(F.lit(1).cast("bigint").alias("run"), F.lit(1_000_000_000).cast("bigint").alias("luminosityBlock"), F.col("id").alias("event"), F.lit(0).alias("genTtbarId"), F.lit(0).cast("bigint").alias("chunk"))
    return own.unionByName(extra)


def prioritised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as rows of two inputs of one dataset that share identities."""
    return table(spark, sf_dir, "lineitem").select(
        F.lit("/A/B/NANOAODSIM").alias("dataset"), F.lit(0).alias("datasetIdx"), F.lit(1).cast("bigint").alias("run"),
        F.col("l_orderkey").alias("luminosityBlock"), F.col("l_linenumber").cast("bigint").alias("event"),
        (F.col("l_suppkey") % 2).cast("int").alias("priority"), (F.col("l_suppkey") % 2).cast("int").alias("ord"),
        F.struct("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice").alias("pos"),
        F.when(F.col("l_returnflag") == "R", 53).otherwise(54).alias("genTtbarId"),
        F.when(F.col("l_returnflag") == "R", 61).when(F.col("l_returnflag") == "A", 54).otherwise(71).alias("Expanded_genTtbarId"),
        F.when(F.col("l_returnflag") == "R", 3).when(F.col("l_returnflag") == "A", 2).otherwise(4).alias("nAddBJets"),
        F.col("l_linenumber").cast("int").alias("nAddBJetsMulti"),
        (F.col("l_quantity") / 64).cast("float").alias("Generator_x1"), F.lit(0.5).cast("float").alias("Generator_x2"),
        F.lit(21).alias("Generator_id1"), F.lit(21).alias("Generator_id2"),
    )


def ordered_files(spark: SparkSession, sf_dir: str, permuted: bool = False) -> DataFrame:
    """Events as rows of daily files; permuted: one row in 500 sits at another place."""
    pos = F.when((F.col("event_id") % 500 == 7) & F.lit(permuted), F.col("event_id") - 20).otherwise(F.col("event_id"))
    return table(spark, sf_dir, "events").select(
        F.date_format("ts", "yyyy-MM-dd").alias("file"), (pos * 2 + (F.col("event_id") % 500 == 7).cast("int")).alias("pos"), F.lit(1).cast("bigint").alias("run"),
        codec.idiv("event_id", 100).alias("luminosityBlock"), F.col("event_id").alias("event"),
    )


#: Common table expressions of the views above.
SQL = f"""
hadrons AS (
  SELECT l_orderkey AS ev, l_linenumber - 1 AS jet_idx, l_quantity AS pt, l_discount * 100 - 5 AS eta, l_returnflag = 'R' AS from_top FROM lineitem),
jets AS (
  SELECT ev, jet_idx, count(*) FILTER (WHERE from_top) AS top, count(*) FILTER (WHERE NOT from_top) AS add_n
  FROM hadrons WHERE pt >= 20 AND abs(eta) <= 2.4 AND jet_idx >= 0 GROUP BY ALL),
counts AS (
  SELECT ev, count(*) FILTER (WHERE add_n > 0 AND top = 0)::INT AS n, count(*) FILTER (WHERE add_n > 1 AND top = 0)::INT AS m FROM jets GROUP BY ev),
ev0 AS (
  SELECT o_orderkey AS ev, o_custkey AS cust, coalesce(n, 0) AS n, coalesce(m, 0) AS m FROM orders LEFT JOIN counts ON ev = o_orderkey),
ev1 AS (
  SELECT *, (cust % 3 * 100 + CASE WHEN n = 0 THEN CASE WHEN ev % 4 = 0 THEN 41 ELSE 0 END WHEN n = 1 THEN CASE WHEN m >= 1 THEN 52 ELSE 51 END
    WHEN m >= 2 THEN 55 WHEN m = 1 THEN 54 ELSE 53 END)::INT AS gen FROM ev0),
sidecar AS (
  SELECT ev, cust, ev // {PER_RUN} + 1 AS run, ev // {PER_BLOCK} AS lumi, ev % {PER_BLOCK} AS event, gen, n, m,
    CASE WHEN n <= 2 THEN gen ELSE gen // 100 * 100 + CASE WHEN n = 3 THEN CASE WHEN m >= 1 THEN 62 ELSE 61 END ELSE CASE WHEN m >= 1 THEN 72 ELSE 71 END END END::INT AS exp,
    ((cust % 64) / 64)::FLOAT AS x1, ((ev % 32) / 32)::FLOAT AS x2, (cust % 5 - 2)::INT AS id1, (ev % 7 - 3)::INT AS id2
  FROM ev1),
nano AS (
  SELECT run, lumi, event, (gen + CASE WHEN ev % 997 = 0 THEN 1 ELSE 0 END)::INT AS gen, cust % 20 AS chunk FROM sidecar WHERE ev % 37 <> 0
  UNION ALL SELECT 1, 1000000000, range, 0, 0 FROM range(5)),
matched AS (
  SELECT nano.run, nano.lumi, nano.event, nano.gen AS ngen, chunk, s.gen, s.exp, s.n, s.m, s.run IS NOT NULL AS there, s.exp % 100 IN (61, 62, 71, 72) AS ext
  FROM nano LEFT JOIN sidecar s ON s.run = nano.run AND s.lumi = nano.lumi AND s.event = nano.event),
items AS (
  SELECT '/A/B/NANOAODSIM' AS dataset, l_orderkey AS lumi, l_linenumber::BIGINT AS event, (l_suppkey % 2)::INT AS ord, (l_partkey, l_suppkey, l_quantity, l_extendedprice) AS pos,
    CASE WHEN l_returnflag = 'R' THEN 53 ELSE 54 END AS gen, CASE l_returnflag WHEN 'R' THEN 61 WHEN 'A' THEN 54 ELSE 71 END AS exp,
    CASE l_returnflag WHEN 'R' THEN 3 WHEN 'A' THEN 2 ELSE 4 END AS n, l_linenumber::INT AS m, (l_quantity / 64)::FLOAT AS x1 FROM lineitem)
"""
