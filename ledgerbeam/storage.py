"""Registered queries over files: parts and their index, bucketed tables, probes of files, reading that resumes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import adapters as A
from .catalog import COUNTERS, query
from .functions.store import scratch, stored
from .operators import audit, wide
from .plans.audited import audit_files
from .plans.verdict import Refused
from .sources import manifest, parts, probe
from .streaming import incremental


@query(f"SELECT {COUNTERS} FROM matched")
def audit_by_parts(spark: SparkSession, d: str) -> DataFrame:
    """The audit's counters from a lookup in sorted parts by their index."""
    out = scratch(spark, "parts")
    parts.write_parts(A.sidecar(spark, d).select(*audit.KEY, *audit.PAYLOAD), out, 1000)
    return audit.counters(parts.lookup(A.nano(spark, d), out))


@query("""
, p AS (SELECT *, (row_number() OVER (ORDER BY run, lumi, event) - 1) // 500 AS part FROM sidecar), q AS (SELECT * FROM sidecar WHERE ev % 1000 < 3 AND lumi = (SELECT max(lumi) // 2 FROM sidecar))
SELECT (SELECT count(DISTINCT part) FROM p JOIN q USING (run, lumi, event)) AS parts, count(*) AS matched, sum(exp)::BIGINT AS codes FROM q""")
def narrow_lookup(spark: SparkSession, d: str) -> DataFrame:
    """A few keys of one block: how many parts are read, and what is found."""
    side, out = A.sidecar(spark, d), scratch(spark, "parts")
    parts.write_parts(side.select(*audit.KEY, *audit.PAYLOAD), out, 500)
    middle = side.agg(F.call_function("div", F.max("luminosityBlock"), F.lit(2)).alias("m")).first()["m"]
    probe = side.where((F.col("luminosityBlock") == middle) & (F.col("ev") % 1000 < 3)).select(*audit.KEY)
    hit = parts.parts_hit(probe, out, exact=True)
    found = audit.match(probe, parts.read_parts(spark, out, hit)).where(F.col("side").isNotNull())
    return found.agg(F.lit(len(hit)).cast("bigint").alias("parts"), F.count("*").alias("matched"), F.sum("side.Expanded_genTtbarId").alias("codes"))


@query(f"SELECT {COUNTERS} FROM matched")
def audit_bucketed(spark: SparkSession, d: str) -> DataFrame:
    """The audit's counters from a sidecar that lies in buckets; it isn't exchanged."""
    path = scratch(spark, "buckets")
    table = parts.write_bucketed(A.sidecar(spark, d).select(*audit.KEY, *audit.PAYLOAD), path, f"sidecar_{path.rsplit('-', 1)[1]}", 16)
    return audit.counters(audit.match(A.nano(spark, d), parts.open_bucketed(spark, table)))


def _split(spark: SparkSession, d: str, n: int) -> tuple[str, list[str]]:
    """orders in n folders of files by key, in the shared folder."""
    out = scratch(spark, "files")
    A.table(spark, d, "orders").withColumn("k", F.col("o_orderkey") % n).repartition("k").write.partitionBy("k").parquet(out)
    return out, [f"{out}/k={k}" for k in range(n)]


@query("""
SELECT 'k=' || (o_orderkey % 6) AS file, 'ok' AS status, count(*) AS rows, 0 AS round FROM orders GROUP BY ALL
UNION ALL SELECT 'k=6', 'bad_open', NULL, 1 UNION ALL SELECT 'k=7', 'no_table', NULL, 0 UNION ALL SELECT 'k=8', 'bad_columns', (SELECT count(*) FROM supplier), 0 UNION ALL SELECT 'k=9', 'empty', 0, 0""")
def probed_files(spark: SparkSession, d: str) -> DataFrame:
    """States of files that are there, lost, no tables, without a column, or empty; the lost one is tried twice."""
    out, files = _split(spark, d, 6)
    A.table(spark, d, "orders").limit(3).write.json(f"{out}/k=7")
    A.table(spark, d, "supplier").write.parquet(f"{out}/k=8")
    A.table(spark, d, "orders").where("false").coalesce(1).write.parquet(f"{out}/k=9")
    states = probe.probe(probe.table_of(spark, [*files, *(f"{out}/k={k}" for k in range(6, 10))]), ["o_orderkey"], attempts=2, wait=0.01)
    return states.select(F.regexp_extract("file", "k=[0-9]+$", 0).alias("file"), "status", "rows", "round")


@query("""
, f AS (SELECT unnest(range(13)) AS k) SELECT * FROM (SELECT 'k=' || k AS file, CASE WHEN k % 2 = 1 THEN 'bad_open' ELSE 'bad_columns' END AS status, (SELECT count(DISTINCT o_orderkey % 13) FROM orders)::BIGINT AS bad_files FROM f) ORDER BY file LIMIT 10""")
def first_bad_files(spark: SparkSession, d: str) -> DataFrame:
    """The first ten by name of the files that can't be used, and how many there are: every other one is lost, the rest lack a column."""
    _, files = _split(spark, d, 13)
    states = probe.probe(probe.table_of(spark, [f + ("" if k % 2 == 0 else "/lost") for k, f in enumerate(files)]), ["l_orderkey"], attempts=1)
    named = states.withColumn("file", F.regexp_extract("file", "k=[0-9]+", 0))
    return probe.bad_files(named).select("file", "status", "bad_files")


@query("SELECT count(*) AS rows, sum(o_orderkey)::BIGINT AS keys, 7 AS files, 0 AS lost FROM orders")
def resumed_read(spark: SparkSession, d: str) -> DataFrame:
    """A table read by row groups with a ledger of what was counted, checked against the footers."""
    _, files = _split(spark, d, 7)
    states = probe.probe(probe.table_of(spark, files), ["o_orderkey"], attempts=1)
    rows, ledger = probe.read(states, A.table(spark, d, "orders").select("o_orderkey").schema)
    done = ledger.agg(F.sum("read").alias("n"), F.countDistinct("file").cast("int").alias("files"), F.count_if(F.col("read").isNull()).cast("int").alias("lost"))
    manifest.check_complete(done.first()["n"], probe.opened(states, files).total)
    sums = rows.agg(F.count("*").alias("rows"), F.sum("o_orderkey").alias("keys"))
    return sums.withColumn("_k", F.lit(1)).join(done.withColumn("_k", F.lit(1)), "_k").select("rows", "keys", "files", "lost")


@query("""
, n AS (SELECT o_custkey, count(*) AS n, count(*) FILTER (WHERE o_orderkey % 40 = 3) AS changed, count(*) FILTER (WHERE o_orderkey % 40 = 7) AS dropped FROM orders GROUP BY o_custkey)
SELECT * FROM (SELECT 'prices' AS name, count(*) AS compared, count(*) FILTER (WHERE changed + dropped > 0) AS mismatches FROM n
  UNION ALL SELECT 'keys', count(*), count(*) FILTER (WHERE dropped > 0) FROM n UNION ALL SELECT 'n', count(*), count(*) FILTER (WHERE dropped > 0) FROM n)""")
def wide_arrays(spark: SparkSession, d: str) -> DataFrame:
    """Columns that are arrays: values that are off by more than the tolerance, and arrays of another length."""
    o = A.table(spark, d, "orders").select("o_orderkey", "o_custkey", F.col("o_totalprice").alias("p"))
    k = F.col("o_orderkey")
    by = lambda df: df.groupBy("o_custkey").agg(F.sort_array(F.collect_list(F.struct("o_orderkey", "p"))).alias("a")).select(
        "o_custkey", F.transform("a", lambda x: x["p"]).alias("prices"), F.transform("a", lambda x: x["o_orderkey"]).alias("keys"), F.size("a").alias("n")
    )
    right = o.where(k % 40 != 7).withColumn("p", F.when(k % 40 == 3, F.col("p") * 1.001).when(k % 40 == 4, F.col("p") * 1.0001).otherwise(F.col("p")))
    # customers whose orders are all dropped stay, with empty arrays
    rest = by(o).join(right.select("o_custkey").distinct(), "o_custkey", "left_anti")
    empty = rest.select("o_custkey", F.slice("prices", 1, 0).alias("prices"), F.slice("keys", 1, 0).alias("keys"), F.lit(0).alias("n"))
    return wide.value_mismatches(by(o), by(right).unionByName(empty), ["o_custkey"]).select("name", "compared", "mismatches")


@query("""
SELECT 'c' || c AS name, (SELECT count(*) FROM part) AS compared, (SELECT count(*) FROM part WHERE p_partkey % 1000 = c)::BIGINT AS mismatches FROM range(1666) t(c)""")
def wide_many_columns(spark: SparkSession, d: str) -> DataFrame:
    """1,666 columns of four types, arrays among them; column c differs where the key's remainder by 1,000 is c."""
    rows = A.table(spark, d, "part").select(F.col("p_partkey").alias("k"))
    # what columns share is computed before them, as every task compiles all 1,666; _l is the left value, _r what the right one differs by
    parts = [f"{x} AS {n}_{side}" for side, k in (("l", "k"), ("r", "(k + 100000)")) for n, x in (("i", k), ("d", f"double({k})"), ("s", f"concat('v', {k})"), ("f", f"float({k} % 7)"))]
    # dealt while the rows are narrow, so that both tables lie by key and no wide row is exchanged; a row of both has some 55 KB
    rows = rows.selectExpr("k", "k % 1000 AS m", *parts).repartition(max(spark.sparkContext.defaultParallelism, -(-rows.count() // 2000)), "k")
    made = lambda c, x: (f"{x('i')} + {c}", f"{x('d')} + {c}D", x("s"), f"array({x('f')}, float({c}))")[c % 4] + f" AS c{c}"
    left = rows.selectExpr("k", *(made(c, lambda n: f"{n}_l") for c in range(1666)))
    right = rows.selectExpr("k", *(made(c, lambda n: f"if(m = {c}, {n}_r, {n}_l)" if c < 1000 else f"{n}_l") for c in range(1666)))
    return wide.value_mismatches(left, right, ["k"]).select("name", "compared", "mismatches")


@query(f"""
, b AS (SELECT count(*) FILTER (WHERE ev % 3 = 0) + count(*) FILTER (WHERE ev % 100 < 2) + count(*) FILTER (WHERE ev % 50 = 7) AS extra FROM sidecar) SELECT {COUNTERS}, (SELECT extra FROM b) AS n_dup FROM matched""")
def incremental_repeats(spark: SparkSession, d: str) -> DataFrame:
    """The audit of a sidecar in five batches, of which later ones repeat keys of earlier ones and one repeats its own, against a reference in parts."""
    out, side, reference = scratch(spark, "incremental"), stored(A.sidecar(spark, d)), stored(A.nano(spark, d))
    batches = [side.where("ev % 3 = 0"), side.where("ev % 3 = 1"), side.where("ev % 3 = 0 or ev % 3 = 2"), side.where("ev % 100 < 2"), side.where("ev % 50 = 7")]
    for b in batches:
        incremental.write_batch(b, f"{out}/in")
    parts.write_parts(reference, f"{out}/reference", 1000)
    rows = incremental.stream(spark, f"{out}/in", side.schema, incremental.FILES)
    incremental.incremental_counters(rows, f"{out}/reference", f"{out}/by_batch", f"{out}/checkpoint").awaitTermination()
    return incremental.totals(spark, f"{out}/by_batch", reference)


@query("""
, n AS (SELECT count(*) AS n FROM sidecar), f AS (SELECT count(*) AS n FROM sidecar WHERE ev % 4 <> 3)
SELECT 'all well' AS run, 0 AS code, n AS rows, false AS indicative FROM n UNION ALL SELECT 'a lost file', 4, NULL, NULL UNION ALL SELECT 'a lost file left out', 0, n, true FROM f UNION ALL SELECT 'a file twice', 2, NULL, NULL
UNION ALL SELECT 'a column is lacking', 5, NULL, NULL UNION ALL SELECT 'codes differ', 6, n, false FROM n UNION ALL SELECT 'a key twice', 7, n, false FROM n UNION ALL SELECT 'nothing matches', 5, n, false FROM n UNION ALL SELECT 'another run', 9, n, false FROM n""")
def audited_files(spark: SparkSession, d: str) -> DataFrame:
    """The whole audit over lists of files: what it ends with, the rows it read, and whether they stand for the sample."""
    # stored: seven tables are made of it
    side, out = stored(A.sidecar(spark, d)), scratch(spark, "audited")
    keep, k = [*audit.KEY, *audit.PAYLOAD], F.col("ev") % 4

    def files(name: str, rows: DataFrame) -> list[str]:
        # each task writes what it has of every folder, so none holds a whole one
        rows.write.partitionBy("_k").parquet(f"{out}/{name}")
        return [f"{out}/{name}/_k={i}" for i in range(4)]

    whole = side.select(*keep, k.alias("_k"))
    good, nano = files("side", whole), files("nano", whole.select(*audit.KEY, "genTtbarId", "_k"))
    changed = files("changed", whole.withColumn("genTtbarId", F.col("genTtbarId") + F.when(F.col("event") == 8, 1).otherwise(0)).select(*audit.KEY, "genTtbarId", "_k"))
    far = files("far", whole.select("run", (F.col("luminosityBlock") + 10**7).alias("luminosityBlock"), "event", "genTtbarId", "_k"))
    other = files("other", whole.select((F.col("run") + 1).alias("run"), "luminosityBlock", "event", "genTtbarId", "_k"))
    twice = files("twice", whole.unionByName(whole.where("event = 8")))
    narrow = files("narrow", whole.drop("nAddBJets"))
    lost = [*nano[:3], f"{out}/nano/lost"]
    runs = {
        "all well": (nano, good, False), "a lost file": (lost, good, False), "a lost file left out": (lost, good, True), "a file twice": ([*nano, nano[0].replace("/_k", "//_k")], good, False), "a column is lacking": (nano, narrow, False),
        "codes differ": (changed, good, False), "a key twice": (nano, twice, False), "nothing matches": (far, good, False), "another run": (other, good, False),
    }
    rows = []
    for name, (left, right, allow) in runs.items():
        try:
            v = audit_files(spark, left, right, attempts=1, allow_missing=allow)
            rows.append((name, v.code, v.counters["nano_entries_opencheck"], v.counters["indicative"]))
        except Refused as e:
            rows.append((name, e.code, None, None))
    return spark.createDataFrame(rows, "run string, code int, rows bigint, indicative boolean")
