"""Registered queries over samples, lineage, lists of files and reports."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import adapters as A
from .catalog import CHUNKS, FILES, RANKED, _chunks, query
from .functions import codec
from .functions.store import scratch
from .operators import audit, campaign, extract, order
from .plans.verdict import Refused
from .sources import manifest, sinks


@query(f"""{CHUNKS}, plan AS (SELECT 's' || (range % 4) AS sample, CASE WHEN range = 5 THEN 45 ELSE range END AS chunk FROM range(20)),
u AS (SELECT sample, sum(nano_entries)::BIGINT AS entries FROM chunks c WHERE (sample, chunk) IN (SELECT sample, chunk FROM plan) GROUP BY sample),
m AS (SELECT sample, count(*) AS lost FROM plan WHERE (sample, chunk) NOT IN (SELECT sample, chunk FROM chunks) GROUP BY sample)
SELECT 's' || k AS sample, k < 4 AND m.lost IS NULL AS chunks_present, k < 4 AND coalesce(entries = (SELECT count(*) FROM nano WHERE chunk % 4 = k), false) AS events_expected
FROM range(5) t(k) LEFT JOIN u ON u.sample = 's' || k LEFT JOIN m ON m.sample = 's' || k""")
def chunk_identity(spark: SparkSession, d: str) -> DataFrame:
    """Chunks by their ids: where another chunk came than the one that is expected, as many chunks are there and yet one is missing."""
    k = F.col("id")
    sizes = A.nano(spark, d).groupBy(F.concat(F.lit("s"), F.col("chunk") % 4).alias("sample")).agg(F.count("*").alias("n_events"))
    expected = spark.range(5).select(F.concat(F.lit("s"), k).alias("sample"), F.lit(False).alias("skip")).join(sizes, "sample", "left")
    plan = spark.range(20).select(F.concat(F.lit("s"), k % 4).alias("sample"), F.when(k == 5, 45).otherwise(k).alias("chunk"))
    return campaign.sample_verdict(_chunks(spark, d), expected, plan).select("sample", "chunks_present", "events_expected")


_ERA = "'RunIISummer20UL' || CASE WHEN k % 2 = 0 THEN '18' ELSE '16' END"


@query(f"""
, e AS (SELECT s_suppkey AS k, '/P' || s_suppkey || '/' || {_ERA} AS head FROM supplier),
c AS (SELECT k, CASE k % 7 WHEN 0 THEN '/P' || k || '/RunIISummer20UL17NanoAODv9-a-v1/NANOAODSIM' WHEN 1 THEN head || 'NanoAODv2-mc_v9-v1/NANOAODSIM' WHEN 2 THEN head || 'NanoAODAPVv9-a-v2/NANOAODSIM'
  WHEN 3 THEN '/Q' || k || '/' || {_ERA} || 'NanoAODv9-a-v1/NANOAODSIM' ELSE head || 'NanoAODv9-a-v3/NANOAODSIM' END AS child, k % 5 <> 0 AS own FROM e)
SELECT 'e' || k AS entry, CASE WHEN own AND k % 7 NOT IN (1) THEN 'SAME_PARENT' WHEN NOT own AND k % 7 IN (2, 4, 5, 6) THEN 'DIFFERENT_PARENT' ELSE 'VERSION_ABSENT' END AS status,
  CASE WHEN own AND k % 7 NOT IN (1) OR NOT own AND k % 7 IN (2, 4, 5, 6) THEN child END AS child, CASE WHEN k % 3 = 0 THEN CASE WHEN own THEN 'IN_CHILD_LIST' ELSE 'NOT_IN_CHILD_LIST' END END AS recorded FROM c""")
def lineage_verdicts(spark: SparkSession, d: str) -> DataFrame:
    """Children of the wanted version from the entry's own parent, from another parent of its era, or none; and recorded children."""
    k = F.col("s_suppkey")
    era = F.concat(F.lit("RunIISummer20UL"), F.when(k % 2 == 0, "18").otherwise("16"))
    head = F.concat(F.lit("/P"), k, F.lit("/"), era)
    child = (
        F.when(k % 7 == 0, F.concat(F.lit("/P"), k, F.lit("/RunIISummer20UL17NanoAODv9-a-v1/NANOAODSIM"))).when(k % 7 == 1, F.concat(head, F.lit("NanoAODv2-mc_v9-v1/NANOAODSIM")))
        .when(k % 7 == 2, F.concat(head, F.lit("NanoAODAPVv9-a-v2/NANOAODSIM"))).when(k % 7 == 3, F.concat(F.lit("/Q"), k, F.lit("/"), era, F.lit("NanoAODv9-a-v1/NANOAODSIM")))
        .otherwise(F.concat(head, F.lit("NanoAODv9-a-v3/NANOAODSIM")))
    )
    rows = A.table(spark, d, "supplier").select(F.concat(F.lit("e"), k).alias("entry"), F.concat(head, F.lit("MiniAODv2-x-v2/MINIAODSIM")).alias("parent"), F.lit("v9").alias("version"), child.alias("child"), k)
    entries = rows.select("entry", "parent", "version", F.when(k % 3 == 0, F.col("child")).alias("recorded"))
    children = rows.select("entry", "child", F.when(k % 5 == 0, F.concat(head, F.lit("MiniAODv1-x-v1/MINIAODSIM"))).otherwise(F.col("parent")).alias("parent"))
    return campaign.lineage_verdicts(entries, children)


@query("SELECT 'f' || s_suppkey AS file FROM supplier WHERE s_suppkey % 5 <> 0")
def manifest_files(spark: SparkSession, d: str) -> DataFrame:
    """A list of files in text, with remarks, blank lines and blanks around names."""
    k, out = F.col("s_suppkey"), scratch(spark, "list")
    lines = F.when(k % 10 == 0, F.concat(F.lit("# f"), k)).when(k % 5 == 0, F.lit("  ")).otherwise(F.concat(F.when(k % 3 == 0, "  ").otherwise(""), F.lit("f"), k, F.lit(" ")))
    A.table(spark, d, "supplier").select(lines).coalesce(1).write.text(out)
    return spark.createDataFrame([(f,) for f in manifest.read_manifest(spark, out)], "file string")


@query(f"""{RANKED} SELECT 'data' AS "table", count(*) AS rows FROM w2 WHERE rank = 1 AND exp IN (61, 71) UNION ALL SELECT 'lookup_format', 1 UNION ALL SELECT 'nano_datasets', 2 UNION ALL SELECT 'sources', count(DISTINCT ord) FROM items
UNION ALL SELECT 'refused twice', 4""")
def staged_lookup(spark: SparkSession, d: str) -> DataFrame:
    """A lookup table and what is to lie beside it, written all or none; a second time it is refused."""
    rank, out = extract.ranked(A.prioritised(spark, d), 2), scratch(spark, "lookup")
    fs, path, _ = sinks._store(spark, out)
    fs.mkdirs(path.getParent())
    tables = {"data": extract.lookup(rank).select("datasetIdx", *extract.KEY, *audit.PAYLOAD)} | sinks.lookup_metadata(spark, 2, ["/A/B/NANOAODSIM", "/A/C/NANOAODSIM"], extract.sources(rank))
    sinks.write_staged(tables, out)
    code = 0
    try:
        sinks.write_staged(tables, out)
    except Refused as e:
        code = e.code
    found = spark.createDataFrame([("refused twice", code)], "table string, rows bigint")
    for name in tables:
        found = found.unionByName(spark.read.parquet(f"{out}/{name}").agg(F.lit(name).alias("table"), F.count("*").alias("rows")))
    return found


@query("""
, o AS (SELECT dense_rank() OVER (ORDER BY s_nationkey) - 1 AS idx, s_nationkey FROM (SELECT DISTINCT s_nationkey FROM supplier)) SELECT idx::INT AS "datasetIdx", '/N' || s_nationkey || '/B/NANOAODSIM' AS dataset FROM (SELECT row_number() OVER (ORDER BY '/N' || s_nationkey || '/B/NANOAODSIM') - 1 AS idx, s_nationkey FROM o)""")
def dataset_list(spark: SparkSession, d: str) -> DataFrame:
    """Datasets by number, as they lie beside a lookup table; their order is that of their names."""
    names = [f"/N{r[0]}/B/NANOAODSIM" for r in A.table(spark, d, "supplier").select("s_nationkey").distinct().collect()]
    empty = spark.createDataFrame([], "dataset string")
    return sinks.lookup_metadata(spark, 2, names, empty)["nano_datasets"]


@query(f"{FILES} SELECT file, sorted::VARCHAR AS sorted, out_of_order::VARCHAR AS out_of_order, \"overlaps\"::VARCHAR AS overlaps FROM v")
def order_report(spark: SparkSession, d: str) -> DataFrame:
    """The order report as text with a header, read back."""
    out = scratch(spark, "order")
    sinks.order_csv(order.file_overlap(order.file_order(A.ordered_files(spark, d, permuted=True))), out)
    return spark.read.csv(out, header=True)


@query("SELECT r_name AS era, n_name AS name, '/P' || n_nationkey || '/R/NANOAODSIM' AS dataset, n_nationkey % 2 = 0 AS enabled, n_nationkey::INT AS units_per_job FROM nation JOIN region ON n_regionkey = r_regionkey")
def catalogue_text(spark: SparkSession, d: str) -> DataFrame:
    """The catalogue of eras and entries from its text."""
    rows = A.table(spark, d, "nation").join(A.table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).collect()
    tree: dict = {}
    for r in rows:
        k = r["n_nationkey"]
        tree.setdefault(r["r_name"], {"datasets": []})["datasets"].append({"name": r["n_name"], "dataset": f"/P{k}/R/NANOAODSIM", "enabled": k % 2 == 0, "units_per_job": k})
    return manifest.catalogue(spark, json.dumps(tree)).select("era", "name", "dataset", "enabled", "units_per_job")


@query("SELECT 'k=' || (o_orderkey % 4) AS folder, true AS filled FROM orders GROUP BY ALL")
def walked_files(spark: SparkSession, d: str) -> DataFrame:
    """Files below a folder by the beginning of their names; marks of writers and other files are passed over."""
    out = scratch(spark, "walk")
    A.table(spark, d, "orders").withColumn("k", F.col("o_orderkey") % 4).repartition("k").write.partitionBy("k").parquet(out)
    A.table(spark, d, "nation").write.option("header", True).csv(f"{out}/other")
    found = manifest.walk(spark, out, ("part-",)).where(F.col("path").endswith(".parquet"))
    return found.select(F.regexp_extract("path", "k=[0-9]+", 0).alias("folder"), (F.col("length") > 0).alias("filled"))


@query("""
, s AS (SELECT exp % 100 AS k, count(*) AS n FROM sidecar GROUP BY ALL), r AS (SELECT lumi AS k, count(*) AS n FROM sidecar GROUP BY ALL)
SELECT '{"by_block": {' || (SELECT string_agg('"' || k || '": ' || n, ', ' ORDER BY k) FROM r) || '}, "by_sub": {' || (SELECT string_agg('"' || k || '": ' || n, ', ' ORDER BY k) FROM s) || '}}' AS value""")
def sorted_maps(spark: SparkSession, d: str) -> DataFrame:
    """Counts by code and by block as maps in a report, their keys in order of number."""
    side = A.sidecar(spark, d)
    count = lambda key: {r["k"]: r["n"] for r in side.groupBy(key.alias("k")).agg(F.count("*").alias("n")).collect()}
    maps = {"by_block": count(F.col("luminosityBlock")), "by_sub": count(codec.sub_code("Expanded_genTtbarId"))}
    return spark.createDataFrame([(sinks.maps_json(maps),)], "value string")


@query(r"""
, t AS (SELECT CASE p_partkey % 8 WHEN 0 THEN '/A' || p_partkey || '/B/NANOAODSIM=l.txt' WHEN 1 THEN '/A' || p_partkey || '/B/NANOAODSIM=l.txt:' || p_partkey WHEN 2 THEN '/A' || p_partkey || '/B/NANOAODSIM=l.txt:1234567' WHEN 3 THEN '/A' || p_partkey || '/B/MINIAODSIM=l'
  WHEN 4 THEN '/A' || p_partkey || '/B/NANOAODSIM=' WHEN 5 THEN '/A' || p_partkey || '/B/NANOAODSIM=a:b:3' WHEN 6 THEN 'A' || p_partkey ELSE '/A' || p_partkey || '/B/NANOAODSIM=y=z:007' END AS text, p_partkey AS k FROM part)
SELECT text, CASE WHEN k % 8 IN (0, 1, 7) THEN '/A' || k || '/B/NANOAODSIM' END AS dataset, CASE WHEN k % 8 IN (0, 1) THEN 'l.txt' WHEN k % 8 = 7 THEN 'y=z' END AS manifest,
  CASE k % 8 WHEN 0 THEN 0 WHEN 1 THEN k::INT WHEN 7 THEN 7 END AS priority, CASE WHEN k % 8 IN (0, 1, 7) THEN 0 ELSE 2 END AS code FROM t""")
def table_specs(spark: SparkSession, d: str) -> DataFrame:
    """Inputs in a table's rows; what can't be read, or can be read in two ways, is refused."""
    k = F.col("p_partkey")
    a = F.concat(F.lit("/A"), k)
    forms = [F.concat(a, F.lit("/B/NANOAODSIM=l.txt")), F.concat(a, F.lit("/B/NANOAODSIM=l.txt:"), k), F.concat(a, F.lit("/B/NANOAODSIM=l.txt:1234567")), F.concat(a, F.lit("/B/MINIAODSIM=l")),
             F.concat(a, F.lit("/B/NANOAODSIM=")), F.concat(a, F.lit("/B/NANOAODSIM=a:b:3")), F.concat(F.lit("A"), k), F.concat(a, F.lit("/B/NANOAODSIM=y=z:007"))]
    return extract.specs(A.table(spark, d, "part").select(F.get(F.array(*forms), (k % 8).cast("int")).alias("text")))


@query("""
, f AS (SELECT s_suppkey // 2 AS k FROM supplier) SELECT '/store/x' || k || '/a.root' AS file, count(*) AS times FROM f GROUP BY k HAVING count(*) > 1""")
def table_repeats(spark: SparkSession, d: str) -> DataFrame:
    """Files that a table lists more than once, by other servers, with options, doubled slashes or dots."""
    k = F.col("s_suppkey")
    name = F.concat(F.lit("x"), F.call_function("div", k, F.lit(2)))
    forms = [F.concat(F.lit("root://a.example//store/"), name, F.lit("/a.root")), F.concat(F.lit("/store//"), name, F.lit("/./a.root?n=1")), F.concat(F.lit("file:///store/y/../"), name, F.lit("/b/../a.root")), F.concat(F.lit("https://b.example/store/"), name, F.lit("//a.root"))]
    return manifest.repeated(A.table(spark, d, "supplier").select(F.get(F.array(*forms), (k % 4).cast("int")).alias("path")))


@query("SELECT row_number() OVER (ORDER BY o_orderkey) + 2 AS at, 'ROW ' || o_orderkey || ' ' || o_custkey AS line FROM orders UNION ALL SELECT 0, 'NAMED made by' UNION ALL SELECT 1, 'LEAF o_orderkey bigint' UNION ALL SELECT 2, 'LEAF o_custkey bigint'")
def dumped_lines(spark: SparkSession, d: str) -> DataFrame:
    """A whole table as numbered lines."""
    rows = A.table(spark, d, "orders").select(F.col("o_orderkey").cast("bigint"), F.col("o_custkey").cast("bigint"))
    return sinks.dump_lines(rows, {"made": "by"})


@query("SELECT 'all well' AS run, 0 AS code UNION ALL SELECT 'a lost file', 1 UNION ALL SELECT 'a file that is no table', 1 UNION ALL SELECT 'a column is lacking', 1 UNION ALL SELECT 'an invariant', 2 UNION ALL SELECT 'an empty file', 0 FROM (SELECT count(*) FROM orders)")
def sample_file_codes(spark: SparkSession, d: str) -> DataFrame:
    """The verdict over a whole sample in several files: what it ends with where files or rows are wrong."""
    out = scratch(spark, "sample")
    side = A.sidecar(spark, d).select(*audit.KEY, *audit.PAYLOAD, (F.col("ev") % 5).alias("k"))
    side.repartition("k").write.partitionBy("k").parquet(f"{out}/in")
    files = [f"{out}/in/k={k}" for k in range(5)]
    side.where("false").drop("k").coalesce(1).write.parquet(f"{out}/empty")
    side.select("run").limit(4).write.parquet(f"{out}/narrow")
    side.limit(4).write.json(f"{out}/text")
    side.limit(4).drop("k").withColumn("Expanded_genTtbarId", F.lit(56)).withColumn("nAddBJets", F.lit(1)).write.parquet(f"{out}/broken")
    runs = {"all well": [], "a lost file": ["lost"], "a file that is no table": ["text"], "a column is lacking": ["narrow"], "an invariant": ["broken"], "an empty file": ["empty"]}
    rows = []
    for name, more in runs.items():
        every = [*files, *(f"{out}/{m}" for m in more)]
        states = manifest.file_statuses(spark, every, [*audit.KEY, *audit.PAYLOAD])
        good = [r["file"] for r in states.where("status in ('ok', 'empty')").collect()]
        held = spark.read.schema(side.drop("k").schema).option("recursiveFileLookup", True).parquet(*good).withColumn("file", F.regexp_replace(F.col("_metadata.file_path"), "(^file:(//)?)|(/[^/]*$)", ""))
        listed = spark.createDataFrame([(f.removeprefix("file:").replace("///", "/"),) for f in good], "file string")
        rows.append((name, audit.files_verdict(audit.by_file(held, listed), states).code))
    return spark.createDataFrame(rows, "run string, code int")


@query(f"""
, i AS (SELECT *, ord AS own FROM items WHERE ord = 0 OR lumi % 40 = 0), w AS (SELECT *, row_number() OVER o AS rank, row_number() OVER p AS own_rank, first(ord) OVER o AS ford, first(gen) OVER o AS fgen, first(exp) OVER o AS fexp
  FROM i WINDOW o AS (PARTITION BY lumi, event ORDER BY ord, pos), p AS (PARTITION BY lumi, event, ord ORDER BY pos))
SELECT ord, count(*) AS entries, count(*) FILTER (WHERE ord <> ford AND own_rank = 1) AS superseded, count(*) FILTER (WHERE own_rank > 1) AS repeated, count(*) FILTER (WHERE rank = 1 AND exp IN (61, 71)) AS written,
  count(*) FILTER (WHERE gen <> fgen OR exp <> fexp) AS conflicts FROM w GROUP BY ord""")
def patch_sparse(spark: SparkSession, d: str) -> DataFrame:
    """Priority where the inputs share few blocks: rows that are alone with their key are ranked without a window."""
    rows = A.prioritised(spark, d).where("ord = 0 or luminosityBlock % 40 = 0")
    rank = extract.ranked_sparse(rows, 2, most=1.0)
    sums = rank.groupBy("ord").agg(F.count_if("conflict").alias("conflicts"))
    return extract.sources(rank).select("ord", "entries", "superseded", "repeated", "written").join(sums, "ord")
