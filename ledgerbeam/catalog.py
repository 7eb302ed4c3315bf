"""The registered queries over the test tables, each with the SQL it is held against."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import adapters as A
from .functions import codec
from .functions.store import scratch, stored
from .operators import audit, campaign, derive, extract, hist, intervals, order, resolve, wide
from .plans.verdict import Refused, Verdict
from .sources import manifest, sinks
from .streaming import incremental

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    """Register a function under its name, with its SQL over the views of adapters."""

    def add(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = f"WITH {A.SQL}\n{sql}" if "FROM" in sql else sql
        return f

    return add


# Derivation and censuses ----------------------------------------------------------------------------------------------


@query("SELECT exp % 100 AS sub, count(*) AS n FROM sidecar GROUP BY ALL")
def expand_census(spark: SparkSession, d: str) -> DataFrame:
    return A.sidecar(spark, d).groupBy(codec.sub_code("Expanded_genTtbarId").alias("sub")).agg(F.count("*").alias("n"))


@query("SELECT gen % 100 AS gen_sub, exp % 100 AS exp_sub, count(*) AS n FROM sidecar GROUP BY ALL")
def expand_transitions(spark: SparkSession, d: str) -> DataFrame:
    return hist.transitions(A.sidecar(spark, d))


@query("SELECT gen % 100 AS gen_sub, " + ", ".join(f"count(*) FILTER (WHERE least(n, 6) = {i}) AS n{i}" for i in range(7)) + " FROM sidecar GROUP BY ALL")
def nadd_crosstab(spark: SparkSession, d: str) -> DataFrame:
    return hist.crosstab(A.sidecar(spark, d))


@query("SELECT ev, n AS \"nAddBJets\", m AS \"nAddBJetsMulti\" FROM counts")
def derive_jets(spark: SparkSession, d: str) -> DataFrame:
    return derive.count_jets(A.hadrons(spark, d))


@query("""
, jet AS (SELECT ev, jet_idx, max(pt) AS pt, min(abs(eta)) AS eta, count(*) FILTER (WHERE from_top) AS top, count(*) FILTER (WHERE NOT from_top) AS a FROM hadrons GROUP BY ALL)
SELECT ev, (count(*) FILTER (WHERE pt >= 20 AND eta <= 2.4 AND a > 0 AND top = 0))::INT AS n, (count(*) FILTER (WHERE pt >= 20 AND eta <= 2.4 AND a > 1 AND top = 0))::INT AS multi
FROM jet GROUP BY ev""")
def derive_nested(spark: SparkSession, d: str) -> DataFrame:
    """Counts from nested arrays, without exploding them."""
    h = A.hadrons(spark, d)
    jets = h.groupBy("ev", "jet_idx").agg(F.max("pt").alias("pt"), F.min(F.abs("eta")).alias("eta"))
    jets = jets.groupBy("ev").agg(F.sort_array(F.collect_list(F.struct("jet_idx", "pt", "eta"))).alias("jets"))
    flags = h.groupBy("ev").agg(F.collect_list(F.struct("jet_idx", "from_top")).alias("h"))
    one = jets.join(flags, "ev")
    idx = F.transform("h", lambda x: (F.array_position(F.transform("jets", lambda j: j["jet_idx"]), x["jet_idx"]) - 1).cast("int"))
    one = one.select("ev", "jets", idx.alias("idx"), F.transform("h", lambda x: x["from_top"]).alias("top"))
    return one.select("ev", derive.count_nested(F.col("jets"), F.col("idx"), F.col("top")).alias("c")).select("ev", "c.n", "c.multi")


@query("""SELECT CASE exp % 100 WHEN 0 THEN 'ttlf' WHEN 51 THEN 'ttb' WHEN 52 THEN 'tt2b' WHEN 61 THEN 'tt3b' WHEN 62 THEN 'tt3b' WHEN 71 THEN 'tt4b' WHEN 72 THEN 'tt4b'
  ELSE CASE WHEN exp % 100 BETWEEN 41 AND 45 THEN 'ttc' WHEN exp % 100 BETWEEN 53 AND 55 THEN 'ttbb' END END AS category, count(*) AS n FROM sidecar GROUP BY ALL""")
def category_census(spark: SparkSession, d: str) -> DataFrame:
    return A.sidecar(spark, d).groupBy(codec.category("Expanded_genTtbarId").alias("category")).agg(F.count("*").alias("n"))


@query("SELECT exp % 100 AS sub, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 9) AS percent FROM sidecar GROUP BY ALL")
def census_pct(spark: SparkSession, d: str) -> DataFrame:
    return audit.census(A.sidecar(spark, d), "Expanded_genTtbarId").withColumn("percent", F.round("percent", 9))


# Audit ----------------------------------------------------------------------------------------------------------------

COUNTERS = """count(*) AS nano_entries, count(*) FILTER (WHERE there) AS matched, count(*) FILTER (WHERE NOT there) AS unmatched, count(*) FILTER (WHERE run <> 1) AS run_not_1,
  count(*) FILTER (WHERE there AND gen = ngen) AS agree, count(*) FILTER (WHERE there AND gen <> ngen) AS disagree, count(*) FILTER (WHERE there AND n >= 3) AS "nAddBJets_ge3",
  count(*) FILTER (WHERE ext) AS expanded_sub_in_set, count(*) FILTER (WHERE ext AND n < 3) AS viol_ext_but_lt3, count(*) FILTER (WHERE there AND n >= 3 AND NOT ext) AS viol_ge3_not_ext,
  count(*) FILTER (WHERE ext AND exp // 100 <> gen // 100) AS viol_prefix_changed,
  count(*) FILTER (WHERE ext AND coalesce(exp % 100 <> CASE WHEN n = 3 THEN 61 WHEN n >= 4 THEN 71 END + CASE WHEN m >= 1 THEN 1 ELSE 0 END, true)) AS viol_wrong_sub,
  count(*) FILTER (WHERE there AND NOT ext AND exp <> gen) AS viol_unchanged, count(*) FILTER (WHERE there AND n < 3 AND exp <> gen) AS viol_le2_changed,
  abs(count(*) FILTER (WHERE there AND n >= 3) - count(*) FILTER (WHERE ext)) AS not_conserved"""


@query(f"SELECT {COUNTERS} FROM matched")
def audit_counters(spark: SparkSession, d: str) -> DataFrame:
    return audit.counters(audit.match(A.nano(spark, d), A.sidecar(spark, d)))


@query(f"SELECT chunk, {COUNTERS} FROM matched GROUP BY chunk")
def audit_by_chunk(spark: SparkSession, d: str) -> DataFrame:
    return audit.counters(audit.match(A.nano(spark, d), A.sidecar(spark, d)), "chunk")


@query("SELECT ngen % 100 AS nano_sub, count(*) AS n FROM matched WHERE there AND gen <> ngen GROUP BY ALL")
def audit_disagree_by_sub(spark: SparkSession, d: str) -> DataFrame:
    return audit.disagreements(audit.match(A.nano(spark, d), A.sidecar(spark, d)))


@query("SELECT run, lumi AS \"luminosityBlock\", event, ngen AS nano_gen, gen AS side_gen FROM matched WHERE there AND gen <> ngen ORDER BY 1, 2, 3 LIMIT 20")
def audit_mismatch_rows(spark: SparkSession, d: str) -> DataFrame:
    return audit.examples(audit.match(A.nano(spark, d), A.sidecar(spark, d)))


@query("SELECT gen % 100 AS side_origin, ngen % 100 AS nano_origin, count(*) AS n FROM matched WHERE ext GROUP BY ALL")
def origin_census(spark: SparkSession, d: str) -> DataFrame:
    return audit.reclassified(audit.match(A.nano(spark, d), A.sidecar(spark, d)))


@query("SELECT count(*) AS keys, coalesce(sum(c - 1), 0)::BIGINT AS extra FROM (SELECT count(*) AS c FROM sidecar GROUP BY run, event) WHERE c > 1")
def key2_collisions(spark: SparkSession, d: str) -> DataFrame:
    return audit.duplicates(A.sidecar(spark, d), ("run", "event")).agg(F.count("*").alias("keys"), F.coalesce(F.sum("extra"), F.lit(0)).alias("extra"))


@query("SELECT count(*) AS keys, coalesce(sum(c - 1), 0)::BIGINT AS extra FROM (SELECT count(*) AS c FROM sidecar GROUP BY run, lumi, event) WHERE c > 1")
def key3_collisions(spark: SparkSession, d: str) -> DataFrame:
    return audit.duplicates(A.sidecar(spark, d)).agg(F.count("*").alias("keys"), F.coalesce(F.sum("extra"), F.lit(0)).alias("extra"))


SELF = """count(*) AS entries, count(*) FILTER (WHERE n <= 2 AND exp <> gen) AS le2_changed, count(*) FILTER (WHERE n = 3 AND exp % 100 NOT IN (61, 62)) AS eq3_other,
  count(*) FILTER (WHERE n >= 4 AND exp % 100 NOT IN (71, 72)) AS ge4_other, count(*) FILTER (WHERE exp % 100 = 56) AS sub_56, count(*) FILTER (WHERE exp // 100 <> gen // 100) AS prefix_changed,
  count(*) FILTER (WHERE exp % 100 IN (61, 62, 71, 72) AND gen % 100 NOT IN (53, 54, 55)) AS other_origin, count(*) FILTER (WHERE run <> 1) AS run_not_1"""
BROKEN = """, broken AS (SELECT ev, cust, CASE WHEN ev % 103 = 0 THEN 2 ELSE run END AS run, n, m, gen,
  CASE WHEN ev % 101 = 0 THEN exp + 1 WHEN ev % 107 = 0 THEN exp + 100 WHEN ev % 109 = 0 THEN gen // 100 * 100 + 56 WHEN ev % 113 = 0 THEN gen // 100 * 100 + 61 ELSE exp END AS exp FROM sidecar)"""


def _broken(spark: SparkSession, d: str) -> DataFrame:
    s, ev, exp = A.sidecar(spark, d), F.col("ev"), F.col("Expanded_genTtbarId")
    base = codec.prefix("genTtbarId") * 100
    bad = F.when(ev % 101 == 0, exp + 1).when(ev % 107 == 0, exp + 100).when(ev % 109 == 0, base + 56).when(ev % 113 == 0, base + 61).otherwise(exp)
    return s.withColumns({"Expanded_genTtbarId": bad.cast("int"), "run": F.when(ev % 103 == 0, 2).otherwise(F.col("run"))})


@query(f"SELECT {SELF} FROM sidecar")
def invariants(spark: SparkSession, d: str) -> DataFrame:
    return audit.self_invariants(A.sidecar(spark, d))


@query(f"{BROKEN} SELECT {SELF} FROM broken")
def invariants_corrupted(spark: SparkSession, d: str) -> DataFrame:
    return audit.self_invariants(_broken(spark, d))


@query(f"""{BROKEN}, x AS (SELECT 'f' || (cust % 20) AS file, {SELF} FROM broken GROUP BY ALL)
SELECT file, {", ".join(f"coalesce({c}, 0) AS {c}" for c in ("entries", "le2_changed", "eq3_other", "ge4_other", "sub_56", "prefix_changed", "other_origin", "run_not_1"))}, entries IS NULL AS empty
FROM (SELECT 'f' || range AS file FROM range(22)) LEFT JOIN x USING (file)""")
def invariants_by_file(spark: SparkSession, d: str) -> DataFrame:
    manifest = spark.range(22).select(F.concat(F.lit("f"), F.col("id")).alias("file"))
    return audit.by_file(_broken(spark, d).withColumn("file", F.concat(F.lit("f"), F.col("cust") % 20)), manifest)


@query(f"""{BROKEN}, y AS (SELECT *, CASE WHEN n <= 2 THEN gen ELSE gen // 100 * 100 + CASE WHEN n = 3 THEN 61 ELSE 71 END + CASE WHEN m >= 1 THEN 1 ELSE 0 END END AS want FROM broken)
SELECT count(*) AS rows, count(*) FILTER (WHERE exp <> want) AS rule, count(*) FILTER (WHERE exp // 100 <> gen // 100) AS prefix,
  count(*) FILTER (WHERE exp <> want) + count(*) FILTER (WHERE exp // 100 <> gen // 100) AS violations, coalesce(bool_or(exp % 100 IN (71, 72)), false) AS has_4b FROM y""")
def rule_violations(spark: SparkSession, d: str) -> DataFrame:
    return audit.rule_violations(_broken(spark, d))


@query(f"""{BROKEN}, m AS (SELECT nano.run, nano.lumi, nano.event, nano.gen AS ngen, s.gen, s.exp, s.n, s.m, s.run IS NOT NULL AS there, s.exp % 100 IN (61, 62, 71, 72) AS ext
  FROM nano LEFT JOIN (SELECT b.*, ev // 5000 AS lumi, ev % 5000 AS event FROM broken b) s ON s.run = nano.run AND s.lumi = nano.lumi AND s.event = nano.event) SELECT {COUNTERS} FROM m""")
def audit_corrupted(spark: SparkSession, d: str) -> DataFrame:
    return audit.counters(audit.match(A.nano(spark, d), _broken(spark, d)))


@query("""
, a AS (SELECT gen % 100 AS sub, count(*) AS a FROM nano GROUP BY ALL), b AS (SELECT exp % 100 AS sub, count(*) AS b FROM sidecar GROUP BY ALL),
c AS (SELECT sub, coalesce(a, 0) AS a, coalesce(b, 0) AS b, sub IN (53, 54, 55, 61, 62, 71, 72) AS moved, sub IN (61, 62, 71, 72) AS ext FROM a FULL JOIN b USING (sub)),
r AS (SELECT 'totals_equal' AS "check", sum(a)::BIGINT AS left_n, sum(b)::BIGINT AS right_n FROM c
  UNION ALL SELECT 'untouched_subs_equal', count(*) FILTER (WHERE NOT moved), count(*) FILTER (WHERE NOT moved AND a = b) FROM c
  UNION ALL SELECT 'bbb_conserved', coalesce(sum(a) FILTER (WHERE moved AND NOT ext), 0)::BIGINT, coalesce(sum(b) FILTER (WHERE moved), 0)::BIGINT FROM c
  UNION ALL SELECT 'reference_has_no_extension', coalesce(sum(a) FILTER (WHERE ext), 0)::BIGINT, 0 FROM c)
SELECT *, left_n = right_n AS holds FROM r""")
def spot_conservation(spark: SparkSession, d: str) -> DataFrame:
    return audit.conservation(A.nano(spark, d), A.sidecar(spark, d))


@query("SELECT l_orderkey, max_by(l_returnflag, (l_linenumber, l_partkey, l_suppkey, l_extendedprice)) AS l_returnflag, count(*) - 1 AS overwritten FROM lineitem GROUP BY ALL")
def last_wins_join(spark: SparkSession, d: str) -> DataFrame:
    rows = A.table(spark, d, "lineitem").withColumn("at", F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"))
    return audit.last_wins(rows, ("l_orderkey",), "at", "l_returnflag")


# Extraction -----------------------------------------------------------------------------------------------------------

RANKED = """
, w2 AS (SELECT *, row_number() OVER o AS rank, row_number() OVER p AS own, first(ord) OVER o AS ford, first(gen) OVER o AS fgen, first(exp) OVER o AS fexp, first(n) OVER o AS fn, first(m) OVER o AS fm
  FROM items WINDOW o AS (PARTITION BY lumi, event ORDER BY ord, pos), p AS (PARTITION BY lumi, event, ord ORDER BY pos)),
w3 AS (SELECT *, row_number() OVER o AS rank FROM items WINDOW o AS (PARTITION BY lumi, event, x1 ORDER BY ord, pos))"""


def _rank2(spark: SparkSession, d: str) -> DataFrame:
    return extract.ranked(A.prioritised(spark, d), 2)


def _rank3(spark: SparkSession, d: str) -> DataFrame:
    return extract.ranked(extract.with_bits(A.prioritised(spark, d)), 3)


@query("SELECT lumi AS \"luminosityBlock\", event, ord, gen AS \"genTtbarId\", exp AS \"Expanded_genTtbarId\", n AS \"nAddBJets\", m AS \"nAddBJetsMulti\" FROM items WHERE exp IN (61, 71)")
def patch_format1(spark: SparkSession, d: str) -> DataFrame:
    return extract.format1(A.prioritised(spark, d)).select("luminosityBlock", "event", "ord", *audit.PAYLOAD)


@query(f"{BROKEN} SELECT exp % 100 AS sub, n AS jets, count(*) AS rows FROM broken WHERE (exp % 100 IN (61, 62, 71, 72)) <> (n >= 3) GROUP BY ALL")
def patch_inconsistent(spark: SparkSession, d: str) -> DataFrame:
    bad = extract.inconsistent(_broken(spark, d))
    return bad.groupBy(codec.sub_code("Expanded_genTtbarId").alias("sub"), F.col("nAddBJets").alias("jets")).agg(F.count("*").alias("rows"))


@query(f"{RANKED} SELECT lumi AS \"luminosityBlock\", event, ord, gen AS \"genTtbarId\", exp AS \"Expanded_genTtbarId\", n AS \"nAddBJets\", m AS \"nAddBJetsMulti\" FROM w2 WHERE rank = 1 AND exp IN (61, 71)")
def patch_priority(spark: SparkSession, d: str) -> DataFrame:
    return extract.lookup(_rank2(spark, d)).select("luminosityBlock", "event", "ord", *audit.PAYLOAD)


@query(f"""{RANKED}, c AS (SELECT count(*) FILTER (WHERE gen <> fgen OR exp <> fexp) AS conflicts, count(*) FILTER (WHERE gen = fgen AND exp = fexp AND (n <> fn OR m <> fm)) AS other_counts,
  count(*) FILTER (WHERE own > 1) AS repeated FROM w2), s AS (SELECT count(*) AS shared FROM (SELECT 1 FROM items GROUP BY lumi, event HAVING min(ord) <> max(ord))) SELECT * FROM c, s""")
def patch_conflicts(spark: SparkSession, d: str) -> DataFrame:
    return extract.conflict_counts(_rank2(spark, d))


@query(f"""{RANKED} SELECT dataset, ord AS priority, ord, count(*) AS entries, count(*) FILTER (WHERE ord <> ford AND own = 1) AS superseded, count(*) FILTER (WHERE own > 1) AS repeated,
  count(*) FILTER (WHERE rank = 1 AND exp IN (61, 71)) AS written FROM w2 GROUP BY ALL""")
def patch_sources(spark: SparkSession, d: str) -> DataFrame:
    return extract.sources(_rank2(spark, d))


@query(f"""{RANKED} SELECT dataset, count(*) AS n, count(*) FILTER (WHERE exp = 61) AS n61, count(*) FILTER (WHERE exp = 62) AS n62, count(*) FILTER (WHERE exp = 71) AS n71,
  count(*) FILTER (WHERE exp = 72) AS n72 FROM w2 WHERE rank = 1 AND exp IN (61, 71) GROUP BY ROLLUP (dataset)""")
def patch_summary(spark: SparkSession, d: str) -> DataFrame:
    return extract.summary(extract.lookup(_rank2(spark, d)))


@query(f"{RANKED} SELECT gen AS gen_sub, count(*) AS n FROM w2 WHERE rank = 1 AND exp IN (61, 71) GROUP BY ALL")
def patch_by_origin(spark: SparkSession, d: str) -> DataFrame:
    return extract.by_origin(extract.lookup(_rank2(spark, d)))


@query(f"{RANKED} SELECT lumi AS \"luminosityBlock\", event, ord, x1 AS \"Generator_x1\", gen AS \"genTtbarId\", exp AS \"Expanded_genTtbarId\" FROM w3 WHERE rank = 1 AND exp IN (61, 71)")
def patch_events(spark: SparkSession, d: str) -> DataFrame:
    """Format 3: an event is its key and fingerprint."""
    return extract.lookup(_rank3(spark, d)).select("luminosityBlock", "event", "ord", "Generator_x1", "genTtbarId", "Expanded_genTtbarId")


@query(f"""{RANKED}, k AS (SELECT dataset, count(*) AS e, count(*) FILTER (WHERE exp IN (61, 71)) AS s FROM w3 WHERE rank = 1 GROUP BY dataset, lumi, event)
SELECT dataset, count(*) FILTER (WHERE e >= 2) AS multi_event_keys, count(*) FILTER (WHERE s >= 2) AS multi_selected_keys FROM k GROUP BY dataset""")
def multi_event_keys(spark: SparkSession, d: str) -> DataFrame:
    return extract.multi_event_keys(_rank3(spark, d))


@query(f"""{RANKED}, p AS (SELECT lumi, event, exp, ((x1 * 64)::INT // 2 * 2 / 64 * CASE WHEN (x1 * 64)::INT % 2 = 1 THEN 1.00048828125 ELSE 1 END)::FLOAT AS x FROM w3),
f AS (SELECT lumi, event, x, min(exp) AS exp FROM p GROUP BY ALL)
SELECT a.lumi AS "luminosityBlock", a.event, a.x AS x, b.x AS y FROM f a JOIN f b ON a.lumi = b.lumi AND a.event = b.event AND a.x < b.x
WHERE (a.exp IN (61, 71) OR b.exp IN (61, 71)) AND abs(a.x::DOUBLE - b.x::DOUBLE) <= 0.0009765625 * greatest(abs(a.x), abs(b.x))::DOUBLE""")
def too_close_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Fractions drawn together in pairs 2**-11 apart, so that some events of a key come too close."""
    k = (F.col("Generator_x1") * 64).cast("int")
    moved = ((k - k % 2) / 64 * F.when(k % 2 == 1, F.lit(1 + 2.0**-11)).otherwise(1.0)).cast("float")
    rows = A.prioritised(spark, d).withColumns({"Generator_x1": moved, "priority": F.col("Expanded_genTtbarId")})
    pairs = extract.too_close(extract.ranked(extract.with_bits(rows), 3))
    x, y = F.col("a.Generator_x1"), F.col("b.Generator_x1")
    return pairs.select("luminosityBlock", "event", F.least(x, y).alias("x"), F.greatest(x, y).alias("y"))


# Resolution -----------------------------------------------------------------------------------------------------------


def _lookup(spark: SparkSession, d: str) -> DataFrame:
    return A.sidecar(spark, d).where(codec.is_ttnb("Expanded_genTtbarId") & (F.col("ev") % 3 != 0))


@query("""
, r AS (SELECT nano.gen AS own, s.exp, s.gen, s.exp IS NOT NULL AS hit FROM nano LEFT JOIN (SELECT * FROM sidecar WHERE exp % 100 IN (61, 62, 71, 72) AND ev % 3 <> 0) s
  ON s.lumi = nano.lumi AND s.event = nano.event)
SELECT count(*) FILTER (WHERE hit) AS hits, count(*) FILTER (WHERE NOT hit) AS misses, count(*) FILTER (WHERE hit AND gen <> own) AS mismatches, """ + ", ".join(f"count(*) FILTER (WHERE hit AND exp % 100 = {s}) AS n{s}" for s in codec.TTNB) + " FROM r")
def resolve_override(spark: SparkSession, d: str) -> DataFrame:
    return resolve.counters(resolve.resolve(A.nano(spark, d), _lookup(spark, d)))


@query("""
, l AS (SELECT lumi, event, exp, ev % 5 AS k, CASE WHEN ev % 5 = 2 THEN x2 WHEN ev % 5 = 3 THEN (x1 * 1.0001220703125)::FLOAT ELSE x1 END AS x1, CASE WHEN ev % 5 = 2 THEN x1 ELSE x2 END AS x2,
  CASE WHEN ev % 5 = 1 THEN id1 + 1 ELSE id1 END AS id1, id2 FROM sidecar WHERE exp % 100 IN (61, 62, 71, 72) AND ev % 3 <> 0),
j AS (SELECT s.ev, s.gen, l.exp, l.exp IS NOT NULL AS there, s.x1 = l.x1 AND s.x2 = l.x2 AS same, s.id1 = l.id1 AND s.id2 = l.id2 AS ids, s.x1 = l.x2 AND s.x2 = l.x1 AS swapped,
  abs(s.x1::DOUBLE - l.x1) <= 0.00048828125 * greatest(abs(s.x1), abs(l.x1)) AND abs(s.x2::DOUBLE - l.x2) <= 0.00048828125 * greatest(abs(s.x2), abs(l.x2)) AS near FROM sidecar s LEFT JOIN l USING (lumi, event)),
t AS (SELECT *, CASE WHEN NOT there THEN 'miss' WHEN same AND ids THEN 'hit' WHEN ids AND near AND NOT same THEN 'E84' WHEN same AND NOT ids OR swapped AND NOT same THEN 'E85' ELSE 'other_event' END AS status FROM j)
SELECT status, CASE WHEN status = 'hit' THEN exp ELSE gen END % 100 AS sub, count(*) AS n FROM t GROUP BY ALL""")
def resolve_fingerprint(spark: SparkSession, d: str) -> DataFrame:
    k, x1, x2 = F.col("ev") % 5, F.col("Generator_x1"), F.col("Generator_x2")
    held = _lookup(spark, d).withColumns({
        "Generator_x1": F.when(k == 2, x2).when(k == 3, (x1 * F.lit(1 + 2.0**-13)).cast("float")).otherwise(x1), "Generator_x2": F.when(k == 2, x1).otherwise(x2),
        "Generator_id1": F.when(k == 1, F.col("Generator_id1") + 1).otherwise(F.col("Generator_id1")),
    })
    # rounding 14 bits keeps all of these values apart
    out = resolve.resolve_events(extract.with_bits(A.sidecar(spark, d)), extract.with_bits(held), "ev")
    return out.groupBy("status", codec.raw_sub_code("resolved").alias("sub")).agg(F.count("*").alias("n"))


@query("""SELECT cust % 2 = 0 AS dedicated, exp % 100 AS sub, (cust % 2 = 0) = (exp % 100 IN (61, 62, 71, 72)) AS keep, CASE WHEN (cust % 2 = 0) = (exp % 100 IN (61, 62, 71, 72)) THEN 1.0 ELSE 0.0 END::DOUBLE AS multiplier,
  count(*) AS n FROM sidecar GROUP BY ALL""")
def stitch_keep(spark: SparkSession, d: str) -> DataFrame:
    rows = A.sidecar(spark, d).withColumn("sample", F.when(F.col("cust") % 2 == 0, "tt4b").otherwise("tt"))
    out = resolve.stitch(rows, "sample", "tt4b", "Expanded_genTtbarId")
    return out.groupBy((F.col("sample") == "tt4b").alias("dedicated"), codec.sub_code("Expanded_genTtbarId").alias("sub"), "keep", "multiplier").agg(F.count("*").alias("n"))


@query("SELECT exp % 100 AS sub, sum((cust % 16)::DOUBLE / 8) AS sumw, count(*) AS n FROM sidecar GROUP BY ALL")
def weighted_categories(spark: SparkSession, d: str) -> DataFrame:
    return resolve.weights(A.sidecar(spark, d).withColumn("w", (F.col("cust") % 16).cast("double") / 8), "Expanded_genTtbarId", "w")


# Histograms -----------------------------------------------------------------------------------------------------------


@query("""
, v AS (SELECT unnest(['genTtbarId', 'genTtbarId_sub', 'Expanded', 'Expanded_sub', 'nAddBJets', 'nAddBJetsMulti']) AS hist, unnest([gen, gen % 100, exp, exp % 100, n, m]) AS x, unnest([60000, 100, 60000, 100, 16, 16]) AS bins FROM sidecar)
SELECT hist, (CASE WHEN x < 0 THEN 0 WHEN x >= bins THEN bins + 1 ELSE x + 1 END)::INT AS bin, count(*) AS n, sum(1.0::DOUBLE * 1.0) AS sumw2 FROM v GROUP BY ALL""")
def hist_booked(spark: SparkSession, d: str) -> DataFrame:
    return hist.booked(A.sidecar(spark, d))


@query("SELECT (CASE WHEN exp % 100 < 0 THEN 0 WHEN exp % 100 >= 60 THEN 61 ELSE exp % 100 + 1 END)::INT AS bin, count(*) AS n, count(*)::DOUBLE AS sumw, count(*)::DOUBLE AS sumw2 FROM sidecar GROUP BY ALL")
def hist_sub(spark: SparkSession, d: str) -> DataFrame:
    """Sub-codes in 60 bins, so that 61 and above fall in the overflow bin."""
    return hist.histogram(A.sidecar(spark, d), codec.raw_sub_code("Expanded_genTtbarId"), 60, 0, 60)


@query("""SELECT (CASE WHEN l_quantity < 10 THEN 0 WHEN l_quantity >= 40 THEN 11 ELSE floor((l_quantity - 10) * 10 / 30) + 1 END)::INT AS bin, count(*) AS n, sum((l_linenumber)::DOUBLE) AS sumw,
  sum((l_linenumber * l_linenumber)::DOUBLE) AS sumw2 FROM lineitem GROUP BY ALL""")
def hist_weighted(spark: SparkSession, d: str) -> DataFrame:
    rows = A.table(spark, d, "lineitem").withColumn("w", F.col("l_linenumber").cast("double"))
    return hist.histogram(rows, "l_quantity", 10, 10, 40, "w")


@query("SELECT 'tt_' || (cust % 3) AS process, (n + 1)::INT AS bin, count(*) AS n FROM sidecar WHERE cust % 5 <> 0 GROUP BY ALL")
def hist_merge(spark: SparkSession, d: str) -> DataFrame:
    """Files hist_extend_<process>_<number>; those of another prefix are no part of it."""
    prefix = F.when(F.col("cust") % 5 == 0, "hist_other_").otherwise("hist_extend_")
    name = F.concat(prefix, F.lit("tt_"), F.col("cust") % 3, F.when(F.col("cust") % 7 == 0, "").otherwise(F.concat(F.lit("_"), F.col("cust") % 7)))
    parts = A.sidecar(spark, d).groupBy(name.alias("name"), (F.col("nAddBJets") + 1).alias("bin")).agg(F.count("*").alias("n"))
    return hist.merge(parts.withColumn("name", F.when(F.col("name").rlike("_tt_[0-9]$"), F.concat("name", F.lit("_0"))).otherwise(F.col("name"))), "hist_extend")


@query("""
, a AS (SELECT exp % 100 AS bin, count(*) AS a FROM sidecar GROUP BY ALL), b AS (SELECT gen % 100 AS bin, count(*) AS b FROM nano GROUP BY ALL),
c AS (SELECT bin, coalesce(a, 0) AS a, coalesce(b, 0) AS b FROM a FULL JOIN b USING (bin)), r AS (SELECT *, CASE WHEN b <> 0 THEN a / b END AS ratio FROM c)
SELECT bin, a, b, round(ratio, 9) AS ratio, coalesce(abs(ratio - 1) > 1e-6, false) AS red, b = 0 OR abs(ratio - 1) > 1e-9 AS listed FROM r""")
def hist_ratio(spark: SparkSession, d: str) -> DataFrame:
    a = A.sidecar(spark, d).groupBy((F.col("Expanded_genTtbarId") % 100).alias("bin")).agg(F.count("*").alias("n"))
    b = A.nano(spark, d).groupBy((F.col("genTtbarId") % 100).alias("bin")).agg(F.count("*").alias("n"))
    return hist.ratio(a, b).withColumn("ratio", F.round("ratio", 9))


# Order ----------------------------------------------------------------------------------------------------------------

FILES = """
, f AS (SELECT strftime(ts, '%Y-%m-%d') AS file, (CASE WHEN event_id % 500 = 7 THEN event_id - 20 ELSE event_id END) * 2 + CASE WHEN event_id % 500 = 7 THEN 1 ELSE 0 END AS pos, 1::BIGINT AS run,
  event_id // 100 AS lumi, event_id AS event FROM events),
g AS (SELECT *, coalesce(lag((run, lumi, event)) OVER (PARTITION BY file ORDER BY pos) > (run, lumi, event), false) AS down FROM f),
o AS (SELECT file, count(*) AS n, min_by(run, pos) AS first_run, min_by(lumi, pos) AS fl, min_by(event, pos) AS first_event, max_by(run, pos) AS last_run, max_by(lumi, pos) AS ll, max_by(event, pos) AS last_event,
  min(lumi) AS min_lumi, max(lumi) AS max_lumi, count(*) FILTER (WHERE down) = 0 AS sorted FROM g GROUP BY file),
v AS (SELECT file, sorted, coalesce(NOT (lag((last_run, ll, last_event)) OVER w <= (first_run, fl, first_event)), false) AS out_of_order, coalesce(lag(max_lumi) OVER w >= min_lumi, false) AS "overlaps"
  FROM o WINDOW w AS (ORDER BY file))"""


@query(f'{FILES} SELECT * RENAME (fl AS "first_luminosityBlock", ll AS "last_luminosityBlock") FROM o')
def file_order(spark: SparkSession, d: str) -> DataFrame:
    return order.file_order(A.ordered_files(spark, d, permuted=True))


@query(f"{FILES} SELECT * FROM v")
def file_overlap(spark: SparkSession, d: str) -> DataFrame:
    return order.file_overlap(order.file_order(A.ordered_files(spark, d, permuted=True)))


@query(f"""{FILES}, c AS (SELECT count(*) FILTER (WHERE NOT sorted) AS unsorted, count(*) FILTER (WHERE out_of_order) AS out_of_order, count(*) FILTER (WHERE "overlaps") AS "overlaps" FROM v)
SELECT *, CASE WHEN unsorted > 0 OR out_of_order > 0 THEN 'not strictly ordered' WHEN "overlaps" > 0 THEN 'overlapping' ELSE 'ordered' END AS verdict FROM c""")
def order_verdict(spark: SparkSession, d: str) -> DataFrame:
    return order.order_verdict(order.file_overlap(order.file_order(A.ordered_files(spark, d, permuted=True))))


@query("""
, p AS (SELECT run, lumi, event, (row_number() OVER (ORDER BY run, lumi, event) - 1) // 1000 AS part FROM sidecar)
SELECT part, count(*) AS rows, min(run) AS first_run, min((lumi, event)).lumi AS "first_luminosityBlock", min((lumi, event)).event AS first_event, max(run) AS last_run, max((lumi, event)).lumi AS "last_luminosityBlock",
  max((lumi, event)).event AS last_event FROM (SELECT * REPLACE (lumi AS lumi) FROM p) GROUP BY part""".replace("(lumi, event))", "struct_pack(lumi := lumi, event := event))"))
def shard_index(spark: SparkSession, d: str) -> DataFrame:
    return order.shard_index(order.shards(A.sidecar(spark, d).select(*order.KEY), 1000))


# Intervals ------------------------------------------------------------------------------------------------------------

MASK = """
, mask(run, lo, hi) AS (VALUES (1, 1, 1), (1, 4, 7), (1, 9, 9), (1, 20, 24), (2, 1, 3)),
ins AS (SELECT s.* FROM sidecar s WHERE EXISTS (SELECT 1 FROM mask WHERE mask.run = s.run AND s.lumi BETWEEN lo AND hi))"""


def _mask(spark: SparkSession) -> DataFrame:
    return intervals.checked_mask(intervals.parse_mask(spark.createDataFrame([(A.MASK,)], "value string")))


@query(f"{MASK} SELECT lumi AS \"luminosityBlock\", count(*) AS n FROM ins GROUP BY ALL")
def lumi_inside(spark: SparkSession, d: str) -> DataFrame:
    return intervals.inside(A.sidecar(spark, d), _mask(spark)).groupBy("luminosityBlock").agg(F.count("*").alias("n"))


@query(f"{MASK} SELECT lumi AS \"luminosityBlock\", count(*) AS n FROM sidecar WHERE ev NOT IN (SELECT ev FROM ins) GROUP BY ALL")
def lumi_outside(spark: SparkSession, d: str) -> DataFrame:
    return intervals.outside(A.sidecar(spark, d), _mask(spark)).groupBy("luminosityBlock").agg(F.count("*").alias("n"))


@query(f"""{MASK}, s AS (SELECT DISTINCT run, lumi FROM sidecar), i AS (SELECT DISTINCT run, lumi FROM ins), w AS (SELECT DISTINCT run, unnest(range(lo, hi + 1)) AS lumi FROM mask)
SELECT (SELECT sum(hi - lo + 1)::BIGINT FROM mask) AS mask_lumis, (SELECT count(*) FROM s) AS seen, (SELECT count(*) FROM i) AS inside, (SELECT count(*) FROM s) - (SELECT count(*) FROM i) AS outside,
  (SELECT count(*) FROM (SELECT run, lumi FROM w EXCEPT SELECT run, lumi FROM s)) AS unseen""")
def mask_coverage(spark: SparkSession, d: str) -> DataFrame:
    return intervals.coverage(A.sidecar(spark, d), _mask(spark))


@query("SELECT run, lumi AS \"luminosityBlock\", count(*) AS rows, min_by('f' || (cust % 20), (cust % 20, ev)) AS first_file FROM sidecar GROUP BY ALL")
def lumi_blocks(spark: SparkSession, d: str) -> DataFrame:
    rows = A.sidecar(spark, d).withColumns({"file": F.concat(F.lit("f"), F.col("cust") % 20), "at": F.struct(F.col("cust") % 20, "ev")})
    return intervals.blocks(rows, "file", "at")


# Campaign -------------------------------------------------------------------------------------------------------------

CHUNKS = f"""
, ch AS (SELECT chunk, 's' || (chunk % 4) AS sample, {COUNTERS} FROM matched GROUP BY chunk),
chunks AS (SELECT *, CASE WHEN chunk = 6 THEN 8 ELSE 0 END AS exit_code, nano_entries + CASE WHEN chunk = 9 THEN 1 ELSE 0 END AS opencheck, chunk = 11 AS job_failed FROM ch WHERE chunk <> 3)"""


def _chunks(spark: SparkSession, d: str) -> DataFrame:
    by = audit.counters(audit.match(A.nano(spark, d), A.sidecar(spark, d)), "chunk").where("chunk <> 3")
    return by.withColumns({
        "sample": F.concat(F.lit("s"), F.col("chunk") % 4), "exit_code": F.when(F.col("chunk") == 6, 8).otherwise(0), "nano_entries_postloop": F.col("nano_entries"),
        "nano_entries_opencheck": F.col("nano_entries") + F.when(F.col("chunk") == 9, 1).otherwise(0), "job_failed": F.col("chunk") == 11,
    })


_SUMS = ", ".join(f'sum("{c}")::BIGINT AS "{c}"' for c in campaign.SUMS)


@query(f"{CHUNKS} SELECT sample, count(*) AS chunks, {_SUMS} FROM chunks GROUP BY sample")
def chunk_rollup(spark: SparkSession, d: str) -> DataFrame:
    return campaign.rollup(_chunks(spark, d))


VERDICTS = f"""{CHUNKS}, u AS (SELECT sample, count(DISTINCT chunk) AS chunks, sum((exit_code <> 0)::INT) AS bad, sum((nano_entries <> opencheck OR job_failed)::INT) AS anomalies, {_SUMS} FROM chunks GROUP BY sample),
x AS (SELECT 's' || range AS sample, 5 AS n_chunks, CASE WHEN range = 0 THEN (SELECT count(*) FROM nano WHERE chunk % 4 = 0) WHEN range = 1 THEN 1 END AS n_events, range = 2 AS skip FROM range(5)),
q AS (SELECT sample, coalesce(chunks = n_chunks, false) AS chunks_present, coalesce(skip, false) OR coalesce(nano_entries = n_events, false) AS events_expected, coalesce(matched > 0, false) AS some_matched,
  coalesce(unmatched = 0, false) AS none_unmatched, coalesce(disagree = 0, false) AS none_disagree, coalesce("nAddBJets_ge3" = expanded_sub_in_set, false) AS conserved,
  coalesce(viol_ext_but_lt3 + viol_ge3_not_ext + viol_prefix_changed + viol_le2_changed = 0, false) AS no_violations, coalesce(bad = 0, false) AS exits_zero, coalesce(anomalies = 0, false) AS no_anomalies FROM x FULL JOIN u USING (sample))"""
_CRITERIA = ("chunks_present", "events_expected", "some_matched", "none_unmatched", "none_disagree", "conserved", "no_violations", "exits_zero", "no_anomalies")


def _verdicts(spark: SparkSession, d: str) -> DataFrame:
    n = A.nano(spark, d).where("chunk % 4 = 0").count()
    k = F.col("id")
    expected = spark.range(5).select(
        F.concat(F.lit("s"), k).alias("sample"), F.lit(5).alias("n_chunks"), F.when(k == 0, n).when(k == 1, 1).alias("n_events"), (k == 2).alias("skip")
    )
    plan = spark.range(20).select(F.concat(F.lit("s"), k % 4).alias("sample"), k.alias("chunk"))
    return campaign.sample_verdict(_chunks(spark, d), expected.drop("n_chunks"), plan)


@query(f"{VERDICTS} SELECT *, {' AND '.join(_CRITERIA)} AS passed FROM q")
def sample_verdict(spark: SparkSession, d: str) -> DataFrame:
    return _verdicts(spark, d)


@query(f"{VERDICTS} " + " UNION ALL ".join(f"SELECT sample, '{c}' AS criterion, {c} AS holds FROM q" for c in _CRITERIA))
def verdict_report(spark: SparkSession, d: str) -> DataFrame:
    return campaign.report(_verdicts(spark, d))


@query(f"{CHUNKS} SELECT 's' || (range % 4) AS sample, range AS chunk FROM range(22) WHERE range NOT IN (SELECT chunk FROM chunks)")
def missing_chunks(spark: SparkSession, d: str) -> DataFrame:
    expected = spark.range(22).select(F.concat(F.lit("s"), F.col("id") % 4).alias("sample"), F.col("id").alias("chunk"))
    return campaign.missing_chunks(expected, _chunks(spark, d))


@query(f"""{CHUNKS}, q AS (SELECT 's' || (range % 4) AS sample, range AS chunk FROM range(22) WHERE range % 5 = 1 UNION ALL SELECT 's2', 6 UNION ALL SELECT 's2', 6)
SELECT 's' || (r.range % 4) AS sample, r.range AS chunk, CASE WHEN n > 1 THEN 'duplicate' WHEN n = 1 THEN 'idle' WHEN exit_code IS NULL THEN 'missing' WHEN exit_code = 0 THEN 'done' ELSE 'failed' END AS state
FROM range(22) r LEFT JOIN chunks ON chunks.chunk = r.range LEFT JOIN (SELECT chunk, count(*) AS n FROM q GROUP BY chunk) q ON q.chunk = r.range""")
def chunk_states(spark: SparkSession, d: str) -> DataFrame:
    all_ = spark.range(22).select(F.concat(F.lit("s"), F.col("id") % 4).alias("sample"), F.col("id").alias("chunk"))
    queue = all_.where("chunk % 5 = 1").unionByName(spark.createDataFrame([("s2", 6), ("s2", 6)], "sample string, chunk bigint")).withColumn("job_state", F.lit("idle"))
    return campaign.chunk_states(all_, _chunks(spark, d), queue)


@query(f"""{CHUNKS}, m AS (SELECT 's' || (chunk % 4) AS sample, exp % 100 AS key, count(*) AS n FROM matched WHERE there AND chunk <> 3 GROUP BY ALL) SELECT sample, key::VARCHAR AS key, n FROM m""")
def merged_maps(spark: SparkSession, d: str) -> DataFrame:
    rows = audit.match(A.nano(spark, d), A.sidecar(spark, d)).where("side is not null and chunk <> 3")
    by = rows.groupBy("chunk", codec.sub_code("side.Expanded_genTtbarId").cast("string").alias("k")).agg(F.count("*").alias("n"))
    maps = by.groupBy("chunk").agg(F.map_from_entries(F.collect_list(F.struct("k", "n"))).alias("m"))
    return campaign.merge_maps(maps.withColumn("sample", F.concat(F.lit("s"), F.col("chunk") % 4)), "m")


@query("""
, j AS (SELECT s_suppkey + CASE WHEN s_suppkey % 9 = 0 THEN 1 WHEN s_suppkey % 31 = 4 THEN 1000000 ELSE 0 END AS job FROM supplier), h AS (SELECT job, count(*) AS t FROM j GROUP BY job),
b AS (SELECT coalesce(w.id, h.job) AS job, w.id, t FROM (SELECT range AS id FROM range(1, 91)) w FULL JOIN h ON h.job = w.id)
SELECT job, CASE WHEN t IS NULL THEN 'missing' WHEN id IS NULL THEN 'extra' ELSE 'duplicate' END AS status FROM b WHERE t IS NULL OR id IS NULL OR t > 1""")
def id_gaps(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    jobs = A.table(spark, d, "supplier").select((k + F.when(k % 9 == 0, 1).when(k % 31 == 4, 1_000_000).otherwise(0)).alias("job"))
    return campaign.id_gaps(jobs, 90)


_STATES = [*campaign.STATES, *campaign.OTHER_STATES, "strange"]


@query(f"""
, j AS (SELECT 't' || (o_custkey % 6) AS task, list_extract({_STATES}, (o_orderkey % {len(_STATES)})::INT + 1) AS state FROM orders)
SELECT coalesce(task, 'TOTAL') AS task, """ + ", ".join(f"count(*) FILTER (WHERE state = '{x}') AS {x}" for x in ("finished", "running", "idle", "transferring", "failed")) + """,
  count(*) FILTER (WHERE state NOT IN ('finished', 'running', 'idle', 'transferring', 'failed')) AS others, count(*) AS total,
  coalesce(string_agg(DISTINCT state, ',') FILTER (WHERE state = 'strange'), '') AS unknown FROM j GROUP BY ROLLUP (task)""")
def job_states(spark: SparkSession, d: str) -> DataFrame:
    names = F.array(*map(F.lit, _STATES))
    jobs = A.table(spark, d, "orders").select(F.concat(F.lit("t"), F.col("o_custkey") % 6).alias("task"), F.get(names, (F.col("o_orderkey") % len(_STATES)).cast("int")).alias("state"))
    return campaign.job_states(jobs).withColumn("unknown", F.concat_ws(",", "unknown"))


@query("""
, t AS (SELECT s_suppkey AS task, s_suppkey * 700 AS n_files, s_suppkey % 6 + 1 AS units FROM supplier), j AS (SELECT *, ceil(n_files / units)::BIGINT AS jobs FROM t)
SELECT *, CASE WHEN jobs > 10000 THEN 'FAIL' WHEN jobs > 9000 THEN 'WARN' ELSE 'OK' END AS status FROM j""")
def job_guard(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    return campaign.job_guard(A.table(spark, d, "supplier").select(k.alias("task"), (k * 700).alias("n_files"), (k % 6 + 1).alias("units")))


@query(""", r AS (SELECT 'req_' || (s_suppkey * s_suppkey % 41) AS name, s_suppkey AS member FROM supplier) SELECT name, count(*) AS n, list(member ORDER BY member)::VARCHAR AS members FROM r GROUP BY name HAVING count(*) > 1""")
def name_clashes(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    rows = A.table(spark, d, "supplier").select(F.concat(F.lit("req_"), k * k % 41).alias("name"), k.alias("member"))
    return campaign.name_clashes(rows, "name", "member").withColumn("members", F.concat(F.lit("["), F.concat_ws(", ", "members"), F.lit("]")))


_TYPES = "CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' ELSE lower(column_type) END"


@query(f"""
, l AS (SELECT column_name AS name, {_TYPES} AS left_type FROM (DESCRIBE SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders)),
r AS (SELECT column_name AS name, {_TYPES} AS right_type FROM (DESCRIBE SELECT o_orderkey, o_custkey::VARCHAR AS o_custkey, o_totalprice, 1::INT AS o_extra FROM orders))
SELECT name, left_type, right_type, CASE WHEN right_type IS NULL THEN 'only_left' WHEN left_type IS NULL THEN 'only_right' WHEN left_type <> right_type THEN 'type_mismatch' ELSE 'common' END AS status FROM l FULL JOIN r USING (name)""")
def schema_diff(spark: SparkSession, d: str) -> DataFrame:
    o = A.table(spark, d, "orders")
    left = o.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    return wide.schema_diff(left, o.select("o_orderkey", F.col("o_custkey").cast("string"), "o_totalprice", F.lit(1).alias("o_extra")))


WIDE = """
, r AS (SELECT o_orderkey, o_custkey + CASE WHEN o_orderkey % 50 = 0 THEN 1 ELSE 0 END AS c, CASE WHEN o_orderkey % 40 = 3 THEN o_totalprice * 1.001 WHEN o_orderkey % 40 = 4 THEN o_totalprice * 1.0001 WHEN o_orderkey % 40 = 5 THEN 'nan'::DOUBLE ELSE o_totalprice END AS p,
  o_orderstatus AS s FROM orders),
l AS (SELECT o_orderkey, o_custkey AS c, CASE WHEN o_orderkey % 80 = 5 THEN 'nan'::DOUBLE ELSE o_totalprice END AS p, o_orderstatus AS s FROM orders),
b AS (SELECT l.c AS lc, r.c AS rc, l.p AS lp, r.p AS rp, l.s AS ls, r.s AS rs FROM l JOIN r USING (o_orderkey)),
w AS (SELECT 'o_custkey' AS name, count(*) AS compared, count(*) FILTER (WHERE lc <> rc) AS mismatches, 0 AS nan_agree FROM b
  UNION ALL SELECT 'o_totalprice', count(*), count(*) FILTER (WHERE NOT (isnan(lp) AND isnan(rp)) AND (isnan(lp) OR isnan(rp) OR lp <> rp AND abs(lp - rp) >= 5e-4 * greatest(1, abs(lp)))), count(*) FILTER (WHERE isnan(lp) AND isnan(rp)) FROM b
  UNION ALL SELECT 'o_orderstatus', count(*), count(*) FILTER (WHERE ls <> rs), 0 FROM b)"""


def _wide(spark: SparkSession, d: str) -> DataFrame:
    o, k, p = A.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"), F.col("o_orderkey"), F.col("o_totalprice")
    nan = F.lit(float("nan"))
    left = o.withColumn("o_totalprice", F.when(k % 80 == 5, nan).otherwise(p))
    right = o.withColumns({"o_custkey": F.col("o_custkey") + F.when(k % 50 == 0, 1).otherwise(0), "o_totalprice": F.when(k % 40 == 3, p * 1.001).when(k % 40 == 4, p * 1.0001).when(k % 40 == 5, nan).otherwise(p)})
    return wide.value_mismatches(left, right, ["o_orderkey"])


@query(f"{WIDE} SELECT name, compared, mismatches, nan_agree::BIGINT AS nan_agree FROM w")
def wide_mismatch(spark: SparkSession, d: str) -> DataFrame:
    return _wide(spark, d)


@query(f"{WIDE} SELECT name, compared, mismatches, nan_agree::BIGINT AS nan_agree FROM w WHERE mismatches > 0 ORDER BY mismatches DESC, name LIMIT 1")
def wide_worst(spark: SparkSession, d: str) -> DataFrame:
    return wide.worst(_wide(spark, d), 1)


CATALOGUE = """
, cat AS (SELECT 'c' || s_suppkey AS child, CASE WHEN s_suppkey % 5 = 0 THEN '' ELSE 'p' || s_suppkey END AS parent, true AS entry FROM supplier WHERE s_suppkey % 4 <> 0),
lin AS (SELECT 'c' || s_suppkey AS child, CASE WHEN s_suppkey % 7 <> 3 THEN 'p' || (s_suppkey + CASE WHEN s_suppkey % 3 = 1 THEN 1 ELSE 0 END) END AS parent FROM supplier UNION ALL SELECT 'c' || s_suppkey, 'p0' FROM supplier WHERE s_suppkey % 6 = 0)"""


def _catalogue(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    s, k = A.table(spark, d, "supplier"), F.col("s_suppkey")
    child = F.concat(F.lit("c"), k).alias("child")
    cat = s.where(k % 4 != 0).select(child, F.when(k % 5 == 0, "").otherwise(F.concat(F.lit("p"), k)).alias("parent"), F.lit(True).alias("entry"))
    found = F.when(k % 7 != 3, F.concat(F.lit("p"), k + F.when(k % 3 == 1, 1).otherwise(0)))
    lin = s.select(child, found.alias("parent")).unionByName(s.where(k % 6 == 0).select(child, F.lit("p0").alias("parent")))
    return cat, lin


@query(f"""{CATALOGUE}, l AS (SELECT child, count(parent) AS n, min(parent) AS found FROM lin GROUP BY child)
SELECT child, parent, found, CASE WHEN n IS NULL OR n <> 1 THEN 'NOT CHECKED' WHEN entry IS NULL THEN 'ABSENT' WHEN parent = '' THEN 'EMPTY' WHEN parent = found THEN 'MATCH' ELSE 'MISMATCH' END AS status FROM cat FULL JOIN l USING (child)""")
def lineage_status(spark: SparkSession, d: str) -> DataFrame:
    """No parent and several ones come before everything else, also for children that the catalogue lacks."""
    return campaign.reconcile(*_catalogue(spark, d))


#: Entries c and their recorded parents: all empty ones can be filled but where k % 9 = 0 (another primary part) or k % 8 = 0 (another campaign).
FILL = """
, ent AS (SELECT s_suppkey AS k, '/P' || s_suppkey || '/RunX-v1/NANOAODSIM' AS child, '/P' || s_suppkey || '/RunM-v1/MINIAODSIM' AS parent FROM supplier)"""


def _fill(spark: SparkSession, d: str, where: str) -> tuple[DataFrame, DataFrame]:
    k = F.col("s_suppkey")
    rows = A.table(spark, d, "supplier").where(where)
    child = F.concat(F.lit("/P"), k, F.lit("/RunX-v1/NANOAODSIM"))
    parent = F.concat(F.lit("/P"), k + F.when(k % 9 == 0, 1).otherwise(0), F.when(k % 8 == 0, "/RunO").otherwise("/RunM"), F.lit("-v1/MINIAODSIM"))
    cat = rows.select(child.alias("child"), F.when(k % 2 == 0, "").otherwise(F.concat(F.lit("/P"), k, F.lit("/RunM-v1/MINIAODSIM"))).alias("parent"), F.lit(True).alias("entry"), F.lit(False).alias("enabled"), F.lit(False).alias("verified"))
    return cat, rows.select(child.alias("child"), parent.alias("parent"))


@query(f"""{FILL} SELECT 'fits' AS scenario, child, parent, true AS done FROM ent WHERE k % 9 <> 0 AND k % 8 <> 0
UNION ALL SELECT 'other primary', child, CASE WHEN k % 2 = 0 THEN '' ELSE parent END, NOT EXISTS (SELECT 1 FROM ent WHERE k % 18 = 0 AND k % 8 <> 0) AND EXISTS (SELECT 1 FROM ent WHERE k % 2 = 0) FROM ent WHERE k % 8 <> 0 AND EXISTS (SELECT 1 FROM ent WHERE k % 18 = 0 AND k % 8 <> 0)
UNION ALL SELECT 'other campaign', child, CASE WHEN k % 2 = 0 THEN '' ELSE parent END, false FROM ent WHERE k % 9 <> 0""")
def catalogue_fill(spark: SparkSession, d: str) -> DataFrame:
    """Parents are written into all empty entries or none."""
    out = []
    for scenario, where in (("fits", "s_suppkey % 9 <> 0 and s_suppkey % 8 <> 0"), ("other primary", "s_suppkey % 8 <> 0"), ("other campaign", "s_suppkey % 9 <> 0")):
        cat, lin = _fill(spark, d, where)
        new, done = campaign.update_parents(campaign.reconcile(cat, lin), cat, "RunM-")
        if scenario != "other primary" or not done:
            out.append(new.select(F.lit(scenario).alias("scenario"), "child", "parent", F.lit(done).alias("done")))
    return reduce(DataFrame.unionByName, out)


@query(f"{FILL} SELECT child, enabled, enabled AS verified FROM (SELECT child, k, NOT EXISTS (SELECT 1 FROM ent WHERE k % 2 = 0 OR k % 9 = 0 OR k % 8 = 0) AS enabled FROM ent) UNION ALL SELECT child || '!', true, true FROM ent WHERE k % 2 = 1 AND k % 9 <> 0")
def catalogue_apply(spark: SparkSession, d: str) -> DataFrame:
    """Entries are opened only if every one is a match: not with empty ones among them, but without."""
    cat, lin = _fill(spark, d, "true")
    closed = campaign.apply_matches(campaign.reconcile(cat, lin), cat)[0]
    cat, lin = _fill(spark, d, "s_suppkey % 2 = 1 and s_suppkey % 9 <> 0")
    opened = campaign.apply_matches(campaign.reconcile(cat, lin), cat)[0].withColumn("child", F.concat("child", F.lit("!")))
    return closed.unionByName(opened).select("child", "enabled", "verified")


@query("""
, f AS (SELECT 'f' || s_suppkey AS file, s_suppkey AS k FROM supplier) SELECT file, CASE WHEN k % 17 = 0 THEN 'errored' WHEN k % 3 = 0 THEN 'orphan' ELSE 'matched' END AS status FROM f""")
def lineage_fanout(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    files = A.table(spark, d, "supplier").select(F.concat(F.lit("f"), k).alias("file"), k)
    answers = files.where(k % 17 != 0).select("file", F.when(k % 3 != 0, "p").alias("parent"), F.lit(None).cast("string").alias("error"))
    answers = answers.unionByName(files.where(k % 17 == 0).select("file", F.lit("p").alias("parent"), F.lit("timeout").alias("error")))
    return campaign.lineage_fanout(files.select("file"), answers)


VERSIONS = """
, ch AS (SELECT p_partkey, 'p' || (p_partkey % 50) AS parent, p_partkey % 4 AS t, p_partkey % 3 = 0 AND p_partkey % 50 > 4 OR p_partkey % 50 = 3 AS special, (p_partkey % 13)::INT AS v,
  '/A' || p_partkey || '/RunIISummer20UL18' || CASE p_partkey % 4 WHEN 0 THEN 'NanoAODAPVv9' WHEN 3 THEN 'NanoAODv15' ELSE 'NanoAODv9' END || '-' || CASE WHEN p_partkey % 3 = 0 AND p_partkey % 50 > 4 OR p_partkey % 50 = 3 THEN 'JMENano_' ELSE '' END
    || '106X_realistic-v99_L1-v' || (p_partkey % 13) || '/NANOAODSIM' AS child FROM part),
w AS (SELECT *, CASE WHEN special THEN -1 ELSE v END AS version FROM ch WHERE t <> 3)"""


@query(f"{VERSIONS}, r AS (SELECT *, row_number() OVER (PARTITION BY parent ORDER BY version DESC, child) AS k FROM w) SELECT parent, child, version FROM r WHERE k = 1")
def latest_version(spark: SparkSession, d: str) -> DataFrame:
    """APV children count like others, special reprocessings only where there is nothing else; the last -vN is the version."""
    k = F.col("p_partkey")
    special = (k % 3 == 0) & (k % 50 > 4) | (k % 50 == 3)
    token = F.when(k % 4 == 0, "NanoAODAPVv9").when(k % 4 == 3, "NanoAODv15").otherwise("NanoAODv9")
    child = F.concat(F.lit("/A"), k, F.lit("/RunIISummer20UL18"), token, F.lit("-"), F.when(special, "JMENano_").otherwise(""), F.lit("106X_realistic-v99_L1-v"), k % 13, F.lit("/NANOAODSIM"))
    return campaign.latest_version(A.table(spark, d, "part").select(F.concat(F.lit("p"), k % 50).alias("parent"), child.alias("child")), "v9")


@query("""
, e AS (SELECT s_suppkey AS k, 'e' || s_suppkey AS entry FROM supplier)
SELECT entry, CASE WHEN k % 3 = 0 THEN 'VERSION_ABSENT' WHEN k % 4 = 0 THEN 'DIFFERENT_PARENT' ELSE 'SAME_PARENT' END AS status FROM e""")
def child_lineage(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    entries = A.table(spark, d, "supplier").select(F.concat(F.lit("e"), k).alias("entry"), F.lit("P").alias("parent"), F.lit("v9").alias("version"), k)
    children = entries.select("entry", F.concat(F.lit("/A/"), F.when(k % 3 == 0, "NanoAODv8").when(k % 5 == 0, "NanoAODAPVv9").otherwise("NanoAODv9"), F.lit("-v1/N")).alias("child"), F.when(k % 4 == 0, "Q").otherwise("P").alias("parent"))
    return campaign.child_lineage(entries.drop("s_suppkey"), children)


PATHS = ", f AS (SELECT 't' || (o_custkey % 30) AS task, o_orderkey AS k, o_custkey % 30 AS t FROM orders)"


def _paths(spark: SparkSession, d: str) -> DataFrame:
    k, t = F.col("o_orderkey"), F.col("o_custkey") % 30
    stamp = F.when((t == 4) & (k % 2 == 0), "240101_000001").otherwise("240101_000000")
    n = F.row_number().over(Window.partitionBy(t).orderBy(k)) + F.when((t == 7) & (k % 2 == 0), 1).otherwise(0)
    return A.table(spark, d, "orders").select(F.concat(F.lit("t"), t).alias("task"), F.concat(F.lit("/store/"), stamp, F.lit("/0000/out_"), n, F.lit(".parquet")).alias("path"))


@query(f"{PATHS} SELECT task, count(DISTINCT CASE WHEN t = 4 THEN k % 2 ELSE 0 END) AS stamps, count(DISTINCT CASE WHEN t = 4 THEN k % 2 ELSE 0 END) = 1 AS ok FROM f GROUP BY task")
def one_timestamp(spark: SparkSession, d: str) -> DataFrame:
    return campaign.one_timestamp(_paths(spark, d), "task")


@query(f"""{PATHS}, g AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY k) + CASE WHEN t = 7 AND k % 2 = 0 THEN 1 ELSE 0 END AS job FROM f),
h AS (SELECT task, any_value(t) AS t, count(*) AS n, count(DISTINCT job) AS dd, max(job) AS hi, min(job) AS lo, count(DISTINCT CASE WHEN t = 4 THEN k % 2 ELSE 0 END) AS st FROM g GROUP BY task)
SELECT task, CASE WHEN st = 1 AND dd = n AND lo = 1 AND hi = n AND t NOT IN (9, 11, 13) THEN 'DONE' ELSE 'CHECK FAILED' END AS status FROM h""")
def production_check(spark: SparkSession, d: str) -> DataFrame:
    """Task 9 has too many rows, 11 breaks an invariant, 13 has a file that can't be read."""
    files = _paths(spark, d)
    tasks = files.groupBy("task").agg(F.count("*").alias("n_jobs"), (F.count("*") * 10).alias("n_events"))
    zero = {c: F.lit(0) for c in audit.MUST_BE_ZERO} | {"le2_changed": F.when(F.col("task") == "t11", 1).otherwise(0)}
    by_file = tasks.withColumns({"entries": F.col("n_events") + F.when(F.col("task") == "t9", 1).otherwise(0), "unreadable": F.col("task") == "t13"} | zero)
    return campaign.production_check(tasks, files, campaign.sample_checks(by_file))


@query("""
, s AS (SELECT user_id % 10 AS task, event_id AS t, event_id // 40 * 4 AS done FROM events), w AS (SELECT *, greatest(t - first(t) OVER f, 1) AS span, done - first(done) OVER f AS moved, max(done) OVER g AS best FROM s
  WINDOW f AS (PARTITION BY task ORDER BY t ROWS BETWEEN 11 PRECEDING AND CURRENT ROW), g AS (PARTITION BY task ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
p AS (SELECT *, max(CASE WHEN best IS NULL OR done > best THEN t END) OVER (PARTITION BY task ORDER BY t ROWS UNBOUNDED PRECEDING) AS progress FROM w)
SELECT task, t, done, 1000000 AS total, round(CASE WHEN moved > 0 THEN moved / span END, 9) AS rate, t - progress >= 25 AS stalled, round(CASE WHEN moved > 0 THEN (1000000 - done) / (moved / span) END, 6) AS eta FROM p""")
def throughput(spark: SparkSession, d: str) -> DataFrame:
    snapshots = A.table(spark, d, "events").select((F.col("user_id") % 10).alias("task"), F.col("event_id").alias("t"), (codec.idiv("event_id", 40) * 4).alias("done"), F.lit(1_000_000).alias("total"))
    return campaign.throughput(snapshots, stall=25).withColumns({"rate": F.round("rate", 9), "eta": F.round("eta", 6)})


@query("""
, m AS (SELECT 's' || (p_size % 5) AS sample, 'f' || p_partkey AS path FROM part) SELECT sample, path, (row_number() OVER (PARTITION BY sample ORDER BY path) - 1) // 20 AS chunk FROM m""")
def chunk_files(spark: SparkSession, d: str) -> DataFrame:
    manifest = A.table(spark, d, "part").select(F.concat(F.lit("s"), F.col("p_size") % 5).alias("sample"), F.concat(F.lit("f"), F.col("p_partkey")).alias("path"))
    return campaign.chunk_files(manifest, 20)


ENTRIES = """
, n AS (SELECT s_suppkey AS k, CASE s_suppkey % 3 WHEN 0 THEN '2022' WHEN 1 THEN '2018' ELSE '2023BPix' END AS era, 'n' || s_suppkey AS name,
  CASE WHEN s_suppkey % 3 = 1 AND s_suppkey % 2 = 0 THEN '' WHEN s_suppkey % 7 = 0 THEN 'v2' WHEN s_suppkey % 7 IN (1, 2) THEN 'v3' WHEN s_suppkey % 7 = 3 THEN '' ELSE 'v4' END AS ver,
  CASE WHEN s_suppkey % 3 = 1 AND s_suppkey % 2 = 0 THEN '' WHEN s_suppkey % 5 = 0 THEN 'ext1' WHEN s_suppkey % 5 = 1 THEN 'other' ELSE 'main' END AS role,
  CASE WHEN s_suppkey % 11 = 0 THEN 'x/m.json' WHEN s_suppkey % 13 = 0 THEN 'm.json' WHEN s_suppkey % 7 = 1 OR s_suppkey % 17 = 0 THEN 'own' ELSE '' END AS mask, CASE WHEN s_suppkey % 4 = 1 THEN 'x' ELSE '' END AS md5,
  CASE WHEN s_suppkey % 10 IN (0, 5) THEN '_ext1-' ELSE '-' END AS mini, CASE WHEN s_suppkey % 10 IN (0, 3) THEN '_ext1-' ELSE '-' END AS nano FROM supplier)"""


def _entries(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    era, name = F.when(k % 3 == 0, "2022").when(k % 3 == 1, "2018").otherwise("2023BPix"), F.concat(F.lit("n"), k)
    old = (k % 3 == 1) & (k % 2 == 0)
    own = F.concat(F.lit("crab_lumimask_"), era, F.lit("_"), name, F.lit("_v3.json"))
    part = lambda last, *hits: F.concat(F.lit("/P/Run"), F.when((k % 10).isin(*hits), "_ext1-").otherwise("-"), F.lit(f"v1/{last}"))
    return A.table(spark, d, "supplier").select(
        k, era.alias("era"), name.alias("name"), F.when(old, "").when(k % 7 == 0, "v2").when((k % 7).isin(1, 2), "v3").when(k % 7 == 3, None).otherwise("v4").alias("miniaod_version"),
        F.when(old, "").when(k % 5 == 0, "ext1").when(k % 5 == 1, "other").otherwise("main").alias("nano_role"),
        F.when(k % 11 == 0, "x/m.json").when(k % 13 == 0, "m.json").when((k % 7 == 1) | (k % 17 == 0), own).alias("lumi_mask"), F.when(k % 4 == 1, "x").alias("lumi_mask_md5"),
        part("MINIAODSIM", 0, 5).alias("dataset"), part("NANOAODSIM", 0, 3).alias("nano_child"), (k % 2 == 0).alias("enabled"),
    )


@query(f"""{ENTRIES}, p AS (SELECT era, name, concat_ws('; ',
  CASE WHEN (era <> '2018' OR ver <> '' OR role <> '') AND ver NOT IN ('v3', 'v4') THEN 'unknown version' END, CASE WHEN (era <> '2018' OR ver <> '' OR role <> '') AND role NOT IN ('main', 'ext1') THEN 'unknown role' END,
  CASE WHEN ver = 'v3' AND role = 'ext1' THEN 'v3 with another role than main' END, CASE WHEN role = 'main' AND (mini = '_ext1-' OR nano = '_ext1-') THEN 'main role for an extension' END,
  CASE WHEN role = 'ext1' AND NOT (mini = '_ext1-' AND nano = '_ext1-') THEN 'extension role for a dataset that is none' END, CASE WHEN ver = 'v3' AND mask = '' THEN 'v3 without mask' END,
  CASE WHEN ver <> 'v3' AND mask <> '' THEN 'mask on another version than v3' END, CASE WHEN md5 <> '' AND mask = '' THEN 'checksum without mask' END, CASE WHEN mask = 'x/m.json' THEN 'mask is not a bare name' END,
  CASE WHEN mask = 'm.json' THEN 'mask of another entry' END, CASE WHEN mask = 'own' AND md5 = '' THEN 'mask without checksum' END) AS problems FROM n) SELECT * FROM p WHERE problems <> ''""")
def entry_problems(spark: SparkSession, d: str) -> DataFrame:
    return campaign.entry_problems(_entries(spark, d)).withColumn("problems", F.concat_ws("; ", "problems"))


@query(f"""{ENTRIES} SELECT era, name, CASE WHEN mask = 'x/m.json' THEN 'mask is not a bare name' WHEN mask = 'm.json' THEN 'mask of another entry' WHEN k % 4 = 0 THEN 'mask without checksum' WHEN k % 3 = 0 AND k % 2 = 0 THEN 'mask file missing'
  WHEN k % 4 = 1 THEN 'mask with another checksum' WHEN k % 4 = 2 THEN 'mask without lumis' END AS problem FROM n WHERE mask <> ''""")
def mask_identity(spark: SparkSession, d: str) -> DataFrame:
    """Masks as the content of files: some are lost, some hold no lumi, some have another checksum than the entry says."""
    rows = _entries(spark, d).where("lumi_mask is not null")
    k = F.col("s_suppkey")
    content = F.when(k % 4 == 2, '{"1": []}').otherwise('{"1": [[1, 4]], "2": [[7, 7]]}')
    md5 = F.when(k % 4 == 0, "").when(k % 4 == 1, "00").otherwise(F.upper(F.md5(content.cast("binary"))))
    files = rows.where(~((k % 3 == 0) & (k % 2 == 0)) & F.col("lumi_mask").startswith("crab")).select(F.concat(F.lit("file:/masks/"), "lumi_mask").alias("path"), content.cast("binary").alias("content"))
    return campaign.mask_identity(files, rows.withColumn("lumi_mask_md5", md5)).select("era", "name", "problem")


@query(f"{ENTRIES} SELECT name, name || '_' || era || CASE WHEN ver = 'v3' THEN '_v3' WHEN ver <> '' THEN '_' || role ELSE '' END || '_extend_fp' AS request FROM n")
def request_names(spark: SparkSession, d: str) -> DataFrame:
    return _entries(spark, d).select("name", campaign.request_name(suffix="fp").alias("request"))


@query(f"{ENTRIES} SELECT 'era' AS filter, name FROM n WHERE era = '2022' UNION ALL SELECT 'enabled', name FROM n WHERE k % 2 = 0 UNION ALL SELECT 'both', name FROM n WHERE era = '2018' AND k % 2 = 1")
def catalogue_filters(spark: SparkSession, d: str) -> DataFrame:
    e = _entries(spark, d)
    parts = {"era": campaign.select_entries(e, era="2022"), "enabled": campaign.select_entries(e, enabled=True), "both": campaign.select_entries(e, era="2018", enabled=False)}
    return reduce(DataFrame.unionByName, [df.select(F.lit(k).alias("filter"), "name") for k, df in parts.items()])


@query("""
, ds AS (SELECT s_suppkey AS k, ['2017', '2022', '2022EE', '2030'][s_suppkey % 4 + 1] AS era, CASE s_suppkey % 3 WHEN 0 THEN 'v4' WHEN 1 THEN 'v3' ELSE 'v2' END AS version,
  ['UL17MiniAODv2-x', 'Summer22MiniAODv4-x', 'Summer22EEMiniAODv4-x', 'Autumn2030Mini', 'Summer22MiniAODv3-x'][s_suppkey % 5 + 1] AS mini, ['UL17NanoAODv9-x', 'Summer22NanoAODv12-x', 'Summer22EENanoAODv12-x', 'Autumn2030Nano'][s_suppkey % 4 + 1] AS nano FROM supplier)
SELECT k, CASE era WHEN '2017' THEN starts_with(mini, 'UL17MiniAODv2-') AND starts_with(nano, 'UL17NanoAODv9-')
  WHEN '2022' THEN starts_with(nano, 'Summer22NanoAODv12-') AND (version = 'v4' AND starts_with(mini, 'Summer22MiniAODv4-') OR version = 'v3' AND starts_with(mini, 'Summer22MiniAODv3-'))
  WHEN '2022EE' THEN version = 'v4' AND starts_with(mini, 'Summer22EEMiniAODv4-') AND starts_with(nano, 'Summer22EENanoAODv12-') ELSE contains(mini, era) AND contains(nano, era) END AS matches FROM ds""")
def campaign_match(spark: SparkSession, d: str) -> DataFrame:
    """By prefix where the era has one, for some eras by version; by the era's name elsewhere."""
    k = F.col("s_suppkey")
    pick = lambda names: F.get(F.array(*map(F.lit, names)), (k % len(names)).cast("int"))
    processed = lambda name, tier: F.concat(F.lit("/P/"), name, F.lit(f"/{tier}"))
    ds = A.table(spark, d, "supplier").select(
        k.alias("k"), pick(("2017", "2022", "2022EE", "2030")).alias("era"), pick(("v4", "v3", "v2")).alias("version"),
        processed(pick(("UL17MiniAODv2-x", "Summer22MiniAODv4-x", "Summer22EEMiniAODv4-x", "Autumn2030Mini", "Summer22MiniAODv3-x")), "MINIAODSIM").alias("dataset"),
        processed(pick(("UL17NanoAODv9-x", "Summer22NanoAODv12-x", "Summer22EENanoAODv12-x", "Autumn2030Nano")), "NANOAODSIM").alias("nano_child"),
    )
    prefixes = [("2017", None, "UL17MiniAODv2-", "UL17NanoAODv9-"), ("2022", "v4", "Summer22MiniAODv4-", "Summer22NanoAODv12-"), ("2022", "v3", "Summer22MiniAODv3-", "Summer22NanoAODv12-"), ("2022EE", "v4", "Summer22EEMiniAODv4-", "Summer22EENanoAODv12-")]
    return campaign.campaign_match(ds, spark.createDataFrame(prefixes, "era string, version string, mini string, nano string")).select("k", "matches")


@query("""
, ds AS (SELECT '/P' || (s_suppkey % 4) || '/x/NANOAODSIM' AS dataset, s_suppkey % 4 AS k FROM supplier) SELECT 'P' || k AS "primary", dataset, CASE k WHEN 0 THEN '4b' WHEN 1 THEN 'Had' WHEN 2 THEN 'Semi' END AS short FROM ds""")
def short_names(spark: SparkSession, d: str) -> DataFrame:
    ds = A.table(spark, d, "supplier").select(F.concat(F.lit("/P"), F.col("s_suppkey") % 4, F.lit("/x/NANOAODSIM")).alias("dataset"))
    return campaign.short_names(ds, spark.createDataFrame([("P0", "4b"), ("P1", "Had"), ("P2", "Semi")], "primary string, short string"))


@query("""
SELECT p_partkey, ['nothing', 'nothing', 'refused', 'sent', 'error', 'unclear', 'unclear', 'unclear', 'refused'][p_partkey % 9 + 1] AS status FROM part""")
def classified_answers(spark: SparkSession, d: str) -> DataFrame:
    """Whole phrases count, single words don't; what was sent is told by the reply alone."""
    replies = [
        ("Found no jobs to resubmit", "raised"), ("", "no jobs to resubmit"), ("The task has not been submitted to the Grid scheduler yet", None), ("Resubmit request sent to the server.", None),
        ("hm", "resubmit request sent to the server"), ("not sent, nothing refused", None), ("Error: failed", None), (None, None), ("resubmit request sent to the server", "will not proceed with the resubmission"),
    ]
    said = F.get(F.array(*(F.struct(F.lit(t).cast("string").alias("text"), F.lit(e).cast("string").alias("error")) for t, e in replies)), (F.col("p_partkey") % len(replies)).cast("int"))
    rows = A.table(spark, d, "part").select("p_partkey", said.alias("r")).select("p_partkey", "r.*")
    return campaign.classify_answers(rows).select("p_partkey", "status")


@query("SELECT o_custkey, min(o_orderkey) AS o_orderkey FROM orders GROUP BY o_custkey")
def dedup_in_order(spark: SparkSession, d: str) -> DataFrame:
    return campaign.dedup_in_order(A.table(spark, d, "orders"), "o_custkey", "o_orderkey")


@query("""
, x AS (SELECT p_partkey, '/A' || (p_partkey % 3) || CASE WHEN p_partkey % 5 = 0 THEN '//' ELSE '/B/' END || CASE WHEN p_partkey % 7 = 0 THEN 'MINIAODSIM' ELSE 'NANOAODSIM' END AS name FROM part)
SELECT p_partkey, p_partkey % 5 <> 0 AND p_partkey % 7 <> 0 AS valid FROM x""")
def dataset_grammar(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    name = F.concat(F.lit("/A"), k % 3, F.when(k % 5 == 0, "//").otherwise("/B/"), F.when(k % 7 == 0, "MINIAODSIM").otherwise("NANOAODSIM"))
    return A.table(spark, d, "part").select("p_partkey", extract.valid(name).alias("valid"))


@query("SELECT run, lumi AS \"luminosityBlock\", event FROM sidecar ORDER BY 1, 2, 3 LIMIT 500")
def row_cap(spark: SparkSession, d: str) -> DataFrame:
    """The first rows of the whole in order of key, as asked for."""
    return order.first_rows(A.sidecar(spark, d).select(*order.KEY), 500)


@query("""
, b AS (SELECT p_partkey * 7919 % 16777216 + 1056964608 AS bits, p_partkey FROM part), c AS (SELECT *, bits >> 9 AS cut, (bits >> 8) & 1 AS up FROM b)
SELECT p_partkey, (CASE WHEN up = 1 AND (cut & 16383) < 16382 THEN cut + 1 ELSE cut END) << 9 AS rounded FROM c""")
def rounded_mantissas(spark: SparkSession, d: str) -> DataFrame:
    bits = F.col("p_partkey") * 7919 % 16777216 + 1056964608
    return A.table(spark, d, "part").select("p_partkey", codec.round_mantissa(bits).alias("rounded"))


# Runs, verdicts and files ---------------------------------------------------------------------------------------------


def _codes(spark: SparkSession, runs: dict) -> DataFrame:
    """scenario and code: 0, or the one a run is refused with or a verdict has."""
    rows = []
    for scenario, run in runs.items():
        try:
            out = run()
            rows.append((scenario, out.code if isinstance(out, Verdict) else 0))
        except Refused as e:
            rows.append((scenario, e.code))
    return spark.createDataFrame(rows, "scenario string, code int")


@query(f"""{RANKED}, c AS (SELECT count(*) FILTER (WHERE gen <> fgen OR exp <> fexp) > 0 AS conflict FROM w2), n AS (SELECT count(*) AS n FROM items WHERE ord = 0), o AS (SELECT bool_or((exp % 100 IN (61, 62, 71, 72)) <> (n >= 3)) AS odd FROM items),
p AS (SELECT lumi, event, exp, x1 FROM w3 WHERE rank = 1), t AS (SELECT count(*) > 0 AS close FROM p a JOIN p b ON a.lumi = b.lumi AND a.event = b.event AND a.x1 < b.x1
  WHERE (a.exp IN (61, 71) OR b.exp IN (61, 71)) AND abs(a.x1::DOUBLE - b.x1::DOUBLE) <= 0.0009765625 * greatest(abs(a.x1), abs(b.x1))::DOUBLE)
SELECT 'stop' AS scenario, CASE WHEN conflict THEN 8 WHEN odd THEN 7 ELSE 0 END AS code FROM c, o UNION ALL SELECT 'report', CASE WHEN odd THEN 7 ELSE 0 END FROM o UNION ALL SELECT 'expected', CASE WHEN odd THEN 7 ELSE 0 END FROM o
UNION ALL SELECT 'unexpected', 6 FROM n UNION ALL SELECT 'unknown dataset', 2 UNION ALL SELECT 'no rows', 6 UNION ALL SELECT 'too close', 9 UNION ALL SELECT 'inconsistent', 7""")
def patch_runs(spark: SparkSession, d: str) -> DataFrame:
    """The codes that whole extractions end with."""
    rows = A.prioritised(spark, d).drop("dataset", "datasetIdx", "priority", "ord")
    a, b, name = rows.where(F.col("pos.l_suppkey") % 2 == 0), rows.where(F.col("pos.l_suppkey") % 2 == 1), "/A/B/NANOAODSIM"
    both = [(name, 0, a), (name, 1, b)]
    # the same rows run after run, so what is found out about them is found once
    whole, n = extract.Extraction(both, 2), rows.count()
    # stored: a limit that is computed twice may take two rows
    one = stored(a.limit(1))
    near = [(name, 0, one.withColumns({"Generator_x1": F.lit(0.5).cast("float"), "Expanded_genTtbarId": F.lit(61), "nAddBJets": F.lit(3)}))]
    near.append((name, 0, near[0][2].withColumn("Generator_x1", F.lit(0.5 * (1 + 2.0**-11)).cast("float"))))
    odd = [(name, 0, one.withColumns({"Expanded_genTtbarId": F.lit(61), "nAddBJets": F.lit(1)}))]
    return _codes(spark, {
        "stop": lambda: whole.run(), "report": lambda: whole.run(on_conflict="report"), "expected": lambda: whole.run({name: n}, on_conflict="report"),
        "unexpected": lambda: whole.run({name: n + 1}), "unknown dataset": lambda: whole.run({"/C/D/NANOAODSIM": 1}), "no rows": lambda: extract.run([*both, (name, 2, a.limit(0))], 2),
        "too close": lambda: extract.run(near, 3), "inconsistent": lambda: extract.run(odd, 2),
    })


@query(f"{RANKED}, o AS (SELECT lumi, event, exp, x1, row_number() OVER (ORDER BY lumi, event, x1) - 1 AS place FROM w3 WHERE rank = 1 AND exp IN (61, 71)) SELECT lumi AS \"luminosityBlock\", event, x1 AS \"Generator_x1\", place FROM o")
def patch_order(spark: SparkSession, d: str) -> DataFrame:
    """The output's order: identity, fingerprints by their bits."""
    return order.row_index(extract.lookup(_rank3(spark, d)), *extract.identity(3), name="place").select("luminosityBlock", "event", "Generator_x1", "place")


@query("""
, t AS (SELECT 'b/' || (l_suppkey % 3) AS name, count(*) AS n FROM lineitem GROUP BY ALL) SELECT name AS dataset, (dense_rank() OVER (ORDER BY name) - 1)::INT AS "datasetIdx", n FROM t""")
def dataset_index(spark: SparkSession, d: str) -> DataFrame:
    rows = A.prioritised(spark, d).drop("dataset", "datasetIdx", "priority", "ord")
    parts = [(f"b/{k}", 0, rows.where(F.col("pos.l_suppkey") % 3 == k)) for k in (2, 0, 1)]
    return extract.inputs(parts).groupBy("dataset", "datasetIdx").agg(F.count("*").alias("n"))


@query(f"""{MASK}, c AS (SELECT (SELECT count(*) FROM sidecar) AS n, (SELECT count(*) FROM sidecar WHERE ev NOT IN (SELECT ev FROM ins)) AS beyond,
  (SELECT count(*) FROM (SELECT DISTINCT run, unnest(range(lo, hi + 1)) AS lumi FROM mask EXCEPT SELECT run, lumi FROM ins)) AS unseen)
SELECT 'all' AS scenario, CASE WHEN beyond > 0 THEN 1 WHEN n = 0 THEN 5 ELSE 0 END AS code FROM c UNION ALL SELECT 'inside', CASE WHEN n = beyond THEN 5 ELSE 0 END FROM c
UNION ALL SELECT 'full', CASE WHEN n = beyond THEN 5 WHEN unseen > 0 THEN 4 ELSE 0 END FROM c UNION ALL SELECT 'nothing', 5""")
def mask_containment(spark: SparkSession, d: str) -> DataFrame:
    rows, mask = A.sidecar(spark, d), _mask(spark)
    ins = intervals.inside(rows, mask)
    return _codes(spark, {
        "all": lambda: intervals.containment(rows, mask), "inside": lambda: intervals.containment(ins, mask), "full": lambda: intervals.containment(ins, mask, full=True), "nothing": lambda: intervals.containment(rows.limit(0), mask),
    })


@query(f"""{WIDE}, c AS (SELECT count(*) FILTER (WHERE mismatches > 0) AS n, count(*) FILTER (WHERE mismatches > 0 AND NOT regexp_matches(name, 'price|^o_cust')) AS m FROM w)
SELECT 'equal' AS scenario, 0 AS code UNION ALL SELECT 'values', CASE WHEN n > 0 THEN 4 ELSE 0 END FROM c UNION ALL SELECT 'allowed', CASE WHEN m > 0 THEN 4 ELSE 0 END FROM c UNION ALL SELECT 'counted only', 0 UNION ALL SELECT 'schema', 1 UNION ALL SELECT 'expected schema', 0 UNION ALL SELECT 'few', 1""")
def wide_judgement(spark: SparkSession, d: str) -> DataFrame:
    o = A.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    m, same = _wide(spark, d), wide.schema_diff(o, o)
    more = wide.schema_diff(o, o.withColumn("o_extra", F.lit(1)))
    none = m.where("false")
    return _codes(spark, {
        "equal": lambda: wide.judge(none, same), "values": lambda: wide.judge(m, same), "allowed": lambda: wide.judge(m, same, allow="price|^o_cust"), "counted only": lambda: wide.judge(m, same, zero=False),
        "schema": lambda: wide.judge(none, more), "expected schema": lambda: wide.judge(none, more, only_right={"o_extra"}), "few": lambda: wide.judge(none, same, least_common=5),
    })


@query("SELECT 'good' AS scenario, 0 AS code UNION ALL SELECT 'empty', 42 UNION ALL SELECT 'conflict', 43 UNION ALL SELECT 'repeat', 0 UNION ALL SELECT 'unreadable', 41 UNION ALL SELECT 'hits', CASE WHEN (SELECT count(*) FROM orders WHERE o_orderkey % 997 = 0 AND o_orderkey % 37 <> 0) >= 0 THEN 44 END UNION ALL SELECT 'hits counted', 0")
def lookup_checks(spark: SparkSession, d: str) -> DataFrame:
    held, rows = _lookup(spark, d).drop("ev", "cust"), A.sidecar(spark, d)
    wrong = resolve.counters(resolve.resolve(rows, held.withColumn("genTtbarId", F.col("genTtbarId") + 1)))
    return _codes(spark, {
        "good": lambda: resolve.check_lookup(held), "empty": lambda: resolve.check_lookup(held.limit(0)), "conflict": lambda: resolve.check_lookup(held.unionByName(held.withColumn("nAddBJets", F.col("nAddBJets") + 1))),
        "repeat": lambda: resolve.check_lookup(held.unionByName(held)), "unreadable": lambda: resolve.load_lookup(spark, f"{d}/no_such_table.parquet"), "hits": lambda: resolve.check_hits(wrong), "hits counted": lambda: resolve.check_hits(wrong, stop=False),
    })


@query("""
, r AS (SELECT nano.gen AS own, s.exp FROM nano LEFT JOIN (SELECT * FROM sidecar WHERE exp % 100 IN (61, 62, 71, 72) AND ev % 2 = 0) s ON s.lumi = nano.lumi AND s.event = nano.event)
SELECT 'own' AS dataset, count(*) FILTER (WHERE exp IS NOT NULL) AS hits, count(*) FILTER (WHERE exp IS NULL) AS misses FROM r UNION ALL SELECT 'none', 0, count(*) FROM r""")
def resolve_by_dataset(spark: SparkSession, d: str) -> DataFrame:
    """The dataset is part of the key; a sample without lookup table keeps its own codes."""
    key = ("datasetIdx", *resolve.KEY)
    held = A.sidecar(spark, d).where(codec.is_ttnb("Expanded_genTtbarId")).withColumn("datasetIdx", (F.col("ev") % 2).cast("int"))
    rows = A.nano(spark, d)
    own = resolve.counters(resolve.resolve(rows.withColumn("datasetIdx", F.lit(0)), held, key)).select(F.lit("own").alias("dataset"), "hits", "misses")
    return own.unionByName(resolve.counters(resolve.resolve(rows, None)).select(F.lit("none").alias("dataset"), "hits", "misses"))


@query("SELECT 'orders' AS dataset, 1 AS \"datasetIdx\", count(*) AS n FROM orders UNION ALL SELECT 'supplier', 0, count(*) FROM supplier")
def dataset_by_file(spark: SparkSession, d: str) -> DataFrame:
    index = spark.createDataFrame([("supplier", 0), ("orders", 1)], "dataset string, datasetIdx int")
    one = lambda name: resolve.with_dataset(A.table(spark, d, name), r"/(orders|supplier)\.parquet", index).groupBy("dataset", "datasetIdx").agg(F.count("*").alias("n"))
    return one("orders").unionByName(one("supplier"))


@query("SELECT 'all' AS what, (SELECT count(*) FROM orders) + (SELECT count(*) FROM supplier) AS rows, false AS indicative UNION ALL SELECT 'with a lost file', (SELECT count(*) FROM orders) + (SELECT count(*) FROM supplier), true UNION ALL SELECT 'first file', (SELECT count(*) FROM supplier), false")
def opened_files(spark: SparkSession, d: str) -> DataFrame:
    """Rows counted before the scan, with a file that can't be opened, and with a limit to the number of files."""
    files = [f"{d}/supplier.parquet", f"{d}/orders.parquet"]
    whole = manifest.open_check(spark, files)
    part = manifest.open_check(spark, [*files, f"{d}/no_such_table.parquet"], attempts=1, allow_missing=True)
    manifest.check_complete(whole.total, part.total)
    first = manifest.scan(spark, files, max_files=1).agg(F.lit("first file").alias("what"), F.count("*").alias("rows"), F.lit(False).alias("indicative"))
    return spark.createDataFrame([("all", whole.total, whole.indicative), ("with a lost file", part.total, part.indicative)], first.schema).unionByName(first)


@query("SELECT exp % 100 AS sub, count(*) AS n FROM sidecar GROUP BY ALL")
def sidecar_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """A sidecar table that was written and read back."""
    out = scratch(spark, "sidecar")
    sinks.write_sidecar(A.sidecar(spark, d), out)
    return spark.read.parquet(out).groupBy(codec.sub_code("Expanded_genTtbarId").alias("sub")).agg(F.count("*").alias("n"))


@query("""
, p AS (SELECT run, lumi, event, (row_number() OVER (ORDER BY run, lumi, event) - 1) // 1000 AS part FROM sidecar) SELECT part, count(*) AS rows, min(run) AS first_run, min(lumi) AS "first_luminosityBlock" FROM p GROUP BY part""")
def shards_on_disk(spark: SparkSession, d: str) -> DataFrame:
    """The index that lies beside sorted parts of exact length."""
    return sinks.write_shards(A.sidecar(spark, d).select(*order.KEY), scratch(spark, "shards"), 1000).select("part", "rows", "first_run", "first_luminosityBlock")


@query("SELECT 0 AS at, '#key\tname' AS value UNION ALL SELECT row_number() OVER (ORDER BY s_suppkey DESC), s_suppkey || chr(9) || 'n' || (s_suppkey % 5) FROM supplier")
def task_lines(spark: SparkSession, d: str) -> DataFrame:
    """A task plan as lines of one file, in the plan's order."""
    out = f"{scratch(spark, 'tasks')}.tsv"
    k = F.col("s_suppkey")
    sinks.write_tsv(A.table(spark, d, "supplier").select(k.alias("key"), F.concat(F.lit("n"), k % 5).alias("name")).orderBy(F.desc("key")), out)
    return spark.read.text(out, wholetext=True).select(F.posexplode(F.split(F.rtrim("value", F.lit("\n")), "\n")).alias("at", "value"))


@query(f"{CHUNKS} SELECT sample, chunk::INT AS chunk, matched, exit_code FROM chunks")
def chunk_documents(spark: SparkSession, d: str) -> DataFrame:
    """Chunk counters written as JSON documents and read back."""
    out = scratch(spark, "chunks")
    sinks.counters_json(_chunks(spark, d)).write.text(out)
    return manifest.read_chunks(spark, out, lines=True).select("sample", "chunk", "matched", "exit_code")


@query("SELECT count(*) AS n, sum(exp)::BIGINT AS codes FROM sidecar")
def row_files(spark: SparkSession, d: str) -> DataFrame:
    """Rows in plain text, read back with their types."""
    out = scratch(spark, "rows")
    A.sidecar(spark, d).select(*order.KEY, *audit.PAYLOAD).write.csv(out, sep=" ")
    return manifest.read_rows(spark, out).agg(F.count("*").alias("n"), F.sum("Expanded_genTtbarId").alias("codes"))


@query("SELECT 0 AS at, 'LEAF n_nationkey bigint' AS line UNION ALL SELECT 1, 'LEAF n_regionkey bigint' UNION ALL SELECT row_number() OVER (ORDER BY n_nationkey) + 1, 'ROW ' || n_nationkey || ' ' || n_regionkey FROM nation")
def table_dump(spark: SparkSession, d: str) -> DataFrame:
    lines = sinks.dump(A.table(spark, d, "nation").select(F.col("n_nationkey").cast("bigint"), F.col("n_regionkey").cast("bigint")))
    return spark.createDataFrame(list(enumerate(lines)), "at bigint, line string")


@query("SELECT o_orderkey, format('{:,}', o_orderkey * 1234567) AS n, strftime(make_timestamp(o_orderkey * 86399 * 1000000), '%Y-%m-%d %H:%M:%S UTC') AS utc FROM orders")
def report_texts(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    return A.table(spark, d, "orders").select("o_orderkey", sinks.thousands(k * 1_234_567).alias("n"), sinks.stamp(k * 86_399).alias("utc"))


@query(f"SELECT {COUNTERS}, 0 AS n_dup FROM matched")
def incremental_audit(spark: SparkSession, d: str) -> DataFrame:
    """The audit of a sidecar table that comes in three batches, each of which repeats nothing."""
    out = scratch(spark, "incremental")
    side = stored(A.sidecar(spark, d))
    for k in range(3):
        incremental.write_batch(side.where(F.col("ev") % 3 == k), f"{out}/in")
    reference = stored(A.nano(spark, d))
    incremental.incremental_counters(incremental.stream(spark, f"{out}/in", side.schema, incremental.FILES), reference, f"{out}/by_batch", f"{out}/checkpoint").awaitTermination()
    return incremental.totals(spark, f"{out}/by_batch", reference)


@query("SELECT s.lumi AS \"luminosityBlock\", count(*) AS n FROM sidecar s WHERE (s.run, s.lumi) IN (SELECT run, lumi FROM sidecar WHERE exp % 100 IN (71, 72)) GROUP BY ALL")
def prefiltered_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = A.sidecar(spark, d)
    kept = extract.prefilter(rows, rows.where(codec.sub_code("Expanded_genTtbarId").isin(71, 72)))
    return kept.groupBy("luminosityBlock").agg(F.count("*").alias("n"))


_SPECS = ("/A/B/NANOAODSIM=list.txt", "/A/B/NANOAODSIM=list.txt:3", "/A/B/NANOAODSIM=list.txt:1234567", "/A/B/NANOAODSIM=a:b:3", "/A/B/NANOAODSIM=", "/A/B/MINIAODSIM=x", "A=x", "/A/B/NANOAODSIM", "/A/B/NANOAODSIM=x:", "/A/C/NANOAODSIM=y=z:07")


@query(f"""
, t AS (SELECT unnest({list(_SPECS)}) AS text), x AS (SELECT text, regexp_full_match(text, '/[^/]+/[^/]+/NANOAODSIM=[^:]+(:[0-9]{{1,6}})?') AS ok FROM t)
SELECT text, CASE WHEN ok THEN regexp_extract(text, '^([^=]*)=', 1) END AS dataset, CASE WHEN ok THEN regexp_extract(text, '^[^=]*=([^:]*)', 1) END AS manifest, CASE WHEN ok THEN coalesce(try_cast(regexp_extract(text, ':([0-9]+)$', 1) AS INT), 0) END AS priority,
  CASE WHEN ok THEN 0 ELSE 2 END AS code FROM x""")
def input_specs(spark: SparkSession, d: str) -> DataFrame:
    """Inputs as they are given on a command line; what can be read in two ways is refused."""
    rows = []
    for text in _SPECS:
        try:
            rows.append((text, *extract.parse_spec(text), 0))
        except Refused as e:
            rows.append((text, None, None, None, e.code))
    return spark.createDataFrame(rows, "text string, dataset string, manifest string, priority int, code int")


_FILES = ("root://door.example//store/a.root", "root://other.example//store//a.root?x=1", "file:///data/./b", "/data/c/../b", "/data/d", "https://h.example/store/e")


@query(f"""
, t AS (SELECT unnest({list(_FILES)}) AS path), d AS (SELECT regexp_replace(regexp_replace(path, '\\?.*', ''), '^[a-z]+://[^/]*', '') AS p FROM t),
s AS (SELECT regexp_replace(replace(regexp_replace(p, '/+', '/', 'g'), '/./', '/'), '/[^/]+/[.][.]/', '/') AS file FROM d) SELECT file, count(*) AS times FROM s GROUP BY file HAVING count(*) > 1""")
def repeated_files(spark: SparkSession, d: str) -> DataFrame:
    """Files that are given more than once under different names."""
    twice = manifest.repeated_files({"one": list(_FILES[:3]), "two": list(_FILES[3:])})
    names = [manifest.normalise(f) for f in _FILES]
    return spark.createDataFrame([(f, names.count(f)) for f in twice], "file string, times bigint")
