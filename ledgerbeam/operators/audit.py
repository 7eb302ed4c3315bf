"""Audit of two independently produced tables that share a key.

All functions return DataFrames; ``verdict`` collects one row.  The probe side
is never multiplied: repeated keys of the build side are reported by
``duplicates``, which a verdict heeds before any comparison.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import codec
from ..plans.verdict import AUDIT, Code, Verdict, decide

KEY = ("run", "luminosityBlock", "event")
PAYLOAD = ("genTtbarId", "Expanded_genTtbarId", "nAddBJets", "nAddBJetsMulti")


def _n(condition: Column) -> Column:
    return F.count_if(condition)


def unique_side(side: DataFrame, key=KEY, payload=PAYLOAD) -> DataFrame:
    """One row per key, with the number of rows it stands for; repeated keys show the least value of each column.

    The join on the same key needs no further shuffle, and plain minima stay in hash aggregation.
    """
    by = side.groupBy(*key).agg(F.count("*").alias("side_rows"), *(F.min(c).alias(f"_{c}") for c in payload))
    return by.select(*key, F.struct(*(F.col(f"_{c}").alias(c) for c in payload)).alias("side"), "side_rows")


def match(nano: DataFrame, side: DataFrame, key=KEY) -> DataFrame:
    """Every row of nano with side (null if unmatched)."""
    return nano.join(unique_side(side, key), list(key), "left")


def duplicates(side: DataFrame, key=KEY) -> DataFrame:
    """Keys with more than one row, and how many more."""
    return side.groupBy(*key).agg((F.count("*") - 1).alias("extra")).where("extra > 0")


def last_wins(side: DataFrame, key: tuple[str, ...], position: str, value: str) -> DataFrame:
    """The value of the last row of each key in scan order, and how many rows it overwrote."""
    return side.groupBy(*key).agg(F.max_by(value, position).alias(value), (F.count("*") - 1).alias("overwritten"))


def flags() -> dict[str, Column]:
    """Conditions on matched rows, by the counters' names."""
    gen, exp, n, multi = (F.col(f"side.{c}") for c in PAYLOAD)
    ge3, ext = n >= 3, codec.is_ttnb(exp)
    return {
        "agree": gen == F.col("genTtbarId"),
        "disagree": gen != F.col("genTtbarId"),
        "nAddBJets_ge3": ge3,
        "expanded_sub_in_set": ext,
        "viol_ext_but_lt3": ext & ~ge3,
        "viol_ge3_not_ext": ge3 & ~ext,
        "viol_prefix_changed": ext & (codec.prefix(exp) != codec.prefix(gen)),
        "viol_wrong_sub": ext & F.coalesce(codec.sub_code(exp) != codec.want_sub(n, multi), F.lit(True)),
        "viol_unchanged": ~ext & (exp != gen),
        "viol_le2_changed": ~ge3 & (exp != gen),
    }


def counters(matched: DataFrame, *by: str) -> DataFrame:
    """All counters of match()'s rows, of the whole or by groups."""
    there = F.col("side").isNotNull()
    out = matched.groupBy(*by).agg(
        F.count("*").alias("nano_entries"), _n(there).alias("matched"), _n(~there).alias("unmatched"), _n(F.col("run") != 1).alias("run_not_1"),
        *(_n(there & x).alias(name) for name, x in flags().items()),
    )
    return out.withColumn("not_conserved", F.abs(F.col("nAddBJets_ge3") - F.col("expanded_sub_in_set")))


def verdict(nano: DataFrame, side: DataFrame, checks=AUDIT) -> Verdict:
    """All counters and the code that the order of checks yields; unmatched rows alone are no failure here."""
    row = counters(match(nano, side)).first().asDict()
    more = side.agg(_n(F.col("run") != 1).alias("r")).first()["r"]
    row["run_not_1"] += more
    row["n_dup"] = duplicates(side).agg(F.coalesce(F.sum("extra"), F.lit(0)).alias("n")).first()["n"]
    return decide(row, checks)


def disagreements(matched: DataFrame) -> DataFrame:
    """Disagreeing rows by sub-code of the probed table, with its sign."""
    bad = matched.where(F.col("side").isNotNull() & (F.col("side.genTtbarId") != F.col("genTtbarId")))
    return bad.groupBy(codec.raw_sub_code("genTtbarId").alias("nano_sub")).agg(F.count("*").alias("n"))


def examples(matched: DataFrame, most: int = 20, key=KEY) -> DataFrame:
    """The first disagreeing rows by key."""
    bad = matched.where(F.col("side").isNotNull() & (F.col("side.genTtbarId") != F.col("genTtbarId")))
    return bad.select(*key, F.col("genTtbarId").alias("nano_gen"), F.col("side.genTtbarId").alias("side_gen")).orderBy(*key).limit(most)


def reclassified(matched: DataFrame) -> DataFrame:
    """Reclassified rows by origin: sub-codes of the sidecar's and of the probed table's own code."""
    rows = matched.where(F.col("side").isNotNull() & codec.is_ttnb(F.col("side.Expanded_genTtbarId")))
    return rows.groupBy(codec.sub_code("side.genTtbarId").alias("side_origin"), codec.sub_code("genTtbarId").alias("nano_origin")).agg(F.count("*").alias("n"))


def census(table: DataFrame, code: str) -> DataFrame:
    """Rows by sub-code, and their share of all rows."""
    by = table.groupBy(codec.raw_sub_code(code).alias("sub")).agg(F.count("*").alias("n"))
    # the window sees one row per sub-code
    return by.select("sub", "n", (F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy())).alias("percent"))


def conservation(left: DataFrame, right: DataFrame, left_code: str = "genTtbarId", right_code: str = "Expanded_genTtbarId") -> DataFrame:
    """Spot comparison of two tables' censuses: a row per check with both numbers and whether it holds."""
    moved = (53, 54, 55, *codec.TTNB)
    a = left.groupBy(codec.raw_sub_code(left_code).alias("sub")).agg(F.count("*").alias("a"))
    b = right.groupBy(codec.raw_sub_code(right_code).alias("sub")).agg(F.count("*").alias("b"))
    both = a.join(b, "sub", "full_outer").select("sub", F.coalesce("a", F.lit(0)).alias("a"), F.coalesce("b", F.lit(0)).alias("b"))
    sub = F.col("sub")
    total = lambda x, where: F.coalesce(F.sum(F.when(where, F.col(x))), F.lit(0))
    sums = both.agg(
        F.coalesce(F.sum("a"), F.lit(0)).alias("a0"), F.coalesce(F.sum("b"), F.lit(0)).alias("b0"),
        _n(~sub.isin(*moved)).alias("a1"), _n(~sub.isin(*moved) & (F.col("a") == F.col("b"))).alias("b1"),
        total("a", sub.isin(53, 54, 55)).alias("a2"), total("b", sub.isin(*moved)).alias("b2"),
        total("a", sub.isin(*codec.TTNB)).alias("a3"), F.lit(0).cast("bigint").alias("b3"),
    )
    names = ("totals_equal", "untouched_subs_equal", "bbb_conserved", "reference_has_no_extension")
    rows = F.array(*(F.struct(F.lit(name).alias("check"), F.col(f"a{k}").alias("left_n"), F.col(f"b{k}").alias("right_n")) for k, name in enumerate(names)))
    return sums.select(F.explode(rows).alias("r")).select("r.*").withColumn("holds", F.col("left_n") == F.col("right_n"))


def self_invariants(side: DataFrame, *by: str) -> DataFrame:
    """Invariants of one sidecar table by itself, without a join; each counter must be 0."""
    sub, n = codec.sub_code("Expanded_genTtbarId"), F.col("nAddBJets")
    changed = F.col("Expanded_genTtbarId") != F.col("genTtbarId")
    ext = codec.is_ttnb("Expanded_genTtbarId")
    return side.groupBy(*by).agg(
        F.count("*").alias("entries"), _n((n <= 2) & changed).alias("le2_changed"), _n((n == 3) & ~sub.isin(61, 62)).alias("eq3_other"),
        _n((n >= 4) & ~sub.isin(71, 72)).alias("ge4_other"), _n(sub == 56).alias("sub_56"),
        _n(codec.prefix("Expanded_genTtbarId") != codec.prefix("genTtbarId")).alias("prefix_changed"),
        _n(ext & ~codec.sub_code("genTtbarId").isin(53, 54, 55)).alias("other_origin"), _n(F.col("run") != 1).alias("run_not_1"),
    )


def by_file(side: DataFrame, manifest: DataFrame) -> DataFrame:
    """Self-invariants by file; files of the manifest without rows are listed as empty.  side has a column file."""
    return manifest.join(self_invariants(side, "file"), "file", "left").withColumn("empty", F.col("entries").isNull()).fillna(0)


def rule_violations(side: DataFrame) -> DataFrame:
    """Row rule and prefix rule, counted apart, so that a row may count twice; and whether 71 or 72 occurs."""
    # by arithmetic, not by the function that makes the codes: 61 and 62 for three jets, 71 and 72 for more
    own, n = F.col("genTtbarId"), F.col("nAddBJets")
    new = own - own % 100 + 31 + 10 * F.least(n, F.lit(4)) + (F.col("nAddBJetsMulti") >= 1).cast("int")
    rule = F.col("Expanded_genTtbarId") != F.when(n >= 3, new).otherwise(own)
    moved = F.floor(F.col("Expanded_genTtbarId") / 100) != F.floor(F.col("genTtbarId") / 100)
    return side.agg(
        F.count("*").alias("rows"), _n(rule).alias("rule"), _n(moved).alias("prefix"), (_n(rule) + _n(moved)).alias("violations"),
        F.coalesce(F.max(codec.sub_code("Expanded_genTtbarId").isin(71, 72)), F.lit(False)).alias("has_4b"),
    )


#: Counters of self_invariants that must be 0.
MUST_BE_ZERO = ("le2_changed", "eq3_other", "ge4_other", "sub_56", "prefix_changed", "other_origin", "run_not_1")


def rule_verdict(side: DataFrame, expect_4b: bool = False) -> Verdict:
    """2 if a row breaks a rule, 3 if 71 or 72 is expected and does not occur; tables that can't be read fail in the scan (4)."""
    row = rule_violations(side).first().asDict()
    if row["violations"]:
        return Verdict(2, "violations", row)
    return Verdict(3, "has_4b", row) if expect_4b and not row["has_4b"] else Verdict(0, None, row)


def spot_verdict(reference: DataFrame, side: DataFrame, position: str, key: tuple[str, ...] = ("run", "event")) -> Verdict:
    """Spot comparison: each row of the reference against the last row of side with its key, then the censuses.

    5 if nothing matches, 6 if codes differ, 7 if a census check fails; rows that others overwrite are counted.
    """
    last = last_wins(side, key, position, "genTtbarId").withColumnsRenamed({"genTtbarId": "_gen"})
    both = reference.join(last, list(key), "left").agg(
        _n(F.col("_gen").isNotNull()).alias("matched"), _n(F.col("_gen").isNull()).alias("unmatched"), _n(F.col("_gen") != F.col("genTtbarId")).alias("disagree")
    )
    row = both.first().asDict()
    row["overwritten"] = last.agg(F.coalesce(F.sum("overwritten"), F.lit(0)).alias("n")).first()["n"]
    row["broken"] = conservation(reference, side).where(~F.col("holds")).count()
    return decide(row, [(Code.NOTHING, "matched", "positive"), (Code.DISAGREE, "disagree", "zero"), (7, "broken", "zero")])


def files_verdict(files: DataFrame, statuses: DataFrame | None = None) -> Verdict:
    """Of by_file's rows: unreadable files fail first (1), then invariants (2); empty files do not fail.

    statuses: manifest.file_statuses' rows, which tell files that don't open, that are no tables, that lack columns and that
    fail while they are read.
    """
    row = files.agg(F.count("*").alias("files"), _n("empty").alias("empty_files"), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("entries", *MUST_BE_ZERO))).first().asDict()
    kinds = ("bad_open", "no_table", "bad_columns", "read_errors")
    row |= dict.fromkeys(kinds, 0)
    if statuses is not None:
        row |= {r["status"]: r["count"] for r in statuses.where(F.col("status").isin(*kinds)).groupBy("status").count().collect()}
    return decide(row, [*((1, k, "zero") for k in kinds), *((2, c, "zero") for c in MUST_BE_ZERO)])
