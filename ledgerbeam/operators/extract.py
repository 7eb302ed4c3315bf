"""Extraction of the events with extra jets into a small lookup table.

Formats 1 to 3 are one pipeline that differs in what identifies an event:

* 1: nothing, input order and repeats stay, no conflicts are looked for;
* 2: dataset and key;
* 3: dataset, key and the bits of the event's fingerprint.

Inputs are DataFrames with the columns of ``inputs``.  Rows of an identity are
ranked by the input's priority, then by the order inputs are given in, then by
their position.  All rows take part in priority and conflicts; only the first
of an identity can be written, and only if it has extra jets.

Counters: ``shared`` counts identities present in two or more inputs,
``superseded`` rows that lose to another input, ``repeated`` extra rows of an
identity inside one input, ``conflicts`` rows whose codes differ from the first
row's, ``other_counts`` rows with the same codes and other jet counts.
"""

from __future__ import annotations

import re
from functools import cached_property
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from ..functions import codec
from ..functions.store import stored
from ..plans.verdict import Refused

KEY = ("run", "luminosityBlock", "event")
FINGERPRINT = ("Generator_x1", "Generator_x2", "Generator_id1", "Generator_id2")
BITS = ("x1_bits", "x2_bits", "Generator_id1", "Generator_id2")
GRAMMAR = re.compile(r"/[^/]+/[^/]+/NANOAODSIM")


class Spec(NamedTuple):
    dataset: str
    manifest: str
    priority: int


def valid_dataset(name: str) -> bool:
    return GRAMMAR.fullmatch(name) is not None


def valid(name: Column) -> Column:
    """valid_dataset for columns."""
    return F.coalesce(name.rlike(f"^{GRAMMAR.pattern}$"), F.lit(False))


def parse_spec(text: str) -> Spec:
    """``DATASET=MANIFEST[:PRIORITY]``; a last part of one to six digits is the priority, other uses of a colon are refused."""
    name, found, rest = text.partition("=")
    if not found or not valid_dataset(name) or not rest:
        raise Refused(2, f"bad input {text!r}")
    manifest, colon, last = rest.rpartition(":")
    if not colon:
        return Spec(name, rest, 0)
    if not manifest or not re.fullmatch(r"[0-9]{1,6}", last) or ":" in manifest:
        raise Refused(2, f"ambiguous input {text!r}")
    return Spec(name, manifest, int(last))


def specs(texts: DataFrame) -> DataFrame:
    """parse_spec for a table of inputs (text): text, dataset, manifest, priority, and code, 2 for what can't be read or can be read in two ways."""
    whole = r"^(/[^/=]+/[^/=]+/NANOAODSIM)=([^:]+)(:([0-9]{1,6}))?$"
    part = lambda k: F.regexp_extract("text", whole, k)
    ok = F.coalesce(F.col("text").rlike(whole), F.lit(False))
    priority = F.when(part(4) == "", F.lit(0)).otherwise(F.expr("try_cast(regexp_extract(text, ':([0-9]+)$', 1) AS int)"))
    return texts.select("text", F.when(ok, part(1)).alias("dataset"), F.when(ok, part(2)).alias("manifest"), F.when(ok, priority).alias("priority"), F.when(ok, 0).otherwise(2).alias("code"))


def detect_format(columns_by_file: dict[str, list[str]]) -> int:
    """3 if every file has all fingerprint columns, 2 if none has any; mixtures are refused rather than filled with nulls."""
    have = {sum(c in columns for c in FINGERPRINT) for columns in columns_by_file.values()}
    if have == {4}:
        return 3
    if have <= {0}:
        return 2
    raise Refused(5, "files differ in their fingerprint columns")


def inputs(parts: list[tuple[str, int, DataFrame]]) -> DataFrame:
    """Union of (dataset, priority, table with a column pos) with dataset, priority, ord, datasetIdx."""
    index = {name: k for k, name in enumerate(sorted({name for name, _, _ in parts}))}
    out = None
    for order, (name, priority, df) in enumerate(parts):
        one = df.withColumns({"dataset": F.lit(name), "datasetIdx": F.lit(index[name]), "priority": F.lit(priority), "ord": F.lit(order)})
        out = one if out is None else out.unionByName(one)
    return out


def with_bits(rows: DataFrame) -> DataFrame:
    """Fingerprint bits as unsigned numbers."""
    return rows.withColumns({"x1_bits": codec.unsigned(codec.float_bits("Generator_x1")), "x2_bits": codec.unsigned(codec.float_bits("Generator_x2"))})


def identity(fmt: int) -> list[str]:
    return ["datasetIdx", *KEY, *(BITS if fmt == 3 else ())]


def prefilter(rows: DataFrame, wanted: DataFrame, key=("run", "luminosityBlock")) -> DataFrame:
    """The rows whose block any wanted row has, before a join on the whole key; Spark broadcasts the blocks where they are few."""
    return rows.join(wanted.select(*key).distinct(), list(key), "left_semi")


def inconsistent(rows: DataFrame) -> DataFrame:
    """Rows where the sub-code and the number of jets tell different things."""
    return rows.where(codec.is_ttnb("Expanded_genTtbarId") != (F.col("nAddBJets") >= 3))


def ranked(rows: DataFrame, fmt: int) -> DataFrame:
    """rows with rank in their identity and what they differ in from its first row."""
    order = Window.partitionBy(*identity(fmt)).orderBy("priority", "ord", "pos")
    own = Window.partitionBy(*identity(fmt), "ord").orderBy("pos")
    everything = Window.partitionBy(*identity(fmt))
    first = lambda c: F.first(c).over(order)
    codes = (F.col("genTtbarId") != first("genTtbarId")) | (F.col("Expanded_genTtbarId") != first("Expanded_genTtbarId"))
    counts = (F.col("nAddBJets") != first("nAddBJets")) | (F.col("nAddBJetsMulti") != first("nAddBJetsMulti"))
    return rows.withColumns({
        "rank": F.row_number().over(order), "own_rank": F.row_number().over(own), "first_ord": first("ord"),
        "inputs": F.size(F.collect_set("ord").over(everything)),
        "conflict": codes, "other_counts": ~codes & counts,
    })


def several(rows: DataFrame, fmt: int) -> DataFrame:
    """The identities with two or more rows, stored; only their columns are exchanged.

    One dataset's inputs meet in few blocks where they hold different parts of it.  Rows of its largest input whose block no
    other input has can only repeat rows of their own input, so both kinds are looked for apart, and the blocks are compared
    before the keys.
    """
    key = identity(fmt)
    thin = rows.select(*key, "ord")
    own = thin.groupBy(*key, "ord").agg(F.count("*").alias("_n")).where("_n > 1").select(*key)
    blocks = thin.groupBy("datasetIdx", *KEY[:2]).agg(F.min("ord").alias("_a"), F.max("ord").alias("_b")).where("_a < _b")
    shared = prefilter(thin, blocks, ("datasetIdx", *KEY[:2]))
    across = shared.groupBy(*key).agg(F.min("ord").alias("_a"), F.max("ord").alias("_b")).where("_a < _b").select(*key)
    return stored(own.unionByName(across).distinct())


def _not_alone(rows: DataFrame, fmt: int, most: float) -> DataFrame | None:
    """several, or None where over most of all rows aren't alone with their identity."""
    # about how many rows are no identity's first, from a pass that exchanges none of them; it decides the way, not the result
    total, distinct = rows.agg(F.count("*"), F.approx_count_distinct(F.struct(*identity(fmt)), 0.02)).first()
    if total - distinct > most * total:
        return None
    keys = several(rows, fmt)
    return None if keys.count() > most * total / 2 else keys


def ranked_sparse(rows: DataFrame, fmt: int, most: float = 0.2) -> DataFrame:
    """ranked, by way of several: rows that are alone with their identity are first by themselves and go through no window.

    Where over most of all rows aren't alone, all of them are ranked together.
    """
    keys = _not_alone(rows, fmt, most)
    return ranked(rows, fmt) if keys is None else _ranked_by(rows, keys, fmt)


def _ranked_by(rows: DataFrame, keys: DataFrame, fmt: int) -> DataFrame:
    key = identity(fmt)
    no = F.lit(False)
    alone = rows.join(keys, key, "left_anti").withColumns({"rank": F.lit(1), "own_rank": F.lit(1), "first_ord": F.col("ord"), "inputs": F.lit(1), "conflict": no, "other_counts": no})
    return alone.unionByName(ranked(rows.join(keys, key, "left_semi"), fmt).select(*alone.columns))


def format1(rows: DataFrame) -> DataFrame:
    return rows.where(codec.is_ttnb("Expanded_genTtbarId"))


def lookup(rank: DataFrame) -> DataFrame:
    """The rows to write."""
    return rank.where((F.col("rank") == 1) & codec.is_ttnb("Expanded_genTtbarId"))


def ordered(lookup_rows: DataFrame, fmt: int) -> DataFrame:
    return lookup_rows.orderBy(*identity(fmt))


def sources(rank: DataFrame) -> DataFrame:
    """By input: entries, superseded, repeated, written."""
    written = (F.col("rank") == 1) & codec.is_ttnb("Expanded_genTtbarId")
    return rank.groupBy("dataset", "priority", "ord").agg(
        F.count("*").alias("entries"), F.count_if((F.col("ord") != F.col("first_ord")) & (F.col("own_rank") == 1)).alias("superseded"),
        F.count_if(F.col("own_rank") > 1).alias("repeated"), F.count_if(written).alias("written"),
    )


def conflict_counts(rank: DataFrame) -> DataFrame:
    """One row: conflicts, other_counts, shared, repeated."""
    return rank.agg(*_counts())


def _counts() -> list[Column]:
    return [
        F.count_if("conflict").alias("conflicts"), F.count_if("other_counts").alias("other_counts"), F.count_if(F.col("own_rank") > 1).alias("repeated"),
        F.count_if((F.col("rank") == 1) & (F.col("inputs") > 1)).alias("shared"),
    ]


def multi_event_keys(rank: DataFrame) -> DataFrame:
    """By dataset: keys that two or more events share (format 3), and those with two or more rows written."""
    keys = rank.where("rank = 1").groupBy("dataset", "datasetIdx", *KEY).agg(
        F.count("*").alias("events"), F.count_if(codec.is_ttnb("Expanded_genTtbarId")).alias("selected")
    )
    return keys.groupBy("dataset").agg(F.count_if(F.col("events") >= 2).alias("multi_event_keys"), F.count_if(F.col("selected") >= 2).alias("multi_selected_keys"))


#: Cells of fractions, in powers of two; wider than the distance of near ones, so these lie in one cell or in adjacent ones.
CELL = 0.0015
_EVENT = ("Generator_x1", "Generator_x2", "x1_bits", "x2_bits", "Generator_id1", "Generator_id2", "Expanded_genTtbarId")


def _cell(x: Column) -> Column:
    """The cell of a fraction by sign and logarithm; 0 and what isn't finite have cells far from all others."""
    v, far = x.cast("double"), 4 * 10**6
    log = F.floor(F.log2(F.abs(v)) / CELL).cast("bigint") + 10**6
    return F.when(v == 0, F.lit(0)).when(F.isnan(v), F.lit(2 * far)).when(F.abs(v) == float("inf"), F.signum(v).cast("bigint") * far).otherwise(F.signum(v).cast("bigint") * log)


def meeting(rank: DataFrame) -> DataFrame:
    """Pairs that too_close looks at: an event with extra jets (e) and another one (f) of its key and ids whose fractions lie
    within a cell of its own.  A key's events are spread over their cells, however many there are."""
    first = rank.where("rank = 1").select("datasetIdx", *KEY, F.struct(*_EVENT).alias("e"))
    first = first.withColumns({"_id1": F.col("e.Generator_id1"), "_id2": F.col("e.Generator_id2"), "_c1": _cell(F.col("e.Generator_x1")), "_c2": _cell(F.col("e.Generator_x2"))})
    around = lambda c: F.explode(F.sequence(F.col(c) - 1, F.col(c) + 1))
    wanted = first.where(codec.is_ttnb("e.Expanded_genTtbarId")).withColumn("_c1", around("_c1")).withColumn("_c2", around("_c2"))
    return wanted.join(first.withColumnRenamed("e", "f"), ["datasetIdx", *KEY, "_id1", "_id2", "_c1", "_c2"]).select("datasetIdx", *KEY, "e", "f")


def too_close(rank: DataFrame) -> DataFrame:
    """Pairs of distinct events that share a key and ids, one of them with extra jets, and whose fingerprints are nearly the same.

    Each pair comes once, in order.  An event meets its neighbours in both fractions only, so the work is linear in a key's
    events unless they are close.
    """
    e, f = F.col("e"), F.col("f")
    # of two events with extra jets the lesser one brings the pair
    once = (e < f) | ~codec.is_ttnb("f.Expanded_genTtbarId") & (e != f)
    near = codec.near(e["Generator_x1"], f["Generator_x1"]) & codec.near(e["Generator_x2"], f["Generator_x2"])
    return meeting(rank).where(once & near).select("datasetIdx", *KEY, F.least(e, f).alias("a"), F.greatest(e, f).alias("b"))


def summary(lookup_rows: DataFrame) -> DataFrame:
    """Written rows by dataset and sub-code, with totals by rollup."""
    return lookup_rows.rollup("dataset").agg(
        F.count("*").alias("n"), *(F.count_if(codec.sub_code("Expanded_genTtbarId") == s).alias(f"n{s}") for s in codec.TTNB)
    )


def by_origin(lookup_rows: DataFrame) -> DataFrame:
    return lookup_rows.groupBy(codec.sub_code("genTtbarId").alias("gen_sub")).agg(F.count("*").alias("n"))


class Extraction:
    """Inputs, as DataFrames that give the same rows whenever they are read, and what is found out about them.

    Each is found once, however many runs ask for it, and only by the run that gets so far; ranked rows are not stored, as they
    would be a copy of the inputs: the counters, the pairs and the output read them.
    """

    def __init__(self, parts: list[tuple[str, int, DataFrame]], fmt: int):
        self.fmt, self.count, self.names = fmt, len(parts), {name for name, _, _ in parts}
        self.rows = with_bits(inputs(parts)) if fmt == 3 else inputs(parts)

    @cached_property
    def by_input(self) -> list[Row]:
        """ord, dataset, n, odd and large of each input that has rows; no row is exchanged."""
        small = lambda c: F.col(c).between(-(2**15), 2**15 - 1)
        odd = codec.is_ttnb("Expanded_genTtbarId") != (F.col("nAddBJets") >= 3)
        return self.rows.groupBy("ord", "dataset").agg(
            F.count("*").alias("n"), F.count_if(odd).alias("odd"), F.count_if(~(small("nAddBJets") & small("nAddBJetsMulti"))).alias("large")
        ).collect()

    @cached_property
    def _keys(self) -> DataFrame | None:
        return _not_alone(self.rows, self.fmt, 0.2)

    @cached_property
    def rank(self) -> DataFrame:
        return ranked(self.rows, self.fmt) if self._keys is None else _ranked_by(self.rows, self._keys, self.fmt)

    @cached_property
    def counts(self) -> dict:
        """conflicts, other_counts, repeated, shared; rows that are alone with their identity count for none of them."""
        key = identity(self.fmt)
        met = self.rows if self._keys is None else self.rows.join(self._keys, key, "left_semi")
        return conflict_counts(ranked(met, self.fmt)).first().asDict()

    @cached_property
    def close(self) -> int:
        return too_close(self.rank).count()

    def run(self, expect: dict[str, int] | None = None, on_conflict: str = "stop", on_close: str = "stop") -> tuple[DataFrame, dict]:
        """The lookup table and its counters; refused with the code of the first failed check, before anything is written."""
        for name in expect or {}:
            if name not in self.names:
                raise Refused(2, f"expectation for unknown dataset {name}")
        if any(r["large"] for r in self.by_input):
            raise Refused(5, "jet counts beyond 16 bits")
        if {r["ord"] for r in self.by_input} != set(range(self.count)):
            raise Refused(6, "an input has no rows")
        entries = {name: sum(r["n"] for r in self.by_input if r["dataset"] == name) for name in self.names}
        for name, n in (expect or {}).items():
            if entries[name] != n:
                raise Refused(6, f"{name}: {entries[name]} rows, {n} expected")
        counts = dict(self.counts)
        if counts["conflicts"] and on_conflict == "stop":
            raise Refused(8, f"{counts['conflicts']} conflicts")
        if self.fmt == 3:
            counts["too_close"] = self.close
            if counts["too_close"] and on_close == "stop":
                raise Refused(9, f"{counts['too_close']} pairs too close")
        if any(r["odd"] for r in self.by_input):
            raise Refused(7, "sub-codes and jet counts differ")
        return ordered(lookup(self.rank), self.fmt), counts | {"entries": sum(entries.values()), "datasets": len(self.names), "inputs": self.count}


def run(parts: list[tuple[str, int, DataFrame]], fmt: int, expect: dict[str, int] | None = None, on_conflict: str = "stop", on_close: str = "stop") -> tuple[DataFrame, dict]:
    """Extraction.run of inputs that are run once."""
    return Extraction(parts, fmt).run(expect, on_conflict, on_close)
