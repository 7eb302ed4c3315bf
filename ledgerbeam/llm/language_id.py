"""Language identification by Bayesian evidence fusion.

The posterior of a language is the product of

* the text's likelihood: a model of hashed byte trigrams for each language,
  fitted on at most ``PER_LANGUAGE`` texts of each that is declared in the
  labelled table, those with the smallest hash of their id; languages may be
  any number.  Neighbouring
  trigrams depend on each other, so log-likelihoods count ``TRUST`` times and a
  text of any length at most ``MOST`` against another language;
* the likelihood of the declared markup language (``<html lang>``), of the
  address suffix, and of the language code in the path;
* the host's prior: the host's mean text posterior, smoothed by that of its
  registered domain (its last three parts), which is smoothed by the mean of all
  rows, each with ``PSEUDO`` rows' weight.

Likelihoods of declarations and suffixes are smoothed grouped counts of them
against the texts' posteriors; all counts are grouped aggregates that are
summed before they are shuffled, and each row is taken out of its own host's
counts before it is judged.

Nulls: a null text or address gives no evidence.  A row without any evidence
gets the prior of all rows.  Languages are those of the labelled table; without
labelled rows ``lang`` is null.  Extra columns pass through, those that bear an
output's name are replaced.  Ties go to the first language by code point.
Repeated rows are judged one by one; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut

PER_LANGUAGE = 300
SLOTS = 1 << 15
TRUST = 0.25
MOST = 12.0
PSEUDO = 4.0


def trigrams(text: str | None) -> np.ndarray:
    """Slots of the text's byte trigrams in lower case, the whole text."""
    raw = np.frombuffer(b" " + " ".join((text or "").lower().split()).encode("utf-8", "replace") + b" ", np.uint8).astype(np.uint32)
    if len(raw) < 3:
        return np.zeros(0, np.uint32)
    mixed = (raw[:-2] * np.uint32(0x9E3779B1)) ^ (raw[1:-1] * np.uint32(0x85EBCA77)) ^ (raw[2:] * np.uint32(0xC2B2AE3D))
    return (mixed * np.uint32(0x27D4EB2F)) >> np.uint32(17)


def train(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> tuple[list[str], np.ndarray] | None:
    """Languages and their log probabilities of each slot.  labelled: doc_id, text, lang."""
    known = labelled.where(F.col("lang").isNotNull())
    # Spark limits the rows of each language before the exchange
    rank = F.row_number().over(Window.partitionBy("of").orderBy(F.xxhash64("i"), "i"))
    picks = known.select(F.col("lang").alias("of"), F.col("doc_id").alias("i")).withColumn("rank", rank).where(F.col("rank") <= per_language)
    picks = cut(picks.select("of", "i").distinct())
    langs = sorted(r["of"] for r in picks.select("of").distinct().collect())
    if not langs:
        return None
    some = picks.select("of", "i", (F.array_position(F.lit(langs), F.col("of")) - 1).cast("int").alias("k"))
    # at most per_language rows of a language, some 30 bytes each
    rows = known.join(F.broadcast(some), (F.col("doc_id") == F.col("i")) & (F.col("lang") == F.col("of")))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for pdf in batches:
            for text, k in zip(pdf["text"], pdf["k"], strict=True):
                sums[k] = sums.get(k, 0) + np.bincount(trigrams(text), minlength=SLOTS)
        yield pd.DataFrame({"k": list(sums), "counts": [x.astype("<i8").tobytes() for x in sums.values()]})

    total = np.zeros((len(langs), SLOTS))
    # the sample is small, so it is dealt anew rather than read by few tasks; one row per language and task comes back
    for r in rows.select("text", "k").repartition(8).mapInPandas(count, "k int, counts binary").toLocalIterator():
        total[r["k"]] += np.frombuffer(r["counts"], "<i8")
    total += 0.5
    return langs, np.log(total / total.sum(1, keepdims=True)).astype(np.float32)


def likelihoods(text: Column, langs: list[str], logs: np.ndarray) -> Column:
    """Tempered log-likelihoods, the best 0 and none below -MOST."""

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def run(col: pd.Series) -> pd.Series:
        out = []
        for x in col:
            slots = trigrams(x if isinstance(x, str) else None)
            if not len(slots):
                out.append([0.0] * len(langs))
                continue
            total = np.zeros(len(langs))
            for at in range(0, len(slots), 65_536):
                total += logs[:, slots[at : at + 65_536]].sum(1, dtype=np.float64)
            score = TRUST * (total - total.max())
            out.append(np.maximum(score, -MOST).tolist())
        return pd.Series(out)

    return run(text)


def _posterior(logs: Column) -> Column:
    """Probabilities from log weights."""
    top = F.array_max(logs)
    e = F.transform(logs, lambda x: F.exp(x - top))
    total = F.aggregate(e, F.lit(0.0), lambda a, x: a + x)
    return F.transform(e, lambda x: x / total)


def _means(rows: DataFrame, keys: list[str], n: int, suffix: str) -> DataFrame:
    """For each key: sums of the posteriors and the number of rows."""
    sums = F.array(*(F.sum(F.get("p", F.lit(k))) for k in range(n)))
    return rows.groupBy(*keys).agg(sums.alias(f"sum_{suffix}"), F.count("*").alias(f"n_{suffix}"))


def identify(rows: DataFrame, model: tuple[list[str], np.ndarray] | None) -> DataFrame:
    """rows (text, declared, host, suffix, path_lang and any others but text) with lang, probability, text_lang.

    declared and path_lang are language codes, host and suffix parts of the address; all may be null.
    """
    rest = [c for c in rows.columns if c.lower() not in ("text", "lang", "probability", "text_lang")]
    if model is None:
        return rows.select(*rest, F.lit(None).cast("string").alias("lang"), F.lit(None).cast("double").alias("probability"), F.lit(None).cast("string").alias("text_lang"))
    langs, logs = model
    n = len(langs)
    known = F.array(*map(F.lit, langs))
    domain = F.coalesce(F.substring_index("host", ".", -3), F.lit(""))
    evidence_columns = ("declared", "host", "suffix", "path_lang")
    rows = rows.select(F.struct(*rest).alias("row"), *evidence_columns, likelihoods(F.col("text"), langs, logs).alias("ll"))
    rows = rows.withColumns({"p": _posterior(F.col("ll")), "domain": domain})
    # declarations outside the model's languages count as one value
    code = lambda c: F.when(F.col(c).isNull(), F.lit(None)).when(F.array_contains(known, F.col(c)), F.col(c)).otherwise(F.lit("other"))
    rows = cut(rows.withColumns({"declared_as": code("declared"), "path_as": code("path_lang")}))

    def evidence(key: str) -> DataFrame:
        """log P(value | language), smoothed."""
        seen = _means(rows.where(F.col(key).isNotNull()), [key], n, "v")
        # one row of a number per language
        total = seen.agg(*(F.coalesce(F.sum(F.get("sum_v", F.lit(k))), F.lit(0.0)).alias(f"t{k}") for k in range(n)), F.count("*").alias("values")).first()
        part = F.array(*(F.log((F.get("sum_v", F.lit(k)) + 0.5) / (total[f"t{k}"] + 0.5 * total["values"])) for k in range(n)))
        return seen.select(F.col(key), part.alias(f"log_{key}"))

    everything = _means(rows, [], n, "all").first()
    base = F.array(*(F.lit(((x or 0.0) + 1.0 / n) / (everything["n_all"] + 1)) for x in everything["sum_all"]))
    smooth = lambda sums, rows_of, base: F.zip_with(sums, base, lambda x, b: (x + PSEUDO * b) / (F.col(rows_of) + PSEUDO))
    by_domain = _means(rows, ["domain"], n, "d").select(F.col("domain").alias("dx"), smooth("sum_d", "n_d", base).alias("base_d"))
    hosts = _means(rows, ["host", "domain"], n, "h").join(by_domain, F.col("domain") == F.col("dx"))
    # stored: both sides of the join are plain exchanges then, and Spark splits a host with very many rows
    hosts = cut(hosts.select(F.col("host").alias("hx"), "sum_h", "n_h", "base_d"))
    out = rows.join(hosts, F.col("host").eqNullSafe(F.col("hx")))
    for key in ("declared_as", "path_as", "suffix"):
        out = out.join(evidence(key), key, "left")
    others = F.zip_with(F.zip_with("sum_h", "p", lambda s, x: F.greatest(F.lit(0.0), s - x)), "base_d", lambda s, b: F.log((s + PSEUDO * b) / (F.col("n_h") - 1 + PSEUDO)))
    zero = F.array_repeat(F.lit(0.0), n)
    add = lambda a, b: F.zip_with(a, F.coalesce(b, zero), lambda x, y: x + y)
    fused = add(add(add(add(F.col("ll"), others), F.col("log_declared_as")), F.col("log_path_as")), F.col("log_suffix"))
    out = out.withColumn("post", _posterior(fused))
    best = F.array_max("post")
    pick = lambda a: F.element_at(known, F.array_position(a, F.array_max(a)).cast("int"))
    passed = (F.col(f"row.`{c}`").alias(c) for c in rest)
    return out.select(*passed, pick("post").alias("lang"), best.alias("probability"), pick("p").alias("text_lang"))


#: Elements whose content is no text, comments, and all other tags.  What isn't closed ends with the page or at the next
#: tag, so the time is linear whatever the page.
_SKIP = r"(?is)<(script|style)\b.*?(?:</\1[^<>]*>|\z)|<!--.*?(?:-->|\z)|<[^<>]*>"


def of_pages(pages: DataFrame) -> DataFrame:
    """Evidence columns of web pages."""
    get = lambda pattern: F.lower(F.regexp_extract(F.coalesce("html", F.lit("")), pattern, 1))
    declared = get(r"(?i)<html[^>]*\slang\s*=\s*[\"']?([a-zA-Z]{2,3})")
    url = F.coalesce("url", F.lit(""))
    host = F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1))
    path = F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*/([a-zA-Z]{2})(?:[/?#]|$)", 1))
    null = lambda c: F.when(c != "", c)
    text = F.regexp_replace(F.coalesce("html", F.lit("")), _SKIP, " ")
    return pages.select(
        F.col("page_id").cast("bigint"), text.alias("text"), null(declared).alias("declared"), null(host).alias("host"),
        null(F.substring_index(host, ".", -1)).alias("suffix"), null(path).alias("path_lang"),
    )
