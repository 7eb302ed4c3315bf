"""Quality rules: a threshold table compiled into one Spark projection.

Each row of ``RULES`` names a measure, a lower and an upper bound (None: open)
and the least number of words from which it is applied.  ``measure`` adds the
measures with DataFrame expressions only, ``compile_rules`` turns the table
into one boolean column.

Repeated words are those in five-word windows that occur twice or more in the
text.  A window is held as the 64-bit hash of its words.  Texts without any
repeated window, nearly all, stop after one distinct-count of these hashes; the
others sort (hash, position) pairs, mark windows that equal a neighbour, and
add up the stretches these windows cover.

The stop words are those of four languages, whose short ones most languages in
Latin letters share; texts with fewer Latin letters than characters beyond ASCII
are no case for them and have the ratio 1.  The share of distinct words falls as any
text grows, so beyond ``VOCABULARY`` words it is taken of that number.

Nulls: a null text counts as empty.  Empty and blank texts have no words and
fail the base rule.  Repeated rows are measured one by one.  An empty table
gives an empty result.  Columns of the input that bear the name of an output
column are replaced.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE, free_name, words

WINDOW = 5
VOCABULARY = 10_000

#: Stop words of the four languages (fixed values).
STOP_WORDS = (
    "the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "was", "on", "with", "as", "be", "by", "at", "this",
    "der", "die", "und", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "ist", "im", "dem", "nicht", "ein", "eine",
    "le", "la", "de", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "par", "au", "pas", "sur", "avec",
    "el", "y", "los", "se", "del", "las", "con", "una", "su", "para", "es", "al", "lo", "como", "o",
)


class Rule(NamedTuple):
    measure: str
    at_least: float | None
    at_most: float | None
    from_words: int


#: Applied to texts that pass the base rule.
RULES = (
    Rule("mean_word_chars", 1.0, 40.0, 0),
    Rule("symbols_per_word", None, 0.3, 0),
    Rule("stop_word_ratio", 0.01, None, 100),
    Rule("dup_line_ratio", None, 0.6, 100),
    Rule("upper_letter_ratio", None, 0.7, 20),
    Rule("bullet_line_ratio", None, 0.9, 50),
    Rule("distinct_word_ratio", 0.05, None, 10),
)


def repeat_words(hashes: Column) -> Column:
    """Words covered by windows that occur twice or more; hashes are the windows' hashes in order of position."""
    pairs = F.array_sort(F.arrays_zip(hashes.alias("h"), F.sequence(F.lit(1), F.size(hashes)).alias("p")))

    def covered(s: Column) -> Column:
        last = F.size(s) - 1
        marked = F.filter(
            F.transform(
                s,
                lambda x, i: F.when(
                    ((i > 0) & (F.get(s, i - 1)["h"] == x["h"])) | ((i < last) & (F.get(s, i + 1)["h"] == x["h"])), x["p"]
                ),
            ),
            lambda p: p.isNotNull(),
        )
        return F.aggregate(
            F.sort_array(marked),
            F.struct(F.lit(0).alias("total"), F.lit(-WINDOW).alias("at")),
            lambda acc, p: F.struct(
                (acc["total"] + F.least(F.lit(WINDOW), p - acc["at"])).alias("total"), p.alias("at")
            ),
            lambda acc: acc["total"],
        )

    # a one-element transform binds the sorted pairs once for all uses
    return F.get(F.transform(F.array(pairs), covered), F.lit(0))


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """df with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the ratios that RULES uses."""
    w, h, lines = (free_name(df, x) for x in ("_w", "_h", "_lines"))
    t = F.coalesce(F.col(text), F.lit(""))
    out = df.withColumn(w, words(F.col(text))).withColumn(lines, F.filter(F.split(t, "\n"), lambda x: x.rlike(f"[^{WHITE}]")))
    c, n = F.col(w), F.size(w)
    window_hash = lambda i: F.xxhash64(*(F.get(c, i + k) for k in range(WINDOW)))
    out = out.withColumn(h, F.when(n < WINDOW, F.array().cast("array<bigint>")).otherwise(F.transform(F.sequence(F.lit(0), n - WINDOW), window_hash)))
    hs, ls = F.col(h), F.col(lines)
    chars = F.char_length(F.array_join(c, ""))
    symbols = F.char_length(F.regexp_replace(t, r"[^#*$%&|<>]+", ""))
    upper, latin, beyond = (F.char_length(F.regexp_replace(t, f"[{others}]+", "")) for others in ("^A-Z", "^A-Za-z", "\\x00-\\x7F"))
    dup_lines = F.size(ls) - F.size(F.array_distinct(ls))
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    values = {
        "n_words": n.cast("bigint"),
        "word_chars": chars.cast("bigint"),
        "n_symbols": symbols.cast("bigint"),
        "n_dup_lines": dup_lines.cast("bigint"),
        "n_repeat_words": F.when(F.size(F.array_distinct(hs)) == F.size(hs), F.lit(0)).otherwise(repeat_words(hs)).cast("bigint"),
        "mean_word_chars": ratio(chars, n),
        "stop_word_ratio": F.when(beyond > latin, F.lit(1.0)).otherwise(ratio(F.size(F.filter(c, lambda x: x.isin(*STOP_WORDS))), n)),
        "upper_letter_ratio": ratio(upper, chars),
        "bullet_line_ratio": ratio(F.size(F.filter(ls, lambda x: x.rlike(f"^[{WHITE}]*[-*•]"))), F.size(ls)),
        "distinct_word_ratio": ratio(F.size(F.array_distinct(c)), F.least(n, F.lit(VOCABULARY))),
        "dup_line_ratio": ratio(dup_lines, F.size(ls)),
        "symbols_per_word": ratio(symbols, n),
    }
    kept = [x for x in df.columns if x.lower() not in values]
    # The one-row generator keeps the optimiser from copying these expressions into filters on them, where they would be
    # computed once for each use.
    m = free_name(df, "_measures")
    out = out.select(*(F.col(f"`{x}`") for x in kept), F.explode(F.array(F.struct(*(v.alias(k) for k, v in values.items())))).alias(m))
    return out.select(*(F.col(f"`{x}`") for x in kept), *(F.col(f"{m}.{k}").alias(k) for k in values))


def compile_rules(rules=RULES) -> Column:
    """One boolean column: true where every rule that applies holds."""
    ok = F.lit(True)
    for r in rules:
        holds = F.lit(True)
        if r.at_least is not None:
            holds = holds & (F.col(r.measure) >= r.at_least)
        if r.at_most is not None:
            holds = holds & (F.col(r.measure) <= r.at_most)
        ok = ok & (holds | (F.col("n_words") < r.from_words))
    return ok


def base_failed() -> Column:
    """Fewer than 10 words, or over a fifth of the words repeated."""
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def judge(df: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """df with the measures, base_failed and kept."""
    keep = [x for x in df.columns if x.lower() not in ("base_failed", "kept")]
    out = measure(df.select(*(F.col(f"`{x}`") for x in keep)), text).withColumn("base_failed", base_failed())
    return out.withColumn("kept", ~F.col("base_failed") & compile_rules(rules))
