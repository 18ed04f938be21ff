"""Quality rules with risk-controlled cutoffs, in DataFrame functions only.

Counts of each whole text (words, symbols, repeated lines, repeated three-word
windows) feed two layers.  The base rules are fixed.  Each further rule compares
a share of the counts with a cutoff that is chosen per stratum from labelled rows:

* a false rejection is a good row (label 1) that the rule would reject;
* for a cutoff with k of n good rows rejected, the exact binomial tail
  P(Bin(n, a) <= k) is the p-value of "the rate is above a", a being the rule's
  part of the allowed rate;
* cutoffs of a rule are tested from the most lenient on and stop at the first that fails
  (a fixed sequence needs no correction); over rules and strata the level is
  divided (Bonferroni).

So with probability 1 - delta the rules together reject at most the allowed
rate of good rows in every stratum.  A rule without a certified cutoff is off there.

Defined cases: NULL text has no words (and fails the base rules); a NULL stratum is
the stratum of the empty string; a stratum without labelled good rows has no further rules.
Labels that are NULL, or contradict each other, are left out.  Repeated rows are
repeated in the result; a labelled id counts as often as it occurs.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sublens.llm.common import stored

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
ALLOWED = 0.02                # false rejections of all rules together, per stratum
DELTA = 0.1                   # chance that the guarantee fails
BROADCAST_STRATA = 10_000     # rows of the cutoff table that may be broadcast

# Rules: rejected if 100 * numerator >= cutoff * denominator; cutoffs from the
# most lenient on.
RULES = (
    ("symbols", "n_symbols", "n_words", (200, 100, 60, 40, 20, 10)),
    ("long_words", "word_chars", "n_words", (2000, 1500, 1200, 1000, 900, 800)),
    ("dup_lines", "n_dup_lines", "n_lines", (80, 60, 40, 30, 20)),
    ("repeats", "n_repeat_words", "n_words", (45, 40, 30, 20, 10)),
)


def _without(col: Column, chars: str) -> Column:
    return F.translate(col, chars, "")


def counts(df: DataFrame, text_col: str = "text") -> DataFrame:
    """df with ``_n_words``, ``_word_chars``, ``_n_symbols``, ``_n_lines``,
    ``_n_dup_lines`` and ``_n_repeat_words``; the text column goes."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: _without(x, SPACE) != "")
    d = df.withColumns({
        "_words": words, "_lines": lines,
        "_word_chars": F.length(_without(text, SPACE)).cast("long"),
        "_n_symbols": (F.length(text) - F.length(_without(text, SYMBOLS))).cast("long")})
    # a hash of each three-word window (64 bits; compared inside one text only)
    d = d.withColumn("_grams", F.when(F.size("_words") > 2, F.slice(
        F.transform("_words", lambda w, i: F.xxhash64(w, F.get("_words", i + 1), F.get("_words", i + 2))),
        F.lit(1), F.size("_words") - 2)))
    # sorted (window, place), only where some window comes twice
    d = d.withColumn("_sorted", F.when(
        F.size(F.array_distinct("_grams")) < F.size("_grams"),
        F.array_sort(F.transform("_grams", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    def beside(x: Column, j: Column) -> Column:
        return F.coalesce(x["h"] == F.get("_sorted", j)["h"], F.lit(False))

    d = d.withColumn("_places", F.sort_array(F.transform(
        F.filter("_sorted", lambda x, j: beside(x, j - 1) | beside(x, j + 1)), lambda x: x["i"])))
    # each place covers three words, up to the next place
    covered = F.aggregate(
        F.transform("_places", lambda p, j: F.least(F.lit(3), F.coalesce(F.get("_places", j + 1) - p, F.lit(3)))),
        F.lit(0), lambda a, x: a + x)
    return d.withColumns({
        "_n_words": F.size("_words").cast("long"),
        "_n_lines": F.size("_lines").cast("long"),
        "_n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_n_repeat_words": F.coalesce(covered, F.lit(0)).cast("long"),
    }).drop("_words", "_lines", "_grams", "_sorted", "_places", text_col)


def base_failed() -> Column:
    return (F.col("_n_words") < 50) | (100 * F.col("_n_repeat_words") > 50 * F.col("_n_words"))


def rejects(rule: tuple, cutoff) -> Column:
    _, top, bottom, _ = rule
    return 100 * F.col(f"_{top}") >= cutoff * F.col(f"_{bottom}")


def binomial_tail(n: Column, k: Column, rate: float) -> Column:
    """P(Bin(n, rate) <= k), the terms built up in logs; 1 where k / n is above
    the rate (no certificate is possible there)."""
    log_odds = math.log(rate) - math.log1p(-rate)
    first = n * math.log1p(-rate)
    terms = F.aggregate(
        F.sequence(F.lit(1).cast("long"), k), F.struct(first.alias("log"), F.exp(first).alias("sum")),
        lambda a, i: F.struct((a["log"] + F.log(n - i + 1) - F.log(i) + log_odds).alias("log"),
                              (a["sum"] + F.exp(a["log"] + F.log(n - i + 1) - F.log(i) + log_odds)).alias("sum")))
    return F.when(k > n * rate, 1.0).when(k == 0, F.exp(first)).otherwise(F.least(terms["sum"], F.lit(1.0)))


def cutoffs(counted: DataFrame, labels: DataFrame, stratum_col: str = "lang", label: str = "quality",
            id_col: str = "doc_id", allowed: float = ALLOWED, delta: float = DELTA, rules=RULES) -> tuple[DataFrame, int]:
    """One row per stratum: ``_stratum`` and the certified cutoff of each rule
    (NULL: off); and the number of strata."""
    given = labels.filter(F.col(label).isNotNull() & F.col(id_col).isNotNull()).groupBy(
        F.col(id_col).cast("long").alias("_id")).agg(F.min(label).alias("_y"), F.max(label).alias("_z"))
    good = given.filter("_y = 1 and _z = 1").select("_id")
    rows = counted.join(good, F.col(id_col).cast("long") == F.col("_id"), "left_semi")
    tests = [F.struct(F.lit(r[0]).alias("rule"), F.lit(c).alias("cutoff"), F.col(f"k_{r[0]}_{c}").alias("k"))
             for r in rules for c in r[3]]
    table = rows.groupBy(F.coalesce(F.col(stratum_col).cast("string"), F.lit("")).alias("_stratum")).agg(
        F.count("*").alias("n"), *[F.count_if(rejects(r, F.lit(c))).alias(f"k_{r[0]}_{c}") for r in rules for c in r[3]])
    table = stored(table.select("_stratum", "n", F.inline(F.array(*tests))), "rule-tests")
    strata = table.select("_stratum").distinct().count()
    level = delta / max(1, len(rules) * strata)
    p = binomial_tail(F.col("n"), F.col("k"), allowed / len(rules))
    # false rejections grow along a rule's cutoffs, so the last that passes ends the sequence
    chosen = table.filter(p <= level).groupBy("_stratum").agg(
        *[F.min(F.when(F.col("rule") == r[0], F.col("cutoff"))).alias(f"_cut_{r[0]}") for r in rules])
    return chosen, strata


def judge(df: DataFrame, labels: DataFrame, stratum_col: str = "lang", label: str = "quality",
          id_col: str = "doc_id", text_col: str = "text", allowed: float = ALLOWED, delta: float = DELTA,
          rules=RULES) -> DataFrame:
    """(id_col, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept) for every row."""
    counted = stored(counts(df.select(*{c: F.col(c) for c in (id_col, stratum_col, text_col)}), text_col), "rule-counts")
    table, strata = cutoffs(counted, labels, stratum_col, label, id_col, allowed, delta, rules)
    table = F.broadcast(table) if strata <= BROADCAST_STRATA else table
    rows = counted.withColumn("_stratum", F.coalesce(F.col(stratum_col).cast("string"), F.lit(""))).join(
        table, "_stratum", "left")
    bad = F.lit(False)
    for r in rules:
        bad = bad | F.coalesce(rejects(r, F.col(f"_cut_{r[0]}")), F.lit(False))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return rows.select(F.col(id_col), *[F.col(f"_{c}").alias(c) for c in names],
                       base_failed().alias("base_failed"), (~base_failed() & ~bad).alias("kept"))
