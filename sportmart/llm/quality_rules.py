"""Quality rules whose cutoffs are chosen so that few good documents are rejected, with a proven bound.

Per stratum and rule, cutoffs are tried from the most lenient on. A cutoff is accepted while the exact binomial
test on labelled documents rejects "more than the allowed share of good documents reaches it"; the first
failure ends the sequence, so trying many cutoffs costs no error (fixed-sequence testing). The allowed share
is split over the rules, the error over strata and rules (Bonferroni). So with probability ``1 - ERROR``, in every
stratum at once, the rules together reject at most ``RISK`` of the good documents.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sportmart.llm.common import BLANKS, blank_words, let, staged

#: Share of good documents that may be rejected per stratum, and the error of that statement.
RISK = 0.05
ERROR = 0.05
#: Cutoffs per rule, most lenient first. They are fixed before any label is seen.
CUTOFFS = (0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1, 0.08, 0.06, 0.04, 0.02)
RULES = ("symbols", "repeats", "dup_lines", "capitals")
MIN_WORDS = 10
REPEAT_WORDS = 5
SYMBOLS = "#*$%&|<>"


def log_factorial(n: Column) -> Column:
    """Stirling's series beyond 20, where its error is below 1e-16."""
    x = n.cast("double")
    series = x * F.log(x) - x + 0.5 * F.log(2 * math.pi * x) + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5)
    return F.when(n <= 20, F.log(F.factorial(F.least(n, F.lit(20)).cast("int")).cast("double"))).otherwise(series)


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) of a binomial X, by summing from ``k`` downwards until terms vanish; 1 from the mean on.

    Below the mean each term is smaller than the one before, and all mass lies within some
    standard deviations, so the sum is short for any ``n``.
    """
    top = F.exp(
        log_factorial(n) - log_factorial(k) - log_factorial(n - k)
        + k * math.log(p) + (n - k) * math.log1p(-p)
    )
    steps = F.least(k, F.ceil(F.sqrt(n * (p * (1 - p))) * 12).cast("long") + 60)

    def add(s: Column, i: Column) -> Column:
        return F.struct(
            (s["total"] + s["term"]).alias("total"),
            (s["term"] * ((k - i) * (1 - p)) / ((n - k + i + 1) * p)).alias("term"),
        )

    start = F.struct(F.lit(0.0).alias("total"), F.lit(1.0).alias("term"))
    total = F.aggregate(F.sequence(F.lit(0).cast("long"), steps), start, add, lambda s: s["total"])
    return F.when((n == 0) | (k >= n * p), 1.0).otherwise(F.least(F.lit(1.0), top * total))


def repeated_words(words: Column) -> Column:
    """Words inside windows of ``REPEAT_WORDS`` words that the text holds twice or more.

    Texts without a repeated window hash stop there. Else windows are sorted by hash, a neighbour with the same
    hash is compared word by word, and the marked windows' union is measured in the order of the text.
    """
    n = REPEAT_WORDS

    def window_hash(i: Column) -> Column:
        return F.xxhash64(*(F.get(words, i + k) for k in range(n)))

    def measured(hashes: Column) -> Column:
        ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def same(x: Column, y: Column) -> Column:
            equal = (x["h"] == y["h"]) & (F.slice(words, x["i"] + 1, F.lit(n)) == F.slice(words, y["i"] + 1, F.lit(n)))
            return F.coalesce(equal, F.lit(False))

        def marked(pairs: Column) -> Column:
            return F.transform(
                pairs, lambda x, j: F.when(same(x, F.get(pairs, j - 1)) | same(x, F.get(pairs, j + 1)), x["i"])
            )

        def covered(places: Column) -> Column:
            gaps = F.transform(places, lambda x, j: F.least(F.lit(n), F.coalesce(F.get(places, j + 1) - x, F.lit(n))))
            return F.aggregate(gaps, F.lit(0), lambda s, x: s + x)

        places = F.array_sort(F.array_compact(let(ordered, marked)))
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), let(places, covered)).otherwise(0)

    hashes = F.transform(F.sequence(F.lit(0), F.size(words) - n), window_hash)
    return F.when(F.size(words) > n, let(hashes, measured)).otherwise(0)


def measures(documents: DataFrame, stratum: str = "lang") -> DataFrame:
    """Per document the base counts and the rules' values (0 to 1). Null text has no words; a null stratum is ``''``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    counts = documents.select(
        "doc_id", F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"), text.alias("text")
    )
    with_word = F.filter(F.split("text", "\n", -1), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    lines = let(
        with_word,
        lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup")),
    )
    in_words = let(
        blank_words(F.col("text")),
        lambda w: F.struct(F.size(w).alias("n"), repeated_words(w).alias("repeats")),
    )
    counts = counts.select(
        "doc_id", "stratum", lines.alias("lines"), in_words.alias("words"),
        F.length(F.translate("text", BLANKS, "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        F.regexp_count("text", F.lit("[A-Z]")).cast("long").alias("capitals"),
    )
    n, repeats = F.col("words.n"), F.col("words.repeats")
    share = lambda part, whole: F.least(F.lit(1.0), part / F.greatest(whole, F.lit(1)))
    return counts.select(
        "doc_id", "stratum", n.cast("long").alias("n_words"), "word_chars", "n_symbols",
        F.col("lines.dup").cast("long").alias("n_dup_lines"), repeats.cast("long").alias("n_repeat_words"),
        ((n < MIN_WORDS) | (100 * repeats > 20 * n)).alias("base_failed"),
        share(F.col("n_symbols"), F.col("word_chars")).alias("symbols"), share(repeats, n).alias("repeats"),
        share(F.col("lines.dup"), F.col("lines.n")).alias("dup_lines"),
        share(F.col("capitals"), F.col("word_chars")).alias("capitals"),
    )


def thresholds(
    measured: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR, rules=RULES, cutoffs=CUTOFFS
) -> DataFrame:
    """One row per stratum with a labelled good document: ``n_good`` and per rule its cutoff (null: the rule rejects nothing).

    A document counts as good if it passes the base rules and all its labels say ``quality = 1``. Labels without
    id, quality or document are left out; a document that is repeated counts each time.
    """
    good = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id")
    good = good.agg(F.min("quality").alias("quality")).where("quality = 1").select("doc_id")
    held = measured.where("NOT base_failed").join(good, "doc_id", "left_semi")
    hits = [
        F.array(*(F.sum(F.when(F.col(rule) >= c, 1).otherwise(0)) for c in cutoffs)).alias(rule) for rule in rules
    ]
    strata = held.groupBy("stratum").agg(F.count(F.lit(1)).alias("n_good"), *hits)
    # One row per stratum; each stands for at least one label.
    tests = F.count(F.lit(1)).over(Window.partitionBy()) * len(rules)
    strata = strata.withColumn("level", F.lit(error) / tests)
    grid = F.expr(f"array({', '.join(f'{c}D' for c in cutoffs)})")

    def chosen(rule: str) -> Column:
        tails = F.transform(rule, lambda k: binomial_tail(k, F.col("n_good"), risk / len(rules)))
        first_failure = F.array_position(F.transform(tails, lambda t: t > F.col("level")), F.lit(True))
        accepted = F.when(first_failure == 0, len(cutoffs)).otherwise(first_failure - 1)
        return F.get(grid, (accepted - 1).cast("int")).alias(f"cut_{rule}")

    return strata.select("stratum", "n_good", *(chosen(r) for r in rules))


def judged(documents: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK, error: float = ERROR) -> DataFrame:
    """Every document with its counts, the rules' values and cutoffs, and ``kept``.

    A document is kept if it passes the base rules and stays below every cutoff of its stratum. A stratum
    without labels, or with too few to prove anything, has no cutoffs: only the base rules reject there.
    Empty tables give an empty result; repeated rows are judged alike.
    """
    measured = staged(documents.sparkSession, measures(documents, stratum), "measures")
    cuts = thresholds(measured, labels, risk, error)
    joined = measured.join(cuts, "stratum", "left")
    rejected = F.lit(False)
    for rule in RULES:
        rejected = rejected | F.coalesce(F.col(rule) >= F.col(f"cut_{rule}"), F.lit(False))
    return joined.withColumn("kept", ~F.col("base_failed") & ~rejected)


def quality_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    return judged(documents, labels).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "stratum", *(f"cut_{r}" for r in RULES),
    )
