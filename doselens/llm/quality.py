"""Quality rules whose cutoffs are certified on labelled text.

Each rule compares a ratio of counts with a cutoff and has a ladder of cutoffs
from lenient to strict. Documents labelled good are the holdout: for a stratum
(a language), a rule and a cutoff, the number of good documents that the cutoff
rejects is binomial, so an exact binomial tail tells how sure it is that the
share it rejects stays below a limit. The rungs of a ladder are tested in order
and the first that fails ends it, which needs no correction among rungs; across
strata and rules the error is divided by their number (Bonferroni). The limit
itself is divided by the number of rules, so all rules together reject at most
``false_rejection`` of a stratum's good documents, with the stated confidence in
all strata at once. A stratum with too few labels certifies nothing and keeps
all its documents that pass the fixed rules.

Null texts have no words and fail the fixed rules, as empty ones do. A null
language is a stratum of its own. A document with contradicting labels counts as
not good. Repeated rows are judged one by one. Only counts for each stratum are
gathered; everything is a column expression, a join or an aggregate.
"""

from __future__ import annotations

from functools import reduce
from math import log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from doselens.llm.common import held_out, materialize

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
FALSE_REJECTION = 0.02
"""Share of a stratum's good documents that the rules may reject."""
ERROR = 0.05
"""Chance that the share is exceeded in any stratum."""

RULES = {
    # name: (numerator, denominator, cutoffs in thousandths from lenient to strict)
    "symbols": ("n_symbols", "n_words", (2000, 1000, 500, 300, 200, 100)),
    "repeats": ("n_repeat_words", "n_words", (500, 450, 400, 350, 300, 250, 200)),
    "lines": ("n_dup_lines", "n_lines", (900, 800, 700, 600, 500, 400)),
    "length": ("word_chars", "n_words", (14000, 12000, 11000, 10000, 9000, 8000)),
}


def _length_without(text: Column, characters: str) -> Column:
    return F.length(F.translate(text, characters, ""))


def repeat_words(words: Column) -> Column:
    """Words inside windows of three words that occur twice or more in the list.

    Windows are compared by a 64-bit hash. Sorted by hash and place, the windows
    that repeat stand side by side; each covers three words or fewer, up to the
    next one that repeats. Lists without a repeated window are not sorted.
    """
    windows = F.filter(
        F.transform(
            words,
            lambda word, i: F.when(
                i + 2 < F.size(words),
                F.struct(
                    F.xxhash64(word, F.get(words, i + 1), F.get(words, i + 2)).alias("hash"),
                    i.alias("place"),
                ),
            ),
        ),
        lambda window: window.isNotNull(),
    )
    return windows


def _covered(windows: Column) -> Column:
    # The sorted list is bound to a name by transforming a list that holds it.
    def places(ordered: Column) -> Column:
        return F.sort_array(
            F.transform(
                F.filter(
                    ordered,
                    lambda window, i: (F.get(ordered, i - 1)["hash"] == window["hash"])
                    | F.coalesce(F.get(ordered, i + 1)["hash"] == window["hash"], F.lit(False)),
                ),
                lambda window: window["place"],
            )
        )

    def words_in(found: Column) -> Column:
        return F.aggregate(
            F.transform(
                found,
                lambda place, i: F.least(
                    F.lit(3), F.coalesce(F.get(found, i + 1) - place, F.lit(3))
                ),
            ),
            F.lit(0).cast("bigint"),
            lambda total, n: total + n,
        )

    bound = F.transform(F.array(F.sort_array(windows)), places)
    return F.get(F.transform(bound, words_in), F.lit(0))


def measure(documents: DataFrame, key: str = "doc_id", text: str = "text", stratum: str = "lang") -> DataFrame:
    """The counts of each document: words, symbols, repeated lines and words."""
    given = documents.select(
        F.col(key).alias("doc_id"),
        F.col(stratum).cast("string").alias("stratum"),
        F.coalesce(F.col(text), F.lit("")).alias("_text"),
    )
    split = given.withColumns(
        {
            "_words": F.filter(F.split("_text", r"[\x20\x09-\x0D]+"), lambda word: word != ""),
            "_lines": F.filter(
                F.split("_text", "\n"), lambda line: _length_without(line, SPACES) > 0
            ),
            "word_chars": _length_without(F.col("_text"), SPACES).cast("bigint"),
            "n_symbols": (F.length("_text") - _length_without(F.col("_text"), SYMBOLS)).cast("bigint"),
        }
    )
    windows = split.withColumns(
        {
            "_windows": repeat_words(F.col("_words")),
            "n_words": F.size("_words").cast("bigint"),
            "n_lines": F.size("_lines").cast("bigint"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
        }
    )
    repeated = F.size(F.array_distinct(F.col("_windows.hash"))) < F.size("_windows")
    return windows.select(
        "doc_id",
        "stratum",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_lines",
        "n_dup_lines",
        F.when(repeated, _covered(F.col("_windows"))).otherwise(0).cast("bigint").alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > 50 * F.col("n_words")
    )


def rejects(rule: str, cutoff: Column | int) -> Column:
    """Whether a rule's ratio reaches a cutoff in thousandths."""
    upper, lower, _ = RULES[rule]
    return (F.col(lower) > 0) & (1000 * F.col(upper) >= cutoff * F.col(lower))


def _log_factorial(n: Column) -> Column:
    """ln n!, by Stirling's series from n + 9 on; exact to about 1e-13."""
    x = n + 9.0
    series = 1 / (12 * x) - 1 / (360 * F.pow(x, F.lit(3))) + 1 / (1260 * F.pow(x, F.lit(5)))
    high = (x - 0.5) * F.log(x) - x + 0.5 * log(6.283185307179586) + series
    return high - reduce(lambda a, b: a + b, [F.log(n + float(i)) for i in range(1, 9)])


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """P(X <= k) for X binomial with n draws of chance p; 1 where k is not below the mean.

    Below the mean the terms fall from k downwards, so the sum is taken from
    there; terms beyond forty standard deviations add nothing.
    """
    first = F.exp(
        _log_factorial(n) - _log_factorial(k) - _log_factorial(n - k)
        + k * log(p) + (n - k) * log(1 - p)
    )
    terms = F.least(k, F.ceil(40 * F.sqrt(n * p)) + 100).cast("bigint")
    start = F.struct(first.alias("term"), first.alias("sum"))

    def add(state: Column, i: Column) -> Column:
        at = k - i + 1
        term = state["term"] * at * (1 - p) / ((n - at + 1) * p)
        return F.struct(term.alias("term"), (state["sum"] + term).alias("sum"))

    steps = F.when(terms >= 1, F.sequence(F.lit(1).cast("bigint"), terms)).otherwise(
        F.array().cast("array<bigint>")
    )
    tail = F.aggregate(steps, start, add, lambda state: state["sum"])
    return F.when(k < n * p, F.least(tail, F.lit(1.0))).otherwise(1.0)


def certified(
    measured: DataFrame,
    labels: DataFrame,
    false_rejection: float = FALSE_REJECTION,
    error: float = ERROR,
) -> DataFrame:
    """For each stratum the strictest certified cutoff of each rule, null where none is.

    ``labels`` has ``doc_id`` and ``quality``; rows held out from learning are not used.
    """
    good = (
        labels.where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .where("quality = 1")
    )
    sample = measured.where(~base_failed()).join(good, "doc_id")
    counts = sample.groupBy("stratum").agg(
        F.count("*").alias("n"),
        *[
            F.count_if(rejects(rule, cutoff)).alias(f"{rule}_{cutoff}")
            for rule, (_, _, ladder) in RULES.items()
            for cutoff in ladder
        ],
    )
    rungs = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(rule).alias("rule"),
                    F.lit(rung).alias("rung"),
                    F.lit(cutoff).alias("cutoff"),
                    F.col(f"{rule}_{cutoff}").alias("k"),
                )
                for rule, (_, _, ladder) in RULES.items()
                for rung, cutoff in enumerate(ladder)
            ]
        )
    )
    tests = counts.withColumn("strata", F.count("*").over(Window.partitionBy()))
    tests = tests.select("stratum", "n", "strata", rungs.alias("_")).select(
        "stratum", "n", "strata", "_.*"
    )
    limit = false_rejection / len(RULES)
    tail = binomial_tail(F.col("n").cast("double"), F.col("k").cast("double"), limit)
    passed = (tail <= error / (F.col("strata") * len(RULES))).cast("int")
    ladder = Window.partitionBy("stratum", "rule").orderBy("rung")
    held = tests.withColumn("passed", passed).withColumn("held", F.min("passed").over(ladder))
    return held.groupBy("stratum").agg(
        *[
            F.min(
                F.when((F.col("rule") == rule) & (F.col("held") == 1), F.col("cutoff"))
            ).alias(f"cut_{rule}")
            for rule in RULES
        ]
    )


def judge(
    documents: DataFrame,
    labels: DataFrame,
    false_rejection: float = FALSE_REJECTION,
    error: float = ERROR,
) -> DataFrame:
    """The counts of each document, its cutoffs and whether it is kept."""
    measured = materialize(measure(documents), "quality-measures")
    cutoffs = certified(measured, labels, false_rejection, error)
    cutoffs = cutoffs.withColumnRenamed("stratum", "_stratum")
    judged = measured.join(cutoffs, F.col("stratum").eqNullSafe(F.col("_stratum")), "left")
    rejected = reduce(
        lambda a, b: a | b,
        [F.coalesce(rejects(rule, F.col(f"cut_{rule}")), F.lit(False)) for rule in RULES],
    )
    return judged.drop("_stratum").withColumns(
        {"base_failed": base_failed(), "kept": ~base_failed() & ~rejected}
    )
