"""Quality rules as weak supervision.

Each rule votes good (1), bad (-1) or abstains (0) on a document. The votes are combined by
a model in which rules err independently given the true class: expectation-maximisation
estimates, per rule and class, how often it votes either way, and the share of good
documents. A document is kept if the posterior probability of being good reaches one half.

The votes of m rules have at most 3^m patterns, so expectation-maximisation runs on their
counts: one aggregation over all documents, combined in the map tasks, whose result is
bounded by the number of rules and not by the data. Documents are read once; their features
are saved and scored by column expressions. There is no Python on the data's path.

Repeated word windows are found without a shuffle: a text's window hashes are sorted with
their positions, and equal neighbours give the repeated positions.

Edge cases: null or empty texts have no words, fail the base rules and are not kept; a
document on which no rule votes is kept unless it fails them; repeated rows score alike; if
no rule ever votes, the prior is used; an empty table gives an empty result. Extra columns
are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.common import GAP, SPACES, WORD, Scratch

SYMBOLS = "#*$%&|<>"
ROUNDS = 50
PRIOR = 0.9
# Frequent function words of the languages at hand.
COMMON_WORDS = [
    "the", "of", "and", "to", "in", "is", "that", "was", "for", "with",
    "le", "la", "de", "et", "les", "des", "un", "une", "que", "est",
    "der", "die", "und", "das", "den", "von", "zu", "mit", "ein", "ist",
    "el", "los", "las", "y", "en", "por", "con", "una", "del", "se",
]


def let(value: Column, body) -> Column:
    """Bind a value once for an expression that uses it several times."""
    return F.transform(F.array(value), body)[0]


def repeated_positions(words: Column, width: int = 3) -> Column:
    """Number of words that lie in a window of ``width`` words found twice or more."""
    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - width),
        lambda i: F.struct(F.xxhash64(*[F.get(words, i + k) for k in range(width)]).alias("h"), i.alias("i")),
    )

    def count(s: Column) -> Column:
        same = F.filter(s, lambda x, k: (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"]))
        covered = F.flatten(F.transform(same, lambda x: F.array(*[x["i"] + k for k in range(width)])))
        return F.size(F.array_distinct(covered))

    return F.when(F.size(words) > width, let(F.array_sort(windows), count)).otherwise(0)


def features(docs: DataFrame) -> DataFrame:
    """doc_id and the measures of each whole text that base and rules rest on."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.filter(F.split(text, GAP), lambda w: w != "").alias("words"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD))
    n_words = F.size("words")
    return rows.select(
        "doc_id",
        n_words.cast("long").alias("n_words"),
        F.length(F.regexp_replace("text", GAP, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        let(lines, F.size).cast("long").alias("n_lines"),
        repeated_positions(F.col("words")).cast("long").alias("n_repeat_words"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct"),
        F.size(F.array_intersect("words", F.array(*[F.lit(w) for w in COMMON_WORDS]))).cast("long").alias("n_common"),
        F.regexp_count("text", F.lit("[0-9]")).cast("long").alias("n_digits"),
        F.length(F.regexp_replace("text", r"[^\p{L}.,]+", "")).cast("long").alias("n_letters"),
        F.regexp_count("text", F.lit("[A-Z]")).cast("long").alias("n_capitals"),
    )


def vote(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def rules() -> dict[str, Column]:
    """The rules by name, over the columns of ``features``."""
    c = F.col
    return {
        "length": vote(c("n_words").between(80, 20_000), c("n_words") < 50),
        "word_length": vote(c("word_chars").between(3 * c("n_words"), 9 * c("n_words")), (c("word_chars") < 2 * c("n_words")) | (c("word_chars") > 15 * c("n_words"))),
        "symbols": vote(200 * c("n_symbols") <= c("n_words"), 10 * c("n_symbols") > c("n_words")),
        "symbol_share": vote(200 * c("n_symbols") <= c("word_chars"), 20 * c("n_symbols") > c("word_chars")),
        "letters": vote(100 * c("n_letters") >= 95 * c("word_chars"), 100 * c("n_letters") < 80 * c("word_chars")),
        "duplicate_lines": vote((c("n_lines") >= 3) & (c("n_dup_lines") == 0), 10 * c("n_dup_lines") > 3 * c("n_lines")),
        "repeated_words": vote(100 * c("n_repeat_words") <= 5 * c("n_words"), 100 * c("n_repeat_words") > 25 * c("n_words")),
        "common_words": vote(c("n_common") >= 5, (c("n_words") >= 50) & (c("n_common") <= 1)),
        "digits": vote(50 * c("n_digits") <= c("word_chars"), 5 * c("n_digits") > c("word_chars")),
        "capitals": vote(10 * c("n_capitals") <= c("word_chars"), 2 * c("n_capitals") > c("word_chars")),
        "variety": vote((c("n_words") >= 50) & (10 * c("n_distinct") >= 4 * c("n_words")), 10 * c("n_distinct") < c("n_words")),
    }


def estimate(patterns: list[tuple[tuple[int, ...], int]], rounds: int = ROUNDS) -> tuple[float, list[dict[int, float]]]:
    """Expectation-maximisation on the counts of vote patterns.

    Returns the log odds of the prior and, per rule, the log likelihood ratio of each vote.
    A rule's vote may be worthless but never turns against its meaning: a ratio on the wrong
    side is set to 0, which also fixes which class is the good one.
    """
    m = len(patterns[0][0]) if patterns else 0
    # To begin with, any vote for bad outweighs the prior and all others.
    prior, ratios = math.log(PRIOR / (1 - PRIOR)), [{-1: -5.0, 0: 0.0, 1: 0.1} for _ in range(m)]
    whole = sum(n for _, n in patterns)
    for _ in range(rounds if whole else 0):
        good = 0.0
        seen = [{v: [1.0, 1.0] for v in (-1, 0, 1)} for _ in range(m)]
        for votes, n in patterns:
            p = 1 / (1 + math.exp(-max(-500.0, min(500.0, prior + sum(r[v] for r, v in zip(ratios, votes))))))
            good += n * p
            for counts, v in zip(seen, votes):
                counts[v][0] += n * p
                counts[v][1] += n * (1 - p)
        share = min(max((good + 1) / (whole + 2), 0.01), 0.99)
        prior = math.log(share / (1 - share))
        ratios = []
        for counts in seen:
            yes, no = (sum(c[k] for c in counts.values()) for k in (0, 1))
            ratio = {v: math.log(c[0] / yes) - math.log(c[1] / no) for v, c in counts.items()}
            ratios.append({-1: min(ratio[-1], 0.0), 0: 0.0, 1: max(ratio[1], 0.0)})
    return prior, ratios


def judged(measured: DataFrame) -> DataFrame:
    """Add base_failed, p_good and kept to the rows of ``features`` (a saved table)."""
    chosen = rules()
    counts = measured.groupBy(*[v.alias(k) for k, v in chosen.items()]).count()
    # At most 3^rules rows, whatever the number of documents.
    prior, ratios = estimate(sorted((tuple(r[k] for k in chosen), r["count"]) for r in counts.collect()))
    logit = F.lit(prior)
    for (_, v), ratio in zip(chosen.items(), ratios):
        logit = logit + F.when(v == 1, ratio[1]).when(v == -1, ratio[-1]).otherwise(0.0)
    silent = F.lit(True)
    for v in chosen.values():
        silent = silent & (v == 0)
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    p = 1 / (1 + F.exp(-logit))
    return measured.withColumn("base_failed", base).withColumn("p_good", p).withColumn("kept", ~base & (silent | (p >= 0.5)))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return judged(Scratch(spark, "op6").save(features(docs), "features")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "p_good"
    )
