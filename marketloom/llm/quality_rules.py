"""Quality rules as a ledger of failure bits.

Every rule is evaluated once per document: :func:`ledger` stores the measurements and one
integer in which bit k says that rule k failed.  A policy is a versioned set of rules, i.e.
a bit mask; applying another policy, or asking what each rule contributes
(:func:`ablations`), reads the stored bits only and never the texts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import SPACE, whole_text, words

SYMBOLS = "[^#*$%&|<>]+"  # everything but the counted symbols

#: Rule name -> failure condition over the measurements; the position is the bit.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "4 * n_symbols > n_words",
    "repeated_lines": "10 * n_dup_lines > 3 * n_lines",
    "capitals": "2 * n_upper > word_chars",
    "odd_word_length": "word_chars < 2 * n_words or word_chars > 25 * n_words",
}

#: Versioned policies: the rules whose failure rejects a document.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_words"),
    "v1": tuple(RULES),
    "v2": ("few_words", "repeated_words", "symbols", "capitals"),
}
CURRENT = "v1"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper")


def mask(policy: str) -> int:
    names = list(RULES)
    return reduce(int.__or__, (1 << names.index(rule) for rule in POLICIES[policy]), 0)


def failed(policy: str, bits: str = "fail_bits") -> Column:
    """Whether a document's bits break the policy."""
    return F.col(bits).bitwiseAND(F.lit(mask(policy)).cast("bigint")) != 0


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once, also where the optimizer moves the
    expression: inside another lambda it would else be worked out for every element."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _windows(w: Column) -> Column:
    """The text's 3-word windows, sorted so that equal ones are neighbours: structs of hash
    (which makes most comparisons cheap), the three words, and the position."""
    starts = F.when(F.size(w) >= 3, F.sequence(F.lit(0), F.size(w) - 3)).otherwise(F.array().cast("array<int>"))
    return F.sort_array(
        F.transform(
            starts,
            lambda i: F.struct(
                F.xxhash64(w[i], w[i + 1], w[i + 2]).alias("h"),
                w[i].alias("a"), w[i + 1].alias("b"), w[i + 2].alias("c"), i.alias("i"),
            ),
        )
    )


def _same(x: Column, y: Column) -> Column:
    return (x["h"] == y["h"]) & (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"])


def _repeat_words(s: Column) -> Column:
    """Number of words inside windows that occur twice or more, from the sorted windows."""
    last = F.size(s) - 1
    repeated = F.filter(
        s, lambda x, k: ((k > 0) & _same(x, s[F.greatest(k - 1, F.lit(0))])) | ((k < last) & _same(x, s[F.least(k + 1, last)]))
    )
    covered = F.flatten(F.transform(repeated, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))
    return F.size(F.array_distinct(covered)).cast("bigint")


def ledger(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``_row`` (all columns of ``docs`` as a struct), the measurements, ``fail_bits``, and a
    running number ``_at``.

    * A null or empty text measures 0 everywhere and fails ``few_words``.
    * Repeated rows and ties are measured each for itself; an empty table stays empty.
    * Columns of ``docs`` may have any name: they are kept inside ``_row``.
    """
    text = F.col("_text")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), whole_text(text_col).alias("_text"))
    rows = rows.withColumns({"_w": words("_text"), "_l": F.filter(F.split(text, "\n"), lambda x: F.length(F.trim(F.translate(x, "\t\n\x0b\x0c\r", "     "))) > 0)})
    measured = rows.select(
        "_row",
        F.size("_w").cast("bigint").alias("n_words"),
        F.length(F.regexp_replace(text, SPACE, "")).cast("bigint").alias("word_chars"),
        F.length(F.regexp_replace(text, SYMBOLS, "")).cast("bigint").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("bigint").alias("n_dup_lines"),
        _bound(F.col("_w"), lambda w: _bound(_windows(w), _repeat_words)).alias("n_repeat_words"),
        F.size("_l").cast("bigint").alias("n_lines"),
        F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("bigint").alias("n_upper"),
        # A filter on this is not moved below the measurements, which would repeat them.
        F.monotonically_increasing_id().alias("_at"),
    )
    bits = [F.when(F.expr(rule), 1 << k).otherwise(0).cast("bigint") for k, rule in enumerate(RULES.values())]
    return measured.withColumn("fail_bits", reduce(lambda a, b: a.bitwiseOR(b), bits))


def judged(ledger_rows: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The ledger with ``base_failed`` and ``kept`` under a policy."""
    return ledger_rows.withColumns({
        "base_failed": failed("base"),
        "kept": ~failed("base") & ~failed(policy),
    })


def ablations(ledger_rows: DataFrame, policy: str = CURRENT) -> DataFrame:
    """Per rule of a policy: ``rule, bit, n_docs, n_failed, n_only`` — documents, those that
    fail the rule, and those that only this rule rejects (what dropping it would bring back).

    Documents are first counted by bit pattern (at most 2^rules rows), so the second step
    and its few output rows do not grow with the corpus.  An empty ledger gives no rows.
    """
    patterns = ledger_rows.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("_n"))
    names = list(RULES)
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(names.index(r)).alias("bit")) for r in POLICIES[policy]])
    bit = F.expr("shiftleft(1L, _r.bit)")
    broken = F.col("fail_bits").bitwiseAND(F.lit(mask(policy)).cast("bigint"))
    return (
        patterns.withColumn("_r", F.explode(rules))
        .groupBy(F.col("_r.rule").alias("rule"), F.col("_r.bit").alias("bit"))
        .agg(
            F.sum("_n").alias("n_docs"),
            F.sum(F.when(broken.bitwiseAND(bit) != 0, F.col("_n")).otherwise(0)).alias("n_failed"),
            F.sum(F.when(broken == bit, F.col("_n")).otherwise(0)).alias("n_only"),
        )
    )


def keep_good(docs: DataFrame, policy: str = CURRENT, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass a policy, with their own columns only."""
    kept = judged(ledger(docs, text_col), policy).filter("kept and _at >= 0")
    return kept.select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns])
