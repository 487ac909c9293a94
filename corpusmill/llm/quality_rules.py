"""Rule bitmask ledger: every rule is evaluated once, policies and ablations are bit operations on its result.

The ledger holds one row per document with the measurements and ``failed_bits``, in which bit *i* is set when
rule *i* fails. A policy is a version and a mask of the rules that reject; applying another version, or asking
what each of its rules costs, never reads a text again.

Defined results: a null text counts as an empty one; empty texts have zero measurements and fail ``few_words``;
repeated rows give repeated results; an empty table gives an empty ledger. Only the id and the text are read, so
further columns of any name do no harm. Texts are measured whole, in their own row: nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.words import words_of

SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5

# Rule names in the order of their bits, and the condition (SQL over the measurements) under which each fails.
RULES: dict[str, str] = {
    "few_words": "n_words < 10",
    "repeated_windows": "100 * n_repeat_words > 20 * n_words",
    "symbols": "100 * n_symbols > 10 * n_words",
    "duplicate_lines": "100 * n_dup_lines > 50 * n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 25 * n_words",
}
BASE_RULES = ("few_words", "repeated_windows")
# Policies by version; each names the rules that reject.
POLICIES: dict[str, tuple[str, ...]] = {
    "v1": BASE_RULES,
    "v2": (*BASE_RULES, "symbols", "duplicate_lines"),
    "v3": tuple(RULES),
}
MEASUREMENTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def mask_of(rules: tuple[str, ...]) -> int:
    names = list(RULES)
    return sum(1 << names.index(rule) for rule in rules)


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id and the measurements of every text, one row per row."""
    long = lambda c: c.cast("bigint")
    rows = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    lines = F.filter(F.split("_text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    rows = words_of(rows, "_text").withColumn("_lines", lines)
    n_windows = F.greatest(F.size("_words") - (WINDOW - 1), F.lit(0))
    shifted = F.arrays_zip(*[F.slice("_words", k + 1, n_windows).alias(f"w{k}") for k in range(WINDOW)])
    rows = rows.select(
        id_col,
        long(F.size("_words")).alias("n_words"),
        long(F.char_length(F.array_join("_words", ""))).alias("word_chars"),
        long(F.regexp_count("_text", F.lit(SYMBOLS))).alias("n_symbols"),
        long(F.size("_lines")).alias("n_lines"),
        long(F.size("_lines") - F.size(F.array_distinct("_lines"))).alias("n_dup_lines"),
        F.transform(shifted, lambda window: F.xxhash64(window)).alias("_windows"),
    )
    # Only texts with a repeated window pay for sorting: windows by hash, so that equal ones are neighbours.
    placed = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    rows = rows.withColumn("_placed", F.when(repeats, placed)).drop("_windows")
    starts = F.transform(
        F.filter(
            "_placed",
            lambda p, k: (p["h"] == F.get(F.col("_placed"), k + 1)["h"])
            | ((k > 0) & (p["h"] == F.get(F.col("_placed"), k - 1)["h"])),
        ),
        lambda p: p["i"],
    )
    rows = rows.withColumn("_starts", F.sort_array(starts)).drop("_placed")
    covered = F.aggregate(
        F.transform(
            "_starts",
            lambda s, k: F.least(F.coalesce(F.get(F.col("_starts"), k + 1) - s, F.lit(WINDOW)), F.lit(WINDOW)),
        ),
        F.lit(0).cast("bigint"),
        lambda total, n: total + n,
    )
    return rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("bigint"))).select(
        id_col, *MEASUREMENTS
    )


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Measurements and ``failed_bits`` (bigint) of every document; the only step that reads texts."""
    bits = F.lit(0).cast("bigint")
    for bit, condition in enumerate(RULES.values()):
        bits = bits.bitwiseOR(F.when(F.expr(condition), F.lit(1 << bit)).otherwise(F.lit(0)).cast("bigint"))
    entries = measured(docs, id_col, text_col).withColumn("failed_bits", bits)
    # A generator keeps filters on the verdict from being pushed into the measurements, which would repeat them.
    return entries.select(F.inline(F.array(F.struct(*entries.columns))))


def apply_policy(entries: DataFrame, rules: tuple[str, ...]) -> DataFrame:
    """The ledger with ``base_failed`` and ``kept``: a document stays if no rule of the policy failed."""
    failed = lambda names: F.col("failed_bits").bitwiseAND(F.lit(mask_of(names)).cast("bigint")) != 0
    base = failed(BASE_RULES)
    return entries.withColumn("base_failed", base).withColumn("kept", ~base & ~failed(rules))


def ablations(entries: DataFrame, policies: Mapping[str, tuple[str, ...]] | None = None) -> DataFrame:
    """Per policy version and rule of it: documents, rejected ones, those the rule fails, those only it rejects.

    One pass and one small shuffle: rows are first counted by their bits, of which there are at most
    2 ** len(RULES) different ones, and the policies meet these counts only.
    """
    policies = POLICIES if policies is None else policies
    counts = entries.groupBy("failed_bits").agg(F.count("*").alias("n"))
    names = list(RULES)
    pairs = [
        F.struct(
            F.lit(version).alias("policy"),
            F.lit(rule).alias("rule"),
            F.lit(mask_of(rules)).cast("bigint").alias("mask"),
            F.lit(1 << names.index(rule)).cast("bigint").alias("bit"),
        )
        for version, rules in policies.items()
        for rule in rules
    ]
    rows = counts.select("failed_bits", "n", F.inline(F.array(*pairs)))
    hit = F.col("failed_bits").bitwiseAND(F.col("mask"))
    total = lambda condition: F.sum(F.when(condition, F.col("n")).otherwise(0))
    return rows.groupBy("policy", "rule").agg(
        F.sum("n").alias("n_docs"),
        total(hit != 0).alias("n_rejected"),
        total(hit.bitwiseAND(F.col("bit")) != 0).alias("n_failed"),
        total(hit == F.col("bit")).alias("n_only_here"),
    )
