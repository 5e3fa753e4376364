"""Quality rules as a ledger of failure bits, with policies applied afterwards (operator 7).

``ledger`` evaluates every rule once and stores, per document, the measurements and one bit per failed rule.
A policy is a version and the rules it enforces: applying or comparing policies is arithmetic on the bits and
reads no text. Built from SQL functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5


@dataclass(frozen=True)
class Policy:
    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << list(RULES).index(name) for name in self.rules)


#: Name of each rule and when a document fails it, over the ledger's measurements. The order gives the bits.
RULES: dict[str, str] = {
    "few_words": "n_words < 10",
    "repeated_words": "100 * n_repeat_words > 20 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "repeated_lines": "n_dup_lines > 1 and 10 * n_dup_lines > 3 * n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 15 * n_words",
    "shouting": "n_upper > 0.5 * word_chars",
    "long_text": "n_words > 100000",
}
BASE = ("few_words", "repeated_words")
POLICIES = (
    Policy("v1", BASE),
    Policy("v2", (*BASE, "symbols", "repeated_lines", "short_words", "long_words", "shouting")),
    Policy("strict", tuple(RULES)),
)
CURRENT = POLICIES[1]
MEASUREMENTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper")


def _repeat_words(hashes: Column) -> Column:
    """Words covered by the windows whose hash occurs twice: places sorted by hash, equal neighbours kept."""
    pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    at = lambda p, k: F.get(p, k)["h"]
    return F.transform(
        F.array(pairs),
        lambda p: F.array_sort(
            F.transform(
                F.filter(p, lambda x, k: x["h"].eqNullSafe(at(p, k - 1)) | x["h"].eqNullSafe(at(p, k + 1))),
                lambda x: x["i"],
            )
        ),
    )[0]


def measured(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split("t", "\n"), lambda x: F.length(F.trim(x, F.lit(" \t\n\x0b\x0c\r"))) > 0)
    spaced = docs.select("doc_id", text.alias("t"))
    worded = spaced.select(
        "doc_id",
        F.array_remove(F.split("t", SPACE), "").alias("w"),
        (F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace("t", r"[^\p{Lu}]+", "")).cast("long").alias("n_upper"),
        lines.alias("lines"),
    )
    counted = worded.select(
        "doc_id",
        "n_symbols",
        "n_upper",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(
            F.size("w") > WINDOW,
            F.transform(
                F.sequence(F.lit(1), F.size("w") - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("w", i, WINDOW))
            ),
        ).alias("h"),
    )
    repeats = F.when(F.size(F.array_distinct("h")) < F.size("h"), _repeat_words(F.col("h")))
    placed = counted.withColumn("p", repeats)
    covered = F.aggregate(
        F.zip_with("p", F.slice("p", 2, F.size("p")), lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW))),
        F.lit(0).cast("long"),
        lambda total, x: total + x,
    )
    return placed.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).select("doc_id", *MEASUREMENTS)


def ledger(docs: DataFrame) -> DataFrame:
    """(doc_id, measurements, failed) for each row of ``docs``: bit k of ``failed`` is set if rule k fails.

    Null text has no words and one blank line. Each row stands for itself, so repeated and null doc_ids need
    no rule. Other columns are ignored.
    """
    bits = [F.when(F.expr(test), F.lit(1 << k)).otherwise(0) for k, test in enumerate(RULES.values())]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return measured(docs).withColumn("failed", failed.cast("long"))


def apply_policy(rows: DataFrame, policy: Policy) -> DataFrame:
    """Adds ``kept`` and the policy's version to a ledger."""
    return rows.withColumns(
        {"kept": F.col("failed").bitwiseAND(F.lit(policy.mask)) == 0, "policy": F.lit(policy.version)}
    )


def ablation(rows: DataFrame, policies: tuple[Policy, ...] = POLICIES) -> DataFrame:
    """(policy, rule, n_failed, n_only): documents that fail a rule, and those a policy rejects for it alone.

    One pass over the ledger; with no rows every count is zero.
    """
    counts, names = [], []
    for p in policies:
        for name in p.rules:
            bit = 1 << list(RULES).index(name)
            of_policy = F.col("failed").bitwiseAND(F.lit(p.mask))
            names.append((p.version, name))
            counts.append(
                F.struct(
                    F.lit(p.version).alias("policy"),
                    F.lit(name).alias("rule"),
                    F.count_if(of_policy.bitwiseAND(F.lit(bit)) != 0).alias("n_failed"),
                    F.count_if(of_policy == bit).alias("n_only"),
                )
            )
    return rows.agg(F.array(*counts).alias("r")).select(F.explode("r").alias("r")).select("r.*")
