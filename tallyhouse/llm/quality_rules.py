"""Quality rules as a ledger of bits, built-in expressions only.

``ledger`` evaluates every rule once per text and stores the measurements and one bit per
failed rule. A policy is a named, versioned set of rules; applying one, or asking what
each of its rules is worth, only reads the bits and never the texts.

Words are maximal runs without space, tab, line feed, vertical tab, form feed and carriage
return. A repeated word lies in a window of three words that the text has twice or more;
windows are compared by a 64-bit hash within one text.

Defined results: a null or empty text has no words, all measurements are 0 and it fails
``few_words`` alone. A null id and repeated rows are measured like any others; one row out
per row in. Columns of the input that clash with those added here keep their name, the
added ones get an underscore appended (``ledger``); ``measures`` and ``op3`` return their
own columns alone. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse.llm.columns import column, fresh

WHITE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]+"
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
)

#: Rule -> condition of failure over the measures. The place of a rule is its bit; append
#: new ones at the end.
RULES: Mapping[str, str] = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "many_symbols": "10 * n_symbols > n_words",
    "repeated_lines": "100 * n_dup_lines > 50 * n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 15 * n_words",
}


@dataclass(frozen=True)
class Policy:
    """A version of what is kept: texts that fail none of ``rules``."""

    name: str
    version: int
    rules: Sequence[str]

    @property
    def mask(self) -> int:
        return mask(self.rules)


def mask(rules: Sequence[str]) -> int:
    return sum(1 << list(RULES).index(rule) for rule in set(rules))


BASE = Policy("base", 1, ("few_words", "repeated_words"))
STRICT = Policy("strict", 1, tuple(RULES))


def _repeat_words(words: Column, windows: Column) -> Column:
    """Words covered by windows whose hash comes more than once. The windows are sorted with
    their places, so the work is n log n however repetitive the text is."""
    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def repeated(rows: Column) -> Column:
        found = F.filter(
            rows,
            lambda x, k: ((k > 0) & (F.get(rows, k - 1)["h"] == x["h"]))
            | F.coalesce(F.get(rows, k + 1)["h"] == x["h"], F.lit(False)),
        )
        return F.sort_array(F.transform(found, lambda x: x["i"]))

    def covered(places: Column) -> Column:
        """Each window covers three words, or as many as lie before the next window."""
        steps = F.transform(
            places,
            lambda x, k: F.least(F.lit(3), F.coalesce(F.get(places, k + 1) - x, F.lit(3))),
        )
        return F.aggregate(steps, F.lit(0), lambda total, x: total + x)

    # Binding a value with a one-element transform evaluates it once per text.
    bound = F.transform(F.array(placed), repeated)
    return F.get(F.transform(bound, covered), 0)


def _measured(docs: DataFrame, text_column: str, prefix: str) -> DataFrame:
    """``docs`` with the measures under ``prefix``-ed names."""
    name = lambda x: prefix + x
    text = F.coalesce(column(text_column).cast("string"), F.lit(""))
    words, windows, lines = F.col(name("words")), F.col(name("windows")), F.col(name("lines"))
    kept = [column(c) for c in docs.columns]
    split = docs.select(
        *kept,
        F.array_remove(F.split(text, WHITE), "").alias(name("words")),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD)).alias(name("lines")),
        (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).alias(name("n_symbols")),
    )
    hashed = split.select(
        "*",
        F.when(
            F.size(words) > 2,
            F.transform(
                F.sequence(F.lit(0), F.size(words) - 3),
                lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
            ),
        ).otherwise(F.array().cast("array<bigint>")).alias(name("windows")),
    )
    repeats = F.when(
        F.size(F.array_distinct(windows)) < F.size(windows), _repeat_words(words, windows)
    ).otherwise(0)
    measures = {
        "n_words": F.size(words),
        "word_chars": F.length(F.array_join(words, "")),
        "n_symbols": F.col(name("n_symbols")),
        "n_lines": F.size(lines),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": repeats,
    }
    return hashed.select(
        *kept, *[value.cast("bigint").alias(name(m)) for m, value in measures.items()]
    )


def ledger(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``docs`` with the measures and ``failed_rules``, the bits of the rules it fails."""
    prefix = fresh([c[: len("ledger_")] for c in docs.columns], "ledger_")
    measured = _measured(docs, text_column, prefix)
    values = {m: F.col(prefix + m) for m in MEASURES}
    bits = F.lit(0).cast("bigint")
    named = measured.select(
        *[column(c) for c in docs.columns], F.struct(*[v.alias(m) for m, v in values.items()]).alias(prefix)
    )
    for place, rule in enumerate(RULES.values()):
        condition = rule
        for m in MEASURES:
            condition = condition.replace(m, f"`{prefix}`.{m}") if m in condition else condition
        bits = bits.bitwiseOR(F.when(F.expr(condition), F.lit(1 << place)).otherwise(0).cast("bigint"))
    out = [column(c) for c in docs.columns]
    out += [F.col(prefix)[m].alias(fresh(docs, m)) for m in MEASURES]
    return named.select(*out, bits.alias(fresh(docs, "failed_rules")))


def passes(policy: Policy, bits: str = "failed_rules") -> Column:
    return column(bits).bitwiseAND(F.lit(policy.mask).cast("bigint")) == 0


def ablation(rows: DataFrame, policies: Sequence[Policy], bits: str = "failed_rules") -> DataFrame:
    """Per policy and rule: texts that fail the rule, texts that fail it alone (kept without
    it), and texts the policy keeps. One pass: equal bit sets are counted first, so at most
    ``2 ** len(RULES)`` rows are shuffled per task."""
    counted = rows.groupBy(column(bits).alias("bits")).agg(F.count("*").alias("texts"))
    wanted = F.array(*[
        F.struct(
            F.lit(p.name).alias("policy"),
            F.lit(p.version).alias("version"),
            F.lit(rule).alias("rule"),
            F.lit(p.mask).cast("bigint").alias("mask"),
            F.lit(mask([rule])).cast("bigint").alias("bit"),
        )
        for p in policies
        for rule in p.rules
    ])
    failed = F.col("bits").bitwiseAND(F.col("w.mask"))

    def texts_if(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("texts"))), F.lit(0))

    return (
        counted.select("*", F.explode(wanted).alias("w"))
        .groupBy("w.policy", "w.version", "w.rule")
        .agg(
            texts_if(failed.bitwiseAND(F.col("w.bit")) != 0).alias("failed"),
            texts_if(failed == F.col("w.bit")).alias("failed_alone"),
            texts_if(failed == 0).alias("kept"),
        )
    )


def keep(docs: DataFrame, policy: Policy = STRICT, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass ``policy``, with their columns."""
    rows = ledger(docs, text_column)
    # A row number is no deterministic column: the filter stays above the measures instead of
    # being pushed below them with a copy of all their expressions.
    number = fresh(rows, "row_number")
    numbered = rows.withColumn(number, F.monotonically_increasing_id())
    passed = passes(policy, fresh(docs, "failed_rules")) & (F.col(number) >= 0)
    return numbered.filter(passed).select(*[column(c) for c in docs.columns])
