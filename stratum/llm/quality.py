"""Quality rules as a short-circuit cascade (DataFrame functions only).

:func:`base_measures` adds counts over a whole text. A :class:`Rule` is a named
condition under which a document fails. :func:`order_rules` estimates every
rule's cost (seconds that a scan of a bounded sample takes with it) and
selectivity (part of the sample that it rejects), and orders the rules by
rejection per cost. :func:`cascade` evaluates them in that order and stops at
the first that fails, so a costly rule runs only on what the rules before it
left. The verdict is the same in any order: a document is kept if no rule
fails, and a rule whose condition is null counts as passed.

Defined results: a null text counts as empty: all measures are 0, and it fails
``n_words < 20``; texts are taken whole; repeated rows give repeated rows.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import let

BLANKS = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
#: Words in a repeated window.
WINDOW = 8


@dataclass(frozen=True)
class Rule:
    name: str
    fails: Column


def words_of(text: Column) -> Column:
    """The words of a text as an array; null: none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANKS), lambda w: w != "")


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """The number of words that lie in a window found twice or more.

    Windows are compared by a 64-bit hash. A text without a repeated window,
    the usual case, ends with a count of distinct hashes; else the windows are
    sorted by hash and place, equal neighbours give the repeated places, and
    each place adds the words up to the next one, ``window`` at most."""

    def covered(places: Column) -> Column:
        return F.aggregate(
            F.transform(
                places,
                lambda p, i: F.least(F.lit(window), F.coalesce(F.get(places, i + 1) - p, F.lit(window))),
            ),
            F.lit(0),
            lambda n, x: n + x,
        )

    def heavy(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(
            pairs,
            lambda s: let(
                F.sort_array(
                    F.filter(
                        F.transform(
                            s,
                            lambda x, i: F.when(
                                F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False))
                                | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)),
                                x["i"],
                            ),
                        ),
                        lambda p: p.isNotNull(),
                    )
                ),
                covered,
            ),
        )

    def count(w: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(w) - (window - 1))
        return F.when(F.size(w) <= window, F.lit(0)).otherwise(
            let(
                F.transform(starts, lambda i: F.xxhash64(F.slice(w, i, window))),
                lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(heavy(h)),
            )
        )

    return let(words, count).cast("bigint")


def base_measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines and
    n_repeat_words (columns of these names are replaced)."""
    value = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(value, "\n", -1), lambda x: F.regexp_like(x, F.lit(r"[^\x20\x09-\x0D]")))
    return docs.withColumns(
        {
            "n_words": F.regexp_count(value, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint"),
            "word_chars": F.length(F.translate(value, " \t\n\x0b\x0c\r", "")).cast("bigint"),
            "n_symbols": (
                F.length(value) - F.length(F.translate(value, "#*$%&|<>", ""))
            ).cast("bigint"),
            "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint"),
            "n_repeat_words": repeated_words(words_of(F.col(text))),
        }
    )


def default_rules(text: str = "text") -> list[Rule]:
    """Rules over the measures and the text. They are wide enough for any
    ordinary prose and reject texts that are mostly symbols, repetition,
    markup, capitals or digits."""
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    words = F.greatest(F.col("n_words"), F.lit(1))
    value = F.coalesce(F.col(text), F.lit(""))
    return [
        Rule("word_length", (F.col("word_chars") < 2 * words) | (F.col("word_chars") > 20 * words)),
        Rule("symbols", 10 * F.col("n_symbols") > F.col("n_words")),
        Rule("dup_lines", 10 * F.col("n_dup_lines") > 3 * (F.length(value) - F.length(F.translate(value, "\n", "")) + 1)),
        Rule("digits", 10 * F.length(F.regexp_replace(value, "[^0-9]+", "")) > 3 * chars),
        Rule("exclamations", 5 * (F.length(value) - F.length(F.translate(value, "!", ""))) > F.col("n_words")),
        Rule("letters", 10 * F.length(F.regexp_replace(value, r"[^\p{L}]+", "")) < 6 * chars),
    ]


def order_rules(measured: DataFrame, rules: Sequence[Rule], repeats: int = 2) -> list[Rule]:
    """The rules by estimated rejection per cost on ``measured``, a bounded
    sample; equal ones keep their order."""
    measured.count()  # the first scan also opens the files

    def seconds(*columns: Column) -> float:
        took = []
        for _ in range(repeats):
            began = time.perf_counter()
            measured.agg(F.count("*"), *columns).collect()
            took.append(time.perf_counter() - began)
        return min(took)

    if not rules:
        return []
    n, *rejected = measured.agg(F.count("*"), *(F.count_if(r.fails) for r in rules)).first()
    idle = seconds()
    value = []
    for rule, k in zip(rules, rejected):
        cost = max(seconds(F.count_if(rule.fails)) - idle, 1e-4)
        value.append(((k / n) if n else 0.0) / cost)
    return [r for _, r in sorted(zip(value, rules), key=lambda x: -x[0])]


def cascade(rules: Sequence[Rule]) -> Column:
    """The name of the first rule that fails, null if none does. CASE stops at
    the first branch that holds."""
    out = None
    for rule in rules:
        branch = F.coalesce(rule.fails, F.lit(False))
        out = F.when(branch, F.lit(rule.name)) if out is None else out.when(branch, F.lit(rule.name))
    return F.lit(None).cast("string") if out is None else out


def sample_rows(docs: DataFrame, id: str, rows: int) -> DataFrame:
    """About ``rows`` rows by a hash of the id, all if there are fewer."""
    n = docs.count()
    part = min(1.0, rows / n) if n else 1.0
    return docs.where(F.pmod(F.xxhash64(F.col(id)), F.lit(1 << 32)) < int(part * (1 << 32)))


def judge(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    rules: Sequence[Rule] | None = None,
    sample: int = 1000,
) -> DataFrame:
    """``docs`` with the measures, ``base_failed`` and ``kept``. ``sample``
    bounds what the order of the rules is estimated on; it has no influence on
    any verdict."""
    from stratum.llm.common import stored

    rules = default_rules(text) if rules is None else list(rules)
    few = stored(base_measures(sample_rows(docs.select(id, text), id, sample), text), "quality-sample")
    ordered = order_rules(few, rules)
    base_failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return (
        base_measures(docs, text)
        .withColumn("base_failed", base_failed)
        .withColumn("kept", F.when(F.col("base_failed"), False).otherwise(cascade(ordered).isNull()))
    )
