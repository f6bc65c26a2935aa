"""Quality rules as a short-circuit cascade of native expressions.

Every rule is a boolean expression over a text that is true where the rule
rejects it.  On a bounded sample the cascade measures each rule's cost
(seconds of an aggregate over the sample) and selectivity (share rejected),
orders the rules by rejection per cost, and evaluates them as one CASE: a
text that a rule rejects reaches no later rule.  The order changes the cost
only; whether a text is kept is the same for every order.

Words are runs of characters other than space and U+0009 to U+000D.  A null
text is empty: no words, so it fails the base rules.  Texts are read whole.
Repeated rows are judged each by itself.  Other columns are passed through;
the statistics' names replace columns of the same name.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestflow.llm.common import bind, text_or_empty

#: Fixed values of the word and symbol classes.
SPACE = " \t\n\x0b\x0c\r"
SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 8

#: Texts of the sample on which costs and selectivities are measured (it fixes the order only).
SAMPLE_ROWS = 1000


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Column], Column]


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACES), "")


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def repeated_words(word_list: Column, width: int = WINDOW) -> Column:
    """Words inside ``width``-word windows that occur twice or more.

    Windows are told apart by 64-bit hashes.  Linear in the words for texts
    without a repeated window; a sort of the windows for the others.
    """

    def windows(w: Column) -> Column:
        hashed = F.transform(w, lambda x: F.xxhash64(x))
        return bind(hashed, lambda h: F.transform(F.sequence(F.lit(1), F.size(w) - width + 1),
                                                  lambda i: F.xxhash64(F.slice(h, i, width))))

    def places(h: Column) -> Column:
        ordered = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        twice = bind(ordered, lambda s: F.filter(s, lambda x, k: (
            F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False))
            | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False)))))
        return F.array_sort(F.transform(twice, lambda x: x["i"]))

    def covered(at: Column) -> Column:
        return F.coalesce(F.aggregate(
            F.transform(at, lambda x, k: F.least(F.lit(width), F.coalesce(F.get(at, k + 1) - x, F.lit(width)))),
            F.lit(0), lambda a, x: a + x), F.lit(0))

    def count(w: Column) -> Column:
        return F.when(F.size(w) <= width, F.lit(0)).otherwise(bind(windows(w), lambda h: F.when(
            F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(bind(places(h), covered))))

    return bind(word_list, count).cast("long")


def duplicate_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    return bind(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    t = text_or_empty(text)
    bare = _without(t, SPACE)
    word_list = words(t)
    # One pass over the words gives both counts that need them.
    counted = docs.withColumn("__w", bind(word_list, lambda w: F.struct(
        F.size(w).cast("long").alias("n"), repeated_words(w).alias("r"))))
    n, r = F.col("__w.n"), F.col("__w.r")
    return counted.withColumns({
        "n_words": n,
        "word_chars": F.length(bare).cast("long"),
        "n_symbols": (F.length(t) - F.length(_without(t, SYMBOLS))).cast("long"),
        "n_dup_lines": duplicate_lines(t),
        "n_repeat_words": r,
        "base_failed": (n < 20) | (100 * r > 30 * n),
    }).drop("__w")


def _words_number(t: Column) -> Column:
    return F.greatest(F.size(words(t)), F.lit(1))


#: Production rules: each rejects texts of a form that prose of any language does not take.
RULES = (
    # More than one symbol (#, *, $, ...) for five words.
    Rule("symbols", lambda t: 5 * (F.length(t) - F.length(_without(t, SYMBOLS))) > _words_number(t)),
    # Three tenths of the lines, and four or more, repeat an earlier line.
    Rule("repeated lines", lambda t: bind(
        F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != ""),
        lambda x: (F.size(x) - F.size(F.array_distinct(x)) >= 4)
        & (10 * (F.size(x) - F.size(F.array_distinct(x))) > 3 * F.size(x)))),
    # Fewer than half of the characters in words are letters or marks.
    Rule("letters", lambda t: 2 * F.length(F.regexp_replace(t, r"[^\p{L}\p{M}]+", "")) < F.length(_without(t, SPACE))),
    # Words of more than 25 characters on average: no word boundaries, encoded data.
    Rule("word length", lambda t: F.length(_without(t, SPACE)) > 25 * _words_number(t)),
    # One exclamation or question mark for three words.
    Rule("exclamations", lambda t: 3 * (F.length(t) - F.length(_without(t, "!?"))) > _words_number(t)),
)


def rule_order(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text",
               sample_rows: int = SAMPLE_ROWS) -> list[tuple[Rule, float, float]]:
    """Rules with measured cost and selectivity, most rejection per cost first.

    The sample is at most ``sample_rows`` texts; an empty one keeps the order given.
    """
    sample = docs.select(text_or_empty(text).alias("t")).limit(sample_rows).persist()
    try:
        sample.count()
        measured = []
        for rule in rules:
            took = []
            for _ in range(2):  # the first run compiles the expression
                began = time.perf_counter()
                n, hits = sample.agg(F.count(F.lit(1)), F.count_if(rule.rejects(F.col("t")))).first()
                took.append(time.perf_counter() - began)
            measured.append((rule, took[-1], hits / n if n else 0.0))
    finally:
        sample.unpersist()
    return sorted(measured, key=lambda m: -(m[2] / max(m[1], 1e-9)))


def cascade(rules: list[Rule], text: str = "text") -> Column:
    """The name of the first rule that rejects the text, else null; later rules are not evaluated."""
    t = text_or_empty(text)
    out = F
    for rule in rules:
        out = out.when(F.coalesce(rule.rejects(t), F.lit(False)), F.lit(rule.name))
    return out.otherwise(F.lit(None).cast("string")) if rules else F.lit(None).cast("string")


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """``docs`` with the base statistics, ``base_failed``, ``rejected_by`` and ``kept``.

    ``rejected_by`` names the first rule, in the measured order, that rejects.
    """
    order = [rule for rule, _, _ in rule_order(docs, rules, text)]
    judged = with_statistics(docs, text)
    verdict = F.when(F.col("base_failed"), F.lit("base")).otherwise(cascade(order, text))
    return judged.withColumn("rejected_by", verdict).withColumn("kept", F.col("rejected_by").isNull())


def kept_only(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with the columns they came with."""
    order = [rule for rule, _, _ in rule_order(docs, rules, text)]
    t = text_or_empty(text)
    base = bind(words(t), lambda w: (F.size(w) < 20) | (100 * repeated_words(w) > 30 * F.size(w)))
    return docs.where(~base & cascade(order, text).isNull())
