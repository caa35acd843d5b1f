"""Quality rules: a table of thresholds over text measures, compiled into one
projection of built-in Spark functions. No user functions, no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetplan.llm.common import evaluated_once, fresh

WINDOW = 3
# Patterns: white space, symbols, the rest of a word from its first letter on, runs of capitals.
SPACE = r"[\x20\x09-\x0D]++"
SYMBOL = r"[#*$%&|<>]"
LETTER_ON = r"\p{L}[^\x20\x09-\x0D]*+"
CAPITALS = r"\p{Lu}{2,}+"

# Frequent function words of the languages the rules know.
STOP_WORDS = {
    "en": ("the", "and", "of", "to", "in", "is", "that", "for", "was", "with", "on", "be", "by", "this", "from", "are", "an", "as", "it", "at", "a"),
    "de": ("der", "die", "das", "und", "ist", "zu", "von", "mit", "den", "des", "ein", "eine", "nicht", "auf", "für", "im", "in", "dem", "sich", "als"),
    "fr": ("le", "la", "les", "de", "des", "et", "est", "un", "une", "en", "que", "dans", "pour", "par", "sur", "au", "qui", "avec", "du", "plus"),
    "es": ("el", "la", "los", "las", "de", "y", "que", "en", "un", "una", "es", "por", "con", "para", "del", "se", "no", "su", "al", "como"),
}


@dataclass(frozen=True)
class Rule:
    """A measure (a SQL expression over the counts) and the values that pass."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


# The base rules of the contract in exact integer form, then the ratios.
BASE_RULES = (
    Rule("too_few_words", "n_words", low=50),
    Rule("repeated_words", "100 * n_repeat_words - 50 * n_words", high=0),
)
RULES = (
    Rule("word_length", "try_divide(word_chars, n_words)", low=2.0, high=15.0),
    Rule("symbols", "try_divide(n_symbols, n_words)", high=0.25),
    Rule("stop_words", "try_divide(n_stop_words, n_words)", low=0.01),
    Rule("letter_words", "try_divide(n_letter_words, n_words)", low=0.7),
    Rule("capitals", "try_divide(n_capital_runs, n_words)", high=0.4),
    Rule("duplicate_lines", "try_divide(n_dup_lines, greatest(n_lines, 1))", high=0.5),
)

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words", "n_letter_words", "n_capital_runs")


def count_measures(docs: DataFrame, text: str = "text", into: str = "counts") -> DataFrame:
    """``docs`` with a struct ``into`` of the counts (long) of each whole text.

    Words are maximal runs without ASCII white space, lines are split at \\n and
    count if they hold a word. ``n_dup_lines`` counts lines equal to an earlier
    one; ``n_repeat_words`` counts the words within windows of three words that
    occur at least twice. A null text has no words; empty texts and repeated
    rows need no care.
    """
    taken = [*docs.columns, into]
    body, words, lines, grams = (fresh(taken, f"rule_{x}") for x in ("body", "words", "lines", "grams"))
    own = F.coalesce(F.col(text), F.lit(""))
    stop = sorted({v for group in STOP_WORDS.values() for w in group for v in (w, w.title())})
    step = docs.withColumn(body, own).withColumn(words, F.array_remove(F.split(body, SPACE), ""))
    step = step.withColumn(lines, F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    w = F.col(words)
    windows = F.when(
        F.size(w) >= WINDOW,
        F.transform(
            F.sequence(F.lit(0), F.size(w) - F.lit(WINDOW)),
            lambda i: F.struct(F.concat_ws(" ", *[F.get(w, i + F.lit(k)) for k in range(WINDOW)]).alias("gram"), i.alias("at")),
        ),
    )
    # Equal windows stand next to each other once sorted; a window never spans white space, so joined words compare exactly.
    step = step.withColumn(grams, F.sort_array(F.coalesce(windows, F.array().cast("array<struct<gram:string,at:int>>"))))
    g = F.col(grams)
    reach = lambda x: [x["at"] + F.lit(k) for k in range(WINDOW)]
    twice = F.zip_with(g, F.slice(g, 2, F.greatest(F.size(g), F.lit(1))), lambda x, y: F.when(x["gram"] == y["gram"], F.array(*reach(x), *reach(y))))
    covered = F.array_distinct(F.flatten(F.array_compact(twice)))
    counts = {
        "n_words": F.size(w),
        "word_chars": F.length(F.array_join(w, "")),
        "n_symbols": F.regexp_count(F.col(body), F.lit(SYMBOL)),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": F.size(covered),
        "n_lines": F.size(lines),
        "n_stop_words": F.size(F.filter(w, lambda x: x.isin(stop))),
        "n_letter_words": F.regexp_count(F.col(body), F.lit(LETTER_ON)),
        "n_capital_runs": F.regexp_count(F.col(body), F.lit(CAPITALS)),
    }
    counted = F.struct(*[counts[c].cast("long").alias(c) for c in COUNTS])
    return step.withColumn(into, evaluated_once(counted)).drop(body, words, lines, grams)


def _failed(rule: Rule) -> Column:
    value = F.expr(rule.measure)
    tests = [value < F.lit(rule.low)] if rule.low is not None else []
    tests += [value > F.lit(rule.high)] if rule.high is not None else []
    return F.coalesce(tests[0] if len(tests) == 1 else tests[0] | tests[1], F.lit(False))


def apply_rules(counts: DataFrame, base: tuple[Rule, ...] = BASE_RULES, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Rows of counts with ``base_failed``, ``kept`` and ``failed``, the names
    of all rules that a row fails. A ratio without a value (no words) passes,
    since the base rules have refused such rows."""
    names = lambda group: [F.when(_failed(r), F.lit(r.name)) for r in group]
    failed = F.array_compact(F.array(*names((*base, *rules))))
    any_of = lambda group: F.expr("false") if not group else _any([_failed(r) for r in group])
    return counts.select("*", any_of(base).alias("base_failed"), (~any_of((*base, *rules))).alias("kept"), failed.alias("failed"))


def _any(tests: list[Column]) -> Column:
    out = tests[0]
    for t in tests[1:]:
        out = out | t
    return out


def verdicts(docs: DataFrame) -> DataFrame:
    """Counts and verdict of every document."""
    rows = count_measures(docs.select("doc_id", "text")).select("doc_id", "counts.*")
    return apply_rules(rows).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
