"""Quality rules: a table of thresholds compiled into one projection of built-in functions.

``measure`` adds nothing but a projection: no shuffle, no user function.  ``RULES`` holds one row per rule: a ratio of
two measures and its bounds.  A document is kept if the base rules and every row of the table hold.

Defined cases: null, empty and blank texts have no words and fail; texts of any length are read whole; repeated rows
and null ids are judged row by row; further columns, whatever their names, are neither read nor changed.

Windows of words are compared by 64-bit hashes within one text, so two different windows would have to collide inside
the same document to be confused.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import let, words

# The most frequent function words of the languages the rules are meant for.
STOP_WORDS = {
    "de": "der die das und ist von den zu mit sich auf für nicht ein eine als auch es an im dem des in".split(),
    "en": "the be to of and that have with is in for on are was as it this or an at by from not a".split(),
    "es": "el la los las de del y en que un una por con no se su para es al lo como o".split(),
    "fr": "le la les de des du et en un une que qui est dans pour pas sur au aux ne se il par ce".split(),
}
WINDOW = 8


@dataclass(frozen=True)
class Rule:
    """``low <= numerator / denominator <= high``; a zero denominator fails no rule."""

    name: str
    numerator: str
    denominator: str
    low: float | None = None
    high: float | None = None


RULES = (
    Rule("word length", "word_chars", "n_words", low=2.0, high=25.0),
    Rule("symbols per word", "n_symbols", "n_words", high=0.1),
    Rule("stop words per word", "n_stop_words", "n_words", low=0.02),
    Rule("repeated lines", "n_dup_lines", "n_lines", high=0.5),
    Rule("words that echo the word before", "n_echo_words", "n_words", high=0.3),
)


def _repeat_words(tokens: Column) -> Column:
    """Words inside windows that occur twice or more.

    Window hashes are compared first; only a text with a repeated one sorts (hash, position) pairs, takes those with an
    equal neighbour and adds up the words their windows cover.
    """

    def covered(windows: Column) -> Column:
        pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def positions(ordered: Column) -> Column:
            def if_repeated(pair: Column, j: Column) -> Column:
                return F.when(
                    pair.h.eqNullSafe(F.get(ordered, j + 1).h) | pair.h.eqNullSafe(F.get(ordered, j - 1).h), pair.i
                )

            return F.sort_array(F.filter(F.transform(ordered, if_repeated), lambda p: p.isNotNull()))

        start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
        return F.aggregate(
            let(pairs, positions),
            start,
            lambda acc, p: F.struct(
                (acc.n + (p + WINDOW - F.greatest(p, acc.end))).cast("long").alias("n"), (p + WINDOW).alias("end")
            ),
            lambda acc: acc.n,
        )

    def of(hashes: Column) -> Column:
        windows = F.transform(
            F.sequence(F.lit(0), F.size(hashes) - WINDOW), lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)])
        )
        return let(windows, lambda w: F.when(F.size(F.array_distinct(w)) < F.size(w), covered(w)).otherwise(F.lit(0).cast("long")))

    hashes = F.transform(tokens, lambda w: F.xxhash64(w))
    return F.when(F.size(tokens) >= WINDOW, let(hashes, of)).otherwise(F.lit(0).cast("long"))


def _measures(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    length = lambda dropped: F.char_length(F.translate(text, dropped, ""))
    stops = sorted({w for group in STOP_WORDS.values() for w in group})

    def of_lines(lines: Column) -> Column:
        return F.struct(F.size(lines).cast("long").alias("n"), (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("dup"))

    lines = F.filter(F.split(text, "\n"), lambda line: F.translate(line, " \t\x0b\x0c\r", "") != "")

    def of_words(tokens: Column) -> Column:
        by_line = let(lines, of_lines)
        return let(
            by_line,
            lambda l: F.struct(
                F.size(tokens).cast("long").alias("n_words"),
                length(" \t\n\x0b\x0c\r").cast("long").alias("word_chars"),
                (F.char_length(text) - length("#*$%&|<>")).cast("long").alias("n_symbols"),
                F.size(F.filter(tokens, lambda w: F.lower(w).isin(stops))).cast("long").alias("n_stop_words"),
                F.size(F.filter(tokens, lambda w, i: w == F.get(tokens, i - 1))).cast("long").alias("n_echo_words"),
                l.n.alias("n_lines"),
                l.dup.alias("n_dup_lines"),
                _repeat_words(tokens).alias("n_repeat_words"),
            ),
        )

    return let(words(text), of_words)


def compile_rules(rules: tuple[Rule, ...], measure: Column) -> Column:
    """One boolean expression for the whole table."""
    holds = F.lit(True)
    for rule in rules:
        above, below = measure[rule.numerator], measure[rule.denominator]
        if rule.low is not None:
            holds &= (below == 0) | (above >= F.lit(rule.low) * below)
        if rule.high is not None:
            holds &= (below == 0) | (above <= F.lit(rule.high) * below)
    return holds


def measure(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """All columns of ``df`` and a struct column ``quality!`` with measures and verdicts."""

    def judge(m: Column) -> Column:
        base = (m.n_words < 20) | (100 * m.n_repeat_words > 30 * m.n_words)
        return m.withField("base_failed", base).withField("kept", ~base & compile_rules(rules, m))

    # One expression that names the measures once: pushed into a filter, it is still computed once.
    return df.withColumn("quality!", let(_measures(F.col(text)), judge))


def keep(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``df`` that the rules keep, columns unchanged."""
    return measure(df, text, rules).filter(F.col("`quality!`.kept")).drop("quality!")
