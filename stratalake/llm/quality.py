"""Quality rules whose thresholds follow the data of each language and source.

Per text the rules look at four rates: characters per word, symbols per word, repeated lines per
line, and words in repeated three-word windows per word. A fixed cutoff for them rejects whole
sources that write in another way. Here every (language, source) has its own cutoffs, taken from a
quantile sketch per rate. Sketches are merged upwards, from sources to languages to everything, so
that one pass over the measures serves all levels. A group's quartiles are drawn to those of the
level above by as much as its texts are few: they weigh as many as there are, the level above weighs
``PRIOR`` texts. The cutoffs are joined back to the texts, and a text is kept if it passes the two
absolute rules and every cutoff.

A sketch counts texts in bins whose bounds grow by a fixed factor. Sketches are merged by adding
counts, so neither the order of merging nor the number of tasks changes a cutoff, and a quantile is
the middle of the bin that has it: it is off by no more than ``ERROR`` of its size.

A cutoff lies ``SPREAD`` times the group's interquartile range above its third quartile (or below
its first), and never nearer to the median than the rule's ``least_spread``, so that a rate which hardly
varies in a group does not reject its ordinary texts.

Defined results: a null or empty text has no words and fails the absolute rule; null languages and
sources form groups of their own; repeated rows count each; an empty table gives an empty result.
Columns of the input that share a name with a result are replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from stratalake.llm.common import column_udf, with_fields, written

# Fixed values of the absolute rules.
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50

SPREAD = 4.0
# Texts that the level above counts as, beside those of a group.
PRIOR = 20.0
# Relative error of a sketch's quantiles, and the growth of its bins that gives it.
ERROR = 0.01
GROWTH = (1 + ERROR) / (1 - ERROR)
# The bin of rates that are zero; those of other rates are above.
ZERO_BIN = -(1 << 30)

MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
FIELDS = ", ".join(f"{m} long" for m in MEASURES)

_SPACE = b" \t\n\x0b\x0c\r"
_NO_SYMBOL = bytes(set(range(256)) - set(b"#*$%&|<>"))
_NOT_LEADING = bytes(range(0x80, 0xC0))


@dataclass(frozen=True)
class Rule:
    """A rate, as a share of two measures, with the side on which it is bad."""

    name: str
    part: str
    whole: str
    least_spread: float
    both_sides: bool = False


RULES = (
    Rule("chars_per_word", "word_chars", "n_words", 2.0, both_sides=True),
    Rule("symbols_per_word", "n_symbols", "n_words", 0.1),
    Rule("repeated_lines", "n_dup_lines", "n_lines", 0.5),
    Rule("repeated_words", "n_repeat_words", "n_words", 0.35),
)


def measure_text(text: str | None) -> tuple[int, ...]:
    """The measures of one text, in the order of ``MEASURES``."""
    raw = (text or "").encode()
    words = raw.split()  # on the six ASCII spaces
    n = len(words)
    if not n:
        return (0,) * len(MEASURES)
    # Characters are the bytes that do not continue a character.
    chars = len(raw.translate(None, _SPACE + _NOT_LEADING))
    lines = [line for line in raw.split(b"\n") if line and not line.isspace()]
    repeated = 0
    if n > 3:
        windows = list(zip(words, words[1:], words[2:]))
        if len(set(windows)) < len(windows):
            repeated = _words_in_repeats(windows)
    symbols = len(raw.translate(None, _NO_SYMBOL))
    return n, chars, symbols, len(lines), len(lines) - len(set(lines)), repeated


def _words_in_repeats(windows: list[tuple]) -> int:
    """Words covered by windows that occur more than once."""
    often, once = set(), set()
    for w in windows:
        (often if w in once else once).add(w)
    covered, end = 0, -1
    for i, w in enumerate(windows):
        if w in often:
            covered += i + 2 - max(end, i - 1)
            end = i + 2
    return covered


def _measure(texts: list) -> list:
    rows = [measure_text(t) for t in texts]
    return [list(c) for c in zip(*rows)] if rows else [[] for _ in MEASURES]


def with_measures(docs: DataFrame, text_column: str = "text") -> DataFrame:
    measure = column_udf(docs.sparkSession, _measure, FIELDS, [pa.int64()] * len(MEASURES))
    return with_fields(docs, measure(F.col(text_column).cast("string")), MEASURES)


def rate(rule: Rule) -> Column:
    return F.when(F.col(rule.whole) > 0, F.col(rule.part) / F.col(rule.whole))


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )


def bin_of(value: Column) -> Column:
    """The number of a rate's bin."""
    return F.when(value > 0, F.ceil(F.log(value) / math.log(GROWTH)).cast("int")).otherwise(F.lit(ZERO_BIN))


def middle_of(number: Column) -> Column:
    """The rate that is off by the same part from both bounds of a bin."""
    middle = F.pow(F.lit(GROWTH), number.cast("double")) * F.lit(2 / (1 + GROWTH))
    return F.when(number == ZERO_BIN, F.lit(0.0)).otherwise(middle)


def sketches(measured: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """(keys, rule, bin, n): texts that pass the absolute rules, counted per rate and bin."""
    rates = F.array(*[F.struct(F.lit(r.name).alias("rule"), bin_of(rate(r)).alias("bin")) for r in RULES])
    usable = measured.filter(~base_failed())
    return usable.select(*keys, F.inline(rates)).groupBy(*keys, "rule", "bin").agg(F.count(F.lit(1)).alias("n"))


def quartiles(sketch: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """(keys, rule, n, q1, q2, q3) of each group; the windows hold the bins of one sketch."""
    group = Window.partitionBy(*keys, "rule")
    up_to = F.sum("n").over(group.orderBy("bin"))
    counted = sketch.withColumns({"up_to": up_to, "all": F.sum("n").over(group)})
    found = [
        middle_of(F.min(F.when(F.col("up_to") >= F.lit(q) * F.col("all"), F.col("bin")))).alias(f"q{k}")
        for k, q in enumerate((0.25, 0.5, 0.75), 1)
    ]
    return counted.groupBy(*keys, "rule").agg(F.sum("n").alias("n"), *found)


def thresholds(measured: DataFrame, keys: tuple[str, ...], prior: float = PRIOR) -> DataFrame:
    """One row per group of ``keys`` that has texts which pass the absolute rules: the lower and upper
    cutoff of each rate.

    Each level's sketches are sums of those below: (language, source), language, everything.
    """
    sketch = written(sketches(measured, keys), "sketches")
    drawn = None
    for depth in range(len(keys) + 1):
        own = quartiles(sketch.groupBy(*keys[:depth], "rule", "bin").agg(F.sum("n").alias("n")), keys[:depth])
        if drawn is not None:
            above = drawn.select(
                *[F.col(k).alias(f"__k_{k}") for k in keys[: depth - 1]], F.col("rule").alias("__rule"),
                *[F.col(f"q{k}").alias(f"p{k}") for k in (1, 2, 3)],
            )
            match = F.col("rule") == F.col("__rule")
            for k in keys[: depth - 1]:
                match = match & F.col(k).eqNullSafe(F.col(f"__k_{k}"))
            own = own.join(above, match).select(
                *keys[:depth], "rule", "n",
                *[
                    ((F.col("n") * F.col(f"q{k}") + F.lit(prior) * F.col(f"p{k}")) / (F.col("n") + F.lit(prior))).alias(f"q{k}")
                    for k in (1, 2, 3)
                ],
            )
        drawn = own
    of_rule = {r.name: F.max(F.when(F.col("rule") == r.name, F.struct("q1", "q2", "q3"))) for r in RULES}
    per_group = drawn.groupBy(*keys).agg(*[q.alias(name) for name, q in of_rule.items()])
    return per_group.select(*keys, F.struct(*[b for r in RULES for b in _bounds(r)]).alias("__cutoffs"))


def _bounds(rule: Rule) -> list[Column]:
    first, middle, third = (F.col(rule.name)[q] for q in ("q1", "q2", "q3"))
    margin = F.lit(SPREAD) * (third - first)
    low = F.least(first - margin, middle - rule.least_spread)
    high = F.greatest(third + margin, middle + rule.least_spread)
    nothing = F.lit(None).cast("double")
    return [
        (low if rule.both_sides else nothing).alias(f"low_{rule.name}"),
        high.alias(f"high_{rule.name}"),
    ]


def quality_verdicts(
    docs: DataFrame,
    text_column: str = "text",
    keys: tuple[str, ...] = ("lang", "source"),
    prior: float = PRIOR,
) -> DataFrame:
    """The rows without their texts, with their measures, ``base_failed`` and ``kept``."""
    slim = with_measures(docs, text_column).drop(text_column)
    # Measuring reads every text; the thresholds and the verdicts both need the result.
    measured = written(slim, "measures")
    cutoffs = thresholds(measured, keys, prior).select(
        *[F.col(k).alias(f"__t_{k}") for k in keys], "__cutoffs"
    )
    match = F.lit(True)
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"__t_{k}"))
    good = F.lit(True)
    for r in RULES:
        low, high = F.col(f"__cutoffs.low_{r.name}"), F.col(f"__cutoffs.high_{r.name}")
        good = good & F.coalesce(rate(r) <= high, F.lit(True)) & F.coalesce(rate(r) >= low, F.lit(True))
    return (
        measured.join(cutoffs, match, "left")
        .withColumns({"base_failed": base_failed(), "kept": ~base_failed() & good})
        .drop("__cutoffs", *[f"__t_{k}" for k in keys])
    )
