"""Quality rules: a threshold table compiled into one projection, without user functions.

Each row of the table bounds one measure of a document. `measures` computes the
counts with built-in functions, `verdict` turns a table into one boolean
expression and one array of the names of broken rules; Catalyst sees plain
expressions, so nothing is shuffled.

Defined results: a null text has no words and all counts are 0; ratios of an
empty text are null and break no rule (the word bound does); repeated rows are
judged alike; an empty table gives an empty result; other columns of the input
pass through `measures` and `judge` unless these make one of that name, which then
replaces it; `keep_good` returns the input's columns untouched.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import WORD, count_of, text_of, words

WINDOW = 8
SYMBOLS = "[#*$%&|<>]"

# --- Fixed values: frequent function words of the four languages ---------------
STOP_WORDS = (
    "the of and to in a is that for it as was with be by on not he his but at are this have from or had an they which "
    "le la les de des du et un une est que qui dans pour pas par sur au aux ce il elle ne se plus avec sont "
    "der die das und ist von den mit zu im ein eine auf für nicht des dem sich als auch es an werden aus er hat "
    "el los las del que y en un una es por con no para su al lo como más o pero sus"
).split()
# --------------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """A document breaks the rule if its measure lies outside [low, high]."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


#: Checked before the table; part of the definition of `base_failed`.
BASE_RULES = (
    Rule("too_few_words", "n_words", low=20),
    Rule("repeated_windows", "repeat_pct", high=30),
)

RULES = (
    Rule("word_length", "mean_word_chars", low=2, high=12),
    Rule("symbols", "symbols_per_word", high=0.1),
    Rule("shouting", "bangs_per_word", high=0.25),
    Rule("capitals", "capital_ratio", high=0.4),
    Rule("stop_words", "stop_word_ratio", low=0.04),
    Rule("repeated_lines", "dup_line_ratio", high=0.4),
    Rule("bullets", "bullet_line_ratio", high=0.9),
    Rule("ellipses", "ellipsis_line_ratio", high=0.3),
)


def _with_windows(frame: DataFrame) -> DataFrame:
    """Adds `_windows`: a 64-bit hash of each run of eight words, by doubling runs of two and of four.

    One column a step: inside one expression each step would compute the one before twice.
    """
    frame, width = frame.withColumn("_windows", F.col("_words")), 1
    while width < WINDOW:
        rest = F.greatest(F.size("_windows") - width, F.lit(0))
        pairs = F.zip_with(
            F.slice("_windows", 1, rest), F.slice("_windows", width + 1, rest), lambda a, b: F.xxhash64(a, b)
        )
        frame, width = frame.withColumn("_windows", pairs), 2 * width
    return frame


def _covered(windows: Column) -> Column:
    size = F.size(windows)
    placed = F.sort_array(F.transform(windows, lambda value, at: F.struct(value.alias("h"), at.alias("at"))))
    pairs = F.zip_with(
        F.slice(placed, 1, size - 1),
        F.slice(placed, F.lit(2), size - 1),
        lambda a, b: F.when(a["h"] == b["h"], F.array(a["at"], b["at"])).otherwise(F.array().cast("array<int>")),
    )
    starts = F.sort_array(F.array_distinct(F.flatten(pairs)))
    zero = F.struct(F.lit(0).alias("total"), F.lit(0).alias("end"))
    walked = F.aggregate(
        starts,
        zero,
        lambda acc, at: F.struct(
            (acc["total"] + at + WINDOW - F.greatest(acc["end"], at)).alias("total"), (at + WINDOW).alias("end")
        ),
    )
    return F.when(F.size(F.array_distinct(windows)) < size, walked["total"]).otherwise(0)


def measures(docs: DataFrame, stop_words: tuple[str, ...] | list[str] = STOP_WORDS) -> DataFrame:
    """The documents with their counts and ratios.

    Windows and lines are compared within a document only. Windows are compared
    by a 64-bit hash.
    """
    text = text_of(docs)
    lines = F.split(text, "\n")
    frame = (
        docs.withColumn("_words", words(text))
        .withColumn("_lines", F.filter(lines, lambda line: line.rlike(WORD)))
        .withColumn("n_words", F.size("_words").cast("bigint"))
    )
    frame = _with_windows(frame)
    n_lines = F.size("_lines")

    def per(value: Column, total: Column) -> Column:
        return F.when(total > 0, value / total)

    frame = frame.withColumns(
        {
            "word_chars": F.char_length(F.array_join("_words", "")).cast("bigint"),
            "n_symbols": count_of(text, SYMBOLS).cast("bigint"),
            "n_dup_lines": (n_lines - F.size(F.array_distinct("_lines"))).cast("bigint"),
            "n_repeat_words": _covered(F.col("_windows")).cast("bigint"),
            "n_stop_words": F.size(F.filter("_words", lambda w: F.lower(w).isin(*stop_words))).cast("bigint"),
            "_bangs": count_of(text, "!"),
            "_capitals": count_of(text, "[A-Z]"),
            "_bullets": F.size(F.filter("_lines", lambda line: F.ltrim(line).rlike(r"^[-*•‣▪]"))),
            "_ellipses": F.size(F.filter("_lines", lambda line: F.rtrim(line).rlike(r"(\.\.\.|…)$"))),
        }
    )
    n = F.col("n_words")
    return frame.withColumns(
        {
            "mean_word_chars": per(F.col("word_chars"), n),
            "symbols_per_word": per(F.col("n_symbols"), n),
            "bangs_per_word": per(F.col("_bangs"), n),
            "capital_ratio": per(F.col("_capitals"), F.col("word_chars")),
            "stop_word_ratio": per(F.col("n_stop_words"), n),
            "repeat_pct": per(100 * F.col("n_repeat_words"), n),
            "dup_line_ratio": per(F.col("n_dup_lines"), n_lines),
            "bullet_line_ratio": per(F.col("_bullets"), n_lines),
            "ellipsis_line_ratio": per(F.col("_ellipses"), n_lines),
        }
    ).drop("_words", "_lines", "_windows", "_bangs", "_capitals", "_bullets", "_ellipses")


def _breaks(rule: Rule) -> Column:
    value, broken = F.col(rule.measure), F.lit(False)
    if rule.low is not None:
        broken = broken | (value < rule.low)
    if rule.high is not None:
        broken = broken | (value > rule.high)
    return F.coalesce(broken, F.lit(False))


def broken_rules(rules: tuple[Rule, ...] = RULES) -> Column:
    """Names of the rules a measured document breaks, in table order."""
    named = [F.when(_breaks(rule), F.lit(rule.name)) for rule in rules]
    return F.array_compact(F.array(*named)) if named else F.array().cast("array<string>")


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, base: tuple[Rule, ...] = BASE_RULES) -> DataFrame:
    """Measured documents with `base_failed`, `broken` (names) and `kept`."""
    return (
        measures(docs)
        .withColumn("base_failed", F.size(broken_rules(base)) > 0)
        .withColumn("broken", broken_rules(rules))
        .withColumn("kept", ~F.col("base_failed") & (F.size("broken") == 0))
    )


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES, base: tuple[Rule, ...] = BASE_RULES) -> DataFrame:
    """The documents that break no rule, with their own columns only."""
    rows = docs.select("text", F.struct(*docs.columns).alias("_row"))
    # The filter must not be pushed below the measures, where each would be computed again for
    # every use in the condition; a filter stays above a projection that numbers its rows.
    judged = judge(rows, rules, base).select("_row", "kept", F.monotonically_increasing_id().alias("_at"))
    return judged.where("kept and _at >= 0").select("_row.*")
