"""Rule-based quality filter as one projection of built-in functions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagewright.llm.common import SPACES, let, words

SYMBOLS = "#*$%&|<>"

# Frequent function words of the four languages.
STOP_WORDS = (
    "the of and to in a is that for it as was with be by on not he are this at from or have an they which one you were "
    "der die und den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei "
    "de la que el en y los se del las un por con no una su para al lo como más pero sus le ya o "
    "et les des est dans qui par pour au une sur pas plus avec ce il ne du sont ou"
).split()


@dataclass(frozen=True)
class Rule:
    """A text fails where 100 * numerator lies outside [low, high] * denominator."""

    name: str
    numerator: str
    denominator: str
    low: int | None = None
    high: int | None = None


#: Counts per 100; "one" is the constant 1.
RULES = (
    Rule("word_length", "word_chars", "n_words", 200, 1200),
    Rule("symbols", "n_symbols", "n_words", None, 10),
    Rule("shouting", "n_marks", "n_words", None, 20),
    Rule("stop_words", "n_stop", "n_words", 6, None),
    Rule("same_lines", "n_dup_lines", "n_lines", None, 60),
    Rule("open_lines", "n_open_lines", "n_lines", None, 80),
)


def base_counts(text: Column) -> dict[str, Column]:
    """Counts over a whole text; a null text has none of anything."""
    text = F.coalesce(text, F.lit(""))
    size = F.char_length(text)
    line = let(
        F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != ""),
        lambda own: F.struct(
            F.size(own).cast("long").alias("n_lines"),
            (F.size(own) - F.size(F.array_distinct(own))).cast("long").alias("n_dup_lines"),
            F.size(F.filter(own, lambda x: ~F.rtrim(x).rlike("[.!?…]$"))).cast("long").alias("n_open_lines"),
        ),
    )
    word = let(
        words(text),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            repeated(w).alias("n_repeat_words"),
            F.size(F.filter(w, lambda x: F.lower(x).isin(STOP_WORDS))).cast("long").alias("n_stop"),
        ),
    )
    return {
        "word": word,
        "line": line,
        "word_chars": F.char_length(F.translate(text, SPACES, "")).cast("long"),
        "n_symbols": (size - F.char_length(F.translate(text, SYMBOLS, ""))).cast("long"),
        "n_marks": (size - F.char_length(F.translate(text, "!", ""))).cast("long"),
    }


def repeated(w: Column) -> Column:
    """How many words lie in a 3-word window that the text holds twice or more.

    Windows are sorted by a 64-bit hash with their place, so equal ones are neighbours; the places of those are
    sorted again, and each adds the words up to the next one, three at most.
    """

    def spread(places: Column) -> Column:
        return F.aggregate(
            places,
            F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last")),
            lambda acc, p: F.struct((acc.n + F.least(F.lit(3), p - acc.last)).cast("long").alias("n"), p.alias("last")),
            lambda acc: acc.n,
        )

    def twins(s: Column) -> Column:
        same = lambda i, j: F.get(s, i).h == F.get(s, j).h
        alike = F.filter(
            F.sequence(F.lit(0), F.size(s) - 1),
            lambda k: F.coalesce(same(k, k - 1), F.lit(False)) | F.coalesce(same(k, k + 1), F.lit(False)),
        )
        return spread(F.sort_array(F.transform(alike, lambda k: F.get(s, k).p)))

    window = F.transform(
        F.sequence(F.lit(0), F.size(w) - 3),
        lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("p")),
    )
    return F.when(F.size(w) < 4, F.lit(0).cast("long")).otherwise(let(F.sort_array(window), twins))


def failing(rule: Rule) -> Column:
    up = 100 * F.col(rule.numerator)
    sides = []
    if rule.low is not None:
        sides.append(up < rule.low * F.col(rule.denominator))
    if rule.high is not None:
        sides.append(up > rule.high * F.col(rule.denominator))
    return sides[0] if len(sides) == 1 else sides[0] | sides[1]


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts, ``base_failed`` and ``kept`` for each row, in one projection without a shuffle.

    Nulls and empty texts have zero counts and fail the base rule. Repeated rows are judged one by one, an empty table
    gives an empty result, and other columns of the input are left out, so none can clash.
    """
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("body"))
    counts = base_counts(F.col("body"))
    flat = own.select("id", *[c.alias(n) for n, c in counts.items()]).select(
        F.col("id").alias("doc_id"),
        F.col("word.n_words").alias("n_words"),
        "word_chars",
        "n_symbols",
        F.col("line.n_dup_lines").alias("n_dup_lines"),
        F.col("word.n_repeat_words").alias("n_repeat_words"),
        F.col("line.n_lines").alias("n_lines"),
        F.col("line.n_open_lines").alias("n_open_lines"),
        F.col("word.n_stop").alias("n_stop"),
        "n_marks",
    )
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    failed = F.array_compact(F.array(*[F.when(failing(r), F.lit(r.name)) for r in rules]))
    return flat.select("*", base.alias("base_failed"), F.concat_ws(",", failed).alias("failed_rules")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.col("failed_rules") == "")).alias("kept"), "failed_rules",
        "n_lines", "n_open_lines", "n_stop", "n_marks",
    )
