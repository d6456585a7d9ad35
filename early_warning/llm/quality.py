"""Quality rules [native]: a threshold table compiled into one projection.

Every metric is a Column over the text; every rule is a row (name, metric, lower, upper) of a table and
a document passes if each metric lies inside its bounds. Nothing but built-in functions runs.

Edge cases: a null text counts as empty (no words, so it fails the length rule); an empty table gives an
empty result; repeated rows each get their own equal result; very long texts cost n log n in their words.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Word separators besides the space itself.
OTHER_SPACES = "\t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
#: Frequent function words of the four languages of the corpus, lower case.
STOP_WORDS = {
    "en": ("the", "of", "and", "to", "that", "with", "is", "for", "be", "in"),
    "de": ("der", "die", "und", "das", "nicht", "mit", "ist", "ein", "eine", "zu"),
    "fr": ("de", "la", "et", "les", "des", "est", "que", "le", "en", "un"),
    "es": ("de", "la", "que", "el", "y", "los", "las", "se", "con", "no"),
}
#: Base rules: at least 50 words; at most half of the words in repeated 3-word windows.
BASE_RULES = (
    ("too few words", "n_words", 50, None),
    ("repeated windows", "repeat_ratio", None, 0.5),
)
#: The method's own rules. Bounds are inclusive; None leaves a side open.
RULES = (
    ("mean word length", "mean_word_length", 2.0, 14.0),
    ("symbols per word", "symbol_ratio", None, 0.1),
    ("stop words", "stop_ratio", 0.02, None),
    ("repeated lines", "dup_line_ratio", None, 0.5),
    ("lines ending in an ellipsis", "ellipsis_line_ratio", None, 0.5),
    ("bullet lines", "bullet_line_ratio", None, 0.9),
)


def _repeat_words() -> Column:
    """Words covered by 3-word windows that occur twice or more, from the sorted (hash, position) pairs ``_s``."""
    twice = F.filter("_s", lambda s, i: (s.h == F.get(F.col("_s"), i - 1).h) | (s.h == F.get(F.col("_s"), i + 1).h))
    starts = F.sort_array(F.transform(twice, lambda s: s.i))
    # A window adds the words that the window before it has not covered yet, three at most.
    return F.aggregate(
        starts, F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("at")),
        lambda acc, p: F.struct((acc.n + F.least(F.lit(3), p - acc.at)).alias("n"), p.alias("at")),
        lambda acc: acc.n)


def measure(docs: DataFrame, text_col: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` plus one column per metric: counts as long, ratios as double."""
    stop = sorted({form for ws in STOP_WORDS.values() for w in ws for form in (w, w.capitalize())})
    bullets = list("-*•‣●")
    n, n_lines = F.col("n_words"), F.size("_lines")
    count = lambda c: c.cast("long")
    spaced = F.coalesce(F.col(text_col), F.lit(""))
    for c in OTHER_SPACES:
        spaced = F.replace(spaced, F.lit(c), F.lit(" "))
    return (
        docs.select(*keep, F.coalesce(F.col(text_col), F.lit("")).alias("_t"),
                    F.array_remove(F.split(spaced, " "), "").alias("_w"))
        .select(*keep, "_t", "_w", count(F.size("_w")).alias("n_words"),
                F.filter(F.split("_t", "\n"), lambda x: x.rlike(WORD)).alias("_lines"),
                # compared inside one text only, so 64 bits are enough
                F.slice(F.transform("_w", lambda w, i: F.xxhash64(w, F.get("_w", i + 1), F.get("_w", i + 2))),
                        1, F.greatest(F.size("_w") - 2, F.lit(0))).alias("_h"))
        .select(*keep, "_t", "_w", "_lines", "n_words",
                F.when(F.size(F.array_distinct("_h")) < F.size("_h"),
                       F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("_s"))
        .select(
            *keep, "n_words",
            count(F.length(F.array_join("_w", ""))).alias("word_chars"),
            count(F.regexp_count("_t", F.lit(SYMBOLS))).alias("n_symbols"),
            count(F.size("_lines") - F.size(F.array_distinct("_lines"))).alias("n_dup_lines"),
            F.coalesce(_repeat_words(), F.lit(0)).cast("long").alias("n_repeat_words"),
            F.size(F.filter("_w", lambda w: w.isin(stop))).alias("_stop"),
            F.size(F.filter("_lines", lambda x: F.rtrim(x).endswith("...") | F.rtrim(x).endswith("…"))).alias("_ellipsis"),
            F.size(F.filter("_lines", lambda x: F.substring(F.ltrim(x), 1, 1).isin(bullets))).alias("_bullet"),
            n_lines.alias("_n_lines"))
        .select(
            *keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            *(F.when(n > 0, F.col(c) / n).otherwise(0.0).alias(a)
              for c, a in (("word_chars", "mean_word_length"), ("n_symbols", "symbol_ratio"), ("_stop", "stop_ratio"),
                           ("n_repeat_words", "repeat_ratio"))),
            *(F.when(F.col("_n_lines") > 0, F.col(c) / F.col("_n_lines")).otherwise(0.0).alias(a)
              for c, a in (("n_dup_lines", "dup_line_ratio"), ("_ellipsis", "ellipsis_line_ratio"),
                           ("_bullet", "bullet_line_ratio"))))
    )


def broken(rules: Sequence[tuple]) -> Column:
    """Names of the rules whose bounds a row's metrics leave: the threshold table as one Column."""
    def fails(metric, low, high):
        sides = [F.col(metric) < low] * (low is not None) + [F.col(metric) > high] * (high is not None)
        return sides[0] if len(sides) == 1 else sides[0] | sides[1]

    return F.filter(F.array(*(F.when(fails(m, lo, hi), F.lit(name)) for name, m, lo, hi in rules)),
                    lambda x: x.isNotNull())


def quality_rules(docs: DataFrame, text_col: str = "text", keep: Sequence[str] = ("doc_id",),
                  base_rules: Sequence[tuple] = BASE_RULES, rules: Sequence[tuple] = RULES) -> DataFrame:
    """Metrics, the names of the broken rules, ``base_failed`` and the verdict ``kept`` per document."""
    return (
        measure(docs, text_col, keep)
        .withColumn("base_failed", F.size(broken(base_rules)) > 0)
        .withColumn("broken_rules", broken(tuple(base_rules) + tuple(rules)))
        .withColumn("kept", F.size("broken_rules") == 0)
    )
