"""Quality rules: a table of thresholds compiled into one Spark projection.

Every measure is a built-in expression over one row, so the whole operator is a
single scan without shuffle or Python. A word is a run of characters other than
space and U+0009-U+000D.

Defined results: a null text counts as empty; an empty or blank text has no
words and fails the length rule; repeated rows are judged each by itself; an
empty table gives an empty table; other columns, whatever their names, are
neither read nor returned (``quality_filter`` returns them unchanged). A measure that
equals its limit passes. A very long text is measured whole, in memory in proportion
to its words. Equal 8-word windows are found by 64-bit hash within one text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Very common words of the languages in scope.
STOP_WORDS = (
    "the", "of", "and", "to", "a", "in", "is", "that", "it", "for", "was", "on", "with", "as", "be", "by", "are",
    "de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "pour", "est", "dans", "qui",
    "der", "die", "und", "den", "von", "zu", "das", "mit", "sich", "auf", "ist", "im", "dem",
    "el", "y", "los", "se", "las", "del", "por", "con", "no", "una", "para", "su", "al",
)


@dataclass(frozen=True)
class Rule:
    """Reject when ``scale * measure > limit * per`` (``above``) or ``<``."""
    name: str
    measure: str
    scale: int
    limit: int
    per: str
    above: bool = True
    base: bool = False


#: Thresholds as integers, so that no engine rounds differently.
RULES = (
    Rule("too_short", "n_words", 1, 20, "one", above=False, base=True),
    Rule("repeated_windows", "n_repeat_words", 100, 30, "n_words", base=True),
    Rule("short_words", "word_chars", 1, 2, "n_words", above=False),
    Rule("long_words", "word_chars", 1, 12, "n_words"),
    Rule("symbols", "n_symbols", 100, 10, "n_words"),
    Rule("few_stop_words", "n_stop_words", 100, 2, "n_words", above=False),
    Rule("duplicate_lines", "n_dup_lines", 100, 40, "n_lines"),
    Rule("equal_neighbours", "n_same_as_previous", 100, 30, "n_words"),
)
WINDOW = 8
_SPLIT = r"[\x20\x09-\x0D]+"


def _compile(rule: Rule) -> Column:
    left = F.lit(rule.scale) * F.col(f"_m.{rule.measure}")
    right = F.lit(rule.limit) * (F.lit(1) if rule.per == "one" else F.col(f"_m.{rule.per}"))
    return left > right if rule.above else left < right


def _window_hashes(words: Column) -> Column:
    """Hash of each ``WINDOW``-word window; null when there are fewer than two."""
    n = F.size(words)
    hashes = F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)),
                         lambda i: F.xxhash64(F.slice(words, i, WINDOW)))
    return F.when(n > WINDOW, hashes)


def measures(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``_m``, the struct of measures every rule refers to."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select(
        F.col("doc_id"), text.alias("_text"),
        F.filter(F.split(text, _SPLIT), lambda w: w != "").alias("_words"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"),
    )
    base = base.withColumn("_hashes", _window_hashes(F.col("_words")))
    # sorting is needed only where some window occurs twice
    base = base.withColumn("_sorted", F.when(
        F.size(F.array_distinct("_hashes")) < F.size("_hashes"),
        F.array_sort(F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    repeated = F.expr("filter(_sorted, (x, j) -> (j > 0 and _sorted[j - 1].h = x.h) "
                      "or (j < size(_sorted) - 1 and _sorted[j + 1].h = x.h))")
    base = base.withColumn("_at", F.array_sort(F.transform(repeated, lambda x: x["i"])))
    covered = F.expr(f"""aggregate(_at, named_struct('n', 0, 'last', -{WINDOW}),
        (a, i) -> named_struct('n', a.n + least({WINDOW}, i - a.last), 'last', i), a -> a.n)""")
    n = F.size("_words")
    same = F.when(n > 1, F.size(F.filter(
        F.zip_with(F.slice("_words", F.lit(1), n - 1), F.slice("_words", F.lit(2), n - 1),
                   lambda a, b: a == b), lambda x: x)))
    # one-element explode: filters on the verdict stay above it, so no rule makes
    # Catalyst evaluate the measures a second time
    return base.select("doc_id", F.explode(F.array(F.struct(
        n.cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size(F.filter("_words", lambda w: F.lower(w).isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
        F.coalesce(same, F.lit(0)).cast("long").alias("n_same_as_previous"),
    ))).alias("_m"))


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: ``doc_id``, the measures, ``base_failed``, ``failed``
    (comma-joined names of the rules it breaks, in table order) and ``kept``."""
    judged = measures(docs).select(
        "doc_id", "_m", F.concat_ws(",", *[F.when(_compile(r), F.lit(r.name)) for r in rules]).alias("failed"))
    base = F.lit(False)
    for r in rules:
        base = base | _compile(r) if r.base else base
    return judged.select("doc_id", "_m.*", base.alias("base_failed"), "failed", (F.col("failed") == "").alias("kept"))


def quality_filter(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that break no rule, with all their columns."""
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    tagged = docs.select(own).select(F.col("_row").alias("doc_id"), F.col("_row.text").alias("text"))
    return quality_rules(tagged, rules).where("kept").select("doc_id.*")
