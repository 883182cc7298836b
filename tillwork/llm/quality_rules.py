"""Quality rules: a threshold table compiled into one projection.

``RULES`` names measures and the range in which a document passes. ``apply_rules`` turns the
table into columns of a single ``select``: words are split once, every measure and every verdict
is an expression of built-in functions, nothing is shuffled and no user function runs.

Edge cases: a null or empty text has no words, all counts 0, and fails the base rule. Repeated
rows are judged one by one. Nulls in other columns, extra columns and clashing names do not
matter to ``measured`` (it reads ``doc_id`` and ``text``) nor to ``filter_documents`` (its
own columns are private). Texts of any length are read whole. An empty table gives an empty
result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = "[#*$%&|<>]"

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in is that with are it for or be by on as this from at was "
    "der die das und den von zu mit dem nicht ein eine für im auf als auch sich des "
    "le la les et des du un une en que qui dans pour par sur est pas au "
    "el los las y del se por con una su al lo como más para no de"
).split()


@dataclass(frozen=True)
class Rule:
    """A document passes while ``low <= measure <= high``; None leaves that side open."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


# Ratios are shares of words unless the name says otherwise.
RULES = (
    Rule("word_length", "mean_word_chars", 3.0, 10.0),
    Rule("symbols", "symbol_ratio", None, 0.1),
    Rule("stop_words", "stop_word_ratio", 0.06, None),
    Rule("duplicate_lines", "dup_line_ratio", None, 0.3),
    Rule("repeated_words", "repeat_ratio", None, 0.5),
)


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part.cast("double") / whole).otherwise(F.lit(0.0))


def _repeat_words(grams: Column) -> Column:
    """Words inside 3-word windows whose hash occurs twice or more in the same text.

    Window hashes are sorted with their positions, so that equal windows become neighbours; a
    text without equal windows skips the sort. Hashes have 64 bits: two unequal windows of one
    text meet with a chance below 1e-9 even for a text of 100,000 words.
    """
    ranked = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))

    def covered(rows: Column) -> Column:
        same = F.filter(
            rows,
            lambda r, k: ((k > 0) & (F.get(rows, k - 1)["g"] == r["g"]))
            | F.coalesce(F.get(rows, k + 1)["g"] == r["g"], F.lit(False)),
        )
        spots = F.flatten(F.transform(same, lambda r: F.array(r["i"], r["i"] + 1, r["i"] + 2)))
        return F.size(F.array_distinct(spots))

    # The one-element transform binds the sorted array once for the lambda above.
    bound = F.get(F.transform(F.array(ranked), covered), F.lit(0))
    return F.when(F.size(F.array_distinct(grams)) < F.size(grams), bound).otherwise(0)


def measured(docs: DataFrame, rules: tuple[Rule, ...] = RULES, min_words: int = 50) -> DataFrame:
    """One row per input row: ``doc_id``, the counts, every ratio of the table and the verdicts.

    ``base_failed``: fewer than ``min_words`` words, or more than half of the words in repeated
    3-word windows. ``kept``: the base passes and so does every rule; ``failed`` names the rules
    that do not.
    """
    text = F.coalesce("text", F.lit(""))
    split = docs.select(
        "doc_id",
        text.alias("t"),
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("w"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD)).alias("lines"),
    )
    w = F.col("w")
    grams = F.when(
        F.size("w") >= 3,
        F.transform(
            F.sequence(F.lit(0), F.greatest(F.size("w") - 3, F.lit(0))),
            lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    counts = F.struct(
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("grams")).cast("long").alias("n_repeat_words"),
        F.size(F.filter("w", lambda x: x.isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
    )
    # A generator of one row: filters on the verdicts stay above it, where they would otherwise
    # be pushed down with copies of every expression they refer to.
    counted = split.select("doc_id", "t", "w", "lines", grams.alias("grams")).select(
        "doc_id", F.inline_outer(F.array(counts))
    )
    n = F.col("n_words")
    ratios = {
        "mean_word_chars": _ratio(F.col("word_chars"), n),
        "symbol_ratio": _ratio(F.col("n_symbols"), n),
        "stop_word_ratio": _ratio(F.col("n_stop_words"), n),
        "dup_line_ratio": _ratio(F.col("n_dup_lines"), F.col("n_lines")),
        "repeat_ratio": _ratio(F.col("n_repeat_words"), n),
    }
    verdicts = {r.name: _within(ratios[r.measure], r) for r in rules}
    base = (n < min_words) | (100 * F.col("n_repeat_words") > 50 * n)
    passed = F.lit(True)
    for verdict in verdicts.values():
        passed = passed & verdict
    failed = F.filter(
        F.array(*(F.when(~v, F.lit(k)) for k, v in verdicts.items())), lambda x: x.isNotNull()
    )
    return counted.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "n_lines",
        "n_stop_words",
        base.alias("base_failed"),
        (~base & passed).alias("kept"),
        F.array_join(failed, ",").alias("failed"),
    )


def _within(measure: Column, rule: Rule) -> Column:
    low = measure >= rule.low if rule.low is not None else F.lit(True)
    return low & (measure <= rule.high) if rule.high is not None else low


def filter_documents(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, min_words: int = 50
) -> DataFrame:
    """The rows of ``docs`` that every rule keeps, with their columns; one pass, no join.

    The row travels through the projection as one struct, so no column name can clash.
    """
    whole = docs.select(
        F.struct(*(docs[c] for c in docs.columns)).alias("doc_id"), docs["text"].alias("text")
    )
    return measured(whole, rules, min_words).where("kept").select("doc_id.*")
