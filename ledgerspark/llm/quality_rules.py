"""Quality rules: a threshold table compiled into one projection of built-in functions.

``measures`` adds counts of words, symbols, stop words and lines to each row with Spark
SQL functions alone; ``verdict`` compiles a table of (measure, least, most) into one
boolean column. There is no join, no exchange and no user function, so any number of rows
is judged in one pass over the scan.

Defined cases: a null text has no words and fails; empty texts likewise; a ratio with an
empty denominator is zero; very long texts are measured whole; repeated rows give repeated
results; an empty table gives no rows; other columns are not read. Windows of three words are
compared by 64-bit hashes within one text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm._common import named

# Frequent function words of the four languages.
STOP_WORDS = (
    "a an and are as at be by for from had has have he in is it its not of on or that the this to was were which with you "
    "au auf aus bei das dem den der des die ein eine einer es für im in ist mit nicht sich sie und von war zu zum zur "
    "au aux avec ce dans de des du elle en est et il la le les ne ou par pas pour qu que qui se sur un une "
    "al como con de del el en es la las lo los más no para pero por que se su sus un una y"
)
GAP = "[ \\x09-\\x0D]+"
SYMBOLS = "[#*$%&|<>]"


@dataclass(frozen=True)
class Rule:
    """A measure must lie between ``least`` and ``most`` (None: open)."""

    measure: str
    least: float | None = None
    most: float | None = None


#: The default table. Ratios are per word, per character of a word, or per line.
RULES = (
    Rule("mean_word_chars", 1.5, 20.0),
    Rule("symbol_ratio", None, 0.05),
    Rule("mark_ratio", None, 0.35),
    Rule("stop_ratio", 0.02, None),
    Rule("dup_line_ratio", None, 0.5),
)


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_stop, n_marks) for every row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    cut = docs.select(F.col(id_col), text.alias("body"), F.array_remove(F.split(text, GAP), "").alias("words"))
    stop = sorted(set(STOP_WORDS.split()))
    lines = F.filter(F.split(F.col("body"), "\n"), lambda x: x.rlike("[^ \\x09-\\x0D]"))
    n = F.size("words")
    windows = F.when(
        n >= 3,
        F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2))),
    )
    counted = cut.select(
        id_col,
        n.cast("long").alias("n_words"),
        F.length(F.regexp_replace("body", GAP, "")).cast("long").alias("word_chars"),
        F.regexp_count("body", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.regexp_count("body", F.lit("[!?]")).cast("long").alias("n_marks"),
        lines.alias("lines"),
        F.size(F.filter("words", lambda w: F.lower(w).isin(stop))).cast("long").alias("n_stop"),
        windows.alias("windows"),
    )
    # Only texts in which some window comes twice pay for the sort that finds all of them.
    placed = counted.withColumn(
        "placed",
        F.when(
            F.size("windows") > F.size(F.array_distinct("windows")),
            F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    twice = F.filter(
        "placed",
        lambda x, i: F.coalesce(F.get("placed", i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get("placed", i + 1)["h"] == x["h"], F.lit(False)),
    )
    starts = placed.withColumn("starts", F.sort_array(F.transform(twice, lambda x: x["i"])))
    covered = F.aggregate(
        "starts",
        F.struct(F.lit(-3).alias("at"), F.lit(0).alias("total")),
        lambda acc, p: F.struct(p.alias("at"), (acc["total"] + F.least(F.lit(3), p - acc["at"])).alias("total")),
        lambda acc: acc["total"],
    )
    return starts.select(
        id_col,
        "n_words",
        "word_chars",
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        "n_stop",
        "n_marks",
    )


def _ratio(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))


def base_failed() -> Column:
    """Too short, or over half of the words in repeated windows of three words."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def verdict(rules: tuple[Rule, ...] = RULES) -> Column:
    """One boolean: every rule of the table holds."""
    known = {
        "mean_word_chars": _ratio("word_chars", "n_words"),
        "symbol_ratio": _ratio("n_symbols", "word_chars"),
        "mark_ratio": _ratio("n_marks", "n_words"),
        "stop_ratio": _ratio("n_stop", "n_words"),
        "dup_line_ratio": _ratio("n_dup_lines", "n_lines"),
        "repeat_ratio": _ratio("n_repeat_words", "n_words"),
        "n_words": F.col("n_words").cast("double"),
    }
    holds = F.lit(True)
    for rule in rules:
        if rule.least is not None:
            holds = holds & (known[rule.measure] >= rule.least)
        if rule.most is not None:
            holds = holds & (known[rule.measure] <= rule.most)
    return holds


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Measures of every row with ``base_failed`` and ``kept``."""
    judged = measures(docs, id_col, text_col).withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & verdict(rules))
    # A filter on a result would be pushed below the measures, with all their expressions copied into it; a generator stops it.
    return judged.select(F.inline(F.array(F.struct(*judged.columns))))


def kept_rows(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns. The whole row rides along as the id: no join."""
    row = docs.select(F.struct(*map(named, docs.columns)).alias("row"), F.col(text_col).alias("text"))
    return judge(row, "row", "text", rules).filter("kept").select("row.*")
