"""The registered queries over the standard tables and their DuckDB equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.llm import chat_format, chat_repair, decontaminate, fingerprint, importance, lm_scoring, packing, quality_rules, secret_scan, simhash_dedup, token_rollup, toxicity, url_filter
from ledgerspark.llm._common import cut, fresh_path

#: Rules of the registered URL query.
URL_RULES = [
    url_filter.Rule("com/en/", "block"),
    url_filter.Rule("example.com/en/7", "allow"),
    url_filter.Rule("net/de/", "allow"),
    url_filter.Rule("example.net/de/8", "block"),
    url_filter.Rule("org/es/", "block"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after four batches: estimates inserted, revised to counts, copies deleted, and word counts added.

    The first two batches come twice, as after a retry; the second time changes nothing, nor does the compaction between.
    """
    counts = cut(token_rollup.count_tokens(table(spark, sf_dir, "documents")))
    rollup = token_rollup.Rollup(spark, fresh_path(spark, "token-rollup"))
    tokens, words, version = F.col("tokens"), F.col("words"), "byte_bpe_50k"
    batches = {
        "insert": token_rollup.events(counts, version, None, 2 * words),
        "revise": token_rollup.events(counts, version, 2 * words, tokens),
        "delete": token_rollup.events(token_rollup.surplus(counts), version, tokens, None, F.col("rows")),
        "words": token_rollup.events(counts, "words", None, words),
    }
    for name in ("insert", "revise", "insert", "revise"):
        rollup.apply(name, batches[name])
    rollup.compact()
    for name in ("delete", "words", "delete"):
        rollup.apply(name, batches[name])
    return rollup.totals()


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables label no URLs, so the names of sites do; the trees learn from four fifths of the URLs."""
    pages = table(spark, sf_dir, "pages")
    trains = pages.filter(~url_filter.held_out(F.col("url")))
    return url_filter.judge(pages, url_filter.fit(url_filter.labelled_by_name(trains)), URL_RULES)


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.cross_entropy_difference(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roles recovered from texts alone; the model learns from four fifths of the conversations."""
    talks = table(spark, sf_dir, "conversations")
    held_out = F.coalesce(F.crc32(F.col("conv_id").cast("string")) % 5 == 0, F.lit(False))
    model = chat_format.fit(talks, trains=~held_out)
    return chat_format.format_chats(talks, model).withColumn("held_out", held_out)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.chained(table(spark, sf_dir, "documents"))


def op12_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_repair.audit(table(spark, sf_dir, "conversations"), damaged=True)


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_secret_scan": op1_secret_scan,
        "op2_token_counts": op2_token_counts,
        "op3_toxicity": op3_toxicity,
        "op4_url_filter": op4_url_filter,
        "op5_lm_scoring": op5_lm_scoring,
        "op6_simhash_dedup": op6_simhash_dedup,
        "op7_chat_format": op7_chat_format,
        "op8_packing": op8_packing,
        "op9_quality_rules": op9_quality_rules,
        "op10_decontaminate": op10_decontaminate,
        "op11_fingerprints": op11_fingerprints,
        "op12_chat_repair": op12_chat_repair,
        "op13_importance_resampling": op13_importance_resampling,
    }


_STOP = ", ".join("'" + w + "'" for w in sorted(set(quality_rules.STOP_WORDS.split())))

OP9_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS body,
    list_filter(string_split_regex(coalesce(text, ''), '[ \\x09-\\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \\x09-\\x0D]')) AS l
  FROM documents),
m AS (
  SELECT r, doc_id, len(w) AS n_words, len(l) AS n_lines,
    length(regexp_replace(body, '[ \\x09-\\x0D]+', '', 'g')) AS word_chars,
    length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    length(body) - length(regexp_replace(body, '[!?]', '', 'g')) AS n_marks,
    len(l) - len(list_distinct(l)) AS n_dup_lines,
    len(list_filter(w, lambda x: lower(x) IN ({_STOP}))) AS n_stop
  FROM d),
g AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS gram FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
t AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS c FROM g) WHERE c > 1),
q AS (SELECT r, count(DISTINCT i + k) AS n FROM t, (VALUES (0), (1), (2)) v(k) GROUP BY r),
a AS (
  SELECT m.*, coalesce(q.n, 0) AS n_repeat_words FROM m LEFT JOIN q USING (r)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM a)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT base_failed AND word_chars >= 1.5 * n_words AND word_chars <= 20 * n_words AND n_symbols <= 0.05 * word_chars
    AND n_marks <= 0.35 * n_words AND n_stop >= 0.02 * n_words AND n_dup_lines <= 0.5 * n_lines AS kept
FROM b
"""


def oracle_sql() -> dict[str, str]:
    return {"op9_quality_rules": OP9_SQL}
