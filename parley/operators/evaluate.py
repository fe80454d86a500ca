"""Quality scoring of enrichment output.

Two scorers stand in for hosted judges, both deterministic columns:

* ``captures_main_topics`` – share of the analysis topics that occur as
  words of the summary; passes at 0.5.
* ``safety`` – 1.0 when the text holds no deny-listed term, else 0.0.

Metrics are per-scorer mean, pass rate and count: a plain aggregation, so
the whole gold table can be scored, not only a sample.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions import text as tfn

# ---- fixed values ----------------------------------------------------------
DENY_TERMS = ("trash", "idiot", "clown", "scum", "worthless", "moron", "pathetic", "loser",
              "stupid", "disgusting", "hate", "kill", "dumb", "garbage", "shut")
COVERAGE_PASS = 0.5
SCORERS = ("captures_main_topics", "safety")
# ----------------------------------------------------------------------------


def eval_records(gold: DataFrame, text_col: str = "transcription_text",
                 output_col: str = "summary", keys=("parent_folder", "filename")) -> DataFrame:
    """``inputs`` = map {transcript: text}, ``outputs`` = the summary."""
    return gold.select(*keys, F.create_map(F.lit("transcript"), F.col(text_col)).alias("inputs"),
                       F.col(output_col).alias("outputs"))


def deny_hits(text: Column, terms=DENY_TERMS) -> Column:
    """Number of deny-listed words in ``text`` (fixed small list, per row)."""
    deny = F.array(*[F.lit(x) for x in sorted(set(terms))])
    return F.size(F.filter(tfn.tokens(F.coalesce(text, F.lit(""))),
                           lambda w: F.array_contains(deny, w)))


def score(gold: DataFrame, keys=("parent_folder", "filename"),
          topics_col: str = "main_topics", output_col: str = "summary",
          unsafe_col: str | None = None) -> DataFrame:
    """Long format: one row per (record, scorer) with ``score`` and ``passed``.

    ``unsafe_col``: a count of unsafe terms (``unsafe.with_unsafe_terms``) to
    take instead of the deny-listed words of the output; null counts as none.
    """
    deny = F.coalesce(F.col(unsafe_col), F.lit(0)) if unsafe_col else deny_hits(F.col(output_col))
    # Topic list and summary words become columns first: lambdas below read
    # them without re-tokenising the summary for every topic.
    staged = gold.select(
        *keys,
        F.filter(F.split(F.coalesce(F.col(topics_col), F.lit("")), ", "),
                 lambda x: x != F.lit("")).alias("_topics"),
        tfn.tokens(F.coalesce(F.col(output_col), F.lit(""))).alias("_words"),
        deny.alias("_deny"))
    found = F.size(F.filter("_topics", lambda x: F.array_contains(F.col("_words"), F.lower(x))))
    staged = staged.withColumns({"_found": found, "_total": F.size("_topics")})
    cov = F.when(F.col("_total") > 0, F.col("_found") / F.col("_total")).otherwise(F.lit(0.0))
    safe = F.when(F.col("_deny") == 0, F.lit(1.0)).otherwise(F.lit(0.0))
    per = staged.select(*keys, cov.alias("_cov"), safe.alias("_safe"))
    long = per.select(*keys, F.inline(F.array(
        F.struct(F.lit(SCORERS[0]).alias("scorer"), F.col("_cov").alias("score")),
        F.struct(F.lit(SCORERS[1]).alias("scorer"), F.col("_safe").alias("score")))))
    threshold = F.when(F.col("scorer") == SCORERS[0], F.lit(COVERAGE_PASS)).otherwise(F.lit(1.0))
    return long.withColumn("passed", F.col("score") >= threshold)


def metrics(scores: DataFrame) -> DataFrame:
    """Per scorer: records, mean score (6 decimals), passed, pass rate."""
    return scores.groupBy("scorer").agg(
        F.count(F.lit(1)).alias("n_records"),
        F.round(F.avg("score"), 6).alias("mean_score"),
        F.count_if(F.col("passed")).alias("n_passed"),
        (F.count_if(F.col("passed")) / F.count(F.lit(1))).alias("pass_rate"))


def hash_sample(df: DataFrame, n: int, keys=("parent_folder", "filename")) -> DataFrame:
    """Reproducible sample of ``n`` rows: smallest md5 of the key.

    A top-k (TakeOrderedAndProject): each task keeps ``n`` candidates, so
    the driver receives at most ``n`` per task.
    """
    h = F.md5(F.concat_ws("/", *[F.col(k) for k in keys]))
    return df.withColumn("_h", h).orderBy("_h").limit(n).drop("_h")
