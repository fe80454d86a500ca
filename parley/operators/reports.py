"""Run reports: counts, error taxonomy, distributions, inventories, audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley import config
from parley.functions import text as tfn


def run_summary(results: DataFrame, error_col: str = "error_message") -> DataFrame:
    """Total / success / failed in one pass."""
    return results.agg(F.count(F.lit(1)).alias("total"),
                       F.count_if(F.col(error_col).isNull()).alias("success"),
                       F.count_if(F.col(error_col).isNotNull()).alias("failed"))


def error_type(error: Column) -> Column:
    """First matching category wins, else OTHER."""
    expr = None
    for cat in config.ERROR_CATEGORIES:
        cond = error.contains(cat)
        expr = F.when(cond, F.lit(cat)) if expr is None else expr.when(cond, F.lit(cat))
    return expr.otherwise(F.lit("OTHER"))


def error_taxonomy(results: DataFrame, error_col: str = "error_full") -> DataFrame:
    """Failed rows counted per error type, most frequent first.

    Reads the uncut errors where the results hold them: a cut message can
    lose the category that counts.
    """
    if error_col not in results.columns:
        error_col = "error_message"
    return (results.filter(F.col(error_col).isNotNull())
                   .groupBy(error_type(F.col(error_col)).alias("error_type"))
                   .agg(F.count(F.lit(1)).alias("count"))
                   .orderBy(F.desc("count"), "error_type"))


def distribution(df: DataFrame, col: str) -> DataFrame:
    """``SELECT col, COUNT(*) AS count ... GROUP BY col ORDER BY count DESC``."""
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
              .orderBy(F.desc("count"), F.col(col).asc_nulls_first()))


def inventory(files: DataFrame, path_col: str = "full_path", size_col: str = "length",
              suffixes=(".wav",)) -> DataFrame:
    """Count and total size (MiB) of files with a matching suffix."""
    cond = None
    for s in suffixes:
        c = F.col(path_col).endswith(F.lit(s))
        cond = c if cond is None else cond | c
    sel = files.filter(cond)
    return sel.agg(F.count(F.lit(1)).alias("files"),
                   F.sum(size_col).alias("total_bytes"),
                   tfn.format_mib(F.coalesce(F.sum(size_col), F.lit(0)), 1).alias("total_mb"))


def latest(df: DataFrame, n: int, ts_col: str, keys=("parent_folder", "filename"),
           cols=None) -> DataFrame:
    """Top ``n`` by timestamp, ties broken by key (a top-k, not a scan)."""
    out = df.orderBy(F.desc(ts_col), *keys).limit(n)
    return out.select(*cols) if cols else out


def bounded_batch(df: DataFrame, n: int, order_col: str = "full_path") -> DataFrame:
    """At most ``n`` files per run, chosen deterministically by path.

    ``remaining`` counts the files left for later runs.
    """
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    return df.orderBy(order_col).limit(n).withColumn(
        "remaining", F.greatest(total - F.lit(n), F.lit(0)).cast("long"))


def rate_audit(requests: DataFrame, ts_col: str, limit: int = config.RATE_LIMIT_CALLS_PER_MINUTE,
               key_cols=(), window: str = "1 minute") -> DataFrame:
    """Calls per tumbling window (and key) with an ``over_limit`` flag.

    Partial counts are combined map-side; one row per window and key.
    """
    w = F.window(F.col(ts_col), window)
    return (requests.groupBy(w.alias("w"), *key_cols)
                    .agg(F.count(F.lit(1)).alias("calls"))
                    .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                            *key_cols, "calls", (F.col("calls") > F.lit(limit)).alias("over_limit")))


def file_id_collisions(files: DataFrame, id_col: str = "file_id",
                       keys=("parent_folder", "filename")) -> DataFrame:
    """Surrogate ids shared by different ``(folder, name)`` pairs.

    Duplicates collapse first in a hash aggregate on ``(id, pair)`` (partial,
    map-side), so a hot id costs one row per distinct pair; the per-id step
    then keeps only bounded values: pair count, smallest and largest pair.
    """
    pair = F.concat_ws("/", *[F.col(k) for k in keys])
    pairs = files.groupBy(F.col(id_col), pair.alias("_pair")).agg(F.count(F.lit(1)).alias("_n"))
    return (pairs.groupBy(id_col)
                 .agg(F.count(F.lit(1)).alias("n_pairs"),
                      F.min("_pair").alias("first_pair"), F.max("_pair").alias("last_pair"))
                 .filter(F.col("n_pairs") > F.lit(1)))
