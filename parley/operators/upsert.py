"""Keyed upsert (MERGE) as a DataFrame rewrite.

``MERGE INTO t USING s ON keys WHEN MATCHED UPDATE SET <all non-key
columns> WHEN NOT MATCHED INSERT *`` with no ``NOT MATCHED BY SOURCE``
clause is: target rows whose key is not in the source, plus every source
row projected to the target's columns.  Matched rows take the source's
values, NULLs included.

Both inputs grow with the data, so nothing is broadcast by hand: the
anti-join shuffles on the keys and AQE switches to a broadcast at run time
only when the source turns out to be small.  Keys are unique on both sides
(checked), so the join has no hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class MergeCardinalityError(ValueError):
    pass


def conform(source: DataFrame, target_columns: list[str]) -> DataFrame:
    """``INSERT *`` maps by name: extra source columns are dropped."""
    missing = [c for c in target_columns if c not in source.columns]
    if missing:
        raise ValueError(f"source lacks target columns {missing}")
    return source.select(*target_columns)


def assert_unique_keys(source: DataFrame, keys: list[str]) -> DataFrame:
    """Fail the job if two source rows share a key (MERGE cardinality rule).

    Lazy: the check runs inside the merge job.  Per-key counts are
    aggregated map-side first (a hot key costs one partial row per task),
    then joined back on ``keys`` – the same hash partitioning the merge join
    uses, so no extra exchange on the source.
    """
    counts = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("_key_rows"))
    msg = F.concat(F.lit("MERGE_CARDINALITY_VIOLATION: more than one source row for key "),
                   F.to_json(F.struct(*[F.col(k) for k in keys])))
    return (source.join(counts, keys, "inner")
                  .filter(F.when(F.col("_key_rows") > F.lit(1), F.raise_error(msg))
                           .otherwise(F.lit(True)))
                  .drop("_key_rows")
                  .select(*source.columns))


def duplicate_keys(df: DataFrame, keys: list[str], detail: str | None = None) -> DataFrame:
    """Keys held by more than one row, with their row count and, for
    ``detail`` (e.g. the full path), the number of distinct values and the
    smallest and largest – bounded per key however hot it is.  Rows first
    collapse per ``(keys, detail)`` in a partial hash aggregate."""
    if not detail:
        return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
                  .filter(F.col("n_rows") > F.lit(1)))
    per = df.groupBy(*keys, detail).agg(F.count(F.lit(1)).alias("_n"))
    return (per.groupBy(*keys)
               .agg(F.sum("_n").alias("n_rows"), F.count(F.lit(1)).alias(f"n_{detail}"),
                    F.min(detail).alias(f"first_{detail}"), F.max(detail).alias(f"last_{detail}"))
               .filter(F.col("n_rows") > F.lit(1)))


def merge_keyed(target: DataFrame, source: DataFrame, keys: list[str], *,
                on_error: str = "overwrite", error_col: str = "error_message",
                check_unique: bool = True, strategy: str = "outer") -> DataFrame:
    """Result of upserting ``source`` into ``target`` on ``keys``.

    One pass over each side: the source is aggregated per key (row count
    for the cardinality rule plus the row itself, combined map-side) and
    full-outer-joined with the target on the same hash partitioning.  A
    matched or new key takes the source row; other target rows stay.

    ``on_error="overwrite"`` (reference behaviour): a failed re-run row
    replaces a good one, so its text becomes NULL.  ``"keep_good"``: source
    rows with a non-null ``error_col`` only insert new keys and never
    replace an existing row.

    ``strategy="anti"`` is for a materialised (e.g. checkpointed) source:
    target rows whose key is not in the source, plus the source rows.  A
    small increment is then broadcast by AQE and the large target streams
    through an anti-join without being shuffled (a full outer join can
    never broadcast).  It reads the source more than once, so it is not the
    default for lazy sources.
    """
    if on_error not in ("overwrite", "keep_good"):
        raise ValueError(on_error)
    if strategy == "anti":
        return _merge_anti(target, source, keys, on_error, error_col, check_unique)
    if strategy != "outer":
        raise ValueError(strategy)
    cols = [c for c in target.columns if c not in keys]
    conform(source, target.columns)  # INSERT * needs every target column
    carry = cols + ([error_col] if on_error == "keep_good" and error_col in source.columns
                    and error_col not in cols else [])
    row = F.struct(*[F.col(c) for c in carry])
    src = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("_src_rows"),
                                    F.any_value(row).alias("_src"))
    if check_unique:
        msg = F.concat(F.lit("MERGE_CARDINALITY_VIOLATION: more than one source row for key "),
                       F.to_json(F.struct(*[F.col(k) for k in keys])))
        src = src.filter(F.when(F.col("_src_rows") > F.lit(1), F.raise_error(msg))
                          .otherwise(F.lit(True)))
    tgt = target.withColumn("_in_target", F.lit(True))
    joined = tgt.join(src.drop("_src_rows"), keys, "full_outer")
    use_src = F.col("_src").isNotNull()
    if on_error == "keep_good" and error_col in source.columns:
        failed = F.col(f"_src.{error_col}").isNotNull()
        use_src = use_src & ~(failed & F.coalesce(F.col("_in_target"), F.lit(False)))
    picked = [F.when(use_src, F.col(f"_src.{c}")).otherwise(F.col(c)).alias(c) for c in cols]
    # A new key whose failed row was skipped has no row on either side.
    present = use_src | F.col("_in_target").isNotNull()
    return joined.filter(present).select(*keys, *picked).select(*target.columns)


def _merge_anti(target: DataFrame, source: DataFrame, keys: list[str], on_error: str,
                error_col: str, check_unique: bool) -> DataFrame:
    src = assert_unique_keys(source, keys) if check_unique else source
    conform(src, target.columns)
    if on_error == "keep_good" and error_col in src.columns:
        failed_keys = src.filter(F.col(error_col).isNotNull()).select(*keys)
        # target side streams; the (small) failed keys are the build side
        held = target.select(*keys).join(failed_keys, keys, "left_semi")
        src = src.join(held, keys, "left_anti")
    src = src.select(*target.columns)
    kept = target.join(src.select(*keys), keys, "left_anti")
    return kept.unionByName(src)


def latest_per_key(df: DataFrame, keys: list[str], order_col: str) -> DataFrame:
    """One row per key: the one with the greatest ``order_col`` (latest wins).

    ``max_by`` over a struct of the row is a partial aggregate: each task
    keeps one candidate per key, so a hot key never gathers its rows in one
    task.  Ties on ``order_col`` resolve to the larger row value.
    """
    others = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(c) for c in others])
    order = F.struct(F.col(order_col), row)
    best = df.groupBy(*keys).agg(F.max_by(row, order).alias("_row"))
    return best.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in others]).select(*df.columns)
