"""Table writers and maintenance.

Plain Parquet tables have no row-level MERGE, so :func:`merge_into_table`
rewrites only the partitions the source touches: the merged rows of those
partitions are checkpointed to the shared checkpoint folder (cutting the
lineage back to the files being replaced) and then written with dynamic
partition overwrite.  For a table format with row-level MERGE, Spark's
``mergeInto`` can be used instead (``row_level_merge=True``).
"""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley import config
from parley.config import ChunkSpec
from parley.operators import chunking
from parley.operators import upsert as up
from parley.session import ensure_checkpoint_dir

CHUNK_ROOT = "/stage/preprocessed"
MAX_LISTED_PARTITIONS = 10_000
_LOG = logging.getLogger(__name__)


# ---- stage tables ------------------------------------------------------------
def overwrite_stage(df: DataFrame, table: str, success_only: bool = False,
                    error_col: str = "error_message", fmt: str = "parquet") -> None:
    """Overwrite a dated stage table (K1: success rows only; K2: all rows)."""
    out = df.filter(F.col(error_col).isNull()) if success_only else df
    out.write.mode("overwrite").format(fmt).saveAsTable(table)


def stage_table_name(base: str, run_id: str) -> str:
    """Stage tables are keyed by an explicit run id, not the wall clock."""
    return f"{base}_{run_id}"


# Fixed contract: columns of the durable transcripts table.
TRANSCRIPTS_SCHEMA = T.StructType([
    T.StructField("parent_folder", T.StringType(), False),
    T.StructField("filename", T.StringType(), False),
    T.StructField("full_path", T.StringType(), False),
    T.StructField("duration_seconds", T.DoubleType()),
    T.StructField("num_chunks", T.IntegerType()),
    T.StructField("transcription_text", T.StringType()),
    T.StructField("processing_timestamp", T.TimestampNTZType()),
    T.StructField("ingestion_timestamp", T.TimestampNTZType(), False),
])
NOT_NULL_COLUMNS = tuple(f.name for f in TRANSCRIPTS_SCHEMA if not f.nullable)


def ensure_transcripts_table(spark: SparkSession, name: str, fmt: str = "parquet") -> None:
    """Create schema and target table if absent (K3).

    Partitioned by folder so a merge rewrites only the folders it touches.
    """
    if "." in name:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name.rsplit('.', 1)[0]}")
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" + ("" if f.nullable else " NOT NULL")
                        for f in TRANSCRIPTS_SCHEMA)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {fmt} "
              "PARTITIONED BY (parent_folder)")


def enforce_not_null(df: DataFrame, cols=NOT_NULL_COLUMNS) -> DataFrame:
    """Fail the write on a NULL in a NOT NULL column (Parquet won't)."""
    cond = None
    for c in cols:
        if c in df.columns:
            cc = F.col(c).isNull()
            cond = cc if cond is None else cond | cc
    if cond is None:
        return df
    msg = F.concat(F.lit("NOT_NULL_VIOLATION in one of "), F.lit(", ".join(cols)))
    return df.filter(F.when(cond, F.raise_error(msg)).otherwise(F.lit(True)))


def merge_into_table(spark: SparkSession, table: str, source: DataFrame, keys: list[str], *,
                     partition_col: str | None = "parent_folder", on_error: str = "overwrite",
                     error_col: str = "error_message", row_level_merge: bool = False) -> None:
    """Upsert ``source`` into ``table`` on ``keys`` (K4 / J1-J4).

    Only the partitions that the source touches are read and rewritten, in
    ranges of the keys (K7).  Their values are listed for the scan's partition
    filter, up to ``MAX_LISTED_PARTITIONS``; beyond that they are joined.

    ``row_level_merge=True`` is for tables whose format implements MERGE
    (row-level operations); Spark's ``mergeInto`` then updates in place.
    """
    if row_level_merge and on_error != "overwrite":
        raise ValueError("row_level_merge supports on_error='overwrite' only")
    target = spark.table(table)
    if row_level_merge:
        src = up.assert_unique_keys(source, keys)
        cond = " AND ".join(f"{table}.{k} = s.{k}" for k in keys)
        updates = {c: F.col(f"s.{c}") for c in target.columns if c not in keys}
        (src.alias("s").mergeInto(table, F.expr(cond))
            .whenMatched().update(updates).whenNotMatched().insertAll().merge())
        return
    ensure_checkpoint_dir(spark)
    # The source feeds two branches below (touched partitions, merge); pin it
    # once so an upstream remote call or decode never runs twice.
    source = source.checkpoint(eager=True)
    partitioned = bool(partition_col) and partition_col in keys
    if partitioned:
        touched = source.select(partition_col).distinct()
        values = [r[0] for r in touched.limit(MAX_LISTED_PARTITIONS + 1).collect()]
        if len(values) <= MAX_LISTED_PARTITIONS:
            # a literal list prunes the scan to the touched folders
            target = target.where(F.col(partition_col).isin([v for v in values if v is not None]))
        else:
            target = target.join(touched, partition_col, "left_semi")
    # The source is materialised above, so the anti-join form applies: a
    # small increment is broadcast and the target is not shuffled.
    merged = up.merge_keyed(target, source, keys, on_error=on_error, error_col=error_col,
                            strategy="anti")
    merged = enforce_not_null(merged).select(*spark.table(table).columns)
    # Materialise in the shared checkpoint folder: the write below no longer
    # reads the files it replaces, and a lost executor recomputes from here.
    frozen = clustered(merged, keys).checkpoint(eager=True)
    if not partitioned:
        frozen.write.insertInto(table, overwrite=True)
        return
    # Dynamic overwrite as an option of this one write: the session's setting
    # may serve a stream or another merge at the same time.
    described = {r["col_name"]: r["data_type"] for r in
                 spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    (frozen.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_col).format(described["Provider"]).save(described["Location"]))
    spark.catalog.recoverPartitions(table)          # new folders
    spark.catalog.refreshTable(table)


def create_or_append(df: DataFrame, table: str) -> None:
    """Add the rows to ``table``, which the write creates where it is absent (K5).

    Appending is not idempotent: a re-run adds every row again.
    """
    df.write.mode("append").saveAsTable(table)


def drop_tables(spark: SparkSession, tables) -> list[str]:
    """Drop stage tables that exist; returns those that could not be dropped (K6).

    A table that stays is logged and does not stop the others.
    """
    left = []
    for name in tables:
        try:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        except AnalysisException as e:
            _LOG.warning("stage table %s was not dropped: %s", name, e)
            left.append(name)
    return left


def clustered(df: DataFrame, keys: list[str], num_partitions: int | None = None) -> DataFrame:
    """Range-partition and sort by ``keys`` before a write (K7): files hold
    disjoint, ordered key ranges, so min/max statistics skip files."""
    parts = df.repartitionByRange(num_partitions, *keys) if num_partitions else \
        df.repartitionByRange(*keys)
    return parts.sortWithinPartitions(*keys)


# ---- stage-1 chunk manifests and payloads ----------------------------------
def chunk_paths(file_id: Column, n: Column, root: str = CHUNK_ROOT) -> Column:
    idx = F.sequence(F.lit(0).cast("long"), (n - F.lit(1)).cast("long"))
    fmt = f"{root}/{config.CHUNK_FILE_FORMAT}"
    return F.array_join(F.transform(idx, lambda i: F.format_string(fmt, file_id, i)),
                        config.CHUNK_PATH_SEPARATOR)


def chunk_manifest(recs: DataFrame, spec: ChunkSpec, length_col: str = "length",
                   chars_per_second: float = 1000.0, root: str = CHUNK_ROOT) -> DataFrame:
    """Stage-1 metadata per recording: duration, chunk count, ``|``-joined
    chunk paths, error (none for text recordings)."""
    n = chunking.chunk_count(F.col(length_col), spec)
    return recs.select("parent_folder", "filename", "full_path", "file_id",
                       (F.col(length_col) / F.lit(chars_per_second)).alias("duration_seconds"),
                       n.alias("num_chunks"), chunk_paths(F.col("file_id"), n, root).alias("chunk_paths"),
                       F.lit(None).cast("string").alias("error_message"))


def write_chunk_payloads(chunks: DataFrame, path: str, payload_col: str = "payload",
                         root: str = CHUNK_ROOT) -> None:
    """Persist chunk payloads as rows (K8): ``chunk_path`` names the chunk
    the way a file would be named, and the bytes travel as data, so a retried
    task rewrites its own output atomically instead of leaving stray files."""
    out = chunks.withColumn("chunk_path", F.format_string(f"{root}/{config.CHUNK_FILE_FORMAT}",
                                                          F.col("file_id"), F.col("chunk_idx")))
    out.select("full_path", "file_id", "chunk_idx", "chunk_path", payload_col).write.mode(
        "overwrite").parquet(path)
