import pytest
from pyspark.sql import functions as F

from parley.plans import pipeline
from parley.sinks import writers


def _src(spark, rows, ts):
    df = spark.createDataFrame(rows, "parent_folder string, filename string, transcription_text string, error_message string")
    return df.select(
        "parent_folder", "filename",
        F.concat_ws("/", F.lit("/calls"), "parent_folder", "filename").alias("full_path"),
        F.lit(1.5).alias("duration_seconds"), F.lit(1).alias("num_chunks"), "transcription_text",
        pipeline._ts(ts).alias("processing_timestamp"), pipeline._ts(ts).alias("ingestion_timestamp"),
        F.lit("x").alias("file_id"), "error_message")


def _rows(spark, table):
    return sorted((r.parent_folder, r.filename, r.transcription_text, str(r.ingestion_timestamp))
                  for r in spark.table(table).collect())


def test_merge_into_table_partition_scoped_and_idempotent(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS calls_db")
    name = "calls_db.transcripts_t1"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    writers.ensure_transcripts_table(spark, name)
    writers.ensure_transcripts_table(spark, name)          # create-if-absent
    first = _src(spark, [("a", "1.wav", "hello", None), ("a", "2.wav", "good", None),
                         ("b", "1.wav", "other", None)], "2024-01-01 00:00:00")
    writers.merge_into_table(spark, name, first, pipeline.KEYS)
    assert len(_rows(spark, name)) == 3
    second = _src(spark, [("a", "1.wav", None, "ENDPOINT_ERROR: X"), ("c", "9.wav", "new", None)],
                  "2024-01-02 00:00:00")
    writers.merge_into_table(spark, name, second, pipeline.KEYS)
    once = _rows(spark, name)
    assert ("a", "1.wav", None, "2024-01-02 00:00:00") in once       # failed re-run overwrote
    assert ("a", "2.wav", "good", "2024-01-01 00:00:00") in once     # same folder, untouched
    assert ("b", "1.wav", "other", "2024-01-01 00:00:00") in once    # other folder, untouched
    assert ("c", "9.wav", "new", "2024-01-02 00:00:00") in once
    writers.merge_into_table(spark, name, second, pipeline.KEYS)
    assert _rows(spark, name) == once                                # idempotent


def test_merge_keep_good(spark):
    name = "calls_db.transcripts_t2"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    writers.ensure_transcripts_table(spark, name)
    writers.merge_into_table(spark, name, _src(spark, [("a", "1.wav", "hello", None)],
                                               "2024-01-01 00:00:00"), pipeline.KEYS)
    writers.merge_into_table(spark, name, _src(spark, [("a", "1.wav", None, "boom")],
                                               "2024-01-02 00:00:00"), pipeline.KEYS,
                             on_error="keep_good")
    assert _rows(spark, name) == [("a", "1.wav", "hello", "2024-01-01 00:00:00")]


def test_merge_duplicate_keys_fail_and_leave_table(spark):
    name = "calls_db.transcripts_t3"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    writers.ensure_transcripts_table(spark, name)
    writers.merge_into_table(spark, name, _src(spark, [("a", "1.wav", "x", None)],
                                               "2024-01-01 00:00:00"), pipeline.KEYS)
    dup = _src(spark, [("a", "1.wav", "y", None), ("a", "1.wav", "z", None)], "2024-01-02 00:00:00")
    with pytest.raises(Exception, match="MERGE_CARDINALITY_VIOLATION"):
        writers.merge_into_table(spark, name, dup, pipeline.KEYS)
    assert _rows(spark, name) == [("a", "1.wav", "x", "2024-01-01 00:00:00")]


def test_not_null_enforced(spark):
    df = spark.createDataFrame([("a", None)], "parent_folder string, filename string")
    with pytest.raises(Exception, match="NOT_NULL_VIOLATION"):
        writers.enforce_not_null(df).collect()


def test_stage_tables_create_or_append_and_drop(spark):
    df = spark.createDataFrame([("a", None), ("b", "err")], "k string, error_message string")
    writers.overwrite_stage(df, "stage_ok_20240101", success_only=True)
    writers.overwrite_stage(df, "stage_all_20240101")
    assert spark.table("stage_ok_20240101").count() == 1
    assert spark.table("stage_all_20240101").count() == 2
    spark.sql("DROP TABLE IF EXISTS gold_t")
    writers.create_or_append(df, "gold_t")
    writers.create_or_append(df, "gold_t")
    assert spark.table("gold_t").count() == 4          # re-run duplicates every row
    left = writers.drop_tables(spark, ["stage_ok_20240101", "stage_all_20240101", "never_there"])
    assert left == [] and not spark.catalog.tableExists("stage_all_20240101")
    assert not spark.catalog.tableExists("stage_ok_20240101")


def test_clustered_keeps_rows_and_orders_within_partitions(spark):
    df = spark.createDataFrame([(f"f{i % 5}", f"n{i:03d}") for i in range(200)], "parent_folder string, filename string")
    c = writers.clustered(df, pipeline.KEYS, 4)
    assert sorted(map(tuple, c.collect())) == sorted(map(tuple, df.collect()))
    parts = c.rdd.glom().collect()
    for p in parts:
        keys = [(r.parent_folder, r.filename) for r in p]
        assert keys == sorted(keys)
    bounds = [((p[0].parent_folder, p[0].filename), (p[-1].parent_folder, p[-1].filename)) for p in parts if p]
    for (a_lo, a_hi), (b_lo, b_hi) in zip(bounds, bounds[1:]):
        assert a_hi < b_lo                              # disjoint ranges


def test_merge_reads_touched_folders_only_and_leaves_the_session_alone(spark):
    name = "calls_db.transcripts_pruned"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    writers.ensure_transcripts_table(spark, name)
    rows = [(f"f{i % 7}", f"{i}.wav", f"t{i}", None) for i in range(70)]
    writers.merge_into_table(spark, name, _src(spark, rows, "2024-01-01 00:00:00"), pipeline.KEYS)
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    target = spark.table(name).where(F.col("parent_folder").isin(["f1"]))
    plan = target._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: ")[1].split("]")[0]
    assert "f1" in filters or "isnotnull(parent_folder" in filters
    files = {r[0] for r in spark.table(name).where("parent_folder <> 'f1'").select(
        F.input_file_name()).distinct().collect()}
    writers.merge_into_table(spark, name, _src(spark, [("f1", "1.wav", None, "E")],
                                               "2024-01-02 00:00:00"), pipeline.KEYS)
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before
    assert {r[0] for r in spark.table(name).where("parent_folder <> 'f1'").select(
        F.input_file_name()).distinct().collect()} == files
    assert len(_rows(spark, name)) == 70
    assert ("f1", "1.wav", None, "2024-01-02 00:00:00") in _rows(spark, name)


def test_row_level_merge_refuses_keep_good(spark):
    with pytest.raises(ValueError, match="row_level_merge"):
        writers.merge_into_table(spark, "t", spark.range(1), ["id"], on_error="keep_good",
                                 row_level_merge=True)
