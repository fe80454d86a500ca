import importlib.util
import os

from pyspark.sql import DataFrame

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _entry_module():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_contract_keys_and_flagship(spark):
    mod = _entry_module()
    qs, oracles = mod.queries(), mod.oracle_sql()
    from parley.plans import catalog
    assert qs and set(catalog.queries()) == set(catalog.oracle_sql())
    assert set(catalog.queries()) <= set(qs) and set(oracles) <= set(qs)
    assert all(isinstance(sql, str) and sql.strip() for sql in oracles.values())
    df = mod.entry(spark)
    assert isinstance(df, DataFrame)
    assert [f.name for f in df.schema.fields] == ["sentiment", "count"]
    assert df.count() > 0


def test_queries_are_lazy(spark):
    """Building every query DataFrame runs no Spark job of its own (Spark's
    parquet footer / schema reading at ``spark.read`` aside)."""
    from parley.plans import catalog
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    for name, fn in catalog.queries().items():
        assert isinstance(fn(spark, "/root/testdata/sf0.001"), DataFrame), name
    new_jobs = set(tracker.getJobIdsForGroup(None)) - before
    names = []
    for j in new_jobs:
        info = tracker.getJobInfo(j)
        for sid in (info.stageIds if info else []):
            st = tracker.getStageInfo(sid)
            names.append(st.name if st else "?")
    assert all(n.startswith("parquet at") for n in names), names
