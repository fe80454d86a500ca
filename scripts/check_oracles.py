import sys, time
sys.path.insert(0, __import__('os').path.dirname(__import__('os').path.dirname(__import__('os').path.abspath(__file__))))
from parley.session import build_session
import compare
from parley.plans import catalog, corpus_queries
from parley.sources.tables import TABLES
sf = sys.argv[1] if len(sys.argv) > 1 else '/root/testdata/sf0.01'
only = sys.argv[2:] 
spark = build_session()
con = compare.duckdb_connection(sf, TABLES)
qs, os_ = catalog.queries() | corpus_queries.QUERIES, catalog.oracle_sql() | corpus_queries.ORACLES
bad = 0
for name, fn in qs.items():
    if only and name not in only: continue
    t0 = time.time()
    try:
        df = fn(spark, sf)
        s = compare.spark_rows(df)
    except Exception as e:
        print(f"FAIL {name}: spark error {str(e)[:600]}"); bad += 1; continue
    t1 = time.time()
    if name not in os_:
        print(f"ROWS {name}: {len(s[1])} rows ({t1-t0:.1f}s)"); continue
    try:
        d = compare.duckdb_rows(con, os_[name])
    except Exception as e:
        print(f"FAIL {name}: duckdb error {str(e)[:600]}"); bad += 1; continue
    r = compare.diff(s, d) or compare.schema_diff(df, con, os_[name])
    if r: bad += 1
    print(f"{'OK  ' if not r else 'DIFF'} {name}: {len(s[1])} rows ({t1-t0:.1f}s) {r or ''}"[:1500])
print("bad", bad)
