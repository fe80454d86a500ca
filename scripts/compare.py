"""Result comparison used by tests and the oracle check script.

Both sides are turned into sorted lists of normalised tuples: columns
sorted by name, floats rounded, timestamps as ISO text, arrays as tuples.
"""

from __future__ import annotations

import datetime as _dt
import decimal
import math


def _norm(v, digits: int = 9):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.{digits}g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.{digits}g}")
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (_dt.datetime, _dt.date)):
        return v.isoformat(sep=" ") if isinstance(v, _dt.datetime) else v.isoformat()
    if isinstance(v, dict):
        return tuple(sorted((str(k), _norm(x, digits)) for k, x in v.items()))
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, digits) for x in v)
    if hasattr(v, "asDict"):
        return tuple(_norm(x, digits) for x in v)
    if hasattr(v, "tolist"):
        return _norm(v.tolist(), digits)
    return v


def normalise(columns: list[str], rows: list[tuple], digits: int = 9):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    out = [tuple(_norm(r[i], digits) for i in order) for r in rows]
    out.sort(key=lambda t: repr(t))
    return cols, out


def spark_rows(df):
    return df.columns, [tuple(r) for r in df.collect()]


def duckdb_rows(con, sql: str):
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return cols, cur.fetchall()


def duckdb_connection(sf_dir: str, tables):
    import duckdb
    import os
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in tables:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def diff(spark_side, duck_side, digits: int = 9, show: int = 3) -> str | None:
    """None when equal, else a short description of the first differences."""
    sc, sr = normalise(*spark_side, digits=digits)
    dc, dr = normalise(*duck_side, digits=digits)
    if sc != dc:
        return f"columns differ: spark={sc} duckdb={dc}"
    if len(sr) != len(dr):
        return f"row counts differ: spark={len(sr)} duckdb={len(dr)}"
    bad = [(a, b) for a, b in zip(sr, dr) if a != b]
    if bad:
        return f"{len(bad)} rows differ, e.g. " + "; ".join(f"spark={a!r} duckdb={b!r}" for a, b in bad[:show])
    return None


_SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "tinyint": "TINYINT",
                  "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR", "boolean": "BOOLEAN",
                  "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE",
                  "date": "DATE", "binary": "BLOB"}


def spark_type_as_duckdb(dt) -> str:
    from pyspark.sql import types as T
    if isinstance(dt, T.ArrayType):
        return spark_type_as_duckdb(dt.elementType) + "[]"
    if isinstance(dt, T.MapType):
        return f"MAP({spark_type_as_duckdb(dt.keyType)}, {spark_type_as_duckdb(dt.valueType)})"
    if isinstance(dt, T.StructType):
        inner = ", ".join(f"{f.name} {spark_type_as_duckdb(f.dataType)}" for f in dt.fields)
        return f"STRUCT({inner})"
    return _SPARK_TO_DUCK.get(dt.simpleString(), dt.simpleString().upper())


def schema_diff(spark_df, con, sql: str) -> str | None:
    """None when column names and types agree (DuckDB naming)."""
    duck = {d[0]: str(d[1]) for d in con.execute(f"DESCRIBE {sql}").fetchall()}
    mine = {f.name: spark_type_as_duckdb(f.dataType) for f in spark_df.schema.fields}
    bad = {k: (mine.get(k), duck.get(k)) for k in set(mine) | set(duck) if mine.get(k) != duck.get(k)}
    return None if not bad else f"schema differs (spark, duckdb): {bad}"
