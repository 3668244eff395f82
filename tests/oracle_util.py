"""Run oracle SQL in DuckDB over the same Parquet tables and compare with a Spark result."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, digits):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, digits) if digits is not None else v
    return v


def rows_of(records, cols, digits):
    return sorted(
        (tuple(_norm(r[c], digits) for c in cols) for r in records),
        key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t),
    )


# DuckDB result type -> Spark simpleString
DUCK_TO_SPARK = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}


def compare(spark_df, sql: str, sf_dir: str, digits: int | None = 9):
    """Return (ok, detail).  Columns compared by name and type, rows order-insensitively."""
    con = duck(sf_dir)
    rel = con.sql(sql)
    otypes = {c: DUCK_TO_SPARK.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
    stypes = dict(spark_df.dtypes)
    if otypes != stypes:
        return False, f"types differ: spark={stypes} oracle={otypes}"
    pdf = spark_df.toPandas()
    odf = con.execute(sql).df()
    sc, oc = sorted(pdf.columns), sorted(odf.columns)
    if sc != oc:
        return False, f"columns differ: spark={sc} oracle={oc}"
    if len(pdf) != len(odf):
        return False, f"row counts differ: spark={len(pdf)} oracle={len(odf)}"
    a = rows_of(pdf.astype(object).where(pdf.notna(), None).to_dict("records"), sc, digits)
    b = rows_of(odf.astype(object).where(odf.notna(), None).to_dict("records"), sc, digits)
    diff = [(x, y) for x, y in zip(a, b) if x != y]
    if diff:
        return False, f"{len(diff)} differing rows, first: {diff[:3]}"
    return True, f"{len(a)} rows equal"
