"""Housing source tables derived from the driver's ``orders`` and ``customer`` tables.

Every row of both tables is used; the rules below only *inject* NULLs, zeros,
negatives and outliers so that imputation, filtering and capping are exercised.
The same expression text runs in Spark (``selectExpr``) and in the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.sources.tables import read_table

# Derivation of ``flats`` from ``orders`` (alias, SQL expression).
FLATS_EXPRS: tuple[tuple[str, str], ...] = (
    ("id", "o_orderkey"),
    ("building_id", "o_custkey"),
    ("floor", "CAST(CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_orderkey % 12 END AS INT)"),
    ("kitchen_area", "CASE WHEN o_orderkey % 19 = 0 THEN NULL WHEN o_orderkey % 211 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(5 + (o_orderkey * 31) % 14 AS DOUBLE) END"),
    ("living_area", "CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE CAST(12 + (o_orderkey * 37) % 50 AS DOUBLE) END"),
    ("rooms", "CAST(CASE WHEN o_orderkey % 401 = 0 THEN 0 WHEN o_orderkey % 307 = 0 THEN NULL ELSE 1 + o_orderkey % 5 END AS INT)"),
    ("is_apartment", "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderkey % 3 = 1 END"),
    ("studio", "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderkey % 7 = 1 END"),
    ("total_area", "CASE WHEN o_orderkey % 23 = 0 THEN NULL WHEN o_orderkey % 83 = 0 THEN CAST(400 AS DOUBLE) ELSE CAST(30 + (o_orderkey * 41) % 70 AS DOUBLE) END"),
    ("price", "CASE WHEN o_orderkey % 101 = 0 THEN NULL WHEN o_orderkey % 103 = 0 THEN -o_totalprice WHEN o_orderkey % 97 = 0 THEN o_totalprice * 10 ELSE o_totalprice END"),
)

# Derivation of ``buildings`` from ``customer`` (alias, SQL expression).
BUILDINGS_EXPRS: tuple[tuple[str, str], ...] = (
    ("id", "c_custkey"),
    ("build_year", "CAST(CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE 1950 + c_custkey % 70 END AS INT)"),
    ("building_type_int", "CASE WHEN c_custkey % 31 = 0 THEN NULL ELSE c_nationkey % 6 END"),
    ("latitude", "CASE WHEN c_custkey % 37 = 0 THEN NULL ELSE 55 + c_acctbal / CAST(10000 AS DOUBLE) END"),
    ("longitude", "CASE WHEN c_custkey % 41 = 0 THEN NULL ELSE 37 + c_acctbal / CAST(20000 AS DOUBLE) END"),
    ("ceiling_height", "CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE CAST(250 + c_custkey % 100 AS DOUBLE) / 100 END"),
    ("flats_count", "CAST(CASE WHEN c_custkey % 43 = 0 THEN NULL ELSE 20 + c_custkey % 300 END AS INT)"),
    ("floors_total", "CAST(CASE WHEN c_custkey % 47 = 0 THEN NULL ELSE 5 + c_custkey % 20 END AS INT)"),
    ("has_elevator", "CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_custkey % 5 > 2 END"),
)

# Orphan variant (flats whose building_id is NULL).
ORPHAN_BUILDING_ID_EXPR = "CASE WHEN o_custkey % 499 = 0 THEN NULL ELSE o_custkey END"


# Variant with flats whose building_id is NULL or names no building.
DANGLING_BUILDING_ID_EXPR = "CASE WHEN o_custkey % 499 = 0 THEN NULL WHEN o_custkey % 333 = 0 THEN -o_custkey ELSE o_custkey END"

# Flats that share ids within one table.
SHARED_ID = {"id": "o_orderkey - CASE WHEN o_orderkey % 10 IN (3, 4) THEN 2 ELSE 0 END"}

# Buildings without any floor count, and floors below zero: the imputed total
# stays NULL, so the published floor rule rejects such floors and the exploratory one does not.
BELOW_ZERO_FLOOR = {"floor": "CAST(CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 59 = 0 THEN -1 ELSE o_orderkey % 12 END AS INT)"}
NO_TOTALS = {"floors_total": "CAST(NULL AS INT)"}


def _select_sql(exprs, table: str, overrides: dict[str, str] | None = None) -> str:
    overrides = overrides or {}
    cols = ",\n  ".join(f"{overrides.get(a, e)} AS {a}" for a, e in exprs)
    return f"SELECT\n  {cols}\nFROM {table}"


def flats_sql(table: str = "orders", *, orphans: bool = False, changed: dict[str, str] | None = None) -> str:
    ov = {"building_id": ORPHAN_BUILDING_ID_EXPR} if orphans else {}
    return _select_sql(FLATS_EXPRS, table, ov | (changed or {}))


def buildings_sql(table: str = "customer", changed: dict[str, str] | None = None) -> str:
    return _select_sql(BUILDINGS_EXPRS, table, changed)


def flats(spark: SparkSession, sf_dir: str, *, orphans: bool = False, changed: dict[str, str] | None = None) -> DataFrame:
    exprs = dict(FLATS_EXPRS) | (changed or {})
    if orphans:
        exprs["building_id"] = ORPHAN_BUILDING_ID_EXPR
    return read_table(spark, sf_dir, "orders").selectExpr(
        *[f"{e} AS {a}" for a, e in exprs.items()]
    )


def buildings(spark: SparkSession, sf_dir: str, *, changed: dict[str, str] | None = None) -> DataFrame:
    return read_table(spark, sf_dir, "customer").selectExpr(
        *[f"{e} AS {a}" for a, e in (dict(BUILDINGS_EXPRS) | (changed or {})).items()]
    )


# Rows that break the raw rules.  Flats of ids divisible by 50 come twice, the
# copy (seq 1) at twice the price; ids divisible by 499 lose their id in the copy.
def repeated_flats_sql(table: str = "orders") -> str:
    base = flats_sql(table)
    cols = [a for a, _ in FLATS_EXPRS if a not in ("id", "price")]
    copy = ", ".join(cols)
    return (
        f"SELECT {copy}, id, price, 0 AS seq FROM ({base}) t UNION ALL "
        f"SELECT {copy}, CASE WHEN id % 499 = 0 THEN NULL ELSE id END AS id, price * 2 AS price, 1 AS seq "
        f"FROM ({base}) t WHERE id % 50 = 0 OR id % 499 = 0"
    )


def repeated_flats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All flats (seq 0) and the copies of some of them (seq 1)."""
    first = flats(spark, sf_dir)
    copies = first.where((F.col("id") % 50 == 0) | (F.col("id") % 499 == 0)).withColumns({
        "id": F.when(F.col("id") % 499 != 0, F.col("id")),
        "price": F.col("price") * 2,
        "seq": F.lit(1),
    })
    return first.withColumn("seq", F.lit(0)).unionByName(copies)


# Target strings that are no positive finite number, and one that is.
TARGET_TEXT_EXPR = (
    "CASE WHEN o_orderkey % 7 = 0 THEN 'abc' WHEN o_orderkey % 7 = 1 THEN '' WHEN o_orderkey % 7 = 2 THEN '-5' "
    "WHEN o_orderkey % 7 = 3 THEN NULL WHEN o_orderkey % 7 = 4 THEN 'Infinity' ELSE '12.5' END"
)
