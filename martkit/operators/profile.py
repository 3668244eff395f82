"""D11 profile report as tidy DataFrames.

Every report is a fixed number of aggregate passes over the input, whatever the
number of columns: per-column counters are evaluated side by side in one ``agg``
and turned into rows with ``unpivot``/``explode`` afterwards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martkit.functions import pct, row_digest
from martkit.operators.stats import combine_rows, literal, quantile_stats, quartiles, row_values

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)

# Columns of the non-positive and outlier checks.
NONPOSITIVE_COLUMNS = ("price", "total_area", "kitchen_area", "living_area", "rooms")
OUTLIER_COLUMNS = ("price", "total_area", "kitchen_area", "living_area")


def _is_numeric(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, NUMERIC)


def profile_info(df: DataFrame) -> DataFrame:
    """``(column, dtype, non_null)`` per column."""
    cols = df.columns
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in cols])
    long = counts.unpivot([], cols, "column", "non_null")
    types = df.sparkSession.createDataFrame(
        [(c, t) for c, t in df.dtypes], "column string, dtype string"
    )
    return long.join(F.broadcast(types), "column").select("column", "dtype", "non_null")


def profile_nulls(df: DataFrame, top: int | None = None) -> DataFrame:
    """A8 + O1 + O2: NULL (and NaN) count per column, descending; ``top`` keeps the
    first n rows of that ranking (a top-k report)."""
    cols = df.columns
    def missing(c):
        m = F.col(c).isNull()
        if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType)):
            m = m | F.isnan(c)
        return F.count_if(m).alias(c)
    counts = df.agg(*[missing(c) for c in cols])
    out = counts.unpivot([], cols, "column", "nulls").orderBy(F.desc("nulls"), "column")
    return out.limit(top) if top is not None else out


def profile_nonpositive(df: DataFrame, columns=NONPOSITIVE_COLUMNS) -> DataFrame:
    """``(check, n)`` with ``n = count(c <= 0)`` for each present column."""
    present = [c for c in columns if c in df.columns]
    one = df.agg(*[F.count_if(F.col(c) <= 0).alias(f"{c}_nonpositive") for c in present])
    names = [f"{c}_nonpositive" for c in present]
    return one.unpivot([], names, "check", "n")


def repeated_rows(df: DataFrame) -> DataFrame:
    """``(columns..., _n)``: every row that occurs more than once, with its number of copies.

    Rows are counted by a 128-bit digest of their columns, combined map-side, so that only
    two numbers per distinct row are shuffled.  Rows whose digest repeats are fetched again
    and compared in full, which also tells apart different rows of equal digest.
    """
    digest = row_digest(df)
    marked = df.select("*", *(d.alias(f"_d{i}") for i, d in enumerate(digest)))
    again = marked.groupBy("_d0", "_d1").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_d0", "_d1")
    held = marked.join(again, ["_d0", "_d1"], "left_semi").select(*df.columns)
    return held.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")


def profile_duplicates(df: DataFrame, key: str | None = "flat_id") -> DataFrame:
    """Whole-row duplicates and key duplicates (2nd+ occurrences; NULLs equal)."""
    extra = F.coalesce(F.sum(F.col("_n") - 1), F.lit(0))
    one = repeated_rows(df).agg(extra.alias("dup_all"))
    if key is not None and key in df.columns:
        per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).agg(extra.alias(f"dup_{key}"))
        one = combine_rows(one, per_key)
    return one


def profile_outliers(
    df: DataFrame, columns=OUTLIER_COLUMNS, k: float = 1.5, *, quantile_mode: str = "exact",
) -> DataFrame:
    """A10: per column the IQR fences of its non-null values, the number of values
    outside them and that number as a percentage of *all* rows (no degenerate-IQR
    guard, as in the exploratory report)."""
    present = [c for c in columns if c in df.columns]
    q = row_values(quantile_stats(df, quartiles(present), quantile_mode))
    lo, hi = {}, {}
    for c in present:
        q1, q3 = literal(q[f"{c}_q1"], "double"), literal(q[f"{c}_q3"], "double")
        lo[c], hi[c] = q1 - F.lit(k) * (q3 - q1), q3 + F.lit(k) * (q3 - q1)
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if((F.col(c) < lo[c]) | (F.col(c) > hi[c])).alias(f"{c}_out") for c in present],
    )
    rows = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("feature"),
                    lo[c].alias("iqr_lo"),
                    hi[c].alias("iqr_hi"),
                    F.col(f"{c}_out").alias("outliers_cnt"),
                    pct(F.col(f"{c}_out"), F.col("_rows")).alias("outliers_pct"),
                )
                for c in present
            ]
        )
    ).alias("r")
    return counts.select(rows).select("r.*")


def profile_summary(df: DataFrame, *, quantile_mode: str = "exact", digits: int = 4) -> DataFrame:
    """Count, unique, top, freq (non-numeric columns), mean, std, min, 25/50/75 %,
    max (numeric columns); quartiles are exact and interpolated.  ``mean``/``std`` are
    rounded to ``digits`` decimals (their last bits depend on summation order).

    Passes: one for the moments, those of the exact quartiles, one for the categorical counts.
    """
    nums = [c for c in df.columns if _is_numeric(df, c)]
    cats = [c for c in df.columns if c not in nums]
    parts = []
    if nums:
        mom = row_values(
            df.agg(
                *[
                    e
                    for c in nums
                    for e in (
                        F.count(c).alias(f"{c}__count"),
                        F.round(F.avg(c), digits).alias(f"{c}__mean"),
                        F.round(F.stddev_samp(c), digits).alias(f"{c}__std"),
                        F.min(c).cast("double").alias(f"{c}__min"),
                        F.max(c).cast("double").alias(f"{c}__max"),
                    )
                ]
            )
        )
        q = quantile_stats(df, [t for c in nums for t in _three(c)], quantile_mode)
        parts.append(
            q.select(
                F.explode(
                    F.array(
                        *[
                            F.struct(
                                F.lit(c).alias("column"),
                                literal(mom[f"{c}__count"], "long").alias("count"),
                                F.lit(None).cast("long").alias("unique"),
                                F.lit(None).cast("string").alias("top"),
                                F.lit(None).cast("long").alias("freq"),
                                literal(mom[f"{c}__mean"], "double").alias("mean"),
                                literal(mom[f"{c}__std"], "double").alias("std"),
                                literal(mom[f"{c}__min"], "double").alias("min"),
                                F.col(f"{c}__p25").alias("p25"),
                                F.col(f"{c}__p50").alias("p50"),
                                F.col(f"{c}__p75").alias("p75"),
                                literal(mom[f"{c}__max"], "double").alias("max"),
                            )
                            for c in nums
                        ]
                    )
                ).alias("r")
            ).select("r.*")
        )
    if cats:
        long = df.select(*[F.col(c).cast("string").alias(c) for c in cats]).unpivot(
            [], cats, "column", "value"
        )
        counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
        nn = counts.where(F.col("value").isNotNull())
        per_col = nn.groupBy("column").agg(
            F.sum("n").alias("count"),
            F.count(F.lit(1)).alias("unique"),
            F.min_by(F.struct(F.col("value"), F.col("n")), F.struct(-F.col("n"), F.col("value"))).alias("_top"),
        )
        names = df.sparkSession.createDataFrame([(c,) for c in cats], "column string")
        parts.append(
            names.join(F.broadcast(per_col), "column", "left").select(
                "column",
                F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count"),
                F.coalesce(F.col("unique"), F.lit(0)).cast("long").alias("unique"),
                F.col("_top.value").alias("top"),
                F.col("_top.n").cast("long").alias("freq"),
                *[F.lit(None).cast("double").alias(x) for x in ("mean", "std", "min", "p25", "p50", "p75", "max")],
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _three(c):
    from martkit.operators.stats import QuantileTarget

    return [QuantileTarget(f"{c}__p25", c, 0.25), QuantileTarget(f"{c}__p50", c, 0.5), QuantileTarget(f"{c}__p75", c, 0.75)]


def profile_shapes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows and columns before and after cleaning."""
    one = combine_rows(
        before.agg(F.count(F.lit(1)).alias("rows_before")),
        after.agg(F.count(F.lit(1)).alias("rows_after")),
    )
    return one.select(
        "rows_before",
        F.lit(len(before.columns)).alias("cols_before"),
        "rows_after",
        F.lit(len(after.columns)).alias("cols_after"),
    )
