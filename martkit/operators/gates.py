"""Data-quality gates (D1, D3, D4, D9, F6) as report DataFrames.

A gate is a handful of aggregates evaluated in as few passes as possible, reported
as rows ``(gate, rule, violations, passed)``.  ``enforce`` runs the report (a bounded
number of rows) and raises ``GateError`` on the driver.  Gates never hide inside a
column expression: an unselected ``assert_true`` column would be pruned away.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.contract import HOUSING, MartSpec
from martkit.errors import GateError
from martkit.operators.raw import orphans
from martkit.sources.tables import table_exists


def _any(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conds)


def _stack(gate: str, one_row: DataFrame, rules: list[str]) -> DataFrame:
    """One-row frame of per-rule violation counts -> one row per rule."""
    long = one_row.select(*[F.col(f"`{r}`").cast("long").alias(r) for r in rules]).unpivot(
        [], rules, "rule", "violations"
    )
    return long.select(
        F.lit(gate).alias("gate"),
        "rule",
        "violations",
        (F.col("violations") == 0).alias("passed"),
    )


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """A5: ``GROUP BY keys HAVING COUNT(*) > 1`` -> ``(keys..., n)`` (map-side combined)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
    )


def _per_key(df: DataFrame, key: str, *extra) -> DataFrame:
    """One shuffle: rows per key (map-side combined), plus extra per-key counters."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("_c"), *extra)


def raw_gate(raw: DataFrame, key: str = "flat_id") -> DataFrame:
    """D3 in one pass: non-empty, key not NULL, key unique (all from per-key counts)."""
    one = _per_key(raw, key).agg(
        F.when(F.coalesce(F.sum("_c"), F.lit(0)) == 0, 1).otherwise(0).alias("non_empty"),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("_c"))), F.lit(0)).alias("key_not_null"),
        F.count_if(F.col("_c") > 1).alias("key_unique"),
    )
    return _stack("raw", one, ["non_empty", "key_not_null", "key_unique"])


def business_rule_violation(spec: MartSpec = HOUSING) -> Column:
    """D9 business rule: any id NULL, target/rooms/areas NULL or <= 0, containment broken."""
    terms = [F.col(c).isNull() for c in spec.not_null]
    for c in list(spec.positive_required) + list(spec.positive):
        terms += [F.col(c).isNull(), F.col(c) <= 0]
    terms += [F.col(a) > F.col(b) for a, b in spec.contained]
    return _any(terms)


def clean_gate(clean: DataFrame, spec: MartSpec = HOUSING) -> DataFrame:
    """D9 in one pass: non-empty, key unique, business rule (floors are not part of it)."""
    one = _per_key(clean, spec.key, F.count_if(business_rule_violation(spec)).alias("_v")).agg(
        F.when(F.coalesce(F.sum("_c"), F.lit(0)) == 0, 1).otherwise(0).alias("non_empty"),
        F.count_if(F.col("_c") > 1).alias("key_unique"),
        F.coalesce(F.sum("_v"), F.lit(0)).alias("business_rules"),
    )
    return _stack("clean", one, ["non_empty", "key_unique", "business_rules"])


def clean_input_gate(df: DataFrame, *, exists: bool = True) -> DataFrame:
    """The raw mart exists and is not empty (``exists`` is checked by the caller
    on the catalog or file system, see ``require_sources``)."""
    one = df.select(F.lit(1).alias("_one")).limit(1).agg(
        F.lit(0 if exists else 1).alias("exists"),
        F.when(F.count(F.lit(1)) == 0, 1).otherwise(0).alias("non_empty"),
    )
    return _stack("clean_input", one, ["exists", "non_empty"])


def source_gate(flats: DataFrame, buildings: DataFrame) -> DataFrame:
    """No flat without a matching building (the join must not lose rows)."""
    one = orphans(flats, buildings).agg(F.count(F.lit(1)).alias("no_orphans"))
    return _stack("source", one, ["no_orphans"])


def target_gate(df: DataFrame, target: str, integral=()) -> DataFrame:
    """M1/F6 in one pass: frame non-empty; target coercible to a finite number and
    strictly positive; each ``integral`` category column holds whole numbers only."""
    from martkit.functions import is_integral

    y = F.col(target).try_cast("double") if dict(df.dtypes)[target] == "string" else F.col(target).cast("double")
    one = df.select(y.alias("_y"), *[F.col(c) for c in integral]).agg(
        F.when(F.count(F.lit(1)) == 0, 1).otherwise(0).alias("non_empty"),
        F.count_if(
            F.col("_y").isNull() | F.isnan("_y") | (F.abs("_y") == F.lit(float("inf")))
        ).alias("target_valid"),
        F.count_if(F.col("_y") <= 0).alias("target_positive"),
        *[F.count_if(~is_integral(c)).alias(f"integral:{c}") for c in integral],
    )
    rules = ["non_empty", "target_valid", "target_positive"] + [f"integral:{c}" for c in integral]
    return _stack("target", one.select(*[F.col(f"`{r}`").alias(r) for r in rules]), rules)


def feature_gate(train: DataFrame, data: DataFrame, cats, nums) -> DataFrame:
    """M3 before assembling: one report row per column and rule.

    ``empty``: rows of ``train`` if a column has no value at all (the assembler would pass it
    on as NaN); ``constant``: 1 if a numeric column holds a single value; ``unseen``: rows of
    ``data`` with a category that ``train`` never shows.  One aggregate over the columns of
    ``train``; categories are compared as distinct values, combined map-side.
    """
    columns = [*cats, *nums]
    one = train.agg(
        *[F.when(F.count(c) == 0, F.count(F.lit(1))).otherwise(0).alias(f"empty:{c}") for c in columns],
        *[F.when(F.min(c) == F.max(c), 1).otherwise(0).alias(f"constant:{c}") for c in nums])
    rules = [f"empty:{c}" for c in columns] + [f"constant:{c}" for c in nums]
    report = _stack("features", one, rules)
    if not cats:
        return report
    def shown(df):
        long = df.select(*[F.col(c).cast("string").alias(c) for c in cats]).unpivot([], list(cats), "column", "value")
        return long.where(F.col("value").isNotNull()).groupBy("column", "value")
    seen = shown(train).agg(F.lit(1).alias("_seen"))
    unseen = shown(data).agg(F.count(F.lit(1)).alias("n")).join(seen, ["column", "value"], "left_anti")
    per_column = F.array(*[F.struct(
        F.lit(f"unseen:{c}").alias("rule"), F.coalesce(F.sum(F.when(F.col("column") == c, F.col("n"))), F.lit(0)).alias("violations")) for c in cats])
    rows = unseen.agg(per_column.alias("r")).select(F.inline("r"))
    return report.unionByName(rows.select(F.lit("features").alias("gate"), "rule", "violations", (F.col("violations") == 0).alias("passed")))


def require_sources(spark: SparkSession, *names_or_paths: str) -> None:
    """Each source exists (catalog table or path), else ``GateError``."""
    missing = [n for n in names_or_paths if not table_exists(spark, n)]
    if missing:
        raise GateError("sources", [{"rule": f"exists:{m}", "violations": 1} for m in missing])


def enforce(report: DataFrame) -> list[dict]:
    """Run a gate report and raise ``GateError`` listing every failed rule."""
    rows = [r.asDict() for r in report.collect()]
    failed = [r for r in rows if not r["passed"]]
    if failed:
        raise GateError(failed[0]["gate"], failed)
    return rows
