"""D5-D8 (published cleaning), D10 (exploratory cleaning) and W1 (keep-first dedup).

Order of the published semantics (do not reorder): F1 -> medians/mode on F1 survivors
-> impute -> F2-F4 -> quartiles on those survivors -> cap with the pre-cap quartiles
-> F5.  Each statistics relation is one row, computed once and used as literals:
the cleaning plan itself is scan -> filter -> project, inside one codegen stage.
"""

from __future__ import annotations

from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkit.contract import HOUSING, MartSpec, check_has
from martkit.functions import (
    bool_default,
    clamp_iqr,
    contained,
    floor_rule_independent,
    floor_rule_joint,
    not_null_positive,
)
from martkit.operators.ordinal import ORDINAL, with_input_order
from martkit.operators.stats import combine_rows, feature_statistics, literal, medians, quantile_stats, quartiles, row_values
from martkit.session import stage
from martkit.sources.tables import normalise_nan


def _all(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds) if conds else F.lit(True)


def _materialise(df: DataFrame, how: str | None, name: str) -> DataFrame:
    """Store ``df`` once: ``stage`` (Parquet in the shared folder) or ``persist``."""
    if how is None:
        return df
    if how == "persist":
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    if how == "stage":
        return stage(df, name)
    raise ValueError(f"unknown materialise option {how!r}")


# -------------------------------------------------------------- published


def base_filter(raw: DataFrame, spec: MartSpec = HOUSING) -> DataFrame:
    """contract columns; ids non-null; target and rooms non-null and > 0."""
    conds = [F.col(c).isNotNull() for c in spec.not_null]
    conds += [not_null_positive(c) for c in spec.positive_required]
    return raw.select(*spec.columns).where(_all(conds))


def impute(
    base: DataFrame,
    spec: MartSpec = HOUSING,
    *,
    stats: DataFrame | None = None,
    quantile_mode: str = "exact",
) -> DataFrame:
    """Median / mode / FALSE defaults; ids and target are never imputed."""
    if stats is None:
        stats = feature_statistics(base, spec.medians, spec.modes, quantile_mode=quantile_mode)
    s = row_values(stats)
    types = dict((f.name, f.dataType) for f in base.schema.fields)
    cols = []
    for c in spec.columns:
        if c in spec.medians:
            cols.append(F.coalesce(F.col(c), literal(s[f"{c}_median"], "double")).alias(c))
        elif c in spec.modes:
            cols.append(F.coalesce(F.col(c), literal(s[f"{c}_mode"], types[c])).alias(c))
        elif c in spec.booleans:
            cols.append(bool_default(c).alias(c))
        else:
            cols.append(F.col(c))
    return base.select(*cols)


def consistency_condition(spec: MartSpec = HOUSING, *, floors: str = "independent") -> Column:
    conds = [F.col(c) > 0 for c in spec.positive]
    conds += [contained(a, b) for a, b in spec.contained]
    if spec.floor_rule is not None:
        rule = floor_rule_independent if floors == "independent" else floor_rule_joint
        conds.append(rule(*spec.floor_rule))
    return _all(conds)


def filter_consistent(df: DataFrame, spec: MartSpec = HOUSING) -> DataFrame:
    """F2 positive areas, F3 containment, F4 floor bounds (NULL passes)."""
    return df.where(consistency_condition(spec))


def clip_iqr(
    df: DataFrame,
    columns,
    k: float = 1.5,
    *,
    min_rows: int | None = None,
    quantile_mode: str = "exact",
    bounds: DataFrame | None = None,
) -> DataFrame:
    """Cap each column to ``[q1 - k*IQR, q3 + k*IQR]`` of its non-null values.

    No cap when the quartiles are NULL or ``q3 <= q1``, or (``min_rows``) when the
    column has fewer non-null values.  NULL values stay NULL.  All columns are capped
    with the quartiles of the input (not of partly capped data).
    """
    columns = list(columns)
    if bounds is None:
        bounds = quantile_stats(df, quartiles(columns), quantile_mode)
    if min_rows is not None:
        bounds = combine_rows(bounds, df.agg(*[F.count(c).alias(f"{c}_n") for c in columns]))
    b = row_values(bounds)
    out = []
    for c in df.columns:
        if c in columns:
            q1, q3 = literal(b[f"{c}_q1"], "double"), literal(b[f"{c}_q3"], "double")
            guard = F.lit(b[f"{c}_n"] < min_rows) if min_rows is not None else None
            out.append(clamp_iqr(c, q1, q3, k, guard).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def containment_filter(df: DataFrame, spec: MartSpec = HOUSING) -> DataFrame:
    """containment again after capping."""
    return df.where(_all([contained(a, b) for a, b in spec.contained]))


class CleanStages:
    """D5-D8 step by step; each stage is built on first use, once.

    With ``materialise`` the two relations that feed both a statistics pass and the
    next step (F1 survivors, F2-F4 survivors) are stored once.
    """

    def __init__(self, raw: DataFrame, spec: MartSpec = HOUSING, *, quantile_mode: str = "exact",
                 materialise: str | None = None):
        self.raw, self.spec, self.mode, self.how = raw, spec, quantile_mode, materialise
        self._cache: dict = {}

    def _once(self, name, build):
        if name not in self._cache:
            self._cache[name] = build()
        return self._cache[name]

    @property
    def base(self) -> DataFrame:
        return self._once("base", lambda: _materialise(base_filter(self.raw, self.spec), self.how, "base"))

    @property
    def stats(self) -> DataFrame:
        return self._once(
            "stats", lambda: feature_statistics(self.base, self.spec.medians, self.spec.modes, quantile_mode=self.mode))

    @property
    def imputed(self) -> DataFrame:
        return self._once("imputed", lambda: impute(self.base, self.spec, stats=self.stats))

    @property
    def consistent(self) -> DataFrame:
        return self._once(
            "consistent", lambda: _materialise(filter_consistent(self.imputed, self.spec), self.how, "consistent"))

    @property
    def bounds(self) -> DataFrame:
        return self._once("bounds", lambda: quantile_stats(self.consistent, quartiles(self.spec.clips), self.mode))

    @property
    def capped(self) -> DataFrame:
        return self._once(
            "capped", lambda: clip_iqr(self.consistent, self.spec.clips, self.spec.iqr_k, bounds=self.bounds)
        )

    @property
    def clean(self) -> DataFrame:
        return self._once("clean", lambda: containment_filter(self.capped, self.spec))


def build_clean(
    raw: DataFrame,
    spec: MartSpec = HOUSING,
    *,
    quantile_mode: str = "exact",
    materialise: str | None = None,
) -> DataFrame:
    """The published clean mart.

    ``materialise`` ("persist" | "stage") stores the two relations that feed both a
    statistics pass and the next step (F1 survivors, F2-F4 survivors), so an expensive
    input (e.g. the source join) is computed once instead of once per use.  Leave it
    off when ``raw`` is a stored snapshot: every step after it is row-local with
    literal statistics, and re-scanning pruned Parquet columns is cheaper than
    writing two copies of the mart.
    """
    return CleanStages(raw, spec, quantile_mode=quantile_mode, materialise=materialise).clean


# ---------------------------------------------------------- W1 keep-first dedup


def dedup_keep_first(df: DataFrame, keys, order_by=None) -> DataFrame:
    """One row per key — the first in ``order_by`` order, or in the order of the files
    that ``df`` scans if none is given (``ordinal.with_input_order``).

    Rows tied on it are decided by the remaining columns from left to right, smaller
    values first and NULLs last, so the result is deterministic and a filled copy beats
    an empty one.  An order made of key columns alone decides nothing and is refused.

    Keys are counted first, which shuffles one small row per key and task.  Rows of keys
    that occur once pass through; only rows of repeated keys are compared, by a grouped
    ``min`` over a struct led by the order columns rather than a ``row_number`` window: the
    aggregate combines map-side, so a key holding a large share of the rows never lands in
    one task as rows.  ``df`` is read three times; stage an expensive one first.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    names = df.columns
    if order_by is None:
        df, order_by = with_input_order(df), [ORDINAL]
    order_by = [order_by] if isinstance(order_by, str) else list(order_by)
    if not order_by:
        raise ValueError("keep-first de-duplication needs an order column")
    if set(order_by) <= set(keys):
        raise ValueError("the order of keep-first de-duplication needs a column besides the key")
    order_by = [c for c in order_by if c not in keys]
    rest = [c for c in names if c not in keys and c not in order_by]
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    repeated = repeated.select(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)])
    same = _all([F.col(k).eqNullSafe(F.col(f"_key_{i}")) for i, k in enumerate(keys)])
    single = df.join(repeated, same, "left_anti").select(*names)
    fill = [x for c in rest for x in (F.col(c).isNull().alias(f"_null_{c}"), F.col(c))]
    packed = F.struct(*[F.col(c) for c in order_by], *fill)
    first = df.join(repeated, same, "left_semi").groupBy(*keys).agg(F.min(packed).alias("_first"))
    first = first.select(*[F.col(c) if c in keys else F.col(f"_first.{c}").alias(c) for c in names])
    return single.unionByName(first)


# -------------------------------------------------------- exploratory


def clean_exploratory(
    df: DataFrame,
    spec: MartSpec = HOUSING,
    *,
    order_by=None,
    quantile_mode: str = "exact",
    materialise: str | None = None,
) -> DataFrame:
    """The exploratory cleaner.  Differences from ``build_clean``: six required
    columns (others optional), NaN is missing, keep-first dedup before the target
    filter, no mode imputation, joint floor rule, no capping below 4 values.  "First" is
    by ``order_by``, or by the order of the files that ``df`` scans if it is not given.
    ``materialise`` stores the two relations read twice (as in ``build_clean``)."""
    check_has(df, spec.required, what="frame to clean")
    key = spec.key
    if order_by is None:
        df, order_by = with_input_order(df), ORDINAL
    r = normalise_nan(df).where(F.col(key).isNotNull())
    r = dedup_keep_first(r, key, order_by).drop(ORDINAL)
    bools = [c for c in spec.booleans if c in r.columns]
    if bools:
        r = r.select(*[bool_default(c).alias(c) if c in bools else F.col(c) for c in r.columns])
    r = r.where(_all([not_null_positive(c) for c in dict.fromkeys((spec.target, *spec.positive_required))]))
    meds = [c for c in spec.medians if c in r.columns]
    r = _materialise(r, materialise, "exploratory-base")
    if meds:
        s = row_values(quantile_stats(r, medians(meds), quantile_mode))
        r = r.select(
            *[F.coalesce(F.col(c), literal(s[f"{c}_median"], "double")).alias(c) if c in meds else F.col(c)
              for c in r.columns]
        )
    r = r.where(_all([F.col(c) > 0 for c in spec.positive]))
    r = r.where(_all([contained(a, b) for a, b in spec.contained]))
    if spec.floor_rule is not None and set(spec.floor_rule).issubset(r.columns):
        r = r.where(floor_rule_joint(*spec.floor_rule))
    r = _materialise(r, materialise, "exploratory-consistent")
    r = clip_iqr(r, spec.clips, spec.iqr_k, min_rows=4, quantile_mode=quantile_mode)
    return containment_filter(r, spec)

