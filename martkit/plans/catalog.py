"""Registered queries: one Spark DataFrame per operator, and its DuckDB oracle SQL.

Every query reads the driver's tables (whole tables; the housing sources are derived
row by row from ``orders`` and ``customer``), so its work grows with the data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.contract import CLEAN_SCHEMA, EXPORT_COLUMNS, HOUSING, RAW_SCHEMA
from martkit.operators import gates, profile
from martkit.operators.clean import (
    CleanStages,
    base_filter,
    build_clean,
    clean_exploratory,
    clip_iqr,
    dedup_keep_first,
)
from martkit.operators.features import as_category_strings, infer_columns, one_hot_long, prepare_features
from martkit.operators.model import ModelParams, fit, predict, regression_metrics
from martkit.operators.ordinal import ORDINAL, with_input_order
from martkit.operators.raw import build_raw, orphans
from martkit.operators.split import VALIDATION, exact_split
from martkit.operators.stats import QuantileTarget, combine_rows, feature_statistics, literal, quantile_stats, row_values
from martkit.plans import oracle as O
from martkit.sources import fixtures
from martkit.sources.snapshots import export, lookup, publish_snapshot, read_current
from martkit.sources.tables import contract_scan, place_in_ranges, range_predicates, read_csv, read_table, table_exists, table_path
from martkit.session import scratch_path, stage

SPEC = HOUSING
SEED, TEST_SIZE = 42, 0.2
# Model size of the registered queries: the operator's default, as in the flow.
MODEL = ModelParams()

# Lineitem pair key and the non-key columns used to order duplicates.
LI_KEY = ("l_orderkey", "l_linenumber")
LI_ORDER = (
    "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus",
)
LI_QUANT_COLS = ("l_extendedprice", "l_quantity", "l_discount", "l_tax")


# ------------------------------------------------------------------ Spark side


def _raw(spark, d, orphan=False) -> DataFrame:
    return build_raw(fixtures.flats(spark, d, orphans=orphan), fixtures.buildings(spark, d))


def _raw_stored(spark, d) -> DataFrame:
    """The raw mart staged once as Parquet: later stages read a stored raw mart (as they
    read the published snapshot in the flow)."""
    return stage(_raw(spark, d), "raw")


def _raw_in_order(spark, d) -> DataFrame:
    """A raw mart with shared ids, stored in the order of the flats' own file."""
    placed = with_input_order(fixtures.flats(spark, d, changed=fixtures.SHARED_ID))
    raw = build_raw(placed, fixtures.buildings(spark, d), keep=[ORDINAL])
    return stage(raw.orderBy(ORDINAL).drop(ORDINAL), "raw-in-order")


def _exploratory(raw: DataFrame) -> DataFrame:
    return clean_exploratory(raw, SPEC, materialise="stage")


def _clean(spark, d) -> DataFrame:
    return build_clean(_raw(spark, d), SPEC, materialise="stage")


def _stages(spark, d) -> CleanStages:
    return CleanStages(_raw(spark, d), SPEC, materialise="stage")


def _consistent(spark, d) -> DataFrame:
    return _stages(spark, d).consistent


def _clean_stored(spark, d) -> DataFrame:
    """The clean mart staged once, as modelling reads a published snapshot rather than
    recomputing the mart for every pass."""
    return stage(_clean(spark, d), "clean")


def _features(spark, d) -> DataFrame:
    return prepare_features(_clean_stored(spark, d), SPEC.target, key=SPEC.key)


def _split_feats(spark, d) -> DataFrame:
    return exact_split(_features(spark, d), SPEC.key, TEST_SIZE, SEED)


def q_raw_mart(spark, d):
    return _raw(spark, d)


def q_contract_export(spark, d):
    return contract_scan(_raw(spark, d), EXPORT_COLUMNS, RAW_SCHEMA)


def q_source_orphans(spark, d):
    return orphans(fixtures.flats(spark, d, orphans=True), fixtures.buildings(spark, d))


def q_source_gate_report(spark, d):
    return gates.source_gate(fixtures.flats(spark, d, orphans=True), fixtures.buildings(spark, d))


def q_raw_gate_report(spark, d):
    return gates.raw_gate(_raw(spark, d), SPEC.key)


def _raw_repeated(spark, d) -> DataFrame:
    """Raw mart with repeated and NULL flat ids."""
    return build_raw(fixtures.repeated_flats(spark, d), fixtures.buildings(spark, d))


def q_raw_gate_failing(spark, d):
    """D3 on a mart that breaks both key rules."""
    return gates.raw_gate(_raw_repeated(spark, d), SPEC.key)


def q_clean_gate_failing(spark, d):
    """D9 on the unfiltered mart: repeated ids, missing and non-positive values."""
    return gates.clean_gate(_raw_repeated(spark, d), SPEC)


def q_clean_input_gate_failing(spark, d):
    """D4 on a mart of flats whose ids are all missing: no row is left."""
    return gates.clean_input_gate(_raw(spark, d).where(F.col(SPEC.key).isNull()), exists=table_exists(spark, table_path(d, "no_such_table")))


def q_target_gate_failing(spark, d):
    """F6 / P8 / P9 on target strings that are no positive finite number."""
    text = read_table(spark, d, "orders").selectExpr("o_orderkey", f"{fixtures.TARGET_TEXT_EXPR} AS price")
    return gates.target_gate(text, SPEC.target)


def q_profile_duplicates_repeated(spark, d):
    """A7 on whole-row and key repeats: all rows of the repeated mart and its copies again."""
    raw = _raw_repeated(spark, d)
    return profile.profile_duplicates(raw.unionByName(raw.where(F.col("rooms") == 2)), SPEC.key)


def q_dedup_repeated_flats(spark, d):
    """W1 in input order: of the rows of an id the one of smallest seq stays."""
    rows = fixtures.repeated_flats(spark, d).where(F.col("id").isNotNull()).select("id", "seq", "price", "rooms", "total_area")
    return dedup_keep_first(rows, ["id"], ["seq"])


def q_clean_input_gate(spark, d):
    exists = all(table_exists(spark, table_path(d, t)) for t in ("orders", "customer"))
    return gates.clean_input_gate(_raw(spark, d), exists=exists)


def q_clean_gate_report(spark, d):
    return gates.clean_gate(_clean(spark, d), SPEC)


def q_duplicate_keys(spark, d):
    return gates.duplicate_keys(read_table(spark, d, "lineitem"), list(LI_KEY))


def q_base_filter(spark, d):
    return base_filter(_raw(spark, d))


def q_feature_statistics(spark, d):
    return feature_statistics(base_filter(_raw(spark, d)), SPEC.medians, SPEC.modes)


def q_imputed(spark, d):
    return _stages(spark, d).imputed


def q_consistent(spark, d):
    return _consistent(spark, d)


def q_iqr_bounds(spark, d):
    return _stages(spark, d).bounds


def q_clip_iqr(spark, d):
    return _stages(spark, d).capped


def q_clean_mart(spark, d):
    # the two relations read twice (F1 survivors, F2-F4 survivors) are staged once
    return _clean(spark, d)


def q_events_clip_value(spark, d):
    ev = read_table(spark, d, "events").select("event_id", "user_id", "event_type", "value")
    return clip_iqr(ev, ["value"])


def q_lineitem_clip_price(spark, d):
    li = read_table(spark, d, "lineitem").select(*LI_KEY, "l_partkey", "l_extendedprice")
    return clip_iqr(li, ["l_extendedprice"])


def q_clean_exploratory(spark, d):
    """Of the flats that share an id, the first of the stored mart stays."""
    return _exploratory(_raw_in_order(spark, d))


def _without_totals(spark, d) -> DataFrame:
    """A stored raw mart without any floor count, and with floors below zero."""
    raw = build_raw(
        fixtures.flats(spark, d, changed=fixtures.BELOW_ZERO_FLOOR), fixtures.buildings(spark, d, changed=fixtures.NO_TOTALS))
    return stage(raw, "raw-without-totals")


def q_clean_mart_no_totals(spark, d):
    """F4, published form: each bound on its own."""
    return build_clean(_without_totals(spark, d), SPEC, materialise="stage")


def q_clean_exploratory_no_totals(spark, d):
    """F4, exploratory form: bounds only where both values are present."""
    return _exploratory(_without_totals(spark, d))


def q_dedup_input_order(spark, d):
    """W1 in the order of the table's own file: each user's first event."""
    events = read_table(spark, d, "events")
    return dedup_keep_first(events.select("user_id", "event_id", "event_type", "value"), "user_id")


def q_dedup_keep_first(spark, d):
    li = read_table(spark, d, "lineitem").select(*LI_KEY, *LI_ORDER)
    return dedup_keep_first(li, list(LI_KEY), list(LI_ORDER))


def q_profile_nulls(spark, d):
    return profile.profile_nulls(_raw(spark, d))


def q_profile_nonpositive(spark, d):
    return profile.profile_nonpositive(_raw(spark, d))


def q_profile_duplicates(spark, d):
    return profile.profile_duplicates(_raw_stored(spark, d), SPEC.key)


def q_profile_outliers(spark, d):
    return profile.profile_outliers(_raw_stored(spark, d))


def q_profile_summary(spark, d):
    return profile.profile_summary(_raw_stored(spark, d))


def q_profile_info(spark, d):
    return profile.profile_info(_raw(spark, d))


def q_profile_shapes(spark, d):
    raw = _raw_in_order(spark, d)
    return profile.profile_shapes(raw, _exploratory(raw))


def _li_targets():
    out = []
    for c in LI_QUANT_COLS:
        out += [QuantileTarget(f"{c}_q1", c, 0.25), QuantileTarget(f"{c}_median", c, 0.5),
                QuantileTarget(f"{c}_q3", c, 0.75)]
    return out


def q_quantiles_distributed(spark, d):
    li = read_table(spark, d, "lineitem")
    return quantile_stats(li, _li_targets())


def q_target_gate(spark, d):
    return gates.target_gate(_clean(spark, d), SPEC.target)


def q_features(spark, d):
    return _features(spark, d)


def q_train_val_split(spark, d):
    return exact_split(_clean_stored(spark, d).select(SPEC.key), SPEC.key, TEST_SIZE, SEED)


# Columns of lineitem that repeat and hold no key.
LI_NO_KEY = ("l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus")


def q_split_no_key(spark, d):
    """O4 on a table without a key whose rows repeat: whole rows are the identity."""
    return exact_split(read_table(spark, d, "lineitem").select(*LI_NO_KEY), None, TEST_SIZE, SEED)


def q_split_repeated_ids(spark, d):
    """O4 by an id that repeats: rows of the boundary id are told apart by their values."""
    return exact_split(read_table(spark, d, "lineitem").select("l_suppkey", "l_returnflag"), "l_suppkey", TEST_SIZE, SEED)


def q_features_missing_category(spark, d):
    """P10: categories that are missing, as the raw mart has them before imputation."""
    return prepare_features(stage(base_filter(_raw(spark, d)), "base"), SPEC.target, key=SPEC.key)


def _gate_parts(spark, d) -> tuple[DataFrame, DataFrame]:
    """Feature columns of which train has an empty and a constant one, and lacks categories."""
    rows = read_table(spark, d, "lineitem").select(
        "l_returnflag", "l_linestatus", "l_quantity", F.lit(None).cast("double").alias("nothing"), F.lit(1.0).alias("same"))
    return rows.where("l_returnflag <> 'A'"), rows


def q_feature_gate_failing(spark, d):
    """M3 on columns that break each of its rules."""
    train, rows = _gate_parts(spark, d)
    return gates.feature_gate(train, rows, ["l_returnflag", "l_linestatus"], ["l_quantity", "nothing", "same"])


def q_feature_gate(spark, d):
    """M3 on the features of the split mart."""
    feats = stage(_split_feats(spark, d), "features")
    cats, nums = infer_columns(feats, exclude=("label", SPEC.key, VALIDATION))
    return gates.feature_gate(feats.where(~F.col(VALIDATION)), feats, cats, nums)


def q_lookup_snapshot(spark, d):
    """The row of the largest key, from the one file whose range holds it."""
    root = scratch_path(spark, "marts")
    manifest = publish_snapshot(_raw(spark, d), root, "raw", gates=[lambda x: gates.raw_gate(x, SPEC.key)], cluster_by=SPEC.key)
    return lookup(spark, root, "raw", max(r["high"] for r in manifest["key_ranges"]))


def q_read_in_ranges(spark, d):
    """S3: rows of each balanced key range of a table, whose keys are skewed."""
    rows = read_table(spark, d, "lineitem").selectExpr("l_suppkey * l_suppkey AS k")
    ranges = range_predicates(rows, "k", 1000)
    sizes = place_in_ranges(rows, "k", ranges).groupBy("i").agg(F.count(F.lit(1)).alias("n"), F.min("hits").alias("lo"), F.max("hits").alias("hi"))
    return sizes.agg(F.sum("n").alias("rows"), F.min("lo").alias("least_ranges"), F.max("hi").alias("most_ranges"))


def q_source_gate_failing(spark, d):
    """D1 on flats without an id and flats whose id names no building."""
    flats = fixtures.flats(spark, d, changed={"building_id": fixtures.DANGLING_BUILDING_ID_EXPR})
    return gates.source_gate(flats, fixtures.buildings(spark, d))


def q_one_hot(spark, d):
    feats = _split_feats(spark, d)
    cats, _ = infer_columns(feats, exclude=("label", SPEC.key, VALIDATION))
    data = as_category_strings(feats, cats)
    return one_hot_long(data.where(~F.col(VALIDATION)), data, cats, SPEC.key)


def q_regression_metrics(spark, d):
    """Baseline model: predict the training mean of the target."""
    feats = _split_feats(spark, d)
    mean = row_values(feats.where(~F.col(VALIDATION)).agg(F.avg("label").alias("m")))["m"]
    scored = feats.where(F.col(VALIDATION)).withColumn("prediction", literal(mean, "double"))
    m = regression_metrics(scored, rows_total=0, digits=4).drop("rows_total")
    total = feats.agg(F.count(F.lit(1)).alias("rows_total"))
    return combine_rows(m, total).select("rmse", "mae", "r2", "rows_total", "rows_val")


def q_features_from_csv(spark, d):
    from martkit.operators.features import load_features_and_target

    path = scratch_path(spark, "export") + "/dataset.csv"
    export(_clean_stored(spark, d), path, EXPORT_COLUMNS, schema=CLEAN_SCHEMA, fmt="csv")
    feats, _ = load_features_and_target(spark, path, CLEAN_SCHEMA, SPEC.target)
    return feats


def q_profile_nulls_clean_top15(spark, d):
    """Top-15 NULL counts of the exploratory-cleaned mart (the limit is the report)."""
    clean = _exploratory(_raw_in_order(spark, d))
    return profile.profile_nulls(clean, top=15)


def q_profile_duplicates_clean(spark, d):
    """Duplicates left after the exploratory cleaner (whole rows and keys)."""
    clean = _exploratory(_raw_in_order(spark, d))
    return profile.profile_duplicates(clean, SPEC.key)


def q_csv_roundtrip(spark, d):
    path = scratch_path(spark, "export") + "/dataset.csv"
    export(_clean_stored(spark, d), path, EXPORT_COLUMNS, schema=CLEAN_SCHEMA, fmt="csv")
    return read_csv(spark, path, CLEAN_SCHEMA)


def q_publish_snapshot(spark, d):
    root = scratch_path(spark, "marts")
    publish_snapshot(_raw(spark, d), root, "raw", gates=[lambda x: gates.raw_gate(x, SPEC.key)], cluster_by=SPEC.key)
    return read_current(spark, root, "raw")


def q_gbt_evaluate(spark, d, params: ModelParams = MODEL):
    feats = _split_feats(spark, d)
    train = feats.where(~F.col(VALIDATION)).drop(VALIDATION, SPEC.key)
    val = feats.where(F.col(VALIDATION)).drop(VALIDATION, SPEC.key)
    model = fit(train, params)
    n = feats.count()
    return regression_metrics(predict(model, val), rows_total=n)


def q_end_to_end_report(spark, d, params: ModelParams = MODEL):
    from martkit.plans.flow import run_flow

    res = run_flow(
        fixtures.flats(spark, d), fixtures.buildings(spark, d), scratch_path(spark, "flow"),
        params=params, sources=[table_path(d, t) for t in ("orders", "customer")],
    )
    return res.report(spark)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "clean_mart": q_clean_mart,
    "raw_mart": q_raw_mart,
    "contract_export": q_contract_export,
    "source_orphans": q_source_orphans,
    "source_gate_report": q_source_gate_report,
    "raw_gate_report": q_raw_gate_report,
    "raw_gate_failing": q_raw_gate_failing,
    "clean_gate_failing": q_clean_gate_failing,
    "clean_input_gate_failing": q_clean_input_gate_failing,
    "target_gate_failing": q_target_gate_failing,
    "profile_duplicates_repeated": q_profile_duplicates_repeated,
    "dedup_repeated_flats": q_dedup_repeated_flats,
    "clean_input_gate": q_clean_input_gate,
    "clean_gate_report": q_clean_gate_report,
    "duplicate_keys": q_duplicate_keys,
    "base_filter": q_base_filter,
    "feature_statistics": q_feature_statistics,
    "imputed": q_imputed,
    "consistent": q_consistent,
    "iqr_bounds": q_iqr_bounds,
    "clip_iqr": q_clip_iqr,
    "events_clip_value": q_events_clip_value,
    "lineitem_clip_price": q_lineitem_clip_price,
    "clean_exploratory": q_clean_exploratory,
    "dedup_keep_first": q_dedup_keep_first,
    "profile_nulls": q_profile_nulls,
    "profile_nonpositive": q_profile_nonpositive,
    "profile_duplicates": q_profile_duplicates,
    "profile_outliers": q_profile_outliers,
    "profile_summary": q_profile_summary,
    "profile_info": q_profile_info,
    "profile_shapes": q_profile_shapes,
    "clean_mart_no_totals": q_clean_mart_no_totals,
    "clean_exploratory_no_totals": q_clean_exploratory_no_totals,
    "dedup_input_order": q_dedup_input_order,
    "split_no_key": q_split_no_key,
    "split_repeated_ids": q_split_repeated_ids,
    "features_missing_category": q_features_missing_category,
    "feature_gate": q_feature_gate,
    "feature_gate_failing": q_feature_gate_failing,
    "lookup_snapshot": q_lookup_snapshot,
    "read_in_ranges": q_read_in_ranges,
    "source_gate_failing": q_source_gate_failing,
    "quantiles_distributed": q_quantiles_distributed,
    "target_gate": q_target_gate,
    "features": q_features,
    "train_val_split": q_train_val_split,
    "one_hot": q_one_hot,
    "regression_metrics": q_regression_metrics,
    "csv_roundtrip": q_csv_roundtrip,
    "features_from_csv": q_features_from_csv,
    "profile_nulls_clean_top15": q_profile_nulls_clean_top15,
    "profile_duplicates_clean": q_profile_duplicates_clean,
    "publish_snapshot": q_publish_snapshot,
    "gbt_evaluate": q_gbt_evaluate,
    "end_to_end_report": q_end_to_end_report,
}


# ----------------------------------------------------------------- oracle side

_H = O.housing_ctes()
_RAW = O.raw_ctes()
_REPEATED = [("flats", fixtures.repeated_flats_sql())] + _RAW[1:]
_NO_TOTALS = O.raw_ctes(changed=fixtures.BELOW_ZERO_FLOOR, changed_buildings=fixtures.NO_TOTALS, input_order=True)


def _w(ctes, final):
    return O.with_query(ctes, final)


def _gate_sql(gate: str, rel_ctes, rules: list[tuple[str, str]]) -> str:
    parts = [f"SELECT '{r}' AS rule, CAST(({e}) AS BIGINT) AS violations" for r, e in rules]
    body = " UNION ALL ".join(parts)
    return _w(rel_ctes, f"SELECT '{gate}' AS gate, rule, violations, violations = 0 AS passed FROM ({body}) t")


def _dups(rel, key):
    return f"SELECT count(*) FROM (SELECT {key} FROM {rel} GROUP BY {key} HAVING count(*) > 1) t"


def _biz_sql():
    terms = [f"{c} IS NULL" for c in SPEC.not_null]
    for c in list(SPEC.positive_required) + list(SPEC.positive):
        terms += [f"{c} IS NULL", f"{c} <= 0"]
    terms += [f"{a} > {b}" for a, b in SPEC.contained]
    return " OR ".join(terms)


def _raw_rules(rel: str) -> list[tuple[str, str]]:
    return [("non_empty", f"SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM {rel}"),
            ("key_not_null", f"SELECT count(*) FROM {rel} WHERE flat_id IS NULL"),
            ("key_unique", _dups(rel, "flat_id"))]


def _clean_rules(rel: str) -> list[tuple[str, str]]:
    return [("non_empty", f"SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM {rel}"),
            ("key_unique", _dups(rel, "flat_id")),
            ("business_rules", f"SELECT count(*) FROM {rel} WHERE {_biz_sql()}")]


def _quartile_row(cols, rel):
    return O.iqr_bounds_sql(cols, rel)


def _clip_sql(rel_sql, cols, clip_cols):
    bounds = O.iqr_bounds_sql(clip_cols, "src")
    sel = ", ".join(
        O.clamp_sql(f"d.{c}", f"(SELECT {c}_q1 FROM b)", f"(SELECT {c}_q3 FROM b)", 1.5) + f" AS {c}"
        if c in clip_cols else f"d.{c}"
        for c in cols
    )
    return f"WITH src AS ({rel_sql}), b AS ({bounds}) SELECT {sel} FROM src AS d"


def _exploratory_ctes(raw=None):
    raw = raw or O.raw_ctes(changed=fixtures.SHARED_ID, input_order=True)
    cols = list(SPEC.columns)
    dedup = (
        "SELECT * FROM raw WHERE flat_id IS NOT NULL "
        "QUALIFY row_number() OVER (PARTITION BY flat_id ORDER BY ord) = 1"
    )
    b = ", ".join(f"COALESCE({c}, FALSE) AS {c}" if c in SPEC.booleans else c for c in cols)
    e2 = f"SELECT {b} FROM e1 WHERE price IS NOT NULL AND price > 0 AND rooms IS NOT NULL AND rooms > 0"
    s = "SELECT " + ", ".join(f"percentile_cont(0.5) WITHIN GROUP (ORDER BY {c}) AS {c}_median" for c in SPEC.medians) + " FROM e2"
    imp = ", ".join(
        f"COALESCE(d.{c}, (SELECT {c}_median FROM es)) AS {c}" if c in SPEC.medians else f"d.{c}" for c in cols
    )
    e3 = f"SELECT {imp} FROM e2 AS d"
    e4 = f"SELECT * FROM e3 WHERE {O.consistency_sql(SPEC, floors='joint')}"
    qb = O.iqr_bounds_sql(SPEC.clips, "e4")
    qb = qb.replace(" FROM e4", ", " + ", ".join(f"count({c}) AS {c}_n" for c in SPEC.clips) + " FROM e4")
    cap = ", ".join(
        O.clamp_sql(
            f"d.{c}", f"(SELECT {c}_q1 FROM eb)", f"(SELECT {c}_q3 FROM eb)", 1.5,
            guard=f"(SELECT {c}_n FROM eb) < 4",
        ) + f" AS {c}"
        if c in SPEC.clips else f"d.{c}"
        for c in cols
    )
    e5 = f"SELECT {cap} FROM e4 AS d"
    f5 = " AND ".join(f"{a} <= {b}" for a, b in SPEC.contained)
    return raw + [("e1", dedup), ("e2", e2), ("es", s), ("e3", e3), ("e4", e4), ("eb", qb),
                   ("e5", e5), ("explo", f"SELECT * FROM e5 WHERE {f5}")]


_DOUBLES = {f.name for f in RAW_SCHEMA.fields if f.dataType.simpleString() == "double"}
_NUMS = [f.name for f in RAW_SCHEMA.fields if f.dataType.simpleString() != "boolean"]
_BOOLS = [f.name for f in RAW_SCHEMA.fields if f.dataType.simpleString() == "boolean"]


def _nulls_sql():
    parts = []
    for c in EXPORT_COLUMNS:
        cond = f"{c} IS NULL OR isnan({c})" if c in _DOUBLES else f"{c} IS NULL"
        parts.append(f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {cond}) AS nulls FROM raw")
    return _w(_RAW, " UNION ALL ".join(parts))


def _nonpos_sql():
    parts = [
        f"SELECT '{c}_nonpositive' AS \"check\", count(*) FILTER (WHERE {c} <= 0) AS n FROM raw"
        for c in profile.NONPOSITIVE_COLUMNS
    ]
    return _w(_RAW, " UNION ALL ".join(parts))


def _outliers_sql():
    parts = []
    for c in profile.OUTLIER_COLUMNS:
        q1 = f"percentile_cont(0.25) WITHIN GROUP (ORDER BY {c})"
        q3 = f"percentile_cont(0.75) WITHIN GROUP (ORDER BY {c})"
        parts.append(
            f"SELECT '{c}' AS feature, q.lo AS iqr_lo, q.hi AS iqr_hi, "
            f"(SELECT count(*) FROM raw WHERE {c} < q.lo OR {c} > q.hi) AS outliers_cnt, "
            f"round(CAST(100.0 AS DOUBLE) * (SELECT count(*) FROM raw WHERE {c} < q.lo OR {c} > q.hi) "
            f"/ (SELECT count(*) FROM raw), 2) AS outliers_pct "
            f"FROM (SELECT {q1} - 1.5 * ({q3} - {q1}) AS lo, {q3} + 1.5 * ({q3} - {q1}) AS hi FROM raw) q"
        )
    return _w(_RAW, " UNION ALL ".join(parts))


def _summary_sql():
    parts = []
    for c in _NUMS:
        parts.append(
            f"SELECT '{c}' AS \"column\", count({c}) AS count, CAST(NULL AS BIGINT) AS \"unique\", "
            f"CAST(NULL AS VARCHAR) AS top, CAST(NULL AS BIGINT) AS freq, "
            f"round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, "
            f"CAST(min({c}) AS DOUBLE) AS min, "
            f"percentile_cont(0.25) WITHIN GROUP (ORDER BY {c}) AS p25, "
            f"percentile_cont(0.5) WITHIN GROUP (ORDER BY {c}) AS p50, "
            f"percentile_cont(0.75) WITHIN GROUP (ORDER BY {c}) AS p75, "
            f"CAST(max({c}) AS DOUBLE) AS max FROM raw"
        )
    for c in _BOOLS:
        v = f"CAST({c} AS VARCHAR)"
        parts.append(
            f"SELECT '{c}' AS \"column\", count({c}) AS count, count(DISTINCT {c}) AS \"unique\", "
            f"(SELECT {v} FROM raw WHERE {c} IS NOT NULL GROUP BY {v} ORDER BY count(*) DESC, {v} LIMIT 1) AS top, "
            f"(SELECT count(*) FROM raw WHERE {c} IS NOT NULL GROUP BY {v} ORDER BY count(*) DESC, {v} LIMIT 1) AS freq, "
            f"CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS std, CAST(NULL AS DOUBLE) AS min, "
            f"CAST(NULL AS DOUBLE) AS p25, CAST(NULL AS DOUBLE) AS p50, CAST(NULL AS DOUBLE) AS p75, "
            f"CAST(NULL AS DOUBLE) AS max FROM raw"
        )
    return _w(_RAW, " UNION ALL ".join(parts))


def _info_sql():
    parts = [
        f"SELECT '{f.name}' AS \"column\", '{f.dataType.simpleString()}' AS dtype, count({f.name}) AS non_null FROM raw"
        for f in RAW_SCHEMA.fields
    ]
    return _w(_RAW, " UNION ALL ".join(parts))


def _li_quant_sql():
    sel = []
    for t in _li_targets():
        sel.append(f"percentile_cont({t.p}) WITHIN GROUP (ORDER BY {t.column}) AS {t.name}")
    return f"SELECT {', '.join(sel)} FROM lineitem"


def _feature_select(rel="clean"):
    cols = ["flat_id", "CAST(price AS DOUBLE) AS label"]
    for c in EXPORT_COLUMNS:
        if c in ("flat_id", "building_id", "price"):
            continue
        if c in ("building_type_int",):
            cols.append(f"COALESCE(CAST(CAST({c} AS BIGINT) AS VARCHAR), '__missing__') AS {c}")
        else:
            cols.append(c)
    return f"SELECT {', '.join(cols)} FROM {rel}"


def _split_cte(rel="clean"):
    return (
        f"SELECT flat_id, row_number() OVER (ORDER BY md5('{SEED}:' || CAST(flat_id AS VARCHAR)), flat_id) "
        f"<= (SELECT CEIL(count(*) * CAST({TEST_SIZE} AS DOUBLE)) FROM {rel}) AS is_validation FROM {rel}"
    )


_ONEHOT_CATS = ("is_apartment", "studio", "building_type_int", "has_elevator")


def _one_hot_sql():
    ctes = _H + [("feats", _feature_select()), ("sp", _split_cte())]
    fc = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in _ONEHOT_CATS)
    ctes.append(("fs", f"SELECT f.flat_id, {fc}, s.is_validation FROM feats f JOIN sp s USING (flat_id)"))
    cats = " UNION ALL ".join(
        f"SELECT DISTINCT '{c}' AS col, {c} AS val FROM fs WHERE NOT is_validation" for c in _ONEHOT_CATS
    )
    ctes.append(("cats", cats))
    ctes.append(("cat_list", "SELECT list(struct_pack(col := col, val := val)) AS l FROM cats"))
    match = " OR ".join(f"(x.col = '{c}' AND f.{c} = x.val)" for c in _ONEHOT_CATS)
    return _w(
        ctes,
        "SELECT flat_id, z.feature AS feature, z.value AS value FROM ("
        "SELECT f.flat_id, unnest(list_transform((SELECT l FROM cat_list), lambda x: struct_pack("
        "feature := x.col || '=' || x.val, "
        f"value := CASE WHEN {match} THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END))) AS z "
        "FROM fs f) t",
    )


def _metrics_sql():
    ctes = _H + [("feats", _feature_select()), ("sp", _split_cte())]
    ctes.append(("j", "SELECT f.label, s.is_validation FROM feats f JOIN sp s USING (flat_id)"))
    ctes.append(("m", "SELECT avg(label) AS prediction FROM j WHERE NOT is_validation"))
    ctes.append(("v", "SELECT j.label, (SELECT prediction FROM m) AS prediction FROM j WHERE j.is_validation"))
    return _w(
        ctes,
        "SELECT round(sqrt(avg((label - prediction) * (label - prediction))), 4) AS rmse, "
        "round(avg(abs(label - prediction)), 4) AS mae, "
        "round(CASE WHEN var_pop(label) * count(*) = 0 THEN CASE WHEN sum((label - prediction) * (label - prediction)) = 0 THEN 1.0 ELSE 0.0 END "
        "ELSE 1 - sum((label - prediction) * (label - prediction)) / (var_pop(label) * count(*)) END, 4) AS r2, "
        "(SELECT count(*) FROM feats) AS rows_total, count(*) AS rows_val FROM v",
    )


def _feature_gate_sql(rel_ctes, train: str, rows: str, cats, nums):
    rules = [(f"empty:{c}", f"SELECT CASE WHEN count({c}) = 0 THEN count(*) ELSE 0 END FROM {train}") for c in [*cats, *nums]]
    rules += [(f"constant:{c}", f"SELECT CASE WHEN min({c}) = max({c}) THEN 1 ELSE 0 END FROM {train}") for c in nums]
    rules += [(f"unseen:{c}", f"SELECT count(*) FROM {rows} WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {c} FROM {train} WHERE {c} IS NOT NULL)") for c in cats]
    return _gate_sql("features", rel_ctes, rules)


def _split_rows_sql(columns, identity: str) -> str:
    """Equal rows are interchangeable, so any order among them gives the same relation."""
    names = ", ".join(columns)
    return (
        f"WITH r AS (SELECT {names}, {identity} AS id FROM lineitem), h AS (SELECT *, md5('{SEED}:' || CAST(id AS VARCHAR)) AS h, "
        f"{_row_identity_sql(columns)} AS w FROM r) SELECT {names}, row_number() OVER (ORDER BY h, id, md5('{SEED}:' || w), w) <= "
        f"(SELECT CEIL(count(*) * CAST({TEST_SIZE} AS DOUBLE)) FROM h) AS is_validation FROM h"
    )


def _row_identity_sql(columns) -> str:
    parts = [f"sha256(COALESCE('=' || CAST({c} AS VARCHAR), ''))" for c in sorted(columns)]
    return f"sha256({' || '.join(parts)})"


def _e2e_sql():
    ctes = _H + [("sp", _split_cte())]
    return _w(
        ctes,
        "SELECT 'raw' AS stage, (SELECT count(*) FROM flats) AS rows_in, (SELECT count(*) FROM raw) AS rows_out, TRUE AS passed "
        "UNION ALL SELECT 'clean', (SELECT count(*) FROM raw), (SELECT count(*) FROM clean), TRUE "
        "UNION ALL SELECT 'export', (SELECT count(*) FROM clean), (SELECT count(*) FROM clean), TRUE "
        "UNION ALL SELECT 'split', (SELECT count(*) FROM clean), (SELECT count(*) FROM sp WHERE is_validation), TRUE "
        "UNION ALL SELECT 'model', (SELECT count(*) FROM sp WHERE NOT is_validation), (SELECT count(*) FROM sp WHERE is_validation), TRUE",
    )


def oracle_sql() -> dict[str, str]:
    ec = ", ".join(EXPORT_COLUMNS)
    q = {
        "clean_mart": _w(_H, "SELECT * FROM clean"),
        "raw_mart": _w(_RAW, "SELECT * FROM raw"),
        "contract_export": _w(_RAW, f"SELECT {ec} FROM raw"),
        "source_orphans": _w(
            O.raw_ctes(orphans=True)[:2],
            "SELECT f.* FROM flats f WHERE NOT EXISTS (SELECT 1 FROM buildings b WHERE b.id = f.building_id)",
        ),
        "source_gate_report": _gate_sql(
            "source", O.raw_ctes(orphans=True)[:2],
            [("no_orphans", "SELECT count(*) FROM flats f LEFT JOIN buildings b ON b.id = f.building_id WHERE b.id IS NULL")],
        ),
        "raw_gate_report": _gate_sql(
            "raw", _RAW, _raw_rules("raw"),
        ),
        "raw_gate_failing": _gate_sql("raw", _REPEATED, _raw_rules("raw")),
        "clean_gate_failing": _gate_sql("clean", _REPEATED, _clean_rules("raw")),
        "clean_input_gate_failing": _gate_sql(
            "clean_input", _RAW,
            [("exists", "SELECT 1"),
             ("non_empty", "SELECT CASE WHEN EXISTS (SELECT 1 FROM raw WHERE flat_id IS NULL) THEN 0 ELSE 1 END")],
        ),
        "target_gate_failing": _gate_sql(
            "target", [("t0", f"SELECT TRY_CAST({fixtures.TARGET_TEXT_EXPR} AS DOUBLE) AS price FROM orders")],
            [("non_empty", "SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM t0"),
             ("target_valid", "SELECT count(*) FROM t0 WHERE price IS NULL OR isnan(price) OR isinf(price)"),
             ("target_positive", "SELECT count(*) FROM t0 WHERE price <= 0")],
        ),
        "profile_duplicates_repeated": _w(
            _REPEATED + [("twice", "SELECT * FROM raw UNION ALL SELECT * FROM raw WHERE rooms = 2")],
            "SELECT (SELECT count(*) FROM twice) - (SELECT count(*) FROM (SELECT DISTINCT * FROM twice) t) AS dup_all, "
            "(SELECT CAST(COALESCE(sum(c - 1), 0) AS BIGINT) FROM (SELECT count(*) AS c FROM twice GROUP BY flat_id) t) AS dup_flat_id",
        ),
        "dedup_repeated_flats": (
            f"SELECT id, seq, price, rooms, total_area FROM ({fixtures.repeated_flats_sql()}) t WHERE id IS NOT NULL "
            "QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq) = 1"
        ),
        "clean_input_gate": _gate_sql(
            "clean_input", _RAW,
            [("exists", "SELECT 0"),
             ("non_empty", "SELECT CASE WHEN EXISTS (SELECT 1 FROM raw) THEN 0 ELSE 1 END")],
        ),
        "clean_gate_report": _gate_sql(
            "clean", _H, _clean_rules("clean"),
        ),
        "duplicate_keys": "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem "
        "GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1",
        "base_filter": _w(_H, "SELECT * FROM base"),
        "feature_statistics": _w(_H, "SELECT * FROM fstats"),
        "imputed": _w(_H, "SELECT * FROM imputed"),
        "consistent": _w(_H, "SELECT * FROM consistent"),
        "iqr_bounds": _w(_H, "SELECT * FROM bounds"),
        "clip_iqr": _w(_H, "SELECT * FROM capped"),
        "events_clip_value": _clip_sql(
            "SELECT event_id, user_id, event_type, value FROM events",
            ["event_id", "user_id", "event_type", "value"], ["value"],
        ),
        "lineitem_clip_price": _clip_sql(
            "SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem",
            ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"], ["l_extendedprice"],
        ),
        "clean_exploratory": _w(_exploratory_ctes(), "SELECT * FROM explo"),
        "clean_exploratory_no_totals": _w(_exploratory_ctes(_NO_TOTALS), "SELECT * FROM explo"),
        "clean_mart_no_totals": _w(_NO_TOTALS + O.clean_ctes(), "SELECT * FROM clean"),
        "dedup_input_order": (
            "WITH e AS (SELECT user_id, event_id, event_type, value, row_number() OVER () AS ord FROM events) "
            "SELECT user_id, event_id, event_type, value FROM e QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ord) = 1"
        ),
        "split_no_key": _split_rows_sql(LI_NO_KEY, _row_identity_sql(LI_NO_KEY)),
        "split_repeated_ids": _split_rows_sql(("l_suppkey", "l_returnflag"), "l_suppkey"),
        "features_missing_category": _w(_H, _feature_select("base")),
        "feature_gate": _feature_gate_sql(
            _H + [("f0", _feature_select()), ("sp", _split_cte()),
                  ("data", "SELECT f0.*, sp.is_validation FROM f0 JOIN sp USING (flat_id)"),
                  ("train", "SELECT * FROM data WHERE NOT is_validation")],
            "train", "data", _ONEHOT_CATS, [c for c in EXPORT_COLUMNS if c not in (*_ONEHOT_CATS, "flat_id", "building_id", "price")],
        ),
        "feature_gate_failing": _feature_gate_sql(
            [("data", "SELECT l_returnflag, l_linestatus, l_quantity, CAST(NULL AS DOUBLE) AS nothing, 1.0 AS same FROM lineitem"),
             ("train", "SELECT * FROM data WHERE l_returnflag <> 'A'")],
            "train", "data", ("l_returnflag", "l_linestatus"), ("l_quantity", "nothing", "same"),
        ),
        "lookup_snapshot": _w(_RAW, "SELECT * FROM raw WHERE flat_id = (SELECT max(flat_id) FROM raw)"),
        "read_in_ranges": "SELECT count(*) AS rows, CAST(1 AS INTEGER) AS least_ranges, CAST(1 AS INTEGER) AS most_ranges FROM lineitem",
        "source_gate_failing": _gate_sql(
            "source", O.raw_ctes(changed={"building_id": fixtures.DANGLING_BUILDING_ID_EXPR})[:2],
            [("no_orphans", "SELECT count(*) FROM flats f LEFT JOIN buildings b ON b.id = f.building_id WHERE b.id IS NULL")],
        ),
        "dedup_keep_first": (
            f"SELECT {', '.join(LI_KEY + LI_ORDER)} FROM lineitem QUALIFY row_number() OVER ("
            f"PARTITION BY {', '.join(LI_KEY)} ORDER BY "
            + ", ".join(f"{c} ASC NULLS FIRST" for c in LI_ORDER) + ") = 1"
        ),
        "profile_nulls": _nulls_sql(),
        "profile_nonpositive": _nonpos_sql(),
        "profile_duplicates": _w(
            _RAW,
            "SELECT (SELECT count(*) FROM raw) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw) t) AS dup_all, "
            "(SELECT CAST(COALESCE(sum(c - 1), 0) AS BIGINT) FROM (SELECT count(*) AS c FROM raw GROUP BY flat_id) t) AS dup_flat_id",
        ),
        "profile_outliers": _outliers_sql(),
        "profile_summary": _summary_sql(),
        "profile_info": _info_sql(),
        "profile_shapes": _w(
            _exploratory_ctes(),
            f"SELECT (SELECT count(*) FROM raw) AS rows_before, {len(EXPORT_COLUMNS)} AS cols_before, "
            f"(SELECT count(*) FROM explo) AS rows_after, {len(EXPORT_COLUMNS)} AS cols_after",
        ),
        "quantiles_distributed": _li_quant_sql(),
        "target_gate": _gate_sql(
            "target", _H,
            [("non_empty", "SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM clean"),
             ("target_valid", "SELECT count(*) FROM clean WHERE price IS NULL OR isnan(price) OR isinf(price)"),
             ("target_positive", "SELECT count(*) FROM clean WHERE price <= 0")],
        ),
        "features": _w(_H, _feature_select()),
        "train_val_split": _w(_H, _split_cte()),
        "one_hot": _one_hot_sql(),
        "regression_metrics": _metrics_sql(),
        "csv_roundtrip": _w(_H, "SELECT * FROM clean"),
        "features_from_csv": _w(_H, _feature_select()),
        "profile_duplicates_clean": _w(
            _exploratory_ctes(),
            "SELECT (SELECT count(*) FROM explo) - (SELECT count(*) FROM (SELECT DISTINCT * FROM explo) t) AS dup_all, "
            "(SELECT CAST(COALESCE(sum(c - 1), 0) AS BIGINT) FROM (SELECT count(*) AS c FROM explo GROUP BY flat_id) t) AS dup_flat_id",
        ),
        "profile_nulls_clean_top15": _w(
            _exploratory_ctes(),
            " UNION ALL ".join(
                f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL"
                + (f" OR isnan({c})" if c in _DOUBLES or c in ("floor", "build_year", "flats_count", "floors_total") else "")
                + ") AS nulls FROM explo"
                for c in EXPORT_COLUMNS
            )
            + ' ORDER BY nulls DESC, "column" LIMIT 15',
        ),
        "publish_snapshot": _w(_RAW, "SELECT * FROM raw"),
        "end_to_end_report": _e2e_sql(),
    }
    return q
