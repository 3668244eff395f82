"""Snapshots, export, features, one-hot, model and metrics."""

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from martkit.contract import CLEAN_SCHEMA, EXPORT_COLUMNS
from martkit.errors import ContractError, GateError
from martkit.operators import gates
from martkit.operators.clean import build_clean
from martkit.operators.features import (
    as_category_strings,
    encoding_stages,
    infer_columns,
    one_hot_long,
    prepare_features,
)
from martkit.operators.model import ModelParams, fit, load_model, predict, regression_metrics, save_model, write_metrics
from martkit.operators.raw import build_raw
from martkit.operators.split import train_validation
from martkit.sources import fixtures
from martkit.sources.snapshots import current_manifest, export, publish_snapshot, read_current
from martkit.sources.tables import jdbc_read_options, qualified_name, read_csv, table_exists


@pytest.fixture(scope="module")
def clean(spark, sf001):
    raw = build_raw(fixtures.flats(spark, sf001), fixtures.buildings(spark, sf001))
    return build_clean(raw).persist()


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_publish_then_failed_run_keeps_previous(spark, clean, scratch):
    m1 = publish_snapshot(clean, scratch, "clean", gates=[gates.clean_gate], cluster_by="flat_id")
    assert m1["rows"] == 1165
    assert same(read_current(spark, scratch, "clean"), clean)
    bad = clean.withColumn("price", F.lit(-1.0))
    with pytest.raises(GateError, match="business_rules"):
        publish_snapshot(bad, scratch, "clean", gates=[gates.clean_gate])
    assert current_manifest(spark, scratch, "clean")["run_id"] == m1["run_id"]
    assert same(read_current(spark, scratch, "clean"), clean)
    # the staged folder of the failed run was removed
    assert not any(p.startswith("v=") and p != f"v={m1['run_id']}" for p in _ls(spark, f"{scratch}/clean"))


def _ls(spark, path):
    from martkit.sources.files import names

    return names(spark, path)


def test_publish_row_count_check(spark, clean, scratch):
    with pytest.raises(GateError, match="row_count"):
        publish_snapshot(clean, scratch, "c2", expected_rows=1)
    assert current_manifest(spark, scratch, "c2") is None


def test_read_current_without_snapshot(spark, scratch):
    with pytest.raises(GateError, match="exists"):
        read_current(spark, scratch, "nothing")


def test_export_counts_its_rows_and_keeps_the_previous_one(spark, clean, scratch, monkeypatch):
    from martkit.sources import snapshots

    path, n = f"{scratch}/counted", clean.count()
    first = export(clean, path, EXPORT_COLUMNS, schema=CLEAN_SCHEMA, fmt="parquet", expected_rows=n)
    assert first["rows"] == n
    with pytest.raises(GateError):  # a short write
        export(clean.limit(5), path, EXPORT_COLUMNS, schema=CLEAN_SCHEMA, fmt="parquet", expected_rows=n)
    assert spark.read.parquet(path).count() == n

    class Failing:  # a file system whose move into the target fails once
        def __init__(self, fs):
            self.fs = fs

        def rename(self, a, b):
            return False if ".tmp-" in a.toString() else self.fs.rename(a, b)

        def __getattr__(self, name):
            return getattr(self.fs, name)

    real = snapshots.replace
    monkeypatch.setattr(snapshots, "replace", lambda fs, a, b: real(Failing(fs), a, b))
    with pytest.raises(RuntimeError):
        export(clean.limit(5), path, EXPORT_COLUMNS, schema=CLEAN_SCHEMA, fmt="parquet")
    assert spark.read.parquet(path).count() == n


def test_export_csv_roundtrip_and_atomic_replace(spark, clean, scratch):
    path = f"{scratch}/dataset.csv"
    export(clean, path, EXPORT_COLUMNS, schema=CLEAN_SCHEMA)
    back = read_csv(spark, path, CLEAN_SCHEMA)
    assert same(back, clean.select(*EXPORT_COLUMNS))
    with pytest.raises(GateError, match="non_empty"):
        export(clean.limit(0), path, EXPORT_COLUMNS, schema=CLEAN_SCHEMA)
    assert same(read_csv(spark, path, CLEAN_SCHEMA), clean.select(*EXPORT_COLUMNS))
    assert table_exists(spark, path)
    with pytest.raises(ContractError):
        export(clean.drop("price"), f"{scratch}/x.csv", EXPORT_COLUMNS)


def test_csv_header_must_match(spark, clean, scratch):
    path = f"{scratch}/h.csv"
    export(clean, path, EXPORT_COLUMNS, schema=CLEAN_SCHEMA)
    swapped = CLEAN_SCHEMA.fieldNames()
    swapped[0], swapped[1] = swapped[1], swapped[0]
    from pyspark.sql import types as T

    schema = T.StructType([CLEAN_SCHEMA[n] for n in swapped])
    with pytest.raises(Exception):
        read_csv(spark, path, schema).collect()


def test_qualified_name_and_jdbc_options(spark):
    assert qualified_name("flats") == "`public`.`flats`"
    assert qualified_name("s.t") == "`s`.`t`"
    for bad in ("a.b.c", "1x", "x;drop", ""):
        with pytest.raises(ValueError):
            qualified_name(bad)
    o = jdbc_read_options("jdbc:postgresql://h/db", "public.t", chunk_size=500,
                          partition_column="flat_id", lower_bound=1, upper_bound=10, num_partitions=4)
    assert o["fetchsize"] == "500" and o["numPartitions"] == "4" and o["dbtable"] == '"public"."t"'
    with pytest.raises(ValueError):
        jdbc_read_options("u", "t", chunk_size=0)


def test_prepare_features_types_and_gates(spark, clean):
    f = prepare_features(clean)
    cats, nums = infer_columns(f)
    assert cats == ["is_apartment", "studio", "building_type_int", "has_elevator"]
    assert len(nums) == 11
    assert dict(f.dtypes)["building_type_int"] == "string"
    with pytest.raises(GateError):
        prepare_features(clean.withColumn("price", F.lit(0.0)))
    with pytest.raises(GateError, match="integral"):
        prepare_features(clean.withColumn("building_type_int", F.lit(2.5)))
    with pytest.raises(ContractError, match="no feature columns remain"):
        prepare_features(clean.select("flat_id", "building_id", "price"))


def test_one_hot_unseen_is_all_zero(spark):
    train = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "flat_id long, t string")
    data = spark.createDataFrame([(1, "a"), (4, "z")], "flat_id long, t string")
    rows = {(r["flat_id"], r["feature"]): r["value"] for r in one_hot_long(train, data, ["t"]).collect()}
    assert rows == {(1, "t=a"): 1.0, (1, "t=b"): 0.0, (4, "t=a"): 0.0, (4, "t=b"): 0.0}


def test_encoding_keeps_every_train_category(spark):
    from pyspark.ml import Pipeline

    train = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 3.0)], "t string, x double")
    m = Pipeline(stages=encoding_stages(["t"], ["x"])).fit(train)
    vecs = [r[0] for r in m.transform(train).select(vector_to_array("features")).collect()]
    assert all(len(v) == 4 for v in vecs)  # 3 categories + 1 numeric


def test_metrics_and_degenerate_r2(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 2.0)], "label double, prediction double")
    m = regression_metrics(df, rows_total=5).first()
    assert m["rmse"] == 1.0 and m["mae"] == 1.0 and m["r2"] == 0.0 and m["rows_total"] == 5 and m["rows_val"] == 2
    const = spark.createDataFrame([(2.0, 2.0), (2.0, 2.0)], "label double, prediction double")
    assert regression_metrics(const, rows_total=2).first()["r2"] == 1.0
    off = spark.createDataFrame([(2.0, 3.0), (2.0, 2.0)], "label double, prediction double")
    assert regression_metrics(off, rows_total=2).first()["r2"] == 0.0


def test_gbt_fit_save_load_same_predictions(spark, clean, scratch):
    feats = prepare_features(clean)
    train, val = train_validation(feats, "flat_id", 0.2, 42)
    model = fit(train.drop("flat_id"), ModelParams(n_estimators=5, max_depth=3))
    p1 = predict(model, val.drop("flat_id"))
    save_model(model, f"{scratch}/model")
    p2 = predict(load_model(spark, f"{scratch}/model"), val.drop("flat_id"))
    a = [r[0] for r in p1.orderBy("floor", "kitchen_area", "living_area", "total_area", "latitude").select("prediction").collect()]
    b = [r[0] for r in p2.orderBy("floor", "kitchen_area", "living_area", "total_area", "latitude").select("prediction").collect()]
    assert a == b
    m = regression_metrics(p1, rows_total=1165)
    d = write_metrics(m, f"{scratch}/metrics.json")
    assert list(d) == ["mae", "r2", "rmse", "rows_total", "rows_val"] and d["rows_val"] == 233
    import json

    text = "\n".join(r.value for r in spark.read.text(f"{scratch}/metrics.json").collect())
    assert json.loads(text) == d and text.index('"mae"') < text.index('"rmse"')
    from martkit.sources.snapshots import current_model, publish_model

    man = publish_model(model, scratch, "price_model")
    p3 = predict(current_model(spark, scratch, "price_model"), val.drop("flat_id"))
    c = [r[0] for r in p3.orderBy("floor", "kitchen_area", "living_area", "total_area", "latitude").select("prediction").collect()]
    assert c == a and man["stages"][-1] == "GBTRegressionModel"
    with pytest.raises(FileNotFoundError):
        load_model(spark, f"{scratch}/missing")
    with pytest.raises(ValueError, match="unsupported loss"):
        fit(train.drop("flat_id"), ModelParams(n_estimators=1, loss_function="Huber"))


def test_analyze_catalog_table(spark, clean):
    from martkit.sources.tables import analyze_table

    spark.sql("CREATE DATABASE IF NOT EXISTS public")
    clean.write.mode("overwrite").saveAsTable("public.mart_clean_test")
    analyze_table(spark, "public.mart_clean_test")
    assert table_exists(spark, "public.mart_clean_test")
    stats = spark.sql("DESCRIBE TABLE EXTENDED public.mart_clean_test").where("col_name = 'Statistics'").first()
    assert "1165 rows" in stats["data_type"]


def test_gates_idempotent(spark, clean):
    a = sorted(tuple(r) for r in gates.clean_gate(clean).collect())
    b = sorted(tuple(r) for r in gates.clean_gate(clean).collect())
    assert a == b


def test_publish_table_switches_view(spark, clean, scratch):
    from martkit.sources.snapshots import publish_table

    m1 = publish_snapshot(clean, scratch, "viewed")
    publish_table(spark, m1, "marts.clean_current")
    assert spark.table("marts.clean_current").count() == 1165
    m2 = publish_snapshot(clean.limit(10), scratch, "viewed")
    publish_table(spark, m2, "marts.clean_current")
    assert spark.table("marts.clean_current").count() == 10


def test_run_flow_publishes_everything(spark, sf001, scratch):
    from martkit.plans.flow import run_flow
    from martkit.sources.tables import path_exists

    res = run_flow(
        fixtures.flats(spark, sf001), fixtures.buildings(spark, sf001), scratch,
        params=ModelParams(n_estimators=3, max_depth=3),
    )
    assert [s[0] for s in res.stages] == ["raw", "clean", "export", "split", "model"]
    assert res.raw_manifest["rows"] == 1500 and res.clean_manifest["rows"] == 1165
    assert res.metrics["rows_total"] == 1165 and res.metrics["rows_val"] == 233
    assert path_exists(spark, f"{scratch}/metrics.json") and path_exists(spark, res.export_path)
    assert res.model_manifest["stages"][-1] == "GBTRegressionModel"


def test_load_features_from_csv(spark, clean, scratch):
    from martkit.operators.features import load_features_and_target

    path = f"{scratch}/d.csv"
    export(clean, path, EXPORT_COLUMNS, schema=CLEAN_SCHEMA)
    feats, n = load_features_and_target(spark, path, CLEAN_SCHEMA)
    assert n == 1165 and same(feats, prepare_features(clean))
    with pytest.raises(FileNotFoundError):
        load_features_and_target(spark, f"{scratch}/missing.csv", CLEAN_SCHEMA)


def test_publish_analyze_and_clean_from_the_snapshot(spark, sf001, scratch):
    raw = build_raw(fixtures.flats(spark, sf001), fixtures.buildings(spark, sf001))
    m = publish_snapshot(raw, scratch, "raw_an", analyze=["price", "floor"])
    assert m["rows"] == 1500 and set(m["distinct"]) == {"price", "floor"}
    assert 10 <= m["distinct"]["floor"] <= 14
    pub = read_current(spark, scratch, "raw_an")
    assert same(build_clean(pub), build_clean(raw, quantile_mode="builtin"))


def _local(path):
    return path.removeprefix("file:")


def test_a_short_or_altered_file_fails_publish_and_export(spark, clean, scratch, monkeypatch):
    import os

    from martkit.sources import snapshots

    real = snapshots.checksum

    def with_a_file_gone(df):
        os.remove(_local(sorted(df.inputFiles())[0]))
        return real(spark.read.schema(df.schema).parquet(os.path.dirname(df.inputFiles()[0])))

    def with_a_changed_value(df):
        return real(df.withColumn("price", F.when(F.col("flat_id") == 7, F.col("price") + 1).otherwise(F.col("price"))))

    rows = clean.repartition(4)
    for fault in (with_a_file_gone, with_a_changed_value):
        monkeypatch.setattr(snapshots, "checksum", fault)
        with pytest.raises(GateError, match="content"):
            publish_snapshot(rows, scratch, "spoiled")
        with pytest.raises(GateError, match="content"):
            export(rows, f"{scratch}/spoiled.parquet", EXPORT_COLUMNS, fmt="parquet")
    monkeypatch.setattr(snapshots, "checksum", with_a_changed_value)
    with pytest.raises(GateError, match="content"):
        export(rows, f"{scratch}/spoiled.csv", EXPORT_COLUMNS)
    assert current_manifest(spark, scratch, "spoiled") is None
    assert not [n for n in _ls(spark, scratch) if n.startswith("spoiled.")] and not [n for n in _ls(spark, f"{scratch}/spoiled") if n[:2] == "v="]


def test_a_failed_write_leaves_no_folder(spark, clean, scratch):
    broken = clean.withColumn("price", F.when(F.col("flat_id") == 7, F.raise_error(F.lit("broken row"))).otherwise(F.col("price")))
    with pytest.raises(Exception, match="broken row"):
        publish_snapshot(broken, scratch, "broken")
    assert _ls(spark, f"{scratch}/broken") == []


def test_of_two_writers_exactly_one_publishes(spark, clean, scratch):
    first = publish_snapshot(clean, scratch, "raced")
    inner = []

    def other_writer(df):  # publishes while the outer writer is between its write and its marker
        inner.append(publish_snapshot(clean.limit(10), scratch, "raced"))
        return gates.clean_gate(df)

    with pytest.raises(GateError, match="fenced"):
        publish_snapshot(clean.limit(20), scratch, "raced", gates=[other_writer])
    now = current_manifest(spark, scratch, "raced")
    assert (first["sequence"], inner[0]["sequence"]) == (1, 2) and now["run_id"] == inner[0]["run_id"]
    kept = {n for n in _ls(spark, f"{scratch}/raced") if n.startswith("v=")}
    assert kept == {f"v={first['run_id']}", f"v={inner[0]['run_id']}"}
    assert read_current(spark, scratch, "raced").count() == 10


def test_export_is_one_file_with_one_header_in_key_order(spark, clean, scratch):
    from martkit.functions import checksum

    path = f"{scratch}/one.csv"
    out = export(clean.repartition(7), path, EXPORT_COLUMNS, schema=CLEAN_SCHEMA, max_records_per_file=100, expected=checksum(clean))
    with open(_local(path), encoding="utf-8") as f:
        lines = f.read().split("\n")
    assert lines[0] == ",".join(EXPORT_COLUMNS) and lines[-1] == "" and len(lines) == 1165 + 2
    ids = [int(x.split(",")[0]) for x in lines[1:-1]]
    assert ids == sorted(ids) and lines.count(lines[0]) == 1 and out["checksum"] == checksum(clean)
    # replaces a file in one step, and a folder too
    export(clean.where("flat_id < 100"), path, EXPORT_COLUMNS, schema=CLEAN_SCHEMA)
    assert 0 < read_csv(spark, path, CLEAN_SCHEMA).count() < 100
    export(clean, f"{scratch}/folder", EXPORT_COLUMNS, fmt="parquet")
    export(clean, f"{scratch}/folder", EXPORT_COLUMNS, fmt="csv")
    assert read_csv(spark, f"{scratch}/folder", CLEAN_SCHEMA).count() == 1165
    assert not [n for n in _ls(spark, scratch) if ".tmp-" in n or ".parts-" in n or ".old-" in n]
    with pytest.raises(GateError, match="content"):
        export(clean.limit(5), path, EXPORT_COLUMNS, expected=checksum(clean))


def test_clustered_snapshot_has_disjoint_ranges_and_lookups_open_one_file(spark, clean, scratch):
    from martkit.plans.inspect import scans
    from martkit.sources.snapshots import lookup

    shuffles = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        m = publish_snapshot(clean, scratch, "zoned", cluster_by="flat_id")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", shuffles)
    ranges = m["key_ranges"]
    assert len(ranges) == 8 and sum(r["rows"] for r in ranges) == 1165
    assert all(a["high"] < b["low"] for a, b in zip(ranges, ranges[1:]))
    key = ranges[3]["high"]
    found = lookup(spark, scratch, "zoned", key)
    assert [r["flat_id"] for r in found.collect()] == [key] and len(found.inputFiles()) == 1
    (scan,) = scans(found)
    assert f"EqualTo(flat_id,{key})" in scan["PushedFilters"]
    assert lookup(spark, scratch, "zoned", -5).count() == 0
    # a key on both sides of a border is found
    twice = clean.unionByName(clean.limit(300))
    with pytest.raises(GateError, match="key_ranges_disjoint"):
        publish_snapshot(twice.coalesce(1), scratch, "twice", cluster_by="flat_id", max_records_per_file=3)


def test_published_model_must_predict_the_same(spark, clean, scratch, monkeypatch):
    from pyspark.ml import PipelineModel

    from martkit.sources.snapshots import publish_model

    feats = prepare_features(clean).drop("flat_id")
    models = [fit(feats, ModelParams(n_estimators=n, max_depth=2)) for n in (2, 3)]
    man = publish_model(models[0], scratch, "m", rows=feats)
    assert man["rows"] == 1165 and man["sequence"] == 1
    monkeypatch.setattr(PipelineModel, "load", staticmethod(lambda uri: models[1]))
    with pytest.raises(GateError, match="content"):
        publish_model(models[0], scratch, "m", rows=feats)
    assert len([n for n in _ls(spark, f"{scratch}/m") if n.startswith("v=")]) == 1


def test_missing_sources_fail_before_anything_is_read(spark, sf001, scratch):
    from martkit.__main__ import main
    from martkit.plans.flow import run_flow

    with pytest.raises(GateError, match="exists"):
        run_flow(fixtures.flats(spark, sf001), fixtures.buildings(spark, sf001), scratch, sources=[f"{scratch}/nothing"])
    with pytest.raises(GateError, match="exists"):
        main(["raw", "--flats", f"{scratch}/nothing", "--buildings", f"{scratch}/neither", "--root", scratch], spark)


def test_export_of_a_named_table_in_chunks(spark, clean, scratch):
    from martkit.__main__ import main

    spark.sql("CREATE DATABASE IF NOT EXISTS public")
    clean.write.mode("overwrite").saveAsTable("public.mart_to_export")
    out = main(["export", "--table", "public.mart_to_export", "--out", f"{scratch}/t.csv", "--chunk_size", "100"], spark)
    assert out["rows"] == 1165 and same(read_csv(spark, f"{scratch}/t.csv", CLEAN_SCHEMA), clean)
    with pytest.raises(GateError, match="exists"):
        main(["export", "--table", "public.no_such_mart", "--out", f"{scratch}/u.csv"], spark)


def test_key_ranges_are_balanced_disjoint_and_complete(spark):
    from martkit.sources.tables import range_predicates

    # quadratic keys, a third of the rows on one key, NULL keys
    rows = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 50 WHEN id % 100 = 1 THEN NULL ELSE id * id END AS k")
    ranges = range_predicates(rows, "k", 100)
    text = [p.replace('"', "`") for p in ranges]
    hits = rows.select(*[F.coalesce(F.expr(p).cast("int"), F.lit(0)).alias(f"p{i}") for i, p in enumerate(text)])
    sizes = hits.agg(*[F.sum(c) for c in hits.columns]).first()
    assert hits.where(" + ".join(hits.columns) + " <> 1").isEmpty() and sum(sizes) == 3000
    assert sorted(sizes)[-1] <= 1000 + 100 + 5 and sorted(sizes)[-2] <= 105
    assert range_predicates(rows.limit(0), "k", 100) == ["1 = 1"]
    days = spark.range(50).selectExpr("date_add(DATE '2024-01-01', CAST(id AS INT)) AS d")
    assert "DATE '2024-" in range_predicates(days, "d", 10)[0]
    with pytest.raises(ValueError):
        range_predicates(rows, "k", 0)


def test_many_ranges_are_placed_by_their_bounds(spark):
    from martkit.sources.tables import RangePredicate, place_in_ranges, range_predicates

    rows = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 50 WHEN id % 100 = 1 THEN NULL ELSE id * id END AS k")

    def texts(ranges):  # every predicate's text on every row
        text = [p.replace('"', "`") for p in ranges]
        held = [F.coalesce(F.expr(p), F.lit(False)) for p in text]
        return F.filter(F.array(*[F.when(p, i) for i, p in enumerate(held)]), F.isnotnull)

    def agree(df, key, ranges):
        both = place_in_ranges(df, key, ranges).withColumn("t", texts(ranges))
        return both.where("NOT (size(t) <=> hits AND (get(t, 0) <=> i OR hits <> 1))").isEmpty()

    assert agree(rows, "k", range_predicates(rows, "k", 100))
    assert agree(rows, "k", range_predicates(rows, "k", 5000))
    gaps = [RangePredicate('"k" <= 9', high=9), RangePredicate('"k" > 4 AND "k" <= 100', 4, 100), RangePredicate('"k" > 400', low=400)]
    assert agree(rows, "k", gaps)
    days = spark.range(50).selectExpr("date_add(DATE '2024-01-01', CAST(id AS INT)) AS d")
    assert agree(days, "d", range_predicates(days, "d", 10))
    parts = spark.range(50).selectExpr("id / 7D AS x")
    assert agree(parts, "x", range_predicates(parts, "x", 10))
    # thousands of ranges: a predicate each in one expression overflows the stack
    many = spark.range(6000).selectExpr("id AS k")
    ranges = range_predicates(many, "k", 2)
    found = place_in_ranges(many, "k", ranges).agg(F.min("hits"), F.max("hits"), F.countDistinct("i")).first()
    assert tuple(found)[:2] == (1, 1) and len(ranges) - 2 <= found[2] <= len(ranges) - 1


def test_features_without_key_and_from_parquet(spark, clean, scratch):
    from martkit.operators.features import load_features_and_target

    some = clean.drop("flat_id", "building_id", "ceiling_height")
    some.coalesce(1).write.option("header", True).csv(f"{scratch}/nokey.csv")
    feats, n = load_features_and_target(spark, f"{scratch}/nokey.csv", CLEAN_SCHEMA)
    assert n == 1165 and "flat_id" not in feats.columns and "label" in feats.columns and "ceiling_height" not in feats.columns
    train, val = train_validation(feats, None, 0.2, 42)
    assert val.count() == 233 and train.count() == 932
    clean.write.parquet(f"{scratch}/d.parquet")
    again, n = load_features_and_target(spark, f"{scratch}/d.parquet", CLEAN_SCHEMA)
    assert n == 1165 and same(again, prepare_features(clean))
    clean.withColumn("odd", F.lit(1)).coalesce(1).write.option("header", True).csv(f"{scratch}/odd.csv")
    with pytest.raises(ContractError, match="odd"):
        load_features_and_target(spark, f"{scratch}/odd.csv", CLEAN_SCHEMA)


def test_feature_gate_names_each_fault(spark):
    from martkit.operators.gates import feature_gate

    train = spark.createDataFrame([("a", 1.0, None, 2.0), ("b", 3.0, None, 2.0)], "t string, x double, e double, c double")
    data = train.unionByName(spark.createDataFrame([("z", 1.0, 1.0, 2.0), ("z", 1.0, 1.0, 2.0), (None, 1.0, 1.0, 2.0)], train.schema))
    found = {r["rule"]: r["violations"] for r in feature_gate(train, data, ["t"], ["x", "e", "c"]).collect()}
    assert {k: v for k, v in found.items() if v} == {"empty:e": 2, "constant:c": 1, "unseen:t": 2} and len(found) == 8


def test_records_per_file_bound(spark, clean, scratch):
    m = publish_snapshot(clean, scratch, "small_files", max_records_per_file=200)
    files = [f for f in _ls(spark, m["uri"]) if f.endswith(".parquet")]
    assert m["rows"] == 1165 and len(files) >= 6


def test_model_queries_train_the_operators_default_size(spark, sf001, monkeypatch):
    from martkit.plans import catalog, flow

    seen = []

    def stop(train, params=None, **_):
        seen.append(params)
        raise InterruptedError

    monkeypatch.setattr(catalog, "fit", stop)
    monkeypatch.setattr(flow, "train_job", lambda train, root, params, **_: stop(train, params))
    for query in (catalog.q_gbt_evaluate, catalog.q_end_to_end_report):
        with pytest.raises(InterruptedError):
            query(spark, sf001)
    assert seen == [ModelParams()] * 2 and (seen[0].n_estimators, seen[0].max_depth) == (500, 8)
