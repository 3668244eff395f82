"""Published semantics (raw + clean marts), gates and the FIXTURES.md variants."""

import pytest
from pyspark.sql import functions as F

from martkit.contract import CLEAN_SCHEMA, RAW_SCHEMA, check_schema
from martkit.errors import GateError
from martkit.operators import gates
from martkit.operators.clean import build_clean, clean_exploratory, clip_iqr
from martkit.operators.raw import build_raw, orphans
from martkit.operators.stats import mode_value
from martkit.sources import fixtures


@pytest.fixture(scope="module")
def raw(spark, sf001):
    return build_raw(fixtures.flats(spark, sf001), fixtures.buildings(spark, sf001))


def test_raw_and_clean_counts_and_types(spark, raw):
    check_schema(raw, RAW_SCHEMA)
    assert raw.count() == 1500
    clean = build_clean(raw)
    check_schema(clean, CLEAN_SCHEMA)
    assert clean.count() == 1165
    gates.enforce(gates.raw_gate(raw))
    gates.enforce(gates.clean_gate(clean))


@pytest.mark.parametrize("materialise", ["persist", "stage"])
def test_materialised_build_is_identical(spark, raw, materialise):
    a = build_clean(raw)
    b = build_clean(raw, materialise=materialise)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_result_independent_of_partitioning(spark, raw):
    a = build_clean(raw.repartition(1))
    b = build_clean(raw.repartition(7, "building_id"))
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_output_ids_subset_of_input(raw):
    clean = build_clean(raw)
    assert clean.select("flat_id").exceptAll(raw.select("flat_id")).isEmpty()


def test_orphans_fail_source_gate(spark, sf001):
    f = fixtures.flats(spark, sf001, orphans=True)
    b = fixtures.buildings(spark, sf001)
    assert orphans(f, b).count() == 11
    with pytest.raises(GateError) as e:
        gates.enforce(gates.source_gate(f, b))
    assert e.value.failures[0]["violations"] == 11


def test_duplicates_fail_raw_gate_and_keep_first(spark, raw):
    dup = raw.where(F.col("flat_id") % 50 == 0).withColumn("price", F.col("price") * 2)
    both = raw.withColumn("seq", F.lit(0)).unionByName(dup.withColumn("seq", F.lit(1)))
    with pytest.raises(GateError, match="key_unique"):
        gates.enforce(gates.raw_gate(both))
    kept = clean_exploratory(both, order_by="seq").drop("seq")
    ref = clean_exploratory(raw.withColumn("seq", F.lit(0)), order_by="seq").drop("seq")
    assert kept.exceptAll(ref).isEmpty() and ref.exceptAll(kept).isEmpty()


def test_null_key_fails_raw_gate(spark, raw):
    bad = raw.withColumn("flat_id", F.when(F.col("flat_id") == 1, None).otherwise(F.col("flat_id")))
    with pytest.raises(GateError, match="key_not_null"):
        gates.enforce(gates.raw_gate(bad))


def test_nan_equals_null(spark, sf001):
    f = fixtures.flats(spark, sf001)
    f_nan = f.withColumn("total_area", F.coalesce("total_area", F.lit(float("nan"))))
    b = fixtures.buildings(spark, sf001)
    a = build_clean(build_raw(f, b))
    n = build_clean(build_raw(f_nan, b))
    assert a.exceptAll(n).isEmpty() and n.exceptAll(a).isEmpty()


def test_all_null_column_stays_null(spark, raw):
    r = raw.withColumn("ceiling_height", F.lit(None).cast("double"))
    clean = build_clean(r)
    assert clean.count() == 1165
    assert clean.where(F.col("ceiling_height").isNotNull()).isEmpty()


def test_constant_column_is_not_capped(spark, raw):
    r = raw.withColumn("kitchen_area", F.lit(10.0)).withColumn("total_area", F.lit(1000.0))
    clean = build_clean(r)
    assert clean.agg(F.min("kitchen_area"), F.max("kitchen_area")).first() == (10.0, 10.0)


def test_tiny_frames_are_never_capped(spark):
    # With linear interpolation, <= 3 values always lie inside the 1.5 IQR fences,
    # so the exploratory "fewer than 4 values" guard never changes the result.
    df = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 1e9)], "flat_id long, price double")
    published = {r["flat_id"]: r["price"] for r in clip_iqr(df, ["price"]).collect()}
    exploratory = {r["flat_id"]: r["price"] for r in clip_iqr(df, ["price"], min_rows=4).collect()}
    assert published == exploratory == {1: 1.0, 2: 2.0, 3: 1e9}


def test_capping_uses_fences(spark):
    df = spark.createDataFrame(
        [(1, 1.0), (2, 2.0), (3, 3.0), (4, 4.0), (5, 100.0), (6, None)], "flat_id long, price double"
    )
    out = {r["flat_id"]: r["price"] for r in clip_iqr(df, ["price"]).collect()}
    # q1 = 2, q3 = 4 -> fences [-1, 7]; NULL stays NULL
    assert out == {1: 1.0, 2: 2.0, 3: 3.0, 4: 4.0, 5: 7.0, 6: None}


def test_mode_tie_smallest(spark):
    df = spark.createDataFrame([(3,), (1,), (3,), (1,), (2,), (None,), (None,), (None,)], "t int")
    assert mode_value(df, "t").first()[0] == 1


def test_empty_fails_gates(spark, raw):
    empty = raw.limit(0)
    with pytest.raises(GateError, match="non_empty"):
        gates.enforce(gates.raw_gate(empty))
    with pytest.raises(GateError, match="non_empty"):
        gates.enforce(gates.clean_input_gate(empty))
    with pytest.raises(GateError, match="non_empty"):
        gates.enforce(gates.clean_gate(empty.select(*[F.col(c) for c in empty.columns])))


def test_business_rule_gate_catches_each_term(spark, raw):
    clean = build_clean(raw)
    for col, val in [("price", -1.0), ("rooms", 0), ("total_area", None), ("kitchen_area", 1e9)]:
        bad = clean.withColumn(col, F.when(F.col("flat_id") == clean.first()["flat_id"], F.lit(val)).otherwise(F.col(col)))
        with pytest.raises(GateError, match="business_rules"):
            gates.enforce(gates.clean_gate(bad))


def test_target_gate_bad_values(spark):
    df = spark.createDataFrame([("1.5",), ("abc",), ("inf",), ("",), ("-2",)], "price string")
    rows = {r["rule"]: r["violations"] for r in gates.target_gate(df, "price").collect()}
    assert rows == {"non_empty": 0, "target_valid": 3, "target_positive": 1}


def test_duplicate_key_fails_clean_gate(spark, raw):
    clean = build_clean(raw)
    doubled = clean.unionByName(clean.limit(1))
    with pytest.raises(GateError) as e:
        gates.enforce(gates.clean_gate(doubled))
    assert [f["rule"] for f in e.value.failures] == ["key_unique"]
