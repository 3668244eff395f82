"""Column expressions (P2, P4-P10, P13) on small literal frames."""

import math

from pyspark.sql import functions as F

from martkit.functions import (
    bool_default,
    category_string,
    clamp,
    clamp_iqr,
    floor_rule_independent,
    floor_rule_joint,
    iqr_fences,
    is_finite,
    is_integral,
    nan_to_null,
    pct,
    try_double,
)


def one(spark, expr, schema, rows):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr.alias("x")).collect()]


def test_bool_default_and_nan(spark):
    assert one(spark, bool_default("b"), "b boolean", [(True,), (None,), (False,)]) == [True, False, False]
    assert one(spark, nan_to_null("d"), "d double", [(1.0,), (float("nan"),), (None,)]) == [1.0, None, None]


def test_fences_and_clamp(spark):
    lo, hi = iqr_fences(F.lit(2.0), F.lit(4.0))
    assert spark.range(1).select(lo, hi).first() == (-1.0, 7.0)
    assert one(spark, clamp("x", F.lit(0.0), F.lit(10.0)), "x double", [(-5.0,), (5.0,), (50.0,)]) == [0.0, 5.0, 10.0]


def test_clamp_iqr_guards(spark):
    rows = [(100.0,), (None,), (-100.0,)]
    assert one(spark, clamp_iqr("x", F.lit(2.0), F.lit(4.0)), "x double", rows) == [7.0, None, -1.0]
    # degenerate or missing IQR: no capping
    assert one(spark, clamp_iqr("x", F.lit(3.0), F.lit(3.0)), "x double", rows) == [100.0, None, -100.0]
    assert one(spark, clamp_iqr("x", F.lit(None).cast("double"), F.lit(3.0)), "x double", rows) == [100.0, None, -100.0]
    assert one(spark, clamp_iqr("x", F.lit(2.0), F.lit(4.0), guard=F.lit(True)), "x double", rows) == [100.0, None, -100.0]


def test_floor_rules(spark):
    rows = [(None, 10), (5, None), (-1, None), (None, 0), (11, 10), (5, 10), (-1, 10)]
    schema = "f int, t int"
    assert one(spark, floor_rule_independent("f", "t"), schema, rows) == [True, True, False, False, False, True, False]
    assert one(spark, floor_rule_joint("f", "t"), schema, rows) == [True, True, True, True, False, True, False]


def test_coercion_finite_and_categories(spark):
    vals = one(spark, try_double("s"), "s string", [("1.5",), ("abc",), ("inf",), ("",)])
    assert vals[0] == 1.5 and vals[1] is None and math.isinf(vals[2]) and vals[3] is None
    assert one(spark, is_finite("d"), "d double", [(1.0,), (float("inf"),), (float("nan"),)]) == [True, False, False]
    assert one(spark, is_integral("d"), "d double", [(3.0,), (3.7,), (None,)]) == [True, False, True]
    assert one(spark, category_string("c"), "c int", [(3,), (None,)]) == ["3", "__missing__"]


def test_pct_rounds_to_two_places(spark):
    assert one(spark, pct(F.col("n"), F.col("t")), "n long, t long", [(21, 1500), (1, 3)]) == [1.4, 33.33]
