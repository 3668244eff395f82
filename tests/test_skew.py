"""Results stay exact when one key or value holds a third of all rows."""

import numpy as np
from pyspark.sql import functions as F

from martkit.operators import gates
from martkit.operators.clean import dedup_keep_first
from martkit.operators.stats import QuantileTarget, mode_value, quantile_stats

N = 3000


def _skewed(spark):
    # key 7 holds a third of the rows; value 5.0 holds a third of the values
    return spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("seq"),
        F.when(F.col("id") % 3 == 1, F.lit(5.0)).otherwise((F.col("id") * 7919 % 1000).cast("double")).alias("v"),
    ).repartition(8)


def test_dedup_hot_key(spark):
    df = _skewed(spark)
    rows = df.collect()
    first = {}
    for r in sorted(rows, key=lambda r: r["seq"]):
        first.setdefault(r["k"], (r["seq"], r["v"]))
    got = {r["k"]: (r["seq"], r["v"]) for r in dedup_keep_first(df, "k", "seq").collect()}
    assert got == first


def test_gates_hot_key(spark):
    df = _skewed(spark)
    rep = {r["rule"]: r["violations"] for r in gates.raw_gate(df, "k").collect()}
    assert rep == {"non_empty": 0, "key_not_null": 0, "key_unique": 1}


def test_mode_and_quantiles_hot_value(spark):
    df = _skewed(spark)
    vals = np.array([r["v"] for r in df.select("v").collect()])
    assert mode_value(df, "v").first()[0] == 5.0
    ts = [QuantileTarget(f"q{int(p * 100)}", "v", p) for p in (0.1, 0.33, 0.5, 0.9)]
    for mode, kw in (("builtin", {}), ("exact", {}), ("exact", dict(accuracy=8, few_rows=50))):
        got = quantile_stats(df, ts, mode, **kw).first().asDict()
        want = {t.name: float(np.percentile(vals, t.p * 100)) for t in ts}
        assert all(abs(got[k] - want[k]) < 1e-9 for k in want), (mode, got, want)


def test_quantile_modes_keep_results(spark):
    from martkit.operators.clean import clean_exploratory
    from martkit.operators.profile import profile_outliers
    from martkit.operators.raw import build_raw
    from martkit.sources import fixtures

    d = "/root/testdata/sf0.001"
    raw = build_raw(fixtures.flats(spark, d), fixtures.buildings(spark, d))
    a = clean_exploratory(raw, order_by="price")
    b = clean_exploratory(raw, order_by="price", quantile_mode="builtin")
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    p1 = sorted(tuple(r) for r in profile_outliers(raw).collect())
    p2 = sorted(tuple(r) for r in profile_outliers(raw, quantile_mode="builtin").collect())
    assert p1 == p2
