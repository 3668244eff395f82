"""The command-line stages, run in-process on the test session."""

import json

from martkit.__main__ import main
from martkit.sources import fixtures
from martkit.sources.snapshots import current_manifest


def test_stage_by_stage(spark, sf001, scratch):
    fixtures.flats(spark, sf001).write.parquet(f"{scratch}/flats")
    fixtures.buildings(spark, sf001).write.parquet(f"{scratch}/buildings")
    root = f"{scratch}/marts"
    raw = main(["raw", "--flats", f"{scratch}/flats", "--buildings", f"{scratch}/buildings", "--root", root], spark)
    assert raw["rows"] == 1500
    clean = main(["clean", "--root", root], spark)
    assert clean["rows"] == 1165 and current_manifest(spark, root, "clean")["run_id"] == clean["run_id"]
    main(["export", "--root", root, "--out", f"{scratch}/dataset.csv"], spark)
    small = ["--n_estimators", "3", "--max_depth", "3"]
    m = main(["train", "--data", f"{scratch}/dataset.csv", "--root", root, *small], spark)
    assert m["stages"][-1] == "GBTRegressionModel"
    metrics = main(["evaluate", "--data", f"{scratch}/dataset.csv", "--root", root, *small], spark)
    assert metrics["rows_total"] == 1165 and metrics["rows_val"] == 233
    text = "\n".join(r.value for r in spark.read.text(f"{root}/metrics.json").collect())
    assert json.loads(text) == metrics
