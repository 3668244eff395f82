"""Command line: the pipeline's stages as Spark jobs.

    python -m martkit raw      --flats P --buildings P --root DIR
    python -m martkit clean    --root DIR
    python -m martkit export   --root DIR --out PATH [--format csv|parquet]
    python -m martkit export   --table T --out PATH [--url JDBC] [--chunk_size N] [--key K]
    python -m martkit train    --data PATH --root DIR [--target price --test_size 0.2 ...]
    python -m martkit evaluate --data PATH --root DIR [--target price --test_size 0.2 ...]
    python -m martkit flow     --flats P --buildings P --root DIR [model options]

Sources are Parquet paths or catalog tables (``schema.table``).  ``--root`` is the
shared folder that holds the published snapshots, the model and the metrics.
"""

from __future__ import annotations

import argparse
import json
import sys

from martkit.contract import CLEAN_SCHEMA, EXPORT_COLUMNS, HOUSING
from martkit.operators import gates
from martkit.operators.clean import build_clean
from martkit.operators.features import load_features_and_target
from martkit.operators.model import ModelParams
from martkit.operators.raw import build_raw
from martkit.operators.split import train_validation
from martkit.session import get_session, scale_conf
from martkit.sources.snapshots import current_manifest, export, publish_snapshot, read_current
from martkit.sources.tables import qualified_name, read_jdbc

# Stage defaults of the modelled pipeline's parameters.
DEFAULTS = dict(
    target="price", test_size=0.2, random_state=42, n_estimators=500, max_depth=8,
    learning_rate=0.1, loss_function="RMSE",
)


def _read(spark, src: str):
    if "/" in src or ":" in src:
        return spark.read.parquet(src)
    qualified_name(src)  # validates the name
    return spark.table(src)


def _model_args(p: argparse.ArgumentParser) -> None:
    p.add_argument("--target", default=DEFAULTS["target"])
    p.add_argument("--test_size", type=float, default=DEFAULTS["test_size"])
    p.add_argument("--random_state", type=int, default=DEFAULTS["random_state"])
    p.add_argument("--n_estimators", type=int, default=DEFAULTS["n_estimators"])
    p.add_argument("--max_depth", type=int, default=DEFAULTS["max_depth"])
    p.add_argument("--learning_rate", type=float, default=DEFAULTS["learning_rate"])
    p.add_argument("--loss_function", default=DEFAULTS["loss_function"])


def _params(a) -> ModelParams:
    return ModelParams(
        n_estimators=a.n_estimators, max_depth=a.max_depth, learning_rate=a.learning_rate,
        loss_function=a.loss_function, seed=a.random_state,
    )


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="martkit", description="Data-mart and price-model stages on Spark")
    ap.add_argument("--input_gb", type=float, default=None,
                    help="input volume; sizes scan splits, shuffle partitions and skew thresholds")
    sub = ap.add_subparsers(dest="cmd", required=True)
    for name in ("raw", "flow"):
        p = sub.add_parser(name)
        p.add_argument("--flats", required=True)
        p.add_argument("--buildings", required=True)
        p.add_argument("--root", required=True)
        if name == "flow":
            _model_args(p)
    p = sub.add_parser("clean")
    p.add_argument("--root", required=True)
    p = sub.add_parser("export")
    p.add_argument("--root", help="export the published clean mart of this folder")
    p.add_argument("--table", help="export this [schema.]table instead")
    p.add_argument("--url", help="JDBC address of the database that holds the table")
    p.add_argument("--key", default=HOUSING.key, help="key of a table: order of a CSV, ranges of a JDBC read")
    p.add_argument("--chunk_size", type=int, default=100_000, help="rows of one fetch and of one written part")
    p.add_argument("--out", required=True)
    p.add_argument("--format", default="csv", choices=("csv", "parquet"))
    for name in ("train", "evaluate"):
        p = sub.add_parser(name)
        p.add_argument("--data", required=True, help="exported dataset (CSV, or Parquet of a name ending in .parquet)")
        p.add_argument("--root", required=True)
        _model_args(p)
    return ap


def _export(spark, a) -> dict:
    """The clean mart with the checksum of its snapshot, or any table of the mart's columns."""
    if (a.root is None) == (a.table is None):
        raise SystemExit("export takes either --root or --table")
    if a.root is not None:
        manifest = current_manifest(spark, a.root, "clean") or {}
        return export(read_current(spark, a.root, "clean"), a.out, EXPORT_COLUMNS, schema=CLEAN_SCHEMA, fmt=a.format,
                      order_by=HOUSING.key, expected=manifest.get("checksum"))
    if a.url:
        df = read_jdbc(spark, a.url, a.table, EXPORT_COLUMNS, key=a.key, chunk_size=a.chunk_size)
    else:
        gates.require_sources(spark, a.table)
        df = _read(spark, a.table)
    return export(df, a.out, EXPORT_COLUMNS, fmt=a.format, order_by=a.key, max_records_per_file=a.chunk_size)


def main(argv=None, spark=None) -> dict:
    a = parser().parse_args(argv)
    spark = spark or get_session(app_name=f"martkit-{a.cmd}")
    if a.input_gb:
        for k, v in scale_conf(int(a.input_gb * (1 << 30))).items():
            spark.conf.set(k, v)  # runtime SQL settings
    if a.cmd == "raw":
        gates.require_sources(spark, a.flats, a.buildings)
        f, b = _read(spark, a.flats), _read(spark, a.buildings)
        gates.enforce(gates.source_gate(f, b))
        out = publish_snapshot(build_raw(f, b), a.root, "raw",
                               gates=[lambda d: gates.raw_gate(d, HOUSING.key)], cluster_by=HOUSING.key,
                               analyze=list(HOUSING.medians) + list(HOUSING.clips), expected_rows=f.count())
    elif a.cmd == "clean":
        raw = read_current(spark, a.root, "raw")
        gates.enforce(gates.clean_input_gate(raw))
        clean = build_clean(raw, HOUSING)  # re-scans the snapshot
        out = publish_snapshot(clean, a.root, "clean",
                               gates=[lambda d: gates.clean_gate(d, HOUSING)], cluster_by=HOUSING.key)
    elif a.cmd == "export":
        out = _export(spark, a)
    elif a.cmd in ("train", "evaluate"):
        from martkit.plans.flow import evaluate_job, train_job

        feats, n = load_features_and_target(spark, a.data, CLEAN_SCHEMA, a.target)
        key = HOUSING.key if HOUSING.key in feats.columns else None
        train, val = train_validation(feats, key, a.test_size, a.random_state)
        if a.cmd == "train":
            out = train_job(train, a.root, _params(a), key=HOUSING.key, val=val)
        else:
            out = evaluate_job(val, a.root, rows_total=n, key=HOUSING.key)
    else:
        from martkit.plans.flow import run_flow

        gates.require_sources(spark, a.flats, a.buildings)
        res = run_flow(_read(spark, a.flats), _read(spark, a.buildings), a.root,
                       test_size=a.test_size, seed=a.random_state, params=_params(a))
        out = {"stages": res.stages, "metrics": res.metrics}
    print(json.dumps(out, sort_keys=True, default=str))
    return out


if __name__ == "__main__":
    main(sys.argv[1:])
