"""Staged writes, gates on written data, fenced publish.

Layout of a mart under ``root``::

    <root>/<mart>/v=<run_id>/            Parquet snapshot (staged, then published)
    <root>/<mart>/_published/<seq>.json  marker: sequence number, run_id, uri, checksum, key ranges

A snapshot becomes visible only when its marker exists.  Markers are numbered; a run claims
the number after the one it found when it started, by a rename that does not overwrite.  Of
several runs that started from the same snapshot exactly one publishes, the others fail and
remove their folders.  A failed or half-written run never replaces the current snapshot, and
readers of an older snapshot keep reading it.

What was written is compared with what was meant to be written: the write job itself
observes a checksum of the multiset of rows (count, sum and xor of row hashes), and the
files must give the same one when read again.
"""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from martkit.errors import GateError
from martkit.functions import checksum, checksum_dict, checksum_metrics
from martkit.operators.gates import enforce
from martkit.session import release_heap
from martkit.sources.files import csv_header, delete, file_system, names, read_text, replace, replace_file, stitch, write_text
from martkit.sources.tables import contract_scan, read_csv


def new_run_id() -> str:
    return datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%fZ") + "-" + uuid.uuid4().hex[:8]


# --------------------------------------------------------------------- markers


def _markers(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}/_published"


def current_sequence(spark: SparkSession, root: str, name: str) -> int:
    """The number of the newest marker; 0 if nothing is published."""
    return max((int(n.removesuffix(".json")) for n in names(spark, _markers(root, name)) if n.endswith(".json")), default=0)


def _claim(spark: SparkSession, root: str, name: str, after: int, manifest: dict) -> dict:
    """Write the marker that follows ``after``; another writer's marker there is an error."""
    manifest = {**manifest, "sequence": after + 1, "published_utc": datetime.now(timezone.utc).isoformat()}
    path = f"{_markers(root, name)}/{after + 1:012d}.json"
    try:
        write_text(spark, path, json.dumps(manifest, sort_keys=True), overwrite=False)
    except FileExistsError:
        raise GateError("publish", [{"rule": "fenced", "violations": 1}]) from None
    return manifest


def current_manifest(spark: SparkSession, root: str, mart: str) -> dict | None:
    last = current_sequence(spark, root, mart)
    return json.loads(read_text(spark, f"{_markers(root, mart)}/{last:012d}.json")) if last else None


# ------------------------------------------------------------------- snapshots


def _compare(gate: str, want: dict, got: dict) -> None:
    """A report row for each part of two checksums that differs."""
    wrong = [{"rule": f"content:{k}", "violations": 1} for k in want if want[k] != got.get(k)]
    if wrong:
        raise GateError(gate, wrong)


def key_ranges(written: DataFrame, key: str) -> list[dict]:
    """Smallest and largest key and rows of each file, in key order (the zone map)."""
    per_file = written.groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.min(key).alias("low"), F.max(key).alias("high"), F.count(F.lit(1)).alias("rows"))
    rows = [r.asDict() for r in per_file.collect()]  # one row per file
    return sorted(rows, key=lambda r: (r["low"] is not None, r["low"], r["high"]))


def _disjoint(ranges: list[dict]) -> list[dict]:
    """Files whose key range touches that of the file before."""
    held = [r for r in ranges if r["low"] is not None]
    return [{"rule": f"key_ranges_disjoint:{b['file']}", "violations": 1} for a, b in zip(held, held[1:]) if b["low"] <= a["high"]]


def publish_snapshot(
    df: DataFrame,
    root: str,
    mart: str,
    *,
    gates=(),
    run_id: str | None = None,
    expected_rows: int | None = None,
    cluster_by: str | None = None,
    analyze=(),
    max_records_per_file: int = 20_000_000,
) -> dict:
    """Stage ``df`` as a new snapshot, gate it, publish it.

    ``gates`` are callables ``DataFrame -> report DataFrame`` run on the re-read
    snapshot.  ``cluster_by`` (S16: no index in Spark) deals the rows out by ranges of that
    key and sorts them within each file, so files cover disjoint ranges; their bounds go into
    the manifest, a unique key repeats nowhere if no file repeats it and no two ranges touch,
    and ``lookup`` opens the files of a key only.  ``analyze`` (S15) lists columns whose
    distinct-count estimates are stored in the manifest (``distinct``).
    """
    run_id = run_id or new_run_id()
    spark = df.sparkSession
    after = current_sequence(spark, root, mart)
    uri = f"{root.rstrip('/')}/{mart}/v={run_id}"
    out = df.repartitionByRange(cluster_by).sortWithinPartitions(cluster_by) if cluster_by else df
    meant = Observation()
    try:
        # Staged; all-or-nothing job commit; a skewed partition is split across files
        (out.observe(meant, *checksum_metrics(out)).write.mode("errorifexists")
            .option("maxRecordsPerFile", max_records_per_file).parquet(uri))
        written = spark.read.schema(out.schema).parquet(uri)
        content = checksum(written)
        _compare("publish", checksum_dict(meant.get), content)
        reports = [enforce(g(written)) for g in gates]
        if expected_rows is not None and content["rows"] != expected_rows:
            raise GateError("publish", [{"rule": "row_count", "violations": abs(content["rows"] - expected_rows)}])
        distinct = {}
        if analyze:
            columns = dict.fromkeys(analyze)
            distinct = written.agg(*[F.approx_count_distinct(c).alias(c) for c in columns]).first().asDict()
        ranges = key_ranges(written, cluster_by) if cluster_by else []
        if wrong := _disjoint(ranges):
            raise GateError("publish", wrong)
        return _claim(spark, root, mart, after, {
            "run_id": run_id,
            "uri": uri,
            "rows": content["rows"],
            "columns": out.columns,
            "checksum": content,
            "distinct": distinct,
            "cluster_by": cluster_by,
            "key_ranges": ranges,
            "gates": [r for rep in reports for r in rep],
        })
    except Exception:
        delete(spark, uri)  # S11: a failed run leaves nothing behind
        raise


def read_current(spark: SparkSession, root: str, mart: str) -> DataFrame:
    """The published snapshot of ``mart`` (S8: error if there is none)."""
    m = current_manifest(spark, root, mart)
    if m is None:
        raise GateError("clean_input", [{"rule": f"exists:{mart}", "violations": 1}])
    return spark.read.parquet(m["uri"])


def lookup(spark: SparkSession, root: str, mart: str, key) -> DataFrame:
    """The rows of one key of a clustered snapshot; opens only files whose range holds it."""
    m = current_manifest(spark, root, mart)
    if m is None or not m["cluster_by"]:
        raise ValueError(f"no published snapshot of {mart} with a clustered key")
    whole = spark.read.parquet(m["uri"])
    files = [r["file"] for r in m["key_ranges"] if r["low"] is not None and r["low"] <= key <= r["high"]]
    if not files:
        return whole.limit(0)
    return spark.read.schema(whole.schema).parquet(*[f"{m['uri']}/{f}" for f in files]).where(F.col(m["cluster_by"]) == key)


def publish_table(spark: SparkSession, manifest: dict, name: str) -> None:
    """S7 in a catalog: switch view ``[schema.]name`` to the published snapshot.

    ``CREATE OR REPLACE VIEW`` swaps the definition in one catalog operation; a query
    that already resolved the old definition keeps reading the old snapshot files.
    """
    from martkit.sources.tables import qualified_name

    qualified = qualified_name(name)
    schema = qualified.split(".")[0]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}")
    uri = manifest["uri"].replace("`", "``")
    spark.sql(f"CREATE OR REPLACE VIEW {qualified} AS SELECT * FROM parquet.`{uri}`")


def publish_model(model, root: str, name: str, *, rows: DataFrame | None = None, run_id: str | None = None) -> dict:
    """S13 + S14 for models: save under ``<root>/<name>/v=<run_id>``, load it back, compare
    its stages and, on stored ``rows``, every prediction with the fitted model's; then claim
    the next marker."""
    from pyspark.ml import PipelineModel

    from martkit.operators.model import predict, save_model

    spark = SparkSession.getActiveSession()
    run_id = run_id or new_run_id()
    after = current_sequence(spark, root, name)
    uri = f"{root.rstrip('/')}/{name}/v={run_id}"
    manifest = {"run_id": run_id, "uri": uri, "stages": [type(s).__name__ for s in model.stages], "columns": None, "rows": None}
    try:
        save_model(model, uri, overwrite=False)
        release_heap(spark)
        back = PipelineModel.load(uri)
        if [type(s).__name__ for s in back.stages] != manifest["stages"]:
            raise GateError("publish_model", [{"rule": "stages", "violations": 1}])
        if rows is not None:
            scored = []
            for m in (model, back):
                release_heap(spark)
                scored.append(checksum(predict(m, rows).select(*rows.columns, "prediction")))
            _compare("publish_model", *scored)
            manifest |= {"rows": scored[0]["rows"], "columns": rows.columns, "predictions": scored[0]}
        return _claim(spark, root, name, after, manifest)
    except Exception:
        delete(spark, uri)
        raise


def current_model(spark: SparkSession, root: str, name: str):
    from pyspark.ml import PipelineModel

    m = current_manifest(spark, root, name)
    if m is None:
        raise FileNotFoundError(f"no published model {name!r} under {root}")
    return PipelineModel.load(m["uri"])


def write_json_atomic(spark: SparkSession, path: str, doc: dict) -> None:
    """S11 + S12: one JSON document with sorted keys, replacing ``path`` only when complete."""
    write_text(spark, path, json.dumps(doc, sort_keys=True, indent=2) + "\n", overwrite=True)


# ---------------------------------------------------------------------- export


def export(
    df: DataFrame,
    path: str,
    columns,
    *,
    schema=None,
    fmt: str = "csv",
    order_by=None,
    expected_rows: int | None = None,
    expected: dict | None = None,
    max_records_per_file: int = 20_000_000,
) -> dict:
    """Contract columns only, written all-or-nothing to ``path``.

    ``csv`` is one file with one header line and its rows in the order of ``order_by`` (the
    first column if not given): parts are written side by side without headers and put
    together at their byte offsets (``files.stitch``).  ``parquet`` is a folder.

    Output goes to a temporary name beside ``path`` first; only a non-empty result whose rows
    have the checksum that the write job observed, with ``expected_rows`` rows and the checksum
    ``expected`` if given, replaces ``path``.  A file replaces a file in one step; a folder is
    set aside first and put back if the rename fails.  On failure the temporary output is
    removed and any previous export stays.
    """
    spark = df.sparkSession
    if fmt not in ("csv", "parquet"):
        raise ValueError(f"unsupported export format {fmt!r}")
    out = contract_scan(df, columns, schema)
    if fmt == "csv" or order_by:
        out = out.orderBy(order_by or columns[0])
    tmp, parts = f"{path.rstrip('/')}.tmp-{uuid.uuid4().hex}", f"{path.rstrip('/')}.parts-{uuid.uuid4().hex}"
    meant = Observation()
    w = out.observe(meant, *checksum_metrics(out)).write.mode("errorifexists").option("maxRecordsPerFile", max_records_per_file)
    try:
        if fmt == "csv":
            w.option("header", False).csv(parts)
            stitch(spark, parts, tmp, csv_header(out.columns))
            back = read_csv(spark, tmp, out.schema)
        else:
            w.parquet(tmp)
            back = spark.read.schema(out.schema).parquet(tmp)
        content = checksum(back)
        if content["rows"] == 0:
            raise GateError("export", [{"rule": "non_empty", "violations": 1}])
        _compare("export", checksum_dict(meant.get), content)
        if expected is not None:
            _compare("export", expected, content)
        if expected_rows is not None and content["rows"] != expected_rows:
            raise GateError("export", [{"rule": "row_count", "violations": abs(content["rows"] - expected_rows)}])
        if fmt == "csv":
            replace_file(spark, tmp, path)
        else:
            fs, src = file_system(spark, tmp)
            replace(fs, src, file_system(spark, path)[1])
    except Exception:
        delete(spark, tmp)
        raise
    finally:
        delete(spark, parts)
    return {"path": path, "columns": list(columns), "format": fmt, "rows": content["rows"], "checksum": content}
