"""Line de-duplication with levelled sorted runs of line hashes.

A run is a table bucketed and sorted by line hash: how many documents hold the line, and the
largest document id that does.  A new batch is reduced to one row per line and merge
anti-joined with every run (runs are read by bucket, only the batch is shuffled).  Lines that
no run holds are appended as a run of level 0, so a line is in one run only; counts of lines
that are held already go to the run's update table.  When a level has ``fan_out`` runs they
are merged into one run of the next level, so a line lookup reads at most fan_out - 1 runs
per level and every row is rewritten once per level.  Common lines are read from the bucketed
runs, each joined by merge with the summed updates.

Defined cases: a null or empty text is one empty line; lines whose key is shorter than
``min_chars`` code points are never dropped; a line repeated in one document counts once
for it; documents are distinct ids, so rows that repeat an id are one document; a null id is
neither counted nor a holder, but its common lines go; empty tables give empty results; only
id and text are read, so extra columns cannot clash.
"""

from __future__ import annotations

import hashlib
import uuid
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE_CHARS, drop_folder, fresh_folder, ship, store, table

MIN_CHARS = 40
MIN_DOCS = 5
FAN_OUT = 4
BATCHES = 5
_SPACE = SPACE_CHARS.encode()
RUN_SCHEMA = "key binary, n_docs bigint, holder bigint"


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """128-bit hash of a line without outer white space, A-Z lower-cased; None if too short."""
    bare = line.strip(_SPACE).lower()
    if len(bare) < min_chars or (len(bare) < 4 * min_chars and len(bare.decode("utf-8", "surrogatepass")) < min_chars):
        return None
    return hashlib.blake2b(bare, digest_size=16).digest()


def _lines(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split(b"\n")


def line_keys(spark: SparkSession, docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, key): the distinct long lines of every document."""
    ship(spark)

    def keys(batches):
        for b in batches:
            ids, found = [], []
            for doc_id, text in zip(b.column(0), b.column(1)):
                own = {line_key(x, min_chars) for x in set(_lines(text.as_py()))} - {None}
                ids += [doc_id.as_py()] * len(own)
                found += own
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(found, pa.binary())], ["doc_id", "key"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(keys, "doc_id bigint, key binary")


class LineRuns:
    """Runs of line hashes under ``path``; ``levels[k]`` lists the runs of level k.

    A run is a pair of tables: lines, which no other run holds, and updates of lines of any run.
    """

    def __init__(self, spark: SparkSession, path: str, fan_out: int = FAN_OUT, buckets: int | None = None):
        self.spark, self.path, self.fan_out = spark, path, fan_out
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[tuple[str, str]]] = [[]]

    def runs(self) -> list[tuple[str, str]]:
        return [r for level in self.levels for r in level]

    def _write(self, rows: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        (rows.write.format("parquet").option("path", f"{self.path}/{name}")
            .bucketBy(self.buckets, "key").sortBy("key").saveAsTable(name))
        return name

    def _remove(self, runs: list[tuple[str, str]]) -> None:
        for n in (t for run in runs for t in run):
            self.spark.sql(f"DROP TABLE {n}")
            drop_folder(self.spark, f"{self.path}/{n}")

    def _unheld(self, batch: DataFrame, tables: list[str]) -> DataFrame:
        """Rows of the batch whose line none of the tables holds: a merge anti-join with each."""
        return reduce(
            lambda left, name: left.join(self.spark.table(name).select("key").hint("merge"), "key", "left_anti"), tables, batch)

    def add(self, pairs: DataFrame) -> None:
        """Add a batch of distinct (doc_id, key) as a run, then compact full levels."""
        batch = store(self.spark, pairs.groupBy("key").agg(
            F.count("doc_id").alias("n_docs"), F.max("doc_id").alias("holder")), "line-batch")
        lines = self._write(self._unheld(batch, [lines for lines, _ in self.runs()]))
        updates = self._write(self._unheld(batch, [lines]))
        self.levels[0].append((lines, updates))
        level = 0
        while len(self.levels[level]) >= self.fan_out:
            full = self.levels[level]
            if len(self.levels) == level + 1:
                self.levels.append([])
            dealt = self._plain([lines for lines, _ in full]).repartition(self.buckets, "key")
            self.levels[level + 1].append((self._write(dealt), self._write(self._summed([u for _, u in full]))))
            self.levels[level] = []
            self._remove(full)
            level += 1

    def _plain(self, names: list[str]) -> DataFrame:
        # plain scans: Spark 4.1 takes a union of bucketed scans for partitioned by the key
        # and sums it without an exchange, which leaves keys unmerged
        return self.spark.read.schema(RUN_SCHEMA).parquet(*[f"{self.path}/{n}" for n in names])

    def _summed(self, names: list[str]) -> DataFrame:
        return self._plain(names).groupBy("key").agg(F.sum("n_docs").alias("n_docs"), F.max("holder").alias("holder"))

    def totals(self) -> DataFrame:
        """(key, n_docs, holder) over all runs: a row per row of a run's lines."""
        if not self.runs():
            return self.spark.createDataFrame([], RUN_SCHEMA)
        more = self._summed([u for _, u in self.runs()]).select(
            "key", F.col("n_docs").alias("more"), F.col("holder").alias("later"))
        each = [
            self.spark.table(lines).join(more.hint("merge"), "key", "left").select(
                "key", (F.col("n_docs") + F.coalesce("more", F.lit(0))).alias("n_docs"), F.greatest("holder", "later").alias("holder"))
            for lines, _ in self.runs()]
        return reduce(DataFrame.unionByName, each)

    def close(self) -> None:
        self._remove(self.runs())
        self.levels = [[]]


def dedup_lines(spark: SparkSession, docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                batches: int = BATCHES) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_text) with lines held by many documents dropped.

    A line found in ``min_docs`` documents or more stays only in the largest id holding it.
    The table is added to the runs as ``batches`` slices of ids.
    """
    ship(spark)
    pairs = store(spark, line_keys(spark, docs, min_chars).distinct(), "line-keys")
    runs = LineRuns(spark, fresh_folder(spark, "line-runs"))
    slice_of = F.pmod(F.xxhash64("doc_id"), F.lit(batches))
    for k in range(batches):
        runs.add(pairs.filter(slice_of == k))
    common = store(spark, runs.totals().filter(F.col("n_docs") >= min_docs).select("key", "holder"), "common-lines")
    runs.close()
    drops = pairs.join(common, "key").filter(~F.col("doc_id").eqNullSafe(F.col("holder")))
    drops = drops.groupBy("doc_id").agg(F.collect_set("key").alias("keys"))
    rows = docs.select(F.col("doc_id").cast("bigint"), "text").join(
        drops.select(F.col("doc_id").alias("d_id"), "keys"), F.col("doc_id").eqNullSafe(F.col("d_id")), "left")

    def keep(parts):
        for b in parts:
            n_lines, dropped, kept = [], [], []
            for text, keys in zip(b.column(1), b.column(2)):
                lines, keys = _lines(text.as_py()), set(keys.as_py() or ())
                stay = [x for x in lines if line_key(x, min_chars) not in keys] if keys else lines
                n_lines.append(len(lines))
                dropped.append(len(lines) - len(stay))
                kept.append(b"\n".join(stay))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n_lines, pa.int64()), pa.array(dropped, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_lines", "n_dropped", "kept_text"])

    return rows.select("doc_id", "text", "keys").mapInArrow(
        keep, "doc_id bigint, n_lines bigint, n_dropped bigint, kept_text string")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dedup_lines(spark, table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


OP4_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
k AS (
  SELECT doc_id, i, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (
  SELECT key, max(doc_id) AS holder FROM k WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (
  SELECT k.doc_id, k.i, k.line, c.key IS NOT NULL AND k.doc_id <> c.holder AS dropped
  FROM k LEFT JOIN c ON k.key = c.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT dropped), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
