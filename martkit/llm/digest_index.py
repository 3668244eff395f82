"""Exact de-duplication against a persistent digest index (DataFrame operations only).

The index is a table of one row per distinct text, bucketed and sorted by the SHA-256 of
the text without ASCII white space.  An arrival is reduced to its distinct digests, merge
anti-joined with the index (the index side is read by bucket and is not shuffled), and the
digests that are new are appended.  The first arrival of a text owns it.  Among rows of one
arrival the row with the most code points, then the smallest id, owns it.

Defined cases: a null text counts as empty; a null id sorts after every other id; rows that
repeat id and text share one decision; an empty table gives an empty result; only the id
and text columns are read, so extra columns cannot clash.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.snapshots import write_json_atomic
from ..sources.tables import path_exists
from .common import SPACE_CHARS, fresh_folder, read_text, store, table

ENTRY_SCHEMA = "digest binary, keep_id bigint, keep_chars bigint"


def text_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest, chars): digest of the text without white space, length of the original."""
    raw = F.coalesce(F.col(text_col), F.lit(""))
    bare = F.translate(raw, SPACE_CHARS, "")
    return docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.unhex(F.sha2(bare.cast("binary"), 256)).alias("digest"),
        F.char_length(raw).cast("bigint").alias("chars"),
    )


class DigestIndex:
    """A bucketed digest table at ``path``; reopening the path continues the same index.

    The bucket count is stored beside the entries and holds at every reopening, whatever
    the session's shuffle partitions are then; asking for another count is refused.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark, self.path = spark, path
        self.buckets = self._bucket_count(buckets)
        self.name = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self.name} ({ENTRY_SCHEMA}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS "
            f"LOCATION '{path}'"
        )

    def _bucket_count(self, wanted: int | None) -> int:
        """The stored bucket count of the path; a new path gets the wanted or default one."""
        marker = f"{self.path.rstrip('/')}/_index.json"
        if path_exists(self.spark, marker):
            held = json.loads(read_text(self.spark, marker))["buckets"]
            if wanted not in (None, held):
                raise ValueError(f"the index at {self.path} has {held} buckets, not {wanted}")
            return held
        if path_exists(self.spark, self.path) and not self.spark.read.schema(ENTRY_SCHEMA).parquet(self.path).isEmpty():
            raise ValueError(f"the index at {self.path} has entries but no stored bucket count")
        count = wanted or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        write_json_atomic(self.spark, marker, {"buckets": count})
        return count

    def entries(self) -> DataFrame:
        return self.spark.table(self.name)

    def add(self, digests: DataFrame) -> None:
        """Append the digests of an arrival that the index does not hold yet."""
        best = F.min(F.struct(
            (-F.col("chars")).alias("less"), F.col("doc_id").isNull().alias("no_id"), F.col("doc_id")
        )).alias("best")
        arrival = digests.groupBy("digest").agg(best)
        fresh = arrival.join(self.entries().select("digest").hint("merge"), "digest", "left_anti")
        (fresh.select("digest", F.col("best.doc_id").alias("keep_id"), (-F.col("best.less")).alias("keep_chars"))
            .write.mode("append").format("parquet").option("path", self.path)
            .bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(self.name))

    def decide(self, digests: DataFrame) -> DataFrame:
        """One row per document: who keeps its text, how many rows share it, is it kept.

        The documents join plain (unbucketed) scans of index and counts, so that adaptive
        execution can split the partition of a text that very many documents share.
        """
        entries = self.spark.read.schema(ENTRY_SCHEMA).parquet(self.path)
        sizes = digests.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"))
        owners = entries.join(sizes, "digest")
        return digests.join(owners, "digest").select(
            "doc_id", "keep_id", "group_size",
            (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("chars") == F.col("keep_chars"))).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )


def exact_dedup(spark: SparkSession, docs: DataFrame, arrival_chars: int = 2000) -> DataFrame:
    """Decide over a whole table with a new index.

    The table is added as two arrivals, texts of ``arrival_chars`` code points or more first.
    As longer originals arrive first, "the first arrival owns" and "the longest original
    stays" agree, and the second arrival is really anti-joined with a filled index.
    """
    digests = store(spark, text_digests(docs), "digests")
    index = DigestIndex(spark, fresh_folder(spark, "digest-index"))
    index.add(digests.filter(F.col("chars") >= arrival_chars))
    index.add(digests.filter(F.col("chars") < arrival_chars))
    owners = store(spark, index.decide(digests), "digest-decisions")
    spark.sql(f"DROP TABLE {index.name}")
    return owners


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(spark, table(spark, sf_dir, "documents"))


OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
r AS (
  SELECT doc_id, text_sha256,
         first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM r
"""
