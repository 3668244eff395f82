"""A corpus pipeline of five operators over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result
as Parquet in the shared folder and reads it again as the next stage's ``docs``.  All stages
but the last return the columns of their input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.llm import bagminhash, mixing, phrase_index, site_quality, token_store
from martkit.llm.common import store, table

TOKENIZER = "word_bpe_49k.json"
_KEY = "_martkit_key"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject.

    Rows that share an id go together if any of them is rejected.
    """
    scored = site_quality.classify(spark, docs, table(spark, sf_dir, "labels"))
    bad = scored.filter(~F.col("kept")).select(F.col("doc_id").alias(_KEY)).distinct()
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col(_KEY)), "left_anti")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates; of kept rows with equal id and text, one."""
    found = bagminhash.near_duplicates(spark, docs).filter("kept")
    names = [f"{_KEY}_{c}" for c in ("doc_id", "t0", "t1")]
    found = found.groupBy(*[F.col(c).alias(n) for c, n in zip(("doc_id", "t0", "t1"), names)]).agg(F.count(F.lit(1)).alias(f"{_KEY}_n"))
    found = store(spark, found, "kept-rows")
    text = bagminhash.text_hashes(F.col("text"))
    same = F.col("doc_id").eqNullSafe(F.col(names[0])) & (text[0] == F.col(names[1])) & (text[1] == F.col(names[2]))
    kept = docs.join(found, same)
    once = kept.filter(F.col(f"{_KEY}_n") == 1)
    again = kept.filter(F.col(f"{_KEY}_n") > 1).dropDuplicates(names)
    return once.unionByName(again).select(docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without enough benchmark text to count as contaminated."""
    found = phrase_index.decontaminate(spark, docs, table(spark, sf_dir, "benchmark"))
    bad = found.filter("contaminated").select(F.col("doc_id").alias(_KEY)).distinct()
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col(_KEY)), "left_anti")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it (up to three times)."""
    copies = mixing.mix(spark, docs).groupBy("doc_id").agg(F.max("copies").alias("_martkit_copies"))
    copies = copies.filter("_martkit_copies > 0").withColumnRenamed("doc_id", _KEY)
    rows = docs.join(copies, F.col("doc_id").eqNullSafe(F.col(_KEY)))
    again = F.explode(F.sequence(F.lit(1), F.col("_martkit_copies").cast("int")))
    return rows.withColumn("_martkit_copy", again).select(docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in binary shards, read back: one row per document taken."""
    import public_tokenizers

    return token_store.tokens_of(spark, docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality classifier", quality),
    ("near-duplicates", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("source mixing", mix),
    ("token ids", tokens),
]

#: a fitted classifier and BagMinHash signatures are not SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(spark, stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
