"""Blocks of documents with a dictionary of their own, and joins of those dictionaries.

A block is a run of documents of one task, of so many bytes of text or one longer document.
Its words are coded by first occurrence, so that a word that fills a third of a corpus is one
dictionary entry per block.  Entries are exploded and joined with a table of all distinct
words in Spark; what the join gives each entry goes back to its block by a cogroup, where the
code streams, which never pass through the join by word, take it up by position.
"""

from __future__ import annotations

import uuid

import numpy as np
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh_folder

SLICE = 1 << 17


class Codes(dict):
    """Codes of words by first occurrence."""

    def __missing__(self, word):
        code = self[word] = len(self)
        return code

    def of(self, words: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint32, len(words))


def block_ids():
    """Numbers of the blocks that this task makes, different from those of other tasks."""
    first = TaskContext.get().partitionId() << 32
    while True:
        yield first
        first += 1


def pack(values: np.ndarray) -> bytes:
    """Unsigned integers below 2^32, byte plane by byte plane, compressed: high planes are
    mostly zeros, and what a shuffle or a file holds of a number is little more than it tells."""
    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.compress(planes)


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def gather(codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray, source: np.ndarray) -> np.ndarray:
    """Stretches ``source[starts[c] : starts[c] + lengths[c]]`` of all codes one after another."""
    out = np.empty(sum(int(lengths[codes[lo:lo + SLICE]].sum()) for lo in range(0, len(codes), SLICE)), source.dtype)
    at = 0
    for lo in range(0, len(codes), SLICE):
        c = codes[lo:lo + SLICE]
        n = lengths[c]
        ends = np.cumsum(n)
        out[at:at + ends[-1]] = source[np.arange(ends[-1]) - np.repeat(ends - n - starts[c], n)]
        at += int(ends[-1])
    return out


def store_blocks(spark: SparkSession, blocks: DataFrame, name: str) -> DataFrame:
    """Write blocks once, compressed well and bucketed by block.

    Later scans read different columns of them, and the cogroup by block reads the streams
    from their buckets, without another shuffle.  The table's entry in the catalog is needed
    to name the buckets only, and goes at once; the files stay in the shared folder.
    """
    table = f"{name}_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (blocks.write.format("parquet").option("path", fresh_folder(spark, name)).option("compression", "zstd")
        .bucketBy(buckets, "block").saveAsTable(table))
    stored = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return stored


def entries_of(blocks: DataFrame) -> DataFrame:
    """(block, code, word): the dictionary entries of all blocks."""
    return blocks.select("block", F.posexplode("words").alias("code", "word"))


def rejoin(blocks: DataFrame, given: DataFrame, take_up, schema: str) -> DataFrame:
    """Blocks with what was joined to their entries: ``take_up(block_table, entry_table)``.

    ``given`` has block, code and the joined columns.  A group is one block, so its size is
    bounded by the block size of its maker or by the longest document.
    """
    given = given.toDF(*given.columns)  # new columns: both sides come from the same blocks
    return blocks.drop("words").groupBy("block").cogroup(given.groupBy("block")).applyInArrow(take_up, schema)
