"""Audit of how document filters interact, on a sparse document-term matrix.

Words get column numbers from a global dictionary: each block of documents codes its words
locally, the distinct words of all blocks are numbered, and the numbers are joined back to the
blocks' dictionary entries.  Each block then is a CSR shard (row starts, columns, counts) of
the matrix of all documents; row sums are word counts and row lengths are counts of distinct
words, which decide filters A and B.  C and D come from the text's bytes and E from a digest
of the text.  Documents are aggregated to (part, set of failed filters, labels) before the 600
steps of the 120 orders are laid out, so that work depends on documents only once.

Defined cases: a null text is empty, a null lang the part ''; a null id is not smaller than
any id, and E is false for it; of repeated ids each row counts, and a copy under the same id
is not one of a smaller id; several label rows of an id count together (any quality or toxic
of 1); an empty table gives an empty result; only id, text, lang and the label columns are
read, so extra columns cannot clash.
"""

from __future__ import annotations

import hashlib
import itertools
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ship, store, table
from .wordblocks import Codes, block_ids, entries_of, pack, rejoin, store_blocks, unpack

FILTERS = "ABCDE"
#: text of a block
BLOCK_BYTES = 16 << 20
#: fixed values: limits of A, B (percent of words) and C (percent of code points), characters of D
MIN_WORDS = 200
DISTINCT_PERCENT = 50
UPPER_PERCENT = 3
SYMBOLS = b"#$%&*|"

_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_INNER = bytes(range(0x80, 0xC0))  # bytes of UTF-8 that start no character

_DOCS = "doc_ids array<bigint>, parts array<string>, digests array<binary>, upper array<boolean>, symbols array<boolean>"
_BLOCK_SCHEMA = f"block bigint, {_DOCS}, starts binary, codes binary, counts binary, words array<binary>"
SHARD_SCHEMA = f"block bigint, {_DOCS}, starts binary, columns binary, counts binary"


def _without(text: bytes, chars: bytes) -> int:
    """How many bytes of the text are among ``chars``."""
    return len(text) - len(text.translate(None, chars))


class _Block:
    """Local counts of the documents of one block."""

    def __init__(self):
        self.docs: list[tuple] = []
        self.codes = Codes()
        self.rows: list[np.ndarray] = []
        self.bytes = 0

    def add(self, doc_id, part: str, text: bytes) -> None:
        points = len(text) - _without(text, _INNER)
        self.docs.append((
            doc_id, part, hashlib.sha256(text).digest(),
            100 * _without(text, _UPPER) > UPPER_PERCENT * points, _without(text, SYMBOLS) > 0))
        # bytes.split() splits at ASCII white space only
        self.rows.append(self.codes.of(text.split()))
        self.bytes += len(text)

    def row(self, number: int) -> pa.RecordBatch:
        sizes = [len(r) for r in self.rows]
        n = len(self.codes)
        keys = np.repeat(np.arange(len(sizes)), sizes) * max(n, 1) + np.concatenate(self.rows)
        keys, counts = np.unique(keys, return_counts=True)
        row, code = np.divmod(keys, max(n, 1))
        starts = np.searchsorted(row, np.arange(len(sizes) + 1))
        of_docs = [pa.array([list(c)], t) for c, t in zip(
            zip(*self.docs), (pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.binary()), pa.list_(pa.bool_()), pa.list_(pa.bool_())))]
        return pa.RecordBatch.from_arrays(
            [pa.array([number]), *of_docs, pa.array([pack(starts)]), pa.array([pack(code)]), pa.array([pack(counts)]),
             pa.array([list(self.codes)], pa.list_(pa.binary()))],
            ["block", "doc_ids", "parts", "digests", "upper", "symbols", "starts", "codes", "counts", "words"])


def _blocks(batches):
    numbers = block_ids()
    block = _Block()
    for b in batches:
        for doc_id, part, text in zip(*(c.to_pylist() for c in b.columns)):
            if block.docs and block.bytes + len(text) > BLOCK_BYTES:
                yield block.row(next(numbers))
                block = _Block()
            block.add(doc_id, part, text)
    if block.docs:
        yield block.row(next(numbers))


def word_dictionary(spark: SparkSession, words: DataFrame) -> DataFrame:
    """(word, column): all distinct words, numbered from 0 without gaps."""
    # the partition is in the upper bits of this id and the row within it in the lower 33
    rough = store(spark, words.distinct().withColumn("id", F.monotonically_increasing_id()), "words")
    part = F.shiftright("id", 33)
    sizes = sorted(rough.groupBy(part.alias("p")).count().collect())  # one row per partition
    before = dict(zip((p for p, _ in sizes), itertools.accumulate((n for _, n in sizes), initial=0)))
    if not before:
        return rough.withColumnRenamed("id", "column")
    firsts = spark.createDataFrame(list(before.items()), "p bigint, first bigint")
    row = F.col("id").bitwiseAND((1 << 33) - 1)
    return rough.withColumn("p", part).join(F.broadcast(firsts), "p").select("word", (F.col("first") + row).alias("column"))


def _shard(blocks: pa.Table, columns: pa.Table) -> pa.Table:
    """A block's CSR shard: local codes become columns of the global dictionary."""
    of_code = np.zeros(max(len(columns), 1), np.int64)
    of_code[columns.column("code").to_numpy()] = columns.column("column").to_numpy()
    found = of_code[unpack(blocks.column("codes")[0].as_py())].astype("<i8").tobytes()
    at = blocks.schema.get_field_index("codes")
    return blocks.set_column(at, "columns", pa.array([found], pa.binary()))


def term_matrix(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """CSR shards of all documents: row starts and counts packed, columns as 64-bit integers."""
    ship(spark)
    rows = docs.select(
        F.col("doc_id").cast("bigint"), F.coalesce("lang", F.lit("")).alias("part"),
        F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    blocks = store_blocks(spark, rows.mapInArrow(_blocks, _BLOCK_SCHEMA), "term_blocks")
    entries = entries_of(blocks)
    known = word_dictionary(spark, entries.select("word"))
    return rejoin(blocks, entries.join(known, "word").drop("word"), _shard, SHARD_SCHEMA)


def _row_counts(batches):
    """Per document: row sum (words) and row length (distinct words) of its shard, and its flags."""
    for b in batches:
        for s in b.to_pylist():
            starts = unpack(s["starts"]).astype(np.int64)
            distinct = np.diff(starts)
            running = np.concatenate([[0], np.cumsum(unpack(s["counts"]).astype(np.int64))])
            words = running[starts[1:]] - running[starts[:-1]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(s["doc_ids"], pa.int64()), pa.array(s["parts"], pa.string()), pa.array(s["digests"], pa.binary()),
                 pa.array(words), pa.array(distinct), pa.array(s["upper"], pa.bool_()), pa.array(s["symbols"], pa.bool_())],
                ["doc_id", "part", "digest", "words", "distinct_words", "upper", "symbols"])


def document_flags(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(doc_id, part, fails): bit 0 for filter A to bit 4 for E."""
    counted = term_matrix(spark, docs).mapInArrow(
        _row_counts, "doc_id bigint, part string, digest binary, words bigint, distinct_words bigint, upper boolean, symbols boolean")
    rows = store(spark, counted, "document-counts")
    # a stored table of its own, so that a text that very many documents share is split in the join
    copies = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
    copies = store(spark, copies.where("n > 1").select("digest", "first"), "copied-texts")
    failed = [
        F.col("words") < MIN_WORDS,
        100 * F.col("distinct_words") < DISTINCT_PERCENT * F.col("words"),
        F.col("upper"), F.col("symbols"),
        F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))]
    bits = sum((f.cast("int") * (1 << i) for i, f in enumerate(failed)), F.lit(0))
    return rows.join(copies, "digest", "left").select("doc_id", "part", bits.alias("fails"))


def _steps() -> str:
    """All steps of all orders as JSON: order, step, its filter's bit, the bits before it."""
    out = []
    for order in itertools.permutations(range(len(FILTERS))):
        before = 0
        for i, f in enumerate(order):
            out.append({"filter_order": "".join(FILTERS[x] for x in order), "step": i + 1, "bit": 1 << f, "before": before})
            before |= 1 << f
    return json.dumps(out)


def audit(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, filter order and step (contract of the module docstring)."""
    # equal rows as one with a count, so that the join by id meets no large group
    rows = document_flags(spark, docs).groupBy("doc_id", "part", "fails").agg(F.count(F.lit(1)).alias("n"))
    one = lambda c: F.coalesce(F.max((F.col(c) == 1).cast("int")), F.lit(0)).alias(f"_{c}")
    known = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(one("quality"), one("toxic"))
    flag = lambda c: F.coalesce(F.col(f"_{c}"), F.lit(0)).alias(f"_{c}")
    sets = (
        rows.join(known, "doc_id", "left").select("part", "fails", flag("quality"), flag("toxic"), "n")
        .groupBy("part", "fails", "_quality", "_toxic").agg(F.sum("n").alias("n")))
    steps = F.from_json(F.lit(_steps()), "array<struct<filter_order: string, step: int, bit: int, before: int>>")
    laid = sets.select("*", F.inline(steps))
    fails, bit, before = F.col("fails"), F.col("bit"), F.col("before")
    hit, gone = fails.bitwiseAND(bit) != 0, fails.bitwiseAND(before) != 0
    total = lambda when, name: F.sum(F.when(when, F.col("n")).otherwise(0)).alias(name)
    per_step = laid.groupBy("part", "filter_order", "step").agg(
        total(~hit & ~gone, "kept"), total(hit & ~gone, "removed"), total(hit & gone, "redundant"),
        total(fails == bit, "unique_fails"), total(hit & ~gone & (F.col("_quality") == 1), "good_lost"),
        total(hit & ~gone & (F.col("_toxic") == 1), "toxic_lost"))
    letter = F.substring("filter_order", F.col("step"), F.lit(1))
    per_step = per_step.withColumn("_filter", letter)
    # 120 rows per part and filter
    shares = per_step.groupBy("part", "_filter").agg(F.sum("removed").alias("shapley"))
    return per_step.join(shares, ["part", "_filter"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


_ORDERS = ", ".join(f"('{''.join(o)}')" for o in itertools.permutations(FILTERS))

OP12_SQL = rf"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
l AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
f AS (
  SELECT part, coalesce(l.good, FALSE) AS good, coalesce(l.toxic, FALSE) AS toxic,
         CASE WHEN len(words) < 200 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN d.doc_id > min(d.doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END AS fails
  FROM d LEFT JOIN l ON l.doc_id = d.doc_id),
s AS (SELECT part, fails, good, toxic, count(*) AS n FROM f GROUP BY ALL),
o AS (
  SELECT filter_order, CAST(step AS INTEGER) AS step, substr(filter_order, step, 1) AS letter,
         substr(filter_order, 1, step - 1) AS before
  FROM (VALUES {_ORDERS}) v(filter_order), (VALUES (1), (2), (3), (4), (5)) w(step)),
x AS (
  SELECT s.*, o.*, contains(fails, letter) AS hit, length(translate(before, fails, '')) < length(before) AS gone
  FROM s, o),
p AS (
  SELECT part, filter_order, step, letter,
         sum(CASE WHEN NOT hit AND NOT gone THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN hit AND NOT gone THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN hit AND gone THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN fails = letter THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN hit AND NOT gone AND good THEN n ELSE 0 END) AS good_lost,
         sum(CASE WHEN hit AND NOT gone AND toxic THEN n ELSE 0 END) AS toxic_lost
  FROM x GROUP BY ALL)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM p
"""
