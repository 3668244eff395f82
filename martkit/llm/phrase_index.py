"""Benchmark decontamination with a distributed positional inverted index.

Documents are packed into segments of a bounded amount of text.  A segment is one row: the
table of its documents, its terms, and for each term the sorted list of its positions.
Positions run through the whole segment with one free place between documents, so no match
can reach over a document's end.  The index is a stored table; a segment is searched by one
task on its own, so a frequent term is split over all segments and nothing is shuffled.

A phrase is looked up rarest term first: its list, less the term's offset in the phrase,
gives candidate starts, which are intersected with the offset-adjusted lists of the other
terms in ascending order of length.  ``slop`` > 0 also returns proximity matches: every
term at most ``slop`` places from its exact place relative to the rarest term.

Queries reach the segments in blocks of about ``block_windows`` phrases, dealt by hash.  One
block after another is read by the driver, searched and stored, so neither the driver nor a
search job ever holds more than one block; any number of blocks is run.

Defined cases: null and empty texts have no words and no matches; words inside the windows of
an item without an id are hit, but the item cannot be named among the items; repeated documents and items are matched each; empty tables give
empty results (or zero hits); only ids and texts are read, so extra columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import released, ship, store, table

WINDOW = 13
SEGMENT_BYTES = 8 << 20
BLOCK_WINDOWS = 50_000

SEGMENT_SCHEMA = "segment bigint, docs binary, no_id binary, terms binary, counts binary, gaps binary"
HIT_SCHEMA = "segment bigint, place int, starts array<int>, ends array<int>, queries array<bigint>"


def _byte_table() -> bytes:
    keep = bytearray(b" " * 256)
    for b in range(256):
        if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A:
            keep[b] = b
        elif 0x41 <= b <= 0x5A:
            keep[b] = b + 32
    return bytes(keep)


WORD_BYTES = _byte_table()


def words(text: str | None) -> list[bytes]:
    """Words of a text: A-Z lower-cased, runs of digits, letters and non-ASCII characters."""
    return text.encode("utf-8", "surrogatepass").translate(WORD_BYTES).split() if text else []


class _Ids(dict):
    def __missing__(self, key):
        self[key] = n = len(self)
        return n


class _Segment:
    def __init__(self, number: int):
        self.number, self.size, self.at = number, 0, 0
        self.ids, self.tokens, self.docs, self.no_id = _Ids(), [], [], []

    def add(self, doc_id: int | None, text: str | None) -> None:
        found = words(text)
        self.docs.append((0 if doc_id is None else doc_id, self.at, len(found)))
        self.no_id.append(doc_id is None)
        if found:
            self.tokens.append(np.fromiter(map(self.ids.__getitem__, found), np.int32, len(found)))
        self.at += len(found) + 1
        self.size += len(text or "") + 1

    def row(self) -> pa.RecordBatch:
        docs = np.array(self.docs, np.int64)
        tokens = np.concatenate(self.tokens) if self.tokens else np.zeros(0, np.int32)
        places = np.arange(len(tokens), dtype=np.int64) + np.repeat(np.arange(len(docs)), docs[:, 2])
        counts = np.bincount(tokens, minlength=len(self.ids)).astype(np.uint32)
        gaps = np.diff(places[np.argsort(tokens, kind="stable")].astype(np.uint32), prepend=np.uint32(0))
        cells = (docs.tobytes(), np.array(self.no_id, np.bool_).tobytes(), b"\n".join(self.ids),
                 counts.tobytes(), gaps.tobytes())
        names = ["segment", "docs", "no_id", "terms", "counts", "gaps"]
        return pa.RecordBatch.from_arrays(
            [pa.array([self.number], pa.int64()), *[pa.array([c], pa.binary()) for c in cells]], names)


def build_index(spark: SparkSession, docs: DataFrame, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """Store the positional index of ``docs`` (doc_id, text); one row per segment."""
    ship(spark)

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, made = TaskContext.get().partitionId() << 32, 0
        seg = _Segment(first)
        for b in batches:
            for doc_id, text in zip(b.column(0), b.column(1)):
                seg.add(doc_id.as_py(), text.as_py())
                if seg.size >= segment_bytes:
                    yield seg.row()
                    made += 1
                    seg = _Segment(first + made)
        if seg.docs:
            yield seg.row()

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text")).mapInArrow(released(pack), SEGMENT_SCHEMA)
    return store(spark, rows, "phrase-index")


class Lists:
    """Posting lists of one segment, read from its row."""

    def __init__(self, terms: bytes, counts: bytes, gaps: bytes):
        self.ids = {t: i for i, t in enumerate(terms.split(b"\n"))} if counts else {}
        self.counts = np.frombuffer(counts, np.uint32).astype(np.int64)
        self.ends = np.cumsum(self.counts)
        self.places = np.cumsum(np.frombuffer(gaps, np.uint32), dtype=np.uint32)

    def of(self, i: int) -> np.ndarray:
        return self.places[self.ends[i] - self.counts[i]: self.ends[i]].astype(np.int64)

    def starts(self, phrase: list[bytes], slop: int = 0) -> np.ndarray:
        """Start places of a phrase: rarest list first, then the others by length."""
        got = [self.ids.get(t, -1) for t in phrase]
        if min(got) < 0:
            return np.zeros(0, np.int64)
        order = sorted(range(len(got)), key=lambda k: (self.counts[got[k]], k))
        found = self.of(got[order[0]]) - order[0]
        for k in order[1:]:
            if not len(found):
                break
            places = self.of(got[k])
            at = np.searchsorted(places, found + (k - slop))
            near = at < len(places)
            near[near] = places[at[near]] <= found[near] + (k + slop)
            found = found[near]
        return found


def _search_rows(block: list[tuple[int, list[bytes]]], slop: int):
    """Search function of one query block: per document with matches its ranges and queries."""

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                segment, docs, _, terms, counts, gaps = (c[i].as_py() for c in b.columns)
                docs = np.frombuffer(docs, np.int64).reshape(-1, 3)
                lists = Lists(terms, counts, gaps)
                hits: dict[int, tuple[list, list, set]] = {}
                for query, phrase in block:
                    for start in lists.starts(phrase, slop):
                        low, high = start - slop, start + len(phrase) + slop
                        d = int(np.searchsorted(docs[:, 1], max(start, 0), "right")) - 1
                        begin, end = docs[d, 1], docs[d, 1] + docs[d, 2]
                        if slop == 0 or (start >= begin and start + len(phrase) <= end):
                            s, e, q = hits.setdefault(d, ([], [], set()))
                            s.append(int(max(low, begin) - begin))
                            e.append(int(min(high, end) - begin))
                            q.add(query)
                if hits:
                    places = sorted(hits)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([segment] * len(places), pa.int64()), pa.array(places, pa.int32()),
                        pa.array([hits[d][0] for d in places], pa.list_(pa.int32())),
                        pa.array([hits[d][1] for d in places], pa.list_(pa.int32())),
                        pa.array([sorted(hits[d][2]) for d in places], pa.list_(pa.int64())),
                    ], ["segment", "place", "starts", "ends", "queries"])

    return search


def search(spark: SparkSession, index: DataFrame, phrases: DataFrame, slop: int = 0,
           block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """Matches of ``phrases`` (query bigint, words array<binary>) in a stored index.

    Returns (segment, place, starts, ends, queries), a row per document with matches and
    block of queries; starts and ends are word offsets in the document.
    """
    ship(spark)
    n = phrases.count()
    blocks = max(1, -(-n // block_windows))
    out = None
    for k in range(blocks):
        part = phrases.filter(F.pmod(F.xxhash64("words"), F.lit(blocks)) == k) if blocks > 1 else phrases
        block = [(r["query"], [bytes(w) for w in r["words"]]) for r in part.collect()]
        found = store(spark, index.mapInArrow(released(_search_rows(block, slop)), HIT_SCHEMA), "phrase-hits")
        out = found if out is None else out.unionByName(found)
    return out


def item_windows(items: DataFrame, width: int = WINDOW) -> DataFrame:
    """Distinct windows of ``width`` words of the items (all words of a shorter item).

    Returns a stored table (query, words, item_ids): a number for each window text, and who
    holds it (nobody, if only items without an id do).
    """
    ship_schema = "item_id string, words array<binary>"

    def cut(batches):
        for b in batches:
            ids, found = [], []
            for item_id, text in zip(b.column(0), b.column(1)):
                w = words(text.as_py())
                for i in range(max(1, len(w) - width + 1) if w else 0):
                    ids.append(item_id.as_py())
                    found.append(w[i: i + width])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.string()), pa.array(found, pa.list_(pa.binary()))], ["item_id", "words"])

    rows = items.select(F.col("item_id").cast("string"), "text").mapInArrow(released(cut), ship_schema)
    held = rows.groupBy("words").agg(F.collect_set("item_id").alias("item_ids"))
    # the number is fixed by storing it
    return store(items.sparkSession, held.select(F.monotonically_increasing_id().alias("query"), "words", "item_ids"), "item-windows")


def decontaminate(spark: SparkSession, docs: DataFrame, items: DataFrame, width: int = WINDOW) -> DataFrame:
    """Per document: n_words, n_hit words inside benchmark windows, the items, contaminated.

    A document is contaminated if its hit words are at least a twentieth of its words.
    """
    ship(spark)
    index = build_index(spark, docs)
    windows = item_windows(items, width)
    hits = search(spark, index, windows.select("query", "words"))

    def directory(batches):
        for b in batches:
            for segment, docs_, no_id in zip(b.column(0), b.column(1), b.column(2)):
                d = np.frombuffer(docs_.as_py(), np.int64).reshape(-1, 3)
                missing = np.frombuffer(no_id.as_py(), np.bool_)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(d), segment.as_py(), np.int64)),
                    pa.array(np.arange(len(d), dtype=np.int32)),
                    pa.array(d[:, 0], mask=missing), pa.array(d[:, 2])],
                    ["segment", "place", "doc_id", "n_words"])

    def covered(batches):
        for b in batches:
            out = []
            for starts, ends in zip(b.column(2), b.column(3)):
                cells = sorted(zip([x for s in starts.as_py() for x in s], [x for e in ends.as_py() for x in e]))
                total, upto = 0, 0
                for s, e in cells:
                    total += max(0, e - max(s, upto))
                    upto = max(upto, e)
                out.append(total)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(out, pa.int64())], ["segment", "place", "n_hit"])

    every = index.select("segment", "docs", "no_id").mapInArrow(
        released(directory), "segment bigint, place int, doc_id bigint, n_words bigint")
    hit_words = hits.groupBy("segment", "place").agg(
        F.collect_list("starts").alias("starts"), F.collect_list("ends").alias("ends"))
    hit_words = hit_words.mapInArrow(released(covered), "segment bigint, place int, n_hit bigint")
    named = hits.select("segment", "place", F.explode("queries").alias("query")).join(
        windows.select("query", F.explode("item_ids").alias("item_id")), "query")
    named = named.groupBy("segment", "place").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    keys = ["segment", "place"]
    rows = every.join(hit_words.join(named, keys, "left"), keys, "left")
    n_hit = F.coalesce(F.col("n_hit"), F.lit(0))
    return rows.select(
        "doc_id", "n_words", n_hit.alias("n_hit"),
        F.coalesce(F.col("items"), F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decontaminate(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


OP2_SQL = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT item_id, least(13, len(w)) AS n, array_to_string(w[i + 1 : i + 13], ' ') AS k
  FROM iw, LATERAL (SELECT unnest(range(greatest(1, len(w) - 12))) AS i) WHERE len(w) > 0),
lens AS (SELECT DISTINCT n FROM win),
dwin AS (
  SELECT doc_id, i, n, array_to_string(w[i + 1 : i + n], ' ') AS k
  FROM dw, lens, LATERAL (SELECT unnest(range(greatest(0, len(w) - n + 1))) AS i)),
hit AS (SELECT d.doc_id, d.i, d.n, win.item_id FROM dwin d JOIN win ON d.k = win.k AND d.n = win.n),
words AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM hit) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
         array_to_string(list_sort(list_distinct(list(item_id::VARCHAR))), ',') AS names FROM hit GROUP BY doc_id)
SELECT dw.doc_id, len(dw.w)::BIGINT AS n_words, coalesce(words.n_hit, 0)::BIGINT AS n_hit,
       coalesce(items.n_items, 0)::BIGINT AS n_items, sha256(coalesce(items.names, '')) AS items_sha256,
       coalesce(words.n_hit, 0) > 0 AND 20 * coalesce(words.n_hit, 0) >= len(dw.w) AS contaminated
FROM dw LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""
