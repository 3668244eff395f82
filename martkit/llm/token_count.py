"""Exact BPE token counts by heap-and-linked-list merging, without making identifiers.

The symbols of a piece form a linked list; a heap holds the ranks of adjacent pairs.  The
lowest rank (leftmost on ties) is popped and merged again and again; the count is the
number of initial symbols minus the number of merges.  Pieces repeat, so a task counts each
piece once per bounded cache.

Defined cases: a null or empty text has 0 tokens and 0 bytes; texts of any length are
counted whole; rows that repeat are counted each; an empty table gives an empty result;
only id and text are read, so extra columns cannot clash.
"""

from __future__ import annotations

import heapq

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ship, table
from .pieces import Cache, Splitter, byte_symbols

LIMIT = 2048


def count_merges(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """Number of merges that byte-pair merging does on the symbols of one piece."""
    n = len(symbols)
    heap = []
    for i in range(n - 1):
        r = ranks.get((symbols[i], symbols[i + 1]))
        if r is not None:
            heap.append((r, i))
    if not heap:
        return 0
    heapq.heapify(heap)
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    merges = 0
    while heap:
        rank, i = heapq.heappop(heap)
        left = symbols[i]
        j = after[i]
        # a stale entry: the symbol is gone, is last, or the pair has changed since
        if left is None or j >= n or ranks.get((left, symbols[j])) != rank:
            continue
        merges += 1
        symbols[i] = left = left + symbols[j]
        symbols[j] = None
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            r = ranks.get((left, symbols[k]))
            if r is not None:
                heapq.heappush(heap, (r, i))
        h = before[i]
        if h >= 0:
            r = ranks.get((symbols[h], left))
            if r is not None:
                heapq.heappush(heap, (r, h))
    return merges


class Counter:
    """Token counts for one tokenizer file."""

    def __init__(self, path: str):
        self.split = Splitter(path)
        self.stand = byte_symbols()
        pairs = self.split.spec["model"]["merges"]
        self.ranks = {tuple(p) if isinstance(p, list) else tuple(p.split(" ")): i for i, p in enumerate(pairs)}
        self.of_plain = Cache(self._plain)
        self.of_bytes = Cache(self._symbols)

    def _symbols(self, piece: str) -> int:
        symbols = list(piece)
        if self.split.suffix:
            symbols[-1] += self.split.suffix
        n = len(symbols)
        return n - count_merges(symbols, self.ranks)

    def _plain(self, piece: str) -> int:
        return self._symbols("".join(map(self.stand.__getitem__, piece.encode())))

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        found = self.split.short(text)
        if found is not None:
            return sum(map(self.of_plain.__getitem__, found))
        found, specials = self.split.full(text)
        return specials + sum(map(self.of_bytes.__getitem__, found))


_COUNTERS: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """The worker's counter for a file; kept for later tasks of the same worker."""
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path)
    return _COUNTERS[path]


def count_tokens(spark: SparkSession, docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row."""
    ship(spark)

    def count(batches):
        c = counter(path)
        for b in batches:
            texts = b.column(1)
            n_bytes = pa.array([len((t.as_py() or "").encode()) for t in texts], pa.int64())
            n = [c.count(t.as_py()) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), n_bytes, pa.array(n, pa.int64()), pa.array([x > limit for x in n])],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        count, "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean")


def op7_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
