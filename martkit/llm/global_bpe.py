"""Byte-level BPE of a whole corpus by a global shuffle of its distinct words; decoding.

Encoding: texts are cut into pre-tokens by the tokenizer's pattern and coded by block, the
blocks' dictionary entries are exploded and shuffled by word.  In a sorted partition the
entries of a word follow one another, so a task encodes every distinct word of the corpus once
and joins its ids to all its entries, which go back to their blocks in packed rows; there each
block puts the ids together by position.
Decoding joins ids with the token-byte table.  The table is as long as the vocabulary, so it
is broadcast if its bytes are within ``TABLE_BYTES``; a larger one is joined by a shuffle.

Ids are kept as bytes, little-endian unsigned 32-bit integers.

Defined cases: a null or empty text has no ids and decodes to no bytes; texts of any length
are encoded whole; repeated rows and null ids are returned each; an empty table gives an empty
result; an id outside the vocabulary or bytes that are no whole ids raise an error; null ids
decode to null.  Only id and text are read, so extra columns cannot clash.
"""

from __future__ import annotations

import base64
import heapq
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import read_text, release, released, ship, slices, store, table
from .wordblocks import Codes, block_ids, entries_of, gather, pack, rejoin, store_blocks, unpack

#: text of a block; larger ones have fewer dictionary entries to shuffle and need more memory
BLOCK_BYTES = 32 << 20
#: largest token-byte table that decoding broadcasts
TABLE_BYTES = 64 << 20

_BLOCK_SCHEMA = "block bigint, doc_ids array<bigint>, sizes array<int>, codes binary, words array<binary>"
TOKENS_SCHEMA = "doc_id bigint, ids binary"


# ------------------------------------------------------------------------- vocabulary


def parse_ranks(text: str) -> dict[bytes, int]:
    """Ranks of a rank file: per line a token in base 64 and its id."""
    pairs = (line.split() for line in text.splitlines() if line.strip())
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, encoding="ascii") as f:
        return parse_ranks(f.read())


_RANKS: dict[str, dict[bytes, int]] = {}


def ranks_of(path: str) -> dict[bytes, int]:
    """A worker's ranks of a file, kept for later tasks."""
    if path not in _RANKS:
        _RANKS[path] = load_ranks(path)
    return _RANKS[path]


def token_table(spark: SparkSession, path: str) -> DataFrame:
    """(id, token): the token-byte table of a rank file."""
    rows = [(i, t) for t, i in parse_ranks(read_text(spark, f"file:{path}")).items()]
    return spark.createDataFrame(rows, "id bigint, token binary")


# ----------------------------------------------------------------------------- words

#: characters below this are looked up in the narrow pattern's own classes
_NARROW_END = 0x250


class PreTokens:
    """Matches of a pattern; texts of Latin characters alone take a narrower, faster form of it.

    The narrow form writes out the characters below ``_NARROW_END`` of each class that the
    pattern names, so that it gives the same matches on such texts.
    """

    def __init__(self, pattern: str):
        self.wide = regex.compile(pattern)
        classes = {r"\p{L}": regex.compile(r"\p{L}"), r"\p{N}": regex.compile(r"\p{N}"), r"\s": regex.compile(r"\s")}
        chars = {
            name: "".join(re.escape(chr(c)) for c in range(_NARROW_END) if one.match(chr(c)))
            for name, one in classes.items()}
        narrow = pattern
        # inside a set first: [^\s\p{L}\p{N}] holds the same escapes without brackets of their own
        narrow = re.sub(r"\[[^\]]*\]", lambda m: self._written(m[0], chars, "", ""), narrow)
        narrow = self._outside(narrow, chars)
        spaces = chars[r"\s"]
        narrow = narrow.replace(r"\S", f"[^{spaces}]")
        self.narrow = re.compile(narrow)
        self.plain = re.compile(f"[\\x00-{chr(_NARROW_END - 1)}]*")

    @staticmethod
    def _written(part: str, chars: dict[str, str], left: str, right: str) -> str:
        for name, found in chars.items():
            part = part.replace(name, f"{left}{found}{right}")
        return part

    @classmethod
    def _outside(cls, pattern: str, chars: dict[str, str]) -> str:
        parts = re.split(r"(\[(?:\\.|[^\]\\])*\])", pattern)
        return "".join(p if p.startswith("[") else cls._written(p, chars, "[", "]") for p in parts)

    def of(self, text: str) -> list[str]:
        return (self.narrow if self.plain.fullmatch(text) else self.wide).findall(text)


#: words up to so many bytes are merged by a plain search for the lowest rank
SHORT = 40


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word: neighbours of the lowest rank merge first, the leftmost on ties."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    return _merge_short(word, ranks) if len(word) <= SHORT else _merge_long(word, ranks)


def _merge_short(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    none = 1 << 62  # above every rank
    parts = [word[i:i + 1] for i in range(len(word))]
    pairs = [ranks.get(word[i:i + 2], none) for i in range(len(word) - 1)]
    while pairs and (lowest := min(pairs)) < none:
        i = pairs.index(lowest)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i < len(pairs):
            pairs[i] = ranks.get(parts[i] + parts[i + 1], none)
        if i:
            pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
    return [ranks[p] for p in parts]


def _merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """With a heap of pairs over a linked list of parts, for words of any length."""
    n = len(word)
    parts: list[bytes | None] = [word[i:i + 1] for i in range(n)]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, 2) for i in range(n - 1) if (r := ranks.get(word[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, size = heapq.heappop(heap)
        left, j = parts[i], after[i]
        # stale if either side was merged since: their bytes together have grown or gone
        if left is None or j >= n or len(left) + len(parts[j]) != size:
            continue
        parts[i], parts[j] = left + parts[j], None
        k = after[i] = after[j]
        if k < n:
            before[k] = i
        for a, b in ((before[i], i), (i, k)):
            if a >= 0 and b < n:
                pair = parts[a] + parts[b]
                r = ranks.get(pair)
                if r is not None:
                    heapq.heappush(heap, (r, a, len(pair)))
    return [ranks[p] for p in parts if p is not None]


# ---------------------------------------------------------------------------- encode


class _Block:
    def __init__(self):
        self.ids: list = []
        self.codes = Codes()
        self.rows: list[np.ndarray] = []
        self.bytes = 0

    def add(self, doc_id, words: list[str], size: int) -> None:
        self.ids.append(doc_id)
        self.rows.append(self.codes.of(words))
        self.bytes += size

    def row(self, number: int) -> pa.RecordBatch:
        sizes = [len(r) for r in self.rows]
        stream = np.concatenate(self.rows)
        self.rows = []
        # frequent words get the small codes, which compress best
        order = np.argsort(-np.bincount(stream, minlength=len(self.codes)), kind="stable")
        code = np.empty(len(order), np.uint32)
        code[order] = np.arange(len(order))
        found = list(self.codes)
        words = [found[i].encode() for i in order]
        return pa.RecordBatch.from_arrays(
            [pa.array([number]), pa.array([self.ids], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int32())),
             pa.array([pack(code[stream])], pa.binary()), pa.array([words], pa.list_(pa.binary()))],
            ["block", "doc_ids", "sizes", "codes", "words"])


def _blocks_of(pattern: str):
    def blocks(batches):
        split = PreTokens(pattern)
        numbers = block_ids()
        block = _Block()
        for b in batches:
            for i in range(b.num_rows):
                text = b.column(1)[i].as_py() or ""
                if block.ids and block.bytes + len(text) > BLOCK_BYTES:
                    row, block = block.row(next(numbers)), _Block()
                    yield row
                block.add(b.column(0)[i].as_py(), split.of(text), len(text))
        if block.ids:
            row, block = block.row(next(numbers)), None
            yield row

    return blocks


#: entries that a task packs together
PACKED = 200_000
#: words of documents whose ids go to Spark together
BATCH_WORDS = 1 << 18
_GIVEN_SCHEMA = "block bigint, codes binary, sizes binary, ids binary"


def _pack_by_block(blocks: np.ndarray, codes: np.ndarray, ids: list[list[int]]) -> pa.RecordBatch:
    """Entries with ids, one row per block; codes ascend and are kept as differences."""
    order = np.lexsort((codes, blocks))
    found, firsts = np.unique(blocks[order], return_index=True)
    rows = []
    for part in np.split(order, firsts[1:]):
        own = [ids[i] for i in part]
        rows.append((pack(np.diff(codes[part], prepend=0)), pack(np.array([len(x) for x in own])), pack(np.array([i for x in own for i in x], np.int64))))
    columns = [pa.array(c, pa.binary()) for c in zip(*rows)]
    return pa.RecordBatch.from_arrays([pa.array(found), *columns], ["block", "codes", "sizes", "ids"])


def _encoder_of(path: str):
    def encoded(batches):
        """Entries sorted by word, so that each distinct word is encoded once."""
        ranks = ranks_of(path)
        word, of_word = None, []
        blocks, codes, ids, held = [], [], [], 0
        for b in batches:
            blocks.append(b.column(0).to_numpy())
            codes.append(b.column(1).to_numpy())
            for w in b.column(2).to_pylist():
                if w != word:
                    word, of_word = w, merge(w, ranks)
                ids.append(of_word)
            held += b.num_rows
            if held >= PACKED:
                yield _pack_by_block(np.concatenate(blocks), np.concatenate(codes), ids)
                blocks, codes, ids, held = [], [], [], 0
        if held:
            yield _pack_by_block(np.concatenate(blocks), np.concatenate(codes), ids)

    return encoded


def _joined(column: pa.ChunkedArray, read=unpack) -> np.ndarray:
    parts = [read(x) for x in column.to_pylist()]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint32)


def _reassemble(block: pa.Table, given: pa.Table) -> pa.Table:
    """Ids of a block's documents, by the positions of its words."""
    release()  # what the block before it took
    code = _joined(given.column("codes"), lambda x: np.cumsum(unpack(x), dtype=np.int64))
    n, source = _joined(given.column("sizes")).astype(np.int64), _joined(given.column("ids"))
    starts, lengths = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
    starts[code], lengths[code] = np.cumsum(n) - n, n
    codes = unpack(block.column("codes")[0].as_py())
    doc_ids, sizes = block.column("doc_ids")[0].values, block.column("sizes")[0].values.to_numpy()
    ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    out, first = [], 0
    while first < len(sizes):
        # documents of so many words, or one longer, are a batch of their own for Spark
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + BATCH_WORDS, "right")) - 1)
        own = codes[ends[first]:ends[last]]
        places = np.concatenate([[0], np.cumsum(lengths[own])])[ends[first:last + 1] - ends[first]] * 4
        ids = gather(own, starts, lengths, source).astype("<u4", copy=False)
        ids = pa.LargeBinaryArray.from_buffers(pa.large_binary(), last - first, [None, pa.py_buffer(places), pa.py_buffer(ids)])
        out.append(pa.RecordBatch.from_arrays([doc_ids[first:last], ids.cast(pa.binary())], ["doc_id", "ids"]))
        first = last
    return pa.Table.from_batches(out)


def encode(spark: SparkSession, docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids) of every row, by the ranks of the file at ``path`` on every machine."""
    ship(spark)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    blocks = store_blocks(spark, rows.mapInArrow(released(_blocks_of(pattern)), _BLOCK_SCHEMA), "token_blocks")
    entries = entries_of(blocks).repartition("word").sortWithinPartitions("word")
    return rejoin(blocks, entries.mapInArrow(released(_encoder_of(path)), _GIVEN_SCHEMA), _reassemble, TOKENS_SCHEMA)


# ---------------------------------------------------------------------------- decode


class TokenBytes:
    """The token-byte table as one array of bytes, indexed by id."""

    def __init__(self, tokens: list[tuple[int, bytes]]):
        n = max((i for i, _ in tokens), default=-1) + 1
        by_id = [b""] * n
        self.known = np.zeros(n, bool)
        for i, t in tokens:
            by_id[i] = t
            self.known[i] = True
        self.lengths = np.array([len(t) for t in by_id], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.source = np.frombuffer(b"".join(by_id), np.uint8)

    def decode(self, ids: bytes | None) -> bytes | None:
        if ids is None:
            return None
        codes = np.frombuffer(ids, "<u4")
        if len(codes) and (codes.max() >= len(self.known) or not self.known[codes].all()):
            raise ValueError("an id is not in the token-byte table")
        return gather(codes, self.starts, self.lengths, self.source).tobytes()


def _decode_broadcast(spark: SparkSession, tokens: DataFrame, known: DataFrame) -> DataFrame:
    lookup = spark.sparkContext.broadcast(TokenBytes([(r["id"], bytes(r["token"])) for r in known.collect()]))

    def decoded(batches):
        for b in slices(batches):
            found = [lookup.value.decode(x) for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found, pa.binary())], [*b.schema.names, "decoded"])

    schema = T.StructType([*tokens.schema.fields, T.StructField("decoded", T.BinaryType())])
    return tokens.mapInArrow(released(decoded), schema)


@F.arrow_udf(T.ArrayType(T.LongType()))
def _id_array(ids: pa.Array) -> pa.Array:
    return pa.array([None if x is None else np.frombuffer(x, "<u4").tolist() for x in ids.to_pylist()], pa.list_(pa.int64()))


def _decode_shuffled(spark: SparkSession, tokens: DataFrame, known: DataFrame) -> DataFrame:
    """Ids exploded with positions, joined with the table, put together by position."""
    rows = store(spark, tokens.withColumn("_row", F.monotonically_increasing_id()), "token-rows")
    each = rows.select("_row", F.posexplode(_id_array("ids")).alias("at", "id"))
    missing = F.raise_error(F.lit("an id is not in the token-byte table"))
    # hexadecimal digits, as Spark joins an array of strings but not one of bytes
    named = each.join(known, "id", "left").select("_row", "at", F.coalesce(F.hex("token"), missing).alias("token"))
    found = named.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("at", "token"))).alias("found"))
    text = F.unhex(F.array_join(F.transform("found", lambda x: x["token"]), ""))
    decoded = F.when(F.col("ids").isNotNull(), F.coalesce(text, F.lit(b"")))
    return rows.join(found, "_row", "left").select(*tokens.columns, decoded.alias("decoded"))


def decode(spark: SparkSession, tokens: DataFrame, known: DataFrame, broadcast_bytes: int = TABLE_BYTES) -> DataFrame:
    """``tokens`` with a column ``decoded``: the bytes of the tokens of ``ids``, by ``known`` (id, token)."""
    ship(spark)
    size = known.agg(F.coalesce(F.sum(F.octet_length("token") + 16), F.lit(0)).alias("n")).first()["n"]
    way = _decode_broadcast if size <= broadcast_bytes else _decode_shuffled
    return way(spark, tokens, known)


def op11_global_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as known

    path = known.path("byte_bpe_50k.tiktoken")
    tokens = encode(spark, table(spark, sf_dir, "documents"), path, known.PATTERN)
    both = decode(spark, tokens, token_table(spark, path))
    return both.select(
        "doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
