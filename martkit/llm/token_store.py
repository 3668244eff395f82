"""Token ids in binary shards with a shared zstandard dictionary.

File format.  The documents are in ascending id order.  A shard ``<part>-<number>.tok`` is

    magic "MKTOK1\\0\\0" | 32-byte SHA-256 of the dictionary | frames | index | trailer

A frame is one document's ids (unsigned 32-bit little-endian, the end id last), compressed
on its own with the shared dictionary.  The index has one record of five signed 64-bit
integers per document: id (0 if null), 1 if the id is null, frame offset, frame length,
number of ids.  The trailer is the index offset and the number of documents (two signed
64-bit integers).  So one short document is read with three small reads: trailer, index,
frame.  ``dictionary.zdict`` holds the dictionary, the Parquet table ``manifest`` a row per
shard, ``starts`` the number of ids before each shard.

Shards are written by the tasks to a temporary name and renamed, so a task that runs again
after a lost executor writes the same bytes to the same place.  The dictionary is trained on
a bounded, documented sample (``SAMPLE_DOCS`` documents, at most ``SAMPLE_BYTES`` of each):
it changes the size of the files, never their content.

Defined cases: a null or empty text has the end id only; null ids sort first; documents of
equal id are ordered by text; an empty table gives no shards and an empty result; only id
and text are read, so extra columns cannot clash.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import fresh_folder, released, ship, table
from .pieces import Cache, Splitter, byte_symbols

MAGIC = b"MKTOK1\0\0"
END_ID = 1
SHARD_BYTES = 16 << 20
CHUNK_CHARS = 1 << 18
DICT_BYTES = 64 << 10
SAMPLE_DOCS = 512
SAMPLE_BYTES = 16 << 10
MANIFEST = "part int, number int, path string, n_docs bigint, n_ids bigint, n_bytes bigint"


class Encoder:
    """Ids of whole texts as little-endian bytes; pieces are encoded once per bounded cache."""

    def __init__(self, path: str):
        self.split = Splitter(path)
        self.stand = byte_symbols()
        self.model = self.split.library.model
        self.of_piece = Cache(self._piece)

    def _piece(self, piece: str) -> bytes:
        symbols = "".join(map(self.stand.__getitem__, piece.encode()))
        return array("I", [t.id for t in self.model.tokenize(symbols)]).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        get, out = self.of_piece.__getitem__, []
        for t in texts:
            found = self.split.short(t)
            if found is None:
                (e,) = self.split.library.encode_batch_fast([t], add_special_tokens=False)
                out.append(np.array(e.ids, "<u4").tobytes())
            else:
                out.append(b"".join(map(get, found)))
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    """Ids and texts in lists of about CHUNK_CHARS characters."""
    ids, texts, size = [], [], 0
    for b in batches:
        for doc_id, text in zip(b.column(0), b.column(1)):
            ids.append(doc_id.as_py())
            texts.append(text.as_py() or "")
            size += len(texts[-1])
            if size >= CHUNK_CHARS:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def train_dictionary(spark: SparkSession, docs: DataFrame, tokenizer: str) -> bytes:
    """A dictionary from the serialized ids of the SAMPLE_DOCS documents of smallest id hash."""
    import zstandard

    def arrays(batches):
        enc = encoder(tokenizer)
        for _, texts in _chunks(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[:SAMPLE_BYTES] for x in enc.encode(texts)], pa.binary())], ["ids"])

    chosen = docs.filter(F.col("text") != "").orderBy(F.xxhash64("doc_id")).limit(SAMPLE_DOCS)
    sample = [bytes(r[0]) for r in chosen.select("doc_id", "text").mapInArrow(released(arrays), "ids binary").collect()]
    try:
        return zstandard.train_dictionary(DICT_BYTES, sample).as_bytes()
    except (zstandard.ZstdError, ValueError):  # too few samples to train on: use them as they are
        return b"".join(sample)[-DICT_BYTES:]


class _Shard:
    def __init__(self, root: str, part: int, number: int, header: bytes):
        self.name = f"{part:06d}-{number:06d}.tok"
        self.path, self.part, self.number = f"{root}/{self.name}", part, number
        self.parts, self.size, self.index, self.n_ids = [header], len(header), [], 0

    def add(self, doc_id: int | None, frame: bytes, n: int) -> None:
        self.index.append((doc_id or 0, doc_id is None, self.size, len(frame), n))
        self.parts.append(frame)
        self.size += len(frame)
        self.n_ids += n

    def write(self) -> tuple:
        index = np.array(self.index, "<i8").tobytes()
        body = b"".join([*self.parts, index, struct.pack("<qq", self.size, len(self.index))])
        fs, place = pafs.FileSystem.from_uri(self.path)
        temporary = f"{place}.{uuid.uuid4().hex}.tmp"
        with fs.open_output_stream(temporary) as f:
            f.write(body)
        fs.move(temporary, place)
        return self.part, self.number, self.path, len(self.index), self.n_ids, len(body)


def write_tokens(spark: SparkSession, docs: DataFrame, tokenizer: str, root: str) -> DataFrame:
    """Write the shards of ``docs`` under ``root``; returns the manifest with each shard's start."""
    ship(spark)
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    dictionary = train_dictionary(spark, docs, tokenizer)
    fs, place = pafs.FileSystem.from_uri(root)
    fs.create_dir(place, recursive=True)
    with fs.open_output_stream(f"{place}/dictionary.zdict") as f:
        f.write(dictionary)
    header = MAGIC + hashlib.sha256(dictionary).digest()

    def write(batches):
        import zstandard

        enc, part, number = encoder(tokenizer), TaskContext.get().partitionId(), 0
        press = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(dictionary), write_content_size=True)
        end = struct.pack("<I", END_ID)
        shard = _Shard(root, part, number, header)

        def done(s):
            return pa.RecordBatch.from_pylist([dict(zip(("part", "number", "path", "n_docs", "n_ids", "n_bytes"), s.write()))],
                schema=pa.schema([("part", pa.int32()), ("number", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("n_bytes", pa.int64())]))

        for ids, texts in _chunks(batches):
            for doc_id, x in zip(ids, enc.encode(texts)):
                shard.add(doc_id, press.compress(x + end), len(x) // 4 + 1)
                if shard.size >= SHARD_BYTES:
                    yield done(shard)
                    number += 1
                    shard = _Shard(root, part, number, header)
        if shard.index:
            yield done(shard)

    ordered = docs.repartitionByRange(F.col("doc_id"), F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    ordered.mapInArrow(released(write), MANIFEST).write.parquet(f"{root}/manifest")
    shards = spark.read.schema(MANIFEST).parquet(f"{root}/manifest")
    # ids before a part: an ordered sum over one row per part; then over the shards of a part
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("part_ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("part_start", F.coalesce(F.sum("part_ids").over(before), F.lit(0)))
    inside = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    starts = shards.join(parts.select("part", "part_start"), "part").withColumn(
        "start", F.col("part_start") + F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).drop("part_start")
    starts.write.parquet(f"{root}/starts")
    return spark.read.schema(starts.schema).parquet(f"{root}/starts")


def read_dictionary(root: str) -> bytes:
    fs, place = pafs.FileSystem.from_uri(root)
    with fs.open_input_stream(f"{place}/dictionary.zdict") as f:
        return f.read()


class ShardReader:
    """Random access to one shard; refuses a dictionary with another hash."""

    def __init__(self, path: str, dictionary: bytes):
        import zstandard

        fs, place = pafs.FileSystem.from_uri(path)
        self.file = fs.open_input_file(place)
        size = self.file.size()
        head = self._at(0, len(MAGIC) + 32)
        if head != MAGIC + hashlib.sha256(dictionary).digest():
            raise ValueError(f"{path} was written with another dictionary or format")
        offset, n = struct.unpack("<qq", self._at(size - 16, 16))
        self.index = np.frombuffer(self._at(offset, n * 40), "<i8").reshape(-1, 5)
        self.unpress = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))

    def _at(self, offset: int, n: int) -> bytes:
        self.file.seek(int(offset))
        return self.file.read(int(n))

    def frame(self, k: int) -> bytes:
        _, _, offset, length, n = self.index[k]
        ids = self.unpress.decompress(self._at(offset, length))
        if len(ids) != 4 * n:
            raise ValueError("frame and index differ in the number of ids")
        return ids

    def close(self) -> None:
        self.file.close()


def read_document(root: str, path: str, doc_id: int) -> np.ndarray:
    """Ids of one document of a shard, read through the offset index alone."""
    reader = ShardReader(path, read_dictionary(root))
    try:
        (k, *_) = np.flatnonzero((reader.index[:, 0] == doc_id) & (reader.index[:, 1] == 0))
        return np.frombuffer(reader.frame(int(k)), "<u4")
    finally:
        reader.close()


def read_tokens(spark: SparkSession, shards: DataFrame, root: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) of every document, read back from the files."""
    ship(spark)

    def read(batches):
        dictionary = read_dictionary(root)
        for b in batches:
            for path, start in zip(b.column(0), b.column(1)):
                reader, at = ShardReader(path.as_py(), dictionary), start.as_py()
                try:
                    for low in range(0, len(reader.index), 256):
                        records = reader.index[low: low + 256]
                        frames = [reader.frame(low + i) for i in range(len(records))]
                        first = at + np.cumsum(records[:, 4]) - records[:, 4]
                        at += int(records[:, 4].sum())
                        yield pa.RecordBatch.from_arrays([
                            pa.array(records[:, 0], mask=records[:, 1] == 1), pa.array(first), pa.array(records[:, 4]),
                            pa.array([zlib.crc32(x) for x in frames], pa.int64()), pa.array(frames, pa.binary()),
                        ], ["doc_id", "start", "n_tokens", "ids_crc32", "ids"])
                finally:
                    reader.close()

    return shards.select("path", "start").mapInArrow(
        released(read), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, ids binary")


def tokens_of(spark: SparkSession, docs: DataFrame, tokenizer: str) -> DataFrame:
    root = fresh_folder(spark, "token-shards")
    shards = write_tokens(spark, docs, tokenizer, root)
    shards = shards.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path")
    return read_tokens(spark, shards, root).select("doc_id", "start", "n_tokens", "ids_crc32")


def op5_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokens_of(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
