"""Helpers shared by the operators: stored intermediate tables, shipped code, bounded batches."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: ASCII white space: space, tab, line feed, vertical tab, form feed, carriage return
SPACE_CLASS = r"[\x20\x09-\x0D]"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def _fs(spark: SparkSession, path: str):
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(sc._jsc.hadoopConfiguration()), p


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new folder name in the shared folder, deleted when the driver's JVM ends."""
    path = scratch_path(spark, name)
    fs, p = _fs(spark, path)
    fs.deleteOnExit(p)
    return path


def drop_folder(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file of any Hadoop file system, read by the driver."""
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def store(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives executors."""
    path = fresh_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: bytes of an Arrow batch; texts can be long, and a task holds a few copies of a batch
BATCH_BYTES = 8 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers (once per Spark context).

    Also bounds the session's Arrow batches, unless they are set to less already.
    """
    sc = spark.sparkContext
    bound = spark.conf.get(_BATCH_CONF, None)
    if bound is None or not 0 < sc._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(bound) <= BATCH_BYTES:
        spark.conf.set(_BATCH_CONF, str(BATCH_BYTES))
    if getattr(sc, "_martkit_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root = os.path.dirname(package)
    archive = os.path.join(tempfile.mkdtemp(prefix="martkit-code-"), "martkit_code.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(package):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(archive)
    sc._martkit_shipped = True


def release() -> None:
    """Give the memory that a worker no longer uses back to the machine."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def released(run):
    """``run`` over a task's batches, releasing its memory when it ends.

    Spark keeps several workers of an executor for later tasks; each would hold the most that
    any of its tasks took.
    """

    def task(batches):
        try:
            yield from run(batches)
        finally:
            release()

    return task


#: bytes of a slice of a batch
SLICE_BYTES = 1 << 20


def slices(batches) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about SLICE_BYTES, for results that are larger than their input."""
    for b in batches:
        step = max(1, b.num_rows * SLICE_BYTES // max(1, b.nbytes))
        for at in range(0, b.num_rows, step):
            yield b.slice(at, step)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def uniform(seed: str, key: Column) -> Column:
    """A repeatable number in (0, 1) from the first 52 bits of an MD5 of seed and key."""
    hexes = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))), 1, 13)
    return (F.conv(hexes, 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(2**52))


def text_rows(batches) -> Iterator[tuple]:
    """Rows of Arrow record batches as tuples, one at a time."""
    for b in batches:
        cols = b.columns
        for i in range(b.num_rows):
            yield tuple(c[i].as_py() for c in cols)
