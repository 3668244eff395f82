"""Files on any Hadoop file system: atomic texts, fenced claims, one file out of many parts."""

from __future__ import annotations

import csv
import io
import os
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def write_bytes(fs, p, data: bytes) -> None:
    """A new file; an existing one is not overwritten."""
    out = fs.create(p, False)
    try:
        out.write(bytearray(data))
    finally:
        out.close()


def _move(spark: SparkSession, src, dst, *, overwrite: bool) -> None:
    """Rename as one step of the file system: over an existing file, or failing if there is one."""
    jvm = spark.sparkContext._jvm
    kind = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(kind, 1)
    how[0] = kind.OVERWRITE if overwrite else kind.NONE
    uri = src.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(src).toUri()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(uri, spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(src, dst, how)


def write_text(spark: SparkSession, path: str, text: str, *, overwrite: bool) -> None:
    """A whole text file or none: written beside ``path`` and renamed.

    Without ``overwrite`` an existing file stays and ``FileExistsError`` is raised, so of
    several writers of one path exactly one succeeds (as far as the file system's rename
    that does not overwrite is one step, as in HDFS).
    """
    fs, p = file_system(spark, path)
    tmp = p.suffix(f".tmp-{uuid.uuid4().hex}")
    fs.mkdirs(p.getParent())
    try:
        write_bytes(fs, tmp, text.encode("utf-8"))
        _move(spark, tmp, p, overwrite=overwrite)
    except Exception as failed:
        fs.delete(tmp, False)
        if not overwrite and "FileAlreadyExists" in str(failed):
            raise FileExistsError(path) from None
        raise


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file, read by the driver."""
    fs, p = file_system(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    fs, p = file_system(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def names(spark: SparkSession, path: str) -> list[str]:
    fs, p = file_system(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p)]


def replace(fs, src, dst) -> None:
    """Move a folder ``src`` to ``dst``; what was there is set aside first and put back on failure."""
    old = None
    if fs.exists(dst):
        old = dst.suffix(f".old-{uuid.uuid4().hex}")
        if not fs.rename(dst, old):
            raise RuntimeError(f"could not set {dst} aside")
    if not fs.rename(src, dst):
        if old is not None:
            fs.rename(old, dst)
        raise RuntimeError(f"could not replace {dst}")
    if old is not None:
        fs.delete(old, True)


def replace_file(spark: SparkSession, src: str, dst: str) -> None:
    """Move a file over ``dst`` in one step; a folder of that name is set aside first."""
    fs, p = file_system(spark, dst)
    if fs.exists(p) and fs.getFileStatus(p).isDirectory():
        replace(fs, file_system(spark, src)[1], p)
    else:
        _move(spark, file_system(spark, src)[1], p, overwrite=True)


# ------------------------------------------------------------ one file of many parts

COPY_BYTES = 8 << 20
_PART = re.compile(r"part-(\d+)")


def csv_header(columns) -> bytes:
    line = io.StringIO()
    csv.writer(line, lineterminator="\n").writerow(columns)
    return line.getvalue().encode("utf-8")


def _copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row (source, target, offset): the source's bytes to their place in the target."""
    for b in batches:
        done = []
        for x in b.to_pylist():
            with open(x["source"], "rb") as src, open(x["target"], "r+b") as out:
                out.seek(x["at"])
                n = 0
                while chunk := src.read(COPY_BYTES):
                    out.write(chunk)
                    n += len(chunk)
                out.flush()
                os.fsync(out.fileno())
            done.append(n)
        yield pa.RecordBatch.from_arrays([pa.array(done, pa.int64())], ["bytes"])


def stitch(spark: SparkSession, folder: str, target: str, header: bytes) -> int:
    """One file ``target`` out of a header and the part files of ``folder``, in part order.

    The place of each part is the sum of the sizes before it, so on a file system with a
    mounted path (``file:``) tasks copy the parts side by side; elsewhere the file system
    links them itself (``concat``), which moves no bytes.  Neither passes rows through one
    task or the driver.  A file system that can do neither raises ``NotImplementedError``.
    Returns the size of the file.
    """
    fs, p = file_system(spark, folder)
    parts = [(int(m[1]), s.getPath(), s.getLen()) for s in fs.listStatus(p) if (m := _PART.match(s.getPath().getName()))]
    # a task that writes several files numbers them in their names
    parts = [(path, size) for _, path, size in sorted(parts, key=lambda x: (x[0], x[1].getName())) if size]
    total = len(header) + sum(size for _, size in parts)
    target_fs, whole = file_system(spark, target)
    whole = target_fs.makeQualified(whole)
    if whole.toUri().getScheme() == "file":
        _copy_parts(spark, parts, whole.toUri().getPath(), header)
    else:
        write_bytes(target_fs, whole, header)
        _link_parts(spark, target_fs, parts, whole)
    if target_fs.getFileStatus(whole).getLen() != total:
        raise OSError(f"parts of {folder} changed while they were put together")
    return total


def _copy_parts(spark: SparkSession, parts: list, target: str, header: bytes) -> None:
    # past the file system's classes, which would keep a checksum of the header alone
    with open(target, "xb") as out:
        out.write(header)
    rows, at = [], len(header)
    for path, size in parts:
        rows.append((path.toUri().getPath(), target, at))
        at += size
    if rows:
        plan = spark.createDataFrame(rows, "source string, target string, at bigint")
        plan.repartition(len(rows)).mapInArrow(_copy, "bytes bigint").collect()  # one number per part


def _link_parts(spark: SparkSession, fs, parts: list, whole) -> None:
    if not parts:
        return
    array = spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.org.apache.hadoop.fs.Path, len(parts))
    for i, (path, _) in enumerate(parts):
        array[i] = path
    try:
        fs.concat(whole, array)
    except Exception as failed:
        if "UnsupportedOperation" not in str(failed):
            raise
        raise NotImplementedError("this file system can neither concatenate files nor write at an offset") from None
