"""Row digests and order-independent checksums of whole relations (built-in functions)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def canonical(field: T.StructField) -> Column:
    """One form for equal values: -0.0 becomes 0.0 and every NaN the same one."""
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        zero = F.lit(0.0).cast(field.dataType)
        return F.when(F.isnan(c), F.lit(float("nan")).cast(field.dataType)).otherwise(c + zero)
    return c


def row_digest(df: DataFrame) -> tuple[Column, Column]:
    """Two 64-bit hashes of all columns of a row, NULLs by position.

    Equal rows have equal digests.  Different rows may share one by chance, so callers that
    must not confuse rows compare them in full where digests repeat.
    """
    values = [canonical(f) for f in df.schema.fields]
    # of every column: files read again have lost the knowledge that one is never NULL
    nulls = [F.col(f"`{f.name}`").isNull() for f in df.schema.fields]
    return tuple(F.xxhash64(F.lit(salt), *values, *nulls) for salt in (1, 2))


CHECKSUM = ("rows", "hash_sum", "hash_xor")


def checksum_metrics(df: DataFrame) -> list[Column]:
    """Aggregates that identify the multiset of rows of ``df``, whatever their order or files."""
    h, other = row_digest(df)
    return [
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(h.cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).alias("hash_sum"),
        F.coalesce(F.bit_xor(other), F.lit(0).cast("bigint")).alias("hash_xor"),
    ]


def checksum_dict(row: dict) -> dict:
    """A checksum as plain values that fit a JSON manifest."""
    return {"rows": int(row["rows"]), "hash_sum": str(int(row["hash_sum"])), "hash_xor": str(int(row["hash_xor"]))}


def checksum(df: DataFrame) -> dict:
    """The multiset checksum of ``df``: one aggregate pass."""
    return checksum_dict(df.agg(*checksum_metrics(df)).first().asDict())
