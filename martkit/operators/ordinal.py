"""The order in which a stored frame holds its rows, as a column.

A distributed frame has no order of its own, but the files that it is read from do: file by
name, and row by its place in the file.  ``with_input_order`` attaches that place, taken from
the scan's ``_metadata``, so that "the first" of several rows needs no column of the caller.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ORDINAL = "_input_order"


def _place(row_in_split: Column | None = None) -> Column:
    """File, offset of its split, and row: the row's index in the file, or in the split."""
    at = F.col("_metadata")
    if row_in_split is None:
        return F.struct(at["file_path"].alias("file"), F.lit(0).cast("bigint").alias("split"), at["row_index"].alias("row"))
    return F.struct(at["file_path"].alias("file"), at["file_block_start"].alias("split"), row_in_split.alias("row"))


def with_input_order(df: DataFrame, name: str = ORDINAL) -> DataFrame:
    """``df`` with its rows' places in the files that it scans.

    ``df`` has to be a file scan, with row-wise steps at most.  Parquet gives a row's index
    in the file.  Formats without one (CSV, JSON) give the offset of the row's split; rows of
    a split are read in order by one task, whose running number orders them.
    """
    try:
        return df.select("*", _place().alias(name))
    except AnalysisException:
        pass
    try:
        # the number runs over the splits of a task; within one split it follows the rows
        return df.select("*", _place(F.monotonically_increasing_id()).alias(name))
    except AnalysisException as none:
        raise ValueError("this frame does not scan files; its rows have an order only by a column") from none
