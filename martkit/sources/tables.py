"""Scans: Parquet tables, catalog tables, contract scans, CSV re-reads, JDBC options."""

from __future__ import annotations

import re
from datetime import date, datetime

from pyspark.errors import ParseException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martkit.contract import check_schema
from martkit.errors import ContractError
from martkit.functions import nan_to_null

# Identifier pattern and default schema of qualified table names.
IDENTIFIER = re.compile(r"^[A-Za-z_][A-Za-z0-9_$]*$")
DEFAULT_SCHEMA = "public"


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


# Read schemas of the source columns the registered queries use.
SOURCE_SCHEMAS: dict[str, str] = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_totalprice double",
    "customer": "c_custkey bigint, c_nationkey int, c_acctbal double",
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string"
    ),
    "events": "event_id bigint, user_id bigint, event_type string, value double",
}


def read_table(spark: SparkSession, sf_dir: str, name: str, schema: str | None = None) -> DataFrame:
    """Scan one Parquet table; Catalyst prunes columns and pushes filters into it.

    With a declared schema (``SOURCE_SCHEMAS`` by default) the reader skips the
    footer-inference job that a schema-less read runs over the files.
    """
    schema = schema or SOURCE_SCHEMAS.get(name)
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(table_path(sf_dir, name))


def qualified_name(name: str, default_schema: str = DEFAULT_SCHEMA) -> str:
    """A table name as Spark parses it, in back-quotes; only ``[schema.]table`` of plain names."""
    parser = SparkSession.active()._jsparkSession.sessionState().sqlParser()
    try:
        seq = parser.parseMultipartIdentifier(name)
    except ParseException as bad:
        raise ValueError(f"{name!r} is no table identifier") from bad
    found = [default_schema, *(seq.apply(i) for i in range(seq.length()))][-2 if seq.length() < 2 else -seq.length():]
    if len(found) > 2 or not all(map(IDENTIFIER.fullmatch, found)):
        raise ValueError(f"{name!r} has more than a plain schema and table")
    return "`{}`.`{}`".format(*found)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check on any Hadoop file system (local, HDFS, object stores)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def table_exists(spark: SparkSession, name_or_path: str) -> bool:
    """A catalog table (``schema.table``) or a storage path exists."""
    if "/" in name_or_path or ":" in name_or_path:
        return path_exists(spark, name_or_path)
    return spark.catalog.tableExists(name_or_path)


def normalise_nan(df: DataFrame) -> DataFrame:
    """NaN -> NULL on every float/double column, in one projection."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(nan_to_null(f.name).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def contract_scan(df: DataFrame, columns, expected: T.StructType | None = None) -> DataFrame:
    """Exactly the named columns, in order; optional name+type check.

    The explicit projection reaches the Parquet reader as its ``ReadSchema``.
    """
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ContractError(f"contract scan: missing columns {missing}")
    out = df.select(*columns)
    if expected is not None:
        check_schema(out, expected, what="contract scan")
    return out


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header; the header must match the schema (no positional guessing)."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )


def csv_columns(spark: SparkSession, path: str) -> list[str]:
    """The column names of a CSV file's header."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path).columns


def jdbc_read_options(
    url: str,
    table: str,
    *,
    chunk_size: int = 100_000,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
) -> dict[str, str]:
    """S3: options for a bounded-memory, partitioned JDBC read.

    ``chunk_size`` becomes the driver fetch size (rows per round trip); a partition
    column splits the read into ``num_partitions`` parallel range scans.
    """
    if chunk_size <= 0:
        raise ValueError("chunk_size has to be at least 1")
    opts = {"url": url, "dbtable": qualified_name(table).replace("`", '"'), "fetchsize": str(chunk_size)}
    if partition_column is not None:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("partitioned read needs lower_bound, upper_bound and num_partitions")
        opts.update(
            partitionColumn=partition_column,
            lowerBound=str(lower_bound),
            upperBound=str(upper_bound),
            numPartitions=str(num_partitions),
        )
    return opts


def _sql_literal(value) -> str:
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, date):
        return f"DATE '{value.isoformat()}'"
    return repr(value) if isinstance(value, float) else str(value)


class RangePredicate(str):
    """An SQL predicate that holds the keys above ``low`` up to ``high`` (None: no bound on that
    side), NULL keys (``nulls``), or both."""

    def __new__(cls, text: str, low=None, high=None, *, values: bool = True, nulls: bool = False):
        self = super().__new__(cls, text)
        self.low, self.high, self.values, self.nulls = low, high, values, nulls
        return self


def range_predicates(df: DataFrame, key: str, chunk_size: int, accuracy: int = 10_000) -> list[RangePredicate]:
    """S3: SQL predicates on ``key`` that cut ``df`` into ranges of about ``chunk_size`` rows.

    The bounds are quantiles of the key, not steps of equal width, so a skewed key gives equal
    chunks too: each is off by at most two parts in ``accuracy`` of the rows, and a single
    key that holds more than a chunk is a chunk of its own.  The predicates are disjoint and
    cover every row, NULL keys included.  One aggregate pass over the key column; the key is a
    number, a date or a timestamp.
    """
    if chunk_size <= 0:
        raise ValueError("chunk_size has to be at least 1")
    name = key.replace('"', '""')
    n = df.count()
    chunks = max(1, -(-n // chunk_size))
    if chunks == 1:
        return [RangePredicate("1 = 1", nulls=True)]
    fractions = [i / chunks for i in range(1, chunks)]
    bounds = df.agg(F.percentile_approx(key, fractions, max(accuracy, 10 * chunks)).alias("b")).first()["b"] or []
    bounds = list(dict.fromkeys(bounds))  # a key of several chunks bounds one
    if not bounds:
        return [RangePredicate("1 = 1", nulls=True)]
    low = [RangePredicate(f'"{name}" <= {_sql_literal(bounds[0])}', high=bounds[0])]
    between = [
        RangePredicate(f'"{name}" > {_sql_literal(a)} AND "{name}" <= {_sql_literal(b)}', a, b)
        for a, b in zip(bounds, bounds[1:])]
    return low + between + [
        RangePredicate(f'"{name}" > {_sql_literal(bounds[-1])}', low=bounds[-1]),
        RangePredicate(f'"{name}" IS NULL', values=False, nulls=True)]


def _count_below(bounds: list, key: Column, key_type: str) -> Column:
    """How many of ``bounds`` are below ``key``, by binary search.

    The bounds are one literal, so the expression is as small for many ranges as for few.
    """
    if not bounds:
        return F.lit(0)
    found = F.split(F.lit("|".join(map(str, sorted(bounds)))), r"\|").cast(f"array<{key_type}>")
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(bounds).bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda n, s: F.when(F.get(found, n + s - 1) < key, n + s).otherwise(n))


def place_in_ranges(df: DataFrame, key: str, ranges: list[RangePredicate], *, number: str = "i", hits: str = "hits") -> DataFrame:
    """``df`` with the number of the range of ``ranges`` (ascending) that holds a row's key, and
    how many of them do.

    A range holds a key if its low bound is below it and its high bound is not, so the number of
    ranges that do is the difference of two counts, whether or not they overlap or leave gaps.
    """
    k, kind = F.col(key), df.schema[key].dataType.simpleString()
    values = [i for i, r in enumerate(ranges) if r.values]
    nulls = [i for i, r in enumerate(ranges) if r.nulls]
    lows = [ranges[i].low for i in values if ranges[i].low is not None]
    highs = [ranges[i].high for i in values if ranges[i].high is not None]
    out = df.withColumn(number, _count_below(lows, k, kind))
    # ranges without gaps share their bounds, and one search does
    out = out.withColumn(hits, F.col(number) if lows == highs else _count_below(highs, k, kind))
    begun = F.col(number) + (len(values) - len(lows))
    which = F.when(k.isNull(), F.lit(nulls[0] if nulls else None)).otherwise(begun - 1 + (values[0] if values else 0))
    held = F.when(k.isNull(), F.lit(len(nulls))).otherwise(begun - F.col(hits))
    return out.withColumns({number: which, hits: held})


def read_jdbc(spark: SparkSession, url: str, table: str, columns, *, key: str | None = None, properties=None, **kw) -> DataFrame:
    """S3 + S2: fetch-size-bounded JDBC scan of exactly ``columns``.

    With ``key`` the read is cut into balanced ranges of about ``chunk_size`` rows, one task
    each; else ``partition_column`` and its bounds give ranges of equal width.  The projection
    is pushed into the database query by Spark's JDBC source.
    """
    opts = jdbc_read_options(url, table, **kw)
    opts.update(properties or {})
    whole = spark.read.format("jdbc").options(**opts).load()
    if key is None:
        return whole.select(*columns)
    ranges = range_predicates(whole.select(key), key, int(opts["fetchsize"]))
    plain = {k: v for k, v in opts.items() if k not in ("url", "dbtable")}
    return spark.read.jdbc(url, opts["dbtable"], predicates=ranges, properties=plain).select(*columns)


def analyze_table(spark: SparkSession, name: str) -> None:
    """Column statistics for the cost-based optimizer on a catalog table."""
    spark.sql(f"ANALYZE TABLE {qualified_name(name)} COMPUTE STATISTICS FOR ALL COLUMNS")
