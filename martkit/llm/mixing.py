"""Mixing sources to target weights by Pareto order sampling.

Every document has an expected number of copies: its source's target size divided by the
source's size (times an optional document weight).  The whole part is allocated for
certain.  The fractional part is an inclusion probability p; the document draws a uniform
U from a hash of its id and is ranked by (U/(1-U)) / (p/(1-p)).  From each source the
lowest ranks are taken until the sample's size is the rest of the target: the fixed size
is counted in words, since targets are in words.  The last place goes to the document
beyond the cut whose size is nearest to what is still missing, if that brings the total
nearer.

The cut is found without sorting a source: two rounds of 256 rank bins per source (one
grouped sum over all documents, then sums of sums) leave one bin of 1/65,536 of the rank
range, and only that bin's documents are ordered.

Defined cases: a null or empty text has size 0; a null source is a source of its own, last
in order; equal ranks go by id, then size; rows that repeat an id are documents of their
own, and the last place goes to one of several equal rows; an empty table gives an empty
result; only id, text, source (and weight) are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import SPACE_CLASS, store, table, uniform

WORD = r"[^\x20\x09-\x0D]+"
CYCLE = (5, 2, 1)
MAX_COPIES = 3
BINS = 256


def word_count(text: Column) -> Column:
    """Number of runs of characters that are not ASCII white space (null: 0)."""
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), f"^{SPACE_CLASS}+|{SPACE_CLASS}+$", "")
    return F.when(bare == "", F.lit(0)).otherwise(
        F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD))).cast("bigint")


def cycle_weights(sources: DataFrame, cycle: tuple[int, ...] = CYCLE) -> DataFrame:
    """Weights repeating over the sources in code point order, null last (one row per source)."""
    w = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(w) - 1) % len(cycle)
    return sources.withColumn("weight", F.element_at(F.array(*[F.lit(c) for c in cycle]), place + 1).cast("bigint"))


def water_fill(weighted: DataFrame, max_copies: int = MAX_COPIES) -> DataFrame:
    """Adds ``target``: shares of the total size by weight, none above max_copies times its source.

    In ascending order of cap per weight, the capped sources are a prefix: the first source
    whose cap per weight exceeds the level left for it and all later ones ends the prefix.
    """
    cap = F.col("source_size") * max_copies
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing).orderBy(F.lit(1))
    rows = (
        weighted.withColumn("cap", cap)
        .withColumn("rest", F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("rest_weight", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("level", F.col("rest").cast("double") / F.col("rest_weight").cast("double"))
    )
    free = F.col("cap").cast("double") / F.col("weight").cast("double") >= F.col("level")
    rows = rows.withColumn("final", F.first(F.when(free, F.col("level")), True).over(whole))
    share = F.col("weight").cast("double") * F.col("final")
    return rows.withColumn(
        "target", F.least(F.col("cap").cast("double"), F.coalesce(share, F.col("cap").cast("double")))
    ).select("source", "source_size", "weight", "target")


def _cut(ranked: DataFrame, left: str) -> DataFrame:
    """Marks with ``within`` the rows of lowest rank whose sizes sum up to at most ``left``.

    Two rounds of grouped bin sums, then an ordered sum over the one bin that holds the cut.
    """
    fine = F.floor(F.col("rank01") * (BINS * BINS)).cast("int")
    ranked = ranked.withColumn("fine", F.least(fine, F.lit(BINS * BINS - 1)))
    by_fine = ranked.groupBy("source", "fine").agg(F.sum("size").alias("words"), F.first(left).alias("left"))
    coarse = F.floor(F.col("fine") / BINS).cast("int")
    by_coarse = by_fine.groupBy("source", coarse.alias("coarse")).agg(
        F.sum("words").alias("words"), F.first("left").alias("left"))
    up = Window.partitionBy("source").orderBy("coarse")
    c = by_coarse.withColumn("upto", F.sum("words").over(up)).filter(F.col("upto") > F.col("left"))
    c = c.groupBy("source").agg(F.min(F.struct("coarse", (F.col("upto") - F.col("words")).alias("below"))).alias("c"))
    c = c.select(F.col("source").alias("c_source"), F.col("c.coarse").alias("c_coarse"), F.col("c.below").alias("c_below"))
    inside = by_fine.join(
        c, F.col("source").eqNullSafe(F.col("c_source")) & (F.floor(F.col("fine") / BINS) == F.col("c_coarse")))
    up = Window.partitionBy("source").orderBy("fine")
    f = inside.withColumn("upto", F.col("c_below") + F.sum("words").over(up)).filter(F.col("upto") > F.col("left"))
    f = f.groupBy("source").agg(F.min(F.struct("fine", (F.col("upto") - F.col("words")).alias("below"))).alias("f"))
    f = f.select(F.col("source").alias("f_source"), F.col("f.fine").alias("f_fine"), F.col("f.below").alias("f_below"))
    joined = ranked.join(f, F.col("source").eqNullSafe(F.col("f_source")), "left")
    edge = joined.filter(F.col("fine") == F.col("f_fine"))
    rest = joined.filter(F.col("f_fine").isNull() | (F.col("fine") != F.col("f_fine")))
    # equal rows are summed as one row with a count, so that ids that repeat do not meet in the window
    edge = edge.groupBy(*edge.columns).agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("source").orderBy("rank01", F.col("doc_id").asc_nulls_last(), "size", "serial")
    upto = F.sum(F.col("size") * F.col("n")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    edge = edge.withColumn("upto", upto).withColumn("k", F.explode(F.expr("sequence(1L, n)")))
    edge = edge.withColumn(
        "within", F.col("f_below") + F.col("upto") - (F.col("n") - F.col("k")) * F.col("size") <= F.col(left))
    edge = edge.drop("n", "upto", "k")
    rest = rest.withColumn("within", F.col("f_fine").isNull() | (F.col("fine") < F.col("f_fine")))
    return edge.unionByName(rest).drop("f_source", "f_fine", "f_below", "fine")


def mix(spark: SparkSession, docs: DataFrame, seed: str = "mix", max_copies: int = MAX_COPIES,
        cycle: tuple[int, ...] = CYCLE) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) for every row of ``docs``."""
    sizes = store(spark, docs.select(
        F.col("doc_id"), F.col("source"), word_count(F.col("text")).alias("size")), "mix-sizes")
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = store(spark, water_fill(cycle_weights(sources, cycle), max_copies).select(
        F.col("source").alias("t_source"), "source_size", "target"), "mix-targets")
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size").cast("double")).otherwise(F.lit(0.0))
    whole = F.least(F.floor("expected"), F.lit(max_copies)).cast("bigint")
    p = F.col("expected") - F.col("certain").cast("double")
    u = uniform(seed, F.col("doc_id"))
    q = (F.col("u") / (1 - F.col("u"))) / (F.col("p") / (1 - F.col("p")))
    rows = (
        sizes.join(targets, F.col("source").eqNullSafe(F.col("t_source")))
        .withColumn("expected", expected).withColumn("certain", whole).withColumn("p", p)
        .withColumn("u", u)
        .withColumn("rank01", F.when(F.col("p") > 0, q / (1 + q)).otherwise(F.lit(1.0)))
        .withColumn("left", F.col("target") - (F.col("certain") * F.col("source_size")).cast("double"))
        .withColumn("serial", F.lit(0))
        .select("doc_id", "source", "size", "source_size", "target", "certain", "p", "rank01", "left", "serial")
    )
    # without a fraction there is nothing to cut: the whole copies are the result
    whole_only = rows.filter(~(F.col("p") > 0)).drop("p").withColumn("within", F.lit(False))
    cut = _cut(rows.filter(F.col("p") > 0).drop("p"), "left").unionByName(whole_only)
    # a number for each row, fixed by storing it: equal rows are told apart by it alone
    cut = store(spark, cut.withColumn("row", F.monotonically_increasing_id()), "mix-cut")
    got = cut.groupBy("source").agg(
        F.sum(F.when(F.col("within"), F.col("size")).otherwise(F.lit(0))).alias("got"))
    got = got.select(F.col("source").alias("g_source"), "got")
    near = cut.filter(~F.col("within") & (F.col("size") > 0)).join(got, F.col("source").eqNullSafe(F.col("g_source")))
    gap = F.col("left") - F.col("got").cast("double")
    miss = F.abs(F.col("size").cast("double") - gap)
    last = near.filter(miss < gap).groupBy("source").agg(F.min(F.struct(
        miss.alias("miss"), "rank01", F.col("doc_id").isNull().alias("no_id"), "doc_id", "size", "row")).alias("last"))
    last = last.select(F.col("source").alias("l_source"), F.col("last.row").alias("l_row"))
    closing = F.col("row") == F.col("l_row")
    out = cut.join(last, F.col("source").eqNullSafe(F.col("l_source")), "left")
    copies = F.col("certain") + F.when(F.col("within") | F.coalesce(closing, F.lit(False)), F.lit(1)).otherwise(F.lit(0))
    copies = F.when(F.col("left") > 0, copies).otherwise(F.col("certain"))
    return out.withColumn("copies", copies.cast("bigint")).select(
        "doc_id", "source", "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"))


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = mix(spark, table(spark, sf_dir, "documents"))
    return m.select("doc_id", "size", "source_size", "target", "taken")


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         ([5, 2, 1])[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::BIGINT AS weight
  FROM d GROUP BY source),
l AS (
  SELECT *, 3 * source_size AS cap,
         (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0))::BIGINT AS rest,
         (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::BIGINT AS rest_weight,
         row_number() OVER (ORDER BY 3 * source_size / weight::DOUBLE, source NULLS LAST) AS place
  FROM s WINDOW before AS (ORDER BY 3 * source_size / weight::DOUBLE, source NULLS LAST
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
v AS (
  SELECT min_by(rest::DOUBLE / rest_weight::DOUBLE, place) AS level FROM l
  WHERE cap::DOUBLE / weight::DOUBLE >= rest::DOUBLE / rest_weight::DOUBLE),
t AS (
  SELECT source, source_size,
         least(cap::DOUBLE, coalesce(weight::DOUBLE * (SELECT level FROM v), cap::DOUBLE)) AS target FROM l),
e AS (
  SELECT d.doc_id, d.source, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size::DOUBLE ELSE 0.0 END AS expected,
         (('0x' || substr(md5('mix:' || coalesce(d.doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5)
           / 4503599627370496.0::DOUBLE AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
p AS (
  SELECT *, least(floor(expected), 3)::BIGINT AS certain, expected - least(floor(expected), 3) AS p FROM e),
q AS (
  SELECT *, row_number() OVER () AS rid, CASE WHEN p > 0 THEN (u / (1 - u)) / (p / (1 - p)) ELSE 1.0 END AS q0,
         target - (certain * source_size)::DOUBLE AS left_words FROM p),
r AS (
  SELECT *, CASE WHEN p > 0 THEN q0 / (1 + q0) ELSE 1.0 END AS rank01 FROM q),
c AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY rank01, doc_id, size, rid
                            ROWS UNBOUNDED PRECEDING) <= left_words AS within FROM r),
g AS (SELECT source, coalesce(sum(size) FILTER (within), 0) AS got FROM c GROUP BY source),
n AS (
  SELECT c.source, c.doc_id, c.rid, abs(c.size::DOUBLE - (c.left_words - g.got::DOUBLE)) AS miss, c.rank01
  FROM c JOIN g ON c.source IS NOT DISTINCT FROM g.source
  WHERE NOT within AND size > 0 AND abs(c.size::DOUBLE - (c.left_words - g.got::DOUBLE)) < c.left_words - g.got::DOUBLE),
z AS (
  SELECT rid FROM (SELECT rid, row_number() OVER (PARTITION BY source ORDER BY miss, rank01, doc_id, rid) AS k FROM n)
  WHERE k = 1)
SELECT doc_id, size, source_size, target,
       ((certain + CASE WHEN left_words > 0 AND (within OR rid IN (SELECT rid FROM z)) THEN 1 ELSE 0 END) * size)::BIGINT
         AS taken
FROM c
"""
