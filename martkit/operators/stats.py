"""A2-A4: exact interpolated quantiles, medians, mode.

Three quantile modes:

* ``exact``    selection by rank brackets (the default).  A mergeable sketch of bounded rank
               error, taken on the scan, gives a value bracket for each wanted rank; one more
               pass counts what lies below, on and between the bracket's ends.  A rank on an
               end is found at once, however many rows hold that value.  Brackets that still
               hold many rows are sketched again, and only values strictly inside the last
               brackets are shuffled and ranked.
* ``builtin``  Spark's ``percentile``: one value->count map per column, merged in one task.
* ``approx``   ``percentile_approx``; returns an element, no interpolation.

All of them return a one-row DataFrame.  Row-level consumers (imputation, capping)
read that single row once (``row_values``) and use the values as literals, so the
consuming plan has no join and no subquery and stays inside whole-stage codegen.
Report-style consumers combine one-row frames lazily with ``combine_rows``.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class QuantileTarget:
    name: str  # output column
    column: str  # input column
    p: float  # fraction in [0, 1]


def medians(columns, suffix: str = "_median") -> list[QuantileTarget]:
    return [QuantileTarget(f"{c}{suffix}", c, 0.5) for c in columns]


def quartiles(columns) -> list[QuantileTarget]:
    out = []
    for c in columns:
        out += [QuantileTarget(f"{c}_q1", c, 0.25), QuantileTarget(f"{c}_q3", c, 0.75)]
    return out


def row_values(one_row: DataFrame) -> dict:
    """The single row of a statistics frame (a bounded, one-row result)."""
    row = one_row.first()
    return row.asDict() if row is not None else {c: None for c in one_row.columns}


def literal(value, dtype) -> Column:
    return F.lit(value).cast(dtype)


def combine_rows(*one_rows: DataFrame) -> DataFrame:
    """Columns of several one-row frames side by side, lazily and without a join:
    each frame is padded with NULLs to the union of the columns, the frames are
    stacked, and one global aggregate keeps each column's only non-NULL value."""
    types = {}
    for fr in one_rows:
        for f in fr.schema.fields:
            types[f.name] = f.dataType
    cols = list(types)
    padded = [
        fr.select(*[F.col(f"`{c}`") if c in fr.columns else F.lit(None).cast(types[c]).alias(c) for c in cols])
        for fr in one_rows
    ]
    stacked = padded[0]
    for p in padded[1:]:
        stacked = stacked.unionByName(p)
    return stacked.agg(*[F.max(F.col(f"`{c}`")).alias(c) for c in cols])


# ---------------------------------------------------------------- exact / approx


def _grouped(targets):
    by_col: dict[str, list[QuantileTarget]] = defaultdict(list)
    for t in targets:
        by_col[t.column].append(t)
    return by_col


def _builtin(df: DataFrame, targets, approx_accuracy: int | None) -> DataFrame:
    """One aggregate; one percentile call per column covers all its fractions."""
    aggs, picks = [], []
    for i, (col, ts) in enumerate(_grouped(targets).items()):
        ps = [t.p for t in ts]
        if approx_accuracy is None:
            agg = F.percentile(F.col(col), ps)
        else:
            agg = F.percentile_approx(F.col(col), ps, approx_accuracy)
        aggs.append(agg.alias(f"_q{i}"))
        picks += [F.col(f"_q{i}")[j].cast("double").alias(t.name) for j, t in enumerate(ts)]
    return df.agg(*aggs).select(*picks)


# -------------------------------------------------------------- rank brackets


#: the sketch's rank error is at most 1 / ACCURACY of its rows
ACCURACY = 10_000
#: brackets with more rows are sketched again; fewer are shuffled and ranked
FEW_ROWS = 100_000


def _interpolate(pos: float, lo: int, hi: int, v_lo: float, v_hi: float) -> float:
    # Same arithmetic as Spark's percentile, so both exact modes agree bit for bit.
    if hi == lo or v_lo == v_hi:
        return v_lo
    return (hi - pos) * v_lo + (pos - lo) * v_hi


def _above(b: float, a: float) -> bool:
    """``b > a`` in Spark's order, where NaN is above every number."""
    return (b != b and a == a) or b > a


@dataclass(frozen=True)
class Bracket:
    """The place of one wanted rank: strictly between ``lo`` and ``hi`` (None: open), with
    ``below`` rows not above ``lo`` and ``inside`` rows between them."""

    column: str
    rank: int
    below: int
    inside: int
    lo: float | None = None
    hi: float | None = None

    @property
    def span(self) -> tuple:
        return self.column, self.lo, self.hi


def _value(column: str) -> Column:
    return F.col(f"`{column}`").cast("double")


def _within(span: tuple) -> Column:
    column, lo, hi = span
    inside = _value(column).isNotNull()
    if lo is not None:
        inside = inside & (_value(column) > F.lit(lo))
    if hi is not None:
        inside = inside & (_value(column) < F.lit(hi))
    return inside


def _sketch(df: DataFrame, wanted: dict[tuple, list[float]], accuracy: int) -> list:
    """Per span the sketched values at its fractions and its number of rows: one pass."""
    aggs = []
    for i, (span, fractions) in enumerate(wanted.items()):
        v = F.when(_within(span), _value(span[0]))
        aggs += [F.percentile_approx(v, fractions, accuracy).alias(f"v{i}"), F.count(v).alias(f"n{i}")]
    row = df.agg(*aggs).first()
    return [(row[f"v{i}"], row[f"n{i}"]) for i in range(len(wanted))]


def _fractions(center: float, accuracy: int) -> list[float]:
    margin = 2 / accuracy
    return [max(0.0, center - margin), min(1.0, center + margin)]


def _close_in(df: DataFrame, brackets: dict, ends: dict, accuracy: int) -> tuple[dict, dict]:
    """One counting pass: brackets with sketched ``ends`` shrink to the part that holds their
    rank.  Returns the found values and the smaller brackets."""
    parts: dict[tuple, int] = {}
    for key, b in brackets.items():
        parts.setdefault((b.span, ends[key]), len(parts))
    aggs = []
    for (span, (lo, hi)), i in parts.items():
        v, inside = _value(span[0]), _within(span)
        wide = F.lit(_above(hi, lo))
        aggs += [
            F.count_if(inside & (v < F.lit(lo))).alias(f"a{i}"), F.count_if(inside & (v == F.lit(lo))).alias(f"b{i}"),
            F.count_if(inside & (v > F.lit(lo)) & (v < F.lit(hi))).alias(f"c{i}"),
            F.count_if(inside & wide & (v == F.lit(hi))).alias(f"d{i}")]
    counts = df.agg(*aggs).first()
    found, left = {}, {}
    for key, b in brackets.items():
        lo, hi = ends[key]
        i = parts[b.span, ends[key]]
        rest = b.inside - sum(counts[f"{x}{i}"] for x in "abcd")
        below = b.below
        # the five parts in value order: rows of each, and a single value or the ends around it
        for n, value, around in (
            (counts[f"a{i}"], None, (b.lo, lo)), (counts[f"b{i}"], lo, None), (counts[f"c{i}"], None, (lo, hi)),
            (counts[f"d{i}"], hi, None), (rest, None, (hi, b.hi)),
        ):
            if b.rank < below + n:
                break
            below += n
        if around is None:
            found[key] = value
        elif n >= b.inside:
            raise RuntimeError(f"the bracket of rank {b.rank} in {b.column} did not get smaller")
        else:
            left[key] = Bracket(b.column, b.rank, below, n, *around)
    return found, left


def _rank_inside(df: DataFrame, brackets: dict) -> dict:
    """The values of ranks whose brackets hold few rows: only those rows are shuffled."""
    spans = list(dict.fromkeys(b.span for b in brackets.values()))
    cells = [F.when(_within(s), F.struct(F.lit(i).alias("span"), _value(s[0]).alias("v"))) for i, s in enumerate(spans)]
    held = df.where(reduce(lambda a, b: a | b, map(_within, spans))).select(F.inline(F.array_compact(F.array(*cells))))
    counts = held.groupBy("span", "v").agg(F.count(F.lit(1)).alias("n"))
    running = F.sum("n").over(Window.partitionBy("span").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    ranked = counts.withColumn("upto", running)
    wanted = {k: (spans.index(b.span), b.rank - b.below) for k, b in brackets.items()}
    hit = reduce(lambda a, b: a | b, (
        (F.col("span") == s) & (F.col("upto") - F.col("n") <= r) & (r < F.col("upto")) for s, r in set(wanted.values())))
    rows = ranked.where(hit).collect()  # one row per wanted rank at most
    return {k: next(x["v"] for x in rows if x["span"] == s and x["upto"] - x["n"] <= r < x["upto"]) for k, (s, r) in wanted.items()}


def _exact(df: DataFrame, targets, accuracy: int = ACCURACY, few_rows: int = FEW_ROWS) -> dict[str, float | None]:
    by_column = _grouped(targets)
    spans = {(c, None, None): [f for t in ts for f in _fractions(t.p, accuracy)] for c, ts in by_column.items()}
    sketched = dict(zip(by_column, _sketch(df, spans, accuracy)))
    brackets, ends, place, found = {}, {}, {}, {}
    for c, ts in by_column.items():
        values, n = sketched[c]
        for j, t in enumerate(ts):
            if n == 0:
                continue
            pos = (n - 1) * t.p
            place[t.name] = (pos, math.floor(pos), math.ceil(pos))
            for rank in place[t.name][1:]:
                brackets[c, rank] = Bracket(c, rank, 0, n)
                ends[c, rank] = (values[2 * j], values[2 * j + 1])
    while brackets:
        got, left = _close_in(df, brackets, ends, accuracy)
        found |= got
        many = {k: b for k, b in left.items() if b.inside > few_rows}
        few = {k: b for k, b in left.items() if k not in many}
        if few:
            found |= _rank_inside(df, few)
        brackets = many
        if many:
            spans = defaultdict(list)
            for b in many.values():
                spans[b.span] += _fractions((b.rank - b.below + 0.5) / b.inside, accuracy)
            sketched = {s: iter(v) for s, (v, _) in zip(spans, _sketch(df, spans, accuracy))}
            ends = {k: (next(sketched[b.span]), next(sketched[b.span])) for k, b in many.items()}
    out = {}
    for c, ts in by_column.items():
        for t in ts:
            out[t.name] = None
            if t.name in place:
                pos, lo, hi = place[t.name]
                out[t.name] = _interpolate(pos, lo, hi, found[c, lo], found[c, hi])
    return out


def _literal_row(spark, values: dict[str, float | None], order) -> DataFrame:
    schema = T.StructType([T.StructField(n, T.DoubleType()) for n in order])
    return spark.createDataFrame([tuple(values[n] for n in order)], schema)


# ------------------------------------------------------------------------ public


def quantile_stats(df: DataFrame, targets: list[QuantileTarget], mode: str = "exact", **kw) -> DataFrame:
    """One-row DataFrame with a double column per target (NULL if no non-null input).

    ``exact`` reads ``df`` two or three times (pruned to the target columns), so an expensive
    input is staged first.  ``accuracy`` and ``few_rows`` set the work of a pass, not the result.
    """
    if mode == "exact":
        values = _exact(df, targets, **kw)
        return _literal_row(df.sparkSession, values, [t.name for t in targets])
    if mode == "builtin":
        return _builtin(df, targets, None)
    if mode == "approx":
        return _builtin(df, targets, kw.get("accuracy", ACCURACY))
    raise ValueError(f"unknown quantile mode {mode!r}")


def cardinality_metrics(columns) -> list:
    """Distinct-count estimates (HLL++), for table statistics."""
    return [F.approx_count_distinct(c).alias(c) for c in dict.fromkeys(columns)]


def mode_value(df: DataFrame, column: str, alias: str | None = None) -> DataFrame:
    """A4: most frequent non-null value; ties -> smallest.  One-row DataFrame.

    Group counts are map-side combined, so a hot value never reaches one task as
    rows; the final pick is a one-row aggregate over the per-value counts.
    """
    alias = alias or f"{column}_mode"
    counts = (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    return counts.agg(
        F.min_by(F.col(column), F.struct((-F.col("_n")).alias("n"), F.col(column).alias("v"))).alias(alias)
    )


def feature_statistics(
    df: DataFrame, median_cols, mode_cols, *, quantile_mode: str = "exact", **kw
) -> DataFrame:
    """D5 statistics relation: ``<c>_median`` for each median column and
    ``<c>_mode`` for each mode column, as one row."""
    row = quantile_stats(df, medians(median_cols), quantile_mode, **kw) if median_cols else None
    for c in mode_cols:
        m = mode_value(df, c)
        row = m if row is None else combine_rows(row, m)
    return row
