"""Independent SQL (DuckDB dialect) for the relational operators.

Generated from the same ``MartSpec`` as the Spark operators, but expressed as plain
SQL (CTEs, ``percentile_cont``, ``GROUP BY``) so DuckDB can check the Spark results
on the same Parquet tables.  Views ``orders``, ``customer``, ``lineitem``, ``events``
… are assumed to be registered.
"""

from __future__ import annotations

from martkit.contract import HOUSING, MartSpec
from martkit.operators.raw import RAW_PROJECTION
from martkit.sources.fixtures import buildings_sql, flats_sql

_DOUBLE_SOURCES = {
    "kitchen_area", "living_area", "total_area", "price",
    "latitude", "longitude", "ceiling_height",
}


def _nn(expr: str) -> str:
    return f"CASE WHEN isnan({expr}) THEN NULL ELSE {expr} END"


def raw_ctes(
    *, orphans: bool = False, changed: dict[str, str] | None = None, changed_buildings: dict[str, str] | None = None,
    input_order: bool = False,
) -> list[tuple[str, str]]:
    """CTEs ``flats``, ``buildings``, ``raw``; ``input_order`` numbers the flats in table order
    (column ``ord``, passed on to ``raw``)."""
    cols = []
    for out, side, src, default in RAW_PROJECTION:
        e = f"{side}.{src}"
        if src in _DOUBLE_SOURCES:
            e = _nn(e)
        if default:
            e = f"COALESCE({e}, FALSE)"
        cols.append(f"{e} AS {out}")
    flats = flats_sql("orders", orphans=orphans, changed=changed)
    if input_order:
        flats = f"SELECT *, row_number() OVER () AS ord FROM ({flats}) t"
        cols.append("f.ord")
    raw = (
        "SELECT " + ", ".join(cols)
        + " FROM flats AS f JOIN buildings AS b ON b.id = f.building_id"
    )
    return [
        ("flats", flats),
        ("buildings", buildings_sql("customer", changed_buildings)),
        ("raw", raw),
    ]


def _and(conds: list[str]) -> str:
    return " AND ".join(f"({c})" for c in conds) if conds else "TRUE"


def _pc(p: float, c: str) -> str:
    return f"percentile_cont({p}) WITHIN GROUP (ORDER BY {c})"


def mode_sql(c: str, rel: str) -> str:
    return (
        f"(SELECT {c} FROM {rel} WHERE {c} IS NOT NULL GROUP BY {c} "
        f"ORDER BY count(*) DESC, {c} LIMIT 1)"
    )


def consistency_sql(spec: MartSpec = HOUSING, floors: str = "independent") -> str:
    conds = [f"{c} > 0" for c in spec.positive]
    conds += [f"{a} <= {b}" for a, b in spec.contained]
    if spec.floor_rule:
        f, t = spec.floor_rule
        if floors == "independent":
            conds += [
                f"{f} IS NULL OR {f} >= 0",
                f"{t} IS NULL OR {t} > 0",
                f"{f} IS NULL OR {t} IS NULL OR {f} <= {t}",
            ]
        else:
            conds.append(f"{f} IS NULL OR {t} IS NULL OR ({f} >= 0 AND {t} > 0 AND {f} <= {t})")
    return _and(conds)


def clamp_sql(c: str, q1: str, q3: str, k: float, guard: str | None = None) -> str:
    skip = f"{c} IS NULL OR {q1} IS NULL OR {q3} <= {q1}"
    if guard:
        skip += f" OR {guard}"
    lo = f"{q1} - {k} * ({q3} - {q1})"
    hi = f"{q3} + {k} * ({q3} - {q1})"
    return f"CASE WHEN {skip} THEN {c} ELSE GREATEST({lo}, LEAST({c}, {hi})) END"


def iqr_bounds_sql(columns, rel: str) -> str:
    aggs = []
    for c in columns:
        aggs += [f"{_pc(0.25, c)} AS {c}_q1", f"{_pc(0.75, c)} AS {c}_q3"]
    return f"SELECT {', '.join(aggs)} FROM {rel}"


def clean_ctes(spec: MartSpec = HOUSING, *, source: str = "raw") -> list[tuple[str, str]]:
    """CTEs ``base``, ``fstats``, ``imputed``, ``consistent``, ``bounds``, ``capped``, ``clean``."""
    cols = list(spec.columns)
    f1 = [f"{c} IS NOT NULL" for c in spec.not_null]
    f1 += [f"{c} IS NOT NULL AND {c} > 0" for c in spec.positive_required]
    base = f"SELECT {', '.join(cols)} FROM {source} WHERE {_and(f1)}"
    stats = [f"{_pc(0.5, c)} AS {c}_median" for c in spec.medians]
    stats += [f"{mode_sql(c, 'base')} AS {c}_mode" for c in spec.modes]
    fstats = f"SELECT {', '.join(stats)} FROM base"
    imp = []
    for c in cols:
        if c in spec.medians:
            imp.append(f"COALESCE(d.{c}, (SELECT {c}_median FROM fstats)) AS {c}")
        elif c in spec.modes:
            imp.append(f"COALESCE(d.{c}, (SELECT {c}_mode FROM fstats)) AS {c}")
        elif c in spec.booleans:
            imp.append(f"COALESCE(d.{c}, FALSE) AS {c}")
        else:
            imp.append(f"d.{c} AS {c}")
    imputed = f"SELECT {', '.join(imp)} FROM base AS d"
    consistent = f"SELECT * FROM imputed WHERE {consistency_sql(spec)}"
    bounds = iqr_bounds_sql(spec.clips, "consistent")
    cap = [
        clamp_sql(f"d.{c}", f"(SELECT {c}_q1 FROM bounds)", f"(SELECT {c}_q3 FROM bounds)", spec.iqr_k) + f" AS {c}"
        if c in spec.clips
        else f"d.{c} AS {c}"
        for c in cols
    ]
    capped = f"SELECT {', '.join(cap)} FROM consistent AS d"
    f5 = _and([f"{a} <= {b}" for a, b in spec.contained])
    clean = f"SELECT * FROM capped WHERE {f5}"
    return [
        ("base", base),
        ("fstats", fstats),
        ("imputed", imputed),
        ("consistent", consistent),
        ("bounds", bounds),
        ("capped", capped),
        ("clean", clean),
    ]


def with_query(ctes: list[tuple[str, str]], final: str) -> str:
    body = ",\n".join(f"{name} AS (\n{sql}\n)" for name, sql in ctes)
    return f"WITH {body}\n{final}"


def housing_ctes(*, orphans: bool = False, spec: MartSpec = HOUSING) -> list[tuple[str, str]]:
    return raw_ctes(orphans=orphans) + clean_ctes(spec)
