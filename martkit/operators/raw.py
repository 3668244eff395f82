"""D2 raw mart build and J2 orphan detection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.functions import bool_default
from martkit.sources.tables import normalise_nan

# Raw-mart projection (output column, side, source column, boolean default).
RAW_PROJECTION: tuple[tuple[str, str, str, bool], ...] = (
    ("flat_id", "f", "id", False),
    ("building_id", "f", "building_id", False),
    ("floor", "f", "floor", False),
    ("kitchen_area", "f", "kitchen_area", False),
    ("living_area", "f", "living_area", False),
    ("rooms", "f", "rooms", False),
    ("is_apartment", "f", "is_apartment", True),
    ("studio", "f", "studio", True),
    ("total_area", "f", "total_area", False),
    ("price", "f", "price", False),
    ("build_year", "b", "build_year", False),
    ("building_type_int", "b", "building_type_int", False),
    ("latitude", "b", "latitude", False),
    ("longitude", "b", "longitude", False),
    ("ceiling_height", "b", "ceiling_height", False),
    ("flats_count", "b", "flats_count", False),
    ("floors_total", "b", "floors_total", False),
    ("has_elevator", "b", "has_elevator", True),
)


def build_raw(flats: DataFrame, buildings: DataFrame, *, nan_as_null: bool = True, keep=()) -> DataFrame:
    """``flats ⋈ buildings`` on ``buildings.id = flats.building_id`` (N:1, inner).

    No join strategy is forced: AQE broadcasts ``buildings`` only if its measured size
    is under the broadcast threshold, otherwise sort-merge; a building holding a large
    share of flats is split by AQE's skew-join handling.  Only the projected columns
    are read from either side; ``keep`` names further columns of ``flats`` to pass on.
    """
    need_f = [src for _, side, src, _ in RAW_PROJECTION if side == "f"] + list(keep)
    need_b = ["id"] + [src for _, side, src, _ in RAW_PROJECTION if side == "b"]
    f = flats.select(*need_f).alias("f")
    b = buildings.select(*need_b).alias("b")
    if nan_as_null:
        f, b = normalise_nan(f).alias("f"), normalise_nan(b).alias("b")
    joined = f.join(b, F.col("b.id") == F.col("f.building_id"), "inner")
    cols = []
    for out, side, src, default in RAW_PROJECTION:
        c = F.col(f"{side}.{src}")
        cols.append((bool_default(c) if default else c).alias(out))
    return joined.select(*cols, *[F.col(f"f.{c}") for c in keep])


def orphans(flats: DataFrame, buildings: DataFrame) -> DataFrame:
    """Flats without a matching building (NULL ``building_id`` included).

    Written as a left anti join so the plan is an anti join, not outer join + filter.
    Rows without an id match nothing: they go around the join, which would otherwise send
    all of them to one partition.
    """
    without_id = flats.where(F.col("building_id").isNull())
    dangling = flats.where(F.col("building_id").isNotNull()).join(
        buildings.select(F.col("id").alias("_bid")),
        F.col("building_id") == F.col("_bid"),
        "left_anti",
    )
    return without_id.unionByName(dangling)
