"""Rules of the exploratory cleaner, one scenario table per rule, over generated listings."""

import pytest

from martkit.contract import HOUSING
from martkit.errors import ContractError
from martkit.operators.clean import clean_exploratory, dedup_keep_first

DDL = (
    "arrival int, flat_id bigint, price double, rooms int, total_area double, kitchen_area double, "
    "living_area double, studio boolean, floor int, floors_total int, ceiling_height double"
)


def listings(spark, *changes):
    """A frame of sound listings; each change set alters one of them."""
    sound = {
        "price": 7_500_000.0, "rooms": 3, "total_area": 72.0, "kitchen_area": 11.5, "living_area": 44.0,
        "studio": False, "floor": 4, "floors_total": 9, "ceiling_height": 2.7,
    }
    rows = [{"arrival": 10 + i, "flat_id": 700 + i, **sound, **change} for i, change in enumerate(changes)]
    names = [c.split()[0] for c in DDL.split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], DDL)


def cleaned(df):
    return {r["flat_id"]: r.asDict() for r in clean_exploratory(df, order_by="arrival").collect()}


@pytest.mark.parametrize("change", [
    {"price": 0.0}, {"price": None}, {"price": float("nan")}, {"rooms": 0}, {"rooms": None},
    {"living_area": 73.0}, {"kitchen_area": 72.5}, {"total_area": -1.0}, {"floor": 10},
    {"flat_id": None},
])
def test_a_broken_listing_goes_and_a_sound_one_stays(spark, change):
    assert list(cleaned(listings(spark, {}, change))) == [700]


def test_the_earliest_copy_of_a_listing_wins(spark):
    out = cleaned(listings(
        spark, {"flat_id": 42, "rooms": 5, "arrival": 31}, {"flat_id": 42, "rooms": 2, "arrival": 30}, {"flat_id": 43}))
    assert sorted(out) == [42, 43] and out[42]["rooms"] == 2


def test_copies_of_one_arrival_prefer_the_filled_one(spark):
    df = spark.createDataFrame([(5, 1, None), (5, 1, 3.5), (6, 1, None)], "k int, at int, v double")
    assert {r["k"]: r["v"] for r in dedup_keep_first(df, "k", "at").collect()} == {5: 3.5, 6: None}


@pytest.mark.parametrize("kind", ["parquet", "csv", "json"])
def test_without_an_order_the_first_row_of_the_files_wins(spark, scratch, kind):
    rows = spark.range(400).selectExpr("id AS place", "id % 7 AS k", "CAST(1000 - id AS STRING) AS v")
    rows.repartitionByRange(4, "place").sortWithinPartitions("place").write.format(kind).save(f"{scratch}/{kind}")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")  # several splits a file
    try:
        df = spark.read.schema(rows.schema).format(kind).load(f"{scratch}/{kind}").where("place >= 3")
        kept = {r["k"]: r["place"] for r in dedup_keep_first(df, "k").collect()}
        assert kept == {3: 3, 4: 4, 5: 5, 6: 6, 0: 7, 1: 8, 2: 9}
        mart = df.selectExpr("k AS flat_id", "DOUBLE(v) AS price", "1 AS rooms", "DOUBLE(50) AS total_area", "DOUBLE(5) AS kitchen_area", "DOUBLE(20) AS living_area")
        # prices fall in the order of the files: the first row of an id has its highest price
        assert {r["flat_id"] for r in clean_exploratory(mart).collect()} == set(range(7))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_a_frame_without_files_needs_an_order(spark):
    with pytest.raises(ValueError, match="order"):
        dedup_keep_first(spark.createDataFrame([(1, 2)], "k int, v int"), "k")


def test_null_keys_are_one_key(spark):
    df = spark.createDataFrame([(None, 2, "x"), (None, 1, "y"), (3, 1, None), (4, 5, "z"), (4, 5, "a")], "k int, at int, v string")
    assert {tuple(r) for r in dedup_keep_first(df, "k", "at").collect()} == {(None, 1, "y"), (3, 1, None), (4, 5, "a")}


@pytest.mark.parametrize("order", [[], "k", ["k"]])
def test_an_order_that_decides_nothing_is_refused(spark, order):
    df = spark.createDataFrame([(1, 2)], "k int, v int")
    with pytest.raises(ValueError, match="order"):
        dedup_keep_first(df, "k", order)


def test_missing_and_nan_heights_become_the_median(spark):
    out = cleaned(listings(
        spark, {"ceiling_height": 2.4}, {"ceiling_height": None}, {"ceiling_height": float("nan")}, {"ceiling_height": 3.2}))
    assert [out[k]["ceiling_height"] for k in (700, 701, 702, 703)] == pytest.approx([2.4, 2.8, 2.8, 3.2])


def test_all_listings_broken_leaves_an_empty_frame(spark):
    df = listings(spark, {"price": -5.0}, {"rooms": None})
    assert clean_exploratory(df, order_by="arrival").count() == 0


@pytest.mark.parametrize("name", sorted(HOUSING.required))
def test_every_required_column_is_named_when_absent(spark, name):
    with pytest.raises(ContractError, match=name):
        clean_exploratory(listings(spark, {}).drop(name), order_by="arrival")
