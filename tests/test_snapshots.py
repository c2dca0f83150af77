"""Layers that change as a whole, and what is kept with a load."""

import threading
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from parceltrail import queries
from parceltrail.operators.joins import HotKeys, hot_keys, lookup_join, split_join
from parceltrail.plans import layers
from parceltrail.sinks.layers import LayerStore

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def store(spark, tmp_path):
    number = tmp_path.name.translate(str.maketrans("", "", "[]-.")).lower()
    store = LayerStore(spark, str(tmp_path), prefix=f"{number}_")
    store.create_layer("gold")
    return store


def counts(snapshot):
    return snapshot.read("fact").count(), snapshot.read("dim").count()


def fill(spark, store, n):
    with store.load("gold") as load:
        load.write("fact", spark.range(n))
        load.write("dim", spark.range(n))


def test_a_reader_between_two_table_loads(spark, store):
    fill(spark, store, 3)
    before = store.snapshot("gold")
    with store.load("gold") as load:
        load.write("fact", spark.range(5))
        assert counts(store.snapshot("gold")) == (3, 3)
        assert spark.table(store.name("gold", "fact")).count() == 3
        assert load.read("fact").count() == 5
        load.write("dim", spark.range(5))
        assert counts(store.snapshot("gold")) == (3, 3)
    assert counts(store.snapshot("gold")) == (5, 5)
    # A snapshot stays what it was.
    assert counts(before) == (3, 3)
    assert spark.table(store.name("gold", "dim")).count() == 5


def test_a_run_that_fails_half_way_changes_nothing(spark, store):
    fill(spark, store, 3)
    failing = spark.range(1).select(F.raise_error(F.lit("broken")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="broken"):
        with store.load("gold") as load:
            load.write("fact", spark.range(5))
            load.write("dim", failing)
    assert counts(store.snapshot("gold")) == (3, 3)
    with pytest.raises(Exception, match="broken"):
        with store.load("gold") as load:
            load.write_all({"fact": lambda: spark.range(5), "dim": lambda: failing})
    assert counts(store.snapshot("gold")) == (3, 3)


def test_a_table_alone_keeps_the_others(spark, store):
    fill(spark, store, 3)
    store.replace("gold", "dim", spark.range(7))
    assert counts(store.snapshot("gold")) == (3, 7)


def test_a_reader_during_changes_of_the_schema(spark, store):
    name = store.name("gold", "t")
    store.replace("gold", "t", spark.range(3))
    found, done = set(), threading.Event()

    def read():
        while not done.is_set():
            try:
                rows = spark.table(name)
                found.add((len(rows.columns), rows.count()))
            except Exception as e:  # noqa: BLE001
                found.add(str(e)[:200])

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for i in range(6):
            columns = ["id", "id * 2 AS other"] if i % 2 else ["cast(id AS string) AS id"]
            store.replace("gold", "t", spark.range(3).selectExpr(*columns))
    finally:
        done.set()
        reader.join()
    assert found and found <= {(1, 3), (2, 3)}


def test_two_runs_that_end_at_the_same_time(spark, store, monkeypatch):
    fill(spark, store, 3)
    stale, asked = store._numbers("gold"), []
    fresh = LayerStore._numbers

    def late(self, layer):
        asked.append(1)
        # The first look comes before the other run has published.
        return stale if len(asked) == 1 else fresh(self, layer)

    store.replace("gold", "fact", spark.range(4))
    monkeypatch.setattr(LayerStore, "_numbers", late)
    store.replace("gold", "dim", spark.range(5))
    assert len(asked) == 2
    assert counts(store.snapshot("gold")) == (4, 5)


def test_clean_up(spark, store):
    for n in range(4):
        fill(spark, store, n + 1)
    store.replace("gold", "dim", spark.range(9))
    unfinished = Path(store.root) / "gold" / "fact" / "99999999999999999999-unfinished"
    orphan = Path(store.root) / "gold" / "fact" / "00000000000000000001-orphan"
    unfinished.mkdir()
    orphan.mkdir()
    gone = store.clean("gold", keep=2)
    # States 3 and 4 stay; they share a fact.
    assert len(gone) == 3 + 3 + 1 and not orphan.exists() and unfinished.exists()
    assert len(list((Path(store.root) / "gold" / "fact").iterdir())) == 1 + 1
    assert len(list((Path(store.root) / "gold" / "dim").iterdir())) == 2
    assert counts(store.snapshot("gold")) == (4, 9)
    assert store.clean("gold", keep=2) == []
    assert spark.table(store.name("gold", "dim")).count() == 9


def test_tables_of_an_older_version_give_way_to_views(spark, store):
    name = store.name("gold", "dim")
    spark.range(2).write.parquet(f"{store.root}/old")
    spark.catalog.createTable(name, path=f"{store.root}/old", source="parquet")
    assert spark.table(name).count() == 2
    store.replace("gold", "dim", spark.range(6))
    assert spark.table(name).count() == 6
    spark.range(2).write.saveAsTable(store.name("gold", "managed"))
    with pytest.raises(ValueError, match="not this library's"):
        store._show("gold", "managed", f"{store.root}/old")


def test_frequent_values_are_found_while_a_table_is_written(spark, store):
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id"))).alias("key"),
        F.when(F.col("id") % 4 > 0, F.col("id") % 2).alias("few"),
    )
    with store.load("gold") as load:
        load.write("t", rows, ["key", "few"])
    known = store.snapshot("gold").hot_keys("t")
    assert known.rows == 30_000
    assert known.frequent["key"][0] == ("hot", 10_000)
    assert sorted(known.frequent["few"]) == [(0, 7_500), (1, 15_000)]
    assert known.parts("key", 1_000) == hot_keys(rows, "key", 1_000) == [("hot", 10)]
    with pytest.raises(LookupError, match="absent"):
        known.parts("absent", 10)


def test_known_hot_keys_do_not_change_a_join(spark, shuffle_joins):
    rows = spark.range(4_000).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("key"), F.col("id") % 5)
    lookup = spark.range(0, 4_000, 3).select(F.col("id").alias("key"), (F.col("id") * 2).alias("twice"))
    known = HotKeys(4_000, {"key": [(7, 2_000), (8, 1_900)]})
    for how in ("inner", "left"):
        plain = sorted(map(str, rows.join(lookup, "key", how).collect()))
        for count_on in (known, None, HotKeys(0, {"key": []})):
            assert sorted(map(str, split_join(rows, lookup, "key", how, count_on, 100).collect())) == plain
        assert sorted(map(str, lookup_join(rows, lookup, "key", how, known).collect())) == plain


@pytest.mark.parametrize("broadcast", [True, False])
def test_the_star_of_stored_tables_runs_no_job_before_its_own(spark, tmp_path, request, broadcast):
    folder = tmp_path / "data"
    for name, build in (
        ("orders", queries.raw.raw_orders),
        ("order_items", queries.raw.raw_items),
        ("products", queries.raw.raw_products),
        ("sellers", queries.raw.raw_sellers),
        ("geolocation", queries.raw.raw_geolocation),
    ):
        queries._write_csv(build(spark, SF_DIR), f"{folder}/raw_{name}_dataset.csv")
    prefix = f"nojob{'b' if broadcast else 's'}_"
    store = layers.run(spark, str(folder), str(tmp_path / "tables"), prefix=prefix, keep=1, multi_line=False)
    if not broadcast:
        request.getfixturevalue("shuffle_joins")
    context = spark.sparkContext
    context.setJobGroup(prefix, "star")
    star = layers.wide_star(store)
    plan = star._jdf.queryExecution().executedPlan().toString()
    assert not context.statusTracker().getJobIdsForGroup(prefix)
    assert broadcast or "SortMergeJoin" in plan
    expected = queries.star_join(spark, SF_DIR)
    assert sorted(star.columns) == sorted(expected.columns)
    assert sorted(map(str, star.select(*expected.columns).collect())) == sorted(map(str, expected.collect()))
    context.setLocalProperty("spark.jobGroup.id", None)
