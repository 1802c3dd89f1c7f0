"""Staged exchange of days, and the merge of loads into a stored snapshot."""

import random
import uuid
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators.snapshot import current_snapshot
from tallyhouse.plans import pipeline
from tallyhouse.plans.pipeline import KeysRejected, Warehouse, load_transactions
from tallyhouse.sinks import exchange as ex
from tallyhouse.sinks import snapshots
from tallyhouse.sinks.tables import create_day_table
from tests.conftest import plan_of, rows
from tests.test_load_keys import whole_rows

DAY1, DAY2, DAY3 = date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)
SCHEMA = "id string, amount decimal(18,2), transaction_date date"


@pytest.fixture
def table(spark, tmp_path):
    database = f"exchange_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{tmp_path}/db'")
    name = f"{database}.facts"
    create_day_table(spark, name, facts(spark, []).schema)
    yield name
    spark.sql(f"DROP DATABASE {database} CASCADE")


def facts(spark, values):
    whole = spark.createDataFrame(values, SCHEMA.replace("decimal(18,2)", "int"))
    return whole.withColumn("amount", F.col("amount").cast("decimal(18,2)"))


def load(spark, table, values, check=None):
    staged = ex.stage_days(facts(spark, values), table)
    return ex.exchange(spark, staged, check)


def stored(spark, table):
    return rows(spark.table(table).select("id", F.col("amount").cast("int"), "transaction_date"))


def test_new_and_known_days_are_exchanged_and_others_stay(spark, table):
    load(spark, table, [("a", 1, DAY1), ("b", 2, DAY2)])
    assert load(spark, table, [("c", 3, DAY2), ("d", 4, DAY3)]) == 2
    assert stored(spark, table) == [("a", 1, DAY1), ("c", 3, DAY2), ("d", 4, DAY3)]
    assert load(spark, table, []) == 0
    assert len(stored(spark, table)) == 3
    assert "PartitionFilters: [isnotnull(transaction_date" in plan_of(spark.table(table).where(F.col("transaction_date") == F.lit(DAY2)))


def test_a_load_that_fails_its_check_changes_nothing(spark, table):
    load(spark, table, [("a", 1, DAY1)])
    source = facts(spark, [("x", 9, DAY1), ("y", 9, DAY2), ("z", 9, DAY2)])
    staged = ex.stage_days(source.where("id <> 'z'"), table)
    with pytest.raises(ex.LoadRejected, match="2024-01-02|datetime.date\\(2024, 1, 2\\)"):
        ex.exchange(spark, staged, ex.same_counts(source))
    assert stored(spark, table) == [("a", 1, DAY1)]
    assert ex.finish_exchanges(spark, table) == []
    assert ex.exchange(spark, ex.stage_days(source, table), ex.same_counts(source)) == 2
    assert len(stored(spark, table)) == 3


def test_a_row_without_a_day_fails_before_anything_changes(spark, table):
    load(spark, table, [("a", 1, DAY1)])
    with pytest.raises(Exception, match="has no transaction_date"):
        load(spark, table, [("b", 2, DAY1), ("c", 3, None)])
    assert stored(spark, table) == [("a", 1, DAY1)]


def test_an_exchange_that_is_cut_off_is_carried_on(spark, table, monkeypatch):
    load(spark, table, [("a", 1, DAY1), ("b", 2, DAY2)])
    before = spark.table(table)
    plain, calls = ex.SparkSession.sql, []

    def dies_at_the_second_day(self, text, *args, **kwargs):
        if "SET LOCATION" in text:
            calls.append(text)
            if len(calls) == 2:
                raise RuntimeError("driver lost")
        return plain(self, text, *args, **kwargs)

    monkeypatch.setattr(type(spark), "sql", dies_at_the_second_day)
    with pytest.raises(RuntimeError, match="driver lost"):
        load(spark, table, [("c", 3, DAY1), ("d", 4, DAY2), ("e", 5, DAY3)])
    monkeypatch.undo()
    # Whole days, new or old.
    spark.catalog.refreshTable(table)
    assert stored(spark, table) == [("b", 2, DAY2), ("c", 3, DAY1)]
    assert len(ex.finish_exchanges(spark, table)) == 1
    assert stored(spark, table) == [("c", 3, DAY1), ("d", 4, DAY2), ("e", 5, DAY3)]
    assert ex.finish_exchanges(spark, table) == []
    assert before.count() >= 2  # files that an earlier reader knows are still there


# -- snapshots

DIMENSION = "customer_id string, segment string, etl_date date"


def random_loads(seed):
    """Loads with new dates, repeated dates with other rows, late dates, and an empty one."""
    rng = random.Random(seed)
    for i in range(9):
        day = DAY1 + timedelta(days=rng.choice([i, i, max(0, i - 1), 20 - i]))
        keys = rng.sample(range(60), rng.choice([0, 1, 5, 30]))
        yield [(f"c{k}", f"s{rng.randrange(5)}", day) for k in keys] + ([("c1", "twice", day)] if i == 4 else [])


def test_merged_snapshot_is_the_one_of_all_loads(spark, tmp_path):
    path = str(tmp_path / "customers")
    for values in random_loads(seed=1):
        snapshots.load_and_merge(spark.createDataFrame(values, DIMENSION), path, "customer_id", parts=7)
        if (found := snapshots.read_snapshot(spark, path, parts=7)) is not None and found.count():
            expected = current_snapshot(spark.read.parquet(path), "customer_id").select(found.columns)
            assert rows(found) == rows(expected)


def test_a_merge_rewrites_only_the_parts_of_its_keys(spark, tmp_path):
    path = str(tmp_path / "customers")
    first = spark.range(1000).select(F.concat(F.lit("c"), "id").alias("customer_id"), F.lit("s").alias("segment"), F.lit(DAY1).alias("etl_date"))
    assert snapshots.load_and_merge(first, path, "customer_id", parts=16) == list(range(16))
    folder = tmp_path / "customers__current_16"
    before = {p for p in folder.rglob("*.parquet")}
    touched = snapshots.load_and_merge(spark.createDataFrame([("c5", "new", DAY2)], DIMENSION), path, "customer_id", parts=16)
    changed = {p.parent.name for p in before ^ {p for p in folder.rglob("*.parquet")}}
    assert len(touched) == 1 and changed == {f"key_part={touched[0]}"}
    found = snapshots.read_snapshot(spark, path, parts=16)
    assert found.count() == 1000 and found.where("customer_id = 'c5' and segment = 'new'").count() == 1


def test_a_key_that_a_repeated_load_no_longer_holds_is_gone(spark, tmp_path):
    path = str(tmp_path / "customers")
    for values in ([("a", "s", DAY1), ("b", "s", DAY1)], [("a", "t", DAY1)]):
        snapshots.load_and_merge(spark.createDataFrame(values, DIMENSION), path, "customer_id", parts=50)
    assert rows(snapshots.read_snapshot(spark, path, parts=50).select("customer_id", "segment")) == [("a", "t")]


def test_loads_from_before_there_was_a_snapshot_are_taken_in(spark, tmp_path):
    path = str(tmp_path / "customers")
    spark.createDataFrame([("a", "s", DAY1), ("b", "s", DAY1)], DIMENSION).write.partitionBy("etl_date").parquet(path)
    assert snapshots.read_snapshot(spark, path) is None
    snapshots.load_and_merge(spark.createDataFrame([("b", "t", DAY2)], DIMENSION), path, "customer_id")
    assert rows(snapshots.read_snapshot(spark, path).select("customer_id", "segment")) == [("a", "s"), ("b", "t")]


# -- the warehouse's fact load


def amounts(spark, values):
    return whole_rows(spark, [(i, d) for i, _, d in values]).drop("amount").join(
        spark.createDataFrame([(i, v) for i, v, _ in values], "transaction_id_dd string, amount int"), "transaction_id_dd"
    )


@pytest.fixture
def house(spark, table, tmp_path):
    return Warehouse(spark, str(tmp_path / "house"), table.replace(".facts", ".transactions"))


def held(house):
    return rows(house.table("transactions").select("transaction_id_dd", F.col("amount").cast("int"), "transaction_date"))


def test_a_fact_load_into_the_catalog_is_staged_and_checked(spark, house, monkeypatch):
    done = load_transactions(amounts(spark, [("a", 1, DAY1), ("b", 2, DAY2), ("n", 0, None)]), house, start=DAY1, end=DAY2)
    assert rows(done.per_day.select("source_rows", "target_rows", "difference")) == [(1, 1, 0), (1, 1, 0)]
    assert rows(house.loads("rejected_transactions").select("transaction_id_dd", "reject_reason")) == [("n", "no day")]
    repeated = amounts(spark, [("b", 7, DAY1)])
    with pytest.raises(KeysRejected, match="held by another day"):
        load_transactions(repeated, house, days=[DAY1], checked=True)
    assert held(house) == [("a", 1, DAY1), ("b", 2, DAY2)]
    # Rows are lost on the way to the folder beside the table: the load is rejected, and no day changes.
    plain = pipeline.stage_days
    monkeypatch.setattr(pipeline, "stage_days", lambda df, name: plain(df.where("amount <> 4"), name))
    with pytest.raises(ex.LoadRejected):
        load_transactions(amounts(spark, [("c", 3, DAY1), ("d", 4, DAY2)]), house, start=DAY1, end=DAY2)
    monkeypatch.undo()
    assert held(house) == [("a", 1, DAY1), ("b", 2, DAY2)]
    load_transactions(amounts(spark, [("c", 3, DAY1)]), house, start=DAY1, end=DAY2)
    assert held(house) == [("b", 2, DAY2), ("c", 3, DAY1)]
    assert not house.has("customers") and house.has("transactions")


def test_a_load_that_was_cut_off_is_carried_on_by_the_next(spark, house, monkeypatch):
    load_transactions(amounts(spark, [("a", 1, DAY1), ("b", 2, DAY2)]), house, start=DAY1, end=DAY2)
    monkeypatch.setattr(ex, "_carry_out", lambda *_: (_ for _ in ()).throw(RuntimeError("driver lost")))
    with pytest.raises(RuntimeError, match="driver lost"):
        load_transactions(amounts(spark, [("c", 3, DAY1), ("d", 4, DAY2)]), house, start=DAY1, end=DAY2)
    monkeypatch.undo()
    assert held(house) == [("a", 1, DAY1), ("b", 2, DAY2)]
    load_transactions(amounts(spark, [("e", 5, DAY2)]), house, days=[DAY2])
    assert held(house) == [("c", 3, DAY1), ("e", 5, DAY2)]


def test_old_loads_are_removed_but_no_day_that_is_in_use(spark, table):
    load(spark, table, [("a", 1, DAY1), ("b", 2, DAY2)])
    load(spark, table, [("c", 3, DAY1), ("d", 4, DAY3)])
    load(spark, table, [("e", 5, DAY3)])
    with pytest.raises(ex.LoadRejected):
        load(spark, table, [("f", 6, DAY1)], lambda staged: staged)
    assert ex.remove_old_loads(spark, table, datetime.now() - timedelta(days=1)) == 0
    now = datetime.now() + timedelta(days=1)
    # Days 1 of the first load and 3 of the second, and the load that was rejected.
    assert ex.remove_old_loads(spark, table, now) == 3
    assert stored(spark, table) == [("b", 2, DAY2), ("c", 3, DAY1), ("e", 5, DAY3)]
    assert ex.remove_old_loads(spark, table, now) == 0
    # A load all of whose days were replaced goes with its plan, and is not carried out again.
    load(spark, table, [("g", 7, DAY1), ("h", 8, DAY2), ("i", 9, DAY3)])
    assert ex.remove_old_loads(spark, table, now) == 3
    assert ex.finish_exchanges(spark, table) == [] and ex.remove_old_loads(spark, table, now) == 0
    assert stored(spark, table) == [("g", 7, DAY1), ("h", 8, DAY2), ("i", 9, DAY3)]
    assert len(ex._Folders(spark, ".").names(f"{ex.exchange_folder(spark, table)}/loads")) == 1
