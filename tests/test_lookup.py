from pyspark.sql import functions as F

from tallyhouse.operators.lookup import Lookup, star_join
from tests.conftest import plan_of, rows


def skewed(spark, n=30_000):
    """A third of the rows shares one key, a third has none."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.col("id").cast("string"))
    return spark.range(0, n, 1, 16).select(F.col("id").alias("row"), key.alias("k"))


def dimension(spark, n=30_000):
    cold = spark.range(0, n, 4).select(F.col("id").cast("string").alias("dk"), F.col("id").alias("v"))
    return cold.unionAll(spark.sql("SELECT 'hot' AS dk, -1L AS v"))


def brute_force(fact, dim):
    known = {row["dk"]: row["v"] for row in dim.collect()}
    return sorted(((r["row"], r["k"], known.get(r["k"])) for r in fact.collect()), key=repr)


def test_broadcast_and_shuffled_joins_agree_with_brute_force(spark, setting):
    fact, dim = skewed(spark), dimension(spark)
    expected = brute_force(fact, dim)
    lookup = Lookup(dim, "k", "dk", {"v": "v"})
    small = star_join(fact, [lookup])
    assert "BroadcastHashJoin" in plan_of(small)
    assert rows(small) == expected
    setting("spark.sql.autoBroadcastJoinThreshold", "0")
    large = star_join(fact, [Lookup(dim, "k", "dk", {"v": "v"}, large=True)])
    assert "SortMergeJoin" in plan_of(large)
    assert rows(large) == expected


def small_partitions(setting):
    """Adaptive execution as at scale, with kilobytes in place of megabytes."""
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    setting("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    setting("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1k")
    setting("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.2")
    setting("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1k")
    setting("spark.sql.adaptive.coalescePartitions.enabled", "false")


def test_hot_key_and_missing_keys_are_spread(spark, setting):
    small_partitions(setting)
    joined = star_join(skewed(spark), [Lookup(dimension(spark), "k", "dk", {"v": "v"}, large=True)])
    assert rows(joined) == brute_force(skewed(spark), dimension(spark))
    placed = joined.withColumn("task", F.spark_partition_id()).withColumn("kind", F.when(F.col("k") == "hot", "hot").when(F.col("k").isNull(), "none"))
    sizes = {}
    for r in placed.groupBy("kind", "task").count().collect():
        sizes.setdefault(r["kind"], []).append(r["count"])
    # Unsplit, one task would hold all 10,000 rows of either kind.
    assert len(sizes["hot"]) > 1 and max(sizes["hot"]) < 6_000
    assert len(sizes["none"]) > 1 and max(sizes["none"]) < 6_000


def test_repeated_dimension_keys_repeat_rows_like_any_join(spark, setting):
    fact = skewed(spark, 300)
    dim = dimension(spark).unionAll(spark.sql("SELECT 'hot' AS dk, -2L AS v"))
    expected = rows(fact.join(dim, F.col("k") == F.col("dk"), "left").drop("dk"))
    setting("spark.sql.autoBroadcastJoinThreshold", "0")
    assert rows(star_join(fact, [Lookup(dim, "k", "dk", {"v": "v"}, large=True)])) == expected


def test_where_applies_after_the_first_lookup(spark, setting):
    fact = spark.sql("SELECT * FROM VALUES ('a', 'x'), ('b', 'x'), (null, 'x'), ('c', 'y') AS t(k1, k2)")
    first = Lookup(spark.sql("SELECT * FROM VALUES ('a', true), ('b', false) AS t(k, ok)"), "k1", "k", {"ok": "ok"})
    second = Lookup(spark.sql("SELECT 'x' AS k, 7 AS v"), "k2", "k", {"v": "v"})
    expected = [("a", "x", True, 7)]
    assert rows(star_join(fact, [first, second], where=F.col("ok"))) == expected
    setting("spark.sql.autoBroadcastJoinThreshold", "0")
    assert rows(star_join(fact, [first, second], where=F.col("ok"))) == expected


def test_a_lookup_of_the_dimension_is_attached_to_the_dimension(spark, setting):
    fact = spark.sql("SELECT * FROM VALUES ('a'), ('b'), ('z'), (null) AS t(k)")
    dim = spark.sql("SELECT * FROM VALUES ('a', 'x'), ('b', null) AS t(k, outer_key)")
    outer = spark.sql("SELECT 'x' AS k, 7 AS v")
    nested = Lookup(dim, "k", "k", {"outer_key": "ok"}, attached=[Lookup(outer, "ok", "k", {"v": "v"})])
    expected = [("a", "x", 7), ("b", None, None), ("z", None, None), (None, None, None)]
    assert rows(star_join(fact, [nested])) == sorted(expected, key=repr)
    setting("spark.sql.autoBroadcastJoinThreshold", "0")
    assert rows(star_join(fact, [nested])) == sorted(expected, key=repr)


def test_empty_sides(spark, setting):
    setting("spark.sql.autoBroadcastJoinThreshold", "0")
    fact, dim = skewed(spark, 30), dimension(spark)
    assert star_join(fact.limit(0), [Lookup(dim, "k", "dk", {"v": "v"})]).count() == 0
    empty = star_join(fact, [Lookup(dim.limit(0), "k", "dk", {"v": "v"}, large=True)])
    assert rows(empty) == brute_force(fact, dim.limit(0))


def test_building_a_plan_runs_no_job(spark):
    fact, dim = skewed(spark), dimension(spark)
    nested = Lookup(dim, "v", "v", {"dk": "again"})
    spark.sparkContext.setJobGroup("build", "plan only")
    try:
        star_join(fact, [Lookup(dim, "k", "dk", {"v": "v"}, attached=[nested], large=True), Lookup(dim, "k", "dk", {"v": "w"})], where=F.col("v") > 0)
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("build")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_the_widest_dimension_comes_last_and_keys_are_not_carried_twice(spark, setting):
    """What one join attaches is shuffled by every later one."""
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    fact = spark.range(100).select(*[F.col("id").cast("string").alias(k) for k in ("a", "b")])
    outer = spark.range(50).select(F.col("id").cast("string").alias("ok"), *[F.lit(i).alias(f"o{i}") for i in range(4)])
    few = spark.range(0, 100, 2).select(F.col("id").cast("string").alias("bk"), F.col("id").alias("v"), F.lit(1).alias("w"))
    wide = spark.range(0, 100, 3).select(F.col("id").cast("string").alias("ak"), (F.col("id") % 60).cast("string").alias("to"))
    attached = Lookup(outer, "a_to", "ok", {c: c for c in outer.columns})
    joined = star_join(fact, [Lookup(wide, "a", "ak", {"ak": "a_ak", "to": "a_to"}, attached=[attached], large=True), Lookup(few, "b", "bk", {"bk": "b_bk", "v": "v", "w": "w"}, large=True)])
    plan = plan_of(joined)
    assert plan.index("SortMergeJoin [a#") < plan.index("SortMergeJoin [b#")
    assert not [line for line in plan.splitlines() if "AS b_bk" in line and "CASE" not in line and "_matched" not in line]
    assert joined.columns == ["a", "b", "a_ak", "a_to", *outer.columns, "b_bk", "v", "w"]
    expected = []
    for i in range(100):
        to = str(i % 60) if i % 3 == 0 else None
        inner = (to, 0, 1, 2, 3) if to and int(to) < 50 else (None,) * 5
        expected.append((str(i), str(i), str(i) if to else None, to, *inner, *((str(i), i, 1) if i % 2 == 0 else (None, None, None))))
    assert rows(joined) == sorted(expected, key=repr)


def test_a_key_of_another_type_is_the_dimensions_own(spark, setting):
    fact = spark.sql("SELECT * FROM VALUES ('01'), ('2'), (null) AS t(k)")
    dim = spark.sql("SELECT * FROM VALUES (1L), (3L) AS t(dk)")
    assert rows(star_join(fact, [Lookup(dim, "k", "dk", {"dk": "dk"}, large=True)])) == sorted([("01", 1), ("2", None), (None, None)], key=repr)
    attached = Lookup(spark.sql("SELECT 3L AS ok, 7 AS v"), "dk", "ok", {"v": "v"})
    numbers = spark.sql("SELECT * FROM VALUES (1L), (3L), (4L) AS t(k)")
    assert rows(star_join(numbers, [Lookup(dim, "k", "dk", {"dk": "dk"}, attached=[attached], large=True)])) == sorted([(1, 1, None), (3, 3, 7), (4, None, None)], key=repr)
