import random

import pytest
from conftest import plan_text
from pyspark.sql import Window
from pyspark.sql import functions as F

from roadrisk.operators import joins, ranking, shared
from roadrisk.operators.ranking import Ranking, row_numbers
from roadrisk.sources import cities


def same(left, right):
    order = sorted(left.columns)
    key = [repr(r) for r in left.select(*order).collect()]
    other = [repr(r) for r in right.select(*order).collect()]
    return sorted(key) == sorted(other)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows on one key, a tenth on NULL."""
    rng = random.Random(3)
    rows = [(i, "hot" if i % 3 == 0 else None if i % 10 == 1 else f"k{rng.randrange(60)}") for i in range(3000)]
    return spark.createDataFrame(rows, "id long, key string")


@pytest.fixture(scope="module")
def lookup(spark):
    rows = [("hot", 1), ("hot", 2), (None, 3)] + [(f"k{i}", i) for i in range(0, 60, 2)]
    return spark.createDataFrame(rows, "key string, value int")


@pytest.mark.parametrize("salts", [1, 2, 8])
def test_spread_join_is_a_left_join(skewed, lookup, salts):
    spread = joins.spread_left_join(skewed, lookup, ["key"], spread_by="id", salts=salts)
    assert same(spread, skewed.join(lookup, ["key"], "left"))


def test_hot_rows_get_several_salts(spark, skewed, lookup):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        spread = joins.spread_left_join(skewed, lookup, ["key"], spread_by="id", salts=16)
        where = spread.where("key = 'hot'").select(F.spark_partition_id().alias("p")).distinct().count()
        plain = skewed.join(lookup, ["key"], "left").where("key = 'hot'").select(
            F.spark_partition_id().alias("p")).distinct().count()
        assert (where > 1, plain) == (True, 1)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_adaptive_execution_splits_the_hot_key(spark):
    """The plain join of a hot key runs in more tasks than the shuffle has partitions."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        detail = shared.written(spark.range(60_000).repartition(8).selectExpr(
            "id", "if(id % 2 = 0, 'hot', concat('k', id % 500)) AS key", "uuid() AS filler"), "detail")
        lookup = shared.written(spark.range(500).selectExpr("concat('k', id) AS key", "id AS value").union(
            spark.createDataFrame([("hot", -1)], "key string, value long")), "lookup")
        joined = joins.spread_left_join(detail, lookup, ["key"], spread_by="id")
        out = shared.written(joined.withColumn("p", F.spark_partition_id()), "joined").where("value = -1")
        assert out.count() == 30_000 and out.select("p").distinct().count() > 1
    finally:
        for name in settings:
            spark.conf.unset(name)


def test_planning_a_join_runs_no_job(spark, skewed, lookup):
    from roadrisk import schemas
    from roadrisk.plans import staging, traffic_mart
    flow = staging.stage_flow(spark.createDataFrame([], schemas.TRAFFIC_FLOW_RAW))
    tracker, group = spark.sparkContext.statusTracker(), "planning"
    spark.sparkContext.setJobGroup(group, group)
    try:
        joins.spread_left_join(skewed, lookup, ["key"], spread_by="id")
        traffic_mart.traffic_mart(flow)
        assert list(tracker.getJobIdsForGroup(group)) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_boxes_match_brute_force(spark):
    dimension = cities.city_dimension(spark)
    rng = random.Random(5)
    centres = [(r.latitude, r.longitude) for r in dimension.collect()]
    points = [(i, la + rng.uniform(-0.15, 0.15), lo + rng.uniform(-0.15, 0.15))
              for i, (la, lo) in enumerate(rng.choices(centres, k=1500))]
    points += [(5000 + i, la + 0.1, lo - 0.1) for i, (la, lo) in enumerate(centres)]
    frame = spark.createDataFrame(points, "id long, latitude double, longitude double")
    found = joins.inside_city_boxes(frame, dimension)
    assert "BroadcastHashJoin" in plan_text(found) and "NestedLoop" not in plan_text(found)
    boxes = [(r.name, r.min_lat, r.max_lat, r.min_lon, r.max_lon) for r in cities.with_box(dimension).collect()]
    expected = {(i, n) for i, la, lo in points for n, a, b, c, d in boxes if a <= la <= b and c <= lo <= d}
    got = [(r.id, r.box_city) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == expected
    assert max(sum(1 for j, _ in expected if j == i) for i in {i for i, _ in expected}) > 1


RANKINGS = [Ranking("all_rank", "value"), Ranking("group_rank", "value", "part"), Ranking("other_rank", "other", "part")]


@pytest.mark.parametrize("partitions", [1, 3, 7])
def test_row_numbers_match_windows(spark, partitions):
    rng = random.Random(partitions)
    rows = []
    for i in range(2000):
        value = None if rng.random() < 0.1 else 50.0 if rng.random() < 0.4 else rng.randrange(40) / 4
        rows.append((f"id{rng.randrange(500)}", i, rng.choice(["a", "a", "a", "b", None]), value, rng.random()))
    frame = spark.createDataFrame(rows, "record_id string, key long, part string, value double, other double")
    table = shared.written(frame, "ranked")
    got = row_numbers(table, RANKINGS, ["record_id", "key"], partitions)

    def window(value, *part):
        spec = Window.partitionBy(*part).orderBy(F.col(value).desc_nulls_first(), "record_id", "key")
        return F.row_number().over(spec).cast("long")

    expected = frame.select("key", window("value", F.lit(1)).alias("all_rank"),
                            window("value", "part").alias("group_rank"), window("other", "part").alias("other_rank"))
    assert same(got, expected)


def test_ranking_has_no_unpartitioned_window(spark):
    frame = shared.written(spark.range(100).select(
        F.col("id").alias("key"), F.lit("r").alias("record_id"), F.lit("p").alias("part"),
        F.rand(1).alias("value"), F.rand(2).alias("other")), "ranked")
    plan = plan_text(row_numbers(frame, RANKINGS, ["record_id", "key"]))
    assert "SinglePartition" not in plan


def test_all_rankings_share_one_sort(spark):
    frame = shared.written(spark.range(50).select(
        F.col("id").alias("key"), F.lit("r").alias("record_id"), F.lit("p").alias("part"),
        F.lit(1.0).alias("value"), F.rand(2).alias("other")), "ranked")
    plan = plan_text(ranking._sorted(frame, RANKINGS, ["record_id", "key"], 4))
    assert plan.count("Exchange rangepartitioning") == plan.count("Scan parquet") == 1
    placed = ranking._sorted(frame, RANKINGS, ["record_id", "key"], 4)
    assert placed.where("_ranking = 0").select("_part").distinct().count() > 1  # equal values are spread as well


def test_rankings_of_an_empty_table(spark):
    frame = shared.written(spark.range(0).select(
        F.col("id").alias("key"), F.lit("r").alias("record_id"), F.lit("p").alias("part"),
        F.rand(1).alias("value"), F.rand(2).alias("other")), "ranked")
    assert row_numbers(frame, RANKINGS, ["record_id", "key"]).collect() == []


def test_shared_folder_is_the_clusters(spark):
    assert shared.scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
