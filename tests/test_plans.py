"""Shape of the physical plans, and behaviour when one key holds most rows."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR, rows
from tidemark.operators import joins, merge
from tidemark.plans import commerce, rental
from tidemark.registry import QUERIES
from tidemark.registry import bindings as b
from tidemark.registry.core import table
from tidemark.session import TASK_LIMITS, configure, fits_broadcast, shared_folder, size_shuffles


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


SLOW_TO_BUILD = ("stream", "mobile", "latest", "trip", "signal", "gps", "status", "music", "report", "fares")


@pytest.mark.parametrize("name", [
    n for n in sorted(QUERIES) if not any(w in n for w in SLOW_TO_BUILD)
])
def test_no_plan_multiplies_rows_or_calls_python(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas"):
        assert node not in plan


def test_scans_read_the_columns_they_need(spark, settings):
    settings(maxMetadataStringLength="2000")
    plan = plan_of(QUERIES["location_performance"](spark, SF_DIR))
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint,l_extendedprice:double>" in plan
    assert "PushedFilters: [IsNotNull(l_suppkey), IsNotNull(l_partkey)]" in plan


def test_ranks_are_cut_before_the_shuffle(spark):
    plan = plan_of(QUERIES["rank_within_group"](spark, SF_DIR))
    assert re.search(r"WindowGroupLimit .*Partial", plan)


def order_frames(spark, hot):
    """Items of which a share belong to one order."""
    items = spark.range(60000).select(
        F.when(F.col("id") % 3 < hot, 7).otherwise(F.col("id") % 5000).alias("order_id"),
        (F.col("id") % 11).alias("product_id"), (F.col("id") % 1000 / 100).cast("decimal(18,2)").alias("sale_price"),
    )
    orders = spark.range(5000).select(
        F.col("id").alias("order_id"), (F.col("id") % 50).alias("user_id"),
        F.when(F.col("id") % 4 == 0, "Returned").otherwise("Complete").alias("status"),
        F.concat(F.lit("2024-01-0"), (F.col("id") % 9 + 1).cast("string"), F.lit(" 00:00:00")).alias("created_at"),
        F.lit(2).alias("num_of_item"),
    )
    products = spark.range(11).select("id", F.concat(F.lit("c"), F.col("id") % 3).alias("category"))
    return orders, items, products


def test_orders_are_collapsed_without_another_shuffle(spark, settings):
    settings(autoBroadcastJoinThreshold="-1")
    plan = plan_of(commerce.category_wise_summary(*order_frames(spark, 0)))
    # Two for the products, two for the orders, one for the result.
    assert plan.count("Exchange hashpartitioning") == 5
    assert plan.count("Exchange hashpartitioning(order_id") == 2


def test_an_order_with_a_third_of_all_items_is_split(spark, settings):
    orders, items, products = order_frames(spark, 1)
    want = rows(commerce.category_wise_summary(orders, items, products))
    settings(
        autoBroadcastJoinThreshold="-1", adaptive__advisoryPartitionSizeInBytes="16KB",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="32KB", adaptive__skewJoin__skewedPartitionFactor="2",
    )
    df = commerce.category_wise_summary(orders, items.repartition(8), products)
    assert rows(df) == want
    assert "skew=true" in plan_of(df)


def test_a_user_with_a_third_of_all_rentals_is_collapsed_first(spark, settings):
    settings(autoBroadcastJoinThreshold="-1")
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("user_id"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("rental_start_time"),
        F.lit("2024-01-01 01:00:00").cast("timestamp").alias("rental_end_time"), F.lit(1).alias("total_amount"),
    )
    out = rental.user_metrics(df, spark.range(30000).toDF("user_id"))
    assert out.filter("user_id = 1").first()["total_user_transactions"] == 10001
    plan = plan_of(out)
    # The rows meet their user after the partial sums, on the same partitioning.
    assert plan.count("Exchange hashpartitioning(user_id") == 2
    assert plan.index("SortMergeJoin") < plan.index("partial_count(1)")


def test_salted_join_spreads_one_key_and_gives_the_same_rows(spark, settings):
    settings(autoBroadcastJoinThreshold="-1", adaptive__coalescePartitions__enabled="false")
    left = spark.range(20000).select(F.lit(5).alias("k"), "id")
    right = spark.createDataFrame([(5, "x"), (5, "y"), (6, "z")], "k int, v string")
    for how in ("inner", "left", "left_semi", "left_anti"):
        assert rows(joins.salted_join(left, right, ["k"], how)) == rows(left.join(right, "k", how))
    spread = joins.salted_join(left, right, ["k"]).groupBy(F.spark_partition_id()).count().count()
    assert spread > 1
    with pytest.raises(ValueError):
        joins.salted_join(left, right, ["k"], "full")


def test_no_setting_lets_a_task_take_more_than_its_limits(spark, settings):
    settings(files__maxPartitionBytes="128MB", adaptive__advisoryPartitionSizeInBytes="16k", execution__arrow__maxRecordsPerBatch="0")
    configure(spark)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == str(TASK_LIMITS["spark.sql.files.maxPartitionBytes"])
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "1024"
    # What is lower stays.
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16k"


def test_shuffles_of_files_are_sized_by_what_their_rows_take(spark, settings, tmp_path):
    settings(shuffle__partitions="1")
    spark.range(5_000_000).select(F.xxhash64("id").alias("a")).write.parquet(str(tmp_path / "t.parquet"))
    table(spark, str(tmp_path), "t")
    assert int(spark.conf.get("spark.sql.shuffle.partitions")) > 1


def test_copies_of_a_salted_join_are_not_broadcast(spark):
    left = spark.range(100).select((F.col("id") % 7).alias("k"), "id")
    right = spark.range(7).select(F.col("id").alias("k"), F.lit("v").alias("v"))
    assert fits_broadcast(right)
    for how in ("inner", "left", "left_semi", "left_anti"):
        for hot in (None, F.col("k") == 3):
            joined = joins.salted_join(left, right, ["k"], how, 4, hot)
            assert "Broadcast" not in plan_of(joined)
            assert rows(joined) == rows(left.join(right, "k", how))


def test_merge_does_not_shuffle_the_target_for_a_small_source(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).select(F.col("id").alias("k"), F.lit("x").alias("v")).write.parquet(path)
    target = spark.read.parquet(path)
    spark.createDataFrame([(1, "y"), (5000, "z")], "k long, v string").write.parquet(f"{path}-new")
    source = spark.read.parquet(f"{path}-new")
    assert fits_broadcast(source)
    merged = merge.merge_columns(target, source, ["k"], ["v"], ["v"])
    plan = plan_of(merged)
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin [k" in plan
    assert merged.count() == 1001


def test_hot_source_key_is_one_row_per_task_before_the_shuffle(spark):
    source = spark.range(10000).select(F.when(F.col("id") >= 0, 1).alias("k"), F.col("id").alias("at"))
    latest = merge.latest_per_key(source, ["k"], ["at"])
    assert rows(latest) == [(1, 9999)]
    assert re.search(r"WindowGroupLimit .*Partial", plan_of(latest))


def test_shuffles_grow_with_the_input_and_never_shrink(spark, settings):
    settings(shuffle__partitions="8")
    small = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    assert size_shuffles(spark, small) == 8
    large = spark.range(3 * 10**9)
    assert size_shuffles(spark, large) == 90
    assert size_shuffles(spark, small) == 90


def test_scratch_lies_in_the_shared_folder_of_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_bindings_read_whole_tables(spark):
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").count()
    assert b.line_streams(spark, SF_DIR).count() == lines
    assert b.shop_items(spark, SF_DIR).count() == lines


def test_hourly_kpis_expand_no_rows(spark, sf_dir):
    from tidemark.plans.listening import hourly_kpis

    plan = plan_of(hourly_kpis(b.event_streams(spark, sf_dir), b.songs(spark, sf_dir), b.listeners(spark, sf_dir)))
    assert "Expand" not in plan and "spark_grouping_id" not in plan


def test_only_hot_keys_are_salted(spark):
    left = spark.createDataFrame([("hot", i) for i in range(50)] + [("cold", 1), (None, 2)], "k string, v int")
    right = spark.createDataFrame([("hot", "x"), ("cold", "y"), ("other", "z")], "k string, w string")
    got = joins.salted_join(left, right, ["k"], salts=4, hot=F.col("k") == "hot")
    assert rows(got) == rows(left.join(right, "k"))
    assert rows(joins.salted_join(left, right, ["k"], "left", 4, F.col("k") == "hot")) == rows(left.join(right, "k", "left"))


def test_scratch_is_cleared(spark, tmp_path):
    from tidemark import session, storage
    from tidemark.operators.staging import staged

    staged(spark.range(3), "cleared")
    session.clear_scratch(spark)
    assert storage.listing(spark, session._scratch(spark)) == []


def skewed(spark, n=9000):
    """A third of the rows under one key, a tenth without a key, the rest spread."""
    i = F.col("id")
    key = F.when(i % 3 == 0, "hot").when(i % 10 != 1, F.concat(F.lit("k"), i % 3000))
    return spark.range(n).select(key.alias("k"), i.alias("v"))


def test_a_sketch_names_every_key_above_the_share(spark):
    df = skewed(spark)
    assert rows(joins.hot_key_counts(df, ["k"], 1 / 20)) == sorted(
        rows(df.groupBy("k").count().filter("count > 450")), key=lambda r: (r[0] is None, r[0]))
    assert [r["k"] for r in joins.hot_key_counts(df.filter("k is not null"), ["k"], 0.3).collect()] == ["hot"]
    # Two columns, nothing above the share, no rows.
    assert joins.hot_key_counts(df, ["k", "v"], 1 / 512).count() == 0
    assert joins.hot_hashes(df.limit(0), ["k"], 0.1) == []
    for share in (0, 1 / 1000, 2):
        with pytest.raises(ValueError):
            joins.hot_hashes(df, ["k"], share)


def test_rows_of_the_other_side_are_copied_for_named_keys_only(spark, settings):
    left = skewed(spark)
    right = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("k"), "id").unionByName(
        spark.createDataFrame([("hot", -1)], "k string, id long"))
    hot = joins.hot_keys(left, ["k"], 1 / 20)
    assert joins._copied(right, hot, 16).count() == 3001 + 15
    for how in ("inner", "left", "left_semi", "left_anti"):
        assert rows(joins.salted_join(left, right, ["k"], how, hot=hot)) == rows(left.join(right, "k", how))
    # A third of the rows lie in many tasks, and so do those without a key.
    settings(autoBroadcastJoinThreshold="-1", adaptive__enabled="false")
    spread = joins.salted_join(left, right, ["k"], "left", hot=hot).select("k", F.spark_partition_id().alias("p"))
    tasks = dict(spread.groupBy("k").agg(F.count_distinct("p")).collect())
    assert tasks.pop("hot") > 1 and tasks.pop(None) > 1
    assert set(tasks.values()) == {1}
    with pytest.raises(ValueError, match="one type"):
        joins.salted_join(spark.range(3).toDF("k"), spark.range(3).select(F.col("id").cast("int").alias("k")), ["k"], hot=hot)
