"""What the plans must look like to hold at scale: pruning, few shuffles, hot keys."""

import contextlib
import datetime as dt

import pytest
from pyspark.sql import functions as F

from orderloom.operators.dedupe import latest_by_key
from orderloom.operators.upsert import merged_rows
from orderloom.plans import checks, deltas, gold, reports, runs, silver
from tests import shop

D = dt.date


def plan(df, mode="formatted"):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


@contextlib.contextmanager
def settings(spark, **conf):
    before = {}
    for key, value in conf.items():
        key = "spark.sql." + key.replace("__", ".")
        before[key] = spark.conf.get(key, None)
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


NO_BROADCAST = {"autoBroadcastJoinThreshold": "-1", "adaptive__autoBroadcastJoinThreshold": "-1"}
SKEW_AT_TEST_SIZE = {
    "shuffle__partitions": "16",
    **NO_BROADCAST,
    "adaptive__skewJoin__skewedPartitionThresholdInBytes": "2k",
    "adaptive__skewJoin__skewedPartitionFactor": "2",
    "adaptive__advisoryPartitionSizeInBytes": "4k",
    "adaptive__coalescePartitions__enabled": "false",
}


def test_mart_lookup_reads_one_partition_and_keeps_k_rows_per_task(built):
    text = plan(reports.top_product_last_month(built.read(runs.MONTHLY), D(2024, 4, 15)))
    assert "PartitionFilters: [isnotnull(month_start" in text
    assert "TakeOrderedAndProject" in text
    assert "Exchange" not in text


@pytest.mark.parametrize("report", [reports.top_product_yesterday, reports.top_product_last_week])
def test_day_and_week_lookups_prune_months_and_push_the_period(built, report):
    table, period = (runs.DAILY, "order_day") if "yesterday" in report.__name__ else (runs.WEEKLY, "week_start")
    text = plan(report(built.read(table), D(2024, 3, 12)))
    assert "PartitionFilters: [isnotnull(order_month" in text
    assert f"EqualTo({period}" in text


def test_fact_queries_prune_months_and_push_filters(built):
    text = plan(reports.leaderboard_last_month(built.read(runs.FACT), D(2024, 4, 15)))
    assert "PartitionFilters: [isnotnull(order_month" in text
    assert "EqualTo(line_status,DELIVERED)" in text
    assert "GreaterThanOrEqual(order_date" in text
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_month_is_the_only_folder_read(built):
    lines = reports._delivered(built.read(runs.FACT), D(2024, 3, 1), D(2024, 4, 1))
    files = lines.select(F.input_file_name()).distinct().collect()
    assert files and all("order_month=2024-03-01" in f[0] for f in files)


def test_daily_mart_shuffles_no_names_and_expands_nothing(built):
    by_day = gold.sales_by_day(built.read(runs.FACT))
    text = plan(by_day)
    assert "Expand" not in text and "SortAggregate" not in text
    assert "product_name" not in text.split("ReadSchema")[1].splitlines()[0]
    # One distinct column: the first shuffle spreads a hot product over its orders.
    exchanges = [line for line in text.splitlines() if "hashpartitioning" in line]
    assert len(exchanges) == 2
    assert sum("order_id" in line for line in exchanges) == 1


def test_dedupe_limits_a_hot_key_before_the_shuffle(spark):
    df = spark.range(0, 1000, 1, 8).selectExpr("IF(id % 3 = 0, 0, id) AS k", "id AS ts", "'x' AS v")
    text = plan(latest_by_key(df, ["k"], "ts"), "simple")
    partial, final = text.index("Partial"), text.index("Final")
    assert final < text.index("Exchange hashpartitioning(k") < partial
    kept = latest_by_key(df, ["k"], "ts").where("k = 0").first()
    assert kept.ts == 999


def test_report_from_the_fact_groups_by_number(built):
    """Names ride along; the exchanges are keyed by product and order ids."""
    with settings(built.spark, **NO_BROADCAST):
        text = plan(reports.top_product_last_month_from_fact(built.read(runs.FACT)), "simple")
    keys = [line.split("Exchange hashpartitioning(")[1].split("), ")[0] for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert keys and not any("sku" in k or "name" in k or "category" in k for k in keys)


def test_upsert_shuffles_its_target_once(spark):
    target = spark.range(0, 1000, 1, 4).selectExpr("id AS k", "'a' AS v")
    changes = spark.range(0, 10, 1, 2).selectExpr("id AS k", "'b' AS v")
    with settings(spark, **NO_BROADCAST):
        text = plan(merged_rows(target, changes, ["k"]), "simple")
    assert text.count("Exchange hashpartitioning") == 2 and text.count("LeftAnti") == 1


def test_status_counts_before_it_joins(built):
    with settings(built.spark, **NO_BROADCAST):
        text = plan(runs.order_statuses(built), "simple")
    join = text.index("SortMergeJoin")
    assert text.index("HashAggregate") > join
    assert text.count("Exchange hashpartitioning") == 2  # partial counts and headers, nothing else


def hot_order_items(spark, n=6000):
    """Lines of which a third belong to one order and a third, in other orders, to one product."""
    return spark.range(0, n, 1, 8).selectExpr(
        "id AS order_item_id",
        "IF(id % 3 = 0, 7L, id % 1500) AS order_id",
        "IF(id % 3 = 1, 1L, id % 400) AS product_id",
        "1 AS quantity",
        "CAST(1.00 AS DECIMAL(10,2)) AS unit_price",
        "CAST(1.00 AS DECIMAL(12,2)) AS line_total",
        "IF(id % 2 = 0, 'DELIVERED', 'PENDING') AS line_status",
        "TIMESTAMP'2024-03-03 00:00:00' AS status_updated_at",
    )


def hot_orders(spark):
    return spark.range(1500).selectExpr(
        "id AS order_id", "1L AS customer_id", "TIMESTAMP'2024-03-02 00:00:00' + MAKE_DT_INTERVAL(CAST(id % 60 AS INT)) AS order_date"
    )


def products(spark):
    return spark.range(400).selectExpr(
        "id AS product_id", "CONCAT('S', id) AS sku", "'n' AS product_name", "'c' AS category"
    )


def test_hot_order_and_product_are_split_in_the_fact_join(spark):
    with settings(spark, **SKEW_AT_TEST_SIZE):
        fact = gold.fact_order_items(hot_order_items(spark), hot_orders(spark), products(spark))
        got = fact.collect()
        text = plan(fact, "simple")
    assert len(got) == 6000 and len({r.order_item_id for r in got}) == 6000
    assert text.count("skew=true") >= 2


def test_hot_order_is_split_in_the_foreign_key_check(spark):
    raw = hot_order_items(spark)
    landed = shop.landing.to_bronze(raw, "bronze_order_items")
    with settings(spark, **SKEW_AT_TEST_SIZE):
        checked = silver.tagged_order_items(landed, hot_orders(spark), products(spark))
        assert len(checked.where("reject_reason IS NULL").collect()) == 6000
        checked.collect()
        text = plan(checked, "simple")
    assert text.count("skew=true") >= 2


def test_hot_product_is_split_even_where_an_aggregate_follows_on_its_key(spark):
    """Without the forced split the aggregate would reuse the join's partitioning as it is."""
    with settings(spark, **SKEW_AT_TEST_SIZE):
        fact = gold.fact_order_items(hot_order_items(spark), hot_orders(spark), products(spark))
        by_day = gold.sales_by_day(fact).drop("distinct_orders")
        total = sum(r.units_delivered + r.units_pending for r in by_day.collect())
        text = plan(by_day, "simple")
    assert total == 6000
    assert text.count("skew=true") >= 2


def test_foreign_key_joins_carry_text_only(spark):
    landed = shop.landing.to_bronze(hot_order_items(spark), "bronze_order_items")
    with settings(spark, **NO_BROADCAST):
        text = plan(silver.tagged_order_items(landed, hot_orders(spark), products(spark)))
    blocks = [b for b in text.split("\n\n") if "Exchange\n" in b and "order_item_id" in b]
    assert len(blocks) == 2
    for block in blocks:  # the id once, as text, beside the typed key of the join
        assert block.count("order_item_id") == 1 and "line_total" not in block


def test_hot_product_gives_whole_and_right_marts(spark):
    fact = gold.fact_order_items(hot_order_items(spark), hot_orders(spark), products(spark)).cache()
    daily = gold.mart_daily(fact, products(spark))
    expected = {
        (r[0], r[1]): (r[2], r[3])
        for r in fact.groupBy("product_id", F.to_date("order_date"))
        .agg(F.sum("quantity"), F.size(F.collect_set("order_id")))
        .collect()
    }
    units = sum((F.col(c) for c in ["units_delivered", "units_pending"]), F.lit(0))
    got = {
        (r.product_id, r.order_day): (r.u, r.distinct_orders)
        for r in daily.withColumn("u", units).collect()
    }
    assert got == expected
    fact.unpersist()


def exchanges(df):
    return plan(df, "simple").count("Exchange hashpartitioning")


def unstamped(df):
    columns = [*gold.PRODUCT_COLUMNS, *(c for c in sorted(df.columns) if c not in (*gold.PRODUCT_COLUMNS, "_refreshed_at", "order_month"))]
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


@pytest.mark.parametrize("period, plain", [(gold.WEEK, gold.mart_weekly), (gold.MONTH_START, gold.mart_monthly)])
def test_rolled_up_mart_is_shuffled_once_into_its_folders(built, period, plain):
    """One shuffle to the folders, also where a folder is dealt to several tasks; by product where the names are many."""
    daily, names = built.read(runs.DAILY), built.read(runs.DIM_PRODUCT)
    expected = unstamped(plain(daily, names))
    month = daily.select("order_month").first()[0]
    for large in ({}, {month: 3, None: 2}):
        mart = gold.stored_roll_up(daily, names, period, True, large)
        assert exchanges(mart) == 1 and unstamped(mart) == expected
        tasks = mart.select(gold.folder_of(period), "product_id", F.spark_partition_id()).distinct()
        assert len({r[:2] for r in tasks.collect()}) == tasks.count()
    with settings(built.spark, **NO_BROADCAST):
        mart = gold.stored_roll_up(daily, names, period, gold.names_fit(names), {month: 3})
        assert exchanges(mart) == 2 and unstamped(mart) == expected  # the mart once and the names once


def test_refreshed_mart_is_shuffled_once_into_its_folders(built):
    names, daily = built.read(runs.DIM_PRODUCT), built.read(runs.DAILY)
    changes = daily.select("product_id", gold.DAY, *deltas.MEASURES).limit(3)
    mart = deltas.merged(daily, changes, names, gold.DAY, True, {})
    assert plan(mart, "simple").split("Union")[0].count("Exchange hashpartitioning") == 1
    found = {(r.product_id, r.order_day): r for r in mart.collect()}
    changed = {(r.product_id, r.order_day) for r in changes.collect()}
    for row in daily.collect():
        key = row.product_id, row.order_day
        assert found[key].distinct_orders == row.distinct_orders * (2 if key in changed else 1)
        assert found[key].order_month == row.order_month


def test_names_join_after_lines_and_days_are_in_their_months(built):
    """The shuffle to the months carries no names, whose columns are wider than all others."""
    lake, names = built, built.read(runs.DIM_PRODUCT)
    fact = gold.fact_order_items(lake.read("silver_order_items"), lake.read("silver_orders"), lake.read("silver_products"), dealt=True)
    for rows in (fact, gold.stored_mart_daily(lake.read(runs.FACT), names, True)):
        blocks = [b for b in plan(rows).split("\n\n") if "REBALANCE_PARTITIONS_BY_COL" in b]
        assert blocks and not any("product_name" in b for b in blocks)
    assert fact.count() == lake.read(runs.FACT).count()


def test_check_of_the_mart_adds_lines_up_to_months_at_once(built):
    with settings(built.spark, **NO_BROADCAST):
        found = checks.mart_vs_fact(built.read(runs.MONTHLY), built.read(runs.FACT))
        assert exchanges(found) == 3 and found.count() == 0  # the sums, and both sides of the join
