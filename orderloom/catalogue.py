"""All queries and operators over a folder of the given order tables.

The tables are landed, cleaned and aggregated once per folder and session, with the layer
runs; queries then read the layer they are meant for, as they would in operation. Modulo
rules only choose which orders get extra dirt: every query runs over all orders and lines.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.operators.dedupe import collapse_exact
from orderloom.operators.integrity import accepted
from orderloom.operators.upsert import upsert
from orderloom.plans import checks, gold, reports, runs, silver
from orderloom.schemas import (
    BRONZE,
    CORRUPT,
    INGEST_TS,
    MONTH,
    SILVER_KEYS,
    SILVER_LAYOUT,
    UPDATED_TS,
    declared_columns,
)
from orderloom.session import filesystem, new_work_path, tune
from orderloom.sources import landing, sample_tables
from orderloom.sources.lake import Lake, stage
from orderloom.streaming import flows, weekly

# The day the reports are asked on, a day with sales, the month read on its own, where the history is halved.
AS_OF = dt.date(2001, 8, 2)
BUSY_DAY = dt.date(2001, 7, 26)
LAST_MONTH = dt.date(2001, 7, 1)
HALFWAY = dt.date(1998, 1, 1)

ITEMS = "silver_order_items"


# ---- the layers over the given tables, built once -----------------------------------------


class SampleLake:
    """Layers of one folder of tables, each built when a query first needs it."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir
        self.lake = new_lake(spark, "lake")
        self._built: dict[str, DataFrame | bool] = {}

    def _once(self, name: str, build: Callable[[], DataFrame | None]) -> DataFrame | None:
        if name not in self._built:
            self._built[name] = build()
        return self._built[name]

    def lines(self) -> DataFrame:
        """Numbered lines; their numbers are stored, so that the lines need not be."""
        return self._once("lines", lambda: sample_tables.order_lines(self.spark, self.sf_dir))

    def dirty_items(self) -> DataFrame:
        """Landed lines with resent, corrected and broken rows among them."""
        return self._once("dirty", lambda: stage(sample_tables.dirty_items(self.lines()), "dirty"))

    def dirty_parents(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Landed customers, products and orders with newer versions and broken rows among them."""
        args = (self.spark, self.sf_dir)
        return (
            sample_tables.dirty_customers(*args),
            sample_tables.dirty_products(*args),
            sample_tables.dirty_orders(*args),
        )

    def bronze(self) -> Lake:
        def build() -> None:
            sources = {
                "bronze_customers": sample_tables.customers(self.spark, self.sf_dir),
                "bronze_products": sample_tables.products(self.spark, self.sf_dir),
                "bronze_orders": sample_tables.orders(self.spark, self.sf_dir),
                "bronze_order_items": sample_tables.items(self.lines()),
            }
            for table, rows in sources.items():
                landing.load(self.lake, table, rows, replace=True)

        self._once("bronze", build)
        return self.lake

    def silver(self) -> Lake:
        self._once("silver", lambda: runs.run_silver(self.bronze()))
        return self.lake

    def gold(self) -> Lake:
        self._once("gold", lambda: runs.run_gold(self.silver()))
        return self.lake

    def checked_dirty_items(self) -> DataFrame:
        lake = self.silver()
        return silver.tagged_order_items(
            self.dirty_items(), lake.read("silver_orders"), lake.read("silver_products")
        )

    def cleaned_dirty_items(self) -> DataFrame:
        return silver.newest_accepted(self.checked_dirty_items(), ITEMS)

    def copy_of_parents(self, label: str) -> Lake:
        """A lake of its own with the tables that order items refer to."""
        source, copy = self.silver(), new_lake(self.spark, label)
        for table in ("silver_customers", "silver_products"):
            copy.publish(table, source.read(table))
        copy.publish("silver_orders", source.read("silver_orders"), MONTH)
        return copy


def new_lake(spark: SparkSession, label: str) -> Lake:
    return Lake(spark, new_work_path(spark, label), in_catalog=False)


_lakes: dict[tuple[str, str, int], SampleLake] = {}


def _last_change(spark: SparkSession, sf_dir: str) -> int:
    """When the given tables last changed: layers built before then are not used again."""
    tables = [f"{sf_dir}/{t}.parquet" for t in ("customer", "part", "orders", "lineitem")]
    found = [filesystem(spark, t) for t in tables]
    return max(fs.getFileStatus(path).getModificationTime() for fs, path in found)


def sample_lake(spark: SparkSession, sf_dir: str) -> SampleLake:
    tune(spark, sf_dir)
    key = (spark.sparkContext.applicationId, sf_dir, _last_change(spark, sf_dir))
    if key not in _lakes:
        _lakes[key] = SampleLake(spark, sf_dir)
    return _lakes[key]


# ---- result shape -----------------------------------------------------------------------

# Stamps of the run and storage columns, which no two runs or engines share.
_RUN_COLUMNS = (UPDATED_TS, "_refreshed_at")


def comparable(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Types that other engines have as well: money with two places, timestamps without zone."""
    columns = []
    for f in df.schema.fields:
        if f.name in _RUN_COLUMNS and f.name not in keep:
            continue
        c = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("decimal(18,2)")
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        columns.append(c.alias(f.name))
    return df.select(*columns)


# ---- Silver -----------------------------------------------------------------------------


def silver_customers(s: SampleLake) -> DataFrame:
    return silver.silver_customers(s.bronze().read("bronze_customers"))


def silver_products(s: SampleLake) -> DataFrame:
    return silver.silver_products(s.bronze().read("bronze_products"))


def silver_orders(s: SampleLake) -> DataFrame:
    lake = s.silver()
    return silver.silver_orders(lake.read("bronze_orders"), lake.read("silver_customers")).drop(MONTH)


def silver_order_items(s: SampleLake) -> DataFrame:
    lake = s.silver()
    parents = lake.read("silver_orders"), lake.read("silver_products")
    return silver.silver_order_items(lake.read("bronze_order_items"), *parents).drop(MONTH)


def collapse_exact_items(s: SampleLake) -> DataFrame:
    good = silver.typed(accepted(s.checked_dirty_items()), ITEMS)
    return collapse_exact(good.drop(MONTH), UPDATED_TS)


def latest_items_by_key(s: SampleLake) -> DataFrame:
    return s.cleaned_dirty_items().drop(MONTH)


def upsert_order_items(s: SampleLake) -> DataFrame:
    source_lake, lake = s.silver(), new_lake(s.spark, "upsert")
    lake.publish(ITEMS, source_lake.read(ITEMS), MONTH)
    lines = s.lines()
    batch = (
        sample_tables.fixed_items(lines)
        .unionByName(sample_tables.resent_items(lines))
        .unionByName(sample_tables.new_items(lines))
    )
    parents = source_lake.read("silver_orders"), source_lake.read("silver_products")
    rows = silver.silver_order_items(batch, *parents)
    upsert(lake, ITEMS, rows, SILVER_KEYS[ITEMS], MONTH)
    return lake.read(ITEMS).select(*declared_columns(ITEMS))


# ---- Gold -------------------------------------------------------------------------------


def dim_customer(s: SampleLake) -> DataFrame:
    return gold.dim_customer(s.silver().read("silver_customers"))


def dim_product(s: SampleLake) -> DataFrame:
    return gold.dim_product(s.silver().read("silver_products"))


def fact_order_items(s: SampleLake) -> DataFrame:
    lake = s.silver()
    return gold.fact_order_items(
        lake.read(ITEMS), lake.read("silver_orders"), lake.read("silver_products")
    )


def fact_partitioned_month(s: SampleLake) -> DataFrame:
    return s.gold().read(runs.FACT).where(F.col(MONTH) == F.lit(LAST_MONTH))


def mart_daily(s: SampleLake) -> DataFrame:
    lake = s.gold()
    return gold.mart_daily(lake.read(runs.FACT), lake.read(runs.DIM_PRODUCT))


def mart_weekly(s: SampleLake) -> DataFrame:
    lake = s.gold()
    return gold.mart_weekly(lake.read(runs.DAILY), lake.read(runs.DIM_PRODUCT))


def mart_monthly(s: SampleLake) -> DataFrame:
    lake = s.gold()
    return gold.mart_monthly(lake.read(runs.DAILY), lake.read(runs.DIM_PRODUCT))


def order_status(s: SampleLake) -> DataFrame:
    """The status view, read from the catalog."""
    shown = Lake(s.spark, s.silver().root)
    for table in ("silver_orders", ITEMS):
        shown.show_in_catalog(table)
    runs.create_status_view(shown)
    return s.spark.sql(f"SELECT * FROM {shown.view_name(runs.STATUS_VIEW)}")


def dim_order(s: SampleLake) -> DataFrame:
    return gold.dim_order(s.silver().read("silver_orders"), order_status(s))


# ---- reports and checks -----------------------------------------------------------------


def _from_gold(report: Callable[..., DataFrame], table: str, *args) -> Callable[[SampleLake], DataFrame]:
    return lambda s: report(s.gold().read(table), *args)


def _from_status(report: Callable[..., DataFrame], *args) -> Callable[[SampleLake], DataFrame]:
    return lambda s: report(order_status(s), *args)


def check_mart_vs_fact(s: SampleLake) -> DataFrame:
    """The stored mart against a fact that has since been corrected: it is out of date."""
    lake = s.gold()
    parents = lake.read("silver_orders"), lake.read("silver_products")
    corrected = gold.fact_order_items(s.cleaned_dirty_items(), *parents)
    return checks.mart_vs_fact(lake.read(runs.MONTHLY), corrected)


def check_orders_without_items(s: SampleLake) -> DataFrame:
    lake = s.silver()
    return checks.orders_without_items(lake.read("silver_orders"), lake.read(ITEMS))


def check_quarantine(s: SampleLake) -> DataFrame:
    customers, products, orders = s.dirty_parents()
    lake = s.silver()
    return checks.quarantine_counts(
        {
            "customers": silver.tagged_customers(customers),
            "products": silver.tagged_products(products),
            "orders": silver.tagged_orders(orders, lake.read("silver_customers")),
            "order_items": s.checked_dirty_items(),
        }
    )


def check_duplicate_natural_keys(s: SampleLake) -> DataFrame:
    """Customers and products of which some were landed with the email or SKU of the one before."""
    customers, products, _ = s.dirty_parents()
    return checks.duplicate_natural_keys(
        silver.silver_customers(customers), silver.silver_products(products)
    )


def silver_customers_dirty(s: SampleLake) -> DataFrame:
    return silver.silver_customers(s.dirty_parents()[0])


def silver_products_dirty(s: SampleLake) -> DataFrame:
    return silver.silver_products(s.dirty_parents()[1])


def silver_orders_dirty(s: SampleLake) -> DataFrame:
    orders = s.dirty_parents()[2]
    return silver.silver_orders(orders, s.silver().read("silver_customers")).drop(MONTH)


# ---- files and streams ------------------------------------------------------------------


def csv_bronze_items(s: SampleLake) -> DataFrame:
    """Rows written as CSV files, some of which do not fit the header, loaded and read again."""
    table, lake = "bronze_order_items", new_lake(s.spark, "csv")
    folder = f"{lake.root}/incoming"
    as_is = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    sample_tables.quoted_items(s.lines()).drop(INGEST_TS).write.csv(folder, escape='"', **as_is)
    # Written without quoting: the text is CSV already.
    misfits = sample_tables.misfit_lines(s.lines()).write.mode("append")
    misfits.csv(folder, sep="\u0001", quote="\u0000", escapeQuotes=False, **as_is)
    landing.load(lake, table, landing.from_csv(s.spark, table, folder, multi_line=True), replace=True)
    fits = F.col(CORRUPT).isNull()
    return lake.read(table).select(*landing.string_schema(table).names, (~fits).alias("misfit"))


def _incoming(s: SampleLake, lake: Lake) -> tuple[DataFrame, str]:
    """The dirty rows as a stream of files in two batches, and a place for its progress."""
    folder = f"{lake.root}/incoming"
    s.dirty_items().write.parquet(folder)
    fs, pattern = filesystem(s.spark, f"{folder}/part-*")
    per_batch = -(-len(fs.globStatus(pattern)) // 2)
    stream = flows.arriving(s.spark, "bronze_order_items", folder, files_per_batch=per_batch)
    return stream, f"{lake.root}/checkpoint"


def stream_bronze_items(s: SampleLake) -> DataFrame:
    lake = new_lake(s.spark, "stream-bronze")
    stream, checkpoint = _incoming(s, lake)
    flows.land(stream, lake, "bronze_order_items", checkpoint).awaitTermination()
    return lake.read("bronze_order_items").select(*BRONZE["bronze_order_items"].names)


def land_batch_then_stream(s: SampleLake) -> DataFrame:
    """A landing table loaded in a batch, streamed to, and appended to: all rows are there."""
    table, lake = "bronze_order_items", new_lake(s.spark, "mixed")
    landing.load(lake, table, sample_tables.items(s.lines()), replace=True)
    folder, checkpoint = f"{lake.root}/incoming", f"{lake.root}/checkpoint"
    sample_tables.resent_items(s.lines()).write.parquet(folder)
    for _ in range(2):  # the second run finds nothing new
        stream = flows.arriving(s.spark, table, folder)
        flows.land(stream, lake, table, checkpoint).awaitTermination()
    rest = sample_tables.fixed_items(s.lines()).unionByName(sample_tables.broken_items(s.lines()))
    for _ in range(2):  # a batch that comes again takes its own place
        landing.load(lake, table, rest, batch="rest")
    return lake.read(table).select(*BRONZE[table].names)


def late_parent_items(s: SampleLake) -> DataFrame:
    """Lines that land before some of their orders and products, which then come in batches."""
    source, lake = s.silver(), new_lake(s.spark, "late")
    held_back = {"silver_products": F.col("product_id") % 5 == 0, "silver_orders": F.col("order_id") % 3 == 0}
    lake.publish("silver_customers", source.read("silver_customers"))
    for table, late in held_back.items():
        lake.publish(table, source.read(table).where(~late), SILVER_LAYOUT[table])
    runs.absorb(lake, ITEMS, s.dirty_items())
    for table, late in held_back.items():
        runs.absorb(lake, table, source.read(runs.BRONZE_OF[table]).where(late))
    return lake.read(ITEMS).select(*declared_columns(ITEMS))


def stream_mart_monthly_replayed(s: SampleLake) -> DataFrame:
    """Orders move to other months; the driver is lost before Gold, and the batch runs again."""
    lake = s.copy_of_parents("replayed")
    runs.absorb(lake, ITEMS, s.dirty_items())
    runs.run_gold(lake)
    moved = sample_tables.moved_orders(s.spark, s.sf_dir)
    runs.absorb(lake, "silver_orders", moved, "batch-1")
    # Here the driver is lost; the query starts again with the same batch.
    runs.refresh_gold(lake, runs.absorb(lake, "silver_orders", moved, "batch-1"), dimensions=False)
    return lake.read(runs.MONTHLY)


def stream_silver_items(s: SampleLake) -> DataFrame:
    lake = s.copy_of_parents("stream-silver")
    stream, checkpoint = _incoming(s, lake)
    flows.upsert_silver(stream, lake, ITEMS, checkpoint).awaitTermination()
    return lake.read(ITEMS).select(*declared_columns(ITEMS))


def stream_mart_monthly(s: SampleLake) -> DataFrame:
    lake = s.copy_of_parents("stream-gold")
    stream, checkpoint = _incoming(s, lake)
    flows.upsert_and_refresh(stream, lake, ITEMS, checkpoint).awaitTermination()
    return lake.read(runs.MONTHLY)


def rejects_by_load(s: SampleLake) -> DataFrame:
    """What a rebuild of Silver from dirty tables counted while it wrote them."""
    lake = new_lake(s.spark, "counted")
    customers, products, orders = s.dirty_parents()
    landed = {"bronze_customers": customers, "bronze_products": products, "bronze_orders": orders, "bronze_order_items": s.dirty_items()}
    for table, rows in landed.items():
        landing.load(lake, table, rows, replace=True)
    counts = runs.run_silver(lake)
    found = [
        (table.removeprefix("silver_"), reason, n)
        for table, reasons in counts.items()
        for reason, n in reasons.items()
        if reason != runs.ACCEPTED
    ]
    return s.spark.createDataFrame(found, "table_name string, reject_reason string, n_rows long")


def _week_feed(s: SampleLake) -> Lake:
    """The fact as lines that arrive in three runs: the earlier half, the later half, and some lines of both that are late."""

    def build() -> Lake:
        source, lake = s.gold(), new_lake(s.spark, "weeks")
        lake.publish(runs.DIM_PRODUCT, source.read(runs.DIM_PRODUCT))
        fact, folder = source.read(runs.FACT), f"{lake.root}/incoming"
        behind, later = F.col("order_id") % 50 == 0, F.col("order_date") >= F.lit(HALFWAY)
        for arrived in (~behind & ~later, ~behind & later, behind):
            fact.where(arrived).write.mode("append").parquet(folder)
            lines = s.spark.readStream.schema(fact.schema).parquet(folder)
            weekly.close_weeks(lines, lake, f"{lake.root}/checkpoint").awaitTermination()
        return lake

    return s._once("weeks", build)


def weekly_windows_closed(s: SampleLake) -> DataFrame:
    return weekly.closed_weeks(_week_feed(s))


def weekly_windows_late(s: SampleLake) -> DataFrame:
    return _week_feed(s).read(weekly.LATE)


def _marts_by_deltas(s: SampleLake) -> Lake:
    """Marts of clean lines, brought up to date for corrected, late and moved ones by what changed alone."""

    def build() -> Lake:
        lake = s.copy_of_parents("deltas")
        late = F.col("order_id").cast("bigint") % 8 == 0
        lines = sample_tables.items(s.lines())
        runs.absorb(lake, ITEMS, lines.where(~late))
        runs.run_gold(lake)
        runs.absorb(lake, ITEMS, s.dirty_items(), "corrected-and-late")
        runs.refresh_gold(lake, dimensions=False)
        runs.absorb(lake, "silver_orders", sample_tables.moved_orders(s.spark, s.sf_dir), "moved")
        runs.refresh_gold(lake, dimensions=False)
        return lake

    return s._once("deltas", build)


def _mart_by_deltas(table: str, column: str) -> Callable[[SampleLake], DataFrame]:
    return lambda s: _marts_by_deltas(s).read(table).drop(*({MONTH} - {column}))


def items_still_waiting(s: SampleLake) -> DataFrame:
    """Lines that land in many batches before some of their orders and products; then the products come."""
    source, lake = s.silver(), new_lake(s.spark, "waiting")
    held_back = {"silver_products": F.col("product_id") % 5 == 0, "silver_orders": F.col("order_id") % 3 == 0}
    lake.publish("silver_customers", source.read("silver_customers"))
    for table, late in held_back.items():
        lake.publish(table, source.read(table).where(~late), SILVER_LAYOUT[table])
    lines, batches = sample_tables.items(s.lines()), runs.COMPACT_AFTER + 2
    for n in range(batches):
        runs.absorb(lake, ITEMS, lines.where(F.col("order_id").cast("bigint") % batches == n), f"batch-{n}")
    products = source.read("bronze_products").where(held_back["silver_products"])
    runs.absorb(lake, "silver_products", products, "products")
    waiting = runs.quarantine(lake, ITEMS)
    return waiting.select("order_item_id", "order_id", "product_id", "reject_reason")


def csv_mixed_headers(s: SampleLake) -> DataFrame:
    """CSV files with different headers in one folder: columns in another order, a new one, one that is missing."""
    table, lake = "bronze_order_items", new_lake(s.spark, "headers")
    rows = sample_tables.items(s.lines()).drop(INGEST_TS)
    part = F.col("order_id").cast("bigint") % 3
    as_is = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    kinds = [
        rows.where(part == 0),
        rows.where(part == 1).select(*reversed(rows.columns)).withColumn("channel", F.lit("WEB")),
        rows.where(part == 2).drop("status_updated_at"),
    ]
    for kind in kinds:
        kind.write.mode("append").csv(f"{lake.root}/incoming", escape='"', **as_is)
    landing.load(lake, table, landing.from_csv(s.spark, table, f"{lake.root}/incoming"), replace=True)
    return lake.read(table).select(*landing.string_schema(table).names, "channel")


_QUERIES: dict[str, Callable[[SampleLake], DataFrame]] = {
    "silver_customers": silver_customers,
    "silver_products": silver_products,
    "silver_orders": silver_orders,
    "silver_order_items": silver_order_items,
    "silver_customers_dirty": silver_customers_dirty,
    "silver_products_dirty": silver_products_dirty,
    "silver_orders_dirty": silver_orders_dirty,
    "collapse_exact_items": collapse_exact_items,
    "latest_items_by_key": latest_items_by_key,
    "upsert_order_items": upsert_order_items,
    "dim_customer": dim_customer,
    "dim_product": dim_product,
    "fact_order_items": fact_order_items,
    "fact_partitioned_month": fact_partitioned_month,
    "mart_daily": mart_daily,
    "mart_weekly": mart_weekly,
    "mart_monthly": mart_monthly,
    "order_status": order_status,
    "dim_order": dim_order,
    "top_product_last_month_mart": _from_gold(
        reports.top_product_last_month, runs.MONTHLY, AS_OF
    ),
    "top_product_last_month_fact": _from_gold(
        reports.top_product_last_month_from_fact, runs.FACT, AS_OF
    ),
    "top_product_last_week": _from_gold(reports.top_product_last_week, runs.WEEKLY, AS_OF),
    "top_product_yesterday": _from_gold(reports.top_product_yesterday, runs.DAILY, AS_OF),
    "top5_products_on_day": _from_gold(reports.top_products_on_day, runs.DAILY, BUSY_DAY),
    "leaderboard_last_month": _from_gold(reports.leaderboard_last_month, runs.FACT, AS_OF),
    "top_product_trailing_30d": _from_gold(reports.top_product_trailing, runs.FACT, AS_OF),
    "top_product_by_revenue": _from_gold(reports.top_product_by_revenue, runs.FACT, AS_OF),
    "order_status_distribution": _from_status(reports.order_status_distribution),
    "completed_orders_sample": _from_status(reports.orders_with_status, "COMPLETED"),
    "partially_shipped_sample": _from_status(reports.orders_with_status, "PARTIALLY_SHIPPED"),
    "status_peek": _from_status(reports.status_peek, ["COMPLETED", "PARTIALLY_SHIPPED"]),
    "check_mart_vs_fact": check_mart_vs_fact,
    "check_orders_without_items": check_orders_without_items,
    "check_quarantine": check_quarantine,
    "check_duplicate_natural_keys": check_duplicate_natural_keys,
    "csv_bronze_items": csv_bronze_items,
    "stream_bronze_items": stream_bronze_items,
    "land_batch_then_stream": land_batch_then_stream,
    "late_parent_items": late_parent_items,
    "stream_silver_items": stream_silver_items,
    "stream_mart_monthly": stream_mart_monthly,
    "stream_mart_monthly_replayed": stream_mart_monthly_replayed,
    "rejects_by_load": rejects_by_load,
    "mart_daily_by_deltas": _mart_by_deltas(runs.DAILY, gold.DAY),
    "mart_weekly_by_deltas": _mart_by_deltas(runs.WEEKLY, gold.WEEK),
    "mart_monthly_by_deltas": _mart_by_deltas(runs.MONTHLY, gold.MONTH_START),
    "weekly_windows_closed": weekly_windows_closed,
    "weekly_windows_late": weekly_windows_late,
    "items_still_waiting": items_still_waiting,
    "csv_mixed_headers": csv_mixed_headers,
}


def _run(query: Callable[[SampleLake], DataFrame], spark: SparkSession, sf_dir: str) -> DataFrame:
    result = query(sample_lake(spark, sf_dir))
    return comparable(result, keep=(UPDATED_TS,) if query is collapse_exact_items else ())


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: partial(_run, query) for name, query in _QUERIES.items()}
