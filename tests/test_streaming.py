import datetime as dt

import pytest
from pyspark.sql import functions as F

from orderloom.plans import runs
from orderloom.sources import landing
from orderloom.streaming import flows
from tests import shop
from tests.shop import rows
from tests.test_storage import full_state, item

ITEMS = "silver_order_items"


def arrive(spark, folder, table, batches):
    """Write each list of rows as one file."""
    for batch in batches:
        shop.bronze(spark, table, batch).coalesce(1).write.mode("append").parquet(folder)


@pytest.fixture
def parents(spark, new_lake):
    """A lake with the tables that lines refer to, and no lines yet."""

    def make(name):
        lake = new_lake(name)
        shop.land(lake)
        for table, bronze in runs.BRONZE_OF.items():
            if table != ITEMS:
                runs.absorb(lake, table, lake.read(bronze))
        return lake

    return make


def shuffled_batches():
    lines = shop.item_rows()
    fix = [(*r[:5], "RETURNED", r[6], shop.T2) for r in lines if r[1] == "13"]
    return [fix + lines[1::2], lines[::2], lines[:5]]  # the correction comes first, some rows twice


def test_arriving_rows_are_landed_once(spark, new_lake, tmp_path):
    lake, table = new_lake(), "bronze_order_items"
    folder, checkpoint = str(tmp_path / "in"), str(tmp_path / "progress")
    arrive(spark, folder, table, [shop.item_rows()[:4], shop.item_rows()[4:6]])
    for extra in ([], [shop.item_rows()[6:7]], []):
        arrive(spark, folder, table, extra)
        stream = flows.arriving(spark, table, folder, files_per_batch=1)
        flows.land(stream, lake, table, checkpoint).awaitTermination()
    assert lake.read(table).count() == 7
    assert lake.exists(table)


def test_csv_files_can_arrive(spark, new_lake, tmp_path):
    lake, table = new_lake(), "bronze_orders"
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "1.csv").write_text("order_id,customer_id,order_date,shipping_address\n1, 2 ,x,y\n")
    stream = flows.arriving(spark, table, str(folder), "csv")
    flows.land(stream, lake, table, str(tmp_path / "progress")).awaitTermination()
    row = lake.read(table).first()
    assert (row.order_id, row.customer_id) == ("1", " 2 ")
    assert row._ingest_ts is not None


def test_many_batches_equal_one(spark, parents, tmp_path):
    batches = shuffled_batches()
    stepwise, whole = parents("stepwise"), parents("whole")
    folder = str(tmp_path / "in")
    arrive(spark, folder, "bronze_order_items", batches)
    stream = flows.arriving(spark, "bronze_order_items", folder, files_per_batch=1)
    flows.upsert_and_refresh(stream, stepwise, ITEMS, str(tmp_path / "progress")).awaitTermination()
    together = shop.bronze(spark, "bronze_order_items", [r for b in batches for r in b])
    runs.absorb(whole, ITEMS, together)
    runs.run_gold(whole)
    assert rows(stepwise.read(ITEMS)) == rows(whole.read(ITEMS), *stepwise.read(ITEMS).columns)
    rejected = runs.quarantine(stepwise, ITEMS)
    assert rows(rejected) == rows(runs.quarantine(whole, ITEMS), *rejected.columns)
    assert full_state(stepwise) == full_state(whole)
    returned = whole.read(ITEMS).where("order_id = 13")
    assert rows(returned.select("line_status").distinct()) == [("RETURNED",)]


def test_batch_that_runs_again_changes_nothing(spark, parents):
    lake = parents("again")
    first = shop.bronze(spark, "bronze_order_items", shop.item_rows())
    later = shop.bronze(spark, "bronze_order_items", [item(101, 10, "RETURNED", shop.T2)])
    for batch in (first, later):
        runs.refresh_gold(lake, runs.absorb(lake, ITEMS, batch))
    state, lines = full_state(lake), rows(lake.read(ITEMS))
    for batch in (later, first):  # also an old batch after a newer one
        runs.refresh_gold(lake, runs.absorb(lake, ITEMS, batch))
    assert full_state(lake) == state
    assert rows(lake.read(ITEMS)) == lines


def test_only_touched_months_are_rewritten(spark, parents):
    lake = parents("touched")
    batch = shop.bronze(spark, "bronze_order_items", shop.item_rows())
    runs.refresh_gold(lake, runs.absorb(lake, ITEMS, batch))

    def files(table):
        return {str(f) for f in lake.read(table).inputFiles()}

    before = {t: files(t) for t in (runs.FACT, runs.MONTHLY, runs.DAILY)}
    change = shop.bronze(spark, "bronze_order_items", [item(101, 10, "RETURNED", shop.T2)])
    touched = runs.absorb(lake, ITEMS, change)
    runs.refresh_gold(lake, touched)
    assert touched == [dt.date(2024, 2, 1)]
    for t, old in before.items():
        rewritten = files(t) ^ old
        assert rewritten and all("2024-02-01" in f for f in rewritten)
    assert lake.read(runs.FACT).where(F.col("order_item_id") == 101).first().line_status == "RETURNED"


class Lost(Exception):
    """The driver is gone."""


def _lose_after(monkeypatch, owner, method, table):
    """Lose the driver right after the first call of the method for this table."""
    plain = getattr(owner, method)

    def then_lost(self, name, *args, **kwargs):
        plain(self, name, *args, **kwargs)
        if name == table:
            raise Lost

    monkeypatch.setattr(owner, method, then_lost)


@pytest.mark.parametrize(
    "method, table",
    [
        ("replace_partitions", "silver_orders"),
        ("replace_partitions", ITEMS),
        ("append", "silver_orders_rejected"),
        ("publish", "silver_products"),
        ("publish", runs.DIM_PRODUCT),
        ("replace_partitions", runs.FACT),
        ("replace_partitions", runs.MONTHLY),
    ],
)
def test_lost_driver_is_made_up_for(spark, new_lake, monkeypatch, method, table):
    """An order moves to another month and a product is renamed; each batch runs until it succeeds."""
    lake = new_lake()
    shop.build(lake)
    product = ("1", "lamp-a", "Floor lamp", "Light", "10.00", None, shop.T1)
    batches = {
        "silver_orders": [("14", "1", "2024-01-31 00:00:00", "x", shop.T1)],
        "silver_products": [product],
    }
    losses = 0
    for changed, values in batches.items():
        landed = shop.bronze(spark, runs.BRONZE_OF[changed], values)
        with monkeypatch.context() as m:
            _lose_after(m, type(lake), method, table)
            try:
                runs.refresh_gold(lake, runs.absorb(lake, changed, landed, changed))
                continue
            except Lost:
                losses += 1
        runs.refresh_gold(lake, runs.absorb(lake, changed, landed, changed))
    assert losses
    refreshed = full_state(lake)
    runs.run_gold(lake)
    assert refreshed == full_state(lake)
    assert rows(lake.read(ITEMS).where("order_id = 14"), "order_month") == [(dt.date(2024, 1, 1),)] * 2
    assert lake.notes("months") == {} and lake.notes("moved") == {}


def test_equal_time_that_loses_leaves_lines_where_they_are(spark, new_lake):
    lake = new_lake()
    shop.build(lake)
    order = lake.read("silver_orders").where("order_id = 14").first()
    stamp = order._updated_ts.strftime("%Y-%m-%d %H:%M:%S")
    loser = ("14", "1", "2000-01-01 00:00:00", "", stamp)
    before = full_state(lake)
    assert runs.absorb(lake, "silver_orders", shop.bronze(spark, "bronze_orders", [loser])) == []
    runs.refresh_gold(lake, [])
    assert full_state(lake) == before


def test_streams_pin_the_zone(spark, parents, tmp_path):
    lake = parents("zone")
    arrive(spark, str(tmp_path / "in"), "bronze_orders", [[("90", "1", "2024-02-29 23:59:59", "x", shop.T1)]])
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    stream = flows.arriving(spark, "bronze_orders", str(tmp_path / "in"))
    flows.upsert_silver(stream, lake, "silver_orders", str(tmp_path / "progress")).awaitTermination()
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    row = lake.read("silver_orders").where("order_id = 90").first()
    assert (row.order_month, row.order_date) == (dt.date(2024, 2, 1), dt.datetime(2024, 2, 29, 23, 59, 59))


def test_batch_landing_then_stream(spark, new_lake, tmp_path):
    lake, name = new_lake(), "bronze_order_items"
    landing.load(lake, name, shop.bronze(spark, name, shop.item_rows()[:3]), replace=True)
    arrive(spark, str(tmp_path / "in"), name, [shop.item_rows()[3:5]])
    for _ in range(2):
        stream = flows.arriving(spark, name, str(tmp_path / "in"))
        flows.land(stream, lake, name, str(tmp_path / "progress")).awaitTermination()
    landing.load(lake, name, shop.bronze(spark, name, shop.item_rows()[5:6]))
    assert lake.read(name).count() == 6
