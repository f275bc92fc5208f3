import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from orderloom import Lake, LakeNames
from orderloom import session as session_module
from orderloom.operators.upsert import merge_into_table, upsert
from orderloom.plans import runs, silver
from orderloom.session import filesystem, new_work_path, shuffle_partitions, work_dir
from orderloom.sources import lake as lake_module
from orderloom.sources import landing
from tests import shop
from tests.shop import rows

JAN, FEB, MAR = dt.date(2024, 1, 1), dt.date(2024, 2, 1), dt.date(2024, 3, 1)
T = "silver_demo"


def table(spark, *values):
    return spark.createDataFrame(list(values), "k int, v string, ts int, m date")


# ---- versions ---------------------------------------------------------------------------


def test_versions_are_kept_by_age(spark, new_lake):
    lake = new_lake()
    for n in (1, 2, 3):
        lake.publish(T, table(spark, (n, "x", 0, JAN)))
    assert lake.versions(T) == [1, 2, 3]
    assert rows(lake.read(T), "k") == [(3,)]
    hasty = new_lake(keep_for=dt.timedelta(0))
    hasty.publish(T, table(spark, (4, "x", 0, JAN)))
    assert hasty.versions(T) == [4]
    assert rows(hasty.read(T), "k") == [(4,)]


def test_a_table_may_be_rebuilt_from_itself_with_another_schema(spark, new_lake):
    lake = new_lake()
    lake.publish(T, table(spark, (1, "x", 0, JAN)))
    lake.publish(T, lake.read(T).withColumn("w", F.lit(2)))
    assert rows(lake.read(T), "k", "w") == [(1, 2)]


def test_failed_write_leaves_the_table_as_it_was(spark, new_lake):
    lake = new_lake()
    lake.publish(T, table(spark, (1, "x", 0, JAN)))
    with pytest.raises(Exception):
        lake.publish(T, table(spark, (2, "x", 0, JAN)).withColumn("w", F.expr("raise_error('no')")))
    assert rows(lake.read(T), "k") == [(1,)]
    lake.publish(T, table(spark, (3, "x", 0, JAN)))
    assert rows(lake.read(T), "k") == [(3,)]


def test_unknown_table(new_lake):
    with pytest.raises(FileNotFoundError):
        new_lake().read("gold_nothing")


def test_partitioned_table_without_rows_can_be_read(spark, new_lake):
    lake = new_lake()
    lake.publish(T, table(spark, (1, "x", 0, JAN)).where("k > 1"), "m")
    assert lake.read(T).count() == 0
    assert dict(lake.read(T).dtypes)["m"] == "date"


def test_tables_are_shown_in_the_catalog(spark, built):
    spark.catalog.setCurrentDatabase("orders_silver")
    try:
        assert spark.table("silver_products").count() == 3
    finally:
        spark.catalog.setCurrentDatabase("default")
    assert spark.table("orders_gold.gold_fact_order_items").count() == built.read(runs.FACT).count()


def test_work_folder_is_the_one_the_session_names(spark):
    assert work_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert new_work_path(spark, "a") != new_work_path(spark, "a")


def test_shuffle_partitions_grow_with_the_input(spark, new_lake):
    lake = new_lake()
    lake.publish(T, table(spark, (1, "x", 0, JAN)))
    assert shuffle_partitions(spark, lake.path(T)) == spark.sparkContext.defaultParallelism


def test_shuffle_partitions_have_no_ceiling_but_the_one_that_is_asked_for(spark, monkeypatch):
    monkeypatch.setattr(session_module, "stored_bytes", lambda *_: 100 * 10**12)
    assert shuffle_partitions(spark, "x") > 1_000_000
    assert shuffle_partitions(spark, "x", most=5000) == 5000


def test_tasks_stay_small_whatever_the_input(spark, monkeypatch):
    """Rows in memory, some ten times their stored bytes, fit a task's share of the heap before and after a shuffle."""
    for gigabytes in (1, 6, 100):
        stored = gigabytes * 10**9
        monkeypatch.setattr(session_module, "stored_bytes", lambda *_, stored=stored: stored)
        assert 10 * stored / shuffle_partitions(spark, "x") < 100 * 10**6
    for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes"):
        assert int(spark.conf.get(key).removesuffix("m")) <= 32


def test_numbered_lines_are_stored_once(spark, tmp_path, monkeypatch):
    from orderloom.sources import sample_tables
    from orderloom.catalogue import SampleLake

    lines = "id AS l_orderkey, 1 AS l_linenumber, id AS l_partkey, id AS l_suppkey, DATE'1998-01-01' AS l_shipdate"
    more = "10.0D AS l_extendedprice, 2.0D AS l_quantity, 'N' AS l_returnflag, 'O' AS l_linestatus"
    spark.range(50).selectExpr(*f"{lines}, {more}".split(", ")).write.parquet(f"{tmp_path}/lineitem.parquet")
    labels, plain = [], lake_module.Scratch.stage
    monkeypatch.setattr(lake_module.Scratch, "stage", lambda self, df, label: labels.append(label) or plain(self, df, label))
    found = SampleLake(spark, str(tmp_path)).lines()
    assert sorted(r.line_id for r in found.collect()) == list(range(1, 51))
    assert [r.line_id for r in found.sort("order_key").collect()] == [r.line_id for r in sample_tables.order_lines(spark, str(tmp_path)).sort("order_key").collect()]
    assert "lines" not in labels and labels.count("numbering") == 2  # once for each of the two frames


def test_stored_files_are_small(spark, new_lake):
    lake = new_lake()
    lake.publish(T, table(spark, (1, "x", 0, JAN)))
    fs, files = filesystem(spark, f"{lake.current_path(T)}/*.parquet")
    assert all(".zstd." in status.getPath().getName() for status in fs.globStatus(files))


def test_rows_that_are_swapped_in_are_shuffled_once(spark, new_lake, monkeypatch):
    lake = new_lake()
    lake.publish(T, table(spark, (1, "a", 0, JAN), (2, "b", 0, FEB)), "m")
    hinted, hint = [], type(lake.read(T)).hint
    monkeypatch.setattr(type(lake.read(T)), "hint", lambda df, *a: hinted.append(a) or hint(df, *a))
    lake.replace_partitions(T, table(spark, (4, "d", 0, FEB), (3, "c", 0, FEB)), "m", [FEB], sort_by="k")
    assert len(hinted) == 1
    assert rows(lake.read(T), "k", "v") == [(1, "a"), (3, "c"), (4, "d")]


def test_gold_by_groups_of_months_equals_gold_at_once(spark, new_lake):
    lake = new_lake()
    shop.build(lake)
    at_once = full_state(lake)
    runs.run_gold(lake, months_per_pass=1)
    assert full_state(lake) == at_once


# ---- replacing partitions ---------------------------------------------------------------


def test_replace_partitions_leaves_the_others_alone(spark, new_lake):
    lake = new_lake()
    lake.publish(T, table(spark, (1, "a", 0, JAN), (2, "b", 0, FEB), (3, "c", 0, None)), "m")
    january = lake.read(T).where(F.col("m") == F.lit(JAN)).withColumn("v", F.lit("new"))
    lake.replace_partitions(T, january, "m", [JAN, None])
    assert rows(lake.read(T), "k", "v", "m") == [(1, "new", JAN), (2, "b", FEB)]


class Lost(Exception):
    """The driver is gone."""


@pytest.mark.parametrize("lost_in", ["before the first table", "between the tables", "while partitions are swapped"])
def test_interrupted_swap_is_finished_before_the_next_change(spark, new_lake, monkeypatch, lost_in):
    lake, other = new_lake(), "silver_other"
    for name in (T, other):
        lake.publish(name, table(spark, (1, "a", 0, JAN), (2, "b", 0, FEB), (3, "c", 0, MAR)), "m")
    plain, calls = type(lake)._overwrite, []

    def lost(self, step):
        calls.append(step)
        if lost_in == "between the tables" and len(calls) == 1:
            plain(self, step)
            return
        if lost_in == "while partitions are swapped":  # Spark deletes a partition before it moves the new one
            for folder in step["values"]:
                self._delete(f"{step['path']}/{folder}")
            self.put_text(f"{step['path']}/.spark-staging-x/m=2024-01-01/part-0", "half")
        raise Lost

    changes = {
        name: lake_module.Replacement(table(spark, (9, "z", 0, JAN)), "m", [JAN, FEB]) for name in (T, other)
    }
    with monkeypatch.context() as m:
        m.setattr(type(lake), "_overwrite", lost)
        with pytest.raises(Lost):
            lake.replace(changes)
    lake.recover(T)
    for name in (T, other):
        assert rows(lake.read(name), "k", "v", "m") == [(3, "c", MAR), (9, "z", JAN)]
    assert lake.notes("replace") == {}
    fs, left = filesystem(spark, f"{lake.current_path(T)}/.spark-staging-*")
    assert not list(fs.globStatus(left) or []) and not list(fs.globStatus(lake_path(spark, lake.kept_path("*"))) or [])


def lake_path(spark, path):
    return filesystem(spark, path)[1]


@pytest.mark.parametrize("moved", [0, 1, 2])
def test_swap_moves_the_files_it_wrote_also_after_a_loss_between_two(spark, new_lake, monkeypatch, moved):
    lake = new_lake()
    lake.publish(T, table(spark, (1, "a", 0, JAN), (2, "b", 0, FEB), (3, "c", 0, None)), "m")
    written, plain = [], lake_module.write_parquet
    monkeypatch.setattr(lake_module, "write_parquet", lambda *a, **k: written.append(a) or plain(*a, **k))
    make, calls = type(lake)._make_content, []

    def lost(self, folder, source, files):
        make(self, folder, source, files)
        calls.append(folder)
        if len(calls) > moved:
            raise Lost

    with monkeypatch.context() as m:
        m.setattr(type(lake), "_make_content", lost)
        with pytest.raises(Lost):
            lake.replace_partitions(T, table(spark, (8, "y", 0, JAN), (9, "z", 0, FEB), (7, "x", 0, None)), "m", [JAN, FEB, None])
    lake.recover(T)
    assert rows(lake.read(T), "k", "m") == [(7, None), (8, JAN), (9, FEB)]
    assert len(written) == 1  # nothing is read and written again to be swapped in
    assert lake.notes("replace") == {}


def test_change_that_was_noted_without_its_files_is_finished(spark, new_lake, monkeypatch):
    lake = new_lake()
    lake.publish(T, table(spark, (1, "a", 0, JAN), (2, "b", 0, FEB)), "m")
    with monkeypatch.context() as m:
        m.setattr(type(lake), "_overwrite", lambda *_: (_ for _ in ()).throw(Lost()))
        with pytest.raises(Lost):
            lake.replace_partitions(T, table(spark, (9, "z", 0, JAN)), "m", [JAN, FEB])
    (note, steps), = lake.notes("replace").items()
    older = [{k: v for k, v in step.items() if k != "files"} for step in steps]
    lake.put_text(f"{lake.root.rstrip('/')}/_notes/{note}", lake_module.json.dumps(older))
    lake.recover(T)
    assert rows(lake.read(T), "k", "m") == [(9, JAN)]


def test_upsert_writes_a_stored_source_once(spark, new_lake, monkeypatch):
    lake, labels, plain = new_lake(), [], lake_module.Scratch.stage
    monkeypatch.setattr(lake_module.Scratch, "stage", lambda self, df, label: labels.append(label) or plain(self, df, label))
    shop.land(lake)
    for name in ("silver_customers", "silver_products", "silver_orders", "silver_order_items"):
        for _ in range(2):
            runs.absorb(lake, name, lake.read(runs.BRONZE_OF[name]))
    assert "silver_order_items-good" in labels
    assert not [label for label in labels if label.endswith(("-first", "-source"))]


def test_change_that_cannot_be_computed_changes_nothing(spark, new_lake):
    lake, other = new_lake(), "silver_other"
    for name in (T, other):
        lake.publish(name, table(spark, (1, "a", 0, JAN)), "m")
    good, bad = table(spark, (9, "z", 0, JAN)), table(spark, (9, "z", 0, JAN)).withColumn("v", F.expr("raise_error('no')"))
    with pytest.raises(Exception):
        lake.replace({T: lake_module.Replacement(good, "m", [JAN]), other: lake_module.Replacement(bad, "m", [JAN])})
    lake.recover(T, other)
    assert rows(lake.read(T), "k") == rows(lake.read(other), "k") == [(1,)]


def test_rebuild_makes_up_for_a_lost_swap(spark, new_lake, monkeypatch):
    lake = new_lake()
    lake.publish(T, table(spark, (1, "a", 0, JAN)), "m")
    with monkeypatch.context() as m:
        m.setattr(type(lake), "_overwrite", lambda *_: (_ for _ in ()).throw(Lost()))
        with pytest.raises(Lost):
            lake.replace_partitions(T, table(spark, (9, "z", 0, JAN)), "m", [JAN])
    lake.publish(T, table(spark, (5, "new", 0, JAN)), "m")
    lake.recover(T)
    assert rows(lake.read(T), "k") == [(5,)] and lake.notes("replace") == {}


# ---- catalog ----------------------------------------------------------------------------


@pytest.fixture
def shown_lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "shown"), LakeNames("shown_bronze", "shown_silver", "shown_gold"), keep_for=dt.timedelta(0))


def test_catalog_follows_every_change(spark, shown_lake):
    lake = shown_lake

    def check():
        assert rows(spark.table(f"shown_silver.{T}"), "k", "m") == rows(lake.read(T), "k", "m")

    lake.publish(T, table(spark, (1, "a", 0, JAN)).where("k > 1"), "m")
    check()
    lake.replace_partitions(T, table(spark, (1, "a", 0, JAN), (2, "b", 0, None)), "m", [JAN, None])
    check()
    lake.replace_partitions(T, table(spark, (3, "c", 0, FEB)), "m", [JAN, FEB])
    check()
    lake.replace_partitions(T, table(spark, (3, "d", 0, FEB)), "m", [FEB, None])
    check()
    assert spark.table(f"shown_silver.{T}").first().v == "d"
    lake.publish(T, lake.read(T).withColumn("w", F.lit(1)), "m")
    check()
    assert spark.table(f"shown_silver.{T}").columns == lake.read(T).columns
    stored = [t.name for t in spark.catalog.listTables("shown_silver") if t.name.startswith(f"{T}__")]
    assert len(stored) == 1  # the replaced version is gone from the catalog as well


def test_catalog_prunes_months_without_listing_the_others(spark, shown_lake):
    shown_lake.publish(T, table(spark, (1, "a", 0, JAN), (2, "b", 0, FEB)), "m")
    files = spark.table(f"shown_silver.{T}").where("m = DATE'2024-02-01'").inputFiles()
    assert files and all("m=2024-02-01" in f for f in files)


def test_append_costs_the_same_however_many_batches_there_are(spark, shown_lake, monkeypatch):
    """Neither jobs nor files that are opened or listed grow with the number of batches."""
    lake, name = shown_lake, "bronze_products"
    some = landing.from_rows(spark, name, ["product_id"], [("1",)]).coalesce(1)
    tracker, jobs, listed = spark.sparkContext.statusTracker(), [], []
    plain = type(lake)._folders
    monkeypatch.setattr(type(lake), "_folders", lambda self, path: listed.append(path) or plain(self, path))
    for n in range(25):
        spark.sparkContext.setJobGroup(f"append-{n}", "append")
        listed.clear()
        landing.load(lake, name, some if n != 20 else some.withColumn("colour", F.lit("red")), batch=str(n))
        jobs.append((len(tracker.getJobIdsForGroup(f"append-{n}")), len(listed)))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(set(jobs[2:])) == 1 and jobs[-1][1] == 0
    shown = spark.table(f"shown_bronze.{name}")
    assert shown.count() == 25 and shown.where("colour = 'red'").count() == 1
    # Another session would find all that was written.
    spark.sql(f"DROP VIEW shown_bronze.{name}")
    for t in spark.catalog.listTables("shown_bronze"):
        spark.sql(f"DROP TABLE shown_bronze.{t.name}")
    lake.show_in_catalog(name)
    assert spark.table(f"shown_bronze.{name}").count() == 25


# ---- upsert -----------------------------------------------------------------------------


@pytest.mark.parametrize("partition", [None, "m"])
def test_upsert_updates_inserts_and_keeps(spark, new_lake, partition):
    lake = new_lake()
    upsert(lake, T, table(spark, (1, "a", 1, JAN), (2, "b", 1, FEB)), ["k"], partition)
    batch = table(spark, (2, "B", 0, FEB), (3, "c", 1, MAR))
    upsert(lake, T, batch, ["k"], partition)
    expected = [(1, "a"), (2, "B"), (3, "c")]
    assert rows(lake.read(T), "k", "v") == expected
    upsert(lake, T, batch, ["k"], partition)
    assert rows(lake.read(T), "k", "v") == expected


@pytest.mark.parametrize("partition", [None, "m"])
def test_newest_version_wins_in_any_order(spark, new_lake, partition):
    versions = [table(spark, (1, f"v{n}", n, JAN), (n + 10, "x", n, FEB)) for n in (1, 2, 3)]
    results = []
    for order in ([0, 1, 2], [2, 0, 1], [1, 2, 1]):
        lake = new_lake("order-" + "-".join(map(str, order)))
        for n in order:
            upsert(lake, T, versions[n], ["k"], partition, newest="ts")
        results.append(rows(lake.read(T), "k", "v", "ts")[0])
    assert set(results) == {(1, "v3", 3)}


def test_upsert_touches_only_months_with_changes(spark, new_lake):
    lake = new_lake()
    lake.publish(T, table(spark, (1, "a", 1, JAN), (2, "b", 1, FEB), (3, "c", 1, MAR)), "m")
    done = upsert(lake, T, table(spark, (2, "B", 2, FEB)), ["k"], "m", newest="ts")
    assert done.touched == [FEB]
    stale = upsert(lake, T, table(spark, (3, "old", 0, MAR)), ["k"], "m", newest="ts")
    assert stale.touched == []
    assert rows(lake.read(T), "k", "v") == [(1, "a"), (2, "B"), (3, "c")]


def test_row_that_changes_month_leaves_its_old_one(spark, new_lake):
    lake = new_lake()
    lake.publish(T, table(spark, (1, "a", 1, JAN), (2, "b", 1, FEB)), "m")
    done = upsert(lake, T, table(spark, (1, "a", 2, MAR)), ["k"], "m", newest="ts")
    assert done.touched == [JAN, MAR] and done.moved is None
    assert rows(lake.read(T), "k", "m") == [(1, MAR), (2, FEB)]


def test_moved_rows_are_told_before_the_swap(spark, new_lake):
    lake, told = new_lake(), []
    lake.publish(T, table(spark, (1, "a", 1, JAN), (2, "b", 1, FEB)), "m")

    def tell(change):
        told.append((change.touched, rows(lake.read(T), "k", "m")))
        told.append(rows(spark.read.parquet(lake.kept_path(change.moved)), "k", "_old_m", "m"))

    upsert(lake, T, table(spark, (1, "a", 2, MAR)), ["k"], "m", "ts", before_swap=tell, keep_moved=True)
    assert told == [([JAN, MAR], [(1, JAN), (2, FEB)]), [(1, JAN, MAR)]]


def test_losing_version_of_equal_time_moves_nothing(spark, new_lake):
    lake, told = new_lake(), []
    lake.publish(T, table(spark, (1, "b", 5, FEB)), "m")
    done = upsert(lake, T, table(spark, (1, "a", 5, JAN)), ["k"], "m", "ts", before_swap=told.append)
    assert done.touched == [] and told == []
    assert rows(lake.read(T), "k", "v", "m") == [(1, "b", FEB)]


def test_null_in_a_required_column_fails_the_write(spark, new_lake):
    lake = new_lake()
    bad = spark.sql("SELECT CAST(NULL AS BIGINT) AS order_id, 1L AS customer_id")
    with pytest.raises(Exception, match="must not be NULL"):
        lake.publish("silver_orders", bad)
    assert not lake.exists("silver_orders")


def test_a_load_that_is_rejected_as_a_whole_can_be_shown(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "rejected"), LakeNames("rej_bronze", "rej_silver", "rej_gold"))
    shop.land(lake)
    nothing = lake.read("bronze_order_items").withColumn("line_status", F.lit("LOST"))
    landing.load(lake, "bronze_order_items", nothing, replace=True)
    runs.run_silver(lake)
    assert spark.table("rej_silver.silver_order_items").count() == 0
    assert dict(spark.table("rej_silver.silver_order_items").dtypes)["order_id"] == "bigint"
    assert runs.quarantine(lake, "silver_order_items").count() > 0
    runs.run_gold(lake)
    assert spark.table("rej_gold.gold_vw_order_status").count() == 0


def test_merge_statement_needs_a_format_that_has_it(spark, built):
    spark.sql("CREATE TABLE IF NOT EXISTS plain_parquet (k INT, v STRING) USING parquet")
    with pytest.raises(Exception, match="(?i)merge"):
        merge_into_table(spark.sql("SELECT 1 AS k, 'a' AS v"), "plain_parquet", ["k"])


# ---- landing ----------------------------------------------------------------------------


def test_landing_fills_missing_columns_and_keeps_further_ones(spark):
    wide = spark.sql("SELECT 1 AS order_id, 'WEB' AS order_channel, '2024-01-01 00:00:00' AS order_date, array(1) AS more")
    landed = landing.to_bronze(wide, "bronze_orders")
    known = ["order_id", "customer_id", "order_date", "shipping_address", "_ingest_ts"]
    assert landed.columns == [*known, "order_channel", "more"]
    row = landed.first()
    assert (row.order_channel, row.more) == ("WEB", "[1]")
    assert (row.order_id, row.customer_id) == ("1", None)
    assert row._ingest_ts is not None


def test_literal_rows_append_and_replace(spark, new_lake):
    lake = new_lake()
    some = landing.from_rows(spark, "bronze_products", ["product_id", "sku"], [("1", "a"), ("2", "b")])
    landing.load(lake, "bronze_products", some)
    landing.load(lake, "bronze_products", some)
    assert lake.read("bronze_products").count() == 4
    landing.load(lake, "bronze_products", some, replace=True)
    assert rows(lake.read("bronze_products"), "product_id", "sku", "category") == [("1", "a", None), ("2", "b", None)]


def test_csv_keeps_text_as_sent(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "a.csv").write_text(
        "order_id,customer_id,order_date,shipping_address\n007, 1 ,2024-01-01 00:00:00,\"Main St, 1\"\n8,,x,\n"
    )
    got = landing.from_csv(spark, "bronze_orders", str(folder)).drop("_ingest_ts")
    assert rows(got.drop("_corrupt_record")) == [("007", " 1 ", "2024-01-01 00:00:00", "Main St, 1"), ("8", None, "x", None)]
    assert set(dict(got.dtypes).values()) == {"string"}


def test_csv_quotes_wide_headers_and_rows_that_do_not_fit(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "a.csv").write_text(
        'shipping_address,order_id,order_channel,customer_id,order_date\n'
        '"Flat ""B"", Main St",1,WEB,2,d\n"two\nlines",2,"",,d\nx,3,WEB,2,d,more\ny,4\n'
    )
    got = landing.from_csv(spark, "bronze_orders", str(folder), multi_line=True)
    found = {r.order_id: r for r in got.collect()}
    assert found["1"].shipping_address == 'Flat "B", Main St' and found["1"].order_channel == "WEB"
    assert found["2"].shipping_address == "two\nlines" and found["2"].order_channel == ""
    assert found["2"].customer_id is None
    broken = {k for k, r in found.items() if r._corrupt_record is not None}
    assert broken == {"3", "4"}
    tagged = silver.tagged_orders(got, spark.sql("SELECT 2L AS customer_id"))
    reasons = {r.order_id: r.reject_reason for r in tagged.collect()}
    assert reasons == {"1": None, "2": "orphan_customer", "3": "broken_row", "4": "broken_row"}


def test_batches_replace_themselves_and_may_bring_columns(spark, new_lake):
    lake, name = new_lake(), "bronze_products"
    some = landing.from_rows(spark, name, ["product_id"], [("1",), ("2",)])
    landing.load(lake, name, some, batch="a")
    landing.load(lake, name, some, batch="a")
    landing.load(lake, name, some.withColumn("colour", F.lit("red")), batch="b")
    found = rows(lake.read(name), "product_id", "colour")
    assert sorted(found, key=str) == [("1", "red"), ("1", None), ("2", "red"), ("2", None)]
    landing.load(lake, "bronze_shipments", landing.from_rows(spark, "bronze_shipments", ["carrier"], [("UPS",)]))
    assert lake.read("bronze_shipments").first().carrier == "UPS"


# ---- Silver upserts ---------------------------------------------------------------------


def item(n, order_id, status, ingested, product="1"):
    return (str(n), str(order_id), product, "1", "10.00", status, shop.T0, ingested)


def test_silver_by_upsert_equals_rebuild(spark, new_lake):
    whole, stepwise = new_lake("whole"), new_lake("stepwise")
    shop.land(whole)
    runs.run_silver(whole)
    shop.land(stepwise)
    runs.run_silver(stepwise, rebuild=False)
    runs.run_silver(stepwise, rebuild=False, since=dt.datetime(2024, 6, 1, 0, 30))
    for t in runs.BRONZE_OF:
        for suffix in ("", "_rejected"):
            one, two = (runs.quarantine(x, t) if suffix else x.read(t) for x in (whole, stepwise))
            assert rows(one) == rows(two, *one.columns), t + suffix


def test_line_that_lands_before_its_order_is_tried_again(spark, new_lake):
    lake = new_lake()
    shop.build(lake)
    early = shop.bronze(spark, "bronze_order_items", [item(700, 70, "DELIVERED", shop.T1)])
    assert runs.absorb(lake, "silver_order_items", early) == []
    waiting = runs.quarantine(lake, "silver_order_items").where("order_id = '70'")
    assert rows(waiting, "reject_reason") == [("orphan_order",)]
    before = lake.read("silver_order_items_rejected").count()
    order = shop.bronze(spark, "bronze_orders", [("70", "1", "2024-05-05 00:00:00", "x", shop.T1)])
    assert runs.absorb(lake, "silver_orders", order) == [dt.date(2024, 5, 1)]
    assert lake.read("silver_order_items").where("order_item_id = 700").count() == 1
    assert runs.quarantine(lake, "silver_order_items").where("order_id = '70'").isEmpty()
    assert lake.read("silver_order_items_rejected").count() == before


def test_line_waits_for_an_order_that_waits_for_its_customer(spark, new_lake):
    lake = new_lake()
    shop.build(lake)
    line = shop.bronze(spark, "bronze_order_items", [item(800, 80, "DELIVERED", shop.T1)])
    order = shop.bronze(spark, "bronze_orders", [("80", "90", "2024-05-05 00:00:00", "x", shop.T1)])
    runs.absorb(lake, "silver_order_items", line)
    runs.absorb(lake, "silver_orders", order)
    customer = ("90", "Late", "Comer", "late@shop.test", None, None, shop.T1)
    runs.absorb(lake, "silver_customers", shop.bronze(spark, "bronze_customers", [customer]))
    assert lake.read("silver_order_items").where("order_item_id = 800").count() == 1


def full_state(lake):
    tables = [runs.FACT, runs.DAILY, runs.WEEKLY, runs.MONTHLY, runs.DIM_PRODUCT, runs.DIM_CUSTOMER]
    return {t: rows(lake.read(t).drop("_refreshed_at")) for t in tables}


def test_refreshed_gold_equals_rebuilt_gold(spark, new_lake):
    """A changed line, a new one, an order moved to another month, a renamed product."""
    lake = new_lake()
    shop.build(lake)
    months = set()
    product = ("1", "lamp-a", "Floor lamp", "Light", "10.00", None, shop.T1)
    changes = {
        "silver_products": [product],
        "silver_orders": [("14", "1", "2024-01-31 00:00:00", "x", shop.T1), ("71", "1", "2024-04-29 00:00:00", "x", shop.T1)],
        "silver_order_items": [item(101, 10, "RETURNED", shop.T2), item(711, 71, "DELIVERED", shop.T1, "3")],
    }
    for t, values in changes.items():
        landed = shop.bronze(spark, runs.BRONZE_OF[t], values)
        months |= set(runs.absorb(lake, t, landed))
    assert {JAN, FEB, MAR, dt.date(2024, 4, 1)} <= months
    runs.refresh_gold(lake, sorted(months))
    refreshed = full_state(lake)
    runs.run_gold(lake)
    assert refreshed == full_state(lake)
    moved = lake.read("silver_order_items").where("order_id = 14")
    assert rows(moved, "order_month") == [(JAN,), (JAN,)]


def test_catalog_name_is_taken_into_account(spark, new_lake):
    lake = new_lake(names=LakeNames(catalog="no_such_catalog"), in_catalog=True)
    with pytest.raises((AnalysisException, Exception), match="no_such_catalog"):
        lake.create_schema("gold_x")


def test_equal_times_are_decided_the_same_in_any_order(spark, new_lake):
    a, b = table(spark, (1, "a", 5, JAN)), table(spark, (1, "b", 5, FEB))
    results = []
    for name, order in (("ab", (a, b)), ("ba", (b, a))):
        lake = new_lake(name)
        for batch in order:
            upsert(lake, T, batch, ["k"], "m", newest="ts")
        results.append(rows(lake.read(T), "k", "v", "m"))
    assert results[0] == results[1] == [(1, "b", FEB)]


def test_scratch_tables_are_removed(spark, new_lake):
    lake = new_lake()
    fs, folder = filesystem(spark, work_dir(spark))

    def left():
        names = {s.getPath().getName() for s in fs.listStatus(folder)} if fs.exists(folder) else set()
        return names

    before = left()
    shop.land(lake)
    runs.run_silver(lake)
    runs.run_silver(lake, rebuild=False)
    moved = shop.bronze(spark, "bronze_orders", [("14", "1", "2024-01-31 00:00:00", "x", shop.T1)])
    runs.absorb(lake, "silver_orders", moved)
    assert left() == before
    # What is kept under the lake's root is what Gold has still to take in.
    fs, kept = filesystem(spark, lake.kept_path("*"))
    names = {s.getPath().getName() for s in fs.globStatus(kept) or []}
    assert names == {note["orders"] for note in lake.notes("months").values()} and names


def test_current_schema_can_be_set(spark, built):
    built.use_schema_of("gold_dim_product")
    try:
        assert spark.sql("SELECT * FROM gold_dim_product").count() == 3
    finally:
        spark.catalog.setCurrentDatabase("default")


@pytest.mark.parametrize("partition", [None, "m"])
def test_batch_without_news_writes_nothing(spark, new_lake, partition):
    lake = new_lake()
    lake.publish(T, table(spark, (1, "a", 5, JAN)), partition)
    before = sorted(lake.read(T).inputFiles())
    for batch in (table(spark, (1, "old", 1, JAN)), table(spark, (1, "x", 9, JAN)).where("k > 1")):
        assert upsert(lake, T, batch, ["k"], partition, newest="ts").touched == []
    assert sorted(lake.read(T).inputFiles()) == before
