from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orderloom.operators.dedupe import collapse_exact, latest_by_key
from orderloom.operators.integrity import duplicate_values, keep_referenced, mark_referenced, orphans
from orderloom.operators.numbering import number_rows
from orderloom.operators.ranking import best_sellers
from orderloom.operators.upsert import merged_rows
from tests.shop import rows


def test_collapse_keeps_versions_and_newest_time(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (1,'a',1),(1,'a',3),(1,'b',2),(2,CAST(NULL AS STRING),1),(2,NULL,5) t(k,v,ts)"
    )
    assert rows(collapse_exact(df, "ts"), "k", "v", "ts") == [(1, "a", 3), (1, "b", 2), (2, None, 5)]


def test_latest_by_key_breaks_ties_by_value(spark):
    df = spark.sql("SELECT * FROM VALUES (1,'a',2),(1,'c',2),(1,'z',1),(2,'x',CAST(NULL AS INT)) t(k,v,ts)")
    assert rows(latest_by_key(df, ["k"], "ts"), "k", "v", "ts") == [(1, "c", 2), (2, "x", None)]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 3), st.sampled_from("ab") | st.none(), st.integers(0, 3)), min_size=1))
def test_latest_needs_no_collapse_before_it(spark, data):
    df = spark.createDataFrame(data, "k int, v string, ts int")
    direct = latest_by_key(df, ["k"], "ts")
    after_collapse = latest_by_key(collapse_exact(df, "ts").select("k", "v", "ts"), ["k"], "ts")
    assert rows(direct) == rows(after_collapse)
    newest = {}
    for k, v, ts in data:
        newest[k] = max(newest.get(k, (-1, (False, ""))), (ts, (v is not None, v or "")))
    assert rows(direct, "k", "ts") == sorted((k, n[0]) for k, n in newest.items())


def test_foreign_keys(spark):
    child = spark.sql("SELECT * FROM VALUES (1,'a'),(2,'b'),(CAST(NULL AS INT),'c') t(k,v)")
    parent = spark.sql("SELECT * FROM VALUES (1,'p'),(9,'q') t(k,name)")
    assert rows(keep_referenced(child, parent, "k"), "v") == [("a",)]
    assert rows(orphans(child, parent, "k"), "v") == [("b",), ("c",)]
    marked = mark_referenced(child, parent, "k", "found", "name")
    assert rows(marked, "v", "found", "name") == [("a", True, "p"), ("b", None, None), ("c", None, None)]


def test_semi_join_does_not_multiply_rows(spark):
    child = spark.sql("SELECT 1 AS k")
    parent = spark.sql("SELECT 1 AS k UNION ALL SELECT 1")
    assert keep_referenced(child, parent, "k").count() == 1


def test_duplicate_values(spark):
    df = spark.sql("SELECT * FROM VALUES ('a'),('a'),('b'),(NULL),(NULL) t(email)")
    assert rows(duplicate_values(df, "email")) == [("a", 2)]


def test_ranking_ends_with_sku(spark):
    df = spark.sql("SELECT * FROM VALUES ('b',5,1),('a',5,1),('c',5,2),('d',4,9) t(sku,units,revenue)")
    assert [r.sku for r in best_sellers(df, "units", "revenue").collect()] == ["c", "a", "b", "d"]
    assert [r.sku for r in best_sellers(df, "revenue", "units", 2).collect()] == ["d", "c"]


def test_merged_rows(spark):
    target = spark.sql("SELECT * FROM VALUES (1,'old'),(2,'kept') t(k,v)")
    source = spark.sql("SELECT * FROM VALUES ('new',1),('added',3) t(v,k)")
    assert rows(merged_rows(target, source, ["k"]), "k", "v") == [(1, "new"), (2, "kept"), (3, "added")]


def test_numbers_follow_the_order_even_if_one_key_holds_most_rows(spark):
    hot = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("k"),
        F.expr("id * 7919 % 3000").alias("v"),
    )
    numbered = number_rows(hot.repartition(6), ["k", "v"], "n").collect()
    expected = sorted((r.k, r.v) for r in hot.collect())
    assert [(r.k, r.v) for r in sorted(numbered, key=lambda r: r.n)] == expected
    assert sorted(r.n for r in numbered) == list(range(1, 3001))
