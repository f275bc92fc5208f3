import pytest

from orderloom import Lake, LakeNames
from orderloom.jobs import gold_job, silver_job
from orderloom.plans import runs
from tests import shop
from tests.shop import rows

NAMES = LakeNames(bronze="job_bronze", silver="job_silver", gold="job_gold", catalog="spark_catalog")
ARGS = ["--catalog", "spark_catalog", "--silver-schema", "job_silver"]


def test_both_jobs_twice(spark, tmp_path):
    root = str(tmp_path / "lake")
    lake = Lake(spark, root, NAMES)
    shop.land(lake)
    states = []
    for extra in ([], ["--upsert"]):
        silver_job.main(["--root", root, "--bronze-schema", "job_bronze", *ARGS, *extra])
        gold_job.main(["--root", root, "--gold-schema", "job_gold", "--with-dim-order", *ARGS])
        states.append([rows(lake.read(t).drop("_refreshed_at")) for t in (runs.FACT, runs.MONTHLY, runs.DIM_ORDER)])
    assert states[0] == states[1]
    assert spark.table("job_gold.gold_product_monthly_sales").count() == lake.read(runs.MONTHLY).count()
    assert spark.sql("SELECT * FROM job_gold.gold_vw_order_status").count() == len(shop.STATUS)


def test_root_is_required():
    with pytest.raises(SystemExit):
        silver_job.main([])
