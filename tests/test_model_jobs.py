"""Jobs of the model queries: inputs joined once, tasks in proportion to the rows."""
from tidemark.operators import model as ML
from tidemark.plans.q_models import census_dataset
from tests.conftest import SF0001
from tests.test_plans import plan


def test_models_read_the_joined_census_and_do_not_join_it_again(spark):
    ds, feats = census_dataset(spark, SF0001)
    p = plan(ds.where("split = 'train'"))
    assert "Join" not in p and "Exchange" not in p and "parquet" in p.lower()
    assert ds.count() == spark.read.parquet(f"{SF0001}/orders.parquet").count() and len(ds.first()["features"]) == len(feats)


def test_tasks_of_a_search_grow_with_the_rows(spark):
    df = spark.range(0, 1000, 1, 16)
    assert [ML.in_tasks(df, n).rdd.getNumPartitions() for n in (10_000, 1000, 300, 10)] == [1, 1, 4, 16]
    assert ML.in_tasks(df, 300).count() == 1000 and ML.in_tasks(df.limit(0)).rdd.getNumPartitions() == 1
