"""Classifiers in a session whose rows have been observed."""
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tidemark.operators import model as ML
from tidemark.operators.lookup import observe_unmapped
from tidemark.session import scratch_table_path
from tidemark.sources.files import load_model, save_model


@pytest.mark.parametrize("kind, kw", [("lr", {"maxIter": 3}), ("rf", {"numTrees": 2, "maxDepth": 2}), ("svc", {"maxIter": 3}), ("gbt", {"maxIter": 2})])
def test_models_work_in_a_session_that_observed_rows(spark, kind, kw):
    """A lookup that counts its unmapped codes comes first: fits, searches and saved models go on."""
    observe_unmapped(spark.range(3).withColumn("v", F.lit(None)), Observation(), {"x": ("id", "v")}).collect()
    df = spark.range(60).select((F.col("id") % 2).cast("double").alias("label"), (F.col("id") % 3).alias("a"), (F.col("id") % 2 * 2).alias("b"))
    pipe = Pipeline(stages=[VectorAssembler(inputCols=["a", "b"], outputCol="features"), ML.make_classifier(kind, **kw)])
    model = pipe.fit(df)
    assert model.transform(df).where("prediction = label").count() == 60
    path = scratch_table_path(spark, f"models/observed-{kind}")
    save_model(model, path)
    assert load_model(path).transform(df).where("prediction = label").count() == 60
    found = ML.grid_search(ML.make_classifier(kind, **kw), {"seed": [1]} if kind in ("rf", "gbt") else {"regParam": [0.0, 0.1]},
                           ML.f_beta_evaluator(), train=pipe.getStages()[0].transform(df))
    assert found.bestModel.transform(pipe.getStages()[0].transform(df)).where("prediction = label").count() == 60
