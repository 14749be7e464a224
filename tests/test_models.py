"""Model sanity: fixed seeds, beats the naive predictor, save -> load gives
the same predictions."""

from tests.conftest import SF0001, SF001
from tidemark.plans.registry import queries

Q = queries()


def test_classifiers_beat_naive(spark):
    r = {x.model: x for x in Q["census_classifiers"](spark, SF001).collect()}
    assert r["lr"].accuracy >= r["naive"].accuracy


def test_roundtrip_same_predictions(spark):
    r = Q["model_roundtrip"](spark, SF001).first()
    assert r["n_scored"] > 0 and r["n_different"] == 0


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_sweeps_have_the_reference_k(spark):
    wanted = {"segments_kmeans_sweep": [*range(2, 16), *range(16, 29, 2)], "process_kmeans_sweep": [*range(2, 15)]}
    for name, ks in wanted.items():
        rows = Q[name](spark, SF0001).collect()
        assert [r.k for r in rows] == ks and all(r.cost >= 0 and r.score == -r.cost for r in rows)
        assert rows[-1].cost < rows[0].cost
