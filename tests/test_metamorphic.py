"""Metamorphic properties: re-partitioning does not change results; P14 and
P15 split the input; ROC ends at (1, 1); hash samples are stable."""

from pyspark.sql import functions as F

from tests.conftest import SF001
from tidemark.operators.clean import keep_dense_rows, sparse_rows
from tidemark.plans.demographics import coded_population
from tidemark.plans.registry import queries
from tidemark.sources import testdata as td

Q = queries()


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_repartition_invariance(spark):
    from tidemark.operators.bins import user_time_bins
    ev = td.music_events(spark, SF001)
    a = user_time_bins(ev, 7, pages=td.MUSIC_PAGES)
    b = user_time_bins(ev.repartition(17, "event_id"), 7, pages=td.MUSIC_PAGES)
    assert _rows(a) == _rows(b)


def test_dense_sparse_partition(spark):
    pop = coded_population(spark, SF001)
    n = pop.count()
    assert keep_dense_rows(pop, 1).count() + sparse_rows(pop, 1).count() == n


def test_roc_ends_at_one(spark):
    r = Q["roc_points"](spark, SF001)
    last = r.orderBy(F.asc("score")).first()
    assert last.tpr == 1.0 and last.fpr == 1.0


def test_sample_is_stable(spark):
    a = Q["sample_exact"](spark, SF001)
    b = Q["sample_exact"](spark, SF001)
    assert _rows(a) == _rows(b) and a.count() == 1000


def test_approximate_variants_close_to_exact(spark):
    """The sketch-based variants meant for very large inputs stay close to
    the exact answers."""
    from tidemark.operators.bins import user_time_bins
    from tidemark.operators.profile import column_profile, describe, describe_by
    li = td.table(spark, SF001, "lineitem")
    ex = {r.column_name: r for r in describe(li, ["l_quantity", "l_extendedprice"]).collect()}
    ap = {r.column_name: r for r in describe(li, ["l_quantity", "l_extendedprice"], exact=False).collect()}
    for c in ex:
        assert ex[c]["count"] == ap[c]["count"] and abs(ex[c].mean - ap[c].mean) < 1e-6
        assert abs(ex[c].p50 - ap[c].p50) <= 0.01 * (ex[c].max - ex[c].min)
    assert describe_by(li, "l_returnflag", ["l_quantity"], exact=False).count() == 3
    prof = {r.column_name: r.n_unique for r in column_profile(li.select("l_returnflag", "l_linestatus"),
                                                              None, approx=True).collect()}
    assert prof == {"l_returnflag": 3, "l_linestatus": 2}
    ev = td.music_events(spark, SF001)
    a = {(r.UserId, r.UserTimeBin): r.SessionsInTimeBin for r in
         user_time_bins(ev, 7, pages=td.MUSIC_PAGES, approx_distinct=True).collect()}
    e = {(r.UserId, r.UserTimeBin): r.SessionsInTimeBin for r in
         user_time_bins(ev, 7, pages=td.MUSIC_PAGES).collect()}
    assert a.keys() == e.keys()
    assert all(abs(a[k] - e[k]) <= max(2, 0.1 * e[k]) for k in e)


def test_any_earlier_is_monotone_in_bin(spark):
    from pyspark.sql import Window
    df = Q["churn_user_bins"](spark, SF001)
    w = Window.partitionBy("UserId").orderBy("UserTimeBin")
    drops = df.withColumn("prev", F.lag("PreviouslyDowngraded").over(w)).filter(
        F.col("prev") > F.col("PreviouslyDowngraded")).count()
    assert drops == 0
    # and it is 1 exactly after the first bin with a downgrade
    first = df.filter("DowngradedInTimeBin = 1").groupBy("UserId").agg(F.min("UserTimeBin").alias("b0"))
    j = df.join(first, "UserId", "left")
    bad = j.filter(F.when(F.col("b0").isNotNull() & (F.col("UserTimeBin") > F.col("b0")), 1).otherwise(0)
                   != F.col("PreviouslyDowngraded")).count()
    assert bad == 0


def test_exact_quantiles_many_groups(spark):
    """The same medians and quartiles as ``percentile``, per group and column."""
    from tidemark.operators.quantiles import exact_quantiles
    li = td.table(spark, SF001, "lineitem").withColumn("g", F.col("l_suppkey") % 40)
    rows = exact_quantiles(li, ["l_extendedprice", "l_quantity"], [0.25, 0.5], group=["g"]).collect()
    got = {}
    for r in rows:
        got.setdefault(((r.g,), r.column_name), {})[r.prob] = r.value
    exp = li.groupBy("g").agg(F.percentile("l_extendedprice", F.array(F.lit(0.25), F.lit(0.5))).alias("p"),
                              F.percentile("l_quantity", F.array(F.lit(0.25), F.lit(0.5))).alias("q")).collect()
    for r in exp:
        for col, key in (("l_extendedprice", "p"), ("l_quantity", "q")):
            v = got[((r.g,), col)]
            assert abs(v[0.25] - r[key][0]) <= 1e-9 * max(1.0, abs(r[key][0]))
            assert abs(v[0.5] - r[key][1]) <= 1e-9 * max(1.0, abs(r[key][1]))
