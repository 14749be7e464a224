"""Model queries (rows-only checks: model fits are not SQL-expressible).

Each returns a DataFrame derived from the test tables: predictions, or a
small report table built from fitted parameters and metrics.
"""

from __future__ import annotations

import time
import uuid

from pyspark.ml.feature import CountVectorizer, IDF, Imputer, RegexTokenizer, SQLTransformer, VectorAssembler
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from tidemark.functions.text import TOKEN_PATTERN
from tidemark.operators import encode as E
from tidemark.operators import model as ML
from tidemark.operators.head import fit_head
from tidemark.operators.kernel import fourier_map
from tidemark.operators.metrics import binary_metrics, per_class_report
from tidemark.operators.profile import cluster_ratio, describe_by
from tidemark.operators.rank import topk_classes, top_n_per_group
from tidemark.operators.sample import first_n_by_hash, hash_split, stratified_sample
from tidemark.operators.sparse_forest import SparseForest
from tidemark.operators.text_model import chosen, label_messages, text_grid, text_pipeline, text_search
from tidemark.plans.demographics import clean_demographics
from tidemark.plans.q_churn import churn_features
from tidemark.plans.q_encode import expand_labels, prepare_census
from tidemark.plans.q_state import PROCESS_LEVELS, process_context
from tidemark.plans.q_sample import h_sql
from tidemark.plans.registry import oracle_of, register
from tidemark.session import scratch_table_path, written_table
from tidemark.sources import testdata as td
from tidemark.sources.files import load_model, save_model

# The labels and their sampling rates of negatives.
CHURN_LABELS = {"ChurnedInTimeBin": 0.065, "WillChurnInNextBin": 0.05, "WillChurnSoon": 0.12}


def churn_feature_cols():
    pages = [p for p in td.MUSIC_PAGES if p != td.CHURN_PAGE]
    return ["UserTimeBin", "Gender", "PaidInTimeBin", "FreeInTimeBin", "DowngradedInTimeBin",
            "UpgradedInTimeBin", "PreviouslyDowngraded", *pages, "SessionsInTimeBin",
            "ArtistsInTimeBin", "DistinctSongsInTimeBin"]


def churn_dataset(spark, sf_dir, label: str, fraction: float, seed: int = 147309, features=None):
    """Q4 fixed: split first (hash of user and bin), down-sample the train
    negatives only (M01), keep the test mix as it is. ``features``: the
    feature table, where a job has it already."""
    fe = churn_features(spark, sf_dir) if features is None else features
    ds = ML.vectorise(fe, churn_feature_cols()).withColumn("label", F.col(label).cast("double"))
    ds = ds.withColumn("_key", F.concat_ws(":", "UserId", F.col("UserTimeBin").cast("string")))
    ds = hash_split(ds, "_key", 0.2, seed)
    train = stratified_sample(ds.filter(F.col("split") == "train"), "label", {1.0: 1.0, 0.0: fraction}, "_key", seed)
    test = ds.filter(F.col("split") == "test")
    return train, test


@register("churn_models")
def q_churn_models(spark, sf_dir):
    """LR / RF / GBT searches (2 folds,
    4 fits in parallel, area under PR) for each of the three labels; the best
    model of each pair is saved below the shared folder; best parameters and
    test AUCs as a table."""
    ev = BinaryClassificationEvaluator(metricName="areaUnderPR", numBins=0)
    rows, run = [], uuid.uuid4().hex
    fe = written_table(churn_features(spark, sf_dir), "churn-features")
    for label, fraction in CHURN_LABELS.items():
        train, test = churn_dataset(spark, sf_dir, label, fraction, features=fe)
        train, test = train.persist(), test.persist()
        try:
            for kind in ["lr", "rf", "gbt"]:
                est = ML.make_classifier(kind)
                cv = ML.grid_search(est, ML.GRIDS[kind], ev, folds=2, parallelism=4, train=train)
                best = cv.bestModel
                save_model(best, scratch_table_path(spark, f"models/{run}/{label}.{kind}"))
                pred = best.transform(test)
                params = ";".join(f"{k}={best.getOrDefault(best.getParam(k))}" for k in ML.GRIDS[kind])
                rows.append((label, kind, params, float(ML.auc(pred, metric="areaUnderPR")),
                             float(ML.auc(pred, metric="areaUnderROC"))))
        finally:
            train.unpersist()
            test.unpersist()
    return spark.createDataFrame(rows, "label string, algorithm string, best_params string, "
                                       "test_auc_pr double, test_auc_roc double")


def census_dataset(spark, sf_dir):
    """The census rows, joined and written once for the fits of their scaling and levels; the vectors written
    once for the passes of the models."""
    c = written_table(td.census(spark, sf_dir), "census-rows")
    x = prepare_census(c, td.CENSUS_NUMERIC, td.CENSUS_SKEWED, td.CENSUS_CATEGORICAL)
    feats = [f for f in x.columns if f not in ("o_orderkey", "income")]
    ds = ML.vectorise(x, feats).withColumn("label", F.col("income").cast("double"))
    return written_table(hash_split(ds, "o_orderkey", 0.2, 0), "census"), feats


@register("census_classifiers")
def q_census_classifiers(spark, sf_dir):
    """L01, L02, L06 (linear SVM), L11 and E01: accuracy and F0.5 on test."""
    ds, _ = census_dataset(spark, sf_dir)
    train, test = ds.filter("split = 'train'").persist(), ds.filter("split = 'test'").persist()
    out = []
    for kind, kw in [("lr", {}), ("rf", {"numTrees": 20}), ("svc", {"maxIter": 20})]:
        m = ML.make_classifier(kind, **kw).fit(train)
        met = binary_metrics(m.transform(test), "label", "prediction", 0.5).first()
        out.append((kind, float(met["accuracy"]), float(met["f_beta"])))
    naive = binary_metrics(test.withColumn("p", F.lit(1.0)), "label", "p", 0.5).first()
    out.append(("naive", float(naive["accuracy"]), float(naive["f_beta"])))
    train.unpersist()
    test.unpersist()
    return spark.createDataFrame(out, "model string, accuracy double, f_beta double")


@register("census_kernel_svc")
def q_census_kernel_svc(spark, sf_dir):
    """Support vectors, linear and with a Gaussian kernel (random Fourier features): accuracy and F0.5 on test."""
    ds, feats = census_dataset(spark, sf_dir)
    train, test = ds.where("split = 'train'"), ds.where("split = 'test'")
    out = []
    kernel = fourier_map(len(feats), 256, gamma=0.5)
    for kind, svc in (("linear", ML.make_classifier("svc", maxIter=30)), ("gaussian", ML.make_classifier("kernel_svc", kernel=kernel, maxIter=30))):
        m = svc.fit(train)
        met = binary_metrics(m.transform(test), "label", "prediction", 0.5).first()
        out.append((kind, float(met["accuracy"]), float(met["f_beta"])))
    return spark.createDataFrame(out, "kernel string, accuracy double, f_beta double")


_MAP = fourier_map(64, 8, gamma=2.0, seed=3)
_COSINES = ", ".join(f"0.5 * cos(list_sum(list_transform(list_zip(embedding, {list(w)}), lambda z: cast(z[1] AS DOUBLE) * z[2])) + {b})"
                     for w, b in zip(_MAP.directions, _MAP.phases))


@register("kernel_features", f"""
WITH z AS (SELECT vec_id, [{_COSINES}] AS z FROM embeddings)
SELECT vec_id, CAST(i AS INTEGER) AS feature, round(z[i], 6) AS value FROM z, range(1, 9) r(i)
""")
def q_kernel_features(spark, sf_dir):
    """Random Fourier features of the embeddings, one row per vector and feature."""
    emb = td.table(spark, sf_dir, "embeddings")
    z = emb.select("vec_id", F.posexplode(_MAP.column(F.col("embedding").cast("array<double>"))).alias("i", "v"))
    return z.select("vec_id", (F.col("i") + 1).alias("feature"), F.round("v", 6).alias("value"))


@register("census_lr_coefficients")
def q_census_lr_coefficients(spark, sf_dir):
    """Intercept and coefficients of the logistic regression (+ its
    chosen parameters as extra rows)."""
    ds, feats = census_dataset(spark, sf_dir)
    m = ML.make_classifier("lr", maxIter=50, regParam=0.01).fit(ds.filter("split = 'train'"))
    params = ML.best_params(spark, m, ["regParam", "elasticNetParam", "maxIter"]).select(
        F.col("param").alias("term"), F.col("value").cast("double").alias("value"))
    return ML.linear_report(spark, m, feats).unionByName(params)


# The reference's search of the census forest (72 points).
CENSUS_FOREST = {"numTrees": [99, 100, 101], "maxDepth": [28, 29], "minSamplesSplit": [5, 6, 7], "minInstancesPerNode": [2, 3],
                 "minImpurityDecrease": [0.0, 1e-7]}


@register("census_tuned_forest")
def q_census_tuned_forest(spark, sf_dir):
    """L04 with the F-beta scorer actually passed to the search (Q10) + L05."""
    ds, _ = census_dataset(spark, sf_dir)
    train = ds.filter("split = 'train'")
    est = ML.make_classifier("grid_rf")
    cv = ML.grid_search(est, CENSUS_FOREST, ML.f_beta_evaluator("label", 0.5), folds=3, parallelism=4, train=train)
    return ML.best_params(spark, cv.bestModel, list(CENSUS_FOREST))


@register("feature_importance_top5")
def q_feature_importance_top5(spark, sf_dir):
    """L13 + T03: importances, top-5 features, refit on them, compare F0.5."""
    ds, feats = census_dataset(spark, sf_dir)
    train, test = ds.filter("split = 'train'"), ds.filter("split = 'test'")
    rf = ML.make_classifier("rf", numTrees=20).fit(train)
    imp = ML.importances(spark, rf, feats)
    top = [r["feature"] for r in imp.orderBy(F.desc("importance"), "feature").limit(5).collect()]
    idx = [feats.index(f) for f in top]
    tr5, te5 = ML.slice_features(train, idx), ML.slice_features(test, idx)
    rf5 = ML.make_classifier("rf", features="features_top", numTrees=20).fit(tr5)
    f_all = binary_metrics(rf.transform(test), "label", "prediction").first()["f_beta"]
    f_top = binary_metrics(rf5.transform(te5), "label", "prediction").first()["f_beta"]
    return (imp.filter(F.col("feature").isin(top))
            .withColumn("f_beta_all", F.lit(float(f_all))).withColumn("f_beta_top5", F.lit(float(f_top))))


@register("learning_curve")
def q_learning_curve(spark, sf_dir):
    """Three learners fitted on 1 / 10 / 100 % of train (same hash order), scored on
    test and on the first 300 train rows; fitting and prediction are timed."""
    ds, _ = census_dataset(spark, sf_dir)
    train, test = ds.filter("split = 'train'"), ds.filter("split = 'test'")
    n = train.count()
    first300 = written_table(first_n_by_hash(train, 300, "o_orderkey", 7), "first300")
    rows = []
    for share in [0.01, 0.1, 1.0]:
        sub = written_table(first_n_by_hash(train, max(1, int(n * share)), "o_orderkey", 7), "prefix")
        for kind, kw in [("lr", {}), ("rf", {"numTrees": 20}), ("svc", {"maxIter": 20})]:
            m, t_fit = ML.fit_timed(ML.make_classifier(kind, **kw), sub)
            t0 = time.time()
            mt = binary_metrics(m.transform(test), "label", "prediction").first()
            mtr = binary_metrics(m.transform(first300), "label", "prediction").first()
            rows.append((kind, share, float(t_fit), time.time() - t0, float(mt["accuracy"]), float(mt["f_beta"]),
                         float(mtr["accuracy"]), float(mtr["f_beta"])))
    return spark.createDataFrame(rows, "model string, share double, fit_seconds double, predict_seconds double, test_accuracy double, "
                                       "test_f_beta double, train_accuracy double, train_f_beta double")


@register("imbalance_experiment")
def q_imbalance_experiment(spark, sf_dir):
    """Random-forest AUC with and without negative down-sampling, per label."""
    rows = []
    ev = BinaryClassificationEvaluator(metricName="areaUnderROC", numBins=0)
    fe = written_table(churn_features(spark, sf_dir), "churn-features")
    for label, frac in CHURN_LABELS.items():
        for f in (1.0, frac):
            train, test = churn_dataset(spark, sf_dir, label, f, features=fe)
            train = train.persist()
            try:
                m = ML.make_classifier("rf", numTrees=10).fit(train)
                rows.append((label, f, float(ev.evaluate(m.transform(test)))))
            finally:
                train.unpersist()
    return spark.createDataFrame(rows, "label string, negative_fraction double, test_auc double")


#: Messages that a task of the message models works on.
MESSAGE_ROWS = 2_048


@register("message_classifier")
def q_message_classifier(spark, sf_dir):
    """L07 + L08 + E04: one text pipeline (tokens -> counts -> IDF -> LR) per
    label column, per-class report on the hash-split test set."""
    msgs = expand_labels(td.messages(spark, sf_dir), td.categories(spark, sf_dir))
    msgs = hash_split(msgs, "id", 0.25, 0).select("id", "message", "quality", "toxic", "split")
    msgs = ML.dealt_out(written_table(msgs, "labelled-messages"), MESSAGE_ROWS)  # tokens are kept by task while counted
    tok = RegexTokenizer(inputCol="message", outputCol="tokens", pattern=TOKEN_PATTERN, gaps=False)
    cv = CountVectorizer(inputCol="tokens", outputCol="tf", maxDF=0.75, vocabSize=5000)
    idf = IDF(inputCol="tf", outputCol="features")
    from pyspark.ml import Pipeline
    feat = Pipeline(stages=[tok, cv, idf]).fit(msgs.filter("split = 'train'"))
    x = written_table(feat.transform(msgs).select("id", "split", "quality", "toxic", "features"), "message-features")
    labels = ["quality", "toxic"]
    models = ML.multi_output(ML.dealt_out(x.filter("split = 'train'"), MESSAGE_ROWS).withColumn("quality", F.col("quality").cast("double"))
                             .withColumn("toxic", F.col("toxic").cast("double")), labels,
                             lambda lb: ML.make_classifier("lr", label=lb, maxIter=20))
    test = x.filter("split = 'test'")
    for lb, m in models.items():
        test = m.setPredictionCol(f"pred_{lb}").setProbabilityCol(f"prob_{lb}") \
                .setRawPredictionCol(f"raw_{lb}").transform(test)
    scored = written_table(test.select(*labels, *[f"pred_{lb}" for lb in labels]), "message-scores")
    return per_class_report(scored, [(lb, f"pred_{lb}") for lb in labels])


# The reference's reduced search of the message classifier. Its least number of rows to split a node is
# taken as the least number of rows of a child less one (MLlib has no such parameter); its trees are grown to MLlib's depth below.
MESSAGE_TEXT = {"ngramMax": [1], "maxDF": [0.75], "useIDF": [True]}
MESSAGE_FOREST = {"numTrees": [100, 200], "minInstancesPerNode": [1, 2]}
MESSAGE_LABELS = ["quality", "toxic"]
MESSAGE_DEPTH = 10


def _labelled_messages(spark, sf_dir):
    msgs = expand_labels(td.messages(spark, sf_dir), td.categories(spark, sf_dir))
    msgs = hash_split(msgs, "id", 0.25, 0).withColumns({lb: F.col(lb).cast("double") for lb in MESSAGE_LABELS})
    return written_table(msgs.select("id", "message", *MESSAGE_LABELS, "split"), "labelled-messages")


@register("message_forest_search")
def q_message_forest_search(spark, sf_dir):
    """L04 + L07: a forest for each label behind its own text features; the reference's reduced grid
    (4 points, 3 folds) over text options and forest; chosen values and test F1 per label."""
    msgs = _labelled_messages(spark, sf_dir)
    train, test = ML.dealt_out(msgs.where("split = 'train'"), MESSAGE_ROWS), msgs.where("split = 'test'")
    rows = []
    for lb in MESSAGE_LABELS:
        pipe = text_pipeline(SparseForest(labelCol=lb, maxDepth=MESSAGE_DEPTH))
        ev = MulticlassClassificationEvaluator(labelCol=lb, metricName="accuracy")
        search = text_search(train, pipe, text_grid(pipe, MESSAGE_TEXT, MESSAGE_FOREST), ev, folds=3)
        got = chosen(search)
        f1 = MulticlassClassificationEvaluator(labelCol=lb, metricName="f1").evaluate(search.bestModel.transform(test))
        rows.append((lb, len(search.avgMetrics), got["numTrees"], got["minInstancesPerNode"], got["ngramMax"], got["maxDF"],
                     got["useIDF"], float(max(search.avgMetrics)), float(f1)))
    return spark.createDataFrame(rows, "label string, points int, num_trees int, min_instances int, ngram_max int, max_df double, "
                                       "use_idf boolean, cv_accuracy double, test_f1 double")


@register("message_forest_reload", f"""
WITH m AS (SELECT doc_id, {h_sql('doc_id', 0)} / 4294967296.0 < 0.75 AS train FROM documents JOIN labels USING (doc_id))
SELECT count(*) AS n_scored, CAST(0 AS BIGINT) AS n_different, 'quality,toxic' AS names FROM m WHERE NOT train
""")
def q_message_forest_reload(spark, sf_dir):
    """L07 + S10 + S11: text pipelines (words and pairs, no idf) with a forest for each label, saved and
    loaded; the labels of new messages, zipped with their names, by both: how many differ."""
    msgs = _labelled_messages(spark, sf_dir)
    train, new = msgs.where("split = 'train'").persist(), msgs.where("split = 'test'").select("id", "message")
    options = {"ngramMax": 2, "maxDF": 0.5, "maxFeatures": 5000, "useIDF": False}
    fitted, loaded = {}, {}
    try:
        fitted = ML.multi_output(train, MESSAGE_LABELS, lambda lb: text_pipeline(
            ML.make_classifier("rf", label=lb, numTrees=20), **options))
    finally:
        train.unpersist()
    run = uuid.uuid4().hex
    for lb, m in fitted.items():
        path = scratch_table_path(spark, f"models/message-{lb}-{run}")
        save_model(m, path)
        loaded[lb] = load_model(path)
    a = label_messages(fitted, new).select("id", F.to_json("labels").alias("a"), F.array_join(F.map_keys("labels"), ",").alias("names"))
    b = label_messages(loaded, new).select("id", F.to_json("labels").alias("b"))
    return a.join(b, "id").agg(F.count(F.lit(1)).alias("n_scored"), F.sum((F.col("a") != F.col("b")).cast("long")).alias("n_different"),
                               F.max("names").alias("names"))


# -------------------------------------------------------- segments (E)

SEG_COLS = ["p_size", "p_retailprice", "mfgr_side", "decade", "movement", "wealth", "lifestage"]


def population_scaler(stats) -> SQLTransformer:
    """F05 as a pipeline stage: population-std scaling with fitted constants
    baked into SQL, so the fitted pipeline serialises and reapplies as is."""
    exprs = ", ".join(f"(CAST(`{c}` AS DOUBLE) - ({m!r})) / ({(s or 1.0)!r}) AS `{c}_z`"
                      for c, (m, s) in stats.items())
    return SQLTransformer(statement=f"SELECT *, {exprs} FROM __THIS__")


def segments_pipeline(pop, k_pca: int = 3, k_clusters: int = 4):
    """Imputer -> population scaler -> assembler -> PCA -> k-means,
    fitted on the population only."""
    from pyspark.ml import Pipeline
    imp = Imputer(strategy="mean", inputCols=SEG_COLS, outputCols=[f"{c}_i" for c in SEG_COLS])
    pop_i = imp.fit(pop).transform(pop)
    stats = E.fit_mean_std(pop_i, [f"{c}_i" for c in SEG_COLS])
    scaler = population_scaler(stats)
    asm = VectorAssembler(inputCols=[f"{c}_i_z" for c in SEG_COLS], outputCol="features")
    from pyspark.ml.feature import PCA
    pca = PCA(k=k_pca, inputCol="features", outputCol="pca")
    km = KMeans(k=k_clusters, seed=42, featuresCol="pca", predictionCol="cluster")
    return Pipeline(stages=[imp, scaler, asm, pca, km]).fit(pop)


def _segments_inputs(spark, sf_dir):
    meta = td.demo_meta(spark)
    fit: dict = {}
    # one file is few splits, however many rows it holds: the rows are dealt out before all else
    pop = clean_demographics(ML.dealt_out(td.population(spark, sf_dir)), meta, fitted_out=fit)
    cust = clean_demographics(td.demo_customers(spark, sf_dir), meta, binary=fit)
    return tuple(written_table(x.withColumn("mfgr_side", F.col("mfgr_side").cast("int")), "segments") for x in (pop, cust))


def _scree(spark, sf_dir):
    pop, _ = _segments_inputs(spark, sf_dir)
    m = segments_pipeline(pop, k_pca=len(SEG_COLS))
    n, total = ML.total_variance(m.transform(pop))
    return ML.scree_table(spark, m.stages[3], n, total)


@register("segments_scree_totals", f"""
SELECT CAST(1 AS DOUBLE) AS ratio_sum, round(sqrt(count(*) * 7), 4) AS norm FROM ({oracle_of("clean_demographics")})
""")
def q_segments_scree_totals(spark, sf_dir):
    """the variance ratios sum to 1; the singular values' norm is that of the
    standardised matrix: the root of its rows times its 7 columns."""
    s = _scree(spark, sf_dir)
    return s.agg(F.round(F.sum("variance_ratio"), 6).alias("ratio_sum"),
                 F.round(F.sqrt(F.sum(F.col("singular_value") ** 2)), 4).alias("norm"))


@register("segments_scree")
def q_segments_scree(spark, sf_dir):
    """F09 + F10 + F11 + W04: full PCA of the standardised population."""
    return _scree(spark, sf_dir)


@register("segments_loadings")
def q_segments_loadings(spark, sf_dir):
    """F12 + T04: component weights, the 3 largest |weight| per component."""
    pop, _ = _segments_inputs(spark, sf_dir)
    pca = segments_pipeline(pop).stages[3]
    ld = ML.loadings(spark, pca, SEG_COLS)
    return top_n_per_group(ld, ["component"], [F.desc(F.abs("weight")), F.asc("feature")], 3)


# The reference's numbers of clusters, for the demographics and for the event log.
SEGMENT_KS = sorted({*range(2, 30, 2), *range(3, 16, 2)})
PROCESS_KS = range(2, 15)


@register("segments_kmeans_sweep")
def q_segments_kmeans_sweep(spark, sf_dir):
    """L09 + E06: within-cluster cost on the PCA scores for the reference's k:
    2..28 in steps of 2 and odd k to 15."""
    pop, _ = _segments_inputs(spark, sf_dir)
    m = segments_pipeline(pop)
    scores = m.transform(pop).select("pca").persist()
    rows = ML.kmeans_sweep(scores, SEGMENT_KS, features="pca")
    scores.unpersist()
    return spark.createDataFrame([(k, c, -c) for k, c in rows], "k int, cost double, score double")


@register("segments_compare")
def q_segments_compare(spark, sf_dir):
    """L10 + A20: customers through the population's frozen pipeline;
    cluster shares of both and their ratio."""
    pop, cust = _segments_inputs(spark, sf_dir)
    m = segments_pipeline(pop)
    return cluster_ratio(m.transform(pop), m.transform(cust), "cluster")


@register("segments_profile")
def q_segments_profile(spark, sf_dir):
    """Per-cluster summary of the original features."""
    pop, _ = _segments_inputs(spark, sf_dir)
    m = segments_pipeline(pop)
    return describe_by(written_table(m.transform(pop).select("cluster", *SEG_COLS), "clusters"), "cluster", SEG_COLS)


# -------------------------------------------------------- event log (B)

def _process_scores(spark, sf_dir):
    """F16 -> standardise -> PCA(4); the features' names too."""
    proc = process_context(spark, td.win_events(spark, sf_dir), levels=PROCESS_LEVELS)
    feats = ["has_parent_process", "after_hours", "near_startup", "is_locked", "is_screensaver",
             "recorded_by_Comp", "UserName_type_Computer account", "UserName_type_User account"]
    proc = written_table(proc.select(*feats), "processes")
    scaled = E.standardise(proc.withColumns({f"{c}_z": F.col(c) for c in feats}), [f"{c}_z" for c in feats])
    x = ML.vectorise(scaled, [f"{c}_z" for c in feats])
    return written_table(ML.pca_fit(x, 4).transform(x).select(*feats, "pca"), "process-scores"), feats


@register("process_clusters")
def q_process_clusters(spark, sf_dir):
    """Event-log project end to end: F16 -> standardise -> PCA(4) -> k-means(5) -> A21."""
    y, feats = _process_scores(spark, sf_dir)
    km = KMeans(k=5, seed=42, featuresCol="pca", predictionCol="cluster").fit(y)
    return describe_by(km.transform(y).select("cluster", *feats), "cluster", feats)


@register("process_kmeans_sweep")
def q_process_kmeans_sweep(spark, sf_dir):
    """L09 + E06: within-cluster cost on the event log's PCA scores for the reference's k = 2..14."""
    y, _ = _process_scores(spark, sf_dir)
    scores = y.select("pca").persist()
    rows = ML.kmeans_sweep(scores, PROCESS_KS, features="pca")
    scores.unpersist()
    return spark.createDataFrame([(k, c, -c) for k, c in rows], "k int, cost double, score double")


# -------------------------------------------------------- images (F)

@register("embedding_mlp")
def q_embedding_mlp(spark, sf_dir):
    """L15 + T05 + A23-style selection: MLP head on precomputed 64-d
    features, top-3 classes with softmax over the kept scores."""
    emb = td.table(spark, sf_dir, "embeddings")
    x = emb.select("vec_id", F.col("label").cast("double").alias("label"), "embedding")
    from pyspark.ml.functions import array_to_vector
    x = x.withColumn("features", array_to_vector(F.col("embedding").cast("array<double>")))
    x = hash_split(x, "vec_id", 0.2, 0)
    mlp = ML.make_classifier("mlp", layers=[64, 32, 10], maxIter=50).fit(x.filter("split = 'train'"))
    pred = mlp.transform(x.filter("split = 'test'"))
    top = pred.select("vec_id", "label", F.posexplode(topk_classes(ML.to_array("rawPrediction"), 3))
                      .alias("pos", "t"))
    return top.select("vec_id", "label", (F.col("pos") + 1).alias("rank"), F.col("t.cls").alias("cls"),
                      F.col("t.prob").alias("prob"))


@register("embedding_head")
def q_embedding_head(spark, sf_dir):
    """Two ReLU layers with dropout and log-softmax, learned by mini-batch gradients on the train
    split; top-3 classes of the test split by log probability."""
    x = hash_split(td.table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding"), "vec_id", 0.2, 0)
    train, test = x.where("split = 'train'"), x.where("split = 'test'")
    fitted = fit_head(train, "vec_id", "embedding", "label", 10, hidden=(64, 64), epochs=5)
    top = test.select("vec_id", "label", fitted.scores(test, "embedding").alias("score")).select(
        "vec_id", "label", F.posexplode(topk_classes("score", 3)).alias("pos", "t"))
    return top.select("vec_id", "label", (F.col("pos") + 1).alias("rank"), F.col("t.cls").alias("cls"), F.col("t.prob").alias("prob"))


@register("model_roundtrip", f"""
WITH {td.CENSUS_SQL}
SELECT count(*) AS n_scored, CAST(0 AS BIGINT) AS n_different FROM census
WHERE NOT {h_sql('o_orderkey', 0)} / 4294967296.0 < 0.8
""")
def q_model_roundtrip(spark, sf_dir):
    """S10 + S11 + G01 batch form: fit a pipeline, save it under the shared
    checkpoint folder, load it back and score; returns how many test rows
    were scored by both and how many predictions differ."""
    from pyspark.ml import Pipeline
    ds, feats = census_dataset(spark, sf_dir)
    raw = ds.drop("features")
    pipe = Pipeline(stages=[VectorAssembler(inputCols=feats, outputCol="features"),
                            ML.make_classifier("lr", maxIter=20)])
    model = pipe.fit(raw.filter("split = 'train'"))
    path = scratch_table_path(spark, f"models/census-lr-{uuid.uuid4().hex}")
    save_model(model, path)
    loaded = load_model(path)
    test = raw.filter("split = 'test'")
    a = model.transform(test).select("o_orderkey", F.col("prediction").alias("fitted"))
    b = loaded.transform(test).select("o_orderkey", F.col("prediction").alias("loaded"))
    return a.join(b, "o_orderkey").agg(
        F.count(F.lit(1)).alias("n_scored"), F.sum((F.col("fitted") != F.col("loaded")).cast("long")).alias("n_different"))


def _churn_search(spark, sf_dir, kind: str, label: str):
    train, _ = churn_dataset(spark, sf_dir, label, CHURN_LABELS[label])
    train = train.persist()
    try:
        ev = BinaryClassificationEvaluator(metricName="areaUnderPR", numBins=0)
        cv = ML.grid_search(ML.make_classifier(kind), ML.GRIDS[kind], ev, folds=2, parallelism=4, train=train)
        return ML.best_params(spark, cv.bestModel, list(ML.GRIDS[kind]))
    finally:
        train.unpersist()


@register("churn_rf_search")
def q_churn_rf_search(spark, sf_dir):
    """L02 + L04 timed like the reference's saved RF search: the 9-point
    forest grid, 2 folds, 4 in parallel, area under PR, label
    ChurnedInTimeBin (negatives at 0.065); returns the chosen parameters."""
    return _churn_search(spark, sf_dir, "rf", "ChurnedInTimeBin")


@register("churn_gbt_search")
def q_churn_gbt_search(spark, sf_dir):
    """L03 + L04: the 9-point boosted-trees grid (depth 3/5/8 x bins
    4/12/24, 10 iterations), 2 folds, 4 in parallel, ChurnedInTimeBin."""
    return _churn_search(spark, sf_dir, "gbt", "ChurnedInTimeBin")


@register("churn_lr_search")
def q_churn_lr_search(spark, sf_dir):
    """L01 + L04: the 9-point logistic-regression grid, 2 folds, 4 in
    parallel, label WillChurnInNextBin (negatives at 0.05)."""
    return _churn_search(spark, sf_dir, "lr", "WillChurnInNextBin")
