"""Classification (T17–T22) and clustering (T23–T26) invariants."""

import math

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from workbench.operators import classify, cluster, evaluate, project
from workbench.plans import views as V

SF = "/root/testdata/sf0.001"


def test_undo_one_hot_edge_rows(spark):
    df = spark.createDataFrame([(5.0, 0, 1, 0, 0, 1.0), (6.0, 0, 0, 0, 0, 2.0),
                                (7.0, 1, 0, 1, 0, 3.0)], "x double, a0 int, a1 int, a2 int, a3 int, y double")
    out = classify.undo_one_hot(df, {"area": ["a0", "a1", "a2", "a3"]})
    assert out.columns == ["x", "y", "area"]  # new column last (T21)
    assert [r.area for r in out.orderBy("x").collect()] == [1.0, -1.0, 0.0]  # none -> -1, two -> first


def test_tree_and_forest_beat_prior_baseline(spark):
    """On held-out rows: the label is a rule of features with a fifth of noise, so a model
    can beat the priors but not be always right."""
    keyed = V.labelled(spark, SF, keyed=True)
    train, test = (x.drop("l_orderkey", "l_linenumber")
                   for x in evaluate.hash_split(keyed, ["l_orderkey", "l_linenumber"]))
    lab = keyed.drop("l_orderkey", "l_linenumber")
    model = classify.fit_tree(train, "y", seed=1, maxDepth=10)
    acc = evaluate.accuracy_f1(model.transform(test), "y", "prediction").first().accuracy
    prior = evaluate.prior_accuracy(train, test, "y").first().accuracy
    assert prior + 0.2 < acc < 0.9
    probs = classify.predictions(model, lab, ["y"]).first().probability
    assert len(probs) == 8  # labels 1..7 -> classes 0..7 (T17)
    un = classify.undo_one_hot(lab, {"area": V.AREA_COLS, "kind": V.KIND_COLS})
    forest = classify.fit_categorical(un, "y", model="forest", max_bins=50, seed=1)
    facc = evaluate.accuracy_f1(forest.transform(un), "y", "prediction").first().accuracy
    assert facc > prior
    imp = classify.importances(forest, classify.feature_columns(un, "y")).collect()
    assert math.isclose(sum(r.importance for r in imp), 1.0, rel_tol=1e-6)


def test_max_bins_checked(spark):
    df = spark.createDataFrame([(float(i % 30), float(i % 2)) for i in range(200)], "c double, y double")
    with pytest.raises(ValueError):
        classify.fit_categorical(df, "y", max_categories=40, max_bins=20)


def test_bins_of_no_categorical_column(spark):
    df = spark.createDataFrame([(float(i),) for i in range(200)], "c double")
    classify.check_bins(df, ["c"], 40, 20)  # 200 values: not categorical
    with pytest.raises(ValueError):
        classify.check_bins(df.selectExpr("c % 40 AS c"), ["c"], 40, 39)


@pytest.mark.parametrize("partitions", [1, 2, 8])
def test_fits_do_not_depend_on_the_input_layout(spark, partitions):
    s = V.sessions(spark, SF).repartition(partitions)
    model = cluster.fit_clusters(s, 6, numeric=V.SESSION_NUMERIC, seed=3, max_iter=5)
    centers = [[round(float(x), 9) for x in c] for c in model.stages[-1].clusterCenters()]
    assert centers == FIRST_FIT.setdefault("centers", centers)
    lab = V.labelled(spark, SF).repartition(partitions)
    text = classify.fit_tree(lab, "y", seed=1).stages[-1].toDebugString.split("\n", 1)[1]
    assert text == FIRST_FIT.setdefault("tree", text)


FIRST_FIT: dict = {}


def test_cluster_entropy_pure_mixed_single(spark):
    df = spark.createDataFrame([(0, "a"), (0, "a"), (1, "a"), (1, "b"), (2, "c")],
                               "cluster int, label string")
    r = cluster.cluster_entropy(df).first()
    # pure cluster 0 -> 0; 50/50 cluster 1 -> ln 2 weighted 2/5; single row -> 0
    assert r.rows == 5 and math.isclose(r.entropy, 2 * math.log(2) / 5)


def test_anomaly_threshold_ties_and_few_rows(spark):
    df = spark.createDataFrame([(i, d) for i, d in enumerate([5.0, 3.0, 3.0, 1.0])],
                               "id int, dist double")
    assert sorted(r.id for r in cluster.anomalies(df, "dist", 2).collect()) == [0, 1, 2]
    assert cluster.anomalies(df, "dist", 100).count() == 4  # fewer rows than k


def test_training_cost_equals_recomputed_distance(spark):
    s = V.sessions(spark, SF)
    model = cluster.fit_clusters(s, 5, numeric=V.SESSION_NUMERIC,
                                 categorical=V.SESSION_CATEGORICAL, seed=3)
    km = model.stages[-1]
    scored = cluster.distance_to_model_center(model.transform(s), km, cluster.SCALED)
    total = scored.agg(F.sum("dist")).first()[0]
    assert math.isclose(total, km.summary.trainingCost, rel_tol=1e-6)


def test_sweep_shapes(spark):
    s = V.sessions(spark, SF)
    sweep = cluster.kmeans_sweep(s, [2, 4], numeric=V.SESSION_NUMERIC, seed=2).collect()
    assert [r.k for r in sweep] == [2, 4]
    n = s.count()
    assert all(math.isclose(r.cost / n, r.mean_cost) for r in sweep)
    ent = cluster.entropy_sweep(s, [2], numeric=V.SESSION_NUMERIC,
                                categorical=V.SESSION_CATEGORICAL, seed=2).first()
    assert 0 <= ent.entropy <= math.log(3) + 1e-9


def test_pca_scores_centered_and_projection_rows_unit(spark):
    vec = V.vectors(spark, SF).select("vec_id", array_to_vector("embedding").alias("v"))
    scores, var = project.pca_scores(vec, "v", 3, keep=["vec_id"])
    means = scores.agg(*[F.avg(f"pc{i}") for i in (1, 2, 3)]).first()
    assert all(abs(m) < 1e-9 for m in means)
    ev = [r.explained_variance for r in var.orderBy("component").collect()]
    assert ev == sorted(ev, reverse=True) and sum(ev) <= 1 + 1e-9
    m = project.projection_matrix(64, 3, seed=1)
    assert all(math.isclose(float((row * row).sum()), 1.0) for row in m)


def test_fixed_centers_assign(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 1.0]), (3, [0.9, 0.8])],
                               "id int, f array<double>")
    out = {r.id: (r.cluster, r.dist) for r in
           cluster.assign(df, "f", [[0.0, 0.0], [1.0, 1.0]]).collect()}
    assert out[1] == (0, 0.0) and out[2] == (1, 0.0) and out[3][0] == 1


def test_the_class_count_is_known_before_the_rows_are_dealt(spark):
    """A fit finds it in the label's metadata; a label that is no class number is left as it is."""
    def known(values):
        df = spark.createDataFrame([(1.0, y) for y in values], "x double, y double")
        return classify.with_class_count(df, df, "y").schema["y"].metadata.get("ml_attr", {}).get("num_vals")
    assert known([1.0, 7.0]) == 8 and known([0.0, None]) == 1
    assert [known(v) for v in ([0.5], [-1.0], [None], [100.0], [float("nan")])] == [None] * 5


def test_spread_counts_buckets_before_hashes(spark, monkeypatch):
    """Few buckets, so that all of them look full: values with few copies are not cut."""
    from workbench.functions import partitions
    df = spark.range(3_000).select((F.col("id") % 900).alias("a"))
    plain = partitions.spread(df, 4, equal_rows=10)
    monkeypatch.setattr(partitions, "HASH_BUCKETS", 2)
    full = partitions.spread(df, 4, equal_rows=10)
    assert plain.rdd.glom().collect() == full.rdd.glom().collect()
    skewed = df.unionByName(spark.range(50).select(F.lit(5).cast("bigint").alias("a")))
    dealt = partitions.spread(skewed, 4, equal_rows=10)
    assert sorted(r.a for r in dealt.collect()) == sorted(r.a for r in skewed.collect())
