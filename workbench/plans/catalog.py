"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the driver's tables (or data Spark derives from them) whole. Double
results are rounded to 6 places so that the SQL check compares values, not the last
bits of a different summation order.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from workbench.functions.bounded import collected, only_row, temp_views
from workbench.operators import (classify, cluster, evaluate, factor_scores, factorise, lemmas, linkage,
                                 markup, profile, project, recommend)
from workbench.operators import text as X
from workbench.plans import views as V
from workbench.session import materialised, scratch_path
from workbench.sources import files, lines, schema

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Round every double/float column (and fold -0.0 into 0.0)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append((F.round(F.col(f"`{f.name}`").cast("double"), places) + F.lit(0.0))
                       .alias(f.name))
        else:
            out.append(F.col(f"`{f.name}`"))
    return df.select(*out)


# ---- record linkage ---------------------------------------------------------------
LINKAGE_SCORE_COLS = ["cmp_a", "cmp_b", "cmp_c", "cmp_d"]


@register("label_counts")
def label_counts(spark, d):
    return profile.value_counts(V.linkage_like(spark, d), "is_match")


@register("label_counts_sql")
def label_counts_sql(spark, d):
    return profile.value_counts_sql(V.linkage_like(spark, d), "is_match")


@register("summary_stats")
def summary_stats(spark, d):
    return rounded(profile.summary_as_double(profile.summary(V.linkage_like(spark, d))))


@register("summary_transposed")
def summary_transposed(spark, d):
    return rounded(profile.transpose_summary(profile.summary(V.linkage_like(spark, d))))


@register("grouped_summary")
def grouped_summary(spark, d):
    return rounded(profile.grouped_summary(V.linkage_like(spark, d), "is_match"))


@register("feature_delta_ranking")
def feature_delta_ranking(spark, d):
    return rounded(profile.compare_groups(V.linkage_like(spark, d), "is_match",
                                          exclude=["id_1", "id_2"]))


@register("feature_delta_ranking_sql")
def feature_delta_ranking_sql(spark, d):
    """The same ranking the long way: filter each side, describe it, transpose it, and
    join the two transposed summaries."""
    df = V.linkage_like(spark, d)
    match_t = profile.transpose_summary(profile.summary(df.where("is_match = true")))
    miss_t = profile.transpose_summary(profile.summary(df.filter(F.col("is_match") == False)))  # noqa: E712
    return rounded(profile.compare_summaries(match_t, miss_t, exclude=["id_1", "id_2"]))


@register("pair_score")
def pair_score(spark, d):
    return rounded(linkage.additive_score(V.linkage_like(spark, d), LINKAGE_SCORE_COLS,
                                          keep=["id_1", "id_2", "is_match"]))


def _crosstab(t: float) -> Query:
    def q(spark, d):
        scored = linkage.additive_score(V.linkage_like(spark, d), LINKAGE_SCORE_COLS,
                                        keep=["is_match"])
        return linkage.threshold_crosstab(scored, "score", "is_match", t)
    return q


register("score_crosstab_t4")(_crosstab(4.0))
register("score_crosstab_t2")(_crosstab(2.0))


@register("item_plays_sql")
def item_plays_sql(spark, d):
    """Plays and listeners of each catalogue item, as SQL text over two temporary views that
    are gone when the query has been planned."""
    with temp_views(spark, plays=V.plays(spark, d), items=V.items(spark, d)) as views:
        return spark.sql("""
            SELECT i.name, i.id, count(DISTINCT p.user) AS listeners, coalesce(sum(p.count), 0) AS plays
            FROM {items} i LEFT JOIN {plays} p ON p.artist = i.id
            GROUP BY i.name, i.id""".format(**views))


@register("table_structure")
def table_structure(spark, d):
    return profile.structure(V.items(spark, d).join(V.alias_pairs(spark, d), F.col("id") == F.col("artist"), "left"))


@register("first_plays")
def first_plays(spark, d):
    return profile.peek(V.plays(spark, d), 20, "user", "artist")


@register("aliases_swapped")
def aliases_swapped(spark, d):
    """Key and value of the alias pairs exchanged: all misspelt ids of each right one."""
    pairs = lines.parse_pairs_lenient(alias_lines(spark, d))
    return pairs.select(F.col("alias").alias("artist"), F.col("artist").alias("alias"))


@register("distinct_counts")
def distinct_counts(spark, d):
    return profile.distinct_counts(V.linkage_like(spark, d))


@register("distinct_counts_labelled")
def distinct_counts_labelled(spark, d):
    """The wide table: 55 columns, still one pass."""
    return profile.distinct_counts(V.labelled(spark, d))


# ---- sources: file round trips and line parsers ------------------------------------

LINKAGE_SCHEMA = ("id_1 bigint, id_2 bigint, cmp_a double, cmp_b double, cmp_c int, "
                  "cmp_d int, is_match boolean")


def _cast_like(df: DataFrame, like: DataFrame) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in like.schema.fields])


@register("csv_roundtrip_infer")
def csv_roundtrip_infer(spark, d):
    src = V.linkage_like(spark, d)
    path = files.write_csv(src, scratch_path(spark, "linkage-csv"), null_value="?")
    back = files.read_csv(spark, path, header=True, null_value="?", infer=True)
    return _cast_like(back, src)  # inference narrows bigint → int


@register("csv_roundtrip_schema")
def csv_roundtrip_schema(spark, d):
    src = V.linkage_like(spark, d)
    path = files.write_csv(src, scratch_path(spark, "linkage-csv"), null_value="?")
    back = files.read_csv(spark, path, header=True, null_value="?", schema=LINKAGE_SCHEMA)
    return schema.typed_view(back, LINKAGE_SCHEMA)


@register("csv_positional")
def csv_positional(spark, d):
    src = V.labelled(spark, d)
    path = files.write_csv(src, scratch_path(spark, "labelled-csv"), header=False)
    back = files.read_csv(spark, path, header=False, infer=True, names=V.LABELLED_COLS)
    return back.withColumn("y", F.col("y").cast("double"))


def play_lines(spark, d) -> DataFrame:
    """The play table as ``user artist count`` text lines, written and read back."""
    p = V.plays(spark, d)
    txt = p.select(F.concat_ws(" ", "user", "artist", "count").alias("value"))
    return files.read_lines(spark, files.write_lines(txt, "value", scratch_path(spark, "plays")))


def item_lines(spark, d) -> DataFrame:
    """Catalogue lines ``id<TAB>name`` with a rule-made share of malformed ones."""
    p = V.table(spark, d, "part")
    k, name, brand = F.col("p_partkey"), F.col("p_name"), F.col("p_brand")
    tab = F.lit("\t")
    v = (F.when(k % 7 == 0, F.concat(k.cast("string"), F.lit(" "), name))
         .when(k % 7 == 1, F.concat(F.lit("x"), k.cast("string"), tab, name))
         .when(k % 7 == 2, F.concat(k.cast("string"), tab))
         .when(k % 7 == 3, F.concat(F.lit(" "), k.cast("string"), F.lit(" "), tab, name))
         .when(k % 7 == 4, F.concat((k + 3000000000).cast("string"), tab, name))
         .when(k % 7 == 5, F.concat(k.cast("string"), tab, name, tab, brand))
         .otherwise(F.concat(k.cast("string"), tab, F.lit("  "), name, F.lit("  "))))
    txt = p.select(v.alias("value"))
    return files.read_lines(spark, files.write_lines(txt, "value", scratch_path(spark, "items")))


def alias_lines(spark, d) -> DataFrame:
    """Alias lines ``bad<TAB>good``, plus lines with an empty first field."""
    p = V.table(spark, d, "part")
    k = F.col("p_partkey")
    v = (F.when(k % 10 == 9, F.concat(k.cast("string"), F.lit("\t"), (k - 9).cast("string")))
         .when(k % 10 == 8, F.concat(F.lit("\t"), k.cast("string"))))
    txt = p.select(v.alias("value")).where(F.col("value").isNotNull())
    return files.read_lines(spark, files.write_lines(txt, "value", scratch_path(spark, "alias")))


@register("parse_strict")
def parse_strict(spark, d):
    return lines.parse_fields_strict(play_lines(spark, d), ["user", "artist", "count"])


@register("parse_lenient")
def parse_lenient(spark, d):
    return lines.parse_id_name_lenient(item_lines(spark, d))


@register("parse_alias_lenient")
def parse_alias_lenient(spark, d):
    return lines.parse_pairs_lenient(alias_lines(spark, d))


@register("xml_pages")
def xml_pages(spark, d):
    docs = V.table(spark, d, "documents").select(
        F.concat(F.lit("doc "), F.col("doc_id").cast("string")).alias("title"), "text")
    path = files.write_xml_records(docs, scratch_path(spark, "dump-xml"), "page", "pages")
    return files.read_xml_records(spark, path, "page", "title string, text string")


@register("xml_dump_text")
def xml_dump_text(spark, d):
    """A dump whose text element carries attributes (``<text bytes="…">…</text>``):
    attributes and the element's own text arrive as fields of one struct; pages whose
    text is empty are dropped."""
    docs = V.table(spark, d, "documents").select(
        F.concat(F.lit("doc "), F.col("doc_id").cast("string")).alias("title"),
        F.struct(F.col("n_chars").alias("_bytes"), F.col("text").alias("_VALUE")).alias("text"))
    path = files.write_xml_records(docs, scratch_path(spark, "dump-attr-xml"), "page", "pages")
    back = files.read_xml_records(spark, path, "page",
                                  "title string, text struct<_bytes: bigint, _VALUE: string>")
    return (back.select("title", F.col("text._VALUE").alias("content"))
            .where(F.length("content") > 0))


# ---- recommender: relational parts -------------------------------------------------
@register("id_ranges")
def id_ranges(spark, d):
    return profile.column_ranges(V.plays(spark, d), ["user", "artist"])


@register("alias_resolve")
def alias_resolve(spark, d):
    alias = lines.parse_pairs_lenient(alias_lines(spark, d))
    return recommend.build_counts(play_lines(spark, d), alias)


@register("item_lookup")
def item_lookup(spark, d):
    return V.items(spark, d).where(F.col("id").isin(10, 20))


# Fixed value: the user whose history is looked up.
SPOT_USER = 7


@register("user_history")
def user_history(spark, d):
    return recommend.history(V.plays(spark, d), V.items(spark, d), [SPOT_USER])


@register("hash_split")
def hash_split(spark, d):
    return evaluate.with_split(V.plays(spark, d), ["user", "artist"])


def _split_plays(spark, d):
    return evaluate.hash_split(V.plays(spark, d), ["user", "artist"])


@register("popularity_predict")
def popularity_predict(spark, d):
    plays = _plays_table(spark, d)  # read twice, joined once
    train, _ = evaluate.hash_split(plays, ["user", "artist"])
    return recommend.popularity_predictor(train)(plays).select(
        "user", "artist", "prediction")


@register("distinct_items")
def distinct_items(spark, d):
    return V.plays(spark, d).select("artist").distinct()


@register("first_n_users")
def first_n_users(spark, d):
    return V.plays(spark, d).select("user").distinct().orderBy("user").limit(100)


def _plays_table(spark, d):
    """The play table for the evaluation pipelines, which read it five times (split
    sides, catalogue, positives, scores): the join is written once to the shared
    folder instead of being recomputed per consumer."""
    return materialised(V.plays(spark, d), "plays")


def _negatives(spark, d, plays=None):
    plays = plays if plays is not None else _plays_table(spark, d)
    train, cv = evaluate.hash_split(plays, ["user", "artist"])
    return train, cv, evaluate.sample_negatives(cv, plays.select("artist"), seed=7)


@register("negative_sample")
def negative_sample(spark, d):
    return _negatives(spark, d)[2]


@register("auc_sampled")
def auc_sampled(spark, d):
    train, cv, neg = _negatives(spark, d)
    pred = recommend.popularity_predictor(train)
    both = (cv.select("user", "artist", F.lit(1).alias("_pos"))
            .unionByName(neg.select("user", "artist", F.lit(0).alias("_pos"))))
    return rounded(evaluate.per_user_auc_flagged(pred(both), "_pos", "user"))


@register("auc_mean")
def auc_mean(spark, d):
    train, cv, neg = _negatives(spark, d)
    return rounded(evaluate.mean_auc(cv, neg, recommend.popularity_predictor(train)))


@register("auc_exhaustive")
def auc_exhaustive(spark, d):
    """Per-user AUC of the popularity baseline against every catalogue item the user
    lacks (no sampling, no users × items product)."""
    plays = _plays_table(spark, d)
    train, cv = evaluate.hash_split(plays, ["user", "artist"])
    catalogue = plays.select("artist").distinct()
    scores = recommend.popularity_predictor(train)(catalogue)
    return rounded(evaluate.per_user_auc_all_negatives(cv, scores))


# ---- factor scores over all users and items ----------------------------------------
def _fixed_factors(plays):
    users = V.fixed_factors(plays.select(F.col("user").alias("id")).distinct(), 1, V.NO_USER)
    return users, V.fixed_factors(plays.select(F.col("artist").alias("id")).distinct(), 2, V.NO_ITEM)


@register("auc_all_items")
def auc_all_items(spark, d):
    """Per-user AUC of factors against every catalogue item the user lacks."""
    plays = _plays_table(spark, d)
    _, cv = evaluate.hash_split(plays, ["user", "artist"])
    users, items = _fixed_factors(plays)
    return rounded(factor_scores.per_user_auc_all_items(cv, users, items, plays.select("artist")))


@register("top_items_all")
def top_items_all(spark, d):
    """The best items of every user, by exact search over the items in order of their norms."""
    users, items = _fixed_factors(_plays_table(spark, d))
    return rounded(factor_scores.top_items(users, items, TOP_N))


# Fixed value: items for each user, of those not played yet.
UNSEEN_N = 20


@register("top_items_unseen")
def top_items_unseen(spark, d):
    """The same without the items that the user has played."""
    plays = _plays_table(spark, d)
    users, items = _fixed_factors(plays)
    return rounded(factor_scores.top_items(users, items, UNSEEN_N, exclude=plays))


# ---- classification ---------------------------------------------------------------

CLASSES = [1, 2, 3, 4, 5, 6, 7]
ONE_HOT_GROUPS = {"area": V.AREA_COLS, "kind": V.KIND_COLS}


def _labelled_split(spark, d):
    return evaluate.hash_split(V.labelled(spark, d, keyed=True), ["l_orderkey", "l_linenumber"])


def rule_prediction(df: DataFrame) -> DataFrame:
    """A fixed rule standing in for a model: it errs, and predicts a class (0) that no
    label has."""
    pred = (F.lit(1) + F.least(F.lit(6), F.floor(
        (F.col("q") + 3 * (F.col("l_linenumber") % 3) - 3) / 8))).cast("double")
    return df.withColumn("prediction", pred)


@register("class_priors")
def class_priors(spark, d):
    train, _ = _labelled_split(spark, d)
    return rounded(evaluate.class_priors(train, "y"))


@register("prior_accuracy")
def prior_accuracy(spark, d):
    train, test = _labelled_split(spark, d)
    return rounded(evaluate.prior_accuracy(train, test, "y"))


@register("confusion_matrix")
def confusion_matrix(spark, d):
    p = rule_prediction(V.labelled(spark, d, keyed=True))
    return evaluate.confusion_matrix(p, "y", "prediction", CLASSES)


@register("accuracy_f1")
def accuracy_f1(spark, d):
    p = rule_prediction(V.labelled(spark, d, keyed=True))
    return rounded(evaluate.accuracy_f1(p, "y", "prediction"))


@register("undo_one_hot")
def undo_one_hot(spark, d):
    return classify.undo_one_hot(V.labelled(spark, d), ONE_HOT_GROUPS)


def _train_test_features(spark, d):
    # the split's sides, the parts of the fit and the fit itself read it: derived once
    keyed = materialised(V.labelled(spark, d, keyed=True), "labelled")
    train, test = evaluate.hash_split(keyed, ["l_orderkey", "l_linenumber"])
    return train.drop("l_orderkey", "l_linenumber"), test


@register("tree_predict")
def tree_predict(spark, d):
    train, test = _train_test_features(spark, d)
    model = classify.fit_tree(train, "y", seed=42)
    return classify.predictions(model, test, ["l_orderkey", "l_linenumber", "y"])


@register("tree_text")
def tree_text(spark, d):
    """The fitted tree printed as text, one row per line."""
    train, _ = _train_test_features(spark, d)
    model = classify.fit_tree(train, "y", seed=42)
    lines_ = model.stages[-1].toDebugString.splitlines()
    return spark.createDataFrame(list(enumerate(lines_)), "line_no int, line string")


@register("tree_importance")
def tree_importance(spark, d):
    train, _ = _train_test_features(spark, d)
    cols = classify.feature_columns(train, "y")
    return classify.importances(classify.fit_tree(train, "y", cols, seed=42), cols)


@register("tree_eval")
def tree_eval(spark, d):
    """Accuracy and weighted F1 of the default tree on held-out rows."""
    train, test = _train_test_features(spark, d)
    model = classify.fit_tree(train, "y", seed=42)
    return evaluate.accuracy_f1(model.transform(test), "y", "prediction")


@register("tree_tuned")
def tree_tuned(spark, d):
    """The chosen tree (entropy, depth 20, 300 bins, no minimum gain) on held-out rows."""
    train, test = _train_test_features(spark, d)
    model = classify.fit_tree(train, "y", seed=42, impurity="entropy", maxDepth=20,
                              maxBins=300, minInfoGain=0.0)
    return evaluate.accuracy_f1(model.transform(test), "y", "prediction")


@register("tree_categorical")
def tree_categorical(spark, d):
    train, test = _train_test_features(spark, d)
    tr = classify.undo_one_hot(train, ONE_HOT_GROUPS)
    te = classify.undo_one_hot(test, ONE_HOT_GROUPS)
    model = classify.fit_categorical(tr, "y", model="tree", max_bins=50, seed=42)
    return evaluate.accuracy_f1(model.transform(te), "y", "prediction")


@register("forest_importance")
def forest_importance(spark, d):
    train, _ = _train_test_features(spark, d)
    tr = classify.undo_one_hot(train, ONE_HOT_GROUPS)
    model = classify.fit_categorical(tr, "y", model="forest", max_bins=50, seed=42)
    return classify.importances(model, classify.feature_columns(tr, "y"))


@register("tree_grid")
def tree_grid(spark, d):
    train, _ = _train_test_features(spark, d)
    table, _best = classify.tree_grid_search(train, "y", seed=42)
    return table


# ---- clustering, anomalies, projection --------------------------------------------


def _fixed_clusters(spark, d):
    vec = V.vectors(spark, d)
    centers = cluster.group_centers(vec, "label", "vec_id", "embedding")
    return cluster.assign(vec, "embedding", centers)


@register("nearest_center")
def nearest_center(spark, d):
    return rounded(_fixed_clusters(spark, d).select("vec_id", "cluster", "dist"))


@register("mean_cost")
def mean_cost(spark, d):
    c = _fixed_clusters(spark, d)
    return rounded(c.agg(F.sum("dist").alias("cost"), F.avg("dist").alias("mean_cost")))


@register("label_by_cluster")
def label_by_cluster(spark, d):
    return cluster.label_by_cluster(_fixed_clusters(spark, d), "cluster", "label")


@register("cluster_sizes")
def cluster_sizes(spark, d):
    return cluster.cluster_sizes(_fixed_clusters(spark, d))


@register("cluster_entropy")
def cluster_entropy(spark, d):
    return rounded(cluster.cluster_entropy(_fixed_clusters(spark, d), "cluster", "label"))


@register("anomalies_topk")
def anomalies_topk(spark, d):
    c = _fixed_clusters(spark, d)
    return cluster.anomalies(c, "dist", 100, keep=["vec_id", "label"])


def _standardized(spark, d, with_mean):
    vec = V.vectors(spark, d).select("vec_id", array_to_vector("embedding").alias("v"))
    model = StandardScaler(inputCol="v", outputCol="s", withStd=True,
                           withMean=with_mean).fit(vec)
    out = model.transform(vec).select(
        "vec_id", F.posexplode(vector_to_array("s")).alias("dim", "value"))
    return rounded(out)


@register("standardize")
def standardize(spark, d):
    return _standardized(spark, d, False)


@register("standardize_centered")
def standardize_centered(spark, d):
    return _standardized(spark, d, True)


@register("one_hot")
def one_hot(spark, d):
    s = V.sessions(spark, d).select("l_orderkey", "l_linenumber", "priority")
    stages, (vec,) = cluster.one_hot_stages("priority")
    out = Pipeline(stages=stages).fit(s).transform(s)
    arr = vector_to_array(vec)
    return out.select("l_orderkey", "l_linenumber", "priority",
                      F.col("priority_level").cast("int").alias("priority_index"),
                      (F.array_position(arr, F.lit(1.0)) - 1).cast("int").alias("hot"))


@register("constant_columns")
def constant_columns(spark, d):
    return profile.constant_columns(V.linkage_like(spark, d))


@register("random_projection")
def random_projection(spark, d):
    vec = V.vectors(spark, d)
    return rounded(project.random_projection(vec, "embedding", 64, 3, seed=42)
                   .select("vec_id", "x1", "x2", "x3"))


def _session_feats(spark, d):
    return V.sessions(spark, d)


@register("session_label_counts")
def session_label_counts(spark, d):
    """Rows per label of the connection-log stand-in, most frequent first."""
    return profile.value_counts(V.sessions(spark, d), "label")


@register("kmeans_centers")
def kmeans_centers(spark, d):
    """Default k-means (k = 2) on the numeric columns: its centres."""
    s = _session_feats(spark, d)
    model = cluster.fit_clusters(s, 2, numeric=V.SESSION_NUMERIC, scale=False,
                                 max_iter=20, tol=1e-4, seed=42)
    centers = [(i, [float(x) for x in c]) for i, c in
               enumerate(model.stages[-1].clusterCenters())]
    return spark.createDataFrame(centers, "cluster int, center array<double>")


@register("kmeans_default_labels")
def kmeans_default_labels(spark, d):
    """(cluster, label, count) of the default k = 2 model, by cluster then count desc."""
    s = _session_feats(spark, d)
    model = cluster.fit_clusters(s, 2, numeric=V.SESSION_NUMERIC, scale=False,
                                 max_iter=20, tol=1e-4, seed=42)
    return (model.transform(s).groupBy("cluster", "label").agg(F.count(F.lit(1)).alias("count"))
            .orderBy("cluster", F.col("count").desc()))


@register("kmeans_sweep")
def kmeans_sweep(spark, d):
    """Mean cost per row, numeric columns, default iterations."""
    return cluster.kmeans_sweep(_session_feats(spark, d), cluster.K_SWEEP_SMALL,
                                numeric=V.SESSION_NUMERIC, seed=42)


@register("kmeans_sweep_tight")
def kmeans_sweep_tight(spark, d):
    """40 iterations, tolerance 1e-5."""
    return cluster.kmeans_sweep(_session_feats(spark, d), cluster.K_SWEEP_SMALL,
                                numeric=V.SESSION_NUMERIC, max_iter=40, tol=1e-5, seed=42)


@register("kmeans_scaled")
def kmeans_scaled(spark, d):
    return cluster.kmeans_sweep(_session_feats(spark, d), cluster.K_SWEEP_LARGE,
                                numeric=V.SESSION_NUMERIC, scale=True, max_iter=40,
                                tol=1e-5, seed=42)


@register("kmeans_onehot")
def kmeans_onehot(spark, d):
    return cluster.kmeans_sweep(_session_feats(spark, d), cluster.K_SWEEP_LARGE,
                                numeric=V.SESSION_NUMERIC,
                                categorical=V.SESSION_CATEGORICAL, scale=True,
                                max_iter=40, tol=1e-5, seed=42)


@register("kmeans_entropy_sweep")
def kmeans_entropy_sweep(spark, d):
    return cluster.entropy_sweep(_session_feats(spark, d), cluster.K_SWEEP_LARGE,
                                 numeric=V.SESSION_NUMERIC,
                                 categorical=V.SESSION_CATEGORICAL, label="label", seed=42)


@register("kmeans_labels_k180")
def kmeans_labels_k180(spark, d):
    """(cluster, label, count) of the k=180 one-hot + scaled clustering."""
    s = _session_feats(spark, d)
    model = cluster.fit_clusters(s, 180, numeric=V.SESSION_NUMERIC,
                                 categorical=V.SESSION_CATEGORICAL, seed=42)
    return cluster.label_by_cluster(model.transform(s), "cluster", "label")


@register("anomalies_fitted")
def anomalies_fitted(spark, d):
    """Rows at or beyond the 100th largest distance to their k=180 centre, in the
    original columns."""
    s = _session_feats(spark, d)
    model = cluster.fit_clusters(s, 180, numeric=V.SESSION_NUMERIC,
                                 categorical=V.SESSION_CATEGORICAL, seed=42)
    scored = cluster.distance_to_model_center(model.transform(s), model.stages[-1],
                                              cluster.SCALED)
    return cluster.anomalies(scored, "dist", 100, keep=s.columns)


@register("kmeans_formula")
def kmeans_formula(spark, d):
    """k=100 on every numeric column by formula; predictions, then a 1% sample."""
    s = _session_feats(spark, d).select(*V.SESSION_NUMERIC)
    model = cluster.formula_kmeans(s, 100, max_iter=40, seed=42)
    return (model.transform(s).select(*V.SESSION_NUMERIC, "prediction")
            .sample(False, 0.01, seed=42))


@register("kmeans_scaled_centered")
def kmeans_scaled_centered(spark, d):
    """Scaler with mean removal + k=100 (24 iterations, tol 1e-5): cluster sizes."""
    s = _session_feats(spark, d)
    model = cluster.fit_clusters(s, 100, numeric=V.SESSION_NUMERIC, with_mean=True,
                                 max_iter=24, tol=1e-5, seed=42)
    return cluster.cluster_sizes(model.transform(s))


@register("pca_scores")
def pca_scores(spark, d):
    vec = V.vectors(spark, d).select("vec_id", array_to_vector("embedding").alias("v"))
    scores, _ = project.pca_scores(vec, "v", 3, keep=["vec_id"])
    return scores


@register("pca_sample")
def pca_sample(spark, d):
    """Numeric rows → drop constant columns → centred, scaled PCA: first three scores per
    row. (A single machine would fit this on a sample; here all rows are fitted on.)"""
    s = _session_feats(spark, d).select("l_orderkey", "l_linenumber", *V.SESSION_NUMERIC)
    kept = profile.drop_constant_columns(s, V.SESSION_NUMERIC)
    cols = [c for c in V.SESSION_NUMERIC if c in kept.columns]
    vec = classify.assembler(cols, "v").transform(kept)
    scores, _ = project.pca_scores(vec, "v", min(3, len(cols)),
                                   keep=["l_orderkey", "l_linenumber"])
    return scores


@register("pca_variance")
def pca_variance(spark, d):
    vec = V.vectors(spark, d).select("vec_id", array_to_vector("embedding").alias("v"))
    return project.pca_scores(vec, "v", 3)[1]


# ---- text --------------------------------------------------------------------------


def stop_words(spark) -> DataFrame:
    """The stop-word list as a one-word-per-line file, read back as a word table."""
    words = spark.createDataFrame([(w,) for w in X.STOP_WORDS], "value string")
    return files.read_word_set(spark, files.write_lines(words, "value",
                                                        scratch_path(spark, "stopwords")))


def _doc_terms(spark, d, lemmas=None):
    docs = V.table(spark, d, "documents")
    return X.doc_terms(docs, "doc_id", "text", stop_words=stop_words(spark), lemmas=lemmas)


@register("page_text")
def page_text(spark, d):
    return X.page_text(V.table(spark, d, "pages"), "html", keep=["page_id"])


@register("doc_terms")
def doc_terms(spark, d):
    t = _doc_terms(spark, d)
    return t.select("doc_id", F.size("terms").alias("n_terms"),
                    F.size(F.array_distinct("terms")).alias("n_distinct"))


def accent_folder():
    """An annotator: letter words of three letters and more, in lower case, without marks."""
    import re
    import unicodedata

    def annotate(text: str) -> list[str]:
        words = (unicodedata.normalize("NFD", w.lower()) for w in re.findall(r"[^\W\d_]+", text))
        folded = ("".join(c for c in w if not unicodedata.combining(c)) for w in words)
        return [w for w in folded if len(w) >= 3]
    return annotate


@register("doc_terms_letters")
def doc_terms_letters(spark, d):
    """Terms under the whole-token rule: a token with anything but letters is dropped."""
    t = X.doc_terms(V.table(spark, d, "documents"), "doc_id", "text",
                    stop_words=stop_words(spark), letters_only=True)
    return t.select("doc_id", F.size("terms").alias("n_terms"),
                    F.size(F.array_distinct("terms")).alias("n_distinct"))


@register("doc_terms_pandas")
def doc_terms_pandas(spark, d):
    """Terms without accents, by an annotator that column functions cannot express (Unicode
    decomposition), built once per partition."""
    t = X.doc_terms_in_pandas(V.table(spark, d, "documents"), "doc_id", "text", accent_folder)
    return t.select("doc_id", F.size("terms").alias("n_terms"),
                    F.size(F.array_distinct("terms")).alias("n_distinct"))


@register("lemma_terms")
def lemma_terms(spark, d):
    lemmas = spark.createDataFrame(X.LEMMAS, "form string, lemma string")
    tf = X.term_freq_from_text(V.table(spark, d, "documents"), "doc_id", "text",
                               stop_words=stop_words(spark), lemmas=lemmas)
    return tf.groupBy("term").agg(F.sum("tf").alias("total"))


@register("lemma_rules")
def lemma_rules(spark, d):
    """Lemmas of forms whose lemma was held back, by suffix rules from the other pairs."""
    train, held = evaluate.hash_split(V.inflections(spark, d), ["lemma"], 7, seed=3)
    held = materialised(held, "held-back")
    found = lemmas.lemmatise(held.select("form"), lemmas.induce(train))
    return held.join(found.withColumnRenamed("lemma", "guess"), "form").select(
        "form", "lemma", "guess", (F.col("lemma") == F.col("guess")).alias("right"))


@register("markup_text")
def markup_text(spark, d):
    """Plain text of markup with constructs in one another: the words it was made around."""
    return markup.markup_text(V.nested_markup(spark, d), "doc_id", "markup")


def _tf_long(spark, d):
    return X.term_freq_from_text(V.table(spark, d, "documents"), "doc_id", "text",
                                 stop_words=stop_words(spark))


@register("term_freq")
def term_freq(spark, d):
    return _tf_long(spark, d)


def _term_table(spark, d):
    """Term counts read by several consumers (vocabulary, document frequency, weights):
    written once to the shared folder instead of re-tokenising per consumer."""
    return materialised(_tf_long(spark, d), "term-counts")


@register("vocabulary")
def vocabulary(spark, d):
    return X.vocabulary(_tf_long(spark, d), 20000).select("term_id", "term", "count")


@register("idf")
def idf(spark, d):
    tf = _term_table(spark, d)
    return rounded(X.idf(tf, "doc_id", X.vocabulary(tf, 20000)))


@register("tfidf")
def tfidf(spark, d):
    tf = _term_table(spark, d)
    return rounded(X.tfidf(tf, "doc_id", X.idf(tf, "doc_id", X.vocabulary(tf, 20000))))


@register("tfidf_vectors")
def tfidf_vectors(spark, d):
    """Spark ML vectors per document over the long form's vocabulary, reported as
    (doc_id, non-zero weights, weight sum)."""
    # the term arrays feed the vocabulary, the IDF fit and the weighting: tokenise once
    terms = materialised(_doc_terms(spark, d), "doc-terms")
    vocab = X.vocabulary(X.term_freq(terms, "doc_id"), 20000)
    vecs, _vocab = X.tfidf_vectors(terms, "doc_id", 20000, vocab=vocab)
    arr = vector_to_array("tfidfVec")
    return rounded(vecs.select(
        "doc_id", F.size(F.filter(arr, lambda v: v != 0)).alias("nnz"),
        F.aggregate(arr, F.lit(0.0), lambda a, v: a + v).alias("weight")))


# Size of the vocabulary and components of the factorisation.
SVD_TERMS, SVD_SIZE = 20_000, 10


def _term_svd(spark, d):
    """(decomposition of the TF-IDF matrix of the documents, its weights)"""
    tf = _term_table(spark, d)
    weights = materialised(X.tfidf(tf, "doc_id", X.idf(tf, "doc_id", X.vocabulary(tf, SVD_TERMS))), "weights")
    n_terms = only_row(weights.agg(F.max("term_id")))[0]
    return factorise.truncated_svd(weights, "doc_id", "term_id", "tfidf", (n_terms or 0) + 1, SVD_SIZE), weights


@register("svd_concepts")
def svd_concepts(spark, d):
    """The terms that weigh most in each component of the documents' TF-IDF matrix."""
    svd, weights = _term_svd(spark, d)
    terms = weights.select("term_id", "term").distinct()
    rows = svd.right.select("term_id", F.posexplode("v").alias("place", "weight"))
    by = Window.partitionBy("place").orderBy(F.abs("weight").desc(), "term_id")
    best = rows.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= 10)
    return best.join(terms, "term_id").join(svd.values, F.col("place") + 1 == F.col("component")).select(
        "component", "sigma", "rank", "term", "weight")


@register("svd_documents")
def svd_documents(spark, d):
    """Every document with a term: its coordinates in the space of the components."""
    svd, _ = _term_svd(spark, d)
    return svd.left.select("doc_id", F.col("u").alias("coordinates"))


@register("svd_check")
def svd_check(spark, d):
    """Of each component: lengths of its vectors, and what the left vectors give when the
    weights are multiplied out again (u'Av = sigma), next to the size of the matrix."""
    svd, weights = _term_svd(spark, d)
    left = materialised(svd.left, "left")
    sizes = {n: t.select(F.posexplode(c).alias("place", "x")).groupBy("place").agg(F.sum(F.col("x") ** 2).alias(n))
             for n, t, c in (("left_length", left, "u"), ("right_length", svd.right, "v"))}
    again = (weights.join(left, "doc_id").join(svd.right, "term_id")
             .select(F.posexplode(F.zip_with("u", "v", lambda a, b: a * b)).alias("place", "x"), "tfidf")
             .groupBy("place").agg(F.sum(F.col("x") * F.col("tfidf")).alias("again")))
    total = weights.agg(F.round(F.sum(F.col("tfidf") ** 2), 2)).scalar()
    out = svd.values.withColumn("place", F.col("component") - 1)
    for t in (*sizes.values(), again):
        out = out.join(t, "place")
    return rounded(out.select(
        "component", "left_length", "right_length", (F.col("again") / F.col("sigma")).alias("again"),
        (F.col("residual") < 1e-8).alias("settled"), total.alias("total")))


# ---- recommender: factor model -----------------------------------------------------


def _all_counts(spark, d):
    """Play counts with misspelt item ids resolved (the training table)."""
    alias = lines.parse_pairs_lenient(alias_lines(spark, d))
    return recommend.resolve_aliases(V.plays(spark, d), alias, "artist")


def _split_counts(spark, d):
    return evaluate.hash_split(_all_counts(spark, d), ["user", "artist"])


# The tuned model, the users and items of the batch.
TUNED_ALS = {"rank": 30, "reg": 4.0, "alpha": 1.0, "max_iter": 20}
BATCH_USERS, TOP_N = 100, 5


def _first_users(plays: DataFrame) -> DataFrame:
    return plays.select("user").distinct().orderBy("user").limit(BATCH_USERS)


@register("als_factors")
def als_factors(spark, d):
    model = recommend.fit_als(_all_counts(spark, d), rank=10, reg=0.01, alpha=1.0,
                              max_iter=5, seed=42)
    return recommend.factors(model, "user")


@register("als_topn_batch")
def als_topn_batch(spark, d):
    """Top 5 items, with names, of the first 100 users of the held-out plays, from the tuned
    model fitted on the training split."""
    train, held_out = _split_counts(spark, d)
    model = recommend.fit_als(train, **TUNED_ALS, seed=42)
    top = recommend.top_n(model, TOP_N, _first_users(held_out))
    return top.join(V.items(spark, d), top.artist == F.col("id"), "left").select(
        "user", "rank", "artist", "name", "prediction")


@register("als_topn_names")
def als_topn_names(spark, d):
    """Names of the top-5 items of the spot user (an inner join with the catalogue)."""
    counts = _all_counts(spark, d)
    model = recommend.fit_als(counts, rank=10, reg=0.01, alpha=1.0, max_iter=5, seed=42)
    users = counts.where(F.col("user") == SPOT_USER).select("user").distinct()
    top = recommend.top_n(model, 5, users)
    return top.join(V.items(spark, d), top.artist == F.col("id")).select(
        "user", "rank", "artist", "name", "prediction")


@register("als_topn_user")
def als_topn_user(spark, d):
    """Top 5 of the spot user by scoring every item for that one user."""
    model = recommend.fit_als(_all_counts(spark, d), rank=10, reg=0.01, alpha=1.0,
                              max_iter=5, seed=42)
    return recommend.recommend_for_user(model, SPOT_USER, 5)


@register("als_auc")
def als_auc(spark, d):
    """Mean per-user AUC of the factor model next to the popularity baseline, on the
    same held-out plays and sampled negatives, evaluated in one stacked pass."""
    counts = materialised(_all_counts(spark, d), "counts")
    train, cv, neg = _negatives(spark, d, counts)
    model = recommend.fit_als(train, rank=10, reg=0.01, alpha=1.0, max_iter=5, seed=42)
    return evaluate.mean_auc_many(
        cv, neg, {"als": recommend.als_predictor(model),
                  "popularity": recommend.popularity_predictor(train)}
    ).select("predictor", "mean_auc")


@register("als_auc_all_items")
def als_auc_all_items(spark, d):
    """Mean per-user AUC of the factor model and of popularity, each against every item that
    the user lacks instead of sampled ones."""
    counts = materialised(_all_counts(spark, d), "counts")
    train, cv = evaluate.hash_split(counts, ["user", "artist"])
    catalogue = counts.select("artist").distinct()
    model = recommend.fit_als(train, rank=10, reg=0.01, alpha=1.0, max_iter=5, seed=42)
    popular = recommend.popularity_predictor(train)(catalogue)
    per_user = {"als": factor_scores.per_user_auc_all_items(cv, model.userFactors, model.itemFactors, catalogue),
                "popularity": evaluate.per_user_auc_all_negatives(cv, popular)}
    one, two = (t.agg(F.avg("auc").alias("mean_auc")).select(F.lit(n).alias("predictor"), "mean_auc")
                for n, t in per_user.items())
    return one.unionByName(two)


@register("als_topn_unseen")
def als_topn_unseen(spark, d):
    """Top 5 of every user of the training plays without what the user has played in them."""
    train, _ = _split_counts(spark, d)
    train = materialised(train, "train")
    model = recommend.fit_als(train, rank=10, reg=0.01, alpha=1.0, max_iter=5, seed=42)
    return recommend.top_n(model, TOP_N, exclude_seen=train)


@register("als_topn_unseen_check")
def als_topn_unseen_check(spark, d):
    """Of every user's list: its length, no played item in it, scores falling, ranks 1, 2, ..."""
    train, _ = _split_counts(spark, d)
    train = materialised(train, "train")
    model = recommend.fit_als(train, rank=10, reg=0.01, alpha=1.0, max_iter=5, seed=42)
    top = materialised(recommend.top_n(model, TOP_N, exclude_seen=train), "unseen")
    played = train.select("user", "artist").distinct().withColumn("played", F.lit(1))
    at = F.sort_array(F.collect_list(F.struct("rank", "prediction")))
    lists = top.join(played, ["user", "artist"], "left").groupBy("user").agg(
        F.count(F.lit(1)).alias("n"), (F.count("played") == 0).alias("unseen"), at.alias("at"))
    scores = F.col("at.prediction")
    return lists.select("user", "n", "unseen",
                        (F.sort_array(scores, asc=False) == scores).alias("falling"),
                        (F.col("at.rank") == F.sequence(F.lit(1), F.col("n").cast("int"))).alias("ranked"))


# The factor-model grid.
ALS_RANKS = [5, 30]
ALS_REGS = [4.0, 0.0001]
ALS_ALPHAS = [1.0, 40.0]
# Most fits of the grid at a time, and the rows of all of them together: each keeps blocks of
# its own and the factors of its last steps on the executors' disks.
ALS_FITS, ALS_FIT_ROWS = 4, 40_000_000


@register("als_grid")
def als_grid(spark, d):
    """Mean AUC for rank × reg × alpha (8 fits, 20 iterations), best first: the fits run
    several at a time unless their rows are many, then all eight are evaluated in one
    stacked AUC pass."""
    counts = materialised(_all_counts(spark, d), "counts")
    train, cv, neg = _negatives(spark, d, counts)
    train = train.cache()
    grid = [(r, g, a) for r in ALS_RANKS for g in ALS_REGS for a in ALS_ALPHAS]
    try:
        workers = max(1, min(ALS_FITS, ALS_FIT_ROWS // max(train.count(), 1)))
        with ThreadPoolExecutor(max_workers=workers) as pool:
            models = list(pool.map(
                lambda p: recommend.fit_als(train, rank=p[0], reg=p[1], alpha=p[2],
                                            max_iter=20, seed=42), grid))
    finally:
        train.unpersist()
    names = {f"{r}|{g}|{a}": recommend.als_predictor(m) for (r, g, a), m in zip(grid, models)}
    res = evaluate.mean_auc_many(cv, neg, names)
    parts = F.split("predictor", r"\|")
    return (res.select(parts[0].cast("int").alias("rank"), parts[1].cast("double").alias("reg"),
                       parts[2].cast("double").alias("alpha"), "mean_auc")
            .orderBy(F.col("mean_auc").desc()))


@register("als_item_factors")
def als_item_factors(spark, d):
    model = recommend.fit_als(_all_counts(spark, d), rank=10, reg=0.01, alpha=1.0,
                              max_iter=5, seed=42)
    return recommend.factors(model, "item")


@register("als_best_params")
def als_best_params(spark, d):
    """The grid point with the largest mean AUC."""
    return als_grid(spark, d).limit(1)


@register("tree_best_params")
def tree_best_params(spark, d):
    """The parameters of the best model of the search, as the model itself holds them."""
    train, _ = _train_test_features(spark, d)
    _, best = classify.tree_grid_search(train, "y", seed=42)
    chosen = best.stages[-1]
    row = (chosen.getImpurity(), chosen.getMaxDepth(), chosen.getMaxBins(), chosen.getMinInfoGain())
    return spark.createDataFrame([row], "impurity string, maxDepth int, maxBins int, minInfoGain double")


@register("cluster_id_max")
def cluster_id_max(spark, d):
    """The largest cluster id in use."""
    return _fixed_clusters(spark, d).agg(F.max("cluster").alias("max_cluster"))


@register("parse_id_name_strict")
def parse_id_name_strict(spark, d):
    """Catalogue lines without malformed ones, by the parser that fails on the first bad line."""
    p = V.table(spark, d, "part")
    txt = p.select(F.concat(F.col("p_partkey").cast("string"), F.lit("\t "), F.col("p_name")).alias("value"))
    path = files.write_lines(txt, "value", scratch_path(spark, "good-items"))
    return lines.parse_id_name_strict(files.read_lines(spark, path))


# ---- checked answers around the fits -------------------------------------------------
# What a solver decides has no SQL twin; what it must not change has: which rows come back,
# how many, which parameters were tried, sums, and figures that two ways of computing give.


def _tested_tree(spark, d, **params):
    train, test = _train_test_features(spark, d)
    model = classify.fit_tree(train, "y", seed=42, **params)
    return classify.predictions(model, test, ["l_orderkey", "l_linenumber", "y"])


@register("tree_predict_check")
def tree_predict_check(spark, d):
    """One prediction per held-out row: a class, the likeliest one, of probabilities that add
    up to 1 over classes 0..7."""
    p = _tested_tree(spark, d)
    total = F.aggregate("probability", F.lit(0.0), lambda a, x: a + x)
    likeliest = F.array_position("probability", F.array_max("probability")) - 1
    return p.select("l_orderkey", "l_linenumber", F.col("prediction").between(1, 7).alias("is_class"),
                    (F.size("probability") == 8).alias("has_all"), (F.abs(total - 1) < 1e-9).alias("adds_up"),
                    (F.col("prediction") == likeliest).alias("is_likeliest"))


@register("tree_confusion")
def tree_confusion(spark, d):
    """Confusion matrix of the chosen tree on held-out rows, classes in order."""
    p = _tested_tree(spark, d, impurity="entropy", maxDepth=20, maxBins=300, minInfoGain=0.0)
    return evaluate.confusion_matrix(p, "y", "prediction", CLASSES)


@register("tree_confusion_check")
def tree_confusion_check(spark, d):
    """Rows of each true class in the model's confusion matrix, and whether the tree beats
    the priors without knowing the label."""
    m = tree_confusion(spark, d)
    train, test = _train_test_features(spark, d)
    prior = only_row(evaluate.prior_accuracy(train, test, "y"))[0] or 0
    rows = collected(m, len(CLASSES))
    hits = sum(r[str(int(r["y"]))] for r in rows)
    total = sum(r[str(c)] for r in rows for c in CLASSES)
    return m.select("y", sum(F.col(f"`{c}`") for c in CLASSES).alias("rows"),
                    F.lit(prior * total < hits < total).alias("between"))


# Fixed value: by how much the best tree must be more often right than the priors.
LEARNT = 0.1


@register("tree_text_check")
def tree_text_check(spark, d):
    """The printed tree: as many leaves, questions and levels as the model says it has, and
    only the features that it was given."""
    train, _ = _train_test_features(spark, d)
    cols = classify.feature_columns(train, "y")
    model = classify.fit_tree(train, "y", cols, seed=42).stages[-1]
    printed = spark.createDataFrame([(line,) for line in model.toDebugString.splitlines()], "line string")
    indent = F.length("line") - F.length(F.ltrim("line"))
    asked = F.regexp_extract("line", r"feature (\d+)", 1)
    return printed.agg(
        (F.count_if(F.col("line").contains("Predict:")) == (model.numNodes + 1) // 2).alias("leaves"),
        (F.count_if(F.col("line").rlike(r"^ *If \(")) == model.numNodes // 2).alias("questions"),
        (F.max(F.when(F.col("line").contains("Predict:"), indent)) == model.depth + 2).alias("levels"),
        F.min(F.when(asked != "", asked.cast("int") < len(cols))).alias("known"))


@register("tree_categorical_check")
def tree_categorical_check(spark, d):
    """The tree on categories: every held-out row has one of the classes, and it is right more
    often than the priors by a stated margin."""
    train, test = _train_test_features(spark, d)
    tr, te = (classify.undo_one_hot(t, ONE_HOT_GROUPS) for t in (train, test))
    model = classify.fit_categorical(tr, "y", model="tree", max_bins=50, seed=42)
    prior = only_row(evaluate.prior_accuracy(train, test, "y"))[0] or 0
    return model.transform(te).agg(
        F.count(F.lit(1)).alias("rows"), F.min(F.col("prediction").isin(*CLASSES)).alias("is_class"),
        (F.avg((F.col("prediction") == F.col("y")).cast("int")) > prior + LEARNT).alias("learnt"))


@register("ranking_check")
def ranking_check(spark, d):
    """Rankings as they come, without another sort: importances of the tree and of the forest
    fall row by row, and no feature is missing."""
    out = []
    for name, query in (("tree", tree_importance), ("forest", forest_importance)):
        shares = [r["importance"] for r in collected(query(spark, d), len(V.LABELLED_COLS))]
        out.append((name, len(shares), shares == sorted(shares, reverse=True)))
    return spark.createDataFrame(out, "model string, features int, falling boolean")


@register("kmeans_sample_check")
def kmeans_sample_check(spark, d):
    """The sample of the formula model's predictions: about one row in a hundred (within five
    standard deviations), without a row more often than the table has it."""
    sample = materialised(kmeans_formula(spark, d), "sample")
    rows = _session_feats(spark, d).groupBy(*V.SESSION_NUMERIC).agg(F.count(F.lit(1)).alias("all"))
    n = only_row(rows.agg(F.sum("all")))[0] or 0
    drawn = sample.groupBy(*V.SESSION_NUMERIC).agg(F.count(F.lit(1)).alias("drawn"))
    return drawn.join(rows, V.SESSION_NUMERIC, "left").agg(
        (F.abs(F.sum("drawn") - 0.01 * n) <= 5 * (0.0099 * n) ** 0.5).alias("about"),
        F.min(F.coalesce(F.col("drawn") <= F.col("all"), F.lit(False))).alias("known"))


@register("tree_grid_check")
def tree_grid_check(spark, d):
    """The sixteen points of the tree search with usable scores, and the best model's own
    parameters among the points with the best score."""
    train, test = _train_test_features(spark, d)
    table, best = classify.tree_grid_search(train, "y", seed=42)
    t = best.stages[-1]
    top = only_row(table.agg(F.max("accuracy")))[0]
    prior = only_row(evaluate.prior_accuracy(train, test, "y"))[0] or 0
    own = ((F.col("impurity") == t.getImpurity()) & (F.col("maxDepth") == t.getMaxDepth())
           & (F.col("maxBins") == t.getMaxBins()) & (F.col("minInfoGain") == t.getMinInfoGain()))
    best_is_best = only_row(table.where(own))["accuracy"] == top
    return table.select("impurity", "maxDepth", "maxBins", "minInfoGain",
                        F.col("accuracy").between(0, 1).alias("usable"), F.lit(best_is_best).alias("best_is_best"),
                        F.lit(top > prior + LEARNT).alias("learnt"))


@register("importance_check")
def importance_check(spark, d):
    """Each feature once, of the tree and of the forest; shares that add up to 1."""
    out = None
    for name, query in (("tree", tree_importance), ("forest", forest_importance)):
        imp = query(spark, d)
        one = abs(only_row(imp.agg(F.sum("importance")))[0] - 1) < 1e-9
        rows = imp.select(F.lit(name).alias("model"), "feature", F.lit(one).alias("adds_up"))
        out = rows if out is None else out.unionByName(rows)
    return out


def _cost_check(spark, d, k, **options) -> DataFrame:
    """(rows, at_most_k, same_cost): rows assigned, clusters in use at most k, and whether
    the distances recomputed row by row add up to the model's cost. The model states the
    cost before its last move of the centres, which makes it a little smaller."""
    s = _session_feats(spark, d)
    model = cluster.fit_clusters(s, k, numeric=V.SESSION_NUMERIC, seed=42, **options)
    scaled = options.get("scale", True)
    scored = cluster.distance_to_model_center(
        model.transform(s), model.stages[-1], cluster.SCALED if scaled else "featureVector")
    cost = model.stages[-1].summary.trainingCost
    return scored.agg(F.count(F.lit(1)).alias("rows"),
                      (F.countDistinct("cluster") <= k).alias("at_most_k"),
                      (F.sum("dist") / cost).between(0.99, 1 + 1e-9).alias("same_cost"))


@register("kmeans_cost_check")
def kmeans_cost_check(spark, d):
    """Plain, scaled, centred and one-hot k-means."""
    kinds = {"plain": {"k": 20, "scale": False}, "scaled": {"k": 60}, "centred": {"k": 60, "with_mean": True},
             "one_hot": {"k": 60, "categorical": V.SESSION_CATEGORICAL}}
    out = None
    for name, options in kinds.items():
        rows = _cost_check(spark, d, **options).select(F.lit(name).alias("model"), "*")
        out = rows if out is None else out.unionByName(rows)
    return out


@register("kmeans_sweep_check")
def kmeans_sweep_check(spark, d):
    """The k of the sweeps: cost per row is cost over rows, and entropy lies between 0 and
    that of the labels as a whole."""
    n = _session_feats(spark, d).count()
    whole = only_row(cluster.cluster_entropy(_session_feats(spark, d).withColumn("cluster", F.lit(0))))["entropy"]
    cost = None
    for name, query in (("plain", kmeans_sweep), ("tight", kmeans_sweep_tight)):
        rows = query(spark, d).select(F.lit(name).alias("sweep"), "k",
                                      (F.abs(F.col("cost") / n - F.col("mean_cost")) < 1e-6).alias("ok"))
        cost = rows if cost is None else cost.unionByName(rows)
    entropy = kmeans_entropy_sweep(spark, d).select(
        F.lit("entropy").alias("sweep"), "k", F.col("entropy").between(0, whole + 1e-9).alias("ok"))
    return cost.unionByName(entropy)


@register("anomalies_fitted_check")
def anomalies_fitted_check(spark, d):
    """Anomalies of the fitted model: at least 100, all of them rows of the input."""
    found = materialised(anomalies_fitted(spark, d), "anomalies")
    known = found.join(_session_feats(spark, d), ["l_orderkey", "l_linenumber"], "left_semi").count()
    return found.agg((F.count(F.lit(1)) >= 100).alias("enough"), (F.count(F.lit(1)) == known).alias("known"))


@register("kmeans_formula_check")
def kmeans_formula_check(spark, d):
    """Every row gets one of the formula model's clusters; their cost is a small part of that
    of one cluster for all rows."""
    s = _session_feats(spark, d).select(*V.SESSION_NUMERIC)
    model = cluster.formula_kmeans(s, 100, max_iter=40, seed=42)
    one = only_row(s.agg(sum(F.var_pop(c) for c in V.SESSION_NUMERIC) * F.count(F.lit(1))))[0] or 0
    cost = model.stages[-1].summary.trainingCost
    return model.transform(s).agg(F.count(F.lit(1)).alias("rows"),
                                  F.min(F.col("prediction").between(0, 99)).alias("in_range"),
                                  F.lit(cost < 0.01 * one).alias("close"))


@register("pca_check")
def pca_check(spark, d):
    """Scores of every row, centred, with the variance that the component is said to have:
    the explained shares times the number of standardised columns."""
    vec = V.vectors(spark, d).select("vec_id", array_to_vector("embedding").alias("v"))
    scores, variance = project.pca_scores(vec, "v", 3, keep=["vec_id"])
    share = {r["component"]: r["explained_variance"] for r in collected(variance, 3)}
    width = only_row(vec.agg(F.max(F.size(vector_to_array("v")))))[0] or 0
    first = min(share, default=0)
    out = None
    for i in range(3):
        pc, said = F.col(f"pc{i + 1}"), share.get(first + i, 0.0) * width
        rows = scores.agg(F.count(F.lit(1)).alias("rows"), (F.abs(F.avg(pc)) < 1e-9).alias("centred"),
                          (F.abs(F.var_samp(pc) - said) < 1e-6 * width).alias("as_said")
                          ).select(F.lit(i + 1).alias("component"), "*")
        out = rows if out is None else out.unionByName(rows)
    return out


@register("als_factors_check")
def als_factors_check(spark, d):
    """Who has factors: all users and all items of the training table, ten each."""
    model = recommend.fit_als(_all_counts(spark, d), rank=10, reg=0.01, alpha=1.0, max_iter=5, seed=42)
    both = [recommend.factors(model, which).select(F.lit(which).alias("side"), "id",
                                                   F.size("features").alias("width"))
            for which in ("user", "item")]
    return both[0].unionByName(both[1])


@register("als_topn_check")
def als_topn_check(spark, d):
    """The batch: five ranks for each of its users, distinct known items, falling scores."""
    top = materialised(als_topn_batch(spark, d), "batch")
    return top.groupBy("user").agg(
        F.count(F.lit(1)).alias("n"), (F.countDistinct("artist") == F.count("name")).alias("known"),
        (F.max("rank") == TOP_N).alias("ranked"),
        F.transform(F.sort_array(F.collect_list(F.struct("rank", "prediction"))),
                    lambda x: -x["prediction"]).alias("p")).select(
        "user", "n", "known", "ranked", (F.col("p") == F.array_sort("p")).alias("falling"))


@register("als_topn_user_check")
def als_topn_user_check(spark, d):
    """The spot user's list two ways, by scoring all items and by the model's own search."""
    model = recommend.fit_als(_all_counts(spark, d), rank=10, reg=0.01, alpha=1.0, max_iter=5, seed=42)
    one = recommend.recommend_for_user(model, SPOT_USER, TOP_N).withColumnRenamed("prediction", "p")
    users = spark.createDataFrame([(SPOT_USER,)], "user int")
    many = recommend.top_n(model, TOP_N, users)
    return one.join(many, "artist").agg(
        F.count(F.lit(1)).alias("shared"), F.max(F.abs(F.col("p") - F.col("prediction")) < 1e-5).alias("same"))


@register("als_grid_check")
def als_grid_check(spark, d):
    """The eight points of the factor grid with usable scores."""
    return als_grid(spark, d).select("rank", "reg", "alpha", F.col("mean_auc").between(0, 1).alias("usable"))
