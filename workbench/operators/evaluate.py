"""Evaluation: deterministic splits, per-user AUC with sampled negatives, class priors,
confusion tables, accuracy and weighted F1.

Per-user work never gathers a user's rows into one task: counts are aggregated with
map-side combine, and ordered counts use ``functions.prefix.running_total``, which
cuts a hot user into chunks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from workbench.functions.hashing import hash_split_flag, md5_u32
from workbench.functions.prefix import dense_index, running_total
from workbench.session import materialised

Predictor = Callable[[DataFrame], DataFrame]


# ---- splits -------------------------------------------------------------------------
def hash_split(df: DataFrame, key: Sequence[str], train_tenths: int = 9,
               seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """(train, held_out) by an md5 bucket of the key: reproducible in any engine and
    under recomputation, unlike a per-partition random split."""
    flag = hash_split_flag(list(key), train_tenths, seed)
    return df.where(flag), df.where(~flag)


def with_split(df: DataFrame, key: Sequence[str], train_tenths: int = 9, seed: int = 0,
               out: str = "split") -> DataFrame:
    flag = hash_split_flag(list(key), train_tenths, seed)
    return df.withColumn(out, F.when(flag, F.lit("train")).otherwise(F.lit("test")))


# ---- negatives ----------------------------------------------------------------------
# Fixed value: first-round draws per wanted negative; later rounds draw as many again as
# have been drawn, for users still short.
FIRST_ROUND_DRAWS = 4
SLOT_BLOCK = 4096


def _draw(users: DataFrame, catalogue: DataFrame, n_items: int, seed: int,
          lo: str, hi: str, user: str, item: str) -> DataFrame:
    """Draw slots lo+1..hi for each user; slot s picks catalogue item
    md5(seed:user:s) mod n_items. Slots are exploded in blocks, and the blocks are
    spread over tasks before the inner explode, so a user with many draws is not one
    task's work."""
    blocks = users.where(F.col(hi) > F.col(lo)).select(
        user, "target", lo, hi,
        F.explode(F.sequence(F.floor(F.col(lo) / SLOT_BLOCK),
                             F.floor((F.col(hi) - 1) / SLOT_BLOCK))).alias("_b"))
    blocks = blocks.repartition(user, "_b")
    first = F.greatest(F.col(lo) + 1, F.col("_b") * SLOT_BLOCK + 1)
    last = F.least(F.col(hi), (F.col("_b") + 1) * SLOT_BLOCK)
    slots = blocks.select(user, "target", F.explode(F.sequence(first, last)).alias("slot"))
    slots = slots.withColumn("idx", F.pmod(md5_u32(F.lit(seed), user, "slot"),
                                           F.lit(n_items)))
    return slots.join(catalogue, "idx").select(user, "target", "slot", F.col(item))


def sample_negatives(positives: DataFrame, all_items: DataFrame, *, seed: int = 7,
                     user: str = "user", item: str = "artist",
                     exclude: DataFrame | None = None) -> DataFrame:
    """(user, item) negatives per user: uniform draws with replacement from the
    catalogue, skipping the user's positive items, until as many as the user's
    distinct positives are found or as many draws as catalogue items were made.

    Deterministic (md5 of seed, user, draw number). ``exclude`` adds more (user, item)
    pairs to skip (for example the training plays)."""
    # the numbered catalogue is read by every draw round: write it once
    catalogue = materialised(dense_index(all_items.select(F.col(item)), item, "idx"), "catalogue")
    n_items = catalogue.count()
    pos = positives.select(user, item).distinct()
    skip = pos if exclude is None else pos.unionByName(exclude.select(user, item)).distinct()
    targets = pos.groupBy(user).agg(F.count(F.lit(1)).alias("target"))
    short = targets.select(
        user, "target", F.col("target").alias("wanted"), F.lit(0).cast("bigint").alias("lo"),
        F.least(F.lit(n_items), F.col("target") * FIRST_ROUND_DRAWS).cast("bigint").alias("hi"))
    # a round's hits feed the shortfall count and the result: each is written once. Blocks
    # double, so the rounds are few and nobody draws much more than is wanted
    rounds: list[DataFrame] = []
    while True:
        drawn = _draw(short, catalogue, n_items, seed, "lo", "hi", user, item)
        rounds.append(materialised(drawn.join(skip, [user, item], "left_anti"), "draws"))
        found = rounds[-1].groupBy(user).agg(F.count(F.lit(1)).alias("found"))
        missing = F.col("wanted") - F.coalesce("found", F.lit(0))
        short = materialised(
            short.join(found, user, "left").where((missing > 0) & (F.col("hi") < n_items))
            .select(user, "target", missing.alias("wanted"), F.col("hi").alias("lo"),
                    F.least(F.lit(n_items), 2 * F.col("hi")).cast("bigint").alias("hi")), "short")
        if short.isEmpty():
            break
    hits = reduce(DataFrame.unionByName, rounds).withColumn("_one", F.lit(1))
    # slots are integers: fixed-width slot blocks are ordered chunks of each user
    ranked = running_total(hits, user, ["slot"], "_one", "_k",
                           chunk=F.floor(F.col("slot") / SLOT_BLOCK))
    return ranked.where(F.col("_k") <= F.col("target")).select(user, item)


# ---- AUC ----------------------------------------------------------------------------
def _score(df: DataFrame, user: str, col: str = "prediction") -> DataFrame:
    p = F.col(col).cast("double")
    return df.select(user, F.when(~F.isnan(p), p).alias("score"))


def per_user_auc(pos_pred: DataFrame, neg_pred: DataFrame, user: str = "user",
                 col: str = "prediction") -> DataFrame:
    """(user, auc): share of (positive, negative) pairs of the user in which the
    positive scores strictly higher, without forming the pairs.

    Every pair counts in the total, including pairs with a null/NaN score, which are
    never correct; users without a negative get no row. For each positive, the
    negatives below it are a running count over the user's scores, so the work is a
    sort, not |pos|·|neg|."""
    both = (pos_pred.select(user, col, F.lit(1).alias("_pos"))
            .unionByName(neg_pred.select(user, col, F.lit(0).alias("_pos"))))
    return per_user_auc_flagged(both, "_pos", user, col)


def per_user_auc_flagged(scored: DataFrame, flag: str, user: str = "user",
                         col: str = "prediction") -> DataFrame:
    """``per_user_auc`` over one scored frame whose ``flag`` column is 1 for positive
    rows and 0 for negative rows (so a predictor is applied once to both sides)."""
    p = F.col(col).cast("double")
    both = scored.select(user, F.when(~F.isnan(p), p).alias("score"),
                         F.col(flag).cast("int").alias("np"),
                         (1 - F.col(flag).cast("int")).alias("nn"))
    # one pass over the predictions: sizes and ordered counts both come from this table
    by_score = materialised(both.groupBy(user, "score").agg(
        F.sum("np").alias("np"), F.sum("nn").alias("nn")), "scores")
    sizes = by_score.groupBy(user).agg(F.sum("np").alias("n_pos"), F.sum("nn").alias("n_neg"))
    below = running_total(by_score.where(F.col("score").isNotNull()), user, ["score"], "nn",
                          "neg_below", inclusive=False)
    correct = below.groupBy(user).agg(
        F.sum(F.col("np") * F.col("neg_below")).alias("correct"))
    return (sizes.where((F.col("n_pos") > 0) & (F.col("n_neg") > 0))
            .join(correct, user, "left")
            .select(user, (F.coalesce(F.col("correct"), F.lit(0))
                           / (F.col("n_pos") * F.col("n_neg"))).alias("auc")))


def per_user_auc_all_negatives(positive: DataFrame, item_scores: DataFrame, *,
                               user: str = "user", item: str = "artist",
                               col: str = "prediction") -> DataFrame:
    """(user, auc) with every catalogue item the user lacks as a negative, for a
    predictor whose score depends on the item only (such as popularity).

    The users × items negatives are never formed. For a positive scored s, the
    negatives below it are (catalogue items scored below s) − (the user's own distinct
    items scored below s): a global running count over item scores minus a per-user
    running count over the user's items. A user's pairs number |positive rows| ×
    (catalogue − distinct positives). Null/NaN scores count in the totals and never
    win. ``item_scores`` is (item, prediction) for the whole catalogue."""
    scores = _score(item_scores.withColumnRenamed(item, "_i"), "_i", col) \
        .withColumnRenamed("_i", item)
    n_items = scores.count()
    per_score = (scores.where(F.col("score").isNotNull()).groupBy("score")
                 .agg(F.count(F.lit(1)).alias("_n")))
    items_below = running_total(per_score, None, ["score"], "_n", "items_below",
                                inclusive=False).select("score", "items_below")
    items_below = materialised(items_below, "items-below")
    pos = positive.select(user, item).join(scores, item, "left")
    mine = pos.select(user, item, "score").distinct()
    own = (mine.where(F.col("score").isNotNull()).groupBy(user, "score")
           .agg(F.count(F.lit(1)).alias("_n")))
    own_below = running_total(own, user, ["score"], "_n", "own_below",
                              inclusive=False).select(user, "score", "own_below")
    wins = (pos.where(F.col("score").isNotNull())
            .groupBy(user, "score").agg(F.count(F.lit(1)).alias("_rows"))
            .join(items_below, "score").join(own_below, [user, "score"])
            .groupBy(user).agg(F.sum(F.col("_rows") * (F.col("items_below")
                                                        - F.col("own_below"))).alias("correct")))
    sizes = (pos.groupBy(user).agg(F.count(F.lit(1)).alias("n_pos"),
                                   F.countDistinct(item).alias("n_own"))
             .withColumn("n_neg", F.lit(n_items) - F.col("n_own")))
    return (sizes.where(F.col("n_neg") > 0).join(wins, user, "left")
            .select(user, (F.coalesce(F.col("correct"), F.lit(0))
                           / (F.col("n_pos") * F.col("n_neg"))).alias("auc")))


def mean_auc(positive: DataFrame, negatives: DataFrame, predict: Predictor, *,
             user: str = "user", item: str = "artist") -> DataFrame:
    """One row (mean_auc, users): per-user AUC averaged with equal user weight. The
    predictor scores positives and negatives in one call (it must keep the input
    columns it is given)."""
    both = (positive.select(user, item, F.lit(1).alias("_pos"))
            .unionByName(negatives.select(user, item, F.lit(0).alias("_pos"))))
    pu = per_user_auc_flagged(predict(both), "_pos", user)
    return pu.agg(F.avg("auc").alias("mean_auc"), F.count(F.lit(1)).alias("users"))


def mean_auc_many(positive: DataFrame, negatives: DataFrame,
                  predictors: dict[str, Predictor], *, user: str = "user",
                  item: str = "artist") -> DataFrame:
    """(predictor, mean_auc, users) for several predictors on the same positives and
    negatives in one evaluation: their scored rows are stacked and the per-user
    counting runs once over (predictor, user) keys."""
    # every predictor reads the pairs: derive the negatives once
    both = materialised(positive.select(user, item, F.lit(1).alias("_pos"))
                        .unionByName(negatives.select(user, item, F.lit(0).alias("_pos"))), "pairs")
    stacked = None
    for name, predict in predictors.items():
        scored = predict(both).select(
            F.concat_ws("\u0001", F.lit(name), F.col(user).cast("string")).alias("_key"),
            F.col("prediction").cast("double").alias("prediction"), "_pos")
        stacked = scored if stacked is None else stacked.unionByName(scored)
    pu = per_user_auc_flagged(stacked, "_pos", "_key")
    return (pu.select(F.substring_index("_key", "\u0001", 1).alias("predictor"), "auc")
            .groupBy("predictor").agg(F.avg("auc").alias("mean_auc"),
                                      F.count(F.lit(1)).alias("users")))


# ---- classification metrics ---------------------------------------------------------
def class_priors(df: DataFrame, label: str) -> DataFrame:
    """(label, count, p) with p = count / rows, ordered by label."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))
    # the window runs over one row per class, not over the data
    total = F.sum("count").over(Window.partitionBy(F.lit(0)))
    return counts.withColumn("p", F.col("count") / total).orderBy(label)


def prior_accuracy(train: DataFrame, test: DataFrame, label: str) -> DataFrame:
    """Accuracy of guessing labels at random with the training priors:
    Σ_c p_train(c)·p_test(c), matched on the class (a class missing on one side
    contributes 0)."""
    a = class_priors(train, label).select(label, F.col("p").alias("pa"))
    b = class_priors(test, label).select(label, F.col("p").alias("pb"))
    return a.join(b, label).agg(F.sum(F.col("pa") * F.col("pb")).alias("accuracy"))


def confusion_matrix(df: DataFrame, label: str, prediction: str,
                     classes: Sequence[int]) -> DataFrame:
    """Rows = true class, one column per class in ``classes`` (predicted), 0 for
    empty cells. Classes come from the given list, so a class seen only in the
    predictions is not lost."""
    return (df.groupBy(label).pivot(prediction, list(classes)).count()
            .na.fill(0).orderBy(label))


def accuracy_f1(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row (accuracy, weighted_f1) as aggregates over the (label, prediction)
    counts; classes are those of the label column, weighted by their frequency."""
    cells = df.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("n"))
    y, p, n, zero = F.col(label), F.col(prediction), F.col("n"), F.lit(0).cast("bigint")
    # each cell counts for its true class and for its predicted one: the rows are read once
    parts = cells.select(F.inline(F.array(
        F.struct(y.cast("double").alias("c"), n.alias("actual"), zero.alias("predicted"),
                 F.when(y == p, n).otherwise(zero).alias("tp")),
        F.struct(p.cast("double").alias("c"), zero.alias("actual"), n.alias("predicted"),
                 zero.alias("tp")))))
    per = (parts.groupBy("c").agg(*[F.sum(x).alias(x) for x in ("actual", "predicted", "tp")])
           .where(F.col("actual") > 0))
    precision = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(0.0)
    recall = F.col("tp") / F.col("actual")
    f1 = F.when(precision + recall > 0, 2 * precision * recall / (precision + recall)
                ).otherwise(0.0)
    return per.agg(
        (F.sum("tp") / F.sum("actual")).alias("accuracy"),
        (F.sum(f1 * F.col("actual")) / F.sum("actual")).alias("weighted_f1"))
