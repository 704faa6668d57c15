"""Training and evaluation jobs: pooled models from MLlib, one small model per group, folds, stacking and blending."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickerloom.operators.metrics import accuracy, auc
from tickerloom.operators.staging import staged
from tickerloom.operators.table import hash_mod, numbered_by_hash, stratified_folds, time_split

PARALLEL = 4  # fits that run at the same time; each is a Spark job of its own
METRICS = "symbol string, auc double, accuracy double, train_rows long, test_rows long, features long"


def assembled(df: DataFrame, features: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol="features", handleInvalid="skip").transform(df)


def estimators(seed: int = 7) -> dict:
    """The model families, small enough for a fold each."""
    return {
        "logistic": LogisticRegression(labelCol="label", maxIter=20, regParam=0.01),
        "forest": RandomForestClassifier(labelCol="label", numTrees=10, maxDepth=4, seed=seed),
        "boosted": GBTClassifier(labelCol="label", maxIter=8, maxDepth=3, seed=seed),
    }


def together(df: DataFrame, fits: list[Callable]) -> list:
    """What each of fits gives, PARALLEL at a time."""
    with ThreadPool(PARALLEL) as pool:
        return pool.map(inheritable_thread_target(df.sparkSession)(lambda f: f()), fits, chunksize=1)


def predict(model, df: DataFrame, *keep: str) -> DataFrame:
    """score: the model's probability of class 1."""
    return model.transform(df).select(*keep, vector_to_array("probability")[1].alias("score"))


def sample_split(df: DataFrame, key: str, test_in: int = 5) -> tuple[DataFrame, DataFrame]:
    """About (test_in - 1) of test_in parts to train on and one to test on, by a hash of the key."""
    part = hash_mod(F.col(key), test_in)
    return df.where(part < test_in - 1), df.where(part >= test_in - 1)


def stratified_split(df: DataFrame, key: str, stratum: str, train: float = 0.8) -> DataFrame:
    """df with `train`: of each stratum the first int(rows * train + 0.5) rows by MD5 of the key, so within a row of its share.

    A null stratum is one, too. A stratum's rows are numbered within hash ranges, not in one task.
    """
    return numbered_by_hash(df, key, [stratum]).withColumn("train", F.col("_at") < F.floor(F.col("_n") * F.lit(train) + 0.5)).drop("_at", "_n")


def train_pooled(df: DataFrame, features: list[str], key: str, order: list[str], most: int = 24) -> DataFrame:
    """model, part, auc, trees, losses: one model over all rows, stopped early, and its AUC on each part in time.

    Parts are the first 70 % of the rows in order, the next 15 % (validation) and the rest (test). Trees are added while the
    validation loss falls; losses is its course over the trees that were kept.
    """
    split = staged(time_split(df.select(*dict.fromkeys(["label", key, *order, *features])), order), "pooled")
    rows = assembled(split.withColumn("later", F.col("split") == "val"), features)
    known = rows.where("split <> 'test'")
    model = GBTClassifier(labelCol="label", maxIter=most, maxDepth=3, stepSize=0.2, seed=7, validationIndicatorCol="later", validationTol=0.001).fit(known)
    losses = model.evaluateEachIteration(rows.where("later").select("label", "features"))
    found = auc(predict(model, rows, "label", "split"), ["split"]).withColumnRenamed("split", "part")
    return found.select(F.lit("boosted").alias("model"), "part", "auc", F.lit(model.getNumTrees).alias("trees"), F.array(*[F.lit(float(x)) for x in losses]).alias("losses"))


def _fit_logistic(x: np.ndarray, y: np.ndarray, rounds: int = 60) -> np.ndarray:
    """Newton steps with a small ridge."""
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    for _ in range(min(rounds, 15)):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w)), x.T @ (p - y) + 1e-2 * w)
    return w


def _auc(score: np.ndarray, y: np.ndarray) -> float:
    rank = pd.Series(score).rank().to_numpy()
    p = y.sum()
    return float((rank[y == 1].sum() - p * (p + 1) / 2) / (p * (len(y) - p))) if 0 < p < len(y) else float("nan")


def train_per_group(df: DataFrame, features: list[str], key: str, group: str = "symbol") -> DataFrame:
    """One logistic model and its test measures for each group. A group must fit a task: symbols and sectors do.

    Missing features take the mean of the group's training rows.
    """
    rows = df.select(F.col(group).cast("string").alias("symbol"), "label", (hash_mod(F.col(key), 5) < 4).alias("fit"), *features)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        x, y, here = pdf[features].to_numpy(float), pdf["label"].to_numpy(float), pdf["fit"].to_numpy(bool)
        if not here.any() or here.all():
            return pd.DataFrame([[pdf["symbol"].iloc[0], float("nan"), float("nan"), int(here.sum()), int((~here).sum()), len(features)]], columns=["symbol", "auc", "accuracy", "train_rows", "test_rows", "features"])
        mean = np.nan_to_num(np.nanmean(x[here], 0))
        x = np.where(np.isnan(x), mean, x)
        x = (x - x[here].mean(0)) / np.where(x[here].std(0) > 0, x[here].std(0), 1)
        w = _fit_logistic(x[here], y[here])
        score = 1 / (1 + np.exp(-np.clip(x[~here] @ w[:-1] + w[-1], -30, 30)))
        row = [pdf["symbol"].iloc[0], _auc(score, y[~here]), float(((score > 0.5) == y[~here]).mean()), int(here.sum()), int((~here).sum()), len(features)]
        return pd.DataFrame([row], columns=["symbol", "auc", "accuracy", "train_rows", "test_rows", "features"])

    return rows.groupBy("symbol").applyInPandas(fit, METRICS)


def out_of_fold(df: DataFrame, features: list[str], key: str, k: int = 3) -> DataFrame:
    """key, label, fold, model, score: each row scored by the model of the other folds. Rows and scores are staged."""
    data = staged(assembled(stratified_folds(df, key, "label", k), features).select(key, "label", "fold", "features"), "fold-rows")

    def part(name: str, i: int) -> DataFrame:
        model = estimators()[name].fit(data.where(F.col("fold") != i))
        return predict(model, data.where(F.col("fold") == i), key, "label", "fold").withColumn("model", F.lit(name))

    parts = together(df, [lambda n=n, i=i: part(n, i) for n in estimators() for i in range(k)])
    return staged(reduce(DataFrame.unionByName, parts), "oof")


def fold_measures(oof: DataFrame) -> DataFrame:
    """model, oof_auc, mean_fold_auc, std_fold_auc."""
    folds = auc(oof, ["model", "fold"]).groupBy("model").agg(F.avg("auc").alias("mean_fold_auc"), F.stddev_pop("auc").alias("std_fold_auc"))
    return auc(oof, ["model"]).withColumnRenamed("auc", "oof_auc").join(folds, "model")


def wide(oof: DataFrame, key: str) -> DataFrame:
    """A column of scores for each model."""
    return oof.groupBy(key, "label").pivot("model", sorted(estimators())).agg(F.first("score"))


def blend(scores: DataFrame, key: str, models: list[str]) -> DataFrame:
    """key, label, score: the mean of the models' probabilities."""
    return scores.select(key, "label", (sum((F.col(m) for m in models), F.lit(0.0)) / len(models)).alias("score"))


def blend_measures(scores: DataFrame, models: list[str]) -> DataFrame:
    """auc of the blend, of the best model alone, and the difference."""
    long = scores.select("label", F.explode(F.array(*[F.struct(F.lit(m).alias("model"), F.col(m).alias("score")) for m in models], F.struct(F.lit("blend").alias("model"), (sum((F.col(m) for m in models), F.lit(0.0)) / len(models)).alias("score")))).alias("x")).select("label", "x.model", "x.score")
    each = auc(long, ["model"])
    return each.agg(F.max(F.when(F.col("model") == "blend", F.col("auc"))).alias("blend_auc"), F.max(F.when(F.col("model") != "blend", F.col("auc"))).alias("best_auc")).withColumn("gain", F.col("blend_auc") - F.col("best_auc"))


def stack(oof: DataFrame, key: str, k: int = 3) -> DataFrame:
    """model, mean and deviation of fold AUCs, train AUC of meta-models over the models' out-of-fold scores."""
    models = sorted(estimators())
    data = staged(wide(oof, key).dropna(), "stack-rows")
    cv = fold_measures(out_of_fold(data, models, key, k)).select("model", "mean_fold_auc", "std_fold_auc")
    fit = staged(assembled(data, models).select("label", "features"), "stack-fit")
    train = together(oof, [lambda n=n, e=e: predict(e.fit(fit), fit, "label").withColumn("model", F.lit(n)) for n, e in estimators().items()])
    return cv.join(auc(reduce(DataFrame.unionByName, train), ["model"]).withColumnRenamed("auc", "train_auc"), "model")


def calibrate(oof: DataFrame, key: str, k: int = 3) -> DataFrame:
    """key, label, fold, score, calibrated: a sigmoid of the score, fitted on the folds that the row isn't in."""
    data = staged(assembled(stratified_folds(oof.select(key, "label", "score"), key, "label", k).withColumn("x", F.col("score")), ["x"]), "calibration")

    def part(i: int) -> DataFrame:
        model = LogisticRegression(labelCol="label", maxIter=50, tol=1e-9).fit(data.where(F.col("fold") != i))
        return model.transform(data.where(F.col("fold") == i)).select(key, "label", "fold", "score", vector_to_array("probability")[1].alias("calibrated"))

    return reduce(DataFrame.unionByName, together(oof, [lambda i=i: part(i) for i in range(k)]))


def reliability(calibrated: DataFrame, bins: int = 10) -> DataFrame:
    """score (raw or calibrated), bin, rows, mean_score, positive_share, brier: bins of equal width, and brier over all rows of that score."""
    each = calibrated.select("label", F.explode(F.create_map(F.lit("raw"), F.col("score").cast("double"), F.lit("calibrated"), F.col("calibrated"))).alias("score", "value"))
    at = F.least(F.lit(bins - 1), F.greatest(F.lit(0), F.floor(F.col("value") * bins))).cast("int")
    found = each.groupBy("score", at.alias("bin")).agg(F.count("*").alias("rows"), F.avg("value").alias("mean_score"), F.avg(F.col("label").cast("double")).alias("positive_share"), F.sum(F.pow(F.col("value") - F.col("label"), 2)).alias("_loss"))
    over = W.partitionBy("score")  # a row for each bin
    return found.withColumn("brier", F.sum("_loss").over(over) / F.sum("rows").over(over)).drop("_loss")


#: Penalties that select_l1 tries, each half a decade below the one before.
PENALTIES = tuple(10 ** (-i / 2) for i in range(2, 9))


def select_l1(df: DataFrame, features: list[str], key: str, penalties: tuple[float, ...] = PENALTIES, k: int = 3, least: int = 10) -> DataFrame:
    """feature, weight, kept, penalty: by the size of L1 regression weights, from the median up.

    The penalty is the one with the least mean squared error over k folds, stratified by label; weights are of standardised
    features. If fewer than `least` features reach the median, half of it is enough.
    """
    data = staged(assembled(stratified_folds(df, key, "label", k), features).select("label", "fold", "features"), "l1-rows")
    lasso = LinearRegression(labelCol="label", elasticNetParam=1.0, maxIter=200, tol=1e-10, solver="normal")
    grid = ParamGridBuilder().addGrid(lasso.regParam, list(penalties)).build()
    best = CrossValidator(estimator=lasso, estimatorParamMaps=grid, evaluator=RegressionEvaluator(labelCol="label", metricName="mse"), numFolds=k, foldCol="fold", parallelism=PARALLEL).fit(data).bestModel
    spread = data.select(*[F.stddev_samp(vector_to_array("features")[i]).alias(str(i)) for i in range(len(features))]).first()
    weights = best.coefficients.toArray() * np.array([spread[i] or 0.0 for i in range(len(features))])
    bound = float(np.median(np.abs(weights)))
    if (np.abs(weights) >= bound).sum() < min(least, len(features)):
        bound /= 2
    penalty = float(best.getRegParam())
    return df.sparkSession.createDataFrame([(f, float(w), bool(abs(w) >= bound), penalty) for f, w in zip(features, weights)], "feature string, weight double, kept boolean, penalty double")


def sweep(df: DataFrame, features: list[str], key: str, tries: int = 4, folds: int = 3, seed: int = 3) -> DataFrame:
    """trial, reg_param, elastic_net, auc, best: seeded random parameters of a logistic regression, by mean AUC over stratified folds."""
    rng = np.random.default_rng(seed)
    data = staged(assembled(stratified_folds(df, key, "label", folds), features).select("label", "fold", "features"), "sweep-rows")
    drawn = [(float(10 ** rng.uniform(-4, 0)), float(rng.uniform())) for _ in range(tries)]

    def part(i: int, k: int) -> DataFrame:
        reg, net = drawn[i]
        model = LogisticRegression(labelCol="label", maxIter=15, regParam=reg, elasticNetParam=net).fit(data.where(F.col("fold") != k))
        return predict(model, data.where(F.col("fold") == k), "label").withColumns({"trial": F.lit(i), "reg_param": F.lit(reg), "elastic_net": F.lit(net), "fold": F.lit(k)})

    parts = together(df, [lambda i=i, k=k: part(i, k) for i in range(tries) for k in range(folds)])
    names = ["trial", "reg_param", "elastic_net"]
    found = auc(reduce(DataFrame.unionByName, parts), [*names, "fold"]).groupBy(*names).agg(F.avg("auc").alias("auc"))
    return found.withColumn("best", F.row_number().over(W.orderBy(F.desc("auc"), "trial")) == 1)  # one row for each trial


def permuted(df: DataFrame, features: list[str], key: str, seed: int = 5) -> DataFrame:
    """df with `swapped`: feature -> the value that another row has, each feature dealt anew by a hash of key, seed and its name.

    The rows' numbers in the order of one hash meet the numbers in the order of another; all features take the same shuffles.
    """
    named = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features])).alias("x")
    given = df.select(F.col(key).alias("_key"), named).select("_key", "x.feature", "x.value")
    tagged = lambda salt: F.concat_ws("|", F.col("_key").cast("string"), F.col("feature"), F.lit(f"{salt}{seed}"))
    values = numbered_by_hash(given.withColumn("_hash", tagged("from")), "_hash", ["feature"]).select("feature", "_at", "value")
    takers = numbered_by_hash(given.withColumn("_hash", tagged("to")), "_hash", ["feature"]).select("feature", "_at", "_key")
    swaps = takers.join(values, ["feature", "_at"]).groupBy("_key").agg(F.map_from_entries(F.collect_list(F.struct("feature", "value"))).alias("swapped"))
    return df.join(swaps, df[key].eqNullSafe(swaps["_key"])).drop("_key")


def importance_of(model, df: DataFrame, features: list[str], key: str, seed: int = 5) -> DataFrame:
    """feature, auc, permuted_auc, importance: how far the AUC falls when the feature's values are dealt anew. key tells rows apart.

    Every row is scored as it is and once for each feature, in one pass.
    """
    rows = staged(permuted(df.select(key, "label", *features), features, key, seed), "permuted")
    value = lambda f: F.when(F.col("feature") == f, F.col("swapped")[f]).otherwise(F.col(f).cast("double")).alias(f)
    wide_rows = rows.withColumn("feature", F.explode(F.array(F.lit(""), *map(F.lit, features)))).select("label", "feature", *map(value, features))
    found = auc(predict(model, assembled(wide_rows, features), "label", "feature"), ["feature"])
    base = found.where("feature = ''").select(F.col("auc").alias("base"))
    return found.where("feature <> ''").crossJoin(F.broadcast(base)).select("feature", F.col("base").alias("auc"), F.col("auc").alias("permuted_auc"), (F.col("base") - F.col("auc")).alias("importance"))  # one row


def importance(df: DataFrame, features: list[str], key: str, seed: int = 5) -> DataFrame:
    """feature, auc, permuted_auc, importance, impurity: a forest on the training part, measured on the test part; impurity: what the forest's splits on the feature remove."""
    fit, test = sample_split(df, key)
    model = estimators()["forest"].fit(assembled(fit, features))
    impurity = df.sparkSession.createDataFrame(list(zip(features, map(float, model.featureImportances.toArray()))), "feature string, impurity double")
    return importance_of(model, test, features, key, seed).join(F.broadcast(impurity), "feature")


def measures(preds: DataFrame, by: list[str]) -> DataFrame:
    return auc(preds, by).join(accuracy(preds, by), by)
