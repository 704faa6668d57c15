"""Training jobs against numpy and plain loops."""

from __future__ import annotations

import hashlib
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_DIR
from tickerloom.operators import models as L
from tickerloom.operators import table as O
from tickerloom.operators.metrics import auc
from tickerloom.plans import QUERIES


@pytest.fixture(scope="module")
def rows(spark):
    """Two features that matter, one that doesn't, one that is constant; classes 3 to 7."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 4))
    x[:, 3] = 2.0
    y = (2 * x[:, 0] - x[:, 1] + rng.normal(size=600) > 0.9).astype(int)
    return pd.DataFrame({"id": [f"r{i}" for i in range(600)], "day": np.arange(600) // 3, "label": y, "a": x[:, 0] * 5, "b": x[:, 1], "c": x[:, 2], "d": x[:, 3]})


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows).repartition(4).cache()


def brute_auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    return ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))


def test_stack_and_sweep(spark):
    began = time.time()
    out = QUERIES["ml_stack"](spark, SF_DIR).collect()
    assert sorted(r.model for r in out) == ["boosted", "forest", "logistic"] and all(0.4 < r.mean_fold_auc <= r.train_auc + 0.2 for r in out)
    assert time.time() - began < 240
    trials = QUERIES["ml_param_sweep"](spark, SF_DIR).collect()
    assert len(trials) == 4 and sum(r.best for r in trials) == 1


def test_out_of_fold_rows_are_scored_by_the_other_folds(df, rows):
    oof = L.out_of_fold(df, ["a", "b"], "id", 3).where("model = 'logistic'").toPandas().set_index("id")
    assert len(oof) == 600 and oof.groupby("fold").label.mean().between(rows.label.mean() - 0.01, rows.label.mean() + 0.01).all()
    assert brute_auc(oof.label.to_numpy(), oof.score.to_numpy()) > 0.9


def coordinate_descent(x, y, penalty):
    """Least squares with an L1 penalty on standardised columns; weights of those and the intercept."""
    mean, spread = x.mean(0), x.std(0, ddof=1)
    z = (x - mean) / np.where(spread > 0, spread, 1)
    w, r = np.zeros(x.shape[1]), y - y.mean()
    for _ in range(500):
        for j in range(x.shape[1]):
            if spread[j] > 0:
                r += z[:, j] * w[j]
                g, h = z[:, j] @ r / len(y), z[:, j] @ z[:, j] / len(y)
                w[j] = np.sign(g) * max(0, abs(g) - penalty) / h
                r -= z[:, j] * w[j]
    return w, lambda q: y.mean() + ((q - mean) / np.where(spread > 0, spread, 1)) @ w


def test_l1_by_cross_validation_is_coordinate_descent(df, rows):
    names = ["a", "b", "c", "d"]
    fold = O.stratified_folds(df, "id", "label", 3).select("id", "fold").toPandas().set_index("id").fold
    x, y, f = rows[names].to_numpy(), rows.label.to_numpy(float), fold[rows.id].to_numpy()
    error = {}
    for penalty in L.PENALTIES:
        parts = []
        for k in range(3):
            _, predict = coordinate_descent(x[f != k], y[f != k], penalty)
            parts.append(((predict(x[f == k]) - y[f == k]) ** 2).mean())
        error[penalty] = np.mean(parts)
    best = min(error, key=error.get)
    weights, _ = coordinate_descent(x, y, best)
    bound = np.median(np.abs(weights)) / (2 if (np.abs(weights) >= np.median(np.abs(weights))).sum() < 4 else 1)
    got = {r.feature: r for r in L.select_l1(df, names, "id").collect()}
    assert {r.penalty for r in got.values()} == {best}
    assert [got[n].weight for n in names] == pytest.approx(weights.tolist(), abs=1e-4)
    assert [got[n].kept for n in names] == (np.abs(weights) >= bound).tolist()


def test_pooled_model_stops_early(df):
    got = {r.part: r for r in L.train_pooled(df, ["a", "b", "c"], "id", ["day", "id"], most=40).collect()}
    assert set(got) == {"train", "val", "test"} and got["val"].auc > 0.85
    losses = got["val"].losses
    assert 1 < got["val"].trees == len(losses) < 40 and min(losses) == losses[-1] and len({r.trees for r in got.values()}) == 1


def test_permutation_importance(spark, df, rows):
    """Each feature's values are those of the other rows, dealt out; the AUCs are those of plain loops over them."""
    names = ["a", "b", "c"]
    swapped = L.permuted(df, names, "id").select("id", "swapped").toPandas().set_index("id").swapped[rows.id]
    for n in names:
        values = np.array([s[n] for s in swapped])
        assert sorted(values) == pytest.approx(sorted(rows[n])) and (values == rows[n].to_numpy()).mean() < 0.05
    want = sorted(rows.id, key=lambda i: hashlib.md5(f"{i}|a|to5".encode()).hexdigest())
    given = sorted(rows.id, key=lambda i: hashlib.md5(f"{i}|a|from5".encode()).hexdigest())
    assert [swapped[i]["a"] for i in want] == rows.set_index("id").a[given].tolist()
    fit = L.assembled(df, names)
    model = L.estimators()["logistic"].fit(fit)
    logit = lambda x: x @ model.coefficients.toArray()
    x, y = rows[names].to_numpy(), rows.label.to_numpy()
    got = {r.feature: r for r in L.importance_of(model, df, names, "id").collect()}
    for j, n in enumerate(names):
        z = x.copy()
        z[:, j] = [s[n] for s in swapped]
        assert got[n].auc == pytest.approx(brute_auc(y, logit(x))) and got[n].permuted_auc == pytest.approx(brute_auc(y, logit(z)))
    assert got["a"].importance > got["b"].importance > 0.03 > abs(got["c"].importance)


def test_calibration_is_fitted_on_other_folds(spark, rows):
    """Raw scores that are far too sure: the sigmoid mends them, and each row's comes from the folds that it isn't in."""
    score = 1 / (1 + np.exp(-(3 * rows.a / 5 * 4 - 6 * rows.b)))
    given = spark.createDataFrame(rows[["id", "label"]].assign(score=score))
    got = L.calibrate(given, "id")
    frame = got.toPandas()
    assert len(frame) == 600
    for k in range(3):
        inside, outside = frame[frame.fold == k], frame[frame.fold != k]
        w = np.zeros(2)
        x, y = np.c_[outside.score, np.ones(len(outside))], outside.label.to_numpy()
        for _ in range(50):
            p = 1 / (1 + np.exp(-x @ w))
            w -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x, x.T @ (p - y))
        assert np.allclose(inside.calibrated, 1 / (1 + np.exp(-np.c_[inside.score, np.ones(len(inside))] @ w)), atol=1e-4)
    bins = L.reliability(got).toPandas()
    brier = bins.groupby("score").brier.first()
    assert brier["calibrated"] < brier["raw"] and brier["raw"] == pytest.approx(((frame.score - frame.label) ** 2).mean())
    assert bins.groupby("score").rows.sum().tolist() == [600, 600]


def test_stratified_split(spark, rows):
    given = spark.createDataFrame([(i, "abcd"[min(3, i % 7)] if i % 11 else None) for i in range(500)], "id long, kind string")
    got = L.stratified_split(given, "id", "kind", 0.8).toPandas()
    shares = got.fillna("-").groupby("kind").train.agg(["sum", "count"])
    assert len(shares) == 5 and (abs(shares["sum"] - shares["count"] * 0.8) <= 0.5).all()


def test_auc_evaluates_its_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(x):
        seen.add(1)
        return x

    scores = spark.range(300, numPartitions=3).select(F.udf(count, "double")(F.col("id") / 300.0).alias("score"), (F.col("id") % 2).alias("label"))
    assert auc(scores, []).first().auc == pytest.approx(0.5, abs=0.01) and seen.value == 300
