"""Boosting that stops on AUC, and candidates that are fitted together."""

import json

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import functions as F

from ledgerlens.plans import training

INPUTS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(8)
    rows = []
    for i in range(900):
        a, b, c = rng.normal(), rng.normal(), rng.integers(0, 5)
        odds = 1 / (1 + np.exp(-(1.2 * a - 0.8 * b - 1.5)))
        rows.append((i, int(rng.random() < odds), "train" if i < 500 else "validation" if i < 700 else "test", float(a), float(b), float(c)))
    return spark.createDataFrame(rows, "TransactionID bigint, isFraud int, split string, a double, b double, c double")


def plain_auc(y, p):
    better = (p[y == 1][:, None] > p[y == 0][None, :]).mean()
    return better + (p[y == 1][:, None] == p[y == 0][None, :]).mean() / 2


def test_boosting_stops_on_auc_not_on_loss(spark, table):
    vectors = training.assembled(table, INPUTS)
    trained = training.fit_vectors(vectors, INPUTS, patience=4, maxIter=12, stepSize=0.2, maxDepth=2)
    full = training.classifier("gbt", maxIter=12, stepSize=0.2, maxDepth=2).fit(vectors.where("split = 'train'"))
    validation = vectors.where("split = 'validation'")
    losses = full.evaluateEachIteration(validation)
    aucs = []
    for rounds in range(1, len(trained.auc_by_round) + 1):
        rows = training.score(validation, training.Trained(training.PipelineModel([training.first_trees(full, rounds)]), INPUTS)).toPandas()
        aucs.append(plain_auc(rows["isFraud"].to_numpy(), rows["fraud_probability"].to_numpy()))
    assert np.allclose(trained.auc_by_round, aucs)
    best = int(np.argmax(aucs)) + 1
    assert trained.best_round == best and len(aucs) == min(best + 4, 12)
    assert best != int(np.argmin(losses[: len(aucs)])) + 1  # the loss would have stopped elsewhere
    model: GBTClassificationModel = trained.model.stages[-1]
    assert model.getNumTrees == best and len(model.featureImportances.toArray()) == len(INPUTS)


def test_a_cut_model_is_the_shorter_fit(spark, table, tmp_path):
    vectors = training.assembled(table, INPUTS)
    long = training.classifier("gbt", maxIter=8).fit(vectors.where("split = 'train'"))
    short = training.classifier("gbt", maxIter=3).fit(vectors.where("split = 'train'"))
    cut = training.first_trees(long, 3)
    cut.write().save(str(tmp_path / "model"))
    again = GBTClassificationModel.load(str(tmp_path / "model"))
    want = [tuple(r["probability"]) for r in short.transform(vectors).orderBy("TransactionID").collect()]
    for model in (cut, again):
        assert np.allclose([tuple(r["probability"]) for r in model.transform(vectors).orderBy("TransactionID").collect()], want)


def test_best_round():
    assert training.best_round([0.5, 0.7, 0.6, 0.7]) == 2
    assert training.best_round([0.5, 0.7, 0.6], 2) is None
    assert training.best_round([0.5, 0.7, 0.6, 0.7], 2) == 2
    assert training.best_round([0.6, 0.5, 0.5, 0.9], 2) == 1


def test_empty_splits_are_refused(table):
    with pytest.raises(ValueError, match="empty"):
        training.train_model(table.where("split = 'train'"), INPUTS)
    with pytest.raises(ValueError, match="empty"):
        training.train_model(table.where("split <> 'train'"), INPUTS, "logistic")


def test_candidates_are_assembled_once_and_fitted_together(spark, table, monkeypatch):
    calls = []
    monkeypatch.setattr(training, "assembled", lambda t, i, real=training.assembled: calls.append(1) or real(t, i))
    times = {}

    def fit(vectors, inputs, family="gbt", weight=None, real=training.fit_vectors, **params):
        import time

        begun = time.time()
        result = real(vectors, inputs, family, weight, **params)
        times[weight] = (begun, time.time())
        return result

    monkeypatch.setattr(training, "fit_vectors", fit)
    scored = training.weight_search(table, INPUTS, [1.0, 3.0, 5.0], maxIter=3)
    assert len(calls) == 1
    spans = sorted(times.values())
    assert len(spans) == 3 and spans[1][0] < spans[0][1] and spans[2][0] < spans[0][1]
    counts = {(r["scale_pos_weight"], r["split"]): r["n"] for r in scored.groupBy("scale_pos_weight", "split").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert counts == {(w, s): 200 for w in (1.0, 3.0, 5.0) for s in ("validation", "test")}
    assert json.dumps(sorted(r["candidate"] for r in scored.select("candidate").distinct().collect())) == '["weight_1", "weight_3", "weight_5"]'
