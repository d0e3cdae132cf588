"""Every registered query against its SQL on the smallest tables; the others by their invariants."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from ledgerlens.catalog import registry
from tests.conftest import SMALL
from tools.check_queries import compare, connect

QUERIES = registry.load()
CHECKED = [k for k, q in QUERIES.items() if q.sql is not None]


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("key", CHECKED)
def test_query_equals_sql(spark, duck, key):
    assert compare(QUERIES[key].run(spark, SMALL), duck, QUERIES[key].sql) is None


def test_the_others_are_few():
    """Measures of trained models; the parts of these that don't depend on the trainer have SQL under the key itself."""
    assert {k for k, q in QUERIES.items() if q.sql is None} == {
        "batch_score_probabilities",
        "train_gbt_metrics",
        "weight_search_metrics",
        "model_family_policies",
        "train_pipeline_metrics",
        "feature_importance_values",
    }


def test_sample_is_repeatable(spark):
    run = QUERIES["sample_rows"].run
    first, second = run(spark, SMALL).collect(), run(spark, SMALL).collect()
    assert first == second and len(first) == 20


def test_fingerprint_ignores_order_and_sees_changes(spark):
    from ledgerlens.sources.files import dataset_fingerprint

    df = spark.range(1000).selectExpr("id", "id * 2 AS v")
    one = dataset_fingerprint(df, "t").first()
    assert dataset_fingerprint(df.orderBy("v", ascending=False).repartition(7), "t").first() == one
    assert dataset_fingerprint(df.selectExpr("id", "IF(id = 5, 0, v) AS v"), "t").first() != one
    assert dataset_fingerprint(df.union(df.where("id < 2")), "t").first() != one


def test_batch_scores_are_probabilities(spark):
    scored = QUERIES["batch_score_probabilities"].run(spark, SMALL).collect()
    assert len(scored) == 1000
    assert all(0.0 <= r["fraud_probability"] <= 1.0 for r in scored)


def test_trained_model_ranks_better_than_chance(spark):
    metrics = {r["split"]: r for r in QUERIES["train_gbt_metrics"].run(spark, SMALL).collect()}
    assert set(metrics) == {"train", "validation", "test"}
    assert metrics["train"]["roc_auc"] > 0.6


def test_unavailable_family_is_marked_skipped(spark):
    rows = QUERIES["model_family_policies"].run(spark, SMALL).collect()
    assert {r["status"] for r in rows if r["candidate"] == "other_library"} == {"skipped"}
    assert {r["candidate"] for r in rows if r["status"] == "trained"} == {"gbt_default", "forest_default", "logistic_default"}


@pytest.mark.parametrize("with_pipeline", [False, True])
def test_entry_works_without_the_text_package(tmp_path, with_pipeline):
    repo = Path(__file__).resolve().parents[1]
    shutil.copytree(repo / "ledgerlens", tmp_path / "ledgerlens", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ["__spark_entry__.py", *["corpus_pipeline.py"] * with_pipeline]:
        if (repo / name).exists():
            shutil.copy(repo / name, tmp_path)
    code = "import __spark_entry__ as e; print(sorted(e.queries()) == sorted(e.queries() | e.oracle_sql()), len(e.queries()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert out.stdout.split() == ["True", str(len(QUERIES))], out.stderr


def test_entry_runs():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
