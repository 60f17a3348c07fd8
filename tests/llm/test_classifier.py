"""Weak labels: recovered accuracies, held-out accuracy against labels, edge cases."""

import duckdb
import numpy as np
import pytest
from marketloom.llm import classifier

SF = "/root/testdata/sf0.01"


def test_accuracies_are_recovered():
    rng = np.random.default_rng(3)
    truth = rng.random(20_000) < 0.7
    accuracy = np.array([0.9, 0.8, 0.7, 0.85])
    right = rng.random((len(truth), 4)) < accuracy
    votes = np.where(rng.random((len(truth), 4)) < 0.3, 0, np.where(truth[:, None] == right, 2, 1))
    patterns, which, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    posterior, found = classifier.expectation_maximisation(patterns, counts.astype(float))
    assert np.abs(found - accuracy).max() < 0.03
    assert ((posterior[which.ravel()] > 0.5) == truth).mean() > 0.9


def test_scorer_learns_soft_targets():
    rng = np.random.default_rng(4)
    columns = rng.integers(0, 50, (400, 5))
    target = np.where((columns < 10).any(1), 0.1, 0.9)
    bounds = np.arange(0, 2001, 5)
    weights = classifier.fit(bounds, columns.ravel(), np.ones(2000), target, 64, epochs=60)
    z = weights[columns].sum(1) + weights[-1]
    assert ((z > 0) == (target > 0.5)).mean() > 0.97


def test_agrees_with_labels(spark):
    """On form: junk goes, clean documents stay."""
    out = classifier.classify(spark.read.parquet(f"{SF}/documents.parquet")).toPandas()
    labels = duckdb.sql(f"select doc_id, quality as label, toxic from '{SF}/labels.parquet'").df()
    both = out.merge(labels, on="doc_id")
    assert len(out) == 1000
    assert both[(both.label == 1) & (both.toxic == 0)].kept.mean() > 0.98
    assert both[both.label == 0].kept.mean() < 0.1


def test_edge_cases(spark):
    docs = spark.createDataFrame(
        [(1, None, 1), (2, "", 1), (None, "one two", 1), (3, "x " * 5000, 1), (3, "x " * 5000, 1)], "doc_id long, text string, kept int"
    )
    rows = classifier.classify(docs).collect()
    assert len(rows) == 5 and len({tuple(r)[1:] for r in rows if r.doc_id == 3}) == 1
    assert all(r.votes and 0 <= r.quality <= 1 for r in rows)
    assert classifier.classify(docs.filter("doc_id > 7")).count() == 0
    again = classifier.classify(docs).collect()
    assert [r.quality_score for r in sorted(rows, key=repr)] == pytest.approx([r.quality_score for r in sorted(again, key=repr)])


def test_recall_of_toxic_documents_per_language(spark):
    """Words are learned from the labels of even ids; documents of odd ids are new to them."""
    folder = SF.replace("0.01", "0.1")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    out = classifier.classify(docs, labels=labels.filter("doc_id % 2 = 0")).toPandas()
    truth = duckdb.sql(f"select doc_id, lang, quality as label, toxic from '{folder}/labels.parquet' join '{folder}/documents.parquet' using (doc_id)").df()
    both = out.merge(truth[truth.doc_id % 2 == 1], on="doc_id")
    bad = both.manners < 0.5
    for lang in ("en", "de", "fr", "es"):
        own = both.lang == lang
        assert bad[own & (both.toxic == 1)].mean() > 0.85, lang
        assert bad[own & (both.toxic == 0) & (both.label == 1)].mean() < 0.03, lang


def test_abuse_is_found_between_punctuation_and_silence_is_not_good(spark):
    docs = spark.createDataFrame(
        [(1, '"Idiot!" (moron) plain', "en"), (2, "plain words only", "en"), (3, "nur gute Worte", "de")], "doc_id long, text string, lang string"
    )
    votes = {r.doc_id: r.votes[7:10] for r in classifier.classify(docs).collect()}
    assert votes == {1: "111", 2: "222", 3: "000"}
