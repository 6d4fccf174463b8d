"""Positive-unlabelled learning: the risk, held-out accuracy, and odd inputs."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigilmart.llm import toxicity


def test_risk_slope_equals_differences():
    chance = np.random.default_rng(1)
    scores, positive = chance.normal(size=40), (np.arange(40) < 12).astype(float)
    risk, slope = toxicity.risk_step(scores, positive, 0.1)
    for i in range(40):
        moved = scores.copy()
        moved[i] += 1e-6
        assert (toxicity.risk_step(moved, positive, 0.1)[0] - risk) / 1e-6 == pytest.approx(slope[i], abs=1e-4)


def test_negative_clean_risk_is_not_followed_down():
    scores, positive = np.array([5.0, 5.0, -5.0]), np.array([1.0, 1.0, 0.0])
    risk, slope = toxicity.risk_step(scores, positive, 0.5)
    assert risk == pytest.approx(0.5 * np.logaddexp(0, -5.0))
    assert slope[2] < 0  # pushes the clean risk up again


def test_held_out_accuracy(spark):
    root = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{root}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{root}/labels.parquet")
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    test = scored.join(labels, "doc_id").where(toxicity.held_out(F.col("doc_id")))
    hits = test.agg(
        F.avg(F.when(F.col("toxic") == 1, F.col("predicted"))).alias("recall"),
        F.avg(F.when(F.col("predicted") == 1, F.col("toxic"))).alias("precision"),
    ).first()
    assert hits["recall"] > 0.85
    assert hits["precision"] > 0.9


def test_labels_of_held_out_rows_teach_nothing(spark, docs):
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2]
    texts = docs(*[(i, "vile words" if i in ids else "fine text") for i in range(400)])
    labels = spark.createDataFrame([(i, 1) for i in ids], "doc_id bigint, toxic int")
    assert toxicity.fit(texts, labels).weights == {}


def test_nulls_repeats_empty_texts_and_no_rows(spark, docs):
    rows = [(i, "vile thing" if i % 5 == 0 else "fine thing") for i in range(300)]
    texts = docs(*rows, (None, "vile"), (301, None), (302, ""), (303, "word " * 30000), (0, "vile thing")).withColumn(
        "score", F.lit("mine")
    )
    labels = spark.createDataFrame(
        [(i, int(i % 5 == 0)) for i in range(300)] + [(None, 1), (5, None), (5, 1)], "doc_id bigint, toxic int"
    )
    model = toxicity.fit(texts, labels)
    found = {r["doc_id"]: r for r in toxicity.score(texts, model).collect()}
    assert found[5]["predicted"] == 1 and found[1]["predicted"] == 0
    assert found[301]["score"] == found[302]["score"] and 0 <= found[301]["score"] <= 1
    assert found[None]["predicted"] == 1
    assert toxicity.score(texts, model).count() == 305
    none = labels.where("false")
    assert toxicity.score(texts.where("false"), toxicity.fit(texts.where("false"), none)).count() == 0


def test_a_toxic_word_outside_the_sample_is_known(spark, docs, monkeypatch):
    monkeypatch.setattr(toxicity, "MOST_POSITIVE", 40)
    monkeypatch.setattr(toxicity, "MOST_UNLABELLED", 200)
    toxic = [(i, f"vile thing number {i} said" if i % 30 else f"grubby remark number {i} said") for i in range(0, 3000, 3)]
    clean = [(i, f"kind remark thing number {i} said") for i in range(3000) if i % 3]
    labels = spark.createDataFrame([(i, 1) for i, _ in toxic] + [(i, 0) for i, _ in clean], "doc_id bigint, toxic int")
    texts = docs(*toxic, *clean)
    sampled = []
    train = toxicity.train

    def seen(rows, positive, n_features, prior):
        sampled.append(len(rows))
        return train(rows, positive, n_features, prior)

    monkeypatch.setattr(toxicity, "train", seen)
    model = toxicity.fit(texts, labels)
    assert sampled == [240]
    assert model.weights["grubby"] > 0 and model.weights["vile"] > 0 and "kind" not in model.weights
    found = {r["doc_id"]: r["predicted"] for r in toxicity.score(texts, model).collect()}
    assert all(found[i] == 1 for i, t in toxic) and not any(found[i] for i, _ in clean)


def test_both_ways_to_the_labels_agree(spark, docs, monkeypatch):
    rows = [(i, f"vile thing {i}" if i % 5 == 0 else f"fine thing {i}") for i in range(300)]
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(300)], "doc_id bigint, toxic int")
    sent = toxicity.fit(docs(*rows), labels)
    monkeypatch.setattr(toxicity, "MOST_SENT", 0)
    assert toxicity.fit(docs(*rows), labels) == sent
