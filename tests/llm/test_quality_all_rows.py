"""every labelled row makes the model of quality."""

import numpy as np

from tallyline.llm import quality


def test_ranked_is_exact(spark, monkeypatch):
    monkeypatch.setattr(quality, "HELD_SCORES", 5)
    values = sorted(float(v) for v in np.random.default_rng(3).normal(0, 1, 400).round(2))
    df = spark.createDataFrame([(v,) for v in values], "score double")
    assert [quality.ranked(df, k) for k in (0, 200, 398, 399)] == [values[k] for k in (0, 200, 398, 399)]


def test_all_labelled_rows_count(spark, small, monkeypatch):
    """However few rows the trees are drawn from, all good ones are in their leaves
    and set the threshold."""
    monkeypatch.setattr(quality, "LABELLED_ROWS", 20, raising=False)
    monkeypatch.setattr(quality, "DRAWN_ROWS", 20, raising=False)
    documents, labels = spark.read.parquet(f"{small}/documents.parquet"), spark.read.parquet(f"{small}/labels.parquet")
    seen = []
    monkeypatch.setattr(quality, "weighed", lambda forest, masses, rows: seen.append((len(forest.roots), masses.sum(), rows)) or forest, raising=False)
    forest = quality.fit(documents, labels)
    judged = quality.judge(documents.join(labels.where("quality > 0").select("doc_id"), "doc_id", "left_semi"), forest).where("NOT base_failed").collect()
    assert seen == [(quality.TREES, quality.TREES * len(judged), len(judged))] and len(judged) > 20
    assert sum(not r.kept for r in judged) <= quality.GOOD_REJECTED * len(judged) + 1
