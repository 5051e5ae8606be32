"""Queries whose jobs run at the operators' full size."""

import inspect

from checks import ml_queries
from roadlens.ml import training


def test_risk_comparison_fits_models_of_full_size(spark, monkeypatch):
    asked = {}

    def seen(*args, **kwargs):
        asked.update(inspect.signature(job).bind(*args, **kwargs).arguments)
        return []

    job = training.train_risk
    monkeypatch.setattr(training, "train_risk", seen)
    monkeypatch.setattr(training, "comparison", lambda *a: None)
    monkeypatch.setattr(ml_queries, "view", lambda *a: None)
    ml_queries.risk_comparison(spark, "nowhere")
    asked.pop("roads")
    assert asked == {"key": "event_id", "no_leak": True}
