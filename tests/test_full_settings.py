"""The registered model queries run their jobs at the full settings."""

import inspect

import pytest

from tallyloom.plans import jobs, queries

FULL = {
    "grid_scores": ("grid_scores", {"folds": 5}),
    "best_candidates": ("grid_scores", {"folds": 5}),
    "svc_scores": ("grid_scores", {"folds": 5}),
    "profit_metrics": ("profit_model", {"rounds": 687, "depth": 2}),
    "profit_predictions": ("profit_model", {"rounds": 687, "depth": 2}),
    "profit_importances": ("profit_model", {"rounds": 687, "depth": 2}),
    "profit_early_stop_metrics": ("profit_model_early_stop", {"rounds": 1000, "depth": 4}),
    "profit_grid": ("profit_grid", {"depths": (2, 3, 4, 5), "rates": (0.04, 0.05), "rounds": 687, "folds": 3}),
    "ship_mode_scores": ("ship_mode_model", {"rounds": 1000, "depth": 2}),
    "ship_mode_metadata": ("ship_mode_model", {"rounds": 1000, "depth": 2}),
    "ship_mode_importances": ("ship_mode_model", {"rounds": 1000, "depth": 2}),
    "ship_mode_balanced_scores": ("ship_mode_model", {"rounds": 1900, "depth": 7, "rate": 0.04, "balance": True}),
    "ship_mode_rounds": ("ship_mode_rounds", {"rounds": (500, 1000, 1900), "depth": 7, "folds": 3}),
}


class Called(Exception):
    pass


@pytest.mark.parametrize("name", sorted(FULL))
def test_full_settings(monkeypatch, name):
    job, full = FULL[name]
    told = inspect.signature(getattr(jobs, job))

    def called(*given, **named):
        bound = told.bind(*given, **named)
        bound.apply_defaults()
        raise Called(bound.arguments)

    monkeypatch.setattr(jobs, job, called)
    with pytest.raises(Called) as stop:
        getattr(queries, name)(None)
    used = stop.value.args[0]
    assert {k: used[k] for k in full} == full
