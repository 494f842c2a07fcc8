"""The registered model queries run the operators' whole default job."""

from types import SimpleNamespace

from assay.operators.models import Budget
from assay.queries import modelling


def test_model_queries_use_default_budget_samples_and_replans(monkeypatch):
    calls = {}

    def noted(name):
        def call(*args, **kw):
            calls[name] = (args, kw)
            return SimpleNamespace(board=None, tables={"report": None, "notes": None})
        return call

    task = SimpleNamespace()
    monkeypatch.setattr(modelling, "quality_table", lambda spark, folder: SimpleNamespace(dropDuplicates=lambda: None))
    monkeypatch.setattr(modelling.training, "with_row_key", lambda df: df)
    monkeypatch.setattr(modelling.training, "class_labels", lambda df, name: ["0", "1"])
    monkeypatch.setattr(modelling.training, "split", lambda df, task, share: (df, df))
    assert modelling._quality_task(None, None)[0].budget == Budget()
    monkeypatch.setattr(modelling, "_price_task", lambda spark, folder: (task, None, None))
    for name in ("train_models", "random_search", "tune"):
        monkeypatch.setattr(modelling.training, name, noted(name))
    monkeypatch.setattr(modelling, "run_auto_model", noted("auto"))
    for query, operator in ((modelling.random_search, "random_search"), (modelling.tuned_model, "tune")):
        query(None, None)
        assert "RandomForestRegressor" in [s.name for s in calls["train_models"][0][3]] and calls[operator][1] == {}
    modelling.auto_model(None, None)
    assert calls["auto"][1] == {}
