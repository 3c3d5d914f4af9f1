"""Every flow is registered at the length its preset publishes."""

import pytest

from tallyloom.catalog import QUERIES, SQL
from tallyloom.plans import documents

WHOLE = {"logistic_full": "_whole", "logistic_full_unstemmed": "_whole", "logistic_batches": "_whole", "svm_batches": "_whole",
         "multinomial": ""}


@pytest.mark.parametrize("name", sorted(WHOLE))
def test_flow_runs_its_preset(spark, folder, monkeypatch, name):
    seen = []
    monkeypatch.setattr(documents, "run_documents", lambda train, test, preset, passes=None, **rest: seen.append((preset, passes)))
    QUERIES[f"flow_{name}{WHOLE[name]}"](spark, folder)
    assert [(p, n or documents.PRESETS[p].passes) for p, n in seen] == [(name, documents.PRESETS[name].passes)]
    assert name == "multinomial" or f"flow_{name}_whole" in SQL
