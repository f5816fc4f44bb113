"""The entry without the training-data operators, as on a copy that lacks them."""

from __future__ import annotations

import json
import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LIST = ("import json, __spark_entry__ as E; "
        "print(json.dumps([sorted(E.queries()), sorted(E.oracle_sql())]))")


@pytest.mark.parametrize("with_pipeline", [True, False])
def test_entry_without_training_operators(tmp_path, with_pipeline):
    """Neither the operators' folder nor the pipeline is needed for the other queries."""
    copy = tmp_path / "copy"
    shutil.copytree(os.path.join(ROOT, "ashgrid"), copy / "ashgrid",
                    ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", *(["corpus_pipeline.py"] if with_pipeline else [])):
        if os.path.exists(os.path.join(ROOT, name)):
            shutil.copy(os.path.join(ROOT, name), copy / name)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", LIST], cwd=copy, env=env, text=True,
                         capture_output=True, timeout=120, check=True).stdout
    names, with_sql = json.loads(out.strip().splitlines()[-1])
    from ashgrid.plans.catalog import REGISTRY
    assert names == sorted(REGISTRY)
    assert with_sql == sorted(n for n, e in REGISTRY.items() if e.sql is not None)
