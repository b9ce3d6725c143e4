"""The Python workers must not need the package on their path."""

from __future__ import annotations

import os
import subprocess
import sys

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from daypanel.operators.impute import assign_blocks, knn_impute
from daypanel.session import local_session
spark = local_session("2", "1g")
rows = spark.sql("select id as hadm_id, date'2024-01-01' as startdate, "
                 "array(if(id = 1, null, cast(id as double)), 1.0d) as features from range(4)")
print("filled", sorted(r.features[0] for r in knn_impute(assign_blocks(rows, 4)).collect()))
"""


def test_workers_run_outside_the_repository(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(root=root)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120
    )
    assert "filled [0.0, " in done.stdout, done.stderr[-2000:]
