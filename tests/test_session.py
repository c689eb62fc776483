"""Workers get the package from the session, whatever folder the driver runs in."""

import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]

SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
from catalogops.session import build
from catalogops.operators import vectors
spark = build("foreign", "local[2]", **{"spark.checkpoint.dir": sys.argv[2]})
df = spark.createDataFrame([(1, "red bolt"), (2, "red bolts"), (3, "gizmo")], "row_id long, name string")
rows = vectors.knn(vectors.embed_hashed(df, "name"), "row_id", "vector", 2, 0.1).count()
print("ROWS", rows)
"""


def test_python_workers_need_no_path(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT, str(ROOT), str(tmp_path / "shared")],
        cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300,
    )
    assert "ROWS" in done.stdout, done.stderr[-2000:]
