"""Scratch tables of an application end with its driver."""
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = """
import sys; sys.path.insert(0, {root!r})
from barlake.session import build_session, scratch_path
spark = build_session("local[1]", extra_conf={{"spark.checkpoint.dir": "file://{folder}"}})
path = scratch_path(spark, "t")
spark.range(3).write.parquet(path)
print("rows", spark.read.parquet(path).count())
{end}
"""


def test_scratch_goes_with_the_driver(tmp_path):
    for i, end in enumerate(("", "spark.stop()", "raise SystemExit(3)")):
        folder = tmp_path / str(i)
        folder.mkdir()
        run = subprocess.run([sys.executable, "-c", SCRIPT.format(root=ROOT, folder=folder, end=end)], capture_output=True, text=True, timeout=300)
        assert "rows 3" in run.stdout, run.stderr[-2000:]
        left = [d for d, _, files in os.walk(folder) if any(f.endswith(".parquet") for f in files)]
        assert not left
