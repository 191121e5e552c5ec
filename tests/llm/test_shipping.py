import subprocess
import sys
from pathlib import Path

PROGRAM = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", {folder!r}).getOrCreate()
import __spark_entry__ as contract
print(contract.queries()["op5_packed_documents"](spark, "/root/testdata/sf0.001").count())
"""


def test_workers_find_the_package_wherever_the_program_runs(tmp_path):
    """No PYTHONPATH, another working folder, and a session that stood before the import."""
    import os

    program = PROGRAM.format(root=str(Path(__file__).resolve().parents[2]), folder=str(tmp_path / "shared"))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", program], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.stdout.split()[-1:] == ["200"], done.stderr[-2000:]
