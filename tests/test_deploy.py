import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
from __spark_entry__ import queries
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
print("rows", queries()["from_flat_vectors"](spark, {folder!r}).count())
"""


def test_workers_find_the_package_from_any_folder(tmp_path, folder):
    repo = str(Path(__file__).resolve().parents[1])
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(repo=repo, folder=folder)],
        cwd=tmp_path, capture_output=True, text=True, timeout=300,
    )
    assert "rows 500" in done.stdout, done.stderr[-2000:]
