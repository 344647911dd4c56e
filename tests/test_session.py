"""The folder for scratch data, with and without the setting."""

import subprocess
import sys
from pathlib import Path

from pyspark.sql import SparkSession

from tidemark.session import scratch, written

ROOT = str(Path(__file__).resolve().parents[1])

OWN = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
from tidemark.session import scratch, written
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false"){preset}.getOrCreate()
preset = spark.conf.get("spark.checkpoint.dir", None)
first, second = scratch(spark, "a"), scratch(spark, "a")
assert first != second and first.rsplit("/", 1)[0] == second.rsplit("/", 1)[0]
assert preset == spark.conf.get("spark.checkpoint.dir", None)
print("rows", written(spark.range(3), "b").count(), "under", first)
"""


def run(preset: str, env=None) -> str:
    code = OWN.format(root=ROOT, preset=preset)
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300, env=env)
    assert done.returncode == 0, done.stderr[-2000:]
    return done.stdout


def test_a_local_session_without_the_setting(tmp_path, monkeypatch):
    """An empty configuration folder: nothing presets the folder, and it can't be set afterwards."""
    import os

    assert "rows 3" in run("", {**os.environ, "SPARK_CONF_DIR": str(tmp_path)})


def test_the_setting_is_followed(tmp_path):
    out = run(f'.config("spark.checkpoint.dir", "{tmp_path}")')
    assert "rows 3" in out and f"under {tmp_path}/tidemark/" in out


def test_sessions_for_tests_keep_to_one_folder(spark: SparkSession):
    first, second = (scratch(spark, "x").rsplit("/", 1)[0] for _ in range(2))
    root = spark.conf.get("spark.checkpoint.dir", None)
    assert first == second and (root is None or first.startswith(root.rstrip("/"))) and written(spark.range(2), "y").count() == 2
