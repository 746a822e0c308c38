"""Scratch tables: where they go, and that they go when the session ends."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

SCRIPT = """
import sys
from pyspark.sql import SparkSession
from lexmeter.sources.scratch import new_folder, written

builder = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
spark = builder.config(sys.argv[1], sys.argv[2]).getOrCreate()
folder = new_folder(spark)
assert written(spark.range(5), f"{folder}/numbers").count() == 5
print("FOLDER", folder, new_folder(spark) != folder)
spark.stop()
"""


@pytest.mark.parametrize("setting", ["spark.checkpoint.dir", "spark.sql.warehouse.dir"])
def test_scratch_goes_to_the_shared_folder_and_is_removed(tmp_path, setting):
    command = [sys.executable, "-c", SCRIPT, setting, str(tmp_path / "shared")]
    repository = Path(__file__).resolve().parents[1]
    # Without the machine's own settings, which may name a checkpoint folder.
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path)}
    done = subprocess.run(
        command, cwd=repository, env=env, capture_output=True, text=True, timeout=120
    )
    assert done.returncode == 0, done.stderr[-2000:]
    [line] = [line for line in done.stdout.splitlines() if line.startswith("FOLDER")]
    _, folder, other = line.split()
    assert f"{tmp_path}/shared/" in folder and other == "True"
    assert not list(tmp_path.rglob("*.parquet")) and not list(tmp_path.rglob("lexmeter-*"))
