from __future__ import annotations

import os
import subprocess
import sys
import textwrap

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def run(master: str, tmp_path) -> subprocess.CompletedProcess:
    """Stages a table in a session of its own without spark.checkpoint.dir."""
    code = f"""
        from cellpulse.session import session
        from cellpulse.staging import shared_folder, written
        from pyspark.sql import SparkSession
        spark = session("staging", "{master}", **{{"spark.ui.enabled": "false"}})
        assert written(spark.range(5), "five").count() == 5
        assert shared_folder(spark) == shared_folder(spark)
        print("staged")
    """
    env = {**os.environ, "PYTHONPATH": ROOT, "TMPDIR": str(tmp_path), "SPARK_CONF_DIR": str(tmp_path)}
    return subprocess.run([sys.executable, "-c", textwrap.dedent(code)], env=env, capture_output=True, text=True, timeout=300)


def test_local_session_without_setting(tmp_path):
    assert "staged" in run("local[2]", tmp_path).stdout


def test_shared_folder_is_asked_for_on_a_cluster():
    from types import SimpleNamespace

    import pytest

    from cellpulse.staging import shared_folder

    context = SimpleNamespace(master="local-cluster[2,1,1024]", getCheckpointDir=lambda: None)
    spark = SimpleNamespace(conf={"other": "x"}, sparkContext=context)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(spark)
