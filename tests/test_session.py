"""Settings of the submission survive; clusters need a shared folder."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest

from adinsight.session import checkpoint_dir
from tests.conftest import ROOT


def test_submitted_settings_survive(tmp_path):
    script = tmp_path / "job.py"
    script.write_text("from adinsight.session import get_spark\n"
                      "s = get_spark(master='local[7]', conf={'spark.sql.shuffle.partitions': '9'})\n"
                      "print('GOT', s.sparkContext.master, s.conf.get('spark.sql.shuffle.partitions'), s.sparkContext.getConf().get('spark.driver.memory'))\n")
    env = os.environ | {"PYTHONPATH": ROOT, "PYSPARK_PYTHON": sys.executable, "PYSPARK_DRIVER_PYTHON": sys.executable}
    import pyspark
    submit = os.path.join(os.path.dirname(pyspark.__file__), "bin", "spark-submit")
    out = subprocess.run([submit, "--master", "local[2]", "--conf", "spark.sql.shuffle.partitions=4000", "--conf",
                          "spark.ui.enabled=false", "--driver-memory", "700m", str(script)],
                         env=env, capture_output=True, text=True, timeout=300)
    assert "GOT local[2] 4000 700m" in out.stdout, out.stderr[-1500:]


def test_a_cluster_without_a_shared_folder_is_refused():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())
