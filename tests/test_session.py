"""Where tables that outlive a job may go, and what may be absent."""

import subprocess
import sys
from pathlib import Path

import pytest

from pulsepanel import session

ROOT = Path(__file__).resolve().parent.parent


class Conf(dict):
    def set(self, key, value):
        self[key] = value


class Session:
    def __init__(self, **conf):
        self.conf = Conf({k.replace("_", "."): v for k, v in conf.items()})
        self.sparkContext = self
        self.kept = None

    def getCheckpointDir(self):
        return self.kept

    def setCheckpointDir(self, path):
        self.kept = path


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "k8s://host", "local-cluster[2,1,1024]", ""])
def test_clusters_must_name_a_shared_folder(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Session(spark_master=master))
    named = Session(spark_master=master, spark_checkpoint_dir="s3a://shared/x")
    assert session.shared_dir(named) == "s3a://shared/x" == named.kept


def test_local_sessions_get_a_folder_of_their_own():
    made = Session(spark_master="local[4]")
    assert session.shared_dir(made) == made.kept == session.shared_dir(made)


@pytest.mark.parametrize("absent,fine", [("pulsepanel.llm", True), ("corpus_pipeline", True), ("zstandard", False)])
def test_only_the_optional_part_may_be_absent(absent, fine):
    code = f"""
import sys
class Absent:
    def find_spec(self, name, path=None, target=None):
        if name == {absent!r}:
            raise ModuleNotFoundError("No module named " + name, name=name)
sys.meta_path.insert(0, Absent())
import __spark_entry__
assert __spark_entry__.llm is None and len(__spark_entry__.queries()) > 150
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    # without the optional folders a missing wheel is not asked for
    llm = (ROOT / "pulsepanel" / "llm").exists() and (ROOT / "corpus_pipeline.py").exists()
    assert (done.returncode == 0) == (fine or not llm), done.stderr
