"""Where written tables go: the shared folder named by spark.checkpoint.dir."""

import pytest

from stratus.session import is_local, output_path, shared_dir


def test_shared_dir_and_output_paths(spark):
    sc = spark.sparkContext
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    d = shared_dir(spark)
    # the configured shared folder when there is one (a cluster), else the
    # context's checkpoint folder that shared_dir set up (tests)
    assert d == (conf_dir or sc.getCheckpointDir()).rstrip("/")
    assert sc.getCheckpointDir()  # checkpoint() has somewhere to write
    a, b = output_path(spark, "x"), output_path(spark, "x")
    assert a != b and a.startswith(d + "/stratus-out/x-") and b.startswith(d + "/stratus-out/x-")


def test_masters_that_need_a_shared_folder():
    assert is_local("local[8]") and is_local("local") and is_local("local[*]")
    assert not any(map(is_local, ("local-cluster[2,1,1024]", "yarn", "spark://host:7077", "k8s://host")))


def test_no_machine_local_folder_on_a_cluster(monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "yarn"
        getConf = staticmethod(Conf)
        getCheckpointDir = staticmethod(lambda: None)

        def setCheckpointDir(self, path):
            raise AssertionError(path)

    class Session:
        sparkContext = Context()
        conf = Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session())
