"""Session helpers: scratch folders under the session's checkpoint dir."""

from trendspark.session import checkpoint_root, scratch_dir


def test_scratch_dirs_live_under_checkpoint_root(spark):
    root = checkpoint_root(spark)
    assert root and spark.conf.get("spark.checkpoint.dir", None)
    a, b = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert a != b and a.startswith(root) and b.startswith(root)


def test_cluster_without_checkpoint_dir_is_an_error():
    import pytest

    class Conf:
        def __init__(self):
            self.d = {"spark.master": "yarn"}

        def get(self, k, default=None):
            return self.d.get(k, default)

        def set(self, k, v):
            self.d[k] = v

    class SC:
        def getCheckpointDir(self):
            return None

    class FakeSession:
        conf = Conf()
        sparkContext = SC()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(FakeSession())
