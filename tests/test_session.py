"""Where checkpoints go: the named folder, else the warehouse, never a folder that other machines cannot see."""

from types import SimpleNamespace

import pytest

from atlas.session import ensure_checkpoint_dir


class Context:
    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


@pytest.mark.parametrize("master, warehouse, named, folder", [
    ("local[2]", "file:/x", None, "file:/x/checkpoints"), ("yarn", "hdfs://a/w/", None, "hdfs://a/w/checkpoints"), ("yarn", "file:/x", "s3a://b/c", "s3a://b/c"),
    ("yarn", "file:/x", None, None), ("spark://m:7077", "/x", None, None)])
def test_checkpoint_folder(master, warehouse, named, folder):
    conf = {"spark.sql.warehouse.dir": warehouse} | ({"spark.checkpoint.dir": named} if named else {})
    spark = SimpleNamespace(sparkContext=Context(master), conf=SimpleNamespace(get=lambda k, *default: conf.get(k, *default)))
    if folder is None:
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            ensure_checkpoint_dir(spark)
    else:
        ensure_checkpoint_dir(spark)
        assert spark.sparkContext.folder == folder
