"""Scratch folder and shipping."""

import types
import zipfile

import pytest

from adtally.session import package_zip, shared_dir


def fake(master, base=None):
    conf = types.SimpleNamespace(get=lambda key: base)
    return types.SimpleNamespace(sparkContext=types.SimpleNamespace(master=master, getCheckpointDir=lambda: None, getConf=lambda: conf))


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "local-cluster[2,1,1024]"])
def test_a_cluster_needs_a_shared_folder(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(fake(master))
    assert shared_dir(fake(master, "s3a://bucket/scratch/"), "a", "b") == "s3a://bucket/scratch/a/b"


def test_package_zip_holds_the_modules(tmp_path):
    with zipfile.ZipFile(package_zip(str(tmp_path))) as zf:
        names = zf.namelist()
    assert "adtally/session.py" in names and "adtally/operators/lines.py" in names
    assert all(n.endswith(".py") for n in names)
