import os

import pytest

from strata.sources import fs


def test_fs_helpers(spark, tmp_dir):
    marker = os.path.join(tmp_dir, "a", "b", "marker")
    assert not fs.exists(spark, marker) and fs.list_names(spark, os.path.join(tmp_dir, "a")) == []
    fs.create_marker(spark, marker)
    assert fs.exists(spark, marker)
    assert fs.list_names(spark, os.path.join(tmp_dir, "a", "b")) == ["marker"]
    assert fs.total_size(spark, marker) == 0
    assert fs.total_size(spark, marker + "x") is None
    assert fs.qualify(spark, marker).startswith("file:")
    assert not fs.create_marker(spark, marker)
    assert fs.create_marker(spark, marker + "2", "text") and fs.read_text(spark, marker + "2") == "text"
    assert fs.delete(spark, os.path.join(tmp_dir, "a"))
    assert not fs.exists(spark, marker) and not fs.delete(spark, marker)
