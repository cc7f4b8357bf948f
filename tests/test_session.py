from pathlib import Path
from types import SimpleNamespace

import pytest

from codetide.session import materialise, scratch, scratch_path, shared_dir


def session(master, folder=None):
    conf = SimpleNamespace(get=lambda key, default: folder or default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_the_named_folder_is_used():
    assert shared_dir(session("yarn", "s3a://shared/tmp/")) == "s3a://shared/tmp"


def test_only_a_local_session_may_fall_back():
    assert shared_dir(session("local[2]")) == shared_dir(session("local[8]"))
    for master in ("spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_dir(session(master))


def test_materialised_rows_no_longer_depend_on_their_source(spark):
    stored = materialise(spark.range(5).selectExpr("id * 2 AS n"), "numbers")
    assert [r.n for r in stored.orderBy("n").collect()] == [0, 2, 4, 6, 8]
    assert "Range" not in stored._jdf.queryExecution().executedPlan().toString()


def test_a_run_leaves_only_what_it_keeps(spark):
    with scratch(spark) as keep:
        inner = materialise(spark.range(3), "inner")
        kept = keep(inner.selectExpr("id + 1 AS n"), "result")
        folder = Path(inner.inputFiles()[0].removeprefix("file://")).parents[1]
        assert folder.exists()
    assert not folder.exists() and sorted(r.n for r in kept.collect()) == [1, 2, 3]
    with pytest.raises(KeyError), scratch(spark):
        lost = Path(materialise(spark.range(3), "lost").inputFiles()[0].removeprefix("file://"))
        raise KeyError
    assert not lost.exists()
    assert Path(scratch_path(spark, "x")).parents[1].name == "codetide"
