"""Stage registry and scratch tables."""

import glob
import os
from datetime import timedelta

import pytest

from spanfeat import session
from spanfeat.sources.stages import StageRegistry, content_key


def test_a_stage_is_built_once_per_key(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.range(5).write.parquet(source)
    stages = StageRegistry(spark, f"file://{tmp_path}/stages", "team")
    built = []

    def run(key):
        def build():
            built.append(key)
            return spark.read.parquet(source).withColumnRenamed("id", "k")

        return stages.stage("clean", key, build)

    first = content_key(spark, [source], level=1)
    assert run(first).count() == 5 and run(first).columns == ["k"] and built == [first]
    again = StageRegistry(spark, f"file://{tmp_path}/stages", "team")
    assert again.stage("clean", first, lambda: pytest.fail("built twice")).count() == 5
    assert content_key(spark, [source], level=2) != first
    spark.range(3).write.mode("append").parquet(source)
    second = content_key(spark, [source], level=1)
    assert second != first and run(second).count() == 8
    assert sorted(e["key"] for e in stages.entries()) == sorted([first, second])


def test_a_killed_run_resumes_at_the_last_whole_stage(spark, tmp_path):
    root = f"file://{tmp_path}/stages"
    log = []

    def flow(fail):
        stages = StageRegistry(spark, root, "nightly")

        def one():
            log.append("one")
            return spark.range(10)

        def two():
            log.append("two")
            if fail:
                # rows are half written when the run dies: files, but no manifest
                spark.range(1).write.mode("overwrite").parquet(f"{root}/nightly/two-k")
                raise KeyboardInterrupt
            return stages.stage("one", "k", one).filter("id < 4")

        stages.stage("one", "k", one)
        return stages.stage("two", "k", two)

    with pytest.raises(KeyboardInterrupt):
        flow(True)
    assert flow(False).count() == 4 and log == ["one", "two", "two"]


def test_owners_remove_their_own(spark, tmp_path):
    root = f"file://{tmp_path}/stages"
    a, b = StageRegistry(spark, root, "a"), StageRegistry(spark, root, "b")
    a.stage("s", "k", lambda: spark.range(1), lifetime=timedelta(hours=1))
    a.stage("t", "k", lambda: spark.range(2).selectExpr("id", "id AS part"), partition_by=["part"])
    b.stage("s", "k", lambda: spark.range(3))
    assert a.expire(now=0) == 0 and a.expire(now=4e9) == 1 and [e["name"] for e in a.entries()] == ["t"]
    assert a.stage("t", "k", lambda: pytest.fail("is there")).columns == ["id", "part"]
    a.remove()
    assert a.entries() == [] and not os.path.exists(f"{tmp_path}/stages/a")
    assert b.stage("s", "k", lambda: pytest.fail("is there")).count() == 3
    with pytest.raises(ValueError):
        StageRegistry(spark, root, "a/b")


def test_scratch_tables_are_deleted(spark):
    root = session.checkpoint_root(spark).removeprefix("file:")
    kept = session.staged(spark.range(3), "probe")
    assert kept.count() == 3 and glob.glob(f"{root}/probe-*")
    folder = session.scratch(spark, "probe")
    spark.range(1).write.parquet(folder)
    session.discard(spark, folder)
    assert not os.path.exists(folder.removeprefix("file:"))
    before = set(session._held)
    session._held.intersection_update({p for p in before if "/probe-" in p})
    try:
        assert session.clear_scratch(spark) == 1 and not glob.glob(f"{root}/probe-*")
    finally:
        session._held.update(p for p in before if "/probe-" not in p)
