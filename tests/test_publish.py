import os

import pytest

from strata.sinks.publish import PublishError, current_version, publish, read_published, vacuum


def test_publish_and_read(spark, tmp_dir):
    target = os.path.join(tmp_dir, "t")
    p = publish(spark.range(10), target)
    assert p.rows == 10 and current_version(spark, target) == p.version
    assert read_published(spark, target).count() == 10


def test_empty_frame_raises_and_keeps_old_version(spark, tmp_dir):
    target = os.path.join(tmp_dir, "t")
    first = publish(spark.range(5), target)
    with pytest.raises(PublishError):
        publish(spark.range(0), target)
    assert current_version(spark, target) == first.version
    assert read_published(spark, target).count() == 5


def test_failure_between_stage_and_switch_keeps_old(spark, tmp_dir, monkeypatch):
    target = os.path.join(tmp_dir, "t")
    first = publish(spark.range(5), target)
    monkeypatch.setattr("strata.sinks.publish._commit", lambda *a: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError):
        publish(spark.range(7), target)
    monkeypatch.undo()
    assert os.listdir(os.path.join(target, "_versions")) == [first.version]     # what was staged is gone
    assert current_version(spark, target) == first.version
    assert read_published(spark, target).count() == 5


def test_publish_twice_equals_once(spark, tmp_dir):
    target = os.path.join(tmp_dir, "t")
    publish(spark.range(5), target)
    second = publish(spark.range(5), target)
    assert current_version(spark, target) == second.version
    assert sorted(r.id for r in read_published(spark, target).collect()) == list(range(5))
    removed = vacuum(spark, target, keep=1)
    assert len(removed) == 1 and read_published(spark, target).count() == 5


def test_nothing_published_raises(spark, tmp_dir):
    with pytest.raises(PublishError):
        read_published(spark, os.path.join(tmp_dir, "none"))


def test_count_mismatch_refuses_the_version(spark, tmp_dir, monkeypatch):
    import strata.sinks.publish as P

    real = P.read_parquet

    def short_read(spark_, path, columns=None):   # the staged copy reads back one row more
        df = real(spark_, path, columns)
        return df.unionByName(df.limit(1)) if "/_versions/" in path else df

    target = os.path.join(tmp_dir, "t")
    first = publish(spark.range(5), target)
    monkeypatch.setattr(P, "read_parquet", short_read)
    with pytest.raises(PublishError, match="staged copy has 8"):
        P.publish(spark.range(7), target)
    monkeypatch.undo()
    assert current_version(spark, target) == first.version
    assert len(os.listdir(os.path.join(target, "_versions"))) == 1   # the bad version is gone


def test_slow_writer_that_commits_last_is_live(spark, tmp_dir, monkeypatch):
    """The first publish stages first; the second starts and commits while it is held back."""
    import strata.sinks.publish as P

    target = os.path.join(tmp_dir, "t")
    real, inner = P._commit, []

    def held(spark_, target_, version):
        monkeypatch.setattr(P, "_commit", real)
        inner.append(P.publish(spark.range(3), target))
        return real(spark_, target_, version)

    monkeypatch.setattr(P, "_commit", held)
    slow = P.publish(spark.range(9), target)
    assert (inner[0].number, slow.number) == (1, 2)
    assert current_version(spark, target) == slow.version
    assert read_published(spark, target).count() == 9


def test_one_number_goes_to_one_writer(spark, tmp_dir, monkeypatch):
    """Both writers see the same last number; the loser takes the next one."""
    import strata.sinks.publish as P

    target = os.path.join(tmp_dir, "t")
    monkeypatch.setattr(P, "_numbers", lambda *a: [])
    a, b = P.publish(spark.range(1), target), P.publish(spark.range(2), target)
    monkeypatch.undo()
    assert (a.number, b.number) == (1, 2) and read_published(spark, target).count() == 2


def test_marker_of_a_dead_writer_is_passed_over(spark, tmp_dir):
    target = os.path.join(tmp_dir, "t")
    first = publish(spark.range(5), target)
    open(os.path.join(target, "_commits", "000000000002"), "w").close()
    assert current_version(spark, target) == first.version
    assert publish(spark.range(6), target).number == 3
