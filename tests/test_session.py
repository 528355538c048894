import pytest

from cairn.session import folder_bytes, scratch_dir, shuffle_partitions, tune


def test_shuffles_grow_with_the_input():
    assert shuffle_partitions(0) == 1
    assert shuffle_partitions(10 << 30) == 241
    assert shuffle_partitions(100 << 40) == 1 + 3 * (100 << 40) // (128 << 20)


def test_tune_measures_the_folder(spark, conf, tmp_path):
    (tmp_path / "a").write_bytes(b"x" * 1000)
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "b").write_bytes(b"x" * 500)
    assert 1500 <= folder_bytes(spark, str(tmp_path)) < 1600
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    conf(key, "4")
    tune(spark, str(tmp_path))
    assert int(spark.conf.get(key)) == spark.sparkContext.defaultParallelism


def test_scratch_lies_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first.startswith(f"{shared}/cairn/x-") and first != second


class ClusterSession:
    """A session on a cluster that names no shared folder."""

    class conf:
        @staticmethod
        def get(key, default=None):
            return {"spark.master": "yarn"}.get(key, default)


def test_no_machine_local_scratch_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(ClusterSession, "x")


def test_tasks_read_little_and_write_partitions_unsorted(spark, conf, tmp_path):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    for key in (*keys, "spark.sql.adaptive.coalescePartitions.initialPartitionNum"):
        conf(key, spark.conf.get(key, None) or "4")
    tune(spark, str(tmp_path))
    assert {spark.conf.get(key) for key in keys} == {str(32 << 20)}
    assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) > 0
