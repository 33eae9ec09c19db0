from tessera.session import fresh_path, scale_conf, scratch_dir


def test_scale_conf_sizes_and_caps():
    c = scale_conf(100 * 1024 ** 4, 8000)
    assert c["spark.sql.shuffle.partitions"] == "100000"          # capped
    assert c["spark.sql.adaptive.enabled"] == "true"
    small = scale_conf(10 * 1024 ** 2, 8)
    assert small["spark.sql.shuffle.partitions"] == "16"          # two waves of cores
    mid = scale_conf(1024 ** 4, 8000, target_partition_bytes=1024 ** 3)
    assert mid["spark.sql.shuffle.partitions"] == "16000"         # 1 TB / 1 GB, floor 2x cores


def test_scratch_dir_is_the_session_checkpoint_dir(spark):
    d = scratch_dir(spark)
    assert d == spark.sparkContext.getCheckpointDir().rstrip("/")
    a, b = fresh_path(spark, "x"), fresh_path(spark, "x")
    assert a != b and a.startswith(d) and b.startswith(d)


def test_scratch_dir_needs_a_shared_folder_on_a_cluster():
    import pytest

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(Session())
