from snapdiff.session import checkpoint_dir, cluster_settings


def test_cluster_settings_scale_with_input():
    small = cluster_settings(10 * 2**30, executors=10, cores_per_executor=4)
    big = cluster_settings(100 * 2**40, executors=1000, cores_per_executor=8)
    assert int(small["spark.sql.shuffle.partitions"]) == 80  # two waves of 40 cores
    assert int(big["spark.sql.shuffle.partitions"]) == 409600  # 100 TiB / 256 MiB
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_checkpoint_dir_is_configured(spark):
    d = checkpoint_dir(spark)
    assert d and spark.sparkContext.getCheckpointDir() == d
