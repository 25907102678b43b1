from readerflow.session import cluster_settings, shared_dir


def test_cluster_settings_scale_with_input():
    big = cluster_settings(100 * 2**40, 8000)
    assert int(big["spark.sql.shuffle.partitions"]) == 100 * 2**40 // (256 << 20)
    small = cluster_settings(10 << 20, 8)
    assert int(small["spark.sql.shuffle.partitions"]) == 24  # three waves over the cores
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_shared_dir_comes_from_session(spark):
    d = shared_dir(spark)
    assert d and d == shared_dir(spark)
