"""Session helpers: shuffle sizing and the checkpoint folder lookup."""

from txnlake.session import checkpoint_dir, scale_conf


def test_scale_conf_sizes_partitions_to_the_input():
    tb = 1024**4
    big = scale_conf(100 * tb)
    assert int(big["spark.sql.shuffle.partitions"]) == 200_000  # capped
    assert int(scale_conf(1 * tb)["spark.sql.shuffle.partitions"]) == 4096
    assert int(scale_conf(10 * 1024**2)["spark.sql.shuffle.partitions"]) == 8


def test_checkpoint_dir_uses_the_sessions_setting(spark):
    d = spark.sparkContext.getCheckpointDir()
    assert d and checkpoint_dir(spark) == d
